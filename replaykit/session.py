"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Spark defaults already cover AQE, coalescing and skew joins; these are the
# settings whose default is wrong for ledgers or for very large joins.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; all of them can be changed on a live session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


SCRATCH = "replaykit.scratch.dir"


def scratch_if_unset(spark: SparkSession) -> None:
    """Name a machine-local folder where no shared one is named: for tests and local runs only."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)):
        spark.conf.set(SCRATCH, tempfile.mkdtemp(prefix="replaykit-"))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for an intermediate table, below the one in ``spark.checkpoint.dir``.

    Driver and executors must see the same files, so there is no fallback to a
    temporary folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not base:
        raise ValueError("no shared folder: set spark.checkpoint.dir to one that driver and executors see")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def written_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Used where a result is read several times or must not change under later
    writes.  Unlike a cache it survives lost executors.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def written_so_far() -> list[str]:
    """Folders of the intermediate tables that this process has written and not dropped."""
    return list(_written)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove intermediate tables that nothing reads any more; only folders written by written_table go."""
    for path in paths:
        if path in _written:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            _written.remove(path)


def constant_table(spark: SparkSession, rows: Iterable[tuple], schema: dict[str, str]) -> DataFrame:
    """A few fixed rows as SQL values, whose size the optimiser knows and for which no Python worker starts."""

    def text(value) -> str:
        if isinstance(value, (list, tuple)):
            return f"CAST(array({', '.join(map(text, value))}) AS array<string>)"
        return str(value).lower() if isinstance(value, bool) else f"'{value}'"

    values = ", ".join(f"({', '.join(map(text, row))})" for row in rows)
    columns = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in schema.items())
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({', '.join(schema)})")
