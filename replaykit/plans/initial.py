"""Initial load of the master sources: all four or none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.registry import MASTER_SOURCES
from ..sources.tables import replace_master
from .attempts import RowsOf


def initial_load(spark: SparkSession, database: str, outcomes: DataFrame, rows_of: RowsOf) -> dict[str, str]:
    """Load every master table whole, after all four sources were ingested.

    ``outcomes`` are ingestion outcomes of the delivered files.  A missing,
    unexpected or failed source refuses the load before any table changes.
    No ledger rows are written: master data has no delivery date.
    """
    source, good = F.col("source_object"), F.col("status") == "success"
    per_source = outcomes.filter(source.isin(*MASTER_SOURCES)).groupBy(source).agg(F.bool_and(good).alias("ok"))
    ok = {row.source_object: row.ok for row in per_source.collect()}
    unexpected = outcomes.filter(~F.coalesce(source.isin(*MASTER_SOURCES), F.lit(False))).count()
    missing = sorted(set(MASTER_SOURCES) - set(ok))
    failed = sorted(s for s, succeeded in ok.items() if not succeeded)
    if missing or unexpected or failed:
        raise ValueError(f"initial batch refused: missing {missing}, failed {failed}, rows of other sources: {unexpected}")
    return {source: replace_master(rows_of(source), database, source) for source in MASTER_SOURCES}
