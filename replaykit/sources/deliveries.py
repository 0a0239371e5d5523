"""Delivered CSV files: listing, contracts, counts and the all-text scan.

Layout of a delivery root: ``<root>/<source_object>/[delivery_date=<iso>/]<file>.csv``.

Files are judged in one scan of their lines, block by block, which splits large files
over many tasks (``blocks``).  Sources whose quoted fields span lines are read by the same blocks; the others
need no more than Spark's CSV reader in line mode.  ``line_safe`` tells them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.headers import header_columns, missing_columns
from ..functions.paths import file_name, has_csv_suffix
from ..session import written_table
from .blocks import block_facts, file_key, joined_records, per_file, records
from .registry import columns_of, with_registry

_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "inferSchema": "false", "mode": "PERMISSIVE"}


def describe_paths(files: DataFrame) -> DataFrame:
    """Add the source object, delivery date and file name encoded in ``path``."""
    path = F.col("path")
    day = F.regexp_extract(path, r"/delivery_date=([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$", 1)
    return files.select(
        "*",
        F.regexp_extract(path, r"/([^/]+)(?:/delivery_date=[^/]+)?/[^/]+$", 1).alias("source_object"),
        F.when(day != "", day.try_cast("date")).alias("delivery_date"),
        file_name(path).alias("source_file_name"),
    )


def local_path(path: Column) -> Column:
    """Local paths as file scans report them, with one slash; other schemes have one spelling."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file below a root; contents are not read.

    Scans leave out zero-byte files, so those come from the file index: the list
    of names Spark keeps on the driver for any scan of the root.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    sized = files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("file_size_bytes"))
    names = spark.createDataFrame([(path,) for path in files.inputFiles()], "path string")
    names = names.select(local_path(F.col("path")).alias("path"))
    listed = names.join(sized, "path", "left").withColumn(
        "file_size_bytes", F.coalesce("file_size_bytes", F.lit(0).cast("bigint"))
    )
    return describe_paths(listed)


def file_checks(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """First failing check of each expected ``path``: missing, directory, suffix, empty."""
    sizes = listing.select("path", "file_size_bytes")
    folders = listing.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("path"), F.lit(True).alias("is_folder")
    ).distinct()
    wanted = expected.withColumn("path", local_path(F.col("path")))
    joined = wanted.join(sizes, "path", "left").join(folders, "path", "left")
    size = F.col("file_size_bytes")
    check = (
        F.when(F.coalesce("is_folder", F.lit(False)), "not_a_regular_file")
        .when(size.isNull(), "missing")
        .when(~has_csv_suffix(F.col("path")), "not_csv")
        .when(size == 0, "empty")
        .otherwise("ok")
    )
    return joined.withColumn("file_check", check).drop("is_folder")


def file_facts(spark: SparkSession, root: str) -> DataFrame:
    """One row per listed file with everything the contracts need, computed once.

    Every later check reads this small table instead of the files.  Zero-byte
    files have no lines and hence null facts.  ``n_records`` counts the header too.
    """
    listed = list_files(spark, root).withColumn("file_key", file_key(F.col("path")))
    facts = listed.join(per_file(block_facts(spark, root)), "file_key", "left").drop("file_key")
    return written_table(facts.withColumn("header", header_columns(F.coalesce("header_line", F.lit("")))), "file-facts")


def header_contract(files: DataFrame, required: str = "required_columns") -> DataFrame:
    """Required names missing from each file's ``header``; extra names and order are free.

    ``required`` picks the registry column: the full schema, or
    ``slice_columns`` for the few names slicing depends on.
    """
    checked = with_registry(files)
    missing = missing_columns(F.col(required), F.col("header"))
    return (
        checked.withColumn("has_header", F.size("header") > 0)
        .withColumn("missing_columns", F.array_join(missing, ","))
        .withColumn("header_ok", F.col("has_header") & (F.col("missing_columns") == ""))
    )


def _by_line(spark: SparkSession, root: str, width: int) -> DataFrame:
    """Positional text columns of files without records over several lines, the first line of each dropped."""
    reader = spark.read.options(**_CSV_OPTIONS, recursiveFileLookup="true").schema(_positional(width))
    return reader.csv(root).select("*", F.col("_metadata.file_path").alias("path"))


def _by_block(spark: SparkSession, root: str, width: int, facts: DataFrame) -> DataFrame:
    """The same where quoted fields span lines.  Records are written once, as those that cross blocks are put together behind the scan."""
    whole = joined_records(written_table(records(spark, root, facts), "records"))
    schema = ", ".join(f"_c{i} string" for i in range(width))
    parsed = F.from_csv("record", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    return whole.select(parsed.alias("x"), "path").select("x.*", "path")


def _positional(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def scan_csv(spark: SparkSession, root: str, source_object: str, facts: DataFrame | None = None) -> DataFrame:
    """All-text rows of a source in registry column order, with the file path.

    Values are taken by header name, never by position, so reordered or extra
    columns are harmless.  Spark reads an unquoted empty field as null; the raw
    value is the empty string.  Short rows therefore read as empty text.
    """
    facts = file_facts(spark, root) if facts is None else facts
    names = columns_of(source_object)
    shape = facts.agg(F.max(F.size("header")), F.countDistinct("header_line"), F.bool_and("line_safe"))
    width, layouts, by_line = shape.first()
    width = max(width or 0, 1)
    rows = _by_block(spark, root, width, facts) if by_line is False else _by_line(spark, root, width)
    values = F.array(*[F.col(f"_c{i}") for i in range(width)])

    if layouts == 1:
        header = facts.filter(F.size("header") > 0).select("header").first().header
        lacking = sorted(set(names) - set(header))
        if lacking:
            raise ValueError(f"missing required columns: {', '.join(lacking)}")
        picked = [F.col(f"_c{header.index(n)}").alias(n) for n in names]
        scanned = rows.select(*picked, "path")
    else:
        # Headers differ between files: look each row's header up by file.
        headers = facts.filter(F.size("header") > 0).select("path", "header")
        position = {n: F.array_position("header", F.lit(n)).cast("int") for n in names}
        absent = F.concat(F.lit("missing required column in "), F.col("path"))
        picked = [
            F.when(position[n] > 0, F.get(values, position[n] - 1))
            .otherwise(F.raise_error(absent).cast("string"))
            .alias(n)
            for n in names
        ]
        scanned = rows.join(headers, "path").select(*picked, "path")
    filled = [F.coalesce(F.col(n), F.lit("")).alias(n) for n in names]
    return scanned.select(*filled, "path")


def record_counts(spark: SparkSession, root: str, facts: DataFrame | None = None) -> DataFrame:
    """Logical records of every listed file without its header, header-only and empty files included as 0.

    They are counted with the facts, so no file is read again.  A quoted field over several lines counts once.
    """
    facts = file_facts(spark, root) if facts is None else facts
    headers = F.when(F.col("header_line") != "", 1).otherwise(0)
    return facts.withColumn("record_count", F.greatest(F.coalesce("n_records", F.lit(0)) - headers, F.lit(0)).cast("bigint"))
