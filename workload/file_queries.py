"""Delivered CSV files written from the supplied tables and read back through the contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaykit.functions.dates import effective_ingestion_date, historical_ingestion_date
from replaykit.session import shared_dir
from replaykit.operators.runs import PHASES
from replaykit.sources import deliveries as d
from replaykit.sources.landing import checksums, ingestion_outcomes, landing_conflicts, landing_manifest

from . import bindings as b
from .catalog import query
from .daily import RAW_SQL, by_day, daily_rows, master_rows, stacked, stacked_sql
from .sqltext import sql

_WRITTEN: dict[tuple[str, str], str] = {}
COMPLETE = "-complete"
CSV = {"header": "true", "quote": '"', "escape": '"', "emptyValue": ""}


def _write_days(rows: DataFrame, path: str, **options: str) -> None:
    rows.write.mode("append").options(**CSV, **options).partitionBy("delivery_date").csv(path)


def delivered_root(spark: SparkSession, sf: str) -> str:
    """All eight sources as delivered files, written once per session and scale.

    Products lack a required column; reviews of every January are in Latin-1.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _WRITTEN:
        return _WRITTEN[key]
    root = shared_dir(spark, "delivered")
    for source, rows in master_rows(spark, sf).items():
        kept = rows.drop("product_width_cm")
        kept.write.options(**CSV).csv(f"{root}/{source}")
        if source == "products":
            rows.write.options(**CSV).csv(f"{root}{COMPLETE}/{source}")
    for source, rows in daily_rows(spark, sf, by_day).items():
        if source != "reviews":
            _write_days(rows, f"{root}/{source}")
            continue
        january = F.month("delivery_date") == 1
        accented = F.concat(F.lit("\u00e9"), "review_id").alias("review_id")
        latin = rows.filter(january).select(accented, *rows.columns[1:])
        _write_days(rows.filter(~january), f"{root}/{source}")
        _write_days(latin, f"{root}/{source}", encoding="ISO-8859-1")
    _WRITTEN[key] = root
    return root


_SCANNED = {**RAW_SQL, "reviews": "(SELECT * REPLACE (CASE WHEN extract(month FROM delivery_date) = 1 THEN chr(65533) ELSE '' END || review_id AS review_id) FROM delivered_reviews)"}


@query("raw_csv_scan", sql(stacked_sql(_SCANNED), *RAW_SQL.values()))
def raw_csv_scan(spark, sf):
    """All columns of all eight sources; products come from a delivery that has all of them.

    All other files are judged in one scan for all sources.
    """
    root = delivered_root(spark, sf)
    facts = d.file_facts(spark, root)
    parts = {s: d.scan_csv(spark, f"{root}/{s}", s, facts.filter(F.col("source_object") == s)) for s in RAW_SQL if s != "products"}
    parts["products"] = d.scan_csv(spark, f"{root}{COMPLETE}/products", "products")
    return stacked(parts)


def _per_delivery(files: DataFrame, *aggregates) -> DataFrame:
    return files.groupBy("source_object", "delivery_date").agg(*aggregates)


_COUNTS = " UNION ALL ".join(
    f"SELECT '{s}' AS source_object, {'delivery_date' if t.startswith('delivered') else 'CAST(NULL AS DATE)'} AS delivery_date, "
    f"count(*) AS record_count FROM {t} GROUP BY 1, 2"
    for s, t in RAW_SQL.items()
)


@query("record_counts", sql(_COUNTS, *RAW_SQL.values()))
def record_counts(spark, sf):
    root = delivered_root(spark, sf)
    return _per_delivery(d.record_counts(spark, root), F.sum("record_count").alias("record_count"))


@query("utf8_check", sql(f"""
SELECT source_object, delivery_date,
       NOT (source_object = 'reviews' AND coalesce(extract(month FROM delivery_date) = 1, FALSE)) AS valid_utf8
FROM ({_COUNTS})
""", *RAW_SQL.values()))
def utf8_check(spark, sf):
    facts = d.file_facts(spark, delivered_root(spark, sf))
    return _per_delivery(facts, F.bool_and("valid_utf8").alias("valid_utf8"))


@query("delivery_file_checks", sql(f"""
SELECT source_object, delivery_date, file_check FROM ({_COUNTS}), (VALUES ('ok'), ('missing'), ('not_a_regular_file')) AS t(file_check)
""", *RAW_SQL.values()))
def delivery_file_checks(spark, sf):
    """Every delivered file, a file that never came, and the folder taken for a file."""
    listing = d.list_files(spark, delivered_root(spark, sf))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    paths = F.explode(F.array("path", F.concat(folder, F.lit("/absent.csv")), folder))
    expected = listing.select("source_object", "delivery_date", paths.alias("path")).distinct()
    checked = d.file_checks(expected, listing)
    return checked.select("source_object", "delivery_date", "file_check").distinct()


def named_files(spark: SparkSession, sf: str) -> DataFrame:
    listing = d.list_files(spark, delivered_root(spark, sf))
    return listing.withColumn("ingestion_date", _ingestion_date())


def _ingestion_date():
    """Daily sources land a day later, master sources on one fixed day."""
    fixed = F.lit("2024-02-01").cast("date")
    return effective_ingestion_date(historical_ingestion_date(F.col("delivery_date")), fixed)


@query("landing_manifest")
def manifest(spark, sf):
    return landing_manifest(spark, delivered_root(spark, sf), named_files(spark, sf))


@query("artifact_checksums", sql("""
SELECT source, sha256(body) AS checksum, CAST(octet_length(encode(body)) AS BIGINT) AS file_size_bytes
FROM (SELECT source, string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS body FROM documents GROUP BY 1)
"""))
def artifact_checksums(spark, sf):
    """Digests of files whose bytes SQL can tell as well: the texts of each source, one file per source."""
    root = shared_dir(spark, "texts")
    rows = b.table(spark, sf, "documents").repartition("source").sortWithinPartitions("source", "doc_id")
    rows.select("text", "source").write.partitionBy("source").text(root)
    source = F.regexp_extract("path", "/source=([^/]*)/", 1)
    return checksums(spark, root).select(source.alias("source"), "checksum", "file_size_bytes")


@query("landing_conflicts", sql("""
SELECT k, landing_path, conflict FROM (
  SELECT k, landing_path, row_number() OVER (PARTITION BY landing_path ORDER BY k) > 1
         OR landing_path IN (SELECT 'raw/x/' || source_object || '/' || delivery_date FROM jobs WHERE k % 5 = 0) AS conflict
  FROM (SELECT k, 'raw/x/' || source_object || '/' || delivery_date AS landing_path FROM jobs WHERE k % 5 <> 0))
""", "jobs"))
def conflicts(spark, sf):
    """Every fifth order landed before; the others land now under their pair's path."""
    path = F.concat(F.lit("raw/x/"), "source_object", F.lit("/"), F.col("delivery_date").cast("string"))
    landed = b.jobs(spark, sf).select("k", path.alias("landing_path"))
    earlier = F.col("k") % 5 == 0
    flagged = landing_conflicts(landed.filter(~earlier), landed.filter(earlier), "k")
    return flagged.select("k", "landing_path", "conflict")


_ERRORS = {
    phase: f"category={category} component=connector operation={operation} message={message}"
    for phase, (category, operation, message) in PHASES.items()
}


@query("ingestion_outcomes", sql(f"""
SELECT source_object, delivery_date, status, CASE status WHEN 'success' THEN record_count END AS record_count,
       CASE WHEN status = 'success' THEN NULL WHEN invalid THEN '{_ERRORS["validate"]}' ELSE '{_ERRORS["land"]}' END AS error_message
FROM (SELECT *, CASE WHEN invalid OR source_object = 'payments' AND extract(month FROM delivery_date) = 6 THEN 'failed' ELSE 'success' END AS status
      FROM (SELECT *, source_object = 'products' OR (source_object = 'reviews' AND coalesce(extract(month FROM delivery_date) = 1, FALSE)) AS invalid
            FROM ({_COUNTS})))
""", *RAW_SQL.values()))
def outcomes(spark, sf):
    """Outcome per delivery; June payments are already landed."""
    root = delivered_root(spark, sf)
    existing = landing_manifest(spark, root, named_files(spark, sf)).filter(
        (F.col("source_object") == "payments") & (F.month(F.date_sub("ingestion_date", 1)) == 6)
    )
    files = ingestion_outcomes(spark, root, _ingestion_date(), existing)
    return _per_delivery(
        files,
        F.min("status").alias("status"),
        F.sum("record_count").alias("record_count"),
        F.min("error_message").alias("error_message"),
    )

