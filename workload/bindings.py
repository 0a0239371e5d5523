"""Library inputs derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replaykit.operators.slicing import date_range
from replaykit.sources.registry import is_transactional
from replaykit.functions.paths import destination_id

from .sqltext import cte, day_series

DATASET = "db.raw"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A supplied table with its zone-less timestamps read as UTC; its schema is looked up once."""
    path = f"{sf}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = _zoned(spark.read.parquet(path))
    return _TABLES[key]


def _zoned(df: DataFrame) -> DataFrame:
    zoned = [
        F.col(f.name).cast("timestamp").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*zoned)


def plain(df: DataFrame) -> DataFrame:
    """Results with zone-less timestamps, so that no client zone shifts them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def padded(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 10, "0"))


def days_of(df: DataFrame, extra: int = 0) -> DataFrame:
    """Calendar of ``delivery_date`` with some days after its end."""
    bounds = df.agg(
        F.min("delivery_date").alias("start_date"),
        F.date_add(F.max("delivery_date"), extra).alias("end_date"),
    )
    return date_range(bounds).select("delivery_date")


# --- replay events from events ------------------------------------------------

EVENT_SOURCE = {"click": "orders", "view": "order_items", "purchase": "payments", "signup": "reviews"}
FAILED = "category=warehouse_load_failed component=job operation=load message=Load failed"


def replay_events(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    source = F.lit("unplanned")
    for kind, name in EVENT_SOURCE.items():
        source = F.when(F.col("event_type") == kind, name).otherwise(source)
    success = F.when(F.col("event_type") == "error", k % 311 == 0).otherwise(k % 31 == 0)
    status = F.when(success, "success").when(k % 4 < 2, "running").otherwise("failed")
    stage = F.when(success, "warehouse").when(k % 2 == 0, "ingestion").otherwise("warehouse")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return events.select(
        F.concat(F.lit("run-"), (k % 7).cast("string")).alias("run_id"),
        padded("", k).alias("event_id"),
        F.col("ts").cast("date").alias("delivery_date"),
        source.alias("source_object"),
        status.alias("status"),
        stage.alias("stage"),
        (F.col("ts") - F.expr("interval 5 minutes")).alias("started_at"),
        F.when(status != "running", F.col("ts")).alias("completed_at"),
        F.when(status == "failed", FAILED).alias("error_message"),
        F.col("ts").alias("recorded_at"),
    )


cte("replay_events", f"""
SELECT 'run-' || (k % 7) AS run_id, lpad(CAST(k AS VARCHAR), 10, '0') AS event_id,
       CAST(ts AS DATE) AS delivery_date,
       CASE event_type WHEN 'click' THEN 'orders' WHEN 'view' THEN 'order_items'
            WHEN 'purchase' THEN 'payments' WHEN 'signup' THEN 'reviews' ELSE 'unplanned' END AS source_object,
       CASE WHEN ok THEN 'success' WHEN k % 4 < 2 THEN 'running' ELSE 'failed' END AS status,
       CASE WHEN ok THEN 'warehouse' WHEN k % 2 = 0 THEN 'ingestion' ELSE 'warehouse' END AS stage,
       ts - INTERVAL 5 MINUTE AS started_at,
       CASE WHEN ok OR k % 4 >= 2 THEN ts END AS completed_at,
       CASE WHEN NOT ok AND k % 4 >= 2 THEN '{FAILED}' END AS error_message,
       ts AS recorded_at
FROM (SELECT event_id AS k, ts, event_type,
             CASE WHEN event_type = 'error' THEN event_id % 311 = 0 ELSE event_id % 31 = 0 END AS ok
      FROM events)
""")
cte("event_days", day_series("replay_events", "delivery_date", 1))
cte("daily", """
SELECT * FROM (VALUES ('order_items'), ('orders'), ('payments'), ('reviews')) AS t(source_object)
""")
cte("event_grid", "SELECT delivery_date, source_object FROM event_days, daily")
cte("latest_attempts", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY delivery_date, source_object
                               ORDER BY recorded_at DESC, event_id DESC) AS rn FROM replay_events)
WHERE rn = 1
""")
cte("completions", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY delivery_date, source_object
                               ORDER BY recorded_at DESC, event_id DESC) AS rn
  FROM replay_events WHERE status = 'success')
WHERE rn = 1
""")
cte("day_complete", """
SELECT d.delivery_date,
       count(*) FILTER (WHERE c.source_object IN (SELECT source_object FROM daily)) AS n_completed,
       count(*) FILTER (WHERE c.source_object NOT IN (SELECT source_object FROM daily)) AS n_unexpected
FROM event_days d LEFT JOIN completions c USING (delivery_date) GROUP BY 1
""")
cte("day_status", "SELECT *, n_completed = 4 AND n_unexpected = 0 AS complete FROM day_complete")


# --- load jobs, provenance and physical state from orders ---------------------
#
# Every order is one load attempt of the pair (order date, source by key), so the
# ledgers grow with the orders table and most pairs have several attempts.


def _source_by_key(k: Column) -> Column:
    return (
        F.when(k % 4 == 0, "order_items")
        .when(k % 4 == 1, "orders")
        .when(k % 4 == 2, "payments")
        .otherwise("reviews")
    )


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    pair_no = F.datediff(day, F.lit("1995-01-01").cast("date")) * 4 + (k % 4)
    return orders.select(
        k.alias("k"),
        day.alias("delivery_date"),
        _source_by_key(k).alias("source_object"),
        (pair_no % 15).cast("int").alias("fault"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=k.cast("decimal(18,6)"))).alias("recorded_at"),
    )


cte("jobs", """
SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS delivery_date,
       CASE o_orderkey % 4 WHEN 0 THEN 'order_items' WHEN 1 THEN 'orders'
            WHEN 2 THEN 'payments' ELSE 'reviews' END AS source_object,
       ((CAST(o_orderdate AS DATE) - DATE '1995-01-01') * 4 + o_orderkey % 4) % 15 AS fault,
       o_orderdate + to_seconds(o_orderkey) AS recorded_at
FROM orders
""")


def _uri(segment: str, day: Column, lag: Column) -> Column:
    return F.concat(
        F.lit("gs://bucket/raw/"),
        "source_object",
        F.lit(f"/{segment}ingestion_date="),
        F.date_format(F.date_add(day, lag), "yyyy-MM-dd"),
        F.lit("/"),
        F.col("k").cast("string"),
        F.lit(".csv"),
    )


def _job_facts(spark: SparkSession, sf: str) -> DataFrame:
    fault, day, k = F.col("fault"), F.col("delivery_date"), F.col("k")
    uri = F.when(fault == 11, _uri("x", day, F.lit(1))).otherwise(
        _uri("", day, F.when(fault == 10, 2).otherwise(1))
    )
    return jobs(spark, sf).select(
        "*",
        uri.alias("gcs_uri"),
        F.sha2(k.cast("string"), 256).alias("sum_text"),
        F.when(fault == 2, 0).otherwise(k % 1000).cast("bigint").alias("n_rows"),
    )


cte("job_facts", """
SELECT *, 'gs://bucket/raw/' || source_object || CASE WHEN fault = 11 THEN '/xingestion_date=' ELSE '/ingestion_date=' END
          || strftime(delivery_date + CASE WHEN fault = 10 THEN 2 ELSE 1 END, '%Y-%m-%d') || '/' || k || '.csv' AS gcs_uri,
       sha256(CAST(k AS VARCHAR)) AS sum_text,
       CASE WHEN fault = 2 THEN 0 ELSE k % 1000 END AS n_rows
FROM jobs
""")


def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    return _job_facts(spark, sf).filter(F.col("fault") != 4).select(
        padded("p-", k).alias("provenance_id"),
        F.concat(F.lit("run-"), (k % 7).cast("string")).alias("run_id"),
        "delivery_date",
        "source_object",
        F.date_add("delivery_date", 1).alias("ingestion_date"),
        "gcs_uri",
        F.col("sum_text").alias("checksum"),
        (k % 1000 + 100).alias("file_size_bytes"),
        F.col("n_rows").alias("record_count"),
        "recorded_at",
    )


cte("artifacts", """
SELECT 'p-' || lpad(CAST(k AS VARCHAR), 10, '0') AS provenance_id, 'run-' || (k % 7) AS run_id,
       delivery_date, source_object, delivery_date + 1 AS ingestion_date, gcs_uri,
       sum_text AS checksum, k % 1000 + 100 AS file_size_bytes, n_rows AS record_count, recorded_at
FROM job_facts WHERE fault <> 4
""")


def loads(spark: SparkSession, sf: str) -> DataFrame:
    k, source, day = F.col("k"), F.col("source_object"), F.col("delivery_date")
    return _job_facts(spark, sf).filter(F.col("fault") != 3).select(
        padded("l-", k).alias("load_id"),
        padded("p-", k).alias("provenance_id"),
        F.concat(F.lit("run-"), (k % 7).cast("string")).alias("run_id"),
        "delivery_date",
        "source_object",
        destination_id(
            DATASET, source, F.date_add(day, F.when(F.col("fault") == 13, 7).otherwise(0)), is_transactional(source)
        ).alias("destination"),
        F.date_add(day, F.when(F.col("fault") == 5, 1).otherwise(0)).alias("partition_date"),
        F.col("n_rows").alias("output_rows"),
        padded("j-", k).alias("job_id"),
        "recorded_at",
    )


cte("loads", """
SELECT 'l-' || lpad(CAST(k AS VARCHAR), 10, '0') AS load_id, 'p-' || lpad(CAST(k AS VARCHAR), 10, '0') AS provenance_id,
       'run-' || (k % 7) AS run_id, delivery_date, source_object,
       'db.raw.' || source_object || '$'
         || strftime(delivery_date + CASE WHEN fault = 13 THEN 7 ELSE 0 END, '%Y%m%d') AS destination,
       delivery_date + CASE WHEN fault = 5 THEN 1 ELSE 0 END AS partition_date,
       n_rows AS output_rows, 'j-' || lpad(CAST(k AS VARCHAR), 10, '0') AS job_id, recorded_at
FROM job_facts WHERE fault <> 3
""")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """What the object store holds now."""
    fault, k = F.col("fault"), F.col("k")
    return _job_facts(spark, sf).filter(fault != 6).select(
        "gcs_uri",
        F.when(fault == 7, None).when(fault == 8, "x").otherwise(F.col("sum_text")).alias("checksum"),
        (k % 1000 + 100 + F.when(fault == 9, 1).otherwise(0)).alias("file_size_bytes"),
    )


cte("listing", """
SELECT gcs_uri, CASE WHEN fault = 7 THEN NULL WHEN fault = 8 THEN 'x' ELSE sum_text END AS checksum,
       k % 1000 + 100 + CASE WHEN fault = 9 THEN 1 ELSE 0 END AS file_size_bytes
FROM job_facts WHERE fault <> 6
""")
cte("artifact_seen", """
SELECT a.gcs_uri, l.gcs_uri IS NOT NULL AS present, l.checksum, l.file_size_bytes
FROM (SELECT DISTINCT gcs_uri FROM artifacts) a LEFT JOIN listing l USING (gcs_uri)
""")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return jobs(spark, sf).select("delivery_date", "source_object").distinct()


def partition_state(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Registered partitions and their row counts: the last load of each pair is in the table."""
    last = jobs(spark, sf).groupBy("delivery_date", "source_object", "fault").agg(F.max("k").alias("k"))
    kept = last.filter(F.col("fault") != 12)
    fault = F.col("fault")
    rows = F.when(fault == 2, 0).otherwise(F.col("k") % 1000 + F.when(fault == 14, 1).otherwise(0))
    partitions = kept.select("source_object", F.col("delivery_date").alias("partition_date"))
    counts = kept.select(
        "source_object", F.col("delivery_date").alias("partition_date"), rows.cast("bigint").alias("n")
    )
    return partitions, counts.filter(F.col("n") > 0)


cte("pairs", "SELECT DISTINCT delivery_date, source_object FROM jobs")
cte("partition_rows", """
SELECT source_object, delivery_date AS partition_date, fault,
       CASE WHEN fault = 2 THEN 0 ELSE max(k) % 1000 + CASE WHEN fault = 14 THEN 1 ELSE 0 END END AS n
FROM jobs WHERE fault <> 12 GROUP BY source_object, delivery_date, fault
""")
cte("partition_seen", """
SELECT p.source_object, p.delivery_date AS partition_date,
       'db.raw.' || p.source_object || '$' || strftime(p.delivery_date, '%Y%m%d') AS destination,
       r.n IS NOT NULL AS present, r.n AS row_count
FROM pairs p LEFT JOIN partition_rows r ON r.source_object = p.source_object AND r.partition_date = p.delivery_date
""")
