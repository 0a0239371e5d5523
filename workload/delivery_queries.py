"""Slicing, batch checks, headers and landing names over orders, line items and events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from replaykit.functions.dates import effective_ingestion_date, historical_ingestion_date
from replaykit.functions.headers import header_columns
from replaykit.functions.paths import destination_id, landing_path
from replaykit.functions.text import safe_error, safe_segment
from replaykit.operators import batches, runs, slicing
from replaykit.operators.checks import delivery_rules, load_request_rules, run_rules, violations
from replaykit.sources.deliveries import header_contract as contract_of
from replaykit.sources.registry import SLICE_COLUMNS, SOURCES, is_master, is_transactional, with_registry

from . import bindings as b
from .catalog import query
from .ledger_queries import outcomes
from .sqltext import cte, day_series, sql

# --- source tables in the daily sources' shape --------------------------------


def money(column):
    return F.col(column).cast("decimal(18,2)").cast("string")


def raw_orders(spark, sf):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        stamp.alias("order_purchase_timestamp"),
    )


def raw_items(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        money("l_extendedprice").alias("price"),
    )


def raw_payments(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        money("l_extendedprice").alias("payment_value"),
    )


def raw_reviews(spark, sf):
    """One review per event, of the order with the event's number."""
    return b.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("review_id"),
        F.col("event_id").cast("string").alias("order_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("review_creation_date"),
    )


def raw_tables(spark, sf):
    return {
        "orders": raw_orders(spark, sf),
        "order_items": raw_items(spark, sf),
        "payments": raw_payments(spark, sf),
        "reviews": raw_reviews(spark, sf),
    }


cte("raw_orders", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS order_status,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp, CAST(o_orderdate AS DATE) AS delivery_date
FROM orders
""")
cte("raw_items", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
       CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) AS price
FROM lineitem
""")
cte("raw_payments", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS payment_sequential,
       l_returnflag AS payment_type, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) AS payment_value
FROM lineitem
""")
cte("raw_reviews", """
SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(event_id AS VARCHAR) AS order_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS review_creation_date, CAST(ts AS DATE) AS delivery_date
FROM events
""")


@query("orders_by_day", sql(
    "SELECT order_id, customer_id, order_status, order_purchase_timestamp, delivery_date FROM raw_orders", "raw_orders"))
def orders_by_day(spark, sf):
    return slicing.slice_by_own_date(raw_orders(spark, sf), "order_purchase_timestamp")


@query("order_items_by_parent_day", sql(
    "SELECT i.*, o.delivery_date FROM raw_items i JOIN raw_orders o USING (order_id)", "raw_orders", "raw_items"))
def order_items_by_parent_day(spark, sf):
    return slicing.slice_by_parent(raw_items(spark, sf), orders_by_day(spark, sf))


@query("payments_by_parent_day", sql(
    "SELECT p.*, o.delivery_date FROM raw_payments p JOIN raw_orders o USING (order_id)", "raw_orders", "raw_payments"))
def payments_by_parent_day(spark, sf):
    return slicing.slice_by_parent(raw_payments(spark, sf), orders_by_day(spark, sf))


@query("reviews_by_day", sql(
    "SELECT review_id, order_id, review_creation_date, delivery_date FROM raw_reviews", "raw_reviews"))
def reviews_by_day(spark, sf):
    return slicing.slice_by_own_date(raw_reviews(spark, sf), "review_creation_date")


@query("review_arrival_lag", sql("""
SELECT r.review_id, r.order_id, r.delivery_date, o.delivery_date AS order_date, r.delivery_date - o.delivery_date AS lag_days
FROM (SELECT * REPLACE (CASE WHEN CAST(review_id AS BIGINT) % 9 = 0 THEN 'x' || review_id ELSE order_id END AS order_id)
      FROM raw_reviews) r LEFT JOIN raw_orders o USING (order_id)
""", "raw_orders", "raw_reviews"))
def review_arrival_lag(spark, sf):
    orphan = F.col("review_id").cast("bigint") % 9 == 0
    order_id = F.when(orphan, F.concat(F.lit("x"), "review_id")).otherwise(F.col("order_id"))
    reviews = reviews_by_day(spark, sf).withColumn("order_id", order_id)
    return slicing.review_arrival_lag(reviews, orders_by_day(spark, sf)).select(
        "review_id", "order_id", "delivery_date", "order_date", "lag_days"
    )


def spoiled_dates(spark, sf):
    """Event times as text: canonical, blank, impossible, date only, padded, unpadded."""
    k = F.col("event_id") % 50
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(k == 0, " ")
        .when(k == 1, "2024-13-01")
        .when(k == 2, F.date_format("ts", "yyyy-MM-dd"))
        .when(k == 3, F.concat(F.lit("  "), stamp, F.lit(" \t")))
        .when(k == 4, F.date_format("ts", "yyyy-M-d H:m:s"))
        .when(k == 5, "2024-02-30 10:00:00")
        .when(k == 6, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k == 7, F.concat(stamp, F.lit(".5")))
        .when(k == 8, F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(stamp)
    )
    return b.table(spark, sf, "events").select("event_id", text.alias("stamp"))


cte("spoiled", """
SELECT event_id, CASE event_id % 50 WHEN 0 THEN ' ' WHEN 1 THEN '2024-13-01' WHEN 2 THEN strftime(ts, '%Y-%m-%d')
       WHEN 3 THEN '  ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || chr(9)
       WHEN 4 THEN strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S') WHEN 5 THEN '2024-02-30 10:00:00'
       WHEN 6 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 7 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.5'
       WHEN 8 THEN strftime(ts, '%d/%m/%Y') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp,
       CASE WHEN event_id % 50 NOT IN (0, 1, 5, 6, 7, 8) THEN CAST(ts AS DATE) END AS delivery_date,
       CASE WHEN event_id % 50 = 0 THEN 'missing' WHEN event_id % 50 IN (1, 5, 6, 7, 8) THEN 'malformed' END AS issue
FROM events
""")


@query("business_date", sql("SELECT * FROM spoiled", "spoiled"))
def business_date(spark, sf):
    return slicing.parsed_dates(spoiled_dates(spark, sf), "stamp")


@query("bad_business_dates", sql("SELECT * FROM spoiled WHERE issue IS NOT NULL", "spoiled"))
def bad_business_dates(spark, sf):
    return slicing.bad_business_dates(spoiled_dates(spark, sf), "stamp")


cte("order_days", day_series("raw_orders", "delivery_date", 31))


@query("delivery_counts", sql("""
SELECT d.delivery_date, s.source_object, coalesce(c.n, 0) AS record_count
FROM order_days d CROSS JOIN daily s LEFT JOIN (
  SELECT delivery_date, 'orders' AS source_object, count(*) AS n FROM raw_orders GROUP BY 1
  UNION ALL SELECT delivery_date, 'order_items', count(*) FROM raw_items JOIN raw_orders USING (order_id) GROUP BY 1
  UNION ALL SELECT delivery_date, 'payments', count(*) FROM raw_payments JOIN raw_orders USING (order_id) GROUP BY 1
  UNION ALL SELECT delivery_date, 'reviews', count(*) FROM raw_reviews GROUP BY 1) c USING (delivery_date, source_object)
""", "raw_orders", "raw_items", "raw_payments", "raw_reviews", "order_days", "daily"))
def delivery_counts(spark, sf):
    return slicing.delivery_counts(raw_tables(spark, sf), b.days_of(orders_by_day(spark, sf), 31))


# Cuts days off at both ends of every source.
RANGE = (dt.date(1997, 6, 10), dt.date(2024, 1, 12))


@query("slices_for_range", sql(f"""
SELECT * FROM (
SELECT 'orders' AS source_object, delivery_date, order_id AS row_key FROM raw_orders
UNION ALL SELECT 'order_items', delivery_date, order_id || '/' || order_item_id FROM raw_items JOIN raw_orders USING (order_id)
UNION ALL SELECT 'payments', delivery_date, order_id || '/' || payment_sequential FROM raw_payments JOIN raw_orders USING (order_id)
UNION ALL SELECT 'reviews', delivery_date, review_id FROM raw_reviews
) WHERE delivery_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'
""", "raw_orders", "raw_items", "raw_payments", "raw_reviews"))
def slices_for_range(spark, sf):
    slices = slicing.daily_slices(raw_tables(spark, sf), *RANGE)
    keys = {
        "orders": F.col("order_id"),
        "order_items": F.concat_ws("/", "order_id", "order_item_id"),
        "payments": F.concat_ws("/", "order_id", "payment_sequential"),
        "reviews": F.col("review_id"),
    }
    parts = [
        slices[s].select(F.lit(s).alias("source_object"), "delivery_date", key.alias("row_key"))
        for s, key in keys.items()
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


@query("date_range", sql("""
SELECT k, CAST(unnest(generate_series(delivery_date, delivery_date + CAST(k % 5 AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS delivery_date FROM jobs
""", "jobs"))
def date_range(spark, sf):
    requests = b.jobs(spark, sf).select(
        "k",
        F.col("delivery_date").alias("start_date"),
        F.date_add("delivery_date", (F.col("k") % 5).cast("int")).alias("end_date"),
    )
    return slicing.date_range(requests).select("k", "delivery_date")


@query("ingestion_date_rule", sql("""
SELECT k, delivery_date, delivery_date + 1 AS provider_date,
       CASE WHEN k % 3 = 0 THEN delivery_date ELSE delivery_date + 1 END AS effective_date FROM jobs
""", "jobs"))
def ingestion_date_rule(spark, sf):
    day = F.col("delivery_date")
    supplied = F.when(F.col("k") % 3 != 0, historical_ingestion_date(day))
    return b.jobs(spark, sf).select(
        "k",
        "delivery_date",
        historical_ingestion_date(day).alias("provider_date"),
        effective_ingestion_date(supplied, day).alias("effective_date"),
    )


# --- batches: one delivery per order -------------------------------------------


def deliveries(spark, sf):
    """A delivery per order with planted faults; the 13th of each month was never delivered."""
    k, day = F.col("k"), F.col("delivery_date")
    source = (
        F.when(k % 31 == 0, " ").when(k % 17 == 0, "unplanned").otherwise(F.col("source_object"))
    )
    return b.jobs(spark, sf).filter(F.dayofmonth("delivery_date") != 13).select(
        "k",
        "delivery_date",
        F.when(k % 37 == 0, None).otherwise(F.date_add(day, F.when(k % 23 == 0, 1).otherwise(0))).alias("row_date"),
        source.alias("source_object"),
        F.when(k % 29 == 0, -1).otherwise(k % 1000).alias("record_count"),
    )


cte("deliveries", """
SELECT k, delivery_date, CASE WHEN k % 37 <> 0 THEN delivery_date + CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END END AS row_date,
       CASE WHEN k % 31 = 0 THEN ' ' WHEN k % 17 = 0 THEN 'unplanned' ELSE source_object END AS source_object,
       CASE WHEN k % 29 = 0 THEN -1 ELSE k % 1000 END AS record_count
FROM jobs WHERE extract(day FROM delivery_date) <> 13
""")
cte("job_days", day_series("jobs", "delivery_date", 1))


def job_days(spark, sf):
    return b.days_of(b.jobs(spark, sf), 1)


@query("batch_membership", sql("""
SELECT delivery_date, missing_sources, unexpected_sources, missing_sources = '' AND unexpected_sources = '' AS accepted FROM (
  SELECT d.delivery_date,
         array_to_string(list_filter(['order_items', 'orders', 'payments', 'reviews'],
                                     lambda s: NOT list_contains(coalesce(a.names, []), s)), ',') AS missing_sources,
         array_to_string(list_filter(coalesce(a.names, []),
                                     lambda s: NOT list_contains(['order_items', 'orders', 'payments', 'reviews'], s)), ',') AS unexpected_sources
  FROM job_days d LEFT JOIN (SELECT delivery_date, list_sort(list(DISTINCT source_object)) AS names FROM deliveries GROUP BY 1) a
  USING (delivery_date))
""", "jobs", "deliveries", "job_days"))
def batch_membership(spark, sf):
    return batches.membership(deliveries(spark, sf), job_days(spark, sf))


@query("batch_duplicates", sql("""
SELECT delivery_date, source_object, count(*) AS n_deliveries FROM deliveries GROUP BY 1, 2 HAVING count(*) > 1
""", "jobs", "deliveries"))
def batch_duplicates(spark, sf):
    return batches.duplicates(deliveries(spark, sf))


@query("batch_mixed_dates", sql(
    "SELECT * FROM deliveries WHERE row_date IS DISTINCT FROM delivery_date", "jobs", "deliveries"))
def batch_mixed_dates(spark, sf):
    return batches.mixed_dates(deliveries(spark, sf))


@query("batch_empty", sql(
    "SELECT delivery_date FROM job_days WHERE delivery_date NOT IN (SELECT delivery_date FROM deliveries)",
    "jobs", "deliveries", "job_days"))
def batch_empty(spark, sf):
    return batches.empty_batches(deliveries(spark, sf), job_days(spark, sf))


@query("delivery_row_checks", sql("""
SELECT k, concat_ws(',', CASE WHEN trim(source_object) = '' THEN 'source_object_blank' END,
                    CASE WHEN record_count < 0 THEN 'record_count_negative' END) AS broken_rules
FROM deliveries WHERE trim(source_object) = '' OR record_count < 0
""", "jobs", "deliveries"))
def delivery_row_checks(spark, sf):
    return violations(deliveries(spark, sf), delivery_rules(), ["k"])


@query("resolve_deliveries", sql("""
SELECT delivery_date, source_object, n AS n_deliveries,
       CASE WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'duplicate' ELSE 'ok' END AS resolution
FROM (SELECT d.delivery_date, s.source_object, count(x.k) AS n FROM job_days d CROSS JOIN daily s
      LEFT JOIN deliveries x USING (delivery_date, source_object) GROUP BY 1, 2)
""", "jobs", "deliveries", "job_days", "daily"))
def resolve_deliveries(spark, sf):
    return batches.resolve(slicing.expected_grid(job_days(spark, sf)), deliveries(spark, sf))


@query("partial_deliveries", sql("""
SELECT d.delivery_date, string_agg(s.source_object, ',' ORDER BY s.source_object) AS missing_sources
FROM job_days d CROSS JOIN daily s
WHERE d.delivery_date IN (SELECT delivery_date FROM deliveries)
  AND NOT EXISTS (SELECT 1 FROM deliveries x WHERE x.delivery_date = d.delivery_date AND x.source_object = s.source_object)
GROUP BY 1
""", "jobs", "deliveries", "job_days", "daily"))
def partial_deliveries(spark, sf):
    return batches.partial_deliveries(slicing.expected_grid(job_days(spark, sf)), deliveries(spark, sf))


# --- registry and headers: one delivered file per order -------------------------

NAMES = list(SOURCES)
_CASE = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(NAMES))
cte("files", f"SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS delivery_date, CASE o_orderkey % 8 {_CASE} END AS source_object FROM orders")
cte("registry", "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{system}', '{kind}', {list(columns)}, {list(slice_columns)})"
    for n, (system, kind, columns) in SOURCES.items()
    for slice_columns in [SLICE_COLUMNS.get(n, ())]
) + ") AS t(source_object, source_system, kind, required_columns, slice_columns)")


def files(spark, sf):
    k = F.col("o_orderkey")
    source = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (k % 8 + 1).cast("int"))
    return b.table(spark, sf, "orders").select(
        k.alias("k"), F.col("o_orderdate").cast("date").alias("delivery_date"), source.alias("source_object")
    )


@query("source_registry", sql("""
SELECT f.k, f.source_object, r.source_system, r.kind, len(r.required_columns) AS n_columns, r.kind = 'master' AS is_master,
       r.kind = 'transactional' AS is_transactional
FROM files f JOIN registry r USING (source_object)
""", "files", "registry"))
def source_registry(spark, sf):
    source = F.col("source_object")
    return with_registry(files(spark, sf)).select(
        "k", "source_object", "source_system", "kind", F.size("required_columns").alias("n_columns"),
        is_master(source).alias("is_master"), is_transactional(source).alias("is_transactional"),
    )


def header_files(spark, sf):
    """Header lines as delivered: complete, lacking ids, widened, quoted, with a mark, or empty."""
    k = F.col("k")
    line = F.array_join("required_columns", ",")
    with_lines = with_registry(files(spark, sf)).select("k", "source_object", line.alias("line"))
    plain = F.col("line")
    text = (
        F.when(k % 29 == 0, "")
        .when(k % 23 == 0, F.concat(F.lit('"'), F.replace(plain, F.lit(","), F.lit('","')), F.lit('"')))
        .when(k % 19 == 0, F.concat(F.lit("﻿"), plain))
        .when(k % 17 == 0, F.replace(plain, F.lit("review_"), F.lit("rev_")))
        .when(k % 13 == 0, F.concat(plain, F.lit(",loaded_by\r")))
        .when(k % 11 == 0, F.replace(plain, F.lit("order_id,"), F.lit("")))
        .otherwise(plain)
    )
    return with_lines.select("k", "source_object", header_columns(text).alias("header"))


cte("headers", """
SELECT k, source_object, required_columns, slice_columns,
       CASE WHEN k % 29 = 0 THEN [] WHEN k % 13 = 0 AND k % 23 <> 0 AND k % 19 <> 0 AND k % 17 <> 0
              THEN list_append(required_columns, 'loaded_by')
            WHEN k % 17 = 0 AND k % 23 <> 0 AND k % 19 <> 0
              THEN list_transform(required_columns, lambda c: replace(c, 'review_', 'rev_'))
            WHEN k % 11 = 0 AND k % 23 <> 0 AND k % 19 <> 0 AND k % 13 <> 0
              THEN list_filter(required_columns, lambda c: c <> 'order_id') ELSE required_columns END AS header
FROM files JOIN registry USING (source_object)
""")


def _header_sql(required):
    return sql(f"""
SELECT k, source_object, has_header, missing_columns, has_header AND missing_columns = '' AS header_ok FROM (
  SELECT k, source_object, len(header) > 0 AS has_header,
         array_to_string(list_sort(list_filter({required}, lambda c: NOT list_contains(header, c))), ',') AS missing_columns
  FROM headers)
""", "files", "registry", "headers")


@query("header_contract", _header_sql("required_columns"))
def header_contract(spark, sf):
    return contract_of(header_files(spark, sf)).select(
        "k", "source_object", "has_header", "missing_columns", "header_ok"
    )


@query("slice_header_contract", _header_sql("slice_columns"))
def slice_header_contract(spark, sf):
    return contract_of(header_files(spark, sf), "slice_columns").select(
        "k", "source_object", "has_header", "missing_columns", "header_ok"
    )


# --- landing names, destinations, load requests ---------------------------------


@query("landing_path", sql("""
SELECT k, 'raw/' || source_system || '/' || source_object || '/ingestion_date=' || strftime(delivery_date + 1, '%Y-%m-%d')
       || '/' || source_object || '-' || k || '.csv' AS landing_path
FROM files JOIN registry USING (source_object)
""", "files", "registry"))
def landing_paths(spark, sf):
    name = F.concat("source_object", F.lit("-"), F.col("k").cast("string"), F.lit(".csv"))
    path = landing_path(
        F.col("source_system"), F.col("source_object"), historical_ingestion_date(F.col("delivery_date")), name
    )
    return with_registry(files(spark, sf)).select("k", path.alias("landing_path"))


@query("safe_segment", sql("""
SELECT k, s AS segment, trim(s) <> '' AND s NOT IN ('.', '..') AND NOT contains(s, '/') AND NOT contains(s, chr(92)) AS is_safe
FROM (SELECT k, CASE k % 12 WHEN 0 THEN ' ' WHEN 1 THEN '..' WHEN 2 THEN 'a/b' WHEN 3 THEN 'a' || chr(92) || 'b' WHEN 4 THEN '.'
             WHEN 5 THEN '.a' ELSE source_object END AS s FROM files)
""", "files"))
def safe_segments(spark, sf):
    k = F.col("k") % 12
    segment = (
        F.when(k == 0, " ").when(k == 1, "..").when(k == 2, "a/b").when(k == 3, "a\\b").when(k == 4, ".")
        .when(k == 5, ".a").otherwise(F.col("source_object"))
    )
    return files(spark, sf).select("k", segment.alias("segment")).withColumn(
        "is_safe", safe_segment(F.col("segment"))
    )


@query("destination_id", sql("""
SELECT k, 'db.raw.' || source_object || CASE WHEN kind = 'master' THEN '' ELSE '$' || strftime(delivery_date, '%Y%m%d') END AS destination
FROM files JOIN registry USING (source_object)
""", "files", "registry"))
def destination_ids(spark, sf):
    source = F.col("source_object")
    return files(spark, sf).select(
        "k", destination_id(b.DATASET, source, F.col("delivery_date"), is_transactional(source)).alias("destination")
    )


@query("load_request_checks", sql("""
SELECT k, broken_rules FROM (
  SELECT k, concat_ws(',', CASE WHEN trim(s) = '' THEN 'source_object_blank' END,
    CASE WHEN trim(s) <> '' AND s NOT IN (SELECT source_object FROM registry) THEN 'source_object_unsupported' END,
    CASE WHEN trim(u) = '' THEN 'uri_blank' END, CASE WHEN trim(u) <> '' AND NOT starts_with(u, 'gs://') THEN 'uri_scheme' END,
    CASE WHEN k % 19 = 0 THEN 'partition_date_missing' END) AS broken_rules
  FROM (SELECT k, CASE WHEN k % 31 = 0 THEN '' WHEN k % 17 = 0 THEN 'unplanned' ELSE source_object END AS s,
               CASE WHEN k % 23 = 0 THEN ' ' WHEN k % 29 = 0 THEN '/tmp/x' ELSE 'gs://bucket/x' END AS u FROM files))
WHERE broken_rules <> ''
""", "files", "registry"))
def load_request_checks(spark, sf):
    k = F.col("k")
    requests = files(spark, sf).select(
        "k",
        F.when(k % 31 == 0, "").when(k % 17 == 0, "unplanned").otherwise(F.col("source_object")).alias("source_object"),
        F.when(k % 23 == 0, " ").when(k % 29 == 0, "/tmp/x").otherwise("gs://bucket/x").alias("uri"),
        F.when(k % 19 != 0, F.col("delivery_date")).alias("partition_date"),
    )
    return violations(requests, load_request_rules(), ["k"])


# --- ingestion runs --------------------------------------------------------------

CATEGORIES = ("source_validation_failed", "record_count_failed", "storage_write_failed")


@query("safe_error", sql("""
SELECT k, left('category=' || ['source_validation_failed', 'record_count_failed', 'storage_write_failed'][1 + CAST(k % 3 AS INTEGER)]
       || ' component=loader operation=load message=' || repeat('x', 500), 512) AS error_message FROM jobs
""", "jobs"))
def safe_errors(spark, sf):
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("k") % 3 + 1).cast("int"))
    text = safe_error(category, "loader", "load", "x" * 500)
    return b.jobs(spark, sf).select("k", text.alias("error_message"))


def run_rows(spark, sf):
    """Run rows per order, legal by construction but for planted faults."""
    k = F.col("k")
    state = k % 4
    status = F.when(state == 0, "started").when(state == 1, "failed").when(state == 2, "skipped").otherwise("success")
    ok = state == 3
    return b.jobs(spark, sf).select(
        b.padded("i-", k).alias("ingestion_id"),
        F.lit("order_platform").alias("source_system"),
        F.when(k % 41 == 0, "").otherwise(F.col("source_object")).alias("source_object"),
        F.concat("source_object", F.lit(".csv")).alias("source_file_name"),
        F.col("recorded_at").alias("started_at"),
        F.when((state != 0) != (k % 43 == 0), F.col("recorded_at") + F.expr("interval 90 seconds"))
        .alias("completed_at"),
        F.when(ok, F.when(k % 47 == 0, " ").otherwise("raw/x")).alias("landing_path"),
        F.when(ok, F.when(k % 53 == 0, -1).otherwise(k % 900)).alias("file_size_bytes"),
        F.when(ok & (k % 59 != 0), F.sha2(k.cast("string"), 256)).alias("checksum"),
        F.when(ok, k % 500).alias("record_count"),
        status.alias("status"),
        F.when(state.isin(1, 2) & (k % 61 != 0), "category=x").alias("error_message"),
        F.lit("1.0").alias("schema_version"),
    )


cte("run_rows", """
SELECT 'i-' || lpad(CAST(k AS VARCHAR), 10, '0') AS ingestion_id, 'order_platform' AS source_system,
       CASE WHEN k % 41 = 0 THEN '' ELSE source_object END AS source_object, source_object || '.csv' AS source_file_name,
       recorded_at AS started_at, CASE WHEN (s <> 0) <> (k % 43 = 0) THEN recorded_at + INTERVAL 90 SECOND END AS completed_at,
       CASE WHEN s = 3 THEN CASE WHEN k % 47 = 0 THEN ' ' ELSE 'raw/x' END END AS landing_path,
       CASE WHEN s = 3 THEN CASE WHEN k % 53 = 0 THEN -1 ELSE k % 900 END END AS file_size_bytes,
       CASE WHEN s = 3 AND k % 59 <> 0 THEN sha256(CAST(k AS VARCHAR)) END AS checksum,
       CASE WHEN s = 3 THEN k % 500 END AS record_count, ['started', 'failed', 'skipped', 'success'][1 + CAST(s AS INTEGER)] AS status,
       CASE WHEN s IN (1, 2) AND k % 61 <> 0 THEN 'category=x' END AS error_message, '1.0' AS schema_version
FROM (SELECT *, k % 4 AS s FROM jobs)
""")


@query("run_row_checks", sql("""
SELECT ingestion_id, broken_rules FROM (
  SELECT ingestion_id, concat_ws(',', CASE WHEN source_object = '' THEN 'source_object_blank' END,
    CASE WHEN file_size_bytes < 0 THEN 'file_size_bytes_negative' END,
    CASE WHEN status = 'started' AND completed_at IS NOT NULL THEN 'started_has_completed_at' END,
    CASE WHEN status = 'success' AND completed_at IS NULL THEN 'success_without_completed_at' END,
    CASE WHEN status = 'success' AND checksum IS NULL THEN 'success_without_checksum' END,
    CASE WHEN status = 'success' AND trim(landing_path) = '' THEN 'success_landing_path_blank' END,
    CASE WHEN status IN ('failed', 'skipped') AND completed_at IS NULL THEN 'closed_without_completed_at' END,
    CASE WHEN status IN ('failed', 'skipped') AND error_message IS NULL THEN 'closed_without_error' END) AS broken_rules
  FROM run_rows)
WHERE broken_rules <> ''
""", "jobs", "run_rows"))
def run_row_checks(spark, sf):
    return violations(run_rows(spark, sf), run_rules(), ["ingestion_id"])


@query("batch_status", sql("""
SELECT *, CASE WHEN failed = 0 THEN 'success' WHEN failed = total THEN 'failed' ELSE 'partial_failure' END AS batch_status,
       CASE WHEN failed = 0 THEN 0 WHEN failed = total THEN 2 ELSE 1 END AS exit_code
FROM (SELECT delivery_date, count(*) FILTER (WHERE NOT skipped AND ingest_ok) AS succeeded,
             count(*) FILTER (WHERE NOT skipped AND NOT ingest_ok) AS failed, count(*) FILTER (WHERE skipped) AS skipped,
             count(*) AS total FROM outcomes GROUP BY 1)
""", "jobs", "outcomes"))
def batch_status(spark, sf):
    status = F.when(F.col("skipped"), "skipped").when(F.col("ingest_ok"), "success").otherwise("failed")
    return runs.batch_status(outcomes(spark, sf).select("delivery_date", status.alias("status")), "delivery_date")


def _json(name, text=True):
    value = f"'\"' || {name} || '\"'" if text else f"CAST({name} AS VARCHAR)"
    return f"'\"{name}\":' || coalesce({value}, 'null')"


def _json_stamp(name):
    return f"'\"{name}\":' || coalesce('\"' || strftime({name}, '%Y-%m-%dT%H:%M:%S') || '+00:00\"', 'null')"


_FIELDS = " || ',' || ".join(
    _json_stamp(c) if c.endswith("_at") else _json(c, c not in ("file_size_bytes", "record_count"))
    for c in runs.RUN_COLUMNS
)


@query("run_json", sql(
    f"SELECT ingestion_id, '{{' || {_FIELDS} || '}}' AS json FROM run_rows", "jobs", "run_rows"))
def run_json(spark, sf):
    return runs.run_json(run_rows(spark, sf))

