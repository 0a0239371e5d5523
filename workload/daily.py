"""The eight raw sources in full shape, delivered by period, for files and table writes.

With REPLAYKIT_CADENCE=day every business day is a delivery of its own.  By default the days of a month are delivered together
under its first day, because creating files takes the local file system of these runs tens of milliseconds each (figures in the README); the
library works by day and nothing in it depends on the period.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replaykit.operators.slicing import slice_by_parent
from replaykit.sources.registry import columns_of

from . import bindings as b
from .sqltext import cte


BY_DAY = os.environ.get("REPLAYKIT_CADENCE", "month") == "day"


def period(day: Column) -> Column:
    return day.cast("date") if BY_DAY else F.trunc(day, "month")


def period_sql(day: str) -> str:
    return f"CAST({day} AS DATE)" if BY_DAY else f"CAST(date_trunc('month', {day}) AS DATE)"


def filled(df: DataFrame, source: str, *extra: str) -> DataFrame:
    """All registry columns as texts, those without a counterpart empty."""
    have = set(df.columns)
    columns = [F.col(c).cast("string").alias(c) if c in have else F.lit("").alias(c) for c in columns_of(source)]
    return df.select(*columns, *extra)


# Rows of the daily sources are sliced and placed as numbers and dates, about half the bytes of their texts, which are made last.
Place = Callable[[DataFrame], DataFrame]


def unplaced(rows: DataFrame) -> DataFrame:
    return rows


def by_day(rows: DataFrame) -> DataFrame:
    """Rows in the tasks and order of a write by day, so that the writer need not sort their texts."""
    return rows.hint("rebalance", "delivery_date").sortWithinPartitions("delivery_date")


def cents(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), period(F.col("o_orderdate")).alias("delivery_date")
    )


def delivered_orders(spark: SparkSession, sf: str, place: Place = unplaced) -> DataFrame:
    orders = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        period(F.col("o_orderdate")).alias("delivery_date"),
    )
    stamp = F.col("order_purchase_timestamp")
    texts = {
        "order_purchase_timestamp": F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"),
        "order_estimated_delivery_date": F.date_format(F.date_add(stamp, 30), "yyyy-MM-dd"),
    }
    return filled(place(orders).withColumns(texts), "orders", "delivery_date")


def delivered_items(spark: SparkSession, sf: str, place: Place = unplaced) -> DataFrame:
    items = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        cents("l_extendedprice").alias("price"),
    )
    return filled(place(slice_by_parent(items, order_days(spark, sf))), "order_items", "delivery_date")


def delivered_payments(spark: SparkSession, sf: str, place: Place = unplaced) -> DataFrame:
    payments = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_type"),
        cents("o_totalprice").alias("payment_value"),
    )
    once = {"payment_sequential": F.lit("1"), "payment_installments": F.lit("1")}
    placed = place(slice_by_parent(payments, order_days(spark, sf)))
    return filled(placed.withColumns(once), "payments", "delivery_date")


def delivered_reviews(spark: SparkSession, sf: str, place: Place = unplaced) -> DataFrame:
    """A review per order up to 39 days later, its comment over two lines for every ninth."""
    k = F.col("order_id")
    created = F.date_add("o_orderdate", (F.col("o_orderkey") % 40).cast("int"))
    reviews = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), created.alias("created"), period(created).alias("delivery_date")
    )
    texts = {
        "review_id": F.concat(F.lit("r"), k.cast("string")),
        "review_score": k % 5 + 1,
        "review_comment_message": F.when(k % 9 == 0, 'fine, "really"\nfine').otherwise(""),
        "review_creation_date": F.date_format("created", "yyyy-MM-dd"),
    }
    return filled(place(reviews).withColumns(texts), "reviews", "delivery_date")


def daily_rows(spark: SparkSession, sf: str, place: Place = unplaced) -> dict[str, DataFrame]:
    return {
        "orders": delivered_orders(spark, sf, place),
        "order_items": delivered_items(spark, sf, place),
        "payments": delivered_payments(spark, sf, place),
        "reviews": delivered_reviews(spark, sf, place),
    }


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    customers = b.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.concat("c_mktsegment", F.lit(', "'), "c_name", F.lit('"')).alias("customer_city"),
        F.col("c_nationkey").cast("string").alias("customer_state"),
    )
    return filled(customers, "customers")


def raw_products(spark: SparkSession, sf: str) -> DataFrame:
    products = b.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        F.col("p_size").cast("string").alias("product_weight_g"),
    )
    return filled(products, "products")


def raw_sellers(spark: SparkSession, sf: str) -> DataFrame:
    sellers = b.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("s_nationkey").cast("string").alias("seller_state"),
    )
    return filled(sellers, "sellers")


def raw_geolocations(spark: SparkSession, sf: str) -> DataFrame:
    """One observation per customer: many per prefix, as in the source."""
    places = b.table(spark, sf, "customer").join(
        b.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        (F.col("c_custkey") % 180 - 90).cast("string").alias("geolocation_lat"),
        (F.col("c_custkey") % 360 - 180).cast("string").alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.col("n_regionkey").cast("string").alias("geolocation_state"),
    )
    return filled(places, "geolocations")


def master_rows(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf),
        "products": raw_products(spark, sf),
        "sellers": raw_sellers(spark, sf),
        "geolocations": raw_geolocations(spark, sf),
    }


cte("delivered_orders", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS order_status,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp, '' AS order_approved_at,
       '' AS order_delivered_carrier_date, '' AS order_delivered_customer_date,
       strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS order_estimated_delivery_date,
       {period_sql('o_orderdate')} AS delivery_date, o_orderkey AS k
FROM orders
""")
cte("delivered_items", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id, '' AS shipping_limit_date,
       CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) AS price, '' AS freight_value,
       {period_sql('o_orderdate')} AS delivery_date
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
cte("delivered_payments", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '1' AS payment_sequential, o_orderpriority AS payment_type,
       '1' AS payment_installments, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS payment_value,
       {period_sql('o_orderdate')} AS delivery_date
FROM orders
""")
cte("delivered_reviews", f"""
SELECT 'r' || o_orderkey AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderkey % 5 + 1 AS VARCHAR) AS review_score,
       '' AS review_comment_title, CASE WHEN o_orderkey % 9 = 0 THEN 'fine, "really"' || chr(10) || 'fine' ELSE '' END AS review_comment_message,
       strftime(created, '%Y-%m-%d') AS review_creation_date, '' AS review_answer_timestamp,
       {period_sql('created')} AS delivery_date
FROM (SELECT *, o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) AS created FROM orders)
""")
cte("raw_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       c_mktsegment || ', "' || c_name || '"' AS customer_city, CAST(c_nationkey AS VARCHAR) AS customer_state
FROM customer
""")
cte("raw_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
       CAST(length(p_name) AS VARCHAR) AS product_name_lenght, '' AS product_description_lenght, '' AS product_photos_qty,
       CAST(p_size AS VARCHAR) AS product_weight_g, '' AS product_length_cm, '' AS product_height_cm, '' AS product_width_cm
FROM part
""")
cte("raw_sellers", """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       s_name AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state
FROM supplier
""")
cte("raw_geolocations", """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
       CAST(c_custkey % 180 - 90 AS VARCHAR) AS geolocation_lat, CAST(c_custkey % 360 - 180 AS VARCHAR) AS geolocation_lng,
       n_name AS geolocation_city, CAST(n_regionkey AS VARCHAR) AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
RAW_SQL = {
    "orders": "delivered_orders",
    "order_items": "delivered_items",
    "payments": "delivered_payments",
    "reviews": "delivered_reviews",
    "customers": "raw_customers",
    "products": "raw_products",
    "sellers": "raw_sellers",
    "geolocations": "raw_geolocations",
}


WIDEST = max(len(columns_of(s)) for s in RAW_SQL)


def stacked(parts: dict[str, DataFrame], *extra: str) -> DataFrame:
    """All columns of several sources under one set of names."""
    united = None
    for source, rows in parts.items():
        names = columns_of(source)
        cells = [F.col(names[i]) if i < len(names) else F.lit("") for i in range(WIDEST)]
        part = rows.select(F.lit(source).alias("source_object"), *[c.alias(f"c{i + 1}") for i, c in enumerate(cells)], *extra)
        united = part if united is None else united.unionByName(part)
    return united


def stacked_sql(tables: dict[str, str], *extra: str) -> str:
    """The same in SQL, over the named tables."""
    parts = []
    for source, name in tables.items():
        names = columns_of(source)
        cells = [f"{names[i] if i < len(names) else chr(39) * 2} AS c{i + 1}" for i in range(WIDEST)]
        parts.append(f"SELECT '{source}' AS source_object, {', '.join([*cells, *extra])} FROM {name}")
    return " UNION ALL ".join(parts)
