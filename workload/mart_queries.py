"""Staging, dimensions, facts, quality tests and measures over raw text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from replaykit.plans.marts import measures, model, quality, staging

from . import bindings as b
from .catalog import query
from .delivery_queries import money, raw_items
from .daily import filled, raw_customers, raw_geolocations, raw_products, raw_sellers
from .sqltext import cte, sql

STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}


def raw_mart_orders(spark, sf):
    """Orders as text; their line items ship between first and last ship date."""
    shipped = b.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    k = F.col("o_orderkey")
    status = F.lit("unknown")
    for code, name in STATUS.items():
        status = F.when(F.col("o_orderstatus") == code, name).otherwise(status)
    stamp = "yyyy-MM-dd HH:mm:ss"
    delivered = (
        F.when(k % 17 == 0, " ").when(k % 19 == 0, "n/a").otherwise(F.coalesce(F.date_format("last_ship", stamp), F.lit("")))
    )
    orders = b.table(spark, sf, "orders").join(shipped, k == F.col("l_orderkey"), "left").select(
        k.cast("string").alias("order_id"),
        F.when(k % 23 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        status.alias("order_status"),
        F.date_format("o_orderdate", stamp).alias("order_purchase_timestamp"),
        F.when(k % 41 == 0, "12:30:00").otherwise(F.coalesce(F.date_format("first_ship", stamp), F.lit(""))).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        F.date_format(F.date_add("o_orderdate", 60), "yyyy-MM-dd").alias("order_estimated_delivery_date"),
    )
    # some orders were delivered twice
    return filled(orders.unionByName(orders.filter("CAST(order_id AS BIGINT) % 37 = 0")), "orders")


def raw_mart_payments(spark, sf):
    payments = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.lit("1").alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.col("o_orderkey") % 12).cast("string").alias("payment_installments"),
        money("o_totalprice").alias("payment_value"),
    )
    return filled(payments, "payments")


def raw_mart_reviews(spark, sf):
    k = F.col("o_orderkey")
    reviews = b.table(spark, sf, "orders").select(
        F.concat(F.lit("r"), k.cast("string")).alias("review_id"),
        F.when(k % 29 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("order_id"),
        F.when(k % 31 == 0, "bad").otherwise((k % 5 + 1).cast("string")).alias("review_score"),
        F.date_format(F.date_add("o_orderdate", (k % 40).cast("int")), "yyyy-MM-dd").alias("review_creation_date"),
    )
    return filled(reviews, "reviews")


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "sellers": raw_sellers,
    "geolocation": raw_geolocations,
    "orders": raw_mart_orders,
    "order_items": lambda spark, sf: filled(raw_items(spark, sf), "order_items"),
    "payments": raw_mart_payments,
    "reviews": raw_mart_reviews,
}


def stg(spark, sf, name):
    return getattr(staging, f"stg_{name}")(RAW[name](spark, sf))


cte("stg_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       c_mktsegment || ', "' || c_name || '"' AS customer_city, CAST(c_nationkey AS VARCHAR) AS customer_state
FROM customer
""")
cte("stg_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name, length(p_name) AS product_name_length,
       CAST(NULL AS INTEGER) AS product_description_length, CAST(NULL AS INTEGER) AS product_photos_qty, p_size AS product_weight_g,
       CAST(NULL AS INTEGER) AS product_length_cm, CAST(NULL AS INTEGER) AS product_height_cm, CAST(NULL AS INTEGER) AS product_width_cm
FROM part
""")
cte("stg_sellers", """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       s_name AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state
FROM supplier
""")
cte("stg_geolocation", """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
       CAST(c_custkey % 180 - 90 AS DECIMAL(9, 6)) AS geolocation_lat, CAST(c_custkey % 360 - 180 AS DECIMAL(9, 6)) AS geolocation_lng,
       n_name AS geolocation_city, CAST(n_regionkey AS VARCHAR) AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
cte("stg_orders", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' ELSE 'unknown' END AS order_status,
       o_orderdate AS order_purchase_timestamp, CAST(NULL AS TIMESTAMP) AS order_approved_at, CASE WHEN o_orderkey % 41 <> 0 THEN first_ship END AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 THEN last_ship END AS order_delivered_customer_date,
       CAST(o_orderdate AS DATE) + 60 AS order_estimated_delivery_date
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1)
  ON l_orderkey = o_orderkey
JOIN (VALUES (0), (1)) AS copies(n) ON n = 0 OR o_orderkey % 37 = 0
""")
cte("stg_order_items", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS seller_id, CAST(NULL AS TIMESTAMP) AS shipping_limit_date,
       CAST(l_extendedprice AS DECIMAL(18, 2)) AS price, CAST(NULL AS DECIMAL(18, 2)) AS freight_value
FROM lineitem
""")
cte("stg_payments", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
       o_orderkey % 12 AS payment_installments, CAST(o_totalprice AS DECIMAL(18, 2)) AS payment_value
FROM orders
""")
cte("stg_reviews", """
SELECT 'r' || o_orderkey AS review_id, CASE WHEN o_orderkey % 29 = 0 THEN 'x' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
       CASE WHEN o_orderkey % 31 <> 0 THEN o_orderkey % 5 + 1 END AS review_score, CAST(NULL AS VARCHAR) AS review_comment_title,
       CAST(NULL AS VARCHAR) AS review_comment_message, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS review_creation_date,
       CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
FROM orders
""")


def _register_staging():
    for name in ("customers", "orders", "order_items", "products", "sellers", "payments", "reviews", "geolocation"):
        query(f"stg_{name}", sql(f"SELECT * FROM stg_{name}", f"stg_{name}"))(
            lambda spark, sf, name=name: stg(spark, sf, name)
        )


_register_staging()

# --- dimensions and facts ----------------------------------------------------------

cte("dim_location", """
SELECT zip_code_prefix, city, state, latitude, longitude, n_observations FROM (
  SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_city AS city, geolocation_state AS state,
         CAST(sum(lat) OVER w AS DOUBLE) / sum(n) OVER w AS latitude, CAST(sum(lng) OVER w AS DOUBLE) / sum(n) OVER w AS longitude,
         CAST(sum(n) OVER w AS BIGINT) AS n_observations,
         row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY n DESC, geolocation_city, geolocation_state) AS rn
  FROM (SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state, count(*) AS n, sum(geolocation_lat) AS lat, sum(geolocation_lng) AS lng
        FROM stg_geolocation GROUP BY 1, 2, 3)
  WINDOW w AS (PARTITION BY geolocation_zip_code_prefix))
WHERE rn = 1
""")
cte("fct_orders", """
SELECT o.order_id, o.customer_id, o.order_status, CAST(o.order_purchase_timestamp AS DATE) AS purchase_date,
       CAST(o.order_delivered_customer_date AS DATE) AS delivered_date, o.order_estimated_delivery_date AS estimated_date,
       coalesce(i.n_items, 0) AS n_items, coalesce(i.items_value, 0) AS items_value, coalesce(p.payment_value, 0) AS payment_value,
       CAST(o.order_delivered_customer_date AS DATE) - CAST(o.order_purchase_timestamp AS DATE) AS delivery_days,
       CAST(o.order_delivered_customer_date AS DATE) > o.order_estimated_delivery_date AS is_late
FROM (SELECT DISTINCT * FROM stg_orders) o
LEFT JOIN (SELECT order_id, count(*) AS n_items, sum(price) AS items_value FROM stg_order_items GROUP BY 1) i USING (order_id)
LEFT JOIN (SELECT order_id, sum(payment_value) AS payment_value FROM stg_payments GROUP BY 1) p USING (order_id)
""")
cte("fct_order_items", """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id, CAST(o.order_purchase_timestamp AS DATE) AS purchase_date,
       o.order_status, p.product_category_name, i.price
FROM stg_order_items i LEFT JOIN (SELECT DISTINCT * FROM stg_orders) o USING (order_id) LEFT JOIN stg_products p USING (product_id)
""")
cte("fct_reviews", """
SELECT r.review_id, r.order_id, o.customer_id, r.review_score, r.review_creation_date, CAST(o.order_purchase_timestamp AS DATE) AS purchase_date,
       r.review_creation_date - CAST(o.order_purchase_timestamp AS DATE) AS review_lag_days
FROM stg_reviews r LEFT JOIN (SELECT DISTINCT * FROM stg_orders) o USING (order_id)
""")
LOCATED = ("stg_geolocation", "dim_location")
FCT_ORDERS = ("stg_orders", "stg_order_items", "stg_payments", "fct_orders")
FCT_ITEMS = ("stg_orders", "stg_order_items", "stg_products", "fct_order_items")


def location(spark, sf):
    return model.dim_location(stg(spark, sf, "geolocation"))


@query("dim_location", sql("SELECT * FROM dim_location", *LOCATED))
def dim_location(spark, sf):
    return location(spark, sf)


@query("dim_customer", sql("""
SELECT c.*, l.latitude, l.longitude FROM stg_customers c LEFT JOIN dim_location l ON l.zip_code_prefix = c.customer_zip_code_prefix
""", "stg_customers", *LOCATED))
def dim_customer(spark, sf):
    customers = stg(spark, sf, "customers")
    return model.dim_customer(customers.unionByName(customers), location(spark, sf))


@query("dim_seller", sql("""
SELECT s.*, l.latitude, l.longitude FROM stg_sellers s LEFT JOIN dim_location l ON l.zip_code_prefix = s.seller_zip_code_prefix
""", "stg_sellers", *LOCATED))
def dim_seller(spark, sf):
    return model.dim_seller(stg(spark, sf, "sellers"), location(spark, sf))


@query("dim_product", sql("SELECT * FROM stg_products", "stg_products"))
def dim_product(spark, sf):
    return model.dim_product(stg(spark, sf, "products"))


@query("dim_date", sql("""
SELECT d AS date_day, extract(year FROM d) AS year, extract(quarter FROM d) AS quarter, extract(month FROM d) AS month,
       extract(day FROM d) AS day_of_month, extract(isodow FROM d) AS iso_weekday, extract(isodow FROM d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM (
  SELECT min(x) AS a, max(x) AS z FROM (SELECT CAST(order_purchase_timestamp AS DATE) AS x FROM stg_orders
                                        UNION ALL SELECT review_creation_date FROM stg_reviews)))
""", "stg_orders", "stg_reviews"))
def dim_date(spark, sf):
    return model.dim_date(stg(spark, sf, "orders"), stg(spark, sf, "reviews"))


def orders_fact(spark, sf):
    return model.fct_orders(stg(spark, sf, "orders"), stg(spark, sf, "order_items"), stg(spark, sf, "payments"))


def items_fact(spark, sf):
    return model.fct_order_items(stg(spark, sf, "order_items"), stg(spark, sf, "orders"), stg(spark, sf, "products"))


def reviews_fact(spark, sf):
    return model.fct_reviews(stg(spark, sf, "reviews"), stg(spark, sf, "orders"))


@query("fct_orders", sql("SELECT * FROM fct_orders", *FCT_ORDERS))
def fct_orders(spark, sf):
    return orders_fact(spark, sf)


@query("fct_order_items", sql("SELECT * FROM fct_order_items", *FCT_ITEMS))
def fct_order_items(spark, sf):
    return items_fact(spark, sf)


cte("fct_payments", """
SELECT p.*, o.customer_id, CAST(o.order_purchase_timestamp AS DATE) AS purchase_date
FROM stg_payments p LEFT JOIN (SELECT DISTINCT * FROM stg_orders) o USING (order_id)
""")


@query("fct_payments", sql("SELECT * FROM fct_payments", "stg_orders", "stg_payments", "fct_payments"))
def fct_payments(spark, sf):
    return model.fct_payments(stg(spark, sf, "payments"), stg(spark, sf, "orders"))


@query("fct_reviews", sql("SELECT * FROM fct_reviews", "stg_orders", "stg_reviews", "fct_reviews"))
def fct_reviews(spark, sf):
    return reviews_fact(spark, sf)


# --- quality -------------------------------------------------------------------------


@query("quality_primary_key", sql("""
SELECT customer_id, count(*) AS n_rows, customer_id IS NULL AS has_null FROM stg_orders GROUP BY 1 HAVING count(*) > 1 OR customer_id IS NULL
""", "stg_orders"))
def quality_primary_key(spark, sf):
    """Customer ids taken for the key of orders: broken by every repeat customer and by blanks."""
    return quality.key_violations(stg(spark, sf, "orders"), "customer_id")


@query("quality_composite_key", sql("""
SELECT order_id, order_item_id, count(*) AS n_rows, FALSE AS has_null FROM stg_order_items GROUP BY 1, 2 HAVING count(*) > 1
""", "stg_order_items"))
def quality_composite_key(spark, sf):
    return quality.key_violations(stg(spark, sf, "order_items"), "order_id", "order_item_id")


@query("quality_not_null", sql("""
SELECT * FROM (
  SELECT 'customer_id' AS column_name, count(*) FILTER (WHERE customer_id IS NULL) AS n_nulls FROM stg_orders
  UNION ALL SELECT 'order_approved_at', count(*) FILTER (WHERE order_approved_at IS NULL) FROM stg_orders
  UNION ALL SELECT 'order_delivered_customer_date', count(*) FILTER (WHERE order_delivered_customer_date IS NULL) FROM stg_orders)
WHERE n_nulls > 0
""", "stg_orders"))
def quality_not_null(spark, sf):
    orders = stg(spark, sf, "orders")
    return quality.not_null(
        orders, ["order_id", "customer_id", "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date"]
    )


@query("quality_referential", sql("""
SELECT order_id, count(*) AS n_rows FROM stg_reviews r WHERE NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = r.order_id) GROUP BY 1
""", "stg_orders", "stg_reviews"))
def quality_referential(spark, sf):
    return quality.orphans(stg(spark, sf, "reviews"), stg(spark, sf, "orders"), "order_id")


@query("quality_business_rules", sql("""
SELECT order_id, broken_rules FROM (
  SELECT order_id, concat_ws(',', CASE WHEN delivered_date < purchase_date THEN 'delivered_before_purchase' END,
    CASE WHEN n_items = 0 THEN 'no_items' END, CASE WHEN payment_value <= 0 THEN 'payment_not_positive' END,
    CASE WHEN order_status = 'canceled' AND delivered_date IS NOT NULL THEN 'delivered_but_cancelled' END) AS broken_rules
  FROM fct_orders)
WHERE broken_rules <> ''
""", *FCT_ORDERS))
def quality_business_rules(spark, sf):
    return quality.business_rule_violations(orders_fact(spark, sf))


# --- measures ------------------------------------------------------------------------

_REVENUE = "sum(items_value) AS {}, count(*) AS n_orders, CAST(sum(items_value) AS DOUBLE) / count(*) AS average_order_value"


@query("sales_total", sql(
    f"SELECT {_REVENUE.format('total_revenue')} FROM fct_orders WHERE order_status <> 'canceled'", *FCT_ORDERS))
def sales_total(spark, sf):
    return measures.sales_total(orders_fact(spark, sf))


@query("daily_revenue", sql(
    f"SELECT purchase_date, {_REVENUE.format('revenue')} FROM fct_orders WHERE order_status <> 'canceled' GROUP BY 1", *FCT_ORDERS))
def daily_revenue(spark, sf):
    return measures.daily_revenue(orders_fact(spark, sf))


@query("revenue_trend", sql("""
SELECT *, revenue - previous_revenue AS change FROM (
  SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS previous_revenue FROM (
    SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS month, sum(items_value) AS revenue
    FROM fct_orders WHERE order_status <> 'canceled' GROUP BY 1))
""", *FCT_ORDERS))
def revenue_trend(spark, sf):
    return measures.revenue_trend(orders_fact(spark, sf))


@query("category_revenue", sql("""
SELECT product_category_name, sum(price) AS revenue, count(*) AS n_items FROM fct_order_items
WHERE order_status IS DISTINCT FROM 'canceled' GROUP BY 1
""", *FCT_ITEMS))
def category_revenue(spark, sf):
    return measures.category_revenue(items_fact(spark, sf))


@query("top_products", sql("""
SELECT product_id, sum(price) AS revenue, count(*) AS n_items FROM fct_order_items
WHERE order_status IS DISTINCT FROM 'canceled' GROUP BY 1 ORDER BY revenue DESC, product_id LIMIT 20
""", *FCT_ITEMS))
def top_products(spark, sf):
    return measures.top_products(items_fact(spark, sf))


cte("order_scores", """
SELECT order_id, sum(review_score) AS score, count(review_score) AS n_scores FROM fct_reviews GROUP BY 1
""")
REVIEWED = ("stg_reviews", "fct_reviews", "order_scores")


@query("product_ratings", sql("""
SELECT product_id, CAST(sum(score) AS DOUBLE) / nullif(sum(n_scores), 0) AS average_score, CAST(sum(n_scores) AS BIGINT) AS n_reviews
FROM (SELECT DISTINCT product_id, order_id FROM fct_order_items) JOIN order_scores USING (order_id) GROUP BY 1
""", *FCT_ITEMS, *REVIEWED))
def product_ratings(spark, sf):
    return measures.product_ratings(items_fact(spark, sf), stg(spark, sf, "reviews"))


cte("customer_360", """
SELECT c.customer_id, n_orders, total_spend, first_purchase, last_purchase,
       CASE WHEN n_orders > 1 THEN (last_purchase - first_purchase) / CAST(n_orders - 1 AS DOUBLE) END AS days_between_orders,
       as_of - last_purchase AS recency_days,
       CASE WHEN as_of - last_purchase > 365 THEN 'lapsed' WHEN n_orders >= 5 THEN 'loyal' WHEN n_orders > 1 THEN 'repeat' ELSE 'new' END AS segment,
       coalesce(n_reviews, 0) AS n_reviews, average_score
FROM (SELECT customer_id, count(*) AS n_orders, sum(items_value) AS total_spend, min(purchase_date) AS first_purchase,
             max(purchase_date) AS last_purchase FROM fct_orders WHERE customer_id IS NOT NULL GROUP BY 1) c
LEFT JOIN (SELECT customer_id, count(*) AS n_reviews, CAST(sum(review_score) AS DOUBLE) / nullif(count(review_score), 0) AS average_score
           FROM fct_reviews WHERE customer_id IS NOT NULL GROUP BY 1) r USING (customer_id),
     (SELECT max(purchase_date) AS as_of FROM fct_orders)
""")
CUSTOMERS = (*FCT_ORDERS, "stg_reviews", "fct_reviews", "customer_360")


def customers_view(spark, sf):
    last = b.table(spark, sf, "orders").agg(F.max("o_orderdate")).first()[0]
    return measures.customer_360(orders_fact(spark, sf), reviews_fact(spark, sf), last.date())


@query("customer_360", sql("SELECT * FROM customer_360", *CUSTOMERS))
def customer_360(spark, sf):
    return customers_view(spark, sf)


@query("customer_value", sql("""
SELECT segment, count(*) AS n_customers, count(*) FILTER (WHERE n_orders > 1) AS n_repeat,
       CAST(count(*) FILTER (WHERE n_orders > 1) AS DOUBLE) / count(*) AS repeat_rate, sum(total_spend) AS total_value,
       CAST(sum(total_spend) AS DOUBLE) / count(*) AS lifetime_value
FROM customer_360 GROUP BY 1
""", *CUSTOMERS))
def customer_value(spark, sf):
    return measures.customer_value(customers_view(spark, sf))


@query("active_customers", sql("""
SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS month, count(DISTINCT customer_id) AS n_customers
FROM fct_orders WHERE customer_id IS NOT NULL GROUP BY 1
""", *FCT_ORDERS))
def active_customers(spark, sf):
    return measures.active_customers(orders_fact(spark, sf))


_DELIVERY = """count(*) AS n_orders, count(delivery_days) AS n_delivered,
       CAST(sum(delivery_days) AS DOUBLE) / nullif(count(delivery_days), 0) AS average_days, count(*) FILTER (WHERE is_late) AS n_late,
       CAST(count(*) FILTER (WHERE is_late) AS DOUBLE) / nullif(count(is_late), 0) AS late_rate,
       CAST(count(delivery_days) AS DOUBLE) / count(*) AS fulfilment_rate"""
cte("seller_orders", "SELECT seller_id, order_id, sum(price) AS value FROM stg_order_items GROUP BY 1, 2")


@query("delivery_by_seller", sql(
    f"SELECT seller_id, {_DELIVERY} FROM seller_orders JOIN fct_orders USING (order_id) GROUP BY 1", *FCT_ORDERS, "seller_orders"))
def delivery_by_seller(spark, sf):
    return measures.delivery_by_seller(orders_fact(spark, sf), stg(spark, sf, "order_items"))


@query("delivery_by_state", sql(
    f"SELECT customer_state, {_DELIVERY} FROM fct_orders LEFT JOIN stg_customers USING (customer_id) GROUP BY 1",
    *FCT_ORDERS, "stg_customers"))
def delivery_by_state(spark, sf):
    return measures.delivery_by_state(orders_fact(spark, sf), stg(spark, sf, "customers"))


@query("seller_performance", sql("""
SELECT seller_id, sum(value) AS revenue, count(*) AS n_orders, CAST(sum(score) AS DOUBLE) / nullif(sum(n_scores), 0) AS average_score,
       CAST(count(*) FILTER (WHERE is_late) AS DOUBLE) / nullif(count(is_late), 0) AS delay_rate,
       CAST(count(*) FILTER (WHERE order_status = 'canceled') AS DOUBLE) / count(*) AS cancellation_rate
FROM seller_orders JOIN fct_orders USING (order_id) LEFT JOIN order_scores USING (order_id) GROUP BY 1
""", *FCT_ORDERS, "seller_orders", *REVIEWED))
def seller_performance(spark, sf):
    return measures.seller_performance(orders_fact(spark, sf), stg(spark, sf, "order_items"), stg(spark, sf, "reviews"))


@query("payment_types", sql("""
SELECT payment_type, count(*) AS n_payments, sum(payment_value) AS total_value, CAST(sum(payment_value) AS DOUBLE) / count(*) AS average_value,
       CAST(sum(payment_installments) AS DOUBLE) / count(payment_installments) AS average_installments
FROM stg_payments GROUP BY 1
""", "stg_payments"))
def payment_types(spark, sf):
    return measures.payment_types(stg(spark, sf, "payments"))


@query("payment_mismatch", sql("""
SELECT order_id, items_value, payment_value, payment_value - items_value AS difference FROM fct_orders WHERE payment_value <> items_value
""", *FCT_ORDERS))
def payment_mismatch(spark, sf):
    return measures.payment_mismatch(orders_fact(spark, sf))
