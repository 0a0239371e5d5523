"""Sales, customer, delivery, seller and payment measures over the facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .model import mean

CANCELLED = "canceled"
LAPSED_DAYS = 365
LOYAL_ORDERS = 5


def _sold(orders: DataFrame) -> DataFrame:
    return orders.filter(~F.col("order_status").eqNullSafe(CANCELLED))


def sales_total(orders: DataFrame) -> DataFrame:
    revenue, n = F.sum("items_value"), F.count(F.lit(1))
    return _sold(orders).agg(
        revenue.alias("total_revenue"), n.alias("n_orders"), mean(revenue, n).alias("average_order_value")
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    revenue, n = F.sum("items_value"), F.count(F.lit(1))
    return _sold(orders).groupBy("purchase_date").agg(
        revenue.alias("revenue"), n.alias("n_orders"), mean(revenue, n).alias("average_order_value")
    )


def revenue_trend(orders: DataFrame) -> DataFrame:
    """Monthly revenue and its change; the window runs over one row per month."""
    monthly = _sold(orders).groupBy(F.trunc("purchase_date", "month").alias("month")).agg(
        F.sum("items_value").alias("revenue")
    )
    by_month = Window.orderBy("month")
    previous = F.lag("revenue").over(by_month)
    return monthly.withColumns({"previous_revenue": previous, "change": F.col("revenue") - previous})


def category_revenue(items: DataFrame) -> DataFrame:
    return _sold(items).groupBy("product_category_name").agg(
        F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("n_items")
    )


def top_products(items: DataFrame, k: int = 20) -> DataFrame:
    """The k products with the highest revenue, ties by product id."""
    per_product = _sold(items).groupBy("product_id").agg(
        F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("n_items")
    )
    return per_product.orderBy(F.desc("revenue"), "product_id").limit(k)


def product_ratings(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean score of the orders a product was in; each order counts once per product."""
    scores = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score"), F.count("review_score").alias("n_scores")
    )
    bought = items.select("product_id", "order_id").distinct()
    rated = bought.join(scores, "order_id")
    return rated.groupBy("product_id").agg(
        mean(F.sum("score"), F.sum("n_scores")).alias("average_score"), F.sum("n_scores").alias("n_reviews")
    )


def customer_360(orders: DataFrame, reviews: DataFrame, as_of: dt.date) -> DataFrame:
    """History, spend, frequency, recency, segment and review behaviour of each customer."""
    bought = orders.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("items_value").alias("total_spend"),
        F.min("purchase_date").alias("first_purchase"),
        F.max("purchase_date").alias("last_purchase"),
    )
    reviewed = reviews.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        mean(F.sum("review_score"), F.count("review_score")).alias("average_score"),
    )
    n = F.col("n_orders")
    span = F.datediff("last_purchase", "first_purchase")
    recency = F.datediff(F.lit(as_of), F.col("last_purchase"))
    segment = (
        F.when(recency > LAPSED_DAYS, "lapsed")
        .when(n >= LOYAL_ORDERS, "loyal")
        .when(n > 1, "repeat")
        .otherwise("new")
    )
    return bought.join(reviewed, "customer_id", "left").select(
        "customer_id",
        "n_orders",
        "total_spend",
        "first_purchase",
        "last_purchase",
        F.when(n > 1, span / (n - 1)).alias("days_between_orders"),
        recency.alias("recency_days"),
        segment.alias("segment"),
        F.coalesce("n_reviews", F.lit(0).cast("bigint")).alias("n_reviews"),
        "average_score",
    )


def customer_value(customers: DataFrame) -> DataFrame:
    """Lifetime value and repeat rate over the customer view, per segment."""
    n = F.count(F.lit(1))
    repeat = F.count_if(F.col("n_orders") > 1)
    return customers.groupBy("segment").agg(
        n.alias("n_customers"),
        repeat.alias("n_repeat"),
        mean(repeat, n).alias("repeat_rate"),
        F.sum("total_spend").alias("total_value"),
        mean(F.sum("total_spend"), n).alias("lifetime_value"),
    )


def active_customers(orders: DataFrame) -> DataFrame:
    """Customers with a purchase, per month; distinct pairs combine before counting."""
    month = F.trunc("purchase_date", "month").alias("month")
    pairs = orders.filter(F.col("customer_id").isNotNull()).select(month, "customer_id").distinct()
    return pairs.groupBy("month").agg(F.count(F.lit(1)).alias("n_customers"))


def _delivery_columns() -> list:
    days, late = F.col("delivery_days"), F.col("is_late")
    delivered = F.count("delivery_days")
    return [
        F.count(F.lit(1)).alias("n_orders"),
        delivered.alias("n_delivered"),
        mean(F.sum(days), delivered).alias("average_days"),
        F.count_if(late).alias("n_late"),
        mean(F.count_if(late), F.count("is_late")).alias("late_rate"),
        mean(delivered, F.count(F.lit(1))).alias("fulfilment_rate"),
    ]


def _seller_orders(items: DataFrame) -> DataFrame:
    return items.groupBy("seller_id", "order_id").agg(F.sum("price").alias("value"))


def delivery_by_seller(orders: DataFrame, items: DataFrame) -> DataFrame:
    facts = orders.select("order_id", "delivery_days", "is_late")
    return _seller_orders(items).join(facts, "order_id").groupBy("seller_id").agg(*_delivery_columns())


def delivery_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    places = customers.select("customer_id", "customer_state")
    facts = orders.select("customer_id", "delivery_days", "is_late")
    return facts.join(places, "customer_id", "left").groupBy("customer_state").agg(*_delivery_columns())


def seller_performance(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Revenue, orders, rating, delay and cancellation of each seller, orders counted once."""
    scores = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score"), F.count("review_score").alias("n_scores")
    )
    facts = orders.select("order_id", "order_status", "is_late")
    joined = _seller_orders(items).join(facts, "order_id").join(scores, "order_id", "left")
    cancelled = F.col("order_status").eqNullSafe(CANCELLED)
    n = F.count(F.lit(1))
    return joined.groupBy("seller_id").agg(
        F.sum("value").alias("revenue"),
        n.alias("n_orders"),
        mean(F.sum("score"), F.sum("n_scores")).alias("average_score"),
        mean(F.count_if("is_late"), F.count("is_late")).alias("delay_rate"),
        mean(F.count_if(cancelled), n).alias("cancellation_rate"),
    )


def payment_types(payments: DataFrame) -> DataFrame:
    total, n = F.sum("payment_value"), F.count(F.lit(1))
    return payments.groupBy("payment_type").agg(
        n.alias("n_payments"),
        total.alias("total_value"),
        mean(total, n).alias("average_value"),
        mean(F.sum("payment_installments"), F.count("payment_installments")).alias("average_installments"),
    )


def payment_mismatch(orders: DataFrame) -> DataFrame:
    """Orders whose payments do not add up to their items."""
    return orders.filter(F.col("payment_value") != F.col("items_value")).select(
        "order_id",
        "items_value",
        "payment_value",
        (F.col("payment_value") - F.col("items_value")).alias("difference"),
    )
