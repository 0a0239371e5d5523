"""Dimensions and facts.  Geography joins only after it has one row per zip prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...operators.slicing import date_range


def mean(total: Column, count: Column) -> Column:
    """Exact total over count, as a double; null when there is nothing to count."""
    return F.try_divide(total.cast("double"), count)


def _one_per(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the least of differing copies; combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    kept = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("row"))
    return kept.select(key, "row.*")


def dim_location(geolocations: DataFrame) -> DataFrame:
    """One row per zip prefix: mean position and most frequent city.

    Counting per (prefix, city) first keeps a prefix with most observations
    from gathering in one task; ties go to the alphabetically first city.
    """
    per_city = geolocations.groupBy(
        "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("geolocation_lat").alias("lat"),
        F.sum("geolocation_lng").alias("lng"),
        F.count("geolocation_lat").alias("n_lat"),
        F.count("geolocation_lng").alias("n_lng"),
    )
    place = F.struct((-F.col("n")).alias("rank"), "geolocation_city", "geolocation_state")
    merged = per_city.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.min(place).alias("place"),
        mean(F.sum("lat"), F.sum("n_lat")).alias("latitude"),
        mean(F.sum("lng"), F.sum("n_lng")).alias("longitude"),
        F.sum("n").alias("n_observations"),
    )
    return merged.select(
        "zip_code_prefix",
        F.col("place.geolocation_city").alias("city"),
        F.col("place.geolocation_state").alias("state"),
        "latitude",
        "longitude",
        "n_observations",
    )


def _located(df: DataFrame, prefix: str, locations: DataFrame) -> DataFrame:
    position = locations.select(F.col("zip_code_prefix").alias(prefix), "latitude", "longitude")
    return df.join(position, prefix, "left")


def dim_customer(customers: DataFrame, locations: DataFrame) -> DataFrame:
    return _located(_one_per(customers, "customer_id"), "customer_zip_code_prefix", locations)


def dim_seller(sellers: DataFrame, locations: DataFrame) -> DataFrame:
    return _located(_one_per(sellers, "seller_id"), "seller_zip_code_prefix", locations)


def dim_product(products: DataFrame) -> DataFrame:
    return _one_per(products, "product_id")


def dim_date(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every day from the first to the last purchase or review."""
    dates = orders.select(F.to_date("order_purchase_timestamp").alias("d")).unionByName(
        reviews.select(F.col("review_creation_date").alias("d"))
    )
    bounds = dates.agg(F.min("d").alias("start_date"), F.max("d").alias("end_date"))
    day = F.col("date_day")
    return date_range(bounds).select(F.col("delivery_date").alias("date_day")).select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.weekday(day) + 1).alias("iso_weekday"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def fct_orders(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order with item and payment totals; children are summed before the join.

    Raw tables keep repeated deliveries, so every parent is reduced to one row per key first.
    """
    item_totals = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("price").alias("items_value")
    )
    payment_totals = payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"))
    purchased = F.to_date("order_purchase_timestamp")
    delivered = F.to_date("order_delivered_customer_date")
    zero = F.lit(0).cast("decimal(28,2)")
    return (
        _one_per(orders, "order_id")
        .join(item_totals, "order_id", "left")
        .join(payment_totals, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_status",
            purchased.alias("purchase_date"),
            delivered.alias("delivered_date"),
            F.col("order_estimated_delivery_date").alias("estimated_date"),
            F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
            F.coalesce("items_value", zero).alias("items_value"),
            F.coalesce("payment_value", zero).alias("payment_value"),
            F.datediff(delivered, purchased).alias("delivery_days"),
            (delivered > F.col("order_estimated_delivery_date")).alias("is_late"),
        )
    )


def fct_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    header = _one_per(orders, "order_id").select(
        "order_id", "customer_id", "order_status", F.to_date("order_purchase_timestamp").alias("purchase_date")
    )
    return (
        items.join(header, "order_id", "left")
        .join(_one_per(products, "product_id").select("product_id", "product_category_name"), "product_id", "left")
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "customer_id",
            "purchase_date",
            "order_status",
            "product_category_name",
            "price",
        )
    )


def fct_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    header = _one_per(orders, "order_id").select(
        "order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("purchase_date")
    )
    return payments.join(header, "order_id", "left")


def fct_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    header = _one_per(orders, "order_id").select(
        "order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("purchase_date")
    )
    return reviews.join(header, "order_id", "left").select(
        "review_id",
        "order_id",
        "customer_id",
        "review_score",
        "review_creation_date",
        "purchase_date",
        F.datediff("review_creation_date", "purchase_date").alias("review_lag_days"),
    )
