"""Raw text to typed columns: blank becomes null, unreadable becomes null, spelling is mended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import business_date, business_timestamp
from ...functions.text import strip

MONEY = "decimal(18,2)"
DEGREES = "decimal(9,6)"


def _text(name: str) -> Column:
    return F.nullif(strip(F.col(name)), F.lit("")).alias(name)


def _number(name: str, kind: str, alias: str | None = None) -> Column:
    # Casts from text ignore surrounding white space themselves.
    return F.col(name).try_cast(kind).alias(alias or name)


def _time(name: str) -> Column:
    return business_timestamp(F.col(name)).alias(name)


def _date(name: str) -> Column:
    return business_date(F.col(name)).alias(name)


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(*[_text(c) for c in (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    )])


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("order_id"),
        _text("customer_id"),
        _text("order_status"),
        _time("order_purchase_timestamp"),
        _time("order_approved_at"),
        _time("order_delivered_carrier_date"),
        _time("order_delivered_customer_date"),
        _date("order_estimated_delivery_date"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("order_id"),
        _number("order_item_id", "int"),
        _text("product_id"),
        _text("seller_id"),
        _time("shipping_limit_date"),
        _number("price", MONEY),
        _number("freight_value", MONEY),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("product_id"),
        _text("product_category_name"),
        _number("product_name_lenght", "int", "product_name_length"),
        _number("product_description_lenght", "int", "product_description_length"),
        *[_number(c, "int") for c in (
            "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        )],
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(*[_text(c) for c in ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")])


def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("order_id"),
        _number("payment_sequential", "int"),
        _text("payment_type"),
        _number("payment_installments", "int"),
        _number("payment_value", MONEY),
    )


def stg_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("review_id"),
        _text("order_id"),
        _number("review_score", "int"),
        _text("review_comment_title"),
        _text("review_comment_message"),
        _date("review_creation_date"),
        _time("review_answer_timestamp"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("geolocation_zip_code_prefix"),
        _number("geolocation_lat", DEGREES),
        _number("geolocation_lng", DEGREES),
        _text("geolocation_city"),
        _text("geolocation_state"),
    )
