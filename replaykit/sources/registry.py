"""The eight source objects and their fixed all-text schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import constant_table

MASTER = "master"
TRANSACTIONAL = "transactional"

# Names, owning systems, kinds and source column order, spelling
# mistakes of the sources included.
SOURCES: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "customers": ("customer_platform", MASTER, (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state",
    )),
    "orders": ("order_platform", TRANSACTIONAL, (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )),
    "order_items": ("order_platform", TRANSACTIONAL, (
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
        "freight_value",
    )),
    "products": ("product_catalog", MASTER, (
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    )),
    "sellers": ("marketplace_platform", MASTER, (
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
    )),
    "payments": ("payment_platform", TRANSACTIONAL, (
        "order_id", "payment_sequential", "payment_type", "payment_installments",
        "payment_value",
    )),
    "reviews": ("review_platform", TRANSACTIONAL, (
        "review_id", "order_id", "review_score", "review_comment_title",
        "review_comment_message", "review_creation_date", "review_answer_timestamp",
    )),
    "geolocations": ("public_geographic_source", MASTER, (
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city", "geolocation_state",
    )),
}

# The few columns slicing itself depends on.
SLICE_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id", "order_purchase_timestamp"),
    "order_items": ("order_id",),
    "payments": ("order_id",),
    "reviews": ("review_creation_date",),
}

MASTER_SOURCES = tuple(sorted(s for s, (_, kind, _c) in SOURCES.items() if kind == MASTER))
DAILY_SOURCES = tuple(sorted(s for s, (_, kind, _c) in SOURCES.items() if kind == TRANSACTIONAL))


def columns_of(source_object: str) -> tuple[str, ...]:
    if source_object not in SOURCES:
        raise ValueError(f"unsupported source_object: {source_object!r}")
    return SOURCES[source_object][2]


def raw_schema(source_object: str) -> T.StructType:
    """Every column nullable text, in source order."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns_of(source_object)])


def is_transactional(source: Column) -> Column:
    return source.isin(*DAILY_SOURCES)


def is_master(source: Column) -> Column:
    return source.isin(*MASTER_SOURCES)


def registry(spark: SparkSession) -> DataFrame:
    """One row per source object; eight rows, so joins broadcast it."""
    rows = [
        (name, system, kind, list(columns), list(SLICE_COLUMNS.get(name, ())))
        for name, (system, kind, columns) in SOURCES.items()
    ]
    schema = dict.fromkeys(("source_object", "source_system", "kind"), "string")
    return constant_table(spark, rows, {**schema, "required_columns": "array<string>", "slice_columns": "array<string>"})


def with_registry(df: DataFrame, strict: bool = True) -> DataFrame:
    """Attach the registry entry of ``source_object``.

    ``strict`` fails the job on the first unsupported source; otherwise such
    rows keep null registry columns.
    """
    joined = df.join(F.broadcast(registry(df.sparkSession)), "source_object", "left")
    if not strict:
        return joined
    # A filter, unlike a computed column, stays when later steps drop columns.
    unsupported = F.concat(F.lit("unsupported source_object: "), F.col("source_object"))
    known = F.when(F.col("kind").isNull(), F.raise_error(unsupported).cast("boolean")).otherwise(F.lit(True))
    return joined.filter(known)


def expected_sources(spark: SparkSession, sources: tuple[str, ...] = DAILY_SOURCES) -> DataFrame:
    return constant_table(spark, [(s,) for s in sources], {"source_object": "string"})
