"""Data-quality tests: each returns what violates it, nothing when the data is sound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators.checks import Rule, violations


def key_violations(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by several rows or containing a null; one key column or several."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("has_null", has_null).filter((F.col("n_rows") > 1) | F.col("has_null"))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each listed column that has any, all counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in columns])
    )
    return counts.select(pairs.alias("p")).select("p.*").filter(F.col("n_nulls") > 0)


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Non-null keys without a parent and how many rows hold them.

    Children are counted per key before the join, so a hot key moves once.
    """
    held = children.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return held.join(parents.select(key), key, "left_anti")


def order_rules() -> list[Rule]:
    """Business rules of the order fact."""
    return [
        ("delivered_before_purchase", F.col("delivered_date") < F.col("purchase_date")),
        ("no_items", F.col("n_items") == 0),
        ("payment_not_positive", F.col("payment_value") <= 0),
        ("delivered_but_cancelled", (F.col("order_status") == "canceled") & F.col("delivered_date").isNotNull()),
    ]


def business_rule_violations(orders_fact: DataFrame) -> DataFrame:
    return violations(orders_fact, order_rules(), ["order_id"])
