"""Checks of delivered batches against what a date was expected to bring.

``deliveries`` rows carry ``delivery_date`` (the batch), ``source_object`` and,
where a check needs it, ``row_date`` (the delivery's own date).  Source names
per date are few, so the per-date name lists below stay small; they are built
from distinct pairs, which combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.registry import DAILY_SOURCES


def _names(condition: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_list(F.when(condition, F.col("source_object")))), ",")


def membership(deliveries: DataFrame, days: DataFrame, expected: tuple[str, ...] = DAILY_SOURCES) -> DataFrame:
    """Missing and unexpected sources of every expected date; either one rejects the batch."""
    pairs = deliveries.select("delivery_date", "source_object").distinct()
    is_expected = F.col("source_object").isin(*expected)
    actual = pairs.groupBy("delivery_date").agg(
        F.collect_list(F.when(is_expected, F.col("source_object"))).alias("known"),
        _names(~is_expected).alias("unexpected_sources"),
    )
    known = F.coalesce("known", F.array().cast("array<string>"))
    wanted = F.array(*[F.lit(s) for s in sorted(expected)])
    joined = days.join(actual, "delivery_date", "left")
    return joined.select(
        "delivery_date",
        F.array_join(F.array_except(wanted, known), ",").alias("missing_sources"),
        F.coalesce("unexpected_sources", F.lit("")).alias("unexpected_sources"),
    ).withColumn(
        "accepted", (F.col("missing_sources") == "") & (F.col("unexpected_sources") == "")
    )


def duplicates(deliveries: DataFrame, keys: tuple[str, ...] = ("delivery_date", "source_object")) -> DataFrame:
    """Pairs delivered more than once."""
    return (
        deliveries.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_deliveries"))
        .filter(F.col("n_deliveries") > 1)
    )


def mixed_dates(deliveries: DataFrame) -> DataFrame:
    """Deliveries whose own date differs from their batch's, nulls compared as values."""
    return deliveries.filter(~F.col("row_date").eqNullSafe(F.col("delivery_date")))


def empty_batches(deliveries: DataFrame, days: DataFrame) -> DataFrame:
    """Expected dates without any delivery; a delivery of zero records is not empty."""
    return days.join(deliveries.select("delivery_date"), "delivery_date", "left_anti")


def resolve(needed: DataFrame, deliveries: DataFrame) -> DataFrame:
    """``ok``, ``missing`` or ``duplicate`` for each needed pair; extra deliveries are ignored."""
    counted = deliveries.groupBy("delivery_date", "source_object").agg(
        F.count(F.lit(1)).alias("n_deliveries")
    )
    joined = needed.join(counted, ["delivery_date", "source_object"], "left").withColumn(
        "n_deliveries", F.coalesce("n_deliveries", F.lit(0).cast("bigint"))
    )
    n = F.col("n_deliveries")
    return joined.withColumn(
        "resolution", F.when(n == 0, "missing").when(n > 1, "duplicate").otherwise("ok")
    )


def partial_deliveries(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """Delivery dates present but lacking expected files, with the lacking names sorted."""
    present_days = delivered.select("delivery_date").distinct()
    lacking = expected.join(
        delivered.select("delivery_date", "source_object"),
        ["delivery_date", "source_object"],
        "left_anti",
    ).join(present_days, "delivery_date", "left_semi")
    return lacking.groupBy("delivery_date").agg(
        F.array_join(F.array_sort(F.collect_set("source_object")), ",").alias("missing_sources")
    )
