"""Daily slices of full source tables: all dates in one job, never one job per date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import business_date, business_date_issue
from ..functions.text import is_blank
from ..sources.registry import DAILY_SOURCES

# The text column that dates a source's own rows.
DATED_BY = {"orders": "order_purchase_timestamp", "reviews": "review_creation_date"}
PARENT_KEY = "order_id"


def date_range(requests: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Every day of each requested range, both ends included; ``end < start`` fails the job."""
    first, last = F.col(start), F.col(end)
    message = F.concat(F.lit("range ends before it starts: "), first.cast("string"))
    checked = F.when(last < first, F.raise_error(message).cast("date")).otherwise(last)
    days = F.sequence(first, checked, F.expr("interval 1 day"))
    return requests.withColumn("delivery_date", F.explode(days))


def calendar(df: DataFrame, column: str = "delivery_date") -> DataFrame:
    """One row per day between the first and last date of a column."""
    bounds = df.agg(F.min(column).alias("start_date"), F.max(column).alias("end_date"))
    return date_range(bounds.filter(F.col("start_date").isNotNull())).select("delivery_date")


def expected_grid(days: DataFrame, sources: tuple[str, ...] = DAILY_SOURCES) -> DataFrame:
    """Calendar days crossed with a fixed handful of sources (a per-day explode, no join)."""
    names = F.explode(F.array(*[F.lit(s) for s in sources]))
    return days.select("delivery_date", names.alias("source_object"))


def parsed_dates(df: DataFrame, column: str) -> DataFrame:
    """Add the business date and what is wrong with rows that have none."""
    dated = df.withColumn("delivery_date", business_date(F.col(column)))
    return dated.withColumn("issue", business_date_issue(F.col(column), F.col("delivery_date")))


def bad_business_dates(df: DataFrame, column: str) -> DataFrame:
    """Rows whose business date is missing or malformed, anywhere in the table."""
    return parsed_dates(df, column).filter(F.col("issue").isNotNull())


def slice_by_own_date(df: DataFrame, column: str, strict: bool = True) -> DataFrame:
    """Assign each row to the day of its own timestamp text; duplicates stay.

    One bad timestamp spoils the whole source, so ``strict`` fails the job on
    it; otherwise undated rows are left out (list them with
    ``bad_business_dates``).
    """
    day = business_date(F.col(column))
    if not strict:
        return df.withColumn("delivery_date", day).filter(F.col("delivery_date").isNotNull())
    # The parse appears once, so the usual row is parsed once.
    issue = F.when(is_blank(F.col(column)), "missing").otherwise("malformed")
    failure = F.raise_error(F.concat(issue, F.lit(f" {column}"))).cast("date")
    return df.withColumn("delivery_date", F.coalesce(day, failure))


def parent_days(orders_by_day: DataFrame, key: str = PARENT_KEY) -> DataFrame:
    """Distinct (order, day) pairs: an order delivered on two days owns its children on both."""
    return orders_by_day.select(F.col(key).alias("parent_key"), "delivery_date").distinct()


def slice_by_parent(children: DataFrame, orders_by_day: DataFrame, key: str = PARENT_KEY) -> DataFrame:
    """Children follow their parent order's day; their own timestamps are ignored.

    Null and blank keys match null and blank keys.  A hot order is split by
    AQE's skew join, which needs no knowledge of the key.
    """
    parents = parent_days(orders_by_day, key)
    return children.join(parents, F.col(key).eqNullSafe(F.col("parent_key"))).drop("parent_key")


def child_counts_by_parent_day(children: DataFrame, orders_by_day: DataFrame, key: str = PARENT_KEY) -> DataFrame:
    """Rows per day of a child source, counted per order before the join moves anything."""
    per_order = children.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    joined = per_order.join(
        parent_days(orders_by_day, key), F.col(key).eqNullSafe(F.col("parent_key"))
    )
    return joined.groupBy("delivery_date").agg(F.sum("n").alias("record_count"))


def daily_slices(
    tables: dict[str, DataFrame],
    start: dt.date | None = None,
    end: dt.date | None = None,
    strict: bool = True,
) -> dict[str, DataFrame]:
    """The four daily sources with a ``delivery_date``, optionally for a date range.

    The range filter sits on the computed date of orders before the child
    joins, so children of other days are never matched.
    """
    if start is not None and end is not None and end < start:
        raise ValueError("range ends before it starts")

    def in_range(df: DataFrame) -> DataFrame:
        kept = df if start is None else df.filter(F.col("delivery_date") >= F.lit(start))
        return kept if end is None else kept.filter(F.col("delivery_date") <= F.lit(end))

    orders = in_range(slice_by_own_date(tables["orders"], DATED_BY["orders"], strict))
    return {
        "orders": orders,
        "order_items": slice_by_parent(tables["order_items"], orders),
        "payments": slice_by_parent(tables["payments"], orders),
        "reviews": in_range(slice_by_own_date(tables["reviews"], DATED_BY["reviews"], strict)),
    }


def delivery_counts(tables: dict[str, DataFrame], days: DataFrame, strict: bool = True) -> DataFrame:
    """Record count of every (day, daily source), zero when nothing was delivered.

    Only keys and dates travel: children are counted per order first.
    """
    orders = slice_by_own_date(
        tables["orders"].select(PARENT_KEY, DATED_BY["orders"]), DATED_BY["orders"], strict
    )
    reviews = slice_by_own_date(tables["reviews"].select(DATED_BY["reviews"]), DATED_BY["reviews"], strict)

    def own(df: DataFrame) -> DataFrame:
        return df.groupBy("delivery_date").agg(F.count(F.lit(1)).alias("record_count"))

    counts = {
        "orders": own(orders),
        "order_items": child_counts_by_parent_day(tables["order_items"], orders),
        "payments": child_counts_by_parent_day(tables["payments"], orders),
        "reviews": own(reviews),
    }
    united = None
    for source, counted in counts.items():
        part = counted.select("delivery_date", F.lit(source).alias("source_object"), "record_count")
        united = part if united is None else united.unionByName(part)
    grid = expected_grid(days, tuple(counts))
    return grid.join(united, ["delivery_date", "source_object"], "left").withColumn(
        "record_count", F.coalesce("record_count", F.lit(0).cast("bigint"))
    )


def review_arrival_lag(reviews_by_day: DataFrame, orders_by_day: DataFrame) -> DataFrame:
    """Days between the parent order and its review; reviews without a parent stay with null."""
    parents = parent_days(orders_by_day).withColumnRenamed("delivery_date", "order_date")
    joined = reviews_by_day.join(
        parents, F.col(PARENT_KEY).eqNullSafe(F.col("parent_key")), "left"
    ).drop("parent_key")
    return joined.withColumn("lag_days", F.datediff("delivery_date", "order_date"))
