"""One key holds most rows: results stay whole and no task gathers the key."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replaykit.operators import ledger, slicing
from replaykit.plans.marts.model import dim_location
from replaykit.sources.landing import landing_conflicts

from .conftest import rows

DAY = dt.date(2017, 5, 1)
N = 40_000


@pytest.fixture
def small_partitions(spark):
    """Thresholds low enough for the skew handling to act on test data."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def test_children_of_a_hot_order(spark, small_partitions):
    """Two thirds of the items belong to one order delivered on two days."""
    key = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string"))
    items = spark.range(N, numPartitions=8).select(key.alias("order_id"), F.sha2(F.col("id").cast("string"), 256).alias("item"))
    orders = items.select("order_id").distinct().select("order_id", F.lit(DAY).alias("delivery_date")).unionByName(
        spark.createDataFrame([("hot", dt.date(2017, 5, 2))], "order_id string, delivery_date date")
    )
    sliced = slicing.slice_by_parent(items, orders)
    hot = N - (N + 2) // 3
    assert sliced.count() == N + hot
    assert sliced.select("item").distinct().count() == N
    counts = dict(rows(slicing.child_counts_by_parent_day(items, orders)))
    assert counts == {DAY: N, dt.date(2017, 5, 2): hot}
    per_task = sliced.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    # Both days of the hot order make 2 * hot rows; no task holds them all.
    assert per_task < 0.6 * 2 * hot


def test_newest_of_a_hot_pair(spark):
    made = spark.range(N, numPartitions=8).select(
        F.lit("r").alias("run_id"),
        F.lpad(F.col("id").cast("string"), 8, "0").alias("event_id"),
        F.lit(DAY).alias("delivery_date"),
        F.when(F.col("id") % 10 == 0, "payments").otherwise("orders").alias("source_object"),
        F.when(F.col("id") % 2 == 0, "success").otherwise("failed").alias("status"),
        F.lit("warehouse").alias("stage"),
        F.timestamp_seconds(F.col("id") % 100).alias("recorded_at"),
    )
    got = rows(ledger.latest_attempt_per_source(made), "source_object", "event_id")
    assert got == [("orders", f"{N - 1:08d}"), ("payments", f"{N - 10:08d}")]
    state = rows(ledger.pair_state(made), "source_object", "latest_event_id", "completed")
    assert state == [("orders", f"{N - 1:08d}", True), ("payments", f"{N - 10:08d}", True)]


def test_many_claims_of_one_landing_path(spark):
    manifest = spark.range(N, numPartitions=8).select(
        F.lpad(F.col("id").cast("string"), 8, "0").alias("path"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("landing_path"),
    )
    existing = spark.createDataFrame([("0",)], "landing_path string")
    flagged = landing_conflicts(manifest, existing)
    assert flagged.count() == N
    assert flagged.filter("landing_path = 'hot' and not conflict").collect()[0].path == "00000001"
    assert flagged.filter("not conflict").count() == (N + 2) // 3


def test_one_prefix_with_most_observations(spark):
    places = spark.range(N, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, "01037").otherwise("02020").alias("geolocation_zip_code_prefix"),
        F.lit(-23).cast("decimal(9,6)").alias("geolocation_lat"),
        F.lit(-46).cast("decimal(9,6)").alias("geolocation_lng"),
        F.when(F.col("id") % 5 == 0, "sao paulo").otherwise("são paulo").alias("geolocation_city"),
        F.lit("SP").alias("geolocation_state"),
    )
    located = {r.zip_code_prefix: r for r in dim_location(places).collect()}
    assert {k: (r.city, r.latitude) for k, r in located.items()} == {
        "01037": ("são paulo", -23.0), "02020": ("são paulo", -23.0),
    }
    assert sum(r.n_observations for r in located.values()) == N
