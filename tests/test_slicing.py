"""Daily slices on a small hand-made data set."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replaykit.operators import batches, slicing

from .conftest import rows

DAY = {n: dt.date(2017, 5, n) for n in range(1, 10)}


@pytest.fixture(scope="module")
def tables(spark):
    orders = [
        ("o1", "2017-05-01 08:00:00"), ("o2", "2017-05-01 21:30:00"), ("o3", "2017-05-02 00:00:00"),
    ]
    items = [("o1", "1"), ("o1", "2"), ("o2", "1"), ("o3", "1"), ("zz", "1")]
    payments = [("o1", "voucher"), ("o1", "credit_card"), ("o2", "boleto"), ("o3", "boleto")]
    reviews = [("r1", "o1", "2017-05-03 00:00:00"), ("r2", "o2", "2017-05-01 00:00:00"), ("r3", "o9", "2017-05-09")]
    return {
        "orders": spark.createDataFrame(orders, "order_id string, order_purchase_timestamp string"),
        "order_items": spark.createDataFrame(items, "order_id string, order_item_id string"),
        "payments": spark.createDataFrame(payments, "order_id string, payment_type string"),
        "reviews": spark.createDataFrame(reviews, "review_id string, order_id string, review_creation_date string"),
    }


def days(spark, *numbers):
    return spark.createDataFrame([(DAY[n],) for n in numbers], "delivery_date date")


def test_counts_per_day_keep_zeros(spark, tables):
    counts = slicing.delivery_counts(tables, days(spark, 1, 2, 3))
    got = {(r.delivery_date.day, r.source_object): r.record_count for r in counts.collect()}
    assert got == {
        (1, "orders"): 2, (1, "order_items"): 3, (1, "payments"): 3, (1, "reviews"): 1,
        (2, "orders"): 1, (2, "order_items"): 1, (2, "payments"): 1, (2, "reviews"): 0,
        (3, "orders"): 0, (3, "order_items"): 0, (3, "payments"): 0, (3, "reviews"): 1,
    }


def test_range_keeps_only_its_days(tables):
    slices = slicing.daily_slices(tables, DAY[2], DAY[3])
    assert {s: df.count() for s, df in slices.items()} == {"orders": 1, "order_items": 1, "payments": 1, "reviews": 1}
    with pytest.raises(ValueError):
        slicing.daily_slices(tables, DAY[3], DAY[2])


def test_all_days_at_once_equals_day_by_day(spark, tables):
    """Repeated ids, ids on two days and null ids behave as set membership per day."""
    orders = spark.createDataFrame(
        [("a", DAY[1]), ("a", DAY[1]), ("a", DAY[2]), (None, DAY[2]), ("", DAY[3])], "order_id string, delivery_date date"
    )
    children = spark.createDataFrame(
        [("a", 1), ("a", 1), (None, 2), ("", 3), ("b", 4)], "order_id string, n int"
    )
    whole = rows(slicing.slice_by_parent(children, orders), "order_id", "n", "delivery_date")
    single = []
    for day in (DAY[1], DAY[2], DAY[3]):
        ids = {r.order_id for r in orders.filter(F.col("delivery_date") == day).collect()}
        single += [(r.order_id, r.n, day) for r in children.collect() if r.order_id in ids]
    assert whole == sorted(single, key=repr)
    counts = rows(slicing.child_counts_by_parent_day(children, orders))
    assert counts == [(DAY[1], 2), (DAY[2], 3), (DAY[3], 1)]


def test_one_bad_date_fails_the_source(spark):
    df = spark.createDataFrame([("o1", "2017-05-01"), ("o2", "soon"), ("o3", " ")], "order_id string, t string")
    bad = slicing.bad_business_dates(df, "t")
    assert rows(bad, "order_id", "issue") == [("o2", "malformed"), ("o3", "missing")]
    with pytest.raises(Exception, match="t"):
        slicing.slice_by_own_date(df, "t").collect()
    assert slicing.slice_by_own_date(df, "t", strict=False).count() == 1


def test_date_range(spark):
    one = spark.createDataFrame([(DAY[1], DAY[3])], "start_date date, end_date date")
    assert [r.delivery_date for r in slicing.date_range(one).collect()] == [DAY[1], DAY[2], DAY[3]]
    backwards = spark.createDataFrame([(DAY[3], DAY[1])], "start_date date, end_date date")
    with pytest.raises(Exception, match="range ends before"):
        slicing.date_range(backwards).collect()


def test_review_lag_keeps_orphans(tables):
    reviews = slicing.slice_by_own_date(tables["reviews"], "review_creation_date")
    orders = slicing.slice_by_own_date(tables["orders"], "order_purchase_timestamp")
    lag = slicing.review_arrival_lag(reviews, orders)
    assert rows(lag, "review_id", "lag_days") == [("r1", 2), ("r2", 0), ("r3", None)]


def test_batch_checks(spark):
    delivered = spark.createDataFrame(
        [
            (DAY[1], DAY[1], "orders"), (DAY[1], DAY[2], "orders"), (DAY[1], None, "extra"), (DAY[2], DAY[2], "payments"),
            (DAY[2], DAY[2], "orders"), (DAY[2], DAY[2], "reviews"), (DAY[2], DAY[2], "order_items"),
        ],
        "delivery_date date, row_date date, source_object string",
    )
    expected = days(spark, 1, 2, 3)
    assert rows(batches.membership(delivered, expected)) == [
        (DAY[1], "order_items,payments,reviews", "extra", False),
        (DAY[2], "", "", True),
        (DAY[3], "order_items,orders,payments,reviews", "", False),
    ]
    assert rows(batches.duplicates(delivered)) == [(DAY[1], "orders", 2)]
    assert batches.mixed_dates(delivered).count() == 2
    assert rows(batches.empty_batches(delivered, expected)) == [(DAY[3],)]
    resolved = batches.resolve(slicing.expected_grid(days(spark, 1), ("orders", "payments")), delivered)
    assert rows(resolved, "source_object", "resolution") == [("orders", "duplicate"), ("payments", "missing")]
    partial = batches.partial_deliveries(slicing.expected_grid(expected), delivered)
    assert rows(partial) == [(DAY[1], "order_items,payments,reviews")]
