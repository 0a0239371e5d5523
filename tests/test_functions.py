"""Column functions against the edge cases of the contracts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replaykit.functions import dates, headers, paths, text

from .conftest import rows


def one(spark, expression, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expression).first()[0]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2017-05-01 10:11:12", dt.date(2017, 5, 1)),
        ("2017-05-01", dt.date(2017, 5, 1)),
        ("  2017-05-01 10:11:12\t", dt.date(2017, 5, 1)),
        (" 2017-05-01　", dt.date(2017, 5, 1)),
        ("2017-5-1 1:2:3", dt.date(2017, 5, 1)),
        ("2017-02-29", None),
        ("2016-02-29", dt.date(2016, 2, 29)),
        ("2017-13-01", None),
        ("2017-05-01T10:11:12", None),
        ("2017-05-01 10:11:12.5", None),
        ("2017-05-01 24:00:00", None),
        ("2017-05-01 10:60:00", None),
        ("2017-05-01 10:11", None),
        ("17-05-01", None),
        ("0000-01-01", None),
        ("not-a-date", None),
        ("", None),
        ("   ", None),
        (None, None),
    ],
)
def test_business_date(spark, value, expected):
    assert one(spark, dates.business_date(F.col("v")), v=value) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("", True), (" \t\n", True), (" ", True), (None, True), ("\x1f", True), ("a", False), (" é ", False),
     (" x", False), ("\x7f", False)],
)
def test_is_blank(spark, value, expected):
    assert one(spark, text.is_blank(F.col("v")), v=value) is expected


@pytest.mark.parametrize("value", ["a", " a", "a ", " a　", "\ta b\n", "", "é", " é"])
def test_strip_matches_python(spark, value):
    assert one(spark, text.strip(F.col("v")), v=value) == value.strip()


@pytest.mark.parametrize(
    ("value", "expected"),
    [("orders", True), (".hidden", True), ("a.b", True), ("", False), ("  ", False), (".", False), ("..", False),
     ("a/b", False), ("a\\b", False), (None, False)],
)
def test_safe_segment(spark, value, expected):
    assert one(spark, text.safe_segment(F.col("v")), v=value) is expected


def test_safe_error_is_bounded(spark):
    message = one(spark, text.safe_error("ingestion_failed", "c", "o", "m" * 600), v="x")
    assert len(message) == 512
    assert message.startswith("category=ingestion_failed component=c operation=o message=mmm")


@pytest.mark.parametrize(
    ("uri", "expected"),
    [
        ("gs://b/raw/x/ingestion_date=2017-05-02/f.csv", dt.date(2017, 5, 2)),
        ("ingestion_date=2017-05-02", dt.date(2017, 5, 2)),
        ("gs://b/ingestion_date=2017-05-02", dt.date(2017, 5, 2)),
        ("gs://b/xingestion_date=2017-05-02/f.csv", None),
        ("gs://b/ingestion_date=2017-05-021/f.csv", None),
        ("gs://b/ingestion_date=2017-02-30/f.csv", None),
        ("gs://b/f.csv", None),
        (None, None),
    ],
)
def test_uri_ingestion_date(spark, uri, expected):
    assert one(spark, paths.uri_ingestion_date(F.col("v")), v=uri) == expected


@pytest.mark.parametrize(
    ("uri", "bucket", "name"),
    [("gs://b/x/y.csv", "b", "x/y.csv"), ("gs://b", None, None), ("gs://b/", None, None), ("gs:///x", None, None),
     ("s3://b/x", None, None)],
)
def test_uri_parts(spark, uri, bucket, name):
    assert one(spark, paths.uri_bucket(F.col("v")), v=uri) == bucket
    assert one(spark, paths.uri_object(F.col("v")), v=uri) == name


def test_landing_path_and_destination(spark):
    df = spark.createDataFrame([("order_platform", "orders", dt.date(2017, 5, 2))], "s string, o string, d date")
    path = paths.landing_path(F.col("s"), F.col("o"), F.col("d"), F.lit("orders.csv"))
    daily = paths.destination_id("p.raw", F.col("o"), F.col("d"), F.lit(True))
    master = paths.destination_id("p.raw", F.col("o"), F.col("d"), F.lit(False))
    assert rows(df.select(path, daily, master)) == [
        ("raw/order_platform/orders/ingestion_date=2017-05-02/orders.csv", "p.raw.orders$20170502", "p.raw.orders")
    ]


@pytest.mark.parametrize(
    ("name", "expected"),
    [("/a/b.csv", True), ("/a/B.CSV", True), ("/a/b.txt", False), ("/a/.csv", False), ("/a/csv", False),
     ("/a.csv/b", False), ("/a/b.csv.gz", False)],
)
def test_csv_suffix(spark, name, expected):
    assert one(spark, paths.has_csv_suffix(F.col("v")), v=name) is expected


def test_header_columns(spark):
    get = lambda v: one(spark, headers.header_columns(F.col("v")), v=v)
    assert get("a,b") == ["a", "b"]
    assert get('﻿"a","b"\r') == ["a", "b"]
    assert get("") == []
    missing = headers.missing_columns(F.array(F.lit("b"), F.lit("a"), F.lit("c")), F.array(F.lit("c"), F.lit("z")))
    assert one(spark, missing, v="x") == ["a", "b"]
