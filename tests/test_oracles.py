"""A sample of registered queries beside their SQL twins; ``tools/check_oracles.py`` runs all."""

from __future__ import annotations

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_points  # noqa: E402
from workload import ORACLES, QUERIES  # noqa: E402
from tools.check_oracles import table_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "date_completeness", "incomplete_summary", "range_progress", "events_from_outcomes", "event_row_checks",
    "reconciliation", "recovery_plan", "recovery_outcome_summary", "delivery_counts", "business_date",
    "batch_membership", "header_contract", "run_json", "raw_partition_replace", "record_counts",
    "fct_orders", "customer_360", "artifact_checksums", "slices_for_range", "recovery_events",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_twin(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    got = table_of(df.columns, df.collect())
    cursor = duck.execute(entry_points.oracle_sql()[name])
    assert got == table_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[1]


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_but_one_has_a_twin():
    assert set(QUERIES) - set(ORACLES) == {"landing_manifest"}


@pytest.mark.parametrize("name", ("reconciliation", "recovery_plan", "date_completeness", "fct_orders", "run_json"))
def test_plans_stay_in_the_jvm(spark, name):
    plan = entry_points.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
