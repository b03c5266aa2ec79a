"""Physical plans: no Python, no cross joins, no single-task windows, pruned scans."""

import re

import pytest

from quotepanel.operators import period
from quotepanel.operators.mart import mart_daily
from quotepanel.plans import panels
from quotepanel.plans.catalog import QUERIES
from quotepanel.plans.entries import jobs

SF_DIR = "/root/testdata/sf0.001"
WRITING = {name for name, run in QUERIES.items() if run.__module__ == jobs.__name__}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert unwanted not in plan
    # A window without keys would sort everything in one task.
    assert not re.search(r"Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_mart_has_one_window_shuffle_and_sort(spark):
    panel = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr(
        "to_date(l_shipdate) result_date", "cast(l_suppkey as string) cur_unit", "l_extendedprice rate"
    )
    plan = plan_of(mart_daily(panel))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 1


def test_dedupe_combines_before_the_shuffle(spark):
    plan = plan_of(panels.suppliers_panel(spark, SF_DIR))
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "partial_max" in below and "partial_max" not in above


def test_panel_reads_five_of_eleven_columns(spark):
    plan = plan_of(panels.suppliers_panel(spark, SF_DIR))
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "l_quantity" not in schema and "l_tax" not in schema


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "mart")
    mart_daily(panels.suppliers_panel(spark, SF_DIR)).write.parquet(path)
    return spark.read.parquet(path)


def test_period_and_snapshot_reach_the_scan_without_a_join(stored):
    for df in (period.period(stored, 5), period.snapshot(stored)):
        plan = plan_of(df)
        assert "Join" not in plan
        assert re.search(r"DataFilters: \[isnotnull\(result_date[^\]]*Subquery", plan)


def test_selection_reaches_the_scan(stored):
    plan = plan_of(period.select(stored, ["1", "2"]))
    assert re.search(r"PushedFilters: \[[^\]]*In\(cur_unit", plan)
