"""What the plans of the registered queries must and must not contain."""

import re

import pytest

from gridspark.plans import catalog


def plan_of(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


# Hot credits are folded in Python; everything else stays in the JVM.
FOLDED = {"credit_settlement_hot", "credit_settlement_refunds"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan
    assert ("InArrow" in plan) == (name in FOLDED)


def test_by_source_is_one_scan_of_the_needed_columns(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "dispatch_by_source")
    assert plan.count("FileScan") == 1
    assert set(re.search(r"ReadSchema: struct<(.*?)>", plan)[1].split(",")) == {
        "l_quantity:double", "l_returnflag:string", "l_shipdate:timestamp_ntz",
    }


def test_treemap_levels_read_the_registry_once(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "treemap_levels")
    assert plan.count("orders.parquet") == 1


def test_filters_reach_the_scan(spark, sf_dir):
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan_of(spark, sf_dir, "load_history")
    assert "GreaterThan" in plan_of(spark, sf_dir, "credits_available") or "date_add" in plan_of(spark, sf_dir, "credits_available")


@pytest.mark.parametrize("name", ["registry_dedup_first", "registry_dedup_last", "plants_upsert", "iot_dedup", "treemap_uf_top", "load_drift_recent"])
def test_groups_are_limited_before_the_shuffle(spark, sf_dir, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan_of(spark, sf_dir, name))


@pytest.mark.parametrize("name", ["units_page", "plants_page", "load_page", "top_ufs", "dispatch_now", "load_mix_now", "growth_log"])
def test_pages_do_not_sort_everything(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan
