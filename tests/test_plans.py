"""Plan-shape checks: the physical plans keep the properties argued in PLANS.md."""

import contextlib
import io
import re

import pytest

from periodlens.plans import catalog
from periodlens.plans.reports import REPORTS
from periodlens.sinks import read_fact, write_parquet

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fact_plan_broadcasts_and_partially_aggregates(spark):
    plan = physical(catalog.event_population_fact(spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 2  # units and calendar days
    assert "partial_sum" in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2  # sums per (date, hour, unit), then sums per roll-up key
    assert plan.index("BroadcastHashJoin [unit_code") < plan.rindex("partial_sum")


def test_range_strategy_is_an_equi_join(spark):
    plan = physical(catalog.event_population_fact(spark, SF, strategy="range"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_baseline_report_scans_its_fact_once(spark, tmp_path):
    write_parquet(catalog.event_population_fact(spark, SF), str(tmp_path / "pop"))
    pop = read_fact(spark, str(tmp_path / "pop"), "area_population")
    assert physical(REPORTS["after_vs_normal"].build(pop, None)).count("FileScan parquet") == 1


def test_reports_over_persisted_facts_push_filters_and_prune_columns(spark, tmp_path):
    pop, rid = catalog.event_facts(spark, SF)
    write_parquet(pop, str(tmp_path / "pop"))
    write_parquet(rid, str(tmp_path / "rid"))
    p = read_fact(spark, str(tmp_path / "pop"), "area_population")
    r = read_fact(spark, str(tmp_path / "rid"), "area_subway")
    plan = formatted(REPORTS["young_population_lift"].build(p, r))
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "In(phase" in pushed and "IsNotNull(semester)" in pushed
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "young_20s_population" in schema
    for unused in ("total_population", "young_20s_ratio", "day_of_week", "hour"):
        assert f"{unused}:" not in schema


@pytest.mark.parametrize("name", ["report_did_young_population", "report_weekend_effect"])
def test_reports_filter_below_the_fact_aggregation(spark, name):
    plan = physical(catalog.QUERIES[name](spark, SF))
    # the report's phase filter turns the calendar's left join into an inner join
    assert re.search(r"BroadcastHashJoin \[date#\d+\], \[date#\d+\], Inner", plan)
