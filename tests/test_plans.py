"""Plan properties every registered query must keep, and small helpers."""

from __future__ import annotations

import pytest

from logtide.operators import basics
from logtide.queries import REGISTRY as QUERIES

from .conftest import SF_SMALL

# pair joins, Python evaluation, and sort-based aggregation (a sort of all
# grouped rows, which Spark picks for non-fixed-width buffers)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "SortAggregate")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_python_or_sort_aggregation_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["daily_summary"](spark, SF_SMALL))
    assert "l_orderkey" not in plan and "l_returnflag" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_partial_aggregation_before_shuffle(spark):
    plan = _plan(QUERIES["log_level_counts"](spark, SF_SMALL))
    assert "partial_count" in plan


def test_entries_take_one_shuffle_of_lines_and_one_of_split_edges(spark):
    df = QUERIES["log_entries"](spark, SF_SMALL)
    df.collect()
    plan = _plan(df)
    final = plan[:plan.index("== Initial Plan ==")]
    shuffles = [x for x in final.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    assert len(shuffles) == 2 and "ReusedExchange" in final and "Join" not in plan


def test_installation_checks(spark):
    assert basics.range_count(spark, 1000).first().total == 1000
    df = spark.range(1000)
    assert basics.sql_count(spark, df).first().total == 1000
    assert basics.even_doubled(df).count() == 500
    assert sorted(r.doubled for r in basics.even_doubled(df).limit(3).collect())[0] % 4 == 0


def test_source_probe_lists_tables(spark):
    from logtide.sources.probe import source_probe

    rows = source_probe(spark, SF_SMALL, glob="*.parquet").collect()
    assert len(rows) == 1 and rows[0].files == 14 and rows[0].bytes > 0


def test_queries_are_lazy_and_leave_nothing(spark):
    """Building a query runs no job and writes no table."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        for name in ("largest_cluster_apps", "cluster_lookup_join", "cluster_share", "duration_histogram", "duration_kde",
                     "log_entries"):
            before = len(tracker.getJobIdsForGroup("lazy"))
            QUERIES[name](spark, SF_SMALL)
            # reading a table's schema is the one job that is allowed
            assert len(tracker.getJobIdsForGroup("lazy")) <= before + 2
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_describe_source_reports_bounded_facts(spark):
    from logtide.sources.probe import describe_source

    d = describe_source(spark, f"{SF_SMALL}/region.parquet")
    assert d["exists"] and d["rows"] == 5 and len(d["preview"]) == 5
    assert d["schema"].startswith("struct<") and len(d["files"]) == 1
    missing = describe_source(spark, f"{SF_SMALL}/no_such_table.parquet")
    assert missing["exists"] is False and missing["error"] == "PATH_NOT_FOUND"
    assert describe_source(spark, f"{SF_SMALL}/none/*.parquet")["exists"] is False
    assert describe_source(spark, f"{SF_SMALL}/regio*.parquet")["exists"] is True


def _fallbacks(plan) -> int:
    """Tasks of object-hash aggregates that went over to sorting, in a plan that has run."""
    n = 0
    metrics = plan.metrics()
    if metrics.contains("numTasksFallBacked"):
        n += metrics.apply("numTasksFallBacked").value()
    name = plan.getClass().getSimpleName()
    below = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if "QueryStage" in name else []
    children = plan.children()
    below += [children.apply(i) for i in range(children.size())]
    return n + sum(_fallbacks(p) for p in below)


@pytest.mark.parametrize("name", ["daily_summary_all_years", "python_timings", "stage_skew"])
def test_percentiles_do_not_fall_back_to_sorting(spark, name):
    from logtide.plans.session import RECOMMENDED_CONF

    from .conftest import SF_MID

    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    spark.conf.set(key, RECOMMENDED_CONF[key])
    try:
        df = QUERIES[name](spark, SF_MID)
        df.collect()
        assert "ObjectHashAggregate" in _plan(df) and _fallbacks(df._jdf.queryExecution().executedPlan()) == 0
    finally:
        spark.conf.unset(key)
    if name == "daily_summary_all_years":  # Spark's own threshold is passed: the metric counts
        df = QUERIES[name](spark, SF_MID)
        df.collect()
        assert _fallbacks(df._jdf.queryExecution().executedPlan()) > 0
