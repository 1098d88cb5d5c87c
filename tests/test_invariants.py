"""Invariants the reference's checked-in outputs satisfy, checked on sf0.01."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

import __spark_entry__ as E
from logtide.functions import parse

from .conftest import SF_MID

Q = E.queries()


@pytest.fixture(scope="module")
def r(spark):
    def run(name):
        return Q[name](spark, SF_MID).collect()
    return run


def test_level_counts_sum_to_lines_with_levels(r):
    counts = r("log_level_counts")
    (tot,) = r("log_scan_totals")
    assert sum(x["count"] for x in counts) == tot.lines_with_levels
    assert len(counts) == tot.unique_levels
    assert all(x["count"] > 0 for x in counts)  # a level without lines has no row
    assert tot.total_lines == r("log_scan_count")[0].total_lines


def test_percentages_use_leveled_denominator(r):
    pct = r("log_level_pct")
    assert sum(x.pct for x in pct) == pytest.approx(100.0)
    (tot,) = r("log_scan_totals")
    for x in pct:
        assert x.pct == pytest.approx(x["count"] / tot.lines_with_levels * 100)


def test_timeline_unique_sorted_and_stats_recompute(r):
    tl = r("app_timeline")
    keys = [(x.cluster_id, x.app_id) for x in tl]
    assert len(keys) == len(set(keys))
    assert [(x.cluster_id, x.start_time) for x in tl] == sorted((x.cluster_id, x.start_time) for x in tl)
    (st,) = r("usage_stats")
    d = [x.duration_sec for x in tl]
    assert st.total_applications == len(tl)
    assert st.avg_duration_sec == pytest.approx(sum(d) / len(d))
    assert (st.min_duration_sec, st.max_duration_sec) == (min(d), max(d))
    summary = r("cluster_summary")
    assert sum(x.num_applications for x in summary) == len(tl)
    assert st.total_clusters == len(summary)
    for x in tl:
        assert x.duration_sec == int((x.end_time - x.start_time).total_seconds())


def test_timeline_lines_use_their_own_predicate(r):
    tl = r("app_timeline")
    (ts,) = r("timestamped_lines")
    (tot,) = r("log_scan_totals")
    (q,) = r("parse_quality")
    assert sum(x.log_lines for x in tl) == ts.timestamped_lines
    assert ts.timestamped_lines == q.total_lines - q.no_timestamp - q.bad_timestamp
    assert tot.lines_with_levels == q.total_lines - q.no_level


def test_timestamp_and_level_predicates_differ_on_files(spark, log_tree):
    from logtide.operators import levels, usage
    from logtide.sources.logs import read_log_lines

    lines = read_log_lines(spark, log_tree)
    leveled = levels.scan_totals(lines).first().lines_with_levels
    stamped = usage.timestamped_lines(lines).count()
    assert (leveled, stamped) == (20, 19)


def test_largest_cluster_and_histogram_agree(r):
    (top,) = r("top_cluster")
    apps = r("largest_cluster_apps")
    assert {x.cluster_id for x in apps} == {top.cluster_id}
    hist = r("duration_histogram")
    assert sum(x["count"] for x in hist) == len(apps) == hist[0].n
    assert sum(x.density * (x.bin_end - x.bin_start) for x in hist) == pytest.approx(1.0)


def test_daily_totals_recompute(r):
    days = r("daily_summary")
    (tot,) = r("daily_totals")
    assert tot.num_days == len(days)
    assert tot.total_trips == sum(x.num_trips for x in days) == r("year_filter_count")[0].filtered_rows
    assert [(x.dt_year, x.dt_month, x.dt_day) for x in days] == sorted(
        ((x.dt_year, x.dt_month, x.dt_day) for x in days), reverse=True)


def test_timestamp_parse_matches_python_on_random_text(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(3000):
        parts = [rng.randint(0, 99), rng.randint(0, 14), rng.randint(0, 33),
                 rng.randint(0, 25), rng.randint(0, 61), rng.randint(0, 61)]
        texts.append("%02d/%02d/%02d %02d:%02d:%02d" % tuple(parts))
    df = spark.createDataFrame([(t,) for t in texts], ["t"])
    got = {x.t: x.ts for x in df.select("t", parse.to_log_timestamp("t").alias("ts")).collect()}
    for t in texts:
        try:
            want = datetime.strptime("20" + t, "%Y/%m/%d %H:%M:%S")
        except ValueError:
            want = None
        assert got[t] == want, t
