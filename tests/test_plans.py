"""Plans stay the ones that scale: shuffles, early limits, pushed filters, no pair-wise joins, no Python in tasks."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest

from __spark_entry__ import queries
from pitfeat.operators.pit import pit_features
from tests.conftest import SF


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_all_history_windows_share_one_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(pit_features(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], ["o_totalprice"]))
    # sorted by time, by time read, and by time again
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 3
    assert "RangeFrame" not in text


@pytest.mark.parametrize("name", ["assign_side", "pair_sides", "dedupe_first", "upsert_last", "best_by"])
def test_first_rows_are_chosen_before_the_shuffle(spark, name):
    text = plan(queries()[name](spark, SF))
    assert text.index("WindowGroupLimit") < text.rindex("Exchange") < text.rindex("WindowGroupLimit")


def test_date_ranges_reach_the_scan(spark):
    text = plan(queries()["between_dates"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text and "o_totalprice" not in text


@pytest.mark.parametrize("name", ["gold_features", "asof_backward", "price_consensus", "policy_grid", "threshold_search", "best_threshold", "metrics_binary", "walk_forward_counts",
                                  "event_caps", "fold_sizes", "dq_suite", "page_stats", "price_feed_flat", "temperature_search"])
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in text
