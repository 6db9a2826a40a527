"""Ordered histories: the block path for hot keys must equal the plain path, and nothing may look ahead."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitfeat.operators.joins import asof_backward
from pitfeat.operators.ordered import BEFORE, HOT_ROWS, ordered_blocks, running, time_index, with_history
from pitfeat.operators.pit import pit_features, rolling
from pitfeat.operators.staking import cap_count, compound, drawdown


def same(a: pd.DataFrame, b: pd.DataFrame, key: list[str]) -> None:
    a, b = [x.sort_values(key, ignore_index=True)[sorted(x.columns)] for x in (a, b)]
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-9, atol=1e-9)


@pytest.fixture(scope="module")
def matches(spark):
    """One entity holds half of all rows; many rows share a day; some figures are missing."""
    rng = random.Random(7)
    start = dt.datetime(2015, 1, 1)
    rows = []
    for i in range(900):
        who = "hot" if i % 2 == 0 else f"e{rng.randrange(30)}"
        day = start + dt.timedelta(days=rng.choice([0, 1, 365, 366, 730, rng.randrange(1500)]))
        rows.append((who, day, i, None if rng.random() < 0.1 else float(rng.randrange(100))))
    return spark.createDataFrame(rows, "who string, day timestamp_ntz, id long, x double").repartition(4).cache()


KEYS = dict(by=["who"], ts="day", tie=["id"])


def test_pit_blocks_equal_plain_windows(matches):
    plain = pit_features(matches, **KEYS, measures=["x"]).toPandas()
    blocks = pit_features(matches, **KEYS, measures=["x"], hot_rows=40).toPandas()
    same(plain, blocks, ["id"])


def test_rolling_blocks_equal_plain_windows(matches):
    same(rolling(matches, **KEYS, means=["x"], sums=["x"]).toPandas(), rolling(matches, **KEYS, means=["x"], sums=["x"], hot_rows=40).toPandas(), ["id"])


def test_against_pandas(matches):
    got = pit_features(matches, **KEYS, measures=["x"], windows=[3], hot_rows=100).toPandas().set_index("id").sort_index()
    for _, g in matches.toPandas().sort_values(["day", "id"]).groupby("who"):
        want = pd.DataFrame({"id": g["id"]})
        want["x_m3"] = g["x"].rolling(3, min_periods=1).mean().shift(1)
        gap = g["day"].diff().dt.days.fillna(365 * 5)
        want["days_since"] = gap
        want["ordinal"] = range(len(g))
        want["avg_gap_3"] = gap.rolling(3, min_periods=1).mean().shift(1).fillna(gap)
        ones = pd.Series(1.0, index=g["day"])
        want["count_365d"] = ones.rolling("365D").sum().shift(1).fillna(0).values
        want["count_730d"] = ones.rolling("730D").sum().shift(1).fillna(0).values
        part = got.loc[want["id"], [c for c in want.columns if c != "id"]].reset_index(drop=True)
        pd.testing.assert_frame_equal(part, want.drop(columns="id").reset_index(drop=True), check_dtype=False, rtol=1e-9)


@pytest.mark.parametrize("hot_rows", [40, HOT_ROWS])
def test_later_rows_change_nothing(matches, hot_rows):
    cut = F.lit(dt.datetime(2016, 6, 1))
    full = pit_features(matches, **KEYS, measures=["x"], hot_rows=hot_rows).where(F.col("day") < cut).toPandas()
    changed = matches.where(F.col("day") < cut).unionByName(
        matches.where((F.col("day") >= cut) & (F.col("id") % 3 == 0)).withColumn("x", F.col("x") * 1000))
    after = pit_features(changed, **KEYS, measures=["x"], hot_rows=hot_rows).where(F.col("day") < cut).toPandas()
    same(full, after, ["id"])


def test_null_times_are_left_out(spark):
    rows = spark.createDataFrame([("a", None, 1, 1.0), ("a", dt.datetime(2020, 1, 1), 2, 2.0)], "who string, day timestamp_ntz, id long, x double")
    assert [r["id"] for r in pit_features(rows, **KEYS, measures=["x"]).collect()] == [2]


def test_running_kinds_in_blocks(matches):
    rows = matches.withColumn("f", 1 + F.col("x") / 1e6)
    totals = {"n": ("count", F.lit(1)), "s": ("sum", F.col("x")), "hi": ("max", F.col("x")), "lo": ("min", F.col("x")),
              "g": ("product", F.col("f")), "seen": ("last", F.col("x")), "b": ("sum", F.col("x"), BEFORE)}
    same(running(rows, ["who"], ["day", "id"], totals).toPandas(), running(rows, ["who"], ["day", "id"], totals, 30).toPandas(), ["id"])


def test_blocks_split_a_key(matches):
    hot = ordered_blocks(matches.where("who = 'hot'"), ["who"], ["day", "id"])
    assert hot.select("_block").distinct().count() > 3
    spans = hot.groupBy("_block").agg(F.min(F.struct("day", "id")).alias("a"), F.max(F.struct("day", "id")).alias("b")).orderBy("_block").collect()
    assert all(p["b"] < n["a"] for p, n in zip(spans, spans[1:]))


def test_history_copies_reach_over_short_blocks(spark):
    """Blocks shorter than the look-back: copies come from several blocks before."""
    rows = spark.range(30).select(F.lit("a").alias("who"), F.col("id").alias("t"))
    shown = with_history(rows, ["who"], ["t"], 12).toPandas()
    for block, g in shown.groupby("_block"):
        own = g[~g["_copy"]]["t"]
        want = set(range(max(0, own.min() - 12), own.min()))
        assert set(g[g["_copy"]]["t"]) == want and (g["_start"] == max(0, own.min() - 12)).all()


def test_asof_in_blocks(spark, matches):
    timeline = matches.where("id % 3 = 0").select("who", F.col("day").alias("at"), F.col("id").alias("r"), F.when(F.col("id") % 2 == 0, F.col("x")).alias("v"))
    args = (timeline, ["who"], "day", "at", ["r", "v"], ["r"], ["id"])
    plain, blocks = asof_backward(matches, *args).toPandas(), asof_backward(matches, *args, hot_rows=30).toPandas()
    same(plain, blocks, ["id"])
    known = timeline.toPandas().sort_values(["at", "r"])
    for row in plain.sample(60, random_state=1).itertuples():
        past = known[(known["who"] == row.who) & (known["at"] <= row.day)]
        assert (pd.isna(row.r) if past.empty else row.r == past.iloc[-1]["r"])


def test_time_index(matches):
    got = time_index(matches, ["day", "id"]).toPandas().sort_values("idx")
    assert list(got["idx"]) == list(range(900))
    assert list(got["id"]) == list(matches.toPandas().sort_values(["day", "id"])["id"])


def test_stakes_in_blocks(matches):
    rows = matches.withColumns({"fraction": F.when(F.col("x") > 50, F.col("x") / 10000).otherwise(0.0), "unit_profit": F.when(F.col("id") % 3 == 0, 1.5).otherwise(-1.0),
                                "profit": F.coalesce(F.col("x") - 50, F.lit(0.0))})
    same(cap_count(rows, "who", ["day", "id"], 5).toPandas(), cap_count(rows, "who", ["day", "id"], 5, hot_rows=20).toPandas(), ["id"])
    same(drawdown(rows, ["day", "id"], by=["who"]).toPandas(), drawdown(rows, ["day", "id"], by=["who"], hot_rows=20).toPandas(), ["id"])
    whole = drawdown(rows, ["day", "id"]).toPandas().sort_values(["day", "id"])
    cum = whole["profit"].cumsum()
    assert (abs(whole["drawdown"] - (cum - cum.cummax())) < 1e-9).all()
    equity = compound(rows, ["day"], 1000.0).toPandas().sort_values("day")
    bank = 1000.0
    events = rows.toPandas()
    for e in equity.itertuples():
        assert abs(e.event_start_bankroll - bank) < 1e-6
        part = events[events["day"] == e.day]
        bank += (bank * part["fraction"] * part["unit_profit"]).sum()
        assert abs(e.bankroll - bank) < 1e-6


@pytest.mark.parametrize("hot_rows", [3, HOT_ROWS])
@pytest.mark.parametrize("who", ["a", None])
def test_counts_with_repeated_ties_and_null_entities(spark, hot_rows, who):
    rows = spark.createDataFrame([(who, dt.datetime(2020, 1, 1) + dt.timedelta(days=k), k % 2, 1.0) for k in range(12)], "who string, day timestamp_ntz, id long, x double")
    got = pit_features(rows, **KEYS, windows=[], hot_rows=hot_rows).orderBy("day").collect()
    assert [r["count_365d"] for r in got] == list(range(12)) and [r["ordinal"] for r in got] == list(range(12))
    now = pit_features(rows, **KEYS, windows=[], horizons=[3], anchor="current", hot_rows=hot_rows).orderBy("day").collect()
    assert [r["count_3d"] for r in now] == [0, 1, *[2] * 10]


def test_counts_within_a_long_dense_history_are_linear(spark):
    rows = spark.range(80_000).select(F.lit("a").alias("who"), (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id"))).alias("day"), "id")
    got = pit_features(rows, **KEYS, windows=[]).agg(F.max("count_365d"), F.sum("count_365d")).first()
    assert tuple(got) == (79_999, 80_000 * 79_999 // 2)
