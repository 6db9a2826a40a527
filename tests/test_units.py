"""Rules that need no reference table: names, medians, edges, sinks, calibration, persistence, streams."""

from __future__ import annotations

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pitfeat.functions import numbers, text
from pitfeat.operators import aggregates, calibrate, clean, features, metrics, models, quality, splits, staking
from pitfeat.plans.gold import MatchTables, attach_prices
from pitfeat.sources import pages, tables
from pitfeat.streaming.polls import poll_quotes, upsert_stream


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


# --- names ---------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", [
    "f_1_r3_knockdowns", "r2_total", "xr5_duration", "f_1_total_strikes_succ", "f_2_sig_strikes_att", "f_1_knockdowns", "f_2_submission_att",
    "f_1_ctrl_time_sec", "fight_duration_s", "finish_round", "finish_time", "f_2_reversals", "f_1_td_2_att", "f_2_takedown_succ"])
def test_leaks(name):
    assert clean.leaks(name)
    hits = [p for p in clean.LEAK_PATTERNS if clean.leaks(name, [p])]
    assert hits


@pytest.mark.parametrize("name", ["f_1_total_strikes_succ_m3", "delta_knockdowns_m5", "f_1_fighter_weight", "r6_x", "f_3_knockdowns"])
def test_no_leak(name):
    assert not clean.leaks(name)


def test_every_pattern_is_needed():
    assert len(clean.LEAK_PATTERNS) == 14


def test_feature_groups():
    assert features.feature_group("f_1_percentage") == "physical"
    assert features.feature_group("f_1_odds_3_x") == "odds"
    assert features.feature_group("sig_3_mean") == "rolling"
    assert features.feature_group("sig_16_mean") == "other"
    assert features.feature_group("f_1_fighter_SlpM") == "career"
    assert features.feature_group("x_m3") == "other"


# --- values --------------------------------------------------------------------------------------------------------

def test_text_edges(spark):
    clock = lambda s: one(spark, text.clock_to_seconds(F.lit(s).cast("string")))
    assert [clock(s) for s in ("4:05", "0:07", "12", "1:2:3", "--", None, "a:3", " 3 : 10 ")] == [245, 7, 12, 0, 0, 0, 0, 190]
    pair = lambda s: tuple(one(spark, text.split_x_of_y(F.lit(s))))
    assert pair("46 of 120") == ("46", "120") and pair("46") == ("", "") and pair("1 of 2 of 3") == ("", "")
    assert one(spark, text.slugify(F.lit("  Ána & Bo! "))) == "na-bo" and one(spark, text.slugify(F.lit(None).cast("string"))) == "unknown"
    kinds = [one(spark, text.outcome_class(F.lit(s).cast("string"))) for s in ("TKO - knees", "Submission", "Decision - split", "DQ", None)]
    assert kinds == ["KO_TKO", "SUB", "DEC", "OTHER", "OTHER"]
    assert one(spark, text.norm_key(F.lit("\t http://x/a// \n"))) == "http://x/a"


def test_kelly_edges(spark):
    stake = lambda p, o: one(spark, numbers.kelly(F.lit(p), F.lit(o)))
    assert stake(0.6, 2.0) == pytest.approx(0.2) and stake(0.4, 2.0) == 0 and stake(0.9, 1.0) == 0 and stake(1.0, 3.0) == 1.0


def test_softmax(spark):
    p = one(spark, numbers.softmax(F.array(F.lit(1000.0), F.lit(1001.0), F.lit(-5.0)), 2.0))
    e = np.exp((np.array([1000.0, 1001.0, -5.0]) - 1001) / 2)
    assert np.allclose(p, e / e.sum()) and one(spark, numbers.renormalise(F.array(F.lit(0.0), F.lit(0.0)))) == [0, 0]


@pytest.mark.parametrize("exact_rows", [5, 50, 10_000])
def test_medians(spark, exact_rows):
    rng = random.Random(3)
    data = {"even": [rng.gauss(0, 1) for _ in range(400)], "odd": [rng.gauss(0, 1e6) for _ in range(399)] + [None], "ties": [1.0] * 250 + [2.0] * 150,
            "split": [0.0] * 200 + [10.0] * 200, "wide": [10.0 ** rng.randrange(-9, 9) for _ in range(399)] + [float("nan")], "none": [None] * 400}
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data))
    got = aggregates.exact_medians(df, list(data), exact_rows)
    for c, values in data.items():
        clean_values = [v for v in values if v is not None and not math.isnan(v)]
        want = float(np.median(clean_values)) if clean_values else None
        assert got[c] == pytest.approx(want) if want is not None else got[c] is None, c


def test_thresholds_and_bins_at_their_edges(spark):
    edges = [float(e) for e in np.linspace(0, 1, 11)]
    values = sorted({*edges, *metrics.THRESHOLDS, *[math.nextafter(e, -1) for e in [*edges, *metrics.THRESHOLDS]], *[math.nextafter(e, 2) for e in metrics.THRESHOLDS], 0.0, 1.0, -0.5, 1.5})
    rows = spark.createDataFrame([(v,) for v in values], "p double").select("p", metrics.thresholds_passed(F.col("p"), metrics.THRESHOLDS).alias("n"), metrics.bin_index(F.col("p")).alias("b")).collect()
    for r in rows:
        assert r["n"] == sum(t <= r["p"] for t in metrics.THRESHOLDS), r
        assert r["b"] == int(np.clip(np.digitize(r["p"], np.linspace(0, 1, 11)) - 1, 0, 9)), r


def test_policy_scores_by_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.random(), rng.randrange(2), round(1.01 + rng.random() * 3, 2), round(1.01 + rng.random() * 3, 2) if i % 11 else None, f"e{i % 9}") for i in range(300)]
    df = spark.createDataFrame(rows, "p double, y int, price_1 double, price_2 double, event string")
    got = {r["policy"]: r for r in staking.policy_scores(df, event="event", max_exposure=0.2).collect()}
    for i, g in enumerate(staking.GRID):
        placed = staking.place_bets(df, g, "event", ["p"], None, 0.2) if i % 27 == 5 else None
        if placed is not None:
            want = staking.roi_summary(placed).first()
            assert got[i]["total_wager"] == pytest.approx(want["total_wager"]) and got[i]["n_bets"] == want["n_bets"]
            assert got[i]["roi"] == pytest.approx(want["roi"] if want["n_bets"] else -1e9)
            assert got[i]["sharpe"] == pytest.approx(want["sharpe_per_bet"] if want["n_bets"] else -1e9, abs=1e-9)
    assert staking.tune_policy(df.where("p > 2")) == staking.DEFAULT_POLICY


def test_temporal_split_needs_order(spark):
    with pytest.raises(ValueError):
        splits.temporal_split(spark.range(1), "id", 2, 2)


def test_calendar():
    cal = splits.fold_calendar()
    assert all(a[2] == b[1] for a, b in zip(cal, cal[1:])) and len(splits.last_folds(splits.fold_calendar(step_days=30))) == 12


# --- data checks ---------------------------------------------------------------------------------------------------

def test_suites_cover_all_tables():
    assert [s.name for s in quality.SUITES] == ["events_raw", "fights_raw", "fight_stats_raw", "odds_raw", "rankings_raw", "fights_silver", "odds_silver", "rankings_silver", "gold_features"]


def test_price_suite(spark):
    df = spark.createDataFrame([("http://a", "1.5", "x"), ("http://a", "0.9", "2000"), (None, None, "3")], "fight_url string, odds_f1 string, odds_f2 string")
    report = quality.run_suite(df, next(s for s in quality.SUITES if s.name == "odds_raw"))
    found = {(r["check"], r["column"]): r["violations"] for r in report.collect()}
    assert found[("between", "odds_f1")] == 1 and found[("between", "odds_f2")] == 1  # text that is no number is null and passes
    assert found[("not_null", "fight_url")] == 1 and found[("matches", "fight_url")] == 0 and found[("has_column", "region")] == 1
    assert quality.failures(report) == 6


# --- tables --------------------------------------------------------------------------------------------------------

def test_csv_and_layers(spark, tmp_path):
    (tmp_path / "in.csv").write_text("name,event_date,price\na,2024-01-02,1.5\nb,soon,x\n")
    df = tables.read_csv_typed(spark, str(tmp_path / "in.csv"), "name string, event_date string, price double", ["event_date"])
    rows = {r["name"]: r for r in df.collect()}
    assert rows["a"]["event_date"] == dt.datetime(2024, 1, 2) and rows["b"]["event_date"] is None and rows["b"]["price"] is None
    tables.write_layer(df, str(tmp_path), "silver", "t")
    assert tables.read_layer(spark, str(tmp_path), "silver", "t").count() == 2
    assert tables.read_layer(spark, str(tmp_path), "gold", "none", required=False) is None
    out = tables.write_csv(df, str(tmp_path / "out"), dt.datetime(2024, 5, 6, 7, 8, 9))
    assert out.endswith("out_20240506_070809") and spark.read.csv(out, header=True).count() == 2
    tables.write_report(df, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "s")
    batch = lambda *rows: spark.createDataFrame(rows, "k string, v int, pos int")
    assert tables.latest_version(spark, root) is None
    assert tables.upsert_table(spark, root, batch(("a", 1, 1), ("a", 2, 2), ("None", 9, 3)), ["k"], "pos") == 1
    assert tables.upsert_table(spark, root, batch(("a", 3, 1), ("b", 4, 1)), ["k"], "pos") == 2
    assert sorted(map(tuple, tables.read_snapshot(spark, root).collect())) == [("a", 3), ("b", 4)]
    grown = str(tmp_path / "g")
    tables.append_new(spark, grown, batch(("a", 1, 1), ("a", 2, 2)), ["k"], "pos")
    tables.append_new(spark, grown, batch(("a", 7, 1), ("c", 5, 1)), ["k"], "pos")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(grown).collect()) == [("a", 2), ("c", 5)]


def test_registry(spark, tmp_path):
    reg = str(tmp_path / "runs")
    for day, path in ((1, "old"), (3, "new"), (2, "mid")):
        tables.register_run(spark, reg, "stack", path, json.dumps({"threshold": 0.5}), dt.datetime(2024, 1, day))
    assert tables.latest_run(spark, reg, "stack")["path"] == "new"


def test_price_polls(spark, tmp_path):
    def entry(price, at):
        return json.dumps({"id": "e", "sport_key": "s", "sport_title": "", "commence_time": "2024-01-01T00:00:00Z", "home_team": "A", "away_team": "B", "bookmakers": [
            {"key": "k", "title": "K", "last_update": at, "markets": [{"key": "h2h", "outcomes": [{"name": "A", "price": price}, {"name": "B", "price": 2.0}]}]}]})

    folder = tmp_path / "in"
    folder.mkdir()
    root = str(tmp_path / "quotes")
    for i, price in enumerate((1.5, 1.7)):
        (folder / f"{i}.json").write_text(entry(price, f"2024-01-0{i + 1}") + "\n")
        upsert_stream(poll_quotes(spark, str(folder)), root, str(tmp_path / "cp")).awaitTermination()
    rows = tables.read_snapshot(spark, root).collect()
    assert [(r["event_name"], r["odds_f1"]) for r in rows] == [("A vs B", 1.7)]


def test_listing_needs_link_title_and_date(spark):
    row = '<tr class="b-statistics__table-row">{}</tr>'
    good = row.format('<td><a href="http://x/1/">One &amp; two</a><span>March 5, 2024</span></td>')
    bad = row.format("<td><a>none</a><span>March 5, 2024</span></td>") + row.format('<a href="h">t</a><span>soon</span>')
    rows = pages.extract_listing(spark.createDataFrame([(1, good + bad)], "page_id long, html string")).collect()
    assert [(r["event_url"], r["event_date"], r["title"]) for r in rows] == [("http://x/1", "2024-03-05", "One & two")]


def test_prices_follow_names(spark):
    pairs = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "fight_url long, f1_fighter_name string, f2_fighter_name string")
    prices = spark.createDataFrame([(1, "b", 3.0, 1.4), (2, "c", 1.8, 2.1)], "fight_url long, n1 string, o1 double, o2 double")
    out = {r["fight_url"]: (r["price_1"], r["price_2"]) for r in attach_prices(pairs, prices, "fight_url", "o1", "o2", "n1").collect()}
    assert out == {1: (1.4, 3.0), 2: (1.8, 2.1)}
    assert len(MatchTables().rolled) == 16 * 5 and len(MatchTables().summed) == 9 * 5


# --- models --------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        p, seg = rng.random(), f"s{i % 3}" if i % 40 else "rare"
        rows.append((i, p, int(rng.random() < (p if seg != "s1" else p * p)), seg))
    return spark.createDataFrame(rows, "id long, p double, y int, seg string").cache()


def test_segment_platt_equals_single_fits(scored):
    fit = calibrate.fit_segment_platt(scored, "p", "y", "seg")
    own = {r["segment"]: r for r in fit.table.collect()}
    assert set(own) == {"s0", "s1", "s2"}
    for seg, r in own.items():
        single = calibrate.fit_platt(scored.where(F.col("seg") == seg), "p", "y")
        assert (r["slope"], r["intercept"]) == pytest.approx((single.slope, single.intercept), abs=1e-4)
    overall = calibrate.fit_platt(scored, "p", "y")
    assert (fit.overall.slope, fit.overall.intercept) == pytest.approx((overall.slope, overall.intercept), abs=1e-4)
    rare = fit.apply(scored.where("seg = 'rare'"), "p", "c", "seg").first()
    assert rare["c"] == pytest.approx(1 / (1 + math.exp(-(overall.slope * rare["p"] + overall.intercept))), abs=1e-4)


def test_isotonic_is_monotone_and_flat_outside(spark, scored):
    fit = calibrate.fit_isotonic(scored.where("p between 0.1 and 0.9"), "p", "y")
    got = [r["c"] for r in fit.apply(spark.range(101).select((F.col("id") / 100).alias("p")), "p", "c").orderBy("p").collect()]
    assert all(a <= b + 1e-12 for a, b in zip(got, got[1:])) and len(set(got[:9])) == 1 and len(set(got[92:])) == 1


def test_temperature_forms_agree(scored):
    df = scored.withColumn("logits", F.array("p", 1 - F.col("p"), F.lit(0.2)))
    a, b = [[r["nll"] for r in calibrate.temperature_scores(df, "logits", "y", classes=c).orderBy("pos").collect()] for c in (None, 3)]
    assert a == pytest.approx(b) and calibrate.fit_temperature(df, "logits", "y") in calibrate.TEMPERATURES


def test_auc_by_pairs(scored):
    rows = scored.withColumn("p", F.round("p", 1)).toPandas()
    pos, neg = rows[rows["y"] == 1]["p"].values, rows[rows["y"] == 0]["p"].values
    want = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))
    df = scored.withColumn("p", F.round("p", 1))
    assert metrics.auc(df, "p", "y").first()["roc_auc"] == pytest.approx(want)
    assert metrics.auc(df.withColumn("g", F.lit(1)), "p", "y", ["g"], hot_rows=3).first()["roc_auc"] == pytest.approx(want)


def test_models_are_saved_and_probabilities_sum_to_one(scored, tmp_path):
    df = scored.withColumns({"q": F.when(F.col("id") % 7 > 0, F.col("p") * 2), "cls": F.concat(F.lit("c"), F.col("id") % 3)})
    imputer = features.GroupImputer(inputCols=["p", "q"], groups={"q": "physical"}).fit(df)
    assert imputer.feature_names() == ["p", "q", "p_missing", "q_missing"]
    ready = imputer.transform(df)
    model = models.fit_logistic(ready, imputer.feature_names(), "y")
    bundle = models.Bundle(["p", "q"], imputer, {"m": model})
    bundle.save(str(tmp_path / "run"))
    trees = models.fit_trees_multiclass(ready, ["p", "q"], "cls", maxIter=1, maxDepth=2)
    whole = models.Bundle(["p", "q"], imputer, {"m": model}, models.fit_stacker(models.with_prob(ready, model, "m_prob"), ["m_prob"], "y"), 0.4,
                          {"m": calibrate.Platt(1.5, -0.5)}, {"cls": trees}, {"cls": 1.5})
    whole.save(str(tmp_path / "whole"))
    loaded = models.Bundle.load(df.sparkSession, str(tmp_path / "whole"))
    a, b = [[repr(r) for r in models.score(df, x, ["id"]).orderBy("id").collect()] for x in (whole, loaded)]
    assert a == b and loaded.calibrators == whole.calibrators and loaded.threshold == 0.4
    again = features.GroupImputerModel.load(str(tmp_path / "run" / "imputer")).transform(df)
    reloaded = PipelineModel.load(str(tmp_path / "run" / "base_m"))
    a = models.with_prob(ready, model, "r").agg(F.sum("r")).first()[0]
    assert models.with_prob(again, reloaded, "r").agg(F.sum("r")).first()[0] == pytest.approx(a)
    trees = models.fit_trees_multiclass(ready, ["p", "q"], "cls", maxIter=1, maxDepth=2)
    probs = trees.transform(ready)
    assert quality.prob_sum(probs, "probs").first()["success"]
    cooled = calibrate.apply_temperature(trees.logits(probs), "logits", 2.0, "t")
    assert quality.prob_sum(cooled, "t").first()["success"]


def test_search_draws_are_repeatable():
    a, b = [models.sample_params(models.SEARCH_SPACE, 5, 42) for _ in range(2)]
    assert a == b and all(0.5 <= t["featureFraction"] <= 0.9 and 20 <= t["minInstancesPerNode"] < 400 for t in a)
