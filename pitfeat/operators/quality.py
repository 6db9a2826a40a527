"""Declarative data checks. A suite costs one aggregate pass over its table, plus one grouping per uniqueness check."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitfeat.functions.text import to_number
from pitfeat.functions.numbers import array_sum, nan_to_null


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    args: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Suite:
    name: str
    layer: str
    checks: Sequence[Check]


def columns_match(*names: str) -> Check:
    return Check("columns_match", None, {"names": sorted(names)})


def has_column(column: str) -> Check:
    return Check("has_column", column)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def matches(column: str, regex: str) -> Check:
    return Check("matches", column, {"regex": regex})


def between(column: str, lo: float | None = None, hi: float | None = None) -> Check:
    return Check("between", column, {"lo": lo, "hi": hi})


def date_parseable(column: str) -> Check:
    return Check("date_parseable", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def _violation(df: DataFrame, check: Check) -> Column | None:
    """Row predicate that is true for a violating row, for the checks that look at rows."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "matches":
        return ~c.cast("string").rlike(check.args["regex"])
    if check.kind == "between":
        number = to_number(c) if dict(df.dtypes)[check.column] == "string" else nan_to_null(c.cast("double"))
        low = number < check.args["lo"] if check.args["lo"] is not None else F.lit(False)
        high = number > check.args["hi"] if check.args["hi"] is not None else F.lit(False)
        return low | high
    if check.kind == "date_parseable":
        return c.isNotNull() & F.try_to_timestamp(c.cast("string")).isNull()
    return None





def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per check: suite, position, kind, column, args, rows, violations, success.

    A check of unknown kind, or on an absent column, fails. Nulls violate only ``not_null``.
    """
    spark = df.sparkSession
    violations: list[Column] = []
    uniques: list[tuple[int, str]] = []
    known: list[tuple] = []
    for i, check in enumerate(suite.checks):
        problem = None
        if check.kind == "columns_match":
            problem = len(set(df.columns) ^ set(check.args["names"]))
        elif check.kind == "has_column":
            problem = 0 if check.column in df.columns else 1
        elif check.column not in df.columns:
            problem = 1
        elif check.kind == "unique":
            uniques.append((i, check.column))
        else:
            bad = _violation(df, check)
            if bad is None:
                problem = 1
            else:
                violations.append(F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"v{i}"))
        known.append((i, check.kind, check.column, json.dumps(check.args, sort_keys=True), problem))
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *violations)
    counted = {f for f in totals.columns if f != "rows"}
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(kind).alias("check"), F.lit(column).cast("string").alias("column"), F.lit(args).alias("args"),
                 (F.col(f"v{i}") if f"v{i}" in counted else F.lit(problem).cast("long")).alias("violations"))
        for i, kind, column, args, problem in known])
    report = totals.select("rows", F.explode(entries).alias("e")).select("rows", "e.*")
    if uniques:
        # a repeated value is a violation once per repetition; pre-counted per value, so a hot value is no problem
        repeated = reduce(DataFrame.unionByName, [
            df.where(F.col(c).isNotNull()).groupBy(c).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("repeats")).withColumn("pos", F.lit(i))
            for i, c in uniques])
        report = (report.join(repeated, F.col("position") == F.col("pos"), "left")
                  .withColumn("violations", F.coalesce("violations", "repeats")).drop("pos", "repeats"))
    return report.select(F.lit(suite.name).alias("suite"), F.lit(suite.layer).alias("layer"), "position", "check", "column",
                         "args", "rows", "violations", (F.col("violations") == 0).alias("success"))


def run_suites(tables: Mapping[str, DataFrame | None], suites: Sequence[Suite]) -> DataFrame | None:
    """All suites whose table is there; absent tables are skipped."""
    reports = [run_suite(tables[s.name], s) for s in suites if tables.get(s.name) is not None]
    return reduce(DataFrame.unionByName, reports) if reports else None


def summarise(report: DataFrame) -> DataFrame:
    return report.groupBy("suite").agg(F.max("rows").alias("rows"), F.count(F.lit(1)).alias("checks"),
                                       F.sum((~F.col("success")).cast("long")).alias("failed"))


def failures(report: DataFrame) -> int:
    return report.where(~F.col("success")).count()


# The checks of each layer table.
HTTP = "^http"
PRICE_RANGE = (1.01, 1000)
RANK_RANGE = (1, 20)

SUITES = [
    Suite("events_raw", "raw", [
        columns_match("event_url", "event_date", "title"),
        not_null("event_url"), not_null("event_date"),
        matches("event_url", HTTP), date_parseable("event_date"),
    ]),
    Suite("fights_raw", "raw", [
        columns_match("fight_url", "event_url"),
        not_null("fight_url"), not_null("event_url"),
        matches("fight_url", HTTP), matches("event_url", HTTP),
    ]),
    Suite("fight_stats_raw", "raw", [
        *[has_column(c) for c in (
            "fight_url", "fighter_name", "weight_class", "sig_strikes_succ", "sig_strikes_att", "total_strikes_succ",
            "total_strikes_att", "takedown_succ", "takedown_att", "submission_att", "reversals", "ctrl_time")],
        not_null("fight_url"), matches("fight_url", HTTP), not_null("fighter_name"),
        *[between(c, 0) for c in (
            "sig_strikes_succ", "sig_strikes_att", "total_strikes_succ", "total_strikes_att", "takedown_succ", "takedown_att")],
    ]),
    Suite("odds_raw", "raw", [
        *[has_column(c) for c in ("fight_url", "odds_f1", "odds_f2", "event_date", "source", "region")],
        not_null("fight_url"), matches("fight_url", HTTP),
        between("odds_f1", *PRICE_RANGE), between("odds_f2", *PRICE_RANGE),
    ]),
    Suite("rankings_raw", "raw", [
        columns_match("rank_date", "fighter", "weight_class", "rank"),
        not_null("rank_date"), date_parseable("rank_date"), not_null("fighter"), between("rank", *RANK_RANGE),
    ]),
    Suite("fights_silver", "silver", [
        columns_match("fight_url", "event_url", "event_date", "event_name"),
        not_null("fight_url"), not_null("event_date"), matches("fight_url", HTTP), matches("event_url", HTTP),
    ]),
    Suite("odds_silver", "silver", [
        *[has_column(c) for c in ("fight_url", "odds_f1", "odds_f2", "imp_f1_vigfree", "imp_f2_vigfree")],
        not_null("fight_url"), between("odds_f1", *PRICE_RANGE), between("odds_f2", *PRICE_RANGE),
        between("imp_f1_vigfree", 0.0, 1.0), between("imp_f2_vigfree", 0.0, 1.0),
    ]),
    Suite("rankings_silver", "silver", [
        columns_match("fight_url", "event_date", "fighter_name", "rank", "weight_class"),
        not_null("fight_url"), not_null("event_date"), not_null("fighter_name"), between("rank", *RANK_RANGE),
    ]),
    Suite("gold_features", "gold", [
        *[has_column(c) for c in ("fight_url", "event_date", "f1_fighter_name", "f2_fighter_name")],
        not_null("fight_url"), not_null("event_date"), unique("fight_url"),
    ]),
]

# Per table the layer, whether it must be there, its columns, and its web-address columns.
LAYERS = {
    "events_raw": ("raw", True, ["event_url", "event_date", "title"], ["event_url"]),
    "fights_raw": ("raw", True, ["fight_url", "event_url"], ["fight_url"]),
    "fight_stats_raw": ("raw", True, ["fight_url", "fighter_name"], []),
    "odds_raw": ("raw", False, ["fight_url", "odds_f1", "odds_f2"], []),
    "rankings_raw": ("raw", False, ["rank_date", "fighter", "weight_class", "rank"], []),
    "fights_silver": ("silver", True, ["fight_url", "event_url", "event_date", "event_name"], []),
    "odds_silver": ("silver", False, ["fight_url", "odds_f1", "odds_f2", "imp_f1_vigfree", "imp_f2_vigfree"], []),
    "rankings_silver": ("silver", False, ["fight_url", "event_date", "fighter_name", "rank"], []),
    "gold_features": ("gold", False, ["fight_url"], []),
}


def layer_contracts(tables: Mapping[str, DataFrame | None], spark: SparkSession, layers: Mapping[str, tuple] = LAYERS) -> DataFrame:
    """Required tables exist, needed columns exist, web addresses start with http; optional tables only if present."""
    parts = []
    missing = [(n, layers[n][0], 0, "table_exists", None, "{}", 0, 1, False) for n in layers if layers[n][1] and tables.get(n) is None]
    for name, (layer, _, columns, addresses) in layers.items():
        if tables.get(name) is not None:
            parts.append(run_suite(tables[name], Suite(name, layer, [*map(has_column, columns), *[matches(a, HTTP) for a in addresses]])))
    schema = "suite string, layer string, position int, check string, column string, args string, rows long, violations long, success boolean"
    if missing or not parts:
        parts.append(spark.createDataFrame(missing, schema))
    return reduce(DataFrame.unionByName, parts)


# Limits of the match-table checks.
MIN_AGE = 18
HEIGHT_RANGE = (140, 230)
FAVOURITE_RANGE = (0.5, 0.95)


def sanity_report(df: DataFrame, now: dt.datetime, names: Mapping[str, str] | None = None) -> DataFrame:
    """Severity rows (check, severity, n, triggered) for a match table, in one pass plus one key count.

    ``names`` maps the roles event_date, winner, winner_encoded, age, height, price_1, price_2, key to columns;
    checks whose columns are absent are left out.
    """
    # Default column of each role.
    role = {"event_date": "event_date", "winner": "winner", "winner_encoded": "winner_encoded", "age": "f_1_fighter_age",
            "height": "f_1_fighter_height_cm", "price_1": "f_1_odds", "price_2": "f_2_odds", "key": "fight_url", **(names or {})}
    have = {r: c in df.columns for r, c in role.items()}

    def c(r: str) -> Column:
        return F.col(role[r])

    def n(pred: Column) -> Column:
        return F.sum(F.when(pred, 1).otherwise(0)).cast("double")

    checks: list[tuple[str, str, Column, Column]] = []  # name, severity, figure, triggered given the figure x
    x = F.col("x")
    if have["event_date"]:
        checks.append(("future_dates", "warning", n(c("event_date") > F.lit(now)), x > 0))
    for target in ("winner", "winner_encoded"):
        if have[target]:
            checks.append((f"missing_{target}", "error", n(c(target).isNull()), x > 0))
    if have["age"]:
        checks.append(("under_age", "error", n(c("age") < MIN_AGE), x > 0))
    if have["height"]:
        checks.append(("height_low", "warning", n(c("height") < HEIGHT_RANGE[0]), x > 0))
        checks.append(("height_high", "warning", n(c("height") > HEIGHT_RANGE[1]), x > 0))
    if have["price_1"] and have["price_2"] and have["winner_encoded"]:
        # the side with the shorter price won; equal prices make side 2 the favourite, a price that is not positive nobody
        priced = (c("price_1").cast("double") > 0) & (c("price_2").cast("double") > 0)
        shorter = F.when(priced, F.when(c("price_1").cast("double") < c("price_2").cast("double"), 1).otherwise(0))
        won = shorter == c("winner_encoded")
        full = c("price_1").isNotNull() & c("price_2").isNotNull() & c("winner_encoded").isNotNull()
        rate = F.avg(F.when(full, F.coalesce(won, F.lit(False)).cast("double")))
        checks.append(("favourite_wins_too_often", "error", rate, x > FAVOURITE_RANGE[1]))
        checks.append(("favourite_wins_too_rarely", "warning", rate, x < FAVOURITE_RANGE[0]))
    figures = df.agg(*[f.alias(f"x{i}") for i, (_, _, f, _) in enumerate(checks)])
    entries = F.array(*[F.struct(F.lit(k).alias("check"), F.lit(s).alias("severity"), F.col(f"x{i}").alias("x"))
                        for i, (k, s, _, _) in enumerate(checks)])
    rows = figures.select(F.explode(entries).alias("e")).select("e.*")
    if have["key"]:
        dup = df.groupBy(role["key"]).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("double").alias("x"))
        rows = rows.unionByName(dup.select(F.lit("duplicate_keys").alias("check"), F.lit("warning").alias("severity"), "x"))
    triggered = F.when(F.col("check") == "favourite_wins_too_often", x > FAVOURITE_RANGE[1])
    triggered = triggered.when(F.col("check") == "favourite_wins_too_rarely", x < FAVOURITE_RANGE[0]).otherwise(x > 0)
    return rows.select("check", "severity", F.col("x").alias("figure"), F.coalesce(triggered, F.lit(False)).alias("triggered"))


def sanity_passed(report: DataFrame) -> bool:
    return report.where((F.col("severity") == "error") & F.col("triggered")).isEmpty()


def split_leak(df: DataFrame, ts: str, split: str = "split") -> DataFrame:
    """Each neighbouring pair of splits with the last time before and the first time after; leak when they touch."""
    ends = df.groupBy().agg(*[f for s in ("train", "val", "test") for f in (
        F.min(F.when(F.col(split) == s, F.col(ts))).alias(f"{s}_min"), F.max(F.when(F.col(split) == s, F.col(ts))).alias(f"{s}_max"))])
    pairs = F.array(*[F.struct(F.lit(a).alias("before"), F.lit(b).alias("after"), F.col(f"{a}_max").alias("before_max"),
                               F.col(f"{b}_min").alias("after_min")) for a, b in (("train", "val"), ("val", "test"))])
    rows = ends.select(F.explode(pairs).alias("p")).select("p.*")
    return rows.withColumn("leak", F.coalesce(F.col("before_max") >= F.col("after_min"), F.lit(False)))


# Lowest accuracy accepted per (model, split).
ACCURACY_FLOORS = {("stack", "val"): 0.71, ("stack", "test"): 0.62, ("parity", "val"): 0.72, ("parity", "test"): 0.60}


def metric_gate(metrics: DataFrame, floors: Mapping[tuple[str, str], float], metric: str = "accuracy") -> DataFrame:
    """One row per demanded (model, split): value found, floor, passed. A missing metric fails."""
    wanted = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("split"), F.lit(v).alias("floor")) for (m, s), v in floors.items()])
    rows = metrics.sparkSession.range(1).select(F.explode(wanted).alias("w")).select("w.*")
    found = metrics.groupBy("model", "split").agg(F.max(metric).alias("value"))
    return rows.join(found, ["model", "split"], "left").withColumn("passed", F.coalesce(F.col("value") >= F.col("floor"), F.lit(False)))


def prob_sum(df: DataFrame, probs: str, tol: float = 1e-6) -> DataFrame:
    """Rows, rows whose probability vector does not sum to 1, and whether none does."""
    off = F.abs(array_sum(F.col(probs)) - 1.0) > tol
    out = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(off).alias("violations"))
    return out.withColumn("success", F.col("violations") == 0)


def label_coverage(features: DataFrame, labels: DataFrame, key: str, group: str, label: str) -> DataFrame:
    """Per group (a year, say) and overall: rows, rows with a label row, their share, share of non-null labels."""
    marked = labels.groupBy(key).agg(F.max(F.col(label)).alias("_y")).withColumn("_hit", F.lit(1))
    joined = features.select(key, group).join(marked, key, "left")
    figures = [F.count(F.lit(1)).alias("n"), F.count("_hit").alias("covered"), F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("coverage"),
               F.avg(F.col("_y").isNotNull().cast("double")).alias("complete")]
    per = joined.groupBy(F.col(group).cast("string").alias("grp")).agg(*figures)
    # the overall row is folded from the per-group rows
    every = per.agg(F.sum("n").alias("n"), F.sum("covered").alias("covered"), (F.sum("covered") / F.sum("n")).alias("coverage"),
                    (F.sum(F.col("complete") * F.col("n")) / F.sum("n")).alias("complete")).withColumn("grp", F.lit("all"))
    return per.unionByName(every)
