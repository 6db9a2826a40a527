"""Walk-forward and yearly back-tests."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pitfeat.operators import metrics
from pitfeat.operators.calibrate import SegmentPlatt, fit_segment_platt
from pitfeat.operators.clean import binary_only
from pitfeat.operators.features import GroupImputer
from pitfeat.operators.models import PARALLEL_FITS, fit_logistic, fit_trees_binned, pick_candidate, with_prob
from pitfeat.operators.ordered import time_index
from pitfeat.operators.splits import MIN_TRAIN, usable_folds, year_window
from pitfeat.operators.staking import DEFAULT_POLICY, GRID, Policy, place_bets, roi_summary, tune_policy, yearly_compounding
from pitfeat.session import durable

Fitter = Callable[[DataFrame, Sequence[str], str], object]

CANDIDATES: Mapping[str, Fitter] = {
    "logistic": fit_logistic,
    "trees": lambda df, features, y: fit_trees_binned(df, features, y),
}


@dataclass(frozen=True)
class Setup:
    features: Sequence[str]
    y: str
    ts: str
    key: str
    event: str
    segment: str
    price_1: str = "price_1"
    price_2: str = "price_2"
    candidates: Mapping[str, Fitter] = field(default_factory=lambda: dict(CANDIDATES))
    grid: Sequence[Policy] = tuple(GRID)
    objective: str = "roi"
    max_bets: int | None = 999
    max_exposure: float | None = 0.2

    def carried(self) -> list[str]:
        return list(dict.fromkeys([self.key, self.ts, self.event, self.segment, self.price_1, self.price_2, self.y]))


def choose_model(inner: DataFrame, tail: DataFrame, cfg: Setup, keep: Sequence[str] | None = None) -> tuple[object, SegmentPlatt, DataFrame]:
    """Fit all candidates, calibrate each per segment on the tail, keep the one with the lowest calibrated Brier score.

    The calibrated tail has the columns ``keep`` (all carried ones by default), which must include outcome and segment.
    """
    fitted, scores = {}, []
    for name, fit in cfg.candidates.items():
        model = fit(inner, cfg.features, cfg.y)
        scored = durable(with_prob(tail, model, "_raw").select(*(cfg.carried() if keep is None else keep), "_raw"))
        calibrator = fit_segment_platt(scored, "_raw", cfg.y, cfg.segment)
        calibrated = calibrator.apply(scored, "_raw", "p", cfg.segment)
        fitted[name] = (model, calibrator, calibrated)
        scores.append(metrics.brier(calibrated, "p", cfg.y).withColumn("model", F.lit(name)))
    best = pick_candidate(reduce(DataFrame.unionByName, scores)).first()["model"]
    return fitted[best]


def _as_bets(df: DataFrame, cfg: Setup) -> DataFrame:
    return df.withColumns({"y": F.col(cfg.y), "price_1": F.col(cfg.price_1), "price_2": F.col(cfg.price_2)})


def walk_forward_backtest(df: DataFrame, cfg: Setup, calendar: Sequence[tuple], min_train: int = MIN_TRAIN,
                          keep_folds: int | None = 12) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metrics per fold, all rows with stakes, return report over all folds).

    Per fold: impute on the train part, fit candidates on its first 90 %, calibrate and tune the stake policy on its
    last 10 % under the same event limits as the test part, bet on the test part.
    """
    # rows without a time have no place in the order; the columns in use are stored before it, as finding its ranges reads the rows once more, and the order itself stores
    # what all folds and fits read
    used = list(dict.fromkeys([*cfg.features, *cfg.carried()]))
    rows = time_index(durable(binary_only(df, cfg.y).where(F.col(cfg.ts).isNotNull()).select(*used)), [cfg.ts, cfg.key], "_idx")
    tuned = list(dict.fromkeys(["_idx", cfg.event, cfg.segment, cfg.price_1, cfg.price_2, cfg.y]))

    def one(part: tuple) -> tuple[DataFrame, DataFrame]:
        fold, start, end = part
        train = rows.where(F.col(cfg.ts) < F.lit(start))
        test = rows.where((F.col(cfg.ts) >= F.lit(start)) & (F.col(cfg.ts) < F.lit(end)))
        imputer = GroupImputer(inputCols=list(cfg.features), indicators=False).fit(train)
        cut = int(train.count() * 0.9)
        ready = imputer.transform(train)  # not stored again: filling costs less than writing the rows once a fold
        model, calibrator, tail = choose_model(ready.where(F.col("_idx") < cut), ready.where(F.col("_idx") >= cut), cfg, tuned)
        policy = tune_policy(_as_bets(tail, cfg), cfg.grid, cfg.objective, cfg.event, cfg.max_exposure, DEFAULT_POLICY, cfg.max_bets, ["_idx"])
        scored = calibrator.apply(with_prob(imputer.transform(test), model, "_raw"), "_raw", "p", cfg.segment)
        placed = durable(place_bets(_as_bets(scored, cfg), policy, cfg.event, ["_idx"], cfg.max_bets, cfg.max_exposure).select(
            F.lit(fold).alias("fold"), *cfg.carried(), "p", *[c for c in ("y", "price_1", "price_2") if c not in cfg.carried()],
            "side", "fraction", "profit"))
        quality = metrics.binary_metrics(placed, "p", "y", by=["fold"]).drop("n")
        returns = roi_summary(placed, ["fold"]).select("fold", "roi", "n_bets", "total_wager", "total_profit")
        return quality.join(returns, "fold").withColumns({"start": F.lit(start), "end": F.lit(end)}), placed

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        done = list(pool.map(one, usable_folds(rows, cfg.ts, calendar, min_train, keep_folds)))
    if not done:
        raise ValueError("no fold has enough rows")
    per_fold, bets = zip(*done)
    every = reduce(DataFrame.unionByName, bets)
    return reduce(DataFrame.unionByName, per_fold), every, roi_summary(every)


def yearly_backtest(df: DataFrame, cfg: Setup, year: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bets, equity, summary) of one test year: train before year-2, choose and calibrate on the two years between."""
    rows = year_window(binary_only(df, cfg.y), cfg.ts, year)
    imputer = GroupImputer(inputCols=list(cfg.features), indicators=False).fit(rows.where("split = 'train'"))
    ready = durable(imputer.transform(rows))
    model, calibrator, _ = choose_model(ready.where("split = 'train'"), ready.where("split = 'val'"), cfg)
    scored = calibrator.apply(with_prob(ready.where("split = 'test'"), model, "_raw"), "_raw", "p", cfg.segment)
    test = durable(_as_bets(scored, cfg))
    return yearly_compounding(test, cfg.ts, cfg.event, [cfg.segment])
