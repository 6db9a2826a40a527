"""Train, stack, calibrate and judge the binary model on a temporal split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from pitfeat.operators import metrics
from pitfeat.operators.calibrate import fit_platt
from pitfeat.operators.clean import binary_only
from pitfeat.operators.features import GroupImputer
from pitfeat.operators.models import PARALLEL_FITS, Bundle, fit_logistic, fit_stacker, fit_trees_binned, importances, with_prob, zero_importance
from pitfeat.operators.quality import metric_gate
from pitfeat.operators.splits import calibration_tail, temporal_split
from pitfeat.session import durable


@dataclass
class Trained:
    bundle: Bundle
    metrics: DataFrame
    importances: DataFrame
    unused: DataFrame
    gate: DataFrame


def train_stack(df: DataFrame, features: Sequence[str], y: str, ts: str, order: Sequence[str], val_start, test_start,
                floors: Mapping[tuple[str, str], float], previous: str | None = None, tree_params: Sequence[Mapping] = ({}, {"maxDepth": 3}),
                split: str = "split") -> Trained:
    """Two tree models and a logistic model, stacked; early stopping on the first part of validation, stacker and
    threshold on its tail, so that no row serves both. ``previous`` names an earlier model's probability column.
    """
    rows = temporal_split(binary_only(df, y), ts, val_start, test_start, split)
    imputer = GroupImputer(inputCols=list(features), indicators=False).fit(rows.where(F.col(split) == "train"))
    val = calibration_tail(rows.where(F.col(split) == "val"), order, 0.5, "_tail")
    parts = rows.where(F.col(split) != "val").withColumn("_tail", F.lit(False)).unionByName(val)
    ready = durable(imputer.transform(parts))
    fit_rows = ready.where((F.col(split) == "train") | ((F.col(split) == "val") & ~F.col("_tail"))).withColumn("_is_val", F.col(split) == "val")
    fits = {f"trees_{i}": partial(fit_trees_binned, fit_rows, features, y, "_is_val", **dict(p)) for i, p in enumerate(tree_params)}
    fits["logistic"] = partial(fit_logistic, fit_rows.where(~F.col("_is_val")), features, y)
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        base = dict(zip(fits, pool.map(lambda fit: fit(), fits.values())))
    scored = ready
    for n, m in base.items():
        scored = with_prob(scored, m, f"{n}_prob")
    scored = durable(scored)
    tail = scored.where((F.col(split) == "val") & F.col("_tail"))
    inputs = [*[f"{n}_prob" for n in base], *([previous] if previous else [])]
    stacker = fit_stacker(tail, inputs, y)
    calibrators = {n: fit_platt(tail, f"{n}_prob", y) for n in base}
    final = with_prob(scored, stacker, "stack_prob")
    threshold = metrics.best_threshold(final.where((F.col(split) == "val") & F.col("_tail")), "stack_prob", y).first()["threshold"]
    for n, c in calibrators.items():
        final = c.apply(final, f"{n}_prob", f"{n}_cal")
    final = durable(final)
    columns = [(n, "no", f"{n}_prob") for n in base] + [(n, "yes", f"{n}_cal") for n in base] + [("stack", "no", "stack_prob")]
    long = final.where(F.col(split) != "train").select(F.col(split), F.col(y).alias("y"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(c).alias("calibrated"), F.col(p).alias("p")) for m, c, p in columns])).alias("s")).select(
        F.col(split).alias("split"), "y", "s.*")
    table = metrics.metrics_table(long)
    used = reduce(DataFrame.unionByName, [importances(df, base[f"trees_{i}"], features, f"trees_{i}") for i in range(len(tree_params))])
    bundle = Bundle(list(features), imputer, base, stacker, threshold, calibrators)
    return Trained(bundle, table, used, zero_importance(used), metric_gate(table.where("calibrated = 'no'"), floors))
