"""Distributed model fitting, stacking, tuning and scoring on Spark ML."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import lru_cache, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitfeat.functions.numbers import argmax_class, renormalise
from pitfeat.operators import boost, metrics
from pitfeat.operators.aggregates import best_by, with_class_weight
from pitfeat.operators.calibrate import Platt, apply_temperature, fit_platt, fit_temperature
from pitfeat.operators.clean import align
from pitfeat.operators.features import GroupImputerModel
from pitfeat.operators.softboost import SoftmaxTrees, fit_softmax_trees
from pitfeat.operators.splits import ts_cv
from pitfeat.session import durable

Trainer = Callable[[DataFrame], PipelineModel]

# Search space of the tree models, trials, folds; rows and folds a task needs.
SEARCH_SPACE: dict[str, Sequence] = {
    "stepSize": [0.02, 0.03, 0.05, 0.07],
    "maxDepth": range(3, 9),
    "featureFraction": (0.5, 0.9),
    "subsamplingRate": (0.6, 0.95),
    "minInstancesPerNode": range(20, 400),
}
TRIALS = 20
FOLDS = 5
MIN_TASK_ROWS = 100

# Independent fits submitted at a time; each one is a task of its own or a distributed job.
PARALLEL_FITS = 8


def prob(column: str = "probability", index: int = 1) -> Column:
    return vector_to_array(F.col(column))[index]


def _pipeline(features: Sequence[str], *stages) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep"), *stages])


def fit_logistic(df: DataFrame, features: Sequence[str], y: str, scale: bool = True) -> PipelineModel:
    """Standardised logistic regression with unit ridge penalty on the summed loss."""
    rows = df.where(F.col(y).isNotNull())
    n = max(rows.count(), 1)
    lr = LogisticRegression(labelCol=y, featuresCol="_scaled" if scale else "_features", regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=200)
    stages = [StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True), lr] if scale else [lr]
    return _pipeline(features, *stages).fit(rows)


def tree_params(params: Mapping[str, object], n_features: int) -> dict:
    out = {k: v for k, v in params.items() if k != "featureFraction"}
    if "featureFraction" in params:
        out["featureSubsetStrategy"] = str(max(1, int(round(float(params["featureFraction"]) * n_features))))
    return out


def fit_trees(df: DataFrame, features: Sequence[str], y: str, val_col: str | None = None, weight: str | None = None, seed: int = 42, **params) -> PipelineModel:
    """Boosted trees; with ``val_col`` (true on validation rows) boosting stops once validation loss stops falling, so the rounds are then only an upper bound."""
    gbt = GBTClassifier(labelCol=y, featuresCol="_features", seed=seed, **{"maxIter": 500 if val_col else 100, "maxDepth": 4, "stepSize": 0.1, **tree_params(params, len(features))})
    if val_col:
        gbt = gbt.setValidationIndicatorCol(val_col)
    if weight:
        gbt = gbt.setWeightCol(weight)
    return _pipeline(features, gbt).fit(df.where(F.col(y).isNotNull()))


def fit_trees_binned(df: DataFrame, features: Sequence[str], y: str, val_col: str | None = None, weight: str | None = None, seed: int = 42, **params) -> PipelineModel:
    """The trees of :func:`fit_trees`, grown over binned rows. Sums are added in another order, so which feature has a gain of nothing but rounding may differ; parameters that only Spark ML has go to it."""
    given = {"maxIter": 500 if val_col else 100, "maxDepth": 4, "stepSize": 0.1, **tree_params(params, len(features))}
    if not set(given) <= boost.KNOWN:
        return fit_trees(df, features, y, val_col, weight, seed, **params)
    return boost.fit_binned(boost.bin_rows(df, features, y, val_col, weight, seed), 1, bool(val_col), seed, **given).model()


def with_prob(df: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    """Add the probability of class 1 and none of the model's own columns."""
    return model.transform(df).withColumn(name, prob()).select(*df.columns, name)


def index_labels(df: DataFrame, y: str, classes: Sequence | None = None, name: str = "code") -> tuple[DataFrame, list]:
    """Code per class in sorted class order; rows of unknown classes are dropped."""
    if classes is None:
        classes = sorted(r[0] for r in df.where(F.col(y).isNotNull()).groupBy(y).count().select(y).collect())
    table = F.array(*[F.lit(c) for c in classes])
    coded = df.withColumn(name, (F.array_position(table, F.col(y)) - 1).cast("int"))
    return coded.where(F.col(name) >= 0), list(classes)


@dataclass(frozen=True)
class ClassTrees:
    """One boosted model per class; probabilities are scaled to sum 1."""

    models: Sequence[PipelineModel]
    classes: Sequence

    def transform(self, df: DataFrame, name: str = "probs") -> DataFrame:
        out = df
        for i, m in enumerate(self.models):
            out = with_prob(out, m, f"_p{i}")
        return out.withColumn(name, renormalise(F.array(*[F.col(f"_p{i}") for i in range(len(self.models))]))).drop(*[f"_p{i}" for i in range(len(self.models))])

    def logits(self, df: DataFrame, probs: str = "probs", name: str = "logits") -> DataFrame:
        return df.withColumn(name, F.transform(probs, lambda x: F.ln(F.greatest(x, F.lit(1e-12)))))


def fit_trees_multiclass(df: DataFrame, features: Sequence[str], y: str, classes: Sequence | None = None, balanced: bool = True, val_col: str | None = None, seed: int = 42, **params) -> ClassTrees:
    """A model per class; all start from the same binned rows."""
    coded, classes = index_labels(df, y, classes, "_code")
    rows = with_class_weight(coded, "_code", "_weight") if balanced else coded.withColumn("_weight", F.lit(1.0))

    given = {"maxIter": 500 if val_col else 100, "maxDepth": 4, "stepSize": 0.1, **tree_params(params, len(features))}
    binned = boost.bin_rows(rows, features, "_code", val_col, "_weight", seed, len(classes)) if classes and set(given) <= boost.KNOWN else None

    def one(i: int) -> PipelineModel:
        if binned is not None:
            return boost.fit_binned(binned, i, bool(val_col), seed, **given).model()
        return fit_trees(rows.withColumn("_is", (F.col("_code") == i).cast("double")), features, "_is", val_col, "_weight", seed, **params)

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return ClassTrees(list(pool.map(one, range(len(classes)))), classes)


def fit_stacker(df: DataFrame, prob_cols: Sequence[str], y: str) -> PipelineModel:
    return fit_logistic(df, prob_cols, y, scale=False)


@dataclass(frozen=True)
class Stack:
    base: Mapping[str, PipelineModel]
    meta: PipelineModel

    def transform(self, df: DataFrame, name: str = "p") -> DataFrame:
        out = df
        for n, m in self.base.items():
            out = with_prob(out, m, f"_base_{n}")
        return with_prob(out, self.meta, name).drop(*[f"_base_{n}" for n in self.base])


def fit_oof_stack(df: DataFrame, trainers: Mapping[str, Trainer], y: str, order: Sequence[str], k: int = FOLDS) -> Stack:
    """Stacker on out-of-fold probabilities of time-ordered folds; rows never predicted do not train it.

    Base models are then fitted again on all rows.
    """
    folded = durable(ts_cv(df, order, k, "_fold"))
    folds = range(1, k + 1)

    def fold(j: int) -> DataFrame:
        held = folded.where(F.col("_fold") == j)
        for n, t in trainers.items():
            held = with_prob(held, t(folded.where(F.col("_fold") < j)), f"_base_{n}")
        return held

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        parts = list(pool.map(fold, folds))
        base = dict(zip(trainers, pool.map(lambda t: t(df), trainers.values())))
    oof = reduce(DataFrame.unionByName, parts)
    return Stack(base, fit_stacker(oof, [f"_base_{n}" for n in trainers], y))


def sample_params(space: Mapping[str, Sequence], trials: int, seed: int) -> list[dict]:
    """Seeded draws: a pair is a range of floats, any other sequence a choice."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        out.append({k: round(rng.uniform(*v), 4) if isinstance(v, tuple) else rng.choice(list(v)) for k, v in space.items()})
    return out


def random_search(df: DataFrame, features: Sequence[str], y: str, order: Sequence[str], space: Mapping[str, Sequence] = SEARCH_SPACE,
                  trials: int = TRIALS, k: int = FOLDS, seed: int = 42, **fixed) -> tuple[DataFrame, dict, PipelineModel]:
    """(trial table with its parameters, best parameters, model refitted with them on all rows) by mean log-loss over time-ordered folds.

    From the second fold on, the fold before the held-out one decides when boosting stops; in the refit the last fold does.
    """
    folded = durable(ts_cv(df, order, k, "_fold"))
    tried = sample_params(space, trials, seed)

    def rows_before(last: int) -> DataFrame:
        return folded.where(F.col("_fold") < last).withColumn("_stop", F.col("_fold") == last - 1)

    @lru_cache(None)
    def binned(last: int) -> boost.Binned:
        return boost.bin_rows(rows_before(last), features, y, "_stop" if last > 1 else None)

    def fit(last: int, params: Mapping[str, object]) -> tuple[boost.Boosted | None, PipelineModel | None]:
        """Trees on rows that all trials bin once, or a model where parameters are other than those of the trees."""
        given = {"maxIter": 500 if last > 1 else 100, "maxDepth": 4, "stepSize": 0.1, **tree_params({**fixed, **params}, len(features))}
        if set(given) <= boost.KNOWN:
            return boost.fit_binned(binned(last), 1, last > 1, **given), None
        return None, fit_trees(rows_before(last), features, y, "_stop" if last > 1 else None, **{**fixed, **params})

    def loss(job: tuple[int, int]) -> tuple[int, int, float]:
        trial, j = job
        trees, model = fit(j, tried[trial])
        held = folded.where(F.col("_fold") == j)
        scored = trees.with_prob(held, "_p") if trees else with_prob(held, model, "_p")
        return trial, j, scored.agg(F.avg(metrics.log_loss(F.col("_p"), F.col(y)))).first()[0]

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        if {*fixed, *space} - {"featureFraction"} <= boost.KNOWN:
            list(pool.map(binned, range(1, k + 2)))
        rows = list(pool.map(loss, [(t, j) for t in range(trials) for j in range(1, k + 1)]))
    table = df.sparkSession.createDataFrame(rows, "trial int, fold int, log_loss double")
    scores = table.groupBy("trial").agg(F.avg("log_loss").alias("log_loss"), F.count(F.lit(1)).alias("folds"))
    named = df.sparkSession.createDataFrame([(t, json.dumps({**fixed, **p})) for t, p in enumerate(tried)], "trial int, params string")
    scores = durable(scores.join(named, "trial"))
    best = best_by(scores, "log_loss", largest=False, tie=["trial"]).first()["trial"]
    trees, model = fit(k + 1, tried[best])
    return scores, {**fixed, **tried[best]}, trees.model() if trees else model


def importances(df: DataFrame, model: PipelineModel, features: Sequence[str], name: str) -> DataFrame:
    """Importance per feature (one row each)."""
    values = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame([(name, f, float(v)) for f, v in zip(features, values)], "model string, feature string, importance double")


def zero_importance(table: DataFrame) -> DataFrame:
    """Features no model uses."""
    return table.groupBy("feature").agg(F.sum("importance").alias("importance")).where("importance = 0").select("feature")


def pick_candidate(scores: DataFrame, metric: str = "brier_score") -> DataFrame:
    return best_by(scores, metric, largest=False, tie=["model"])


@dataclass
class Bundle:
    """What scoring needs: features in order, imputer, base models, stacker, threshold, class models."""

    features: Sequence[str]
    imputer: object
    base: Mapping[str, PipelineModel]
    stacker: PipelineModel | None = None
    threshold: float = 0.5
    calibrators: Mapping[str, Platt] = field(default_factory=dict)
    class_models: Mapping[str, ClassTrees | SoftmaxTrees] = field(default_factory=dict)
    class_temperature: Mapping[str, float] = field(default_factory=dict)

    def save(self, path: str) -> None:
        """Model folders under ``path``, as Spark ML writes them, and one JSON row with all that is not a model."""
        self.imputer.write().overwrite().save(f"{path}/imputer")
        for n, m in self.base.items():
            m.write().overwrite().save(f"{path}/base_{n}")
        if self.stacker is not None:
            self.stacker.write().overwrite().save(f"{path}/stacker")
        joint = {t: m.text() for t, m in self.class_models.items() if isinstance(m, SoftmaxTrees)}
        for task, trees in self.class_models.items():
            for i, m in enumerate([] if task in joint else trees.models):
                m.write().overwrite().save(f"{path}/class_{task}_{i}")
        meta = {"features": list(self.features), "base": list(self.base), "stacker": self.stacker is not None, "threshold": float(self.threshold),
                "calibrators": {n: [c.slope, c.intercept] for n, c in self.calibrators.items()}, "classes": {t: list(m.classes) for t, m in self.class_models.items()},
                "temperatures": dict(self.class_temperature), "joint": joint}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        """A saved bundle, complete for :func:`score`."""
        meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"])
        classes = {t: ClassTrees([PipelineModel.load(f"{path}/class_{t}_{i}") for i in range(len(names))], names) for t, names in meta["classes"].items() if t not in meta.get("joint", {})}
        classes |= {t: SoftmaxTrees.of(text) for t, text in meta.get("joint", {}).items()}
        return cls(meta["features"], GroupImputerModel.load(f"{path}/imputer"), {n: PipelineModel.load(f"{path}/base_{n}") for n in meta["base"]},
                   PipelineModel.load(f"{path}/stacker") if meta["stacker"] else None, meta["threshold"], {n: Platt(*c) for n, c in meta["calibrators"].items()}, classes, meta["temperatures"])


def previous_probability(df: DataFrame, features: Sequence[str], imputer, model: PipelineModel, key: str, name: str,
                         calibrator: Platt | None = None) -> DataFrame:
    """(key, probability) of an earlier generation's model on its own feature list."""
    raw = with_prob(imputer.transform(align(df, features, [key])), model, "_raw")
    return calibrator.apply(raw, "_raw", name).select(key, name) if calibrator else raw.select(key, F.col("_raw").alias(name))


def score(df: DataFrame, bundle: Bundle, keep: Sequence[str], names: tuple[str, str] | None = None) -> DataFrame:
    """Batch scoring: align, impute, base probabilities, stack, threshold, side name, class probabilities.

    ``keep`` columns are carried along; a column named like a base model's ``<name>_prob`` among them joins the stack.
    """
    out = bundle.imputer.transform(align(df, bundle.features, [k for k in keep if k not in bundle.features]))
    for n, m in bundle.base.items():
        out = with_prob(out, m, f"{n}_prob")
        if n in bundle.calibrators:
            out = bundle.calibrators[n].apply(out, f"{n}_prob", f"{n}_cal")
    first = next(iter(bundle.base))
    out = with_prob(out, bundle.stacker, "win_prob") if bundle.stacker is not None else out.withColumn("win_prob", F.col(f"{first}_prob"))
    out = out.withColumn("predicted", (F.col("win_prob") >= bundle.threshold).cast("int"))
    new = ["win_prob", "predicted", *[f"{n}_prob" for n in bundle.base]]
    if names:
        out = out.withColumn("predicted_name", F.when(F.col("predicted") == 1, F.col(names[0])).otherwise(F.col(names[1])))
        new.append("predicted_name")
    for task, model in bundle.class_models.items():
        out = model.transform(out, f"{task}_probs")
        if task in bundle.class_temperature:
            out = apply_temperature(model.logits(out, f"{task}_probs", "_logits"), "_logits", bundle.class_temperature[task], f"{task}_probs").drop("_logits")
        out = out.withColumn(f"{task}_class", argmax_class(F.col(f"{task}_probs"), model.classes))
        new += [f"{task}_probs", f"{task}_class"]
    return out.select(*keep, *new)


@dataclass(frozen=True)
class Task:
    """A target: its column and its classes; two classes 0 and 1 make it binary."""

    name: str
    y: str
    classes: Sequence | None = None


@dataclass(frozen=True)
class FittedTask:
    """A task's model on all rows and what its held-out probabilities say about calibration: Platt for two classes, a temperature for more."""

    model: object
    classes: Sequence
    platt: Platt | None = None
    temperature: float = 1.0

    def transform(self, df: DataFrame, name: str = "probs") -> DataFrame:
        """Calibrated probabilities per class as an array."""
        if self.platt is not None:
            out = self.platt.apply(with_prob(df, self.model, "_raw"), "_raw", "_cal")
            return out.withColumn(name, F.array(1.0 - F.col("_cal"), F.col("_cal"))).drop("_raw", "_cal")
        out = self.model.logits(self.model.transform(df, "_probs"), "_probs", "_logits")
        return apply_temperature(out, "_logits", self.temperature, name).drop("_probs", "_logits")


def fit_tasks(df: DataFrame, features: Sequence[str], tasks: Sequence[Task], order: Sequence[str], k: int = FOLDS,
              min_rows: int = MIN_TASK_ROWS, joint: Mapping | None = None, **params) -> tuple[DataFrame | None, dict[str, FittedTask]]:
    """(fold scores, fitted tasks) of several targets over one feature table; tasks with too few labels are skipped.

    From the second fold on the fold before the held-out one decides when boosting stops, in the last fit the last fold does. Calibrators are fitted on the held-out
    probabilities of all folds, so no row calibrates a model that it trained. With ``joint``, targets of more than two classes are boosted under one softmax loss, with these parameters.
    """
    scores, models = [], {}
    for task in tasks:
        rows, classes = index_labels(df, task.y, task.classes, "_y")
        used = list(dict.fromkeys([*features, *[w for w in (params.get("weight"), (joint or {}).get("weight")) if w], "_y"]))
        folded = durable(ts_cv(rows.select(*dict.fromkeys([*used, *order])), order, k, "_fold").select(*used, "_fold"))
        if folded.count() < min_rows or len(classes) < 2:
            continue
        binary = list(classes) == [0, 1]

        def fit(last: int):
            part = folded.where(F.col("_fold") < last).withColumn("_stop", F.col("_fold") == last - 1)
            stop = {"val_col": "_stop"} if last > 1 else {}
            if joint is not None and not binary:
                return fit_softmax_trees(part, features, "_y", list(range(len(classes))), **stop, **joint)
            return fit_trees_binned(part, features, "_y", **stop, **params) if binary else fit_trees_multiclass(part, features, "_y", list(range(len(classes))), **stop, **params)

        def held(j: int) -> DataFrame:
            model, rest = fit(j), folded.where(F.col("_fold") == j)
            if binary:
                probs = with_prob(rest, model, "_p").withColumn("_probs", F.array(1.0 - F.col("_p"), F.col("_p")))
            else:
                probs = model.logits(model.transform(rest, "_probs"), "_probs", "_logits")
            return durable(probs.select("_y", "_probs", "_p" if binary else "_logits"))

        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            last = pool.submit(fit, k + 1)
            held_out = list(pool.map(held, range(1, k + 1)))
            fitted = last.result()
        for j, probs in enumerate(held_out, 1):
            scores.append(metrics.multiclass_metrics(probs, "_probs", "_y").select(F.lit(task.name).alias("task"), F.lit(j).alias("fold"), "n", "log_loss", "accuracy"))
        every = reduce(DataFrame.unionByName, held_out)
        models[task.name] = (FittedTask(fitted, classes, platt=fit_platt(every, "_p", "_y")) if binary
                             else FittedTask(fitted, classes, temperature=fit_temperature(every, "_logits", "_y")))
    return (reduce(DataFrame.unionByName, scores) if scores else None), models
