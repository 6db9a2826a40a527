"""Quality classifier: a factorisation machine over hashed words, statistics of structure and size.

A text's features are its words, hashed to ``WORDS`` buckets with weights 1 + log(count) scaled to length 1, a dozen statistics of structure
(shares of symbols, capitals, digits, repeated words and lines, mean lengths) and its size (code points, words, lines), each as a hat function over a few fixed knots. The score
is the logistic of bias + linear part + pairwise interactions of rank ``RANK``; by sum over f of (sum v x)^2 - sum (v x)^2, halved, it takes time linear in the features.

Fitting uses a bounded sample: of the labelled rows allowed to train, the ``SAMPLE`` with the smallest hash of doc_id per label, each label weighing the same in total; however many rows an id
has, at most ``SAMPLE`` different texts per label reach the driver.
The features of their whole texts, of which a text has at most ``SIZE``, are fitted by a fixed number of mini-batch steps on the driver.
Scoring is one pass over all documents; the model is a few megabytes whatever the corpus. Labels, language, source and doc_id are never features.

Edge cases. Null or empty text has only its statistics and size. Labels and rows may repeat (equal text, id and label train once) or miss each other; null qualities don't train. With labels of one kind or
none, all scores are the share of label 1 (0.5 without labels). Equal texts get equal scores. Nothing in, nothing out. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pitfeat.llm.common import crc_mod, documents, query, small, whole
from pitfeat.session import durable

WORDS, RANK, SEED = 1 << 14, 8, 5
SAMPLE = 2000
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.1, 1e-5
KNOTS = np.linspace(0, 1, 6)

_SYMBOLS, _OTHERS = b"#*$%&|<>{}[]=_~^\\/@+", b"!?.,;:-'\"()"
_UPPER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"


def statistics(text: str) -> np.ndarray:
    """Numbers between 0 and 1: structure, then size."""
    data = text.encode()
    words = data.split()
    n, chars = max(1, len(words)), max(1, len(data))
    share = lambda marks: (len(data) - len(data.translate(None, marks))) / chars
    lines = [x.strip() for x in data.split(b"\n") if x and not x.isspace()]
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    return np.array([
        min(1, 4 * share(_SYMBOLS)), min(1, 4 * share(_OTHERS)), share(_UPPER), min(1, 4 * share(_DIGITS)),
        len(counts) / n, sum(c for c in counts.values() if c > 1) / n, sum(c for c in pairs.values() if c > 1) / n, max(counts.values(), default=0) / n,
        min(1, chars / n / 16), 1 - len(set(lines)) / max(1, len(lines)), min(1, n / max(1, len(lines)) / 64), sum(w[-1:] in (b".", b",") for w in words) / n,
        min(1, np.log1p(len(text)) / 12), min(1, np.log1p(len(words)) / 10), min(1, np.log1p(len(lines)) / 8),
    ])


N_STATS = 15
SIZE = WORDS + N_STATS * len(KNOTS)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of the features of a text that are not 0."""
    hashes = np.fromiter((zlib.crc32(w) for w in text.encode().split()), np.uint32)
    hashes, count = np.unique(hashes, return_counts=True)
    bucket, at = np.unique(hashes % WORDS, return_inverse=True)
    weight = np.bincount(at, weights=1 + np.log(count), minlength=len(bucket))
    if len(weight):
        weight = weight / np.sqrt((weight ** 2).sum())
    hats = np.maximum(0, 1 - np.abs(statistics(text)[:, None] - KNOTS) * (len(KNOTS) - 1)).ravel()
    some = np.flatnonzero(hats)
    return np.concatenate([bucket.astype(np.int64), WORDS + some]), np.concatenate([weight, hats[some]])


class Model:
    """Bias, linear weights and factors."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray) -> None:
        self.bias, self.linear, self.factors = bias, linear, factors

    def margin(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins of rows laid end to end, and the sums of their factors. No row is empty."""
        vx = self.factors[index] * value[:, None]
        total = np.add.reduceat(vx, starts)
        pairs = 0.5 * ((total ** 2).sum(axis=1) - np.add.reduceat((vx ** 2).sum(axis=1), starts))
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + pairs, total

    def score(self, texts: list[str]) -> np.ndarray:
        rows = [features(t) for t in texts]
        starts = np.cumsum([0, *[len(i) for i, _ in rows[:-1]]])
        margin, _ = self.margin(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> Model:
    """Mini-batches with steps scaled per weight by past gradients."""
    rng = np.random.default_rng(SEED)
    if len(label) == 0 or label.min() == label.max():
        share = float(label.mean()) if len(label) else 0.5
        return Model(float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), np.zeros(SIZE), np.zeros((SIZE, RANK)))
    weight = np.where(label > 0, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    model = Model(0.0, np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, RANK)))
    seen, seen_factors, seen_bias = np.full(SIZE, 1e-6), np.full((SIZE, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            some = order[k:k + BATCH]
            lengths = np.array([len(rows[i][0]) for i in some])
            starts = np.cumsum(lengths) - lengths
            index, value = np.concatenate([rows[i][0] for i in some]), np.concatenate([rows[i][1] for i in some])
            margin, total = model.margin(index, value, starts)
            error = weight[some] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[some]) / len(some)
            each = np.repeat(error, lengths) * value
            used, at = np.unique(index, return_inverse=True)
            slope = np.bincount(at, weights=each, minlength=len(used)) + DECAY * model.linear[used]
            along = each[:, None] * (np.repeat(total, lengths, axis=0) - model.factors[index] * value[:, None])
            slopes = np.stack([np.bincount(at, weights=along[:, f], minlength=len(used)) for f in range(RANK)], 1) + DECAY * model.factors[used]
            seen[used] += slope ** 2
            seen_factors[used] += slopes ** 2
            seen_bias += error.sum() ** 2
            model.linear[used] -= RATE * slope / np.sqrt(seen[used])
            model.factors[used] -= RATE * 0.2 * slopes / np.sqrt(seen_factors[used])
            model.bias -= RATE * error.sum() / np.sqrt(seen_bias)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """``labels``: the rows that may train."""
    usable = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label")).where("l_id is not null and label in (0, 1)")
    chosen = usable.where("label = 1").orderBy(F.xxhash64("l_id"), "l_id").limit(sample).unionAll(usable.where("label = 0").orderBy(F.xxhash64("l_id"), "l_id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    # an id may have any number of rows: equal ones train once, and of the different ones no more than the sample are taken
    met = durable(texts.select("id", "h").join(F.broadcast(chosen), F.col("id") == F.col("l_id")).select("id", "h", "label").distinct())  # at most 2 * sample ids
    order = [F.xxhash64("id"), "id", "h"]
    kept = met.where("label = 1").orderBy(*order).limit(sample).unionAll(met.where("label = 0").orderBy(*order).limit(sample))
    rows = texts.join(F.broadcast(kept.withColumnsRenamed({"id": "k_id", "h": "k_h"})), (F.col("id") == F.col("k_id")) & (F.col("h") == F.col("k_h")))  # at most 2 * sample rows

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("id").cast(pa.int64()), batch.column("h"), batch.column("label"), pa.array([i.astype(np.int32).tobytes() for i, _ in made], pa.binary()),
                pa.array([v.astype(np.float32).tobytes() for _, v in made], pa.binary())], ["id", "h", "label", "i", "v"])

    made = rows.select(F.col("id").cast("long").alias("id"), "h", "label", "text").mapInArrow(make, "id long, h long, label int, i binary, v binary")
    got = made.groupBy("id", "h", "label").agg(F.first("i").alias("i"), F.first("v").alias("v")).collect()
    got.sort(key=lambda r: (r.id, r.label, r.i, r.v))
    return fit([(np.frombuffer(r.i, np.int32).astype(np.int64), np.frombuffer(r.v, np.float32).astype(np.float64)) for r in got], np.array([r.label for r in got], np.float64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``input`` (the row), score and predicted."""
    rows = docs.select(F.struct("*").alias("input"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 256):
            p = model.score([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("input"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["input", "score", "predicted"])

    return rows.mapInArrow(run, T.StructType([rows.schema["input"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


@query("op6_factorisation")
def op6_factorisation(spark, sf_dir):
    def held(c: str) -> Column:
        return crc_mod(c, 3) == 1

    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held("doc_id"))
    done = score(docs, train(docs, labels))
    return done.select(F.col("input.doc_id").alias("doc_id"), held("input.doc_id").alias("held_out"), "score", "predicted")
