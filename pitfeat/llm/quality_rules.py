"""Quality rules: counts that fail a document outright, then the likelihood ratio of its hashed n-grams under trusted text and the raw corpus.

Every document is a bag of byte n-grams hashed to ``BUCKETS`` buckets. Two multinomials are counted over all documents: one over the trusted
ones, smoothed by the other, which is over all. The mean log ratio of a document's n-grams (in whole units of 2**-20, so the sum is exact and order
does not matter) must reach ``LEAST``; every document is judged by the same cut.

Counting ships at most ``BUCKETS`` sums per task; the model is one number per bucket, whatever the corpus. The trusted ids are broadcast while their counted size
is within ``BROADCAST_BYTES``, else joined by shuffle.

Edge cases. Null text has no words and fails. Text under ``GRAM`` bytes has ratio 0. Equal rows get equal verdicts. Labels may repeat; null ids match
nothing. Without trusted documents every ratio is 0, so only the counts decide. No rows in, no rows out. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pitfeat.llm.common import documents, query, small

GRAM, BUCKETS, UNIT = 4, 1 << 16, 1 << 20
LEAST = -0.4
LEAST_WORDS, MOST_REPEATED_PCT = 50, 50
BROADCAST_BYTES, ID_BYTES = 64 << 20, 32
SYMBOLS = b"#*$%&|<>"


def grams(text: bytes) -> np.ndarray:
    """The bucket of each run of ``GRAM`` bytes."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < GRAM:
        return np.zeros(0, np.uint32)
    n = len(b) - GRAM + 1
    key = b[:n] | b[1:n + 1] << 8 | b[2:n + 2] << 16 | b[3:n + 3] << 24
    return (key * np.uint32(2654435761)) >> np.uint32(16)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    n = len(numbers)
    _, pair = np.unique(code[:-1] * n + code[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * n + code[2:], return_inverse=True, return_counts=True)
    twice = times[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= twice
    return int(covered.sum())


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode()
    words = data.split()  # bytes split at exactly the six white space characters
    joined = b"".join(words)
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    chars = len(joined) if len(joined) == len(data) and text.isascii() else len(joined.decode())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x or "" for x in batch.column(name).to_pylist()]


def ngram_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over trusted documents and over all. ``trusted`` has a column of ids."""
    ids = trusted.select(F.col(trusted.columns[0]).alias("t_id")).where("t_id is not null").distinct()
    if ids.count() * ID_BYTES <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, F.col("id") == F.col("t_id"), "left").select(
        "text", F.col("t_id").isNotNull().alias("good"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in small(batches):
            for text, good in zip(_texts(batch), batch.column("good").to_pylist()):
                found = np.bincount(grams(text.encode()), minlength=BUCKETS)
                sums[1] += found
                if good:
                    sums[0] += found
        at = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[0][at]), pa.array(sums[1][at])], ["bucket", "good", "all"])

    rows = marked.mapInArrow(add, "bucket int, good long, all long").groupBy("bucket").agg(F.sum("good"), F.sum("all")).collect()
    out = np.zeros((2, BUCKETS), np.int64)
    for bucket, good, every in rows:  # at most BUCKETS
        out[:, bucket] = good, every
    return out[0], out[1]


def log_ratios(good: np.ndarray, every: np.ndarray) -> np.ndarray:
    """log(P(bucket | trusted) / P(bucket | all)) in whole units of 1 / UNIT."""
    if not good.sum():
        return np.zeros(BUCKETS, np.int64)
    share = every / every.sum()
    smooth = (good + BUCKETS * share) / (good.sum() + BUCKETS)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(share > 0, np.rint(np.log(smooth / share) * UNIT), 0).astype(np.int64)


MADE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept"]


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``input`` (the row), the counts, base_failed, ratio (mean log ratio per n-gram) and kept."""
    table = log_ratios(*ngram_counts(docs, trusted, id_col, text_col))
    rows = docs.select(F.struct("*").alias("input"), F.col(text_col).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            base, ratio = [], []
            for text in _texts(batch):
                base.append(counts(text))
                found = table[grams(text.encode())]
                ratio.append(int(found.sum()) / UNIT / max(1, len(found)))
            n = np.array(base, np.int64).reshape(-1, 5)
            failed = (n[:, 0] < LEAST_WORDS) | (100 * n[:, 4] > MOST_REPEATED_PCT * n[:, 0])
            mean = np.array(ratio, np.float64)
            made = [*(pa.array(n[:, k]) for k in range(5)), pa.array(failed), pa.array(mean), pa.array(~failed & (mean >= least))]
            yield pa.RecordBatch.from_arrays([batch.column("input"), *made], ["input", *MADE])

    kinds = {"base_failed": T.BooleanType(), "kept": T.BooleanType(), "ratio": T.DoubleType()}
    return rows.mapInArrow(score, T.StructType([rows.schema["input"], *(T.StructField(c, kinds.get(c, T.LongType())) for c in MADE)]))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1").select("doc_id")


def drop_rejected(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns."""
    return judge(docs, trusted).where("kept").select(*[F.col(f"input.`{c}`").alias(c) for c in docs.columns])


@query("op8_quality_rules")
def op8_quality_rules(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return judge(docs, trusted_ids(labels)).select(F.col("input.doc_id").alias("doc_id"), *MADE)
