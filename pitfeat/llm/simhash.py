"""SimHash near-dedup: documents whose 64-bit fingerprints differ in few bits, found through Golay codes, and their connected components.

A fingerprint is cut into three segments of 22, 21 and 21 bits. If two fingerprints differ in at most 4 bits, some two segments differ in at most 2
together. Each segment, as a 23-bit vector, is decoded to all codewords of the binary Golay code within distance 4 (one if the nearest is within
2, six otherwise); two vectors that differ in at most 2 bits share one of these (tested over all cosets). So the pairs of codeword
indices of two segments are the keys: any link shares a key, and every pair under a key is verified on the whole fingerprint.

Equal fingerprints are one node, so exact copies cost nothing here. Rows are sorted by key and streamed; the links under a key leave the task as a
forest, never as all pairs. A key with more than ``DENSE`` fingerprints is not compared pairwise: its fingerprints go to an exact
second way, linear in their number. Two fingerprints are within 4 bits exactly if some 64-bit value is within 2 bits of both, so each is sent to its 2,081 neighbours
and all that meet at one neighbour are linked as a star. Keys that are heavy within some task are found beforehand and go there directly.
Components come from large-star and small-star rounds on stored tables.

Edge cases. Null and empty texts, and texts of white space, have fingerprint 0, linked like any other. Fewer than four words are one shingle.
Null doc_ids are never the smallest; a component of nothing else has a null component_id. Equal rows each come out. Nothing in, nothing out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from pitfeat.llm.common import documents, numbered, pieces, query, same, small
from pitfeat.session import durable

SHINGLE, SEED, BITS = 4, 42, 4
DENSE = 4096
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
KEY_BYTES = 64 << 20
GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
HOT_SHARE, HOT_KEYS = 64, 100_000


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of unsigned 64-bit hashes, as an unsigned number; 0 for none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        some = hashes[k:k + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None) -> int:
    """SimHash of a text as an unsigned number; the most significant bit of the hashes first."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, the six white space characters only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(words, lambda at, w: at + 1 + len(w), initial=-1))
    span = min(SHINGLE, len(words))
    return majority(np.frombuffer(b"".join(xxhash.xxh64_digest(joined[a + 1:b], SEED) for a, b in zip(ends, ends[span:])), ">u8"))


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with another column ``fp`` (long); ``docs`` must not have one yet."""
    others = [c for c in docs.columns if c != text_col]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            fp = np.array([fingerprint(t) for t in batch.column(text_col).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(fp)], [*others, "fp"])

    return docs.mapInArrow(add, T.StructType([*(docs.schema[c] for c in others), T.StructField("fp", T.LongType())]))


def _remainder(x: int) -> int:
    for k in range(22, 10, -1):
        if x >> k & 1:
            x ^= GENERATOR << (k - 11)
    return x


@lru_cache
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of the 12 high bits; the error patterns of weight up to 4 for each syndrome, -1 where there are fewer than six."""
    high = np.array([_remainder(m << 11) for m in range(4096)], np.int64)
    patterns: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            patterns.setdefault(int(high[e >> 11]) ^ e & 0x7FF, []).append(e)
    table = np.full((2048, 6), -1, np.int64)
    for s, found in patterns.items():
        table[s, :len(found)] = found
    return high, table


def codewords(x: np.ndarray) -> np.ndarray:
    """Indices of the codewords within distance 4 of 23-bit vectors, six columns, -1 where there is none."""
    high, table = golay_tables()
    e = table[high[x >> 11] ^ x & 0x7FF]
    return np.where(e >= 0, (x[:, None] ^ e) >> 11, -1)


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of its fingerprint) of unsigned fingerprints."""
    near = [codewords(((fp >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)) for at, width in SEGMENTS]
    keys, owners = [], []
    for k, (a, b) in enumerate(combinations(range(3), 2)):
        left, right = near[a][:, :, None], near[b][:, None, :]
        ok = (left >= 0) & (right >= 0)
        keys.append((k << 24 | left << 12 | right)[ok])
        owners.append(np.nonzero(ok)[0])
    return np.concatenate(keys), np.concatenate(owners)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for all other nodes of the links a - b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y, label[x], label[y]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


class _Links:
    """Links gathered up to a bound, then reduced to a forest."""

    def __init__(self, most: int = 1 << 18) -> None:
        self.most, self.parts, self.n = most, [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.parts.append((a, b))
            self.n += len(a)
            if self.n > self.most:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = forest(*(np.concatenate(x) for x in zip(*self.parts)))
        self.parts, self.n = [(a, b)], len(a)
        self.most = max(self.most, 2 * len(a))
        return a, b


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (key, fp) in pieces that end with a key; a run of more than ``most`` rows may come in several pieces of over ``most`` rows."""
    key = fp = np.zeros(0, np.int64)
    for batch in batches:
        key = np.concatenate([key, batch.column("key").to_numpy()])
        fp = np.concatenate([fp, batch.column("fp").to_numpy()])
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if len(key) - cut > 2 * most + 2:
            cut = len(key) - most - 1  # of a run that is too long whatever follows
        if cut:
            yield key[:cut], fp[:cut]
            key, fp = key[cut:], fp[cut:]
    if len(key):
        yield key, fp


def _pairs(key: np.ndarray, fp: np.ndarray, links: _Links, most: int) -> np.ndarray:
    """Adds the verified links under each key; returns the fingerprints under keys with more than ``most``."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    length = np.diff(np.r_[starts, len(key)])
    size = np.repeat(length, length)
    place = np.arange(len(key)) - np.repeat(starts, length)
    dense = np.unique(fp[size > most])
    left = np.flatnonzero((size > 1) & (size <= most))
    shift = 1
    while len(left := left[place[left] + shift < size[left]]):
        apart = np.bitwise_count((fp[left] ^ fp[left + shift]).view(np.uint64))
        hit = left[apart <= BITS]
        links.add(fp[hit], fp[hit + shift])
        shift += 1
    return dense


def _out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _keyed(nodes: DataFrame, hot: frozenset[int]) -> DataFrame:
    """(key, fp) rows; with key -1 for fingerprints that have a hot key, whose rows are left out."""
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.array(sorted(hot), np.int64)
        for batch in batches:
            every = batch.column("fp").to_numpy()
            for k in range(0, len(every), 1 << 10):  # some 85 keys a fingerprint, held at once here and in the JVM
                fp = every[k:k + (1 << 10)]
                key, owner = keys_of(fp.view(np.uint64))
                if len(listed):
                    heavy = np.isin(key, listed)
                    marked = np.unique(owner[heavy])
                    key = np.r_[key[~heavy], -1 - np.arange(len(marked)) % 1024]
                    owner = np.r_[owner[~heavy], marked]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[owner])], ["key", "fp"])

    return nodes.select("fp").mapInArrow(expand, "key long, fp long")


def hot_keys(nodes: DataFrame) -> frozenset[int]:
    """Keys that hold a notable share of some task's fingerprints and over ``DENSE`` rows together; at most ``HOT_KEYS``, the largest.

    Only the way that their rows take depends on this, not the links.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(fp), 1 << 13):
                key, n = np.unique(keys_of(fp[k:k + (1 << 13)])[0], return_counts=True)
                heavy = n >= max(16, min(len(fp) - k, 1 << 13) // HOT_SHARE)
                yield pa.RecordBatch.from_arrays([pa.array(key[heavy]), pa.array(n[heavy])], ["key", "n"])

    found = nodes.select("fp").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > DENSE)
    return frozenset(r.key for r in found.orderBy(F.desc("n"), "key").limit(HOT_KEYS).select("key").collect())


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): a forest of links per task that joins all distinct fingerprints within ``BITS`` bits. ``nodes`` is a stored table of distinct ``fp``."""
    parts = max(pieces(nodes, KEY_BYTES // 200), 1)
    spread = nodes.repartition(parts, "fp")
    hot = hot_keys(spread)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Links()
        for key, fp in _runs(batches, DENSE):
            dense = [_pairs(key[key >= 0], fp[key >= 0], found, DENSE), fp[key < 0]]
            for some in dense:
                if len(some):
                    yield _out(some, some)  # a mark: this fingerprint takes the second way
        yield _out(*found.reduce())

    first = durable(_keyed(spread, hot).repartition(parts, "key").sortWithinPartitions("key").mapInArrow(compare, "a long, b long"))
    dense = durable(first.where("a = b").select(F.col("a").alias("fp")).distinct())

    flips = np.array([0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i, j in combinations(range(64), 2))], np.uint64)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(fp), 64):
                some = fp[k:k + 64]
                yield pa.RecordBatch.from_arrays([pa.array((some[:, None] ^ flips).ravel().view(np.int64)), pa.array(np.repeat(some, len(flips)).view(np.int64))], ["key", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, last_key, last_fp = _Links(), None, None
        for batch in batches:
            key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            if len(key):
                same = np.flatnonzero(key[1:] == key[:-1])
                found.add(fp[same], fp[same + 1])
                if last_key == key[0]:
                    found.add(fp[:1], np.array([last_fp]))
                last_key, last_fp = key[-1], fp[-1]
        yield _out(*found.reduce())

    second = (dense.mapInArrow(neighbours, "key long, fp long").repartition(pieces(dense, KEY_BYTES // 4000), "key")
              .sortWithinPartitions("key").mapInArrow(meet, "a long, b long"))
    return first.where("a <> b").unionAll(second.where("a <> b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the links and the smallest node of its component, by large-star and small-star rounds."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        # both ends know each other (large star), or the larger end knows the smaller (small star)
        ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        if large:
            ends = ends.unionAll(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = durable(ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")))
        met = ends.join(low, F.col("u") == F.col("c"))
        if large:
            out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(low.select(F.col("c").alias("a"), F.col("m").alias("b")))
        return durable(out.where("a <> b").distinct())

    def stamp(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = stamp(edges)
    while before[0]:
        edges = star(star(edges, True), False)
        after = stamp(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def classes(marked: DataFrame) -> DataFrame:
    """(c_fp, root, component_id) for each distinct fingerprint of a stored table of doc_id and fp."""
    nodes = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = durable(components(links(nodes)))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = durable(rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r"))
    return durable(rooted.join(smallest, F.col("root") == F.col("r")).select(F.col("fp").alias("c_fp"), "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id, a row per document."""
    marked = durable(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))))
    return marked.join(classes(marked), F.col("fp") == F.col("c_fp")).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id (null last), of several such the one with the smallest hash of its text.

    Rows are told by doc_id and that hash; of rows that share both, one stays. Columns as they came.
    """
    rows = docs.select(F.struct("*").alias("input"), F.col("doc_id").alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    marked = durable(fingerprints(rows.select(F.col("d").alias("doc_id"), "h", F.col("input.text").alias("text"))))
    found = marked.join(classes(marked), F.col("fp") == F.col("c_fp"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("first"))
    keep = durable(first.select(F.col("first.doc_id").alias("k_doc"), F.col("first.h").alias("k_h")))
    kept = rows.join(keep, same({"d": "k_doc", "h": "k_h"}), "left_semi")
    most = marked.groupBy("doc_id", "h").count().agg(F.max("count")).first()[0] or 1
    return numbered(kept, ["d", "h"], most).where("copy = 1").select("input.*")


@query("op2_simhash")
def op2_simhash(spark, sf_dir):
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
