"""Near-dedup by shingle similarity: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and their connected components.

Texts with the same shingles are one node, told by a 64-bit hash of the set. Candidates come from two sources. The first is SimHash: each set has a 64-bit fingerprint, and
op2's operator links the fingerprints that differ in at most 4 bits, through Golay keys, and finds their components; in each, nodes fewer than ``FAR`` places apart in order of size
are candidates if their own fingerprints are that close. A pair at 0.8 differs in about 10 bits, so fingerprints reach closer copies only. The second source therefore serves every pair, those
too: candidates share one of ``BANDS`` keys, each of ``ROWS`` minima of the
hashed set: a pair at 0.8 shares none with probability (1 - 0.8^6)^24 = 0.0007, less above. Every link is verified on the real sets, which are read
again for nodes that have a candidate only; pairs below 0.8 are never linked.

Under a key the nodes are ordered by set size. Rounds compare nodes at growing distances below ``FAR`` in this order, only those that no link joins so far; a group of
like texts is joined by about as many comparisons as it has nodes. Keys that still hold several components then (pages of one template with contents of their own, alike
just below the link) are replaced by an exact index of their nodes: the shingles of each set, rarest first. A pair of sizes n and m shares (n + m) * 4/9 shingles if it is
alike, so its first common shingle is early enough in both orders to leave that many; only shingles in at least two sets and so early are keys, and a pair under one is
compared only where both places allow it. Contents that no other page shares fill the early places, so such pages meet under no key. Rounds go on under these keys until
all pairs are joined, ruled out or compared, so nothing is left out for the size of a group. Texts that differ from one base by scattered edits, alike just below the link,
still share early shingles of the base and are compared in growing rounds.

Edge cases. Fewer than five words are one shingle. Texts without words (null, empty, white space) have equal, empty sets and are one node. Null doc_ids come last when the one that stays is chosen; of equal
rows one stays; other columns, whatever their names, pass through. Nothing in, nothing out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from pitfeat.llm.common import numbered, pieces, same, small, whole
from pitfeat.llm.simhash import BITS, components, links, majority
from pitfeat.session import durable

SHINGLE, SEED = 5, 43
PART, WHOLE = 4, 5  # linked from a similarity of PART / WHOLE on
BANDS, ROWS = 24, 6
NEXT, GROW = 2, 4  # the first round compares at distances below NEXT, each further one up to GROW times as far
FAR = 8  # from this distance on rare shingles are the keys
KEY_BYTES, SLICE = 64 << 20, 4096
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The hashes of the distinct shingles of a text, sorted."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, the six white space characters only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(words, lambda at, w: at + 1 + len(w), initial=-1))
    span = min(SHINGLE, len(words))
    return np.unique(np.frombuffer(b"".join(xxhash.xxh64_digest(joined[a + 1:b], SEED) for a, b in zip(ends, ends[span:])), ">u8").astype(np.uint64))


def name(hashes: np.ndarray) -> int:
    """The node of a set, a signed number."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key per band; none for the empty set."""
    if not len(hashes):
        return []
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), SLICE):
        least = np.minimum(least, (FACTORS[:, None] * hashes[k:k + SLICE]).min(axis=1))
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64).tolist()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a Jaccard similarity of at least PART / WHOLE."""
    return (PART + WHOLE) * len(np.intersect1d(a, b, assume_unique=True)) >= PART * (len(a) + len(b))


def _marked(rows: DataFrame) -> DataFrame:
    """d, h, node, n (size of the set), fp (its fingerprint) and keys of rows of d, h, text."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            nodes, sizes, prints, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                nodes.append(name(found))
                sizes.append(len(found))
                prints.append(majority(found))
                keys.append(band_keys(found))
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("h"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)),
                                              pa.array(keys, pa.list_(pa.int64()))], ["d", "h", "node", "n", "fp", "keys"])

    return rows.select("d", "h", "text").mapInArrow(mark, f"d {rows.schema['d'].dataType.simpleString()}, h long, node long, n long, fp long, keys array<long>")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows sorted by key, in pieces that end with a key: (key, n, node, reach, c, place under the key, nodes under the key)."""
    names = ["key", "n", "node", "reach", "c"]
    kept = [np.zeros(0, np.int64)] * len(names)

    def sized(rows: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        starts = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
        length = np.diff(np.r_[starts, len(rows[0])])
        return *rows, np.arange(len(rows[0])) - np.repeat(starts, length), np.repeat(length, length)

    for batch in batches:
        kept = [np.concatenate([k, batch.column(c).to_numpy()]) for k, c in zip(kept, names)]
        cut = int(np.searchsorted(kept[0], kept[0][-1])) if len(kept[0]) else 0
        if cut:
            yield sized([k[:cut] for k in kept])
            kept = [k[cut:] for k in kept]
    if len(kept[0]):
        yield sized(kept)


def _shared(nodes: DataFrame) -> DataFrame:
    """key, n, node, reach (the largest set that may be alike) for keys with several nodes."""
    keyed = nodes.select(F.explode("keys").alias("key"), "n", "node", F.expr(f"n * {WHOLE} div {PART}").alias("reach"), F.col("node").alias("c"))

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n, node, reach, _, _, size in _runs(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x[size > 1]) for x in (key, n, node, reach)], ["key", "n", "node", "reach"])

    parts = pieces(nodes, KEY_BYTES // 3)
    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(several, "key long, n long, node long, reach long")


def _close(nodes: DataFrame) -> DataFrame:
    """Distinct (a, b) of nodes in one component of the SimHash operator, fewer than ``FAR`` places apart there in order of size, whose fingerprints differ in at most ``BITS`` bits."""
    names = ["key", "n", "node", "reach", "fp"]
    roots = durable(components(links(durable(nodes.select("fp").distinct()))).select(F.col("node").alias("r_fp"), "root"))
    keyed = nodes.join(roots, F.col("fp") == F.col("r_fp"), "left").select(F.coalesce("root", "fp").alias("key"), "n", "node", F.expr(f"n * {WHOLE} div {PART}").alias("reach"), "fp")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * len(names)  # the last rows before a batch
        for batch in batches:
            fresh = len(kept[0])
            kept = [np.concatenate([k, batch.column(c).to_numpy()]) for k, c in zip(kept, names)]
            key, n, node, reach, fp = kept
            for shift in range(1, FAR):
                right = np.arange(max(fresh, shift), len(key))
                left = right - shift
                apart = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64))
                hit = (key[left] == key[right]) & (n[right] <= reach[left]) & (apart <= BITS)
                a, b = node[left[hit]], node[right[hit]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            kept = [k[-(FAR - 1):] for k in kept]

    return keyed.repartition(pieces(nodes, KEY_BYTES), "key").sortWithinPartitions("key", "n", "node").mapInArrow(pair, "a long, b long").distinct()


def _rare(state: DataFrame, sets: DataFrame) -> DataFrame:
    """State rows of the same nodes under their early shingles, rarest first, instead of their bands.

    At place i of n shingles, n - i are left, so an alike set has at most (5 n - 9 i) / 4 of them: the reach. Of two sets one is the smaller and reaches its own size;
    rows that do not reach the smallest such size of their key meet nothing.
    """
    nodes = state.groupBy("node").agg(F.first("c").alias("c"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 64):
            every = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("hashes")]
            n = np.array([len(x) for x in every], np.int64)
            each = [np.repeat(x, n) for x in (batch.column("node").to_numpy(), batch.column("c").to_numpy(), n)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(every), *each)], ["key", "node", "c", "n"])

    held = sets.select(F.col("node").alias("h_node"), "hashes").join(nodes, F.col("h_node") == F.col("node")).select("node", "c", "hashes")
    tokens = durable(held.mapInArrow(spread, "key long, node long, c long, n long"))
    often = tokens.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("f")).where("f > 1")
    repeated = tokens.join(often, F.col("key") == F.col("k")).select("key", "node", "c", "n", "f")
    every = Window.partitionBy("node")
    place = F.col("n") - F.count("*").over(every) + F.row_number().over(every.orderBy("f", "key")) - 1
    early = repeated.withColumn("i", place).where(F.col("i") * WHOLE <= F.col("n") * (WHOLE - PART))
    reach = F.expr(f"(n * {WHOLE} - i * {PART + WHOLE}) div {PART}").alias("reach")
    rows = durable(early.select("key", "n", "node", reach, "c"))
    least = rows.groupBy(F.col("key").alias("k")).agg(F.min(F.when(F.col("reach") >= F.col("n"), F.col("n"))).alias("least"), F.min("c").alias("low"), F.max("c").alias("top"))
    return rows.join(least.where("least is not null and low < top"), F.col("key") == F.col("k")).where("reach >= least").select("key", "n", "node", "reach", "c")


def _pairs(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Distinct (a, b) under a key at distances from ``low`` to below ``high``, in different components c, that may be alike by their sizes."""
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, n, node, reach, c, place, size in _runs(batches):
            shift, left = low, np.arange(len(node))
            while shift < high and len(left := left[place[left] + shift < size[left]]):
                left = left[n[left + shift] <= reach[left]]  # sizes rise, so farther ones differ even more
                hit = left[(c[left] != c[left + shift]) & (n[left] <= reach[left + shift])]
                a, b = node[hit], node[hit + shift]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
                shift += 1

    parts = pieces(rows, KEY_BYTES // 3)
    return rows.repartition(parts, "key").sortWithinPartitions("key", "n", "node").mapInArrow(pair, "a long, b long").distinct()


def _unsettled(rows: DataFrame, high: int) -> DataFrame:
    """Rows of keys with nodes at distances of ``high`` or more and of several components."""
    open_keys = rows.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("m"), F.min("c").alias("low"), F.max("c").alias("top")).where((F.col("m") > high) & (F.col("low") < F.col("top")))
    return rows.join(open_keys.select("k"), F.col("key") == F.col("k"), "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left, right = (sets.select(F.col("node").alias(f"{c}_node"), F.col("hashes").alias(c)) for c in ("x", "y"))
    met = pairs.join(left, F.col("a") == F.col("x_node")).join(right, F.col("b") == F.col("y_node"))
    return met.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def roots(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(c_node, root) for every node that is linked. ``rows`` has d, h, text; ``nodes`` is a stored table of node, n, fp, keys and the d and h of one of its rows."""
    spark = nodes.sparkSession
    state, close = durable(_shared(nodes)), durable(_close(nodes))
    found = spark.createDataFrame([], "c_node long, root long")
    if state.isEmpty() and close.isEmpty():
        return found
    met = state.select(F.col("node").alias("s_node")).unionAll(close.select("a")).unionAll(close.select("b")).distinct()
    wanted = nodes.join(met, F.col("node") == F.col("s_node"), "left_semi").select(F.col("d").alias("k_d"), F.col("h").alias("k_h"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            hashes = [shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([name(x) for x in hashes], pa.int64()), pa.array([x.tobytes() for x in hashes], pa.binary())], ["node", "hashes"])

    texts = rows.join(wanted, same({"d": "k_d", "h": "k_h"}), "left_semi").select("text")
    sets = durable(texts.mapInArrow(gather, "node long, hashes binary").dropDuplicates(["node"]))
    state, edges = state.withColumn("c", F.col("node")), []
    low, high, rare = 1, NEXT, False
    while True:
        pairs = _pairs(state, low, high)
        if close is not None:
            pairs, close = pairs.unionAll(close).distinct(), None
        new = durable(_verified(pairs, sets))
        if not new.isEmpty():
            edges.append(new)
            every = edges[0]
            for other in edges[1:]:
                every = every.unionAll(other)
            found = durable(components(every).select(F.col("node").alias("c_node"), "root"))
            edges = [found.select(F.col("c_node").alias("a"), F.col("root").alias("b"))]
            state = state.drop("c").join(found, F.col("node") == F.col("c_node"), "left").select("key", "n", "node", "reach", F.coalesce("root", "node").alias("c"))
        state = durable(_unsettled(state, high))
        if not rare and high >= FAR and not state.isEmpty():
            state, rare, high = durable(_rare(state, sets)), True, 1
        if state.isEmpty():
            return found
        low, high = high, max(NEXT, high * GROW)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id (null last), of several such the one with the smallest hash of its text.

    Rows are told by doc_id and that hash; of rows that share both, one stays. Columns as they came.
    """
    rows = docs.select(F.struct("*").alias("input"), F.col("doc_id").alias("d"), F.xxhash64(whole("text")).alias("h"))
    texts = rows.select("d", "h", F.col("input.text").alias("text"))
    marked = durable(_marked(texts))
    order = F.struct(F.col("d").isNull().alias("none"), "d", "h")
    nodes = durable(marked.groupBy("node").agg(F.min(order).alias("first"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
                    .select("node", "n", "fp", "keys", F.col("first.d").alias("d"), F.col("first.h").alias("h")))
    rooted = nodes.join(roots(texts, nodes), F.col("node") == F.col("c_node"), "left").select(F.coalesce("root", "node").alias("r"), "d", "h")
    first = rooted.groupBy("r").agg(F.min(order).alias("first"))
    keep = durable(first.select(F.col("first.d").alias("k_d"), F.col("first.h").alias("k_h")))
    kept = rows.join(keep, same({"d": "k_d", "h": "k_h"}), "left_semi")
    most = marked.groupBy("d", "h").count().agg(F.max("count")).first()[0] or 1
    return numbered(kept, ["d", "h"], most).where("copy = 1").select("input.*")
