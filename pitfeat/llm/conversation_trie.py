"""Conversation prefix trie: z-fast tries over ranges of conversations, joined where ranges share a path.

A conversation is a sequence of turn digests (128 bits of SHA-256 over role and text). Conversations are range-partitioned by (sequence, conv_id), so a group of equal or
similar ones of whatever size is spread over tasks by conv_id. Each task inserts its conversations, batch by batch, into a compacted trie whose nodes are hashed at their
handle, the prefix of two-fattest length on the node's edge: fat binary search finds the exit node of a conversation in as many look-ups as its length has bits, every hit is
verified on the digests, and the edge is split there. Expanding the edges then gives a row for every prefix.

Only prefixes of a range's first and last conversation can occur in another range. A task returns these as partial figures under a digest of the prefix; grouping them
finds how far a range's first path was there before and whether its last path goes on after it, takes what was counted twice out, and adds the parts up. Everything
else is final. Savings need no second walk: over the subtree of a node at depth d, sum (n - 1) * bytes is the members' whole bytes, less n times the bytes above d, less the
bytes of the distinct nodes.

Long conversations. Turns are numbered by running counts in blocks where one conversation has very many. Sequences are cut into segments of ``SEGMENT`` turns; a
segment after the first belongs to a trie of its own under the digest of all turns before. These layers are built from the deepest up, each handing the figures of
its roots to the nodes above. So no task ever holds more than ``SEGMENT`` turns of a conversation. Conversations of fewer turns make one layer.

The list of conversations that end at a node is hashed in numeric order. As SHA-256 is a chain, the ids of one node pass through one task, as a stream of short pieces.

Edge cases. A null conv_id is no conversation: its rows are left out. Null role or text is empty. Turns with equal numbers come in the order of their digests; repeated rows
are repeated turns. A conversation without turns after rebuilding ends at the root. No conversations: no nodes, not even a root. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pitfeat.llm.common import pieces, query, whole
from pitfeat.llm.token_files import mix64
from pitfeat.operators.ordered import HOT_ROWS, ordinal
from pitfeat.session import durable

SEGMENT, PART_BYTES, PIECE_IDS = 4096, 8 << 20, 1000
BROADCAST_BYTES, NODE_BYTES = 32 << 20, 64
WIDE = 16  # bytes of a turn's digest
SHARED_TURNS, FAMILY = 9, 5


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the largest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


def prefix_hashes(digests: bytes, starts: np.ndarray) -> np.ndarray:
    """For each symbol of several sequences put together, a 64-bit hash of its sequence up to there; ``starts``: where each sequence begins."""
    lanes = np.frombuffer(digests, "<u8").reshape(-1, 2)
    at = np.arange(len(lanes)) - np.repeat(starts, np.diff(np.r_[starts, len(lanes)]))
    step = mix64(mix64(lanes[:, 0], 1) + lanes[:, 1] + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 2)
    run = np.r_[np.uint64(0), np.bitwise_xor.accumulate(step)] if len(step) else np.zeros(1, np.uint64)
    return run[1:] ^ np.repeat(run[starts], np.diff(np.r_[starts, len(lanes)]))


class Trie:
    """A z-fast trie of symbol sequences (bytes, ``WIDE`` a symbol). Node 0 is the empty sequence."""

    def __init__(self) -> None:
        self.above, self.upto, self.parent, self.rep, self.hashes, self.kids = [0], [0], [0], [b""], [np.zeros(0, np.uint64)], [{}]
        self.table: dict[int, int] = {}

    def _handle(self, g: int) -> int:
        return int(self.hashes[g][two_fattest(self.above[g], self.upto[g]) - 1])

    def _new(self, above: int, upto: int, parent: int, rep: bytes, hashes: np.ndarray) -> int:
        g = len(self.upto)
        for kept, value in ((self.above, above), (self.upto, upto), (self.parent, parent), (self.rep, rep), (self.hashes, hashes), (self.kids, {})):
            kept.append(value)
        self.table[self._handle(g)] = g
        self.kids[parent][rep[WIDE * above:WIDE * (above + 1)]] = g
        return g

    def _common(self, g: int, x: bytes, low: int, n: int) -> int:
        """Symbols that ``x`` shares with the extent of ``g``, of which ``low`` are known."""
        high = min(n, self.upto[g])
        a, b = (np.frombuffer(s, "<u8")[2 * low:2 * high] for s in (x, self.rep[g]))
        other = np.flatnonzero(a != b)
        return low + int(other[0]) // 2 if len(other) else high

    def exit(self, x: bytes, hashes: np.ndarray) -> tuple[int, int]:
        """The exit node of ``x`` and the length that they share."""
        a, b, node = 0, len(hashes), 0
        n = b
        while a < b:
            f = two_fattest(a, b)
            g = self.table.get(int(hashes[f - 1]))
            if g is None or self.rep[g][:WIDE * f] != x[:WIDE * f]:
                b = f - 1
                continue
            e = self.upto[g]
            if e > n or self.rep[g][WIDE * f:WIDE * e] != x[WIDE * f:WIDE * e]:
                return g, self._common(g, x, f, n)
            node, a = g, e
        child = self.kids[node].get(x[WIDE * a:WIDE * (a + 1)]) if a < n else None
        return (node, a) if child is None else (child, self._common(child, x, a, n))

    def insert(self, x: bytes, hashes: np.ndarray) -> int:
        """The node at which ``x`` ends."""
        g, shared = self.exit(x, hashes)
        if shared < self.upto[g]:  # cut the edge
            del self.table[self._handle(g)]
            mid = self._new(self.above[g], shared, self.parent[g], self.rep[g][:WIDE * shared], self.hashes[g][:shared])
            self.above[g], self.parent[g] = shared, mid
            self.kids[mid][self.rep[g][WIDE * shared:WIDE * (shared + 1)]] = g
            self.table[self._handle(g)] = g
            g = mid
        return g if shared == len(hashes) else self._new(shared, len(hashes), g, x, hashes)

    def down(self) -> list[int]:
        """All nodes but node 0, parents first."""
        out, todo = [], [0]
        while todo:
            g = todo.pop()
            out.append(g)
            todo.extend(self.kids[g].values())
        return out[1:]


def _sha(ids: list[int]) -> str:
    return sha256(",".join(map(str, ids)).encode()).hexdigest()


FIGURES = ["conv", "n", "kids", "leaves", "total", "own", "before"]
NODE = {"part": pa.int64(), "i": pa.int64(), **{c: pa.int64() for c in FIGURES}, "parent": pa.int64(), "ends_sha256": pa.string(), "key": pa.binary(), "parent_key": pa.binary(),
        "on_first": pa.bool_(), "on_last": pa.bool_(), "last_end": pa.bool_(), "upto": pa.int64(), "chunks": pa.list_(pa.string())}
NODE_DDL = ("part long, i long, " + ", ".join(f"{c} long" for c in FIGURES) + ", parent long, ends_sha256 string, key binary, parent_key binary, on_first boolean, on_last boolean, "
            "last_end boolean, upto long, chunks array<string>")


class _Range:
    """The trie of one range of conversations and the figures of its nodes."""

    def __init__(self, part: int, full: int) -> None:
        self.part, self.full, self.trie = part, full, Trie()
        self.first = self.last = None  # (sequence, conv_id) and the node where it ends
        self.sizes: dict[int, np.ndarray] = {}  # bytes before each symbol, of one member of each end node
        self.ends: dict[int, list[tuple]] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        """Inserts a batch; columns c, root, syms, lens, before, total, ended, x_kids, x_leaves, x_bytes."""
        flat, off = batch.column("syms").flatten(), batch.column("syms").offsets.to_numpy()
        data = b"".join(flat.to_pylist())
        off = off - off[0]
        lens = batch.column("lens").flatten().to_numpy()
        roots = batch.column("root").to_pylist()
        xs = [roots[k] + data[WIDE * off[k]:WIDE * off[k + 1]] for k in range(len(roots))]
        starts = off[:-1] + np.arange(len(roots))
        hashes = prefix_hashes(b"".join(xs), starts)
        others = [batch.column(c).to_pylist() for c in ("c", "before", "total", "ended", "x_kids", "x_leaves", "x_bytes")]
        for k, (x, (c, before, *rest)) in enumerate(zip(xs, zip(*others))):
            n = len(x) // WIDE
            g = self.trie.insert(x, hashes[starts[k]:starts[k] + n])
            if g not in self.sizes:
                self.sizes[g] = before + np.r_[0, 0, np.cumsum(lens[off[k]:off[k + 1]])]
            self.ends.setdefault(g, []).append((c, *rest))
            if self.first is None or (x, c) < self.first[0]:
                self.first = (x, c), g
            if self.last is None or (x, c) > self.last[0]:
                self.last = (x, c), g

    def _chain(self, g: int) -> list[int]:
        out = []
        while g:
            out.append(g)
            g = self.trie.parent[g]
        return out[::-1]

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.first is None:
            return
        t, size = self.trie, len(self.trie.upto)
        order = t.down()
        # a node has the sizes of a conversation that ends below it; splitting keeps the shorter extents of the same sequence
        sizes: list = [None] * size
        n, total, leaves, below = [0] * size, [0] * size, [0] * size, [0] * size
        least: list = [None] * size
        kids = [len(k) for k in t.kids]
        for g in reversed(order):
            some = self.ends.get(g, ())
            sizes[g] = self.sizes.get(g, sizes[g])
            for c, whole_bytes, _, x_kids, x_leaves, x_bytes in some:
                n[g] += 1
                total[g] += whole_bytes
                kids[g] += x_kids
                leaves[g] += x_leaves
                below[g] += x_bytes
                least[g] = c if least[g] is None else min(least[g], c)
            if not t.kids[g] and t.upto[g] <= self.full:  # a full segment's leaves are counted in the layer below it
                leaves[g] += 1
            p = t.parent[g]
            n[p] += n[g]
            total[p] += total[g]
            leaves[p] += leaves[g]
            below[p] += below[g] + int(sizes[g][t.upto[g]] - sizes[g][t.above[g]])
            least[p] = least[g] if least[p] is None else min(least[p], least[g])
            if sizes[p] is None:
                sizes[p] = sizes[g]
        head, tail = self._chain(self.first[1]), self._chain(self.last[1])
        edge = {*head, *tail}
        keys = self._keys(head) | self._keys(tail)
        inner = [g for g in order if g not in edge]
        none = _sha([])
        for a in range(0, len(inner), 4096):
            some = inner[a:a + 4096]
            above, upto = (np.array([x[g] for g in some], np.int64) for x in (t.above, t.upto))
            count = upto - above
            which = np.repeat(np.arange(len(some)), count)
            i = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + above[which] + 1
            top, end = i == above[which] + 1, i == upto[which]
            before = np.concatenate([sizes[g][t.above[g]:t.upto[g]] for g in some])
            at_end = np.array([sizes[g][t.upto[g]] for g in some], np.int64)

            def spread(values: list) -> np.ndarray:
                return np.array([values[g] for g in some], np.int64)[which]

            shas = [_sha(sorted(c for c, _, ended, *_ in self.ends.get(g, ()) if ended)) for g in some]
            ups = [t.parent[g] for g in some]
            pk = [keys.get(t.upto[p], {}).get(p) for p in ups]
            up = np.array([least[g] if p == 0 else least[p] for p, g in zip(ups, some)], np.int64)[which]
            zeros = pa.nulls(len(i))
            yield self._batch({
                "part": np.full(len(i), self.part), "i": i, "conv": spread(least), "n": spread(n), "kids": np.where(end, spread(kids), 1), "leaves": spread(leaves),
                "total": spread(total), "own": spread(below) + at_end[which] - before, "before": before, "parent": np.where(top, up, spread(least)),
                "ends_sha256": [shas[w] if e else none for w, e in zip(which.tolist(), end.tolist())], "key": zeros,
                "parent_key": [pk[w] if x else None for w, x in zip(which.tolist(), top.tolist())],
                "on_first": zeros, "on_last": zeros, "last_end": zeros, "upto": zeros, "chunks": zeros})
        ends_in_leaf = t.upto[self.last[1]] <= self.full  # nothing in this range goes on from its last conversation
        rows: dict[str, list] = {c: [] for c in NODE}
        for g in sorted(edge, key=lambda g: t.upto[g]):
            for i in range(t.above[g] + 1, t.upto[g] + 1):
                end = i == t.upto[g]
                ids = sorted(c for c, _, ended, *_ in self.ends.get(g, ()) if ended) if end else []
                p = t.parent[g] if i == t.above[g] + 1 else g
                row = {"part": self.part, "i": i, "conv": least[g], "n": n[g], "kids": kids[g] if end else 1, "leaves": leaves[g], "total": total[g],
                       "own": below[g] + int(sizes[g][t.upto[g]] - sizes[g][i - 1]), "before": int(sizes[g][i - 1]), "parent": None, "ends_sha256": None, "key": keys[i][g],
                       "parent_key": keys[i - 1][p] if i > 1 else None, "on_first": g in head, "on_last": g in tail and ends_in_leaf,
                       "last_end": g == self.last[1] and end, "upto": int(sizes[g][i]),
                       "chunks": [",".join(map(str, ids[k:k + PIECE_IDS])) for k in range(0, len(ids), PIECE_IDS)] or None}
                for c, v in row.items():
                    rows[c].append(v)
            if len(rows["i"]) >= 4096:
                yield self._batch(rows)
                rows = {c: [] for c in NODE}
        yield self._batch(rows)

    def _keys(self, chain: list[int]) -> dict[int, dict[int, bytes]]:
        """Digests of all prefixes along a chain: by length, then by the node on whose edge they lie."""
        out: dict[int, dict[int, bytes]] = {}
        run = sha256()
        for g in chain:
            for i in range(self.trie.above[g] + 1, self.trie.upto[g] + 1):
                run.update(self.trie.rep[g][WIDE * (i - 1):WIDE * i])
                out.setdefault(i, {})[g] = run.copy().digest()[:WIDE]
        return _Levels(out)

    @staticmethod
    def _batch(columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([x.cast(k) if isinstance(x, pa.Array) else pa.array(x, k) for x, k in ((columns[c], k) for c, k in NODE.items())], list(NODE))


class _Levels(dict):
    """Digests by length and node; ``|`` joins the nodes of both sides."""

    def __or__(self, other: dict) -> dict:
        return _Levels({i: self.get(i, {}) | other.get(i, {}) for i in {*self, *other}})


def _layer(rows: DataFrame, full: int) -> DataFrame:
    """Nodes of one layer: i (1 for a root), the figures, parent, ends_sha256."""
    parts = pieces(rows, PART_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = _Range(TaskContext.get().partitionId(), full)
        for batch in batches:
            here.add(batch)
        yield from here.rows()

    raw = durable(rows.repartitionByRange(parts, "root", "syms", "c").mapInArrow(run, NODE_DDL))
    edge = raw.where("key is not null")
    spans = edge.groupBy("i", "key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    again = F.col("on_first") & (F.col("part") > F.col("lo"))
    per = edge.join(spans, ["i", "key"]).groupBy("part").agg(
        F.max(F.when(again, F.col("i"))).alias("shared"), F.max(F.when(again, F.col("upto"))).alias("shared_upto"),
        F.max(F.col("last_end") & (F.col("part") < F.col("hi"))).alias("goes_on"))
    once = edge.join(per, "part").select(
        "i", "key", "parent_key", "conv", "n", "total", "before",
        (F.col("kids") - F.when(F.col("on_first") & (F.col("shared") > F.col("i")), 1).otherwise(0)).alias("kids"),
        (F.col("leaves") - F.when(F.col("on_last") & F.col("goes_on"), 1).otherwise(0)).alias("leaves"),
        (F.col("own") - F.when(F.col("on_first") & (F.col("shared") >= F.col("i")), F.col("shared_upto") - F.col("before")).otherwise(0)).alias("own"))
    sums = once.groupBy("i", "key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv").alias("conv"), F.max("before").alias("before"), *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "total", "own")])
    merged = durable(sums.join(_ends(edge), ["i", "key"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_sha([])))))
    ups = merged.select((F.col("i") + 1).alias("i"), F.col("key").alias("parent_key"), F.col("conv").alias("up"))
    if merged.count() * NODE_BYTES <= BROADCAST_BYTES:  # two paths for each task
        ups = F.broadcast(ups)
    columns = ["i", *FIGURES, "ends_sha256", "parent", "parent_key"]
    every = raw.where("key is null").select(columns).unionByName(merged.withColumn("parent", F.lit(None).cast("long")).select(columns))
    return every.join(ups, ["i", "parent_key"], "left").withColumn("parent", F.coalesce("up", "parent")).drop("up", "parent_key")


def _ends(edge: DataFrame) -> DataFrame:
    """i, key and ends_sha256 of nodes at which conversations of several ranges may end: pieces of ids hashed in their order, as a stream."""
    chunks = edge.where("chunks is not null").select("i", "key", "part", F.posexplode("chunks").alias("at", "ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, sha256()
        for batch in batches:
            done = []
            for i, key, ids in zip(*(batch.column(c).to_pylist() for c in ("i", "key", "ids"))):
                if (i, key) != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (i, key), sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _ended(done)
        if node:
            yield _ended([(*node, state.hexdigest())])

    return chunks.repartition("i", "key").sortWithinPartitions("i", "key", "part", "at").mapInArrow(run, "i long, key binary, ends_sha256 string")


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    i, key, sha = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(key, pa.binary()), pa.array(sha)], ["i", "key", "ends_sha256"])


def digested(conversations: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """c, pos (from 0), sym and bytes of every turn."""
    role, text = whole("role"), whole("text")
    sym = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDE)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", sym.alias("sym"), F.octet_length(text).cast("long").alias("bytes"))
    return ordinal(durable(turns), ["c"], [F.col("turn").asc_nulls_first(), "sym"], "pos", hot_rows).select("c", "pos", "sym", "bytes")


def _shared(c: Column) -> Column:
    return F.crc32(c.cast("string")) % SHARED_TURNS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c, pos, sym, bytes) of the conversations that begin with the first turns of their family's first one, and (c, len) of every conversation."""
    sizes = turns.groupBy("c").agg(F.count("*").alias("had"))
    heads = sizes.select(F.col("c").alias("head"), F.col("had").alias("head_had"))
    sizes = sizes.withColumn("head", F.col("c") - F.col("c") % FAMILY).withColumn("h", _shared(F.col("c"))).join(heads, "head", "left")
    sizes = durable(sizes.select("c", "h", F.least("h", F.coalesce("head_had", F.lit(0))).alias("lent"), "had"))
    own = turns.join(sizes, "c").where("pos >= h").select("c", (F.col("lent") + F.col("pos") - F.col("h")).alias("pos"), "sym", "bytes")
    family = F.sequence(F.lit(1 - FAMILY).cast("long"), F.lit(FAMILY - 1).cast("long"))
    lent = turns.where((F.col("c") % FAMILY == 0) & (F.col("pos") < SHARED_TURNS)).select(
        F.col("c").alias("head"), F.explode(family).alias("k"), "pos", "sym", "bytes").withColumn("c", F.try_add("head", "k"))
    lent = lent.where((F.col("c") - F.col("c") % FAMILY == F.col("head")) & (F.col("pos") < _shared(F.col("c")))).join(sizes.select("c"), "c", "left_semi")
    lens = sizes.select("c", (F.col("lent") + F.greatest(F.col("had") - F.col("h"), F.lit(0))).alias("len"))
    return own.unionByName(lent.select("c", "pos", "sym", "bytes")), lens


def prefix_trie(turns: DataFrame, lens: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row for every distinct prefix: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: c, pos, sym, bytes; ``lens``: c, len of every conversation, those without turns included.
    """
    cut = turns.groupBy("c", F.expr(f"pos div {segment}").alias("seg")).agg(F.sort_array(F.collect_list(F.struct("pos", "sym", "bytes"))).alias("t"))
    cut = cut.select("c", "seg", F.col("t.sym").alias("syms"), F.col("t.bytes").alias("lens"))
    ends = lens.withColumn("end_seg", F.expr(f"len div {segment}"))
    # what ends with a full segment, or has no turns, ends in an empty one
    empty = ends.where(f"len % {segment} = 0").select("c", F.col("end_seg").alias("seg"), F.expr("cast(array() as array<binary>)").alias("syms"),
                                                      F.expr("cast(array() as array<long>)").alias("lens"))
    rows = durable(cut.unionByName(empty).withColumn("sum", F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)))
    top = rows.agg(F.max("seg")).first()[0]
    if top is None:
        top = 0
    if top == 0:
        rows = rows.select("c", "seg", "syms", "lens", F.lit(b"\0" * WIDE).alias("root"), F.lit(0).cast("long").alias("before"), F.col("sum").alias("total"),
                           F.lit(True).alias("ended"))
    else:
        spec = "partition by c order by seg rows between unbounded preceding and 1 preceding"
        marks = rows.select("c", "seg", "sum", F.xxhash64("seg", "syms").alias("d1"), F.xxhash64(F.lit(1), "seg", "syms").alias("d2")).join(ends.select("c", "len"), "c")
        marks = marks.select(
            "c", "seg", F.expr(f"unhex(concat(lpad(hex(coalesce(bit_xor(d1) over ({spec}), 0)), 16, '0'), lpad(hex(coalesce(bit_xor(d2) over ({spec}), 0)), 16, '0')))").alias("root"),
            F.expr(f"coalesce(sum(sum) over ({spec}), 0)").alias("before"), F.expr("sum(sum) over (partition by c)").alias("total"), "len")
        # a full segment that ends the conversation ends at its own last node, not at the empty one below
        ended = (F.col("len") > F.col("seg") * segment) & (F.col("len") <= (F.col("seg") + 1) * segment) | (F.col("len") == 0)
        rows = durable(rows.drop("sum").join(marks.withColumn("ended", ended).drop("len"), ["c", "seg"]))
    out, roots = [], None
    for seg in range(top, -1, -1):
        some = rows.where(F.col("seg") == seg).drop("seg")
        x = ["x_kids", "x_leaves", "x_bytes"]
        if roots is not None:
            some = durable(some.join(roots, "c", "left").fillna(0, x))
        else:
            some = some.select("*", *[F.lit(0).cast("long").alias(c) for c in x])
        nodes = _layer(some, segment)
        if seg:
            nodes = durable(nodes)
            roots = nodes.where("i = 1").select(F.col("conv").alias("c"), F.col("kids").alias("x_kids"), F.col("leaves").alias("x_leaves"), F.col("own").alias("x_bytes"))
            nodes = nodes.where("i > 1")
        out.append(nodes.select(
            F.col("conv").alias("conv_id"), (F.col("i") - 1 + seg * segment).alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("total") - F.col("n") * F.col("before") - F.col("own")).alias("saved_tokens"), "ends_sha256"))
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id")))


# crc32 bit by bit: each byte is xor-ed in, then eight shifts (-1)
_CRC = """xor(list_reduce([4294967295] || flatten(list_transform(range(1, 1 + length(c::varchar)), lambda i: [ascii(substr(c::varchar, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295) % 9"""

SQL = f"""with t as (
  select c, sym, bytes, row_number() over (partition by c order by turn nulls first, sym) - 1 as pos from (
    select conv_id as c, turn, strlen(coalesce(text, '')) as bytes, left(sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 32) as sym
    from conversations where conv_id is not null)),
convs as (select c, c - c % 5 as head, {_CRC} as h from (select distinct c from t)),
turns as (
  select v.c, 0 as own, t.pos, sym, bytes from convs v join t on t.c = v.head and t.pos < v.h
  union all select v.c, 1, t.pos, sym, bytes from convs v join t on t.c = v.c and t.pos >= v.h),
paths as (
  select c, bytes, row_number() over w as d, string_agg(sym, '') over w as prefix, count(*) over (partition by c) as len from turns
  window w as (partition by c order by own, pos rows between unbounded preceding and current row)
  union all select c, 0, 0, '', (select count(*) from turns where turns.c = convs.c) from convs),
nodes as (
  select prefix, d, min(c) as conv_id, count(*) as n_convs, any_value(bytes) as bytes, left(prefix, greatest(32 * (d - 1), 0)) as up,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where len = d), '')) as ends_sha256 from paths group by prefix, d),
kids as (select up, count(*) as n_children from nodes where d > 0 group by up),
every as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids on kids.up = nodes.prefix),
above as (select left(prefix, 32 * k) as prefix, sum((n_convs - 1) * bytes) as saved, count(*) filter (where n_children = 0) as n_leaves
  from (select *, unnest(range(0, d + 1)) as k from every) group by 1)
select e.conv_id, e.d as depth, p.conv_id as parent_conv_id, e.n_convs, e.n_children, n_leaves, saved::bigint as saved_tokens, e.ends_sha256
from every e join above a on a.prefix = e.prefix left join every p on e.d > 0 and p.prefix = e.up"""


@query("op13_conversation_trie", SQL)
def op13_conversation_trie(spark, sf_dir):
    turns, lens = rebuilt(digested(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return prefix_trie(turns, lens)
