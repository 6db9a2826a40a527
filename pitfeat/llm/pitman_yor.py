"""LM scoring by a hierarchical Pitman-Yor model: context restaurants share a parent, seatings are sampled by Gibbs sweeps, predictions averaged.

A token's context is the word before it, the end mark at the start of a text; every different word is a restaurant of its own, so what is learnt grows with the
corpus. A restaurant's dishes are words, and new tables draw their dish from the root restaurant, whose own base is uniform over all training words and one for the unknown.
A sweep seats the customers of every dish anew, one after another, given the tables of all other dishes: table counts of the restaurant and the root's
probabilities, as of the sweep before. From the ``EXACT``-th customer of a dish on they are seated in blocks of 1/32 of those seated, by binomial draws. A dish with one
customer has one table. Concentrations are drawn on a grid from their likelihood given the tables; discounts follow from the words met once and twice.

Data flow. Tokens are counted in groups of ``GROUP_BYTES``: each different (word, context) is asked for once per group, in one block per bucket of words, with its count in
the group's training documents. A bucket owns its words twice: as dishes, in all contexts, so that the root's counts are local; and as restaurants, whose customers
are the word's own count. A sweep is two exchanges between buckets: a bucket seats its dishes and sends the tables of each restaurant, summed, to the restaurant's
bucket, which adds them up and sends the total back to those that asked. Only dishes with two customers or more take part; the others are counted
once. Each sweep's seating is a stored table with one row per bucket. The driver sees totals and a likelihood per grid point, whatever the number of restaurants.
At the end each bucket answers every group's questions, and documents are summed where answers meet the group's recipe. A word that makes up a third of all
tokens is one entry per group as a dish or a restaurant, and one sum per bucket and sweep.

Words are told apart by 64-bit hashes. Two readings of the input must give the same rows in the same order, as stored tables do.

Edge cases. Null or empty text is one end token. A null doc_id trains. Without training documents all probabilities are those of the unknown word. Equal rows each come out;
all of them train. Nothing in, nothing out. Extra columns are not read.
"""

from __future__ import annotations

import io
import math
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from pitfeat.llm.common import crc_mod, documents, pieces, query, small
from pitfeat.session import durable

GROUP_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20  # of text; of the stored table
BURN_IN, SAMPLES, SEED = 2, 3, 11
EXACT, BLOCK = 64, 32
END_HASH = (1 << 64) - 1  # the end of a text; as a context, the start of one
ADD = 0.1
GRID = np.exp(np.linspace(math.log(0.1), math.log(1e6), 60))
OWN, RECIPE = -1, -1  # senders of a bucket's own state and of a group's recipe: before all buckets
MESSAGES = "bucket long, sender long, block binary, sums array<double>"


class _Planes(pickle.Pickler):
    """Arrays by planes, all lowest bytes first: small numbers in wide types cost next to nothing once compressed."""

    def reducer_override(self, x):
        if type(x) is np.ndarray and x.ndim == 1 and x.itemsize > 1:
            return _joined, (x.dtype.str, np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())
        return NotImplemented


def _joined(kind: str, planes: bytes) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _pack(things, level: int = 3) -> bytes:
    out = io.BytesIO()
    _Planes(out, 5).dump(things)
    return zstandard.ZstdCompressor(level).compress(out.getbuffer())


def _unpack(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Group:
    """The tokens of some documents as ranks of the group's words, which are in the order of bucket and hash."""

    def __init__(self, texts: list[str], train: list[bool], buckets: int) -> None:
        numbers = _Numbers()
        parts, lengths = [], []
        for text in texts:
            words = text.encode().lower().split()  # bytes: A-Z only, the six white space characters only
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            lengths.append(len(words) + 1)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in numbers] + [END_HASH], np.uint64)
        order = np.lexsort((hashes, hashes % np.uint64(buckets)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        end = np.array([len(hashes) - 1])
        self.token = rank[np.concatenate([x for p in parts for x in (p, end)]) if parts else end[:0]].astype(np.uint32)
        self.lengths, self.train = np.array(lengths, np.int64), np.array(train, bool)
        self.words, self.end = hashes[order], int(rank[end[0]])
        self.bucket = (self.words % np.uint64(buckets)).astype(np.int64)

    def questions(self) -> Iterator[tuple[int, tuple]]:
        """(bucket, (word hashes, pairs per word, different context hashes, the place of each pair's context among them, counts))."""
        pairs, at = pairs_of(self.token, self.lengths, self.end, len(self.words))
        count = np.bincount(at[np.repeat(self.train, self.lengths)], minlength=len(pairs)).astype(np.uint32)
        word, context = pairs // len(self.words), pairs % len(self.words)
        per_word = np.bincount(word, minlength=len(self.words)).astype(np.uint32)
        some = np.unique(self.bucket)
        edges = np.searchsorted(self.bucket, np.append(some, some[-1] + 1))
        cuts = np.searchsorted(word, edges)
        for k, b in enumerate(some.tolist()):
            w, p = slice(edges[k], edges[k + 1]), slice(cuts[k], cuts[k + 1])
            contexts, place = np.unique(context[p], return_inverse=True)  # in the order of bucket and hash
            yield b, (self.words[w], per_word[w], self.words[contexts], place.astype(np.uint32), count[p])


def pairs_of(token: np.ndarray, lengths: np.ndarray, end: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different word * ``words`` + context of some documents, sorted, and each token's place among them."""
    before = np.empty(len(token), np.int64)
    before[1:] = token[:-1]
    before[np.cumsum(lengths) - lengths] = end
    return np.unique(token.astype(np.int64) * words + before, return_inverse=True)


def _grouped(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[int, list, list[bool], Group]]:
    """(group number, keys, held out, tokens); the same for every reading of the same partition."""
    n = 0
    keys, texts, held, size = [], [], [], 0
    for batch in small(batches):
        part = batch.column("part")[0].as_py() if batch.num_rows else 0  # of the scan, whatever plan stands around it
        for key, text, out in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "held_out"))):
            keys.append(key)
            texts.append(text or "")
            held.append(out)
            size += len(texts[-1]) + 16
            if size >= GROUP_BYTES:
                yield part << 32 | n, keys, held, Group(texts, [not x for x in held], buckets)
                keys, texts, held, size, n = [], [], [], 0, n + 1
    if keys:
        yield part << 32 | n, keys, held, Group(texts, [not x for x in held], buckets)


class Model(NamedTuple):
    """What is known of the whole corpus before a sweep: a few numbers."""

    tokens: int
    words: int
    discount: float
    root_discount: float
    root_customers: float = 0.0
    root_tables: float = 0.0
    strength: float = 1.0
    root_strength: float = 1.0

    def root_probability(self, below: np.ndarray, root: np.ndarray) -> np.ndarray:
        base = (self.root_strength + self.root_discount * self.root_tables) / (self.words + 1)
        return (below - self.root_discount * root + base) / (self.root_strength + self.root_customers)


def seat(rng: np.random.Generator, count: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Tables of each dish when its ``count`` customers sit down one after another; ``others``: tables of all other dishes, ``parent``: the dish's probability."""
    tables = np.minimum(count, 1).astype(np.float64)
    left, i = np.flatnonzero(count > 1), 1
    while len(left):
        step = 1 if i < EXACT else i // BLOCK
        new = (strength + discount * (others[left] + tables[left])) * parent[left]
        p = new / (new + i - discount * tables[left])
        some = np.minimum(step, count[left] - i)
        tables[left] += rng.random(len(left)) < p if step == 1 else rng.binomial(some, p)
        i += step
        left = left[count[left] > i]
    return tables


class Bucket:
    """The words of a bucket, as dishes (``below``, ``root``: customers and tables in the root) and as restaurants (``customers``, ``tables``).

    ``word``, ``count``, ``seated``, ``at``: of each dish with two customers or more, its word, customers, tables and restaurant, as a place in the restaurants that the bucket
    asks for; ``asks``: their part of each other bucket, as (bucket, from, to). ``links``: who asks for which restaurants of this bucket.
    """

    def __init__(self, words: np.ndarray, word: np.ndarray, context: np.ndarray, count: np.ndarray, buckets: int) -> None:
        self.words = words
        self.customers = np.bincount(word, weights=count, minlength=len(words)).astype(np.int64)
        more = count > 1
        self.single = np.bincount(word[~more], minlength=len(words))
        self.word, self.count = word[more], count[more]
        self.seated = np.ones(len(self.word), np.uint32)
        self.alone, self.alone_n = np.unique(context[~more], return_counts=True)
        asked, self.at = np.unique(context[more], return_inverse=True)
        order = np.lexsort((asked, asked % np.uint64(buckets)))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.at, self.asked = place[self.at], asked[order]
        self.asks = _cut(self.asked, buckets)
        self.below = self.single + np.bincount(self.word, minlength=len(words))
        self.root = np.minimum(self.below, 1)
        self.links: list[tuple[int, np.ndarray]] = []
        self.samples: list[tuple] = []

    def contents(self) -> list[float]:
        """Tokens, words, dishes with one and with two customers, words in one and in two contexts."""
        return [float(x) for x in (self.customers.sum(), (self.below > 0).sum(), self.single.sum(), (self.count == 2).sum(), (self.below == 1).sum(), (self.below == 2).sum())]

    def introduce(self, buckets: int) -> Iterator[tuple[int, tuple]]:
        """(bucket, (restaurants of dishes with one customer, how many, restaurants asked for)); the bucket keeps places only."""
        order = np.lexsort((self.alone, self.alone % np.uint64(buckets)))
        alone, n = self.alone[order], self.alone_n[order]
        parts = {b: (alone[lo:hi], n[lo:hi].astype(np.uint32)) for b, lo, hi in _cut(alone, buckets)}
        asks = {b: self.asked[lo:hi] for b, lo, hi in self.asks}
        none = alone[:0]
        for b in sorted({*parts, *asks}):
            yield b, (*parts.get(b, (none, none.astype(np.uint32))), asks.get(b, none))
        del self.alone, self.alone_n, self.asked

    def meet(self, introductions: list[tuple[int, tuple]]) -> None:
        """Tables of dishes with one customer, and the links to buckets whose dishes have more."""
        self.lone = np.zeros(len(self.words), np.int64)
        for sender, (alone, n, asked) in introductions:
            self.lone[np.searchsorted(self.words, alone)] += n
            if len(asked):
                self.links.append((sender, np.searchsorted(self.words, asked).astype(np.uint32)))
        del self.words

    def sums(self) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, tables in each of its restaurants that this bucket asks for)."""
        total = np.bincount(self.at, weights=self.seated, minlength=max((hi for _, _, hi in self.asks), default=0)).astype(np.uint32)
        for b, lo, hi in self.asks:
            yield b, total[lo:hi]

    def add(self, sums: list[tuple[int, np.ndarray]]) -> None:
        self.tables = self.lone.copy()
        for (sender, at), (other, n) in zip(self.links, sums, strict=True):
            assert sender == other
            self.tables[at] += n

    def replies(self) -> Iterator[tuple[int, np.ndarray]]:
        for sender, at in self.links:
            yield sender, self.tables[at].astype(np.uint32)

    def sweep(self, number: int, n: int, replies: list[tuple[int, np.ndarray]], model: Model) -> None:
        """Seats the dishes, then the root's; ``replies`` come in the order of ``asks``."""
        rng = np.random.default_rng([SEED, n, number])
        inside = np.concatenate([t for _, t in replies]).astype(np.float64) if replies else np.zeros(0)
        p = model.root_probability(self.below, self.root)
        self.seated = seat(rng, self.count, inside[self.at] - self.seated, p[self.word], model.discount, model.strength).astype(np.uint32)
        self.below = self.single + np.bincount(self.word, weights=self.seated, minlength=len(self.single)).astype(np.int64)
        base = np.full(len(self.below), 1.0 / (model.words + 1))
        self.root = seat(rng, self.below, model.root_tables - self.root, base, model.root_discount, model.root_strength).astype(np.uint32)

    def keep(self) -> None:
        """This seating is one that predictions are averaged over."""
        self.samples.append((self.seated, self.below, self.root, self.tables))

    def totals(self, model: Model) -> list[float]:
        """Customers and tables of the root, then the log likelihood of this bucket's restaurants at each strength of the grid."""
        return [float(self.below.sum()), float(self.root.sum()), *likelihood(self.customers, self.tables, model.discount)]


def _cut(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of hashes sorted by bucket."""
    of = hashes % np.uint64(buckets)
    some, first = np.unique(of, return_index=True)
    return list(zip(some.tolist(), first.tolist(), [*first.tolist()[1:], len(of)]))


def likelihood(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """Log likelihood of the strengths in ``GRID`` given customers and tables per restaurant, but for a constant."""
    some = tables > 0
    (c, c_n), (t, t_n) = (np.unique(x[some].astype(np.int64), return_counts=True) for x in (customers, tables))
    c, c_n, t, t_n = (x.tolist() for x in (c, c_n, t, t_n))
    n = sum(c_n)
    return np.array([sum(k * math.lgamma(s / discount + b) for b, k in zip(t, t_n)) - sum(k * math.lgamma(s + a) for a, k in zip(c, c_n))
                     + n * (math.lgamma(s + 1) - math.lgamma(s / discount + 1)) for s in GRID])


def draw(rng: np.random.Generator, log: np.ndarray) -> float:
    p = np.exp(log - log.max())
    return float(rng.choice(GRID, p=p / p.sum()))


def merged(questions: list[tuple], buckets: int) -> tuple[Bucket, list[tuple]]:
    """A bucket of its questions, and for each question the places of its words, the customers of its pairs, and the places of those dishes that have two or more."""
    words = np.unique(np.concatenate([q[0] for q in questions]))
    contexts = np.unique(np.concatenate([q[2] for q in questions]))
    place = np.concatenate([np.searchsorted(contexts, q[2])[q[3]] for q in questions])
    word = np.concatenate([np.searchsorted(words, q[0]).astype(np.uint32) for q in questions])
    pairs, at = np.unique(np.repeat(word, np.concatenate([q[1] for q in questions])).astype(np.int64) * len(contexts) + place, return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([q[4] for q in questions]), minlength=len(pairs)).astype(np.int64)
    dish = total > 0
    bucket = Bucket(words, pairs[dish] // len(contexts), contexts[pairs[dish] % len(contexts)], total[dish], buckets)
    number = np.cumsum(total > 1) - 1
    asked, w, p = [], 0, 0
    for q in questions:
        mine = at[p:p + len(q[3])]
        count = total[mine].astype(np.uint32)
        asked.append((word[w:w + len(q[0])], count, number[mine[count > 1]].astype(np.uint32)))
        w, p = w + len(q[0]), p + len(q[3])
    return bucket, asked


def answer(bucket: Bucket, asked: tuple) -> tuple:
    """(customers per word, customers per pair, per seating: tables per pair with two customers or more, and per word customers and tables in the root and tables inside)."""
    word, count, dish = asked
    return bucket.customers[word], count, [(seated[dish], below[word], root[word], tables[word]) for seated, below, root, tables in bucket.samples]


def predicted(answers: list[tuple], pairs: np.ndarray, models: list[Model]) -> np.ndarray:
    """The averaged probability of a group's pairs, from the answers of all buckets in their order."""
    customers = np.concatenate([a[0] for a in answers]).astype(np.float64)
    count = np.concatenate([a[1] for a in answers]).astype(np.float64)
    word, context = pairs // len(customers), pairs % len(customers)
    mean = np.zeros(len(pairs))
    for n, model in enumerate(models):
        seated, below, root, tables = (np.concatenate([a[2][n][k] for a in answers]).astype(np.float64) for k in range(4))
        p0 = model.root_probability(below, root)
        own = np.minimum(count, 1)
        own[count > 1] = seated
        share = (model.strength + model.discount * tables) / (model.strength + customers)
        mean += (count - model.discount * own) / (model.strength + customers[context]) + share[context] * p0[word]
    return mean / len(models)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int64(), "sender": pa.int64(), "block": pa.binary(), "sums": pa.list_(pa.float64())}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds.values())], list(kinds))


def _by(column: str, batches: Iterator[pa.RecordBatch], *others: str) -> Iterator[tuple[int, list[tuple]]]:
    """(value, its rows of the other columns) of batches sorted by a column."""
    last, found = None, []
    for batch in batches:
        for value, *rest in zip(*(batch.column(c).to_pylist() for c in (column, *others))):
            if value != last and found:
                yield last, found
                found = []
            last = value
            found.append(tuple(rest))
    if found:
        yield last, found


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Bucket, list[tuple]]]:
    """(bucket number, bucket, its messages in the order of their senders)."""
    for number, found in _by("bucket", batches, "sender", "block"):
        (own, state), *messages = found
        assert own == OWN
        yield number, _unpack(state), [(s, _unpack(block)) for s, block in messages]


def _sent(number: int, bucket: Bucket, messages: Iterator[tuple], sums: list[float] | None = None) -> pa.RecordBatch:
    out = [(b, number, _pack(m), None) for b, m in messages]
    return _rows([(number, OWN, _pack(bucket), sums), *out])


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "sender")


def _total(df: DataFrame) -> list[float]:
    """The sums of all buckets, by place; as many numbers as a bucket has."""
    each = df.where("sums is not null").select(F.posexplode("sums").alias("at", "v"))
    return [r.v for r in each.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()]


def train(stored: DataFrame, buckets: int) -> tuple[DataFrame, list[Model]]:
    """The last seating, with the kept ones, as a row per bucket; and what was known of the corpus at each kept seating."""
    def introduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("bucket").to_pylist(), batch.column("dishes").to_pylist()):
                bucket = _unpack(data)
                messages = list(bucket.introduce(buckets))
                yield _sent(number, bucket, messages)

    tokens, words, once, twice, root_once, root_twice = _total(stored) or [0.0] * 6
    bounded = lambda a, b: min(0.95, max(0.1, a / (a + 2 * b) if a else 0.5))
    model = Model(int(tokens), int(words), bounded(once, twice), bounded(root_once, root_twice))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, bucket, messages in _met(batches):
            bucket.meet(messages)
            yield _sent(number, bucket, bucket.sums())

    def seated(n: int, model: Model):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, bucket, messages in _met(batches):
                bucket.sweep(number, n, messages, model)
                yield _sent(number, bucket, bucket.sums())

        return run

    def added(keep: bool, model: Model):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, bucket, messages in _met(batches):
                bucket.add(messages)
                if keep:
                    bucket.keep()
                yield _sent(number, bucket, bucket.replies(), bucket.totals(model))

        return run

    rng = np.random.default_rng(SEED)
    sent = _dealt(stored.select("bucket", "dishes").mapInArrow(introduced, MESSAGES), buckets).mapInArrow(opened, MESSAGES)
    kept = []
    for n in range(-1, BURN_IN + SAMPLES):  # -1: a table for each dish
        if n >= 0:
            sent = _dealt(sent, buckets).mapInArrow(seated(n, model), MESSAGES)
        sent = durable(_dealt(sent, buckets).mapInArrow(added(n >= BURN_IN, model), MESSAGES))
        got = _total(sent)
        if not got:  # no rows at all
            continue
        customers, tables, *log = got
        root = likelihood(np.array([customers]), np.array([tables]), model.root_discount)
        model = model._replace(root_customers=customers, root_tables=tables, strength=draw(rng, np.array(log)), root_strength=draw(rng, root))
        if n >= BURN_IN:
            kept.append(model)
    return sent.where(F.col("sender") == OWN).select("bucket", "block"), kept


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; rows with ``held_out`` don't train."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"), held_out.alias("held_out"), F.spark_partition_id().alias("part"))
    buckets = pieces(rows, BUCKET_BYTES, 1)  # by size alone, as every two buckets may have something to tell each other

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, _, _, group in _grouped(batches, buckets):
            yield _rows([(b, g, _pack(q), None) for b, q in group.questions()])

    def recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, keys, held, group in _grouped(batches, buckets):
            yield _rows([(g, RECIPE, _pack((keys, held, group.lengths, group.token, group.end)), None)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, found in _by("bucket", batches, "sender", "block"):
            bucket, asked = merged([_unpack(block) for _, block in found], buckets)
            every = pickle.dumps([(g, _pack(a)) for (g, _), a in zip(found, asked)], 5)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([_pack(bucket)], pa.binary()), pa.array([every], pa.binary()),
                                              pa.array([bucket.contents()], pa.list_(pa.float64()))], ["bucket", "dishes", "asked", "sums"])

    asked = _dealt(rows.mapInArrow(ask, MESSAGES), buckets)
    stored = durable(asked.mapInArrow(merge, "bucket long, dishes binary, asked binary, sums array<double>"))
    seatings, models = train(stored, buckets)
    tokens, words = (models[-1].tokens, models[-1].words) if models else (0, 0)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, found in _by("bucket", batches, "sender", "block"):
            bucket, questions = _unpack(found[0][1]), pickle.loads(found[1][1])
            for g, asked in questions:
                yield _rows([(g, number, _pack(answer(bucket, _unpack(asked))), None)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _by("bucket", batches, "sender", "block"):
            keys, held, lengths, token, end = _unpack(found[0][1])
            answers = [_unpack(block) for _, block in found[1:]]
            known = np.concatenate([a[0] for a in answers])
            pairs, at = pairs_of(token, lengths, end, len(known))
            model = np.log10(predicted(answers, pairs, models))[at]
            base = np.log10((known + ADD) / (tokens + ADD * (words + 1)))
            starts = np.cumsum(lengths) - lengths
            columns = [pa.array(keys, pa.int64()), pa.array(held, pa.bool_()), pa.array(lengths), pa.array(np.add.reduceat((known > 0)[token].astype(np.int64), starts)),
                       pa.array(np.full(len(keys), tokens)), pa.array(np.add.reduceat(base[token], starts)), pa.array(np.add.reduceat(model, starts))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    # the seating first, then the questions of the same bucket
    both = seatings.select("bucket", F.lit(OWN).cast("long").alias("sender"), "block").unionAll(stored.select("bucket", F.lit(0).cast("long"), "asked"))
    given = _dealt(both, buckets).mapInArrow(answered, MESSAGES).drop("sums").unionAll(rows.mapInArrow(recipes, MESSAGES).drop("sums"))
    met = given.repartition(buckets, "bucket").sortWithinPartitions("bucket", "sender")  # here "bucket" is the group
    return met.mapInArrow(add, "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


@query("op7_pitman_yor")
def op7_pitman_yor(spark, sf_dir):
    return score(documents(spark, sf_dir), F.col("doc_id").isNotNull() & (crc_mod("doc_id", 10) == 0)).withColumnRenamed("key", "doc_id")
