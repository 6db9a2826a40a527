"""Phrase collocation mining: n-grams of word ids counted in counting quotient filters, which are sorted, lossless, and merged across shards.

Words. Texts are read in windows of about ``WINDOW_TOKENS`` words; each window lists its different words per language once, with their numbers of occurrences. Sums over all
windows give n and the words that occur ``least`` times or more; only these get ids, as a phrase is no more frequent than its words. Windows and ids meet in an
equality join on the word, in which the most frequent word has one row per window.

Counting. The ids of a phrase are packed into ``words * bits`` bits, 0 for places not used, and permuted by an invertible Feistel network. The first bits of the result choose the
shard; the next ones are the quotient, the rest the remainder, kept whole. A filter stores an occupied bit per quotient, an end bit, a remainder and a counter of one byte (with
longer ones apart) per different phrase, in sorted order: nothing is lost or estimated, and inverting the permutation gives the ids back. Tasks merge the windows they read
into one filter and send it in pieces of about ``PIECE`` phrases. The permutation spreads phrases evenly over shards of at most ``SHARD_GRAMS`` occurrences each, and however
frequent a phrase is, it is one counter per task. Where there are more shards than ``1 << FAN``, filters are dealt and merged in rounds of ``FAN`` bits,
so pieces keep their size.

Scores are joins of the counted phrases with their own parts, in exact decimals.

Edge cases. Null text is empty, null lang is ``und``. Control characters other than tab, line feed, vertical tab, form feed and carriage return are parts of words. Repeated rows
count each time. Nothing frequent, nothing out. Extra columns are not read. A long text is read in slices cut at separators; it may span windows, which end
between pieces only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pitfeat.llm.common import LOWER, UPPER, documents, pieces, query
from pitfeat.llm.token_files import mix64
from pitfeat.operators.ordered import BLOCK, ordered_blocks, running_in_blocks
from pitfeat.session import durable

WORDS, LEAST, TOP, DROP_PCT, UNIT = 3, 10, 2000, 50, 1_000_000
WINDOW_TOKENS, SLICE_BYTES, STREAM_IDS, NGRAM_IDS = 1 << 20, 1 << 20, 4096, 1 << 18
SHARD_GRAMS, FILTER_GRAMS, PIECE, FAN, ROUNDS = 1 << 21, 1 << 20, 2048, 9, 4
WINDOW_BYTES, BROADCAST_BYTES, WORD_BYTES, MOST_TASKS = 32 << 20, 32 << 20, 64, 1 << 14

# A-Z become a-z, what ends a piece becomes a byte that no UTF-8 has, tab becomes space.
_BREAK = b"\xff"
_FORM = bytes(32 if c == 9 else 0xFF if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Numbers(dict):
    """Numbers of words from 1 on, over all languages of a window."""

    def __init__(self, window: "_Window") -> None:
        self.window = window

    def __missing__(self, word: bytes) -> int:
        self.window.size += 1
        self[word] = n = self.window.size
        return n


class _Window:
    """Tokens as local numbers; 0 between pieces."""

    def __init__(self) -> None:
        self.size, self.tokens = 0, 0
        self.langs: dict[str, _Numbers] = {}
        self.stream: list[np.ndarray] = []

    def add(self, lang: str, words: list[bytes]) -> None:
        numbers = self.langs.get(lang)
        if numbers is None:
            self.langs[lang] = numbers = _Numbers(self)
            numbers[_BREAK] = 0
        self.stream.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
        self.tokens += len(words)

    def rows(self, key: int) -> Iterator[pa.RecordBatch]:
        stream = np.concatenate(self.stream)
        count = np.bincount(stream, minlength=self.size + 1)
        langs, words, at = [], [], []
        for lang, numbers in self.langs.items():
            numbers.pop(_BREAK)
            langs += [lang] * len(numbers)
            words += numbers.keys()
            at += numbers.values()
        places = np.array(at, np.int64)
        yield _rows(key, langs, pa.array(words, pa.binary()).cast(pa.string()), count[places], places, None, len(at))
        parts = [stream[k:k + STREAM_IDS].tobytes() for k in range(0, len(stream), STREAM_IDS)]
        yield _rows(key, None, None, None, np.arange(len(parts)), parts, len(parts))


def _rows(key: int, lang, word, n, at, ids, size: int) -> pa.RecordBatch:
    columns = [(np.full(size, key), pa.int64()), (lang, pa.string()), (word, pa.string()), (n, pa.int64()), (at, pa.int64()), (ids, pa.binary())]
    return pa.RecordBatch.from_arrays([pa.nulls(size, k) if x is None else pa.array(x, k) for x, k in columns], ["win", "lang", "word", "n", "at", "ids"])


def _slices(data: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """Words and breaks of a text in slices, and whether the slice ends where a piece does."""
    a = 0
    while len(data) - a > 2 * SLICE_BYTES:
        b = data.find(_BREAK, a + SLICE_BYTES, a + 2 * SLICE_BYTES)
        ended = b >= 0
        if not ended:  # one long piece: cut between words
            b = data.find(b" ", a + SLICE_BYTES)
            b = len(data) if b < 0 else b
        yield data[a:b + ended].replace(_BREAK, b" \xff ").split(b" "), ended
        a = b + ended
    yield data[a:].replace(_BREAK, b" \xff ").split(b" ") + [_BREAK], True


def windows(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Stored rows of two kinds: (win, lang, word, n, at) for each different word of a window, (win, at, ids) for its tokens."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, window = TaskContext.get().partitionId(), 0, _Window()
        for batch in batches:
            for j in range(batch.num_rows):
                lang, text = batch.column(0)[j].as_py(), batch.column(1)[j].as_py()
                for words, ended in _slices((text or "").encode().translate(_FORM)):
                    window.add(lang, [w for w in words if w])
                    if ended and window.tokens >= WINDOW_TOKENS:
                        yield from window.rows(part << 32 | k)
                        k, window = k + 1, _Window()
        if window.tokens:
            yield from window.rows(part << 32 | k)

    return durable(rows.mapInArrow(run, "win long, lang string, word string, n long, at long, ids binary"))


class Packing:
    """Phrases of up to ``words`` ids of ``bits`` bits as two halves of one number, permuted."""

    def __init__(self, words: int, bits: int) -> None:
        if words * bits > 126:
            raise ValueError(f"{words} words of {bits} bits do not fit 126 bits")
        self.words, self.bits = words, bits
        self.low = words * bits // 2
        self.high = words * bits - self.low
        if self.low < bits:
            raise ValueError("phrases have two words at least")

    @staticmethod
    def _mask(n: int) -> np.uint64:
        return np.uint64((1 << n) - 1)

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        hi, lo = np.zeros(len(ids[0]), np.uint64), np.zeros(len(ids[0]), np.uint64)
        for k in range(self.words):
            hi = hi << np.uint64(self.bits) | lo >> np.uint64(self.low - self.bits)
            lo = lo << np.uint64(self.bits) & self._mask(self.low)
            if k < len(ids):
                lo = lo | ids[k].astype(np.uint64)
        return self._permute(hi, lo, range(ROUNDS))

    def unpack(self, hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
        """Ids of the first, second, ... word; 0 for none."""
        hi, lo = self._permute(hi, lo, reversed(range(ROUNDS)), back=True)
        out = []
        for _ in range(self.words):
            out.append((lo & self._mask(self.bits)).astype(np.int64))
            lo = lo >> np.uint64(self.bits) | (hi & self._mask(self.bits)) << np.uint64(self.low - self.bits)
            hi = hi >> np.uint64(self.bits)
        return out[::-1]

    def _permute(self, hi: np.ndarray, lo: np.ndarray, rounds, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
        for r in rounds:
            if not back:
                hi = hi ^ mix64(lo, 2 * r) & self._mask(self.high)
            lo = lo ^ mix64(hi, 2 * r + 1) & self._mask(self.low)
            if back:
                hi = hi ^ mix64(lo, 2 * r) & self._mask(self.high)
        return hi, lo


def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sorted run of (high, low, count) from several, equal phrases added up."""
    hi, lo, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((lo, hi))
    hi, lo, n = hi[order], lo[order], n[order]
    first = np.flatnonzero(np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])][:len(hi)])
    return hi[first], lo[first], np.add.reduceat(n, first) if len(first) else n


def _planes(x: np.ndarray, bits: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)].tobytes()


def _unplaned(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data[:n * width], np.uint8).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64), n * width


def filter_bytes(packing: Packing, depth: int, hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> bytes:
    """A counting quotient filter of a sorted run whose first ``depth`` bits are equal."""
    size = len(hi)
    q = max(0, min(packing.high - depth, (size - 1).bit_length()))
    rest = packing.high - depth - q
    quotient = (hi >> np.uint64(rest) & packing._mask(q)).astype(np.int64)
    ends = np.r_[quotient[1:] != quotient[:-1], True]
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    long = np.flatnonzero(n > 255)
    small = n.copy()
    small[long] = 0
    return b"".join([np.array([size, len(long), q], "<u4").tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), _planes(hi & packing._mask(rest), rest),
                     _planes(lo, packing.low), small.astype(np.uint8).tobytes(), n[long].astype("<i8").tobytes()])


def filter_run(packing: Packing, depth: int, prefix: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted run of a filter."""
    size, n_long, q = np.frombuffer(data, "<u4", 3).tolist()
    view, at = memoryview(data), 12
    rest = packing.high - depth - q
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(view[at:at + -(-(1 << q) // 8)], np.uint8), count=1 << q))
    at += -(-(1 << q) // 8)
    ends = np.unpackbits(np.frombuffer(view[at:at + -(-size // 8)], np.uint8), count=size).astype(np.int64)
    at += -(-size // 8)
    quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64)
    remainder, used = _unplaned(view[at:], size, rest)
    at += used
    lo, used = _unplaned(view[at:], size, packing.low)
    at += used
    n = np.frombuffer(view[at:at + size], np.uint8).astype(np.int64)
    if n_long:
        n[n == 0] = np.frombuffer(view[at + size:], "<i8", n_long)
    head = np.uint64(prefix) << np.uint64(packing.high - depth) if depth else np.uint64(0)
    return head | quotient << np.uint64(rest) | remainder, lo, n


PIECES_DDL = "shard long, depth int, prefix long, filter binary"


def _pieces(packing: Packing, run: tuple[np.ndarray, np.ndarray, np.ndarray], depth: int) -> Iterator[pa.RecordBatch]:
    """A sorted run as filters of about ``PIECE`` phrases, labelled with the shard that their first ``depth`` bits name."""
    hi, lo, n = run
    if not len(hi):
        return
    fine = min(packing.high, max(depth, (len(hi) // PIECE).bit_length()))
    prefix = (hi >> np.uint64(packing.high - fine)).astype(np.int64)
    edges = np.r_[np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]]), len(hi)].tolist()
    for k in range(0, len(edges) - 1, 1024):
        some = edges[k:k + 1025]
        heads = [int(prefix[a]) for a in some[:-1]]
        data = [filter_bytes(packing, fine, hi[a:b], lo[a:b], n[a:b]) for a, b in zip(some, some[1:])]
        yield pa.RecordBatch.from_arrays([pa.array([h >> (fine - depth) for h in heads], pa.int64()), pa.array([fine] * len(heads), pa.int32()), pa.array(heads, pa.int64()),
                                          pa.array(data, pa.binary())], ["shard", "depth", "prefix", "filter"])


def ngrams(packing: Packing, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted runs of all phrases of two words and more in a stream of ids with 0 between pieces, some ``NGRAM_IDS`` starts at a time."""
    for a in range(0, len(ids), NGRAM_IDS):
        parts = []
        some = ids[a:a + NGRAM_IDS + packing.words - 1]
        whole = some > 0
        for k in range(2, packing.words + 1):
            whole = whole[:-1] & (some[k - 1:] > 0)
            at = np.flatnonzero(whole[:NGRAM_IDS])
            parts.append((*packing.pack([some[at + j] for j in range(k)]), np.ones(len(at), np.int64)))
        yield merged(parts)


class _Merger:
    """Runs of one shard, merged whenever enough have come."""

    def __init__(self) -> None:
        self.parts, self.held, self.least = [], 0, 0

    def add(self, run: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.parts.append(run)
        self.held += len(run[0])
        if self.held > 2 * self.least + FILTER_GRAMS // 4:
            self.run()

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.zeros(0, np.uint64)
        out = merged(self.parts) if self.parts else (none, none, np.zeros(0, np.int64))
        self.parts, self.held = [out], len(out[0])
        self.least = self.held
        return out


def _window_filters(rows: DataFrame, ids: DataFrame, packing: Packing, depth: int) -> DataFrame:
    """Filters of all windows: their tokens meet the ids of their words."""
    streams = rows.where("ids is not null").select("win", F.lit(0).alias("kind"), "at", "ids", F.lit(0).cast("long").alias("id"))
    words = rows.where("ids is null").select("win", "at", "lang", "word")
    answers = words.join(ids.select("lang", "word", "id"), ["lang", "word"]).select("win", F.lit(1).alias("kind"), "at", F.lit(None).cast("binary").alias("ids"), "id")
    both = streams.unionByName(answers).repartition(pieces(rows, WINDOW_BYTES), "win").sortWithinPartitions("win", "kind", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, window, stream, at, found = _Merger(), None, [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate(stream) if stream else np.zeros(0, np.uint32)
            table = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
            if at:
                table[np.concatenate(at)] = np.concatenate(found)
            for grams in ngrams(packing, table[tokens]):
                held.add(grams)
                if held.held >= FILTER_GRAMS:
                    got = held.run()
                    if len(got[0]) >= FILTER_GRAMS // 2:
                        yield from _pieces(packing, got, depth)
                        held.__init__()

        for batch in batches:
            win = batch.column("win").to_numpy()
            kind, place, number = (batch.column(c).to_numpy() for c in ("kind", "at", "id"))
            cuts = [0, *(np.flatnonzero(win[1:] != win[:-1]) + 1).tolist(), len(win)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if win[a] != window:
                    if window is not None:
                        yield from close()
                    window, stream, at, found = win[a], [], [], []
                middle = a + int(np.searchsorted(kind[a:b], 1))
                stream += [np.frombuffer(x, np.uint32) for x in batch.column("ids").slice(a, middle - a).to_pylist()]
                at.append(place[middle:b])
                found.append(number[middle:b])
        if window is not None:
            yield from close()
        yield from _pieces(packing, held.run(), depth)

    return both.mapInArrow(run, PIECES_DDL)


def _shard_runs(batches: Iterator[pa.RecordBatch], packing: Packing, most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Merged runs of each shard, in order; of ``most`` phrases where given, else whole."""
    shard, held = None, _Merger()
    for batch in batches:
        for s, depth, prefix, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "depth", "prefix", "filter"))):
            if s != shard or most and held.held > most:
                yield held.run()
                shard, held = s, _Merger()
            held.add(filter_run(packing, depth, prefix, data))
    yield held.run()


def _dealt(filters: DataFrame, depth: int) -> DataFrame:
    """Filters by shard, some shards a task."""
    least = int(filters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return filters.repartition(max(least, min(1 << depth, MOST_TASKS)), "shard").sortWithinPartitions("shard")


def counted(rows: DataFrame, ids: DataFrame, packing: Packing, grams: int, least: int) -> DataFrame:
    """ids (array) and a of every phrase of two words and more that occurs ``least`` times; ``grams``: a bound on the occurrences of all."""
    bits = min(packing.high, max(0, (-(-grams // SHARD_GRAMS) - 1).bit_length()))
    depth = min(FAN, bits)
    filters = _window_filters(rows, ids, packing, depth)
    while depth < bits:
        filters, depth = _dealt(durable(filters), depth), min(depth + FAN, bits)

        def split(batches: Iterator[pa.RecordBatch], depth: int = depth) -> Iterator[pa.RecordBatch]:
            for run in _shard_runs(batches, packing, FILTER_GRAMS):
                yield from _pieces(packing, run, depth)

        filters = filters.mapInArrow(split, PIECES_DDL)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hi, lo, n in _shard_runs(batches, packing, None):
            often = np.flatnonzero(n >= least)
            for k in range(0, len(often), 65536):
                some = often[k:k + 65536]
                words = np.stack(packing.unpack(hi[some], lo[some]), 1)
                used = words > 0
                offsets = np.r_[0, np.cumsum(used.sum(1))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(words[used])), pa.array(n[some])], ["ids", "a"])

    return durable(_dealt(filters, bits).mapInArrow(out, "ids array<long>, a long"))


def frequent_words(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, f, id) of the words that occur ``least`` times or more, ids from 1 on; (lang, n, n_often) of all languages."""
    totals = durable(rows.where("ids is null").groupBy("lang", "word").agg(F.sum("n").alias("f")))
    langs = totals.groupBy("lang").agg(F.sum("f").alias("n"), F.sum(F.when(F.col("f") >= least, F.col("f")).otherwise(0)).alias("n_often"))
    often = totals.where(F.col("f") >= least)
    parts = pieces(totals, WINDOW_BYTES)
    often = durable(often.repartition(parts, "lang", "word").withColumn("k", F.monotonically_increasing_id()))
    # row r of partition p gets r * parts + p: unique, and dense as partitions are alike
    return often.withColumn("id", F.expr(f"(k & {(1 << 33) - 1}) * {parts} + shiftright(k, 33) + 1")).drop("k"), durable(langs)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", words: int = WORDS, least: int = LEAST, drop_pct: int = DROP_PCT) -> DataFrame:
    """lang, phrase, words (array), a, l, r, n, score of every phrase that no longer one stands for."""
    rows = windows(docs, lang_col, text_col)
    ids, langs = frequent_words(rows, least)
    most = ids.agg(F.max("id")).first()[0] or 0
    grams = (words - 1) * (langs.agg(F.sum("n_often")).first()[0] or 0)
    phrases = counted(rows, ids, Packing(words, max(16, most.bit_length())), grams, least)
    size = F.size("ids")
    counts = ids.select(F.array("id").alias("part"), F.col("f").alias("times")).unionByName(phrases.select(F.col("ids").alias("part"), F.col("a").alias("times")))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select("ids", "a", "k", F.slice("ids", 1, F.col("k")).alias("first"),
                                                                                  F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = cuts.join(counts.select(F.col("part").alias("first"), F.col("times").alias("l")), "first").join(
        counts.select(F.col("part").alias("rest"), F.col("times").alias("r")), "rest")
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    cuts = cuts.withColumn("up", a * a * F.lit(UNIT).cast("decimal(7,0)")).withColumn("low", left * right).withColumn("score", F.expr("up div low"))
    best = cuts.groupBy("ids").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # every shorter phrase inside, with the count of the most frequent longer one
    starts = F.sequence(F.lit(1), size - F.col("len") + 1)
    inner = phrases.where(size > 2).select("ids", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("len")).select("a", "ids", "len", F.explode(starts).alias("s"))
    inner = inner.groupBy(F.slice("ids", F.col("s"), F.col("len")).alias("ids")).agg(F.max("a").alias("longer"))
    kept = best.join(inner, "ids", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < drop_pct * F.col("a")))
    names = ids.select("id", "lang", "word")
    if ids.count() * WORD_BYTES <= BROADCAST_BYTES:
        names = F.broadcast(names)
    spelt = kept.select("ids", "a", "cut", F.posexplode("ids").alias("at", "id")).join(names, "id").groupBy("ids").agg(
        F.first("a").alias("a"), F.first("cut").alias("cut"), F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt"))
    spelt = spelt.select("lang", F.col("spelt.word").alias("words"), F.array_join("spelt.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    return spelt.join(langs.select("lang", "n"), "lang").select("lang", "phrase", "words", "a", "l", "r", "n", "score")


def top(found: DataFrame, most: int = TOP) -> DataFrame:
    """The first ``most`` of each language with their rank, by running counts over ranges of the sorted table, so that no task sorts a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = running_in_blocks(ordered_blocks(found, ["lang"], order), ["lang"], order, {"rank": ("count", F.lit(1))}).drop(BLOCK)
    return ranked.withColumn("rank", F.col("rank").cast("long")).where(F.col("rank") <= most)


SQL = f"""with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
ws as (select lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') as w from pieces),
grams as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from ws cross join (values (1), (2), (3)) sizes(k)),
f as (select lang, k, phrase, count(*) as a from grams group by all),
totals as (select lang, sum(a)::bigint as n from f where k = 1 group by lang),
cand as (select * from f where k > 1 and a >= {LEAST}),
cuts as (select *, string_split(phrase, ' ') as w, unnest(range(1, k)) as cut from cand),
scored as (select c.lang, c.phrase, c.k, c.a, l.a as l, r.a as r, cut, ({UNIT} * c.a::hugeint * c.a::hugeint) // (l.a::hugeint * r.a::hugeint) as score from cuts c
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:cut], ' ') join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[cut + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, a from (select *, string_split(phrase, ' ') as w from cand where k = 3)),
longer as (select lang, phrase, max(a) as most from inside group by all),
kept as (select b.* from best b left join longer o on o.lang = b.lang and o.phrase = b.phrase where o.most is null or 100 * o.most < {DROP_PCT} * b.a)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept k join totals t on t.lang = k.lang qualify rank <= {TOP}"""


@query("op12_collocations", SQL)
def op12_collocations(spark, sf_dir):
    return top(collocations(documents(spark, sf_dir))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
