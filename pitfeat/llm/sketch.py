"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs, whose difference gives back the paragraphs that differ.

A text of whatever length is a bag of its paragraphs, large and small: runs of words, cut after a word whose own hash has ``RUN_BITS`` zero bits (16 words on average, wherever the text is
cut or shifted), and all pairs of neighbouring words, so order counts. A word of over ``LONG`` bytes, as in scripts without spaces, counts as its pieces of ``PIECE`` code points. A
paragraph's digest is made of its words' hashes. Equal paragraphs are told apart by their number. Each 64-bit digest is added to one cell of each of three tables: a count, the sum of the digests and
the sum of check values. The fingerprint is the smallest sketch. Subtracting two sketches leaves the digests of one side only; a cell of
one digest is recognised by its check value, its digest is taken out everywhere, and so on. If cells remain, both texts are sketched anew at ``GROW`` times the
size, until nothing remains; the first size follows from how many of the digests with ``SAMPLE_BITS`` zero bits differ. Likeness is the shared part of both bags: 2 * common / (size + size), 1 for two empty bags.

All texts of a window are sketched and peeled together, as arrays. Windows are bounded in bytes, documents and cells.

Neighbours. The edited text needs the next document by doc_id. Documents are range-partitioned by (doc_id, hash of the text); the first document of each range also
goes to the range before, the very first to the last, so every task has what it needs.

Edge cases. Null text is empty. A single document follows itself. Null doc_ids come first, equal ones are ordered by a hash of the text; identical rows
each come out. Nothing in, nothing out. Extra columns are not read.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pitfeat.llm.common import WHITE, documents, pieces, query, whole
from pitfeat.llm.token_files import mix64
from pitfeat.session import durable

TABLES, LEAST_SIDE, GROW = 3, 8, 4
RUN_BITS, SAMPLE_BITS, LONG, PIECE = 4, 4, 16, 4
WINDOW_BYTES, WINDOW_DOCS, WINDOW_CELLS = 4 << 20, 4096, 1 << 21
PART_BYTES = 32 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
COUNT_BITS = 24
COUNT = np.uint64((1 << COUNT_BITS) - 1)


class _Hashes(dict):
    """The hash of each word met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes) -> list[bytes]:
    words = text.split()
    if max(map(len, words), default=0) > LONG:
        words = [x for w in words for x in ([w] if len(w) <= LONG else _cut(w.decode()))]
    return words


def _cut(word: str) -> list[bytes]:
    return [word[k:k + PIECE].encode() for k in range(0, len(word), PIECE)]


def paragraphs(text: str) -> list[bytes]:
    """The paragraphs of a text, by one rule for every length; without any difference for runs of white space."""
    words = words_of(text.encode())
    hashes = _Hashes().of(words)
    edges = [0, *(np.flatnonzero((hashes & np.uint64((1 << RUN_BITS) - 1)) == 0) + 1).tolist(), len(words)]
    runs = [b" ".join(words[a:b]) for a, b in zip(edges, edges[1:]) if a < b]
    return [b"run " + r for r in runs] + [b"pair " + a + b" " + b for a, b in zip(words, words[1:])]


def paragraph_hashes(words: np.ndarray) -> np.ndarray:
    """A hash for each paragraph of a text whose words have these hashes."""
    if not len(words):
        return words
    cut = (words & np.uint64((1 << RUN_BITS) - 1)) == 0
    starts = np.flatnonzero(np.r_[True, cut[:-1]])
    sizes = np.diff(np.r_[starts, len(words)])
    place = (np.arange(len(words)) - np.repeat(starts, sizes)).astype(np.uint64)
    runs = mix64(np.add.reduceat(mix64(words + place * STEP, TABLES + 2), starts) + sizes.astype(np.uint64), TABLES + 3)
    return np.concatenate([runs, mix64(mix64(words[:-1], TABLES + 4) + words[1:], TABLES + 5)])


def _bag(words: np.ndarray) -> np.ndarray:
    """One sorted 64-bit digest per paragraph; the k-th copy of a paragraph has a digest of its own."""
    found = np.sort(paragraph_hashes(words))
    again = np.r_[False, found[1:] == found[:-1]][:len(found)]
    if not again.any():
        return found
    at = np.arange(len(found))
    copy = at - np.maximum.accumulate(np.where(again, 0, at))
    return np.sort(np.where(again, mix64(found, TABLES + 1) + copy.astype(np.uint64) * STEP, found))


def digests(text: str, hashes: _Hashes | None = None) -> np.ndarray:
    """The digests of a text's paragraphs."""
    return _bag((_Hashes() if hashes is None else hashes).of(words_of(text.encode())))


def _edited_words(words: np.ndarray, text: bytes, changed: bytes, hashes: _Hashes) -> np.ndarray:
    """Hashes of the words of an edited text; those before the last white space that both texts share are taken over."""
    n = min(len(text), len(changed))
    shared = n - n // 3  # the edit leaves three quarters of the code points; a cut that is not shared is found by comparing
    while shared and text[:shared] != changed[:shared]:
        shared //= 2
    cut = max((text.rfind(c, 0, shared) for c in WHITE_BYTES), default=-1)
    if cut < 0:
        return hashes.of(words_of(changed))
    return np.concatenate([words[:len(words) - len(words_of(text[cut:]))], hashes.of(words_of(changed[cut:]))])


WHITE_BYTES = [c.encode() for c in WHITE]


class Sketches:
    """Sketches of ``n`` texts with three tables of ``side`` cells (a power of 2) each.

    A cell has two sums: of digests, and of tags, which are check values above a count of ``COUNT_BITS`` bits.
    """

    def __init__(self, n: int, side: int) -> None:
        self.n, self.side, self.cells = n, side, TABLES * side
        self.key = np.zeros(n * self.cells, np.uint64)
        self.tag = np.zeros(n * self.cells, np.uint64)

    def places(self, owner: np.ndarray, digest: np.ndarray) -> Iterator[np.ndarray]:
        mask, base = np.uint64(self.side - 1), owner * self.cells
        mixed = mix64(digest, 0)
        for j in range(TABLES):
            part = mixed >> np.uint64(21 * j) if self.side <= 1 << 21 else mix64(digest, 10 + j)
            yield base + j * self.side + (part & mask).astype(np.int64)

    def add(self, owner: np.ndarray, digest: np.ndarray, sign: np.ndarray | None = None) -> list[np.ndarray]:
        """Adds digests, or takes those of ``sign`` -1 out; returns their cells."""
        tag = _tag(digest)
        if sign is not None:
            factor = sign.astype(np.uint64)  # -1 as the number that adds up to 0
            digest, tag, plain = digest * factor, tag * factor, digest
        else:
            plain = digest
        cells = list(self.places(owner, plain))
        for at in cells:
            np.add.at(self.key, at, digest)
            np.add.at(self.tag, at, tag)
        return cells

    def minus(self, other: Sketches) -> Sketches:
        out = self.part(0, 0)
        out.n, out.key, out.tag = self.n, self.key - other.key, self.tag - other.tag
        return out

    def part(self, a: int, b: int) -> Sketches:
        out = Sketches(0, self.side)
        some = slice(a * self.cells, b * self.cells)
        out.n, out.key, out.tag = b - a, self.key[some], self.tag[some]
        return out

    def text(self, k: int) -> str:
        a = slice(k * self.cells, (k + 1) * self.cells)
        return base64.b64encode(np.stack([self.tag[a], self.key[a]], 1).tobytes()).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Takes all digests out that can be recognised: (text, digest, sign) of each, and for each text whether nothing remains."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        todo = np.flatnonzero(self.tag)
        while len(todo):
            count = self.tag[todo] & COUNT
            lone = (count == 1) | (count == COUNT)
            todo, count = todo[lone], count[lone]
            sign = np.where(count == 1, 1, -1)
            factor = sign.astype(np.uint64)
            digest = self.key[todo] * factor
            pure = _tag(digest) == self.tag[todo] * factor
            owner, digest, sign = todo[pure] // self.cells, digest[pure], sign[pure]
            order = np.lexsort((digest, owner))
            owner, digest, sign = owner[order], digest[order], sign[order]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])][:len(owner)]
            owner, digest, sign = owner[new], digest[new], sign[new]
            if not len(owner):
                break
            found.append((owner, digest, sign))
            todo = np.concatenate(self.add(owner, digest, -sign))
        clear = ~((self.tag != 0) | (self.key != 0)).reshape(self.n, self.cells).any(axis=1)
        got = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        return *got, clear


def _tag(digest: np.ndarray) -> np.ndarray:
    """A check value of 40 bits, and the count 1."""
    return mix64(digest, TABLES) & ~COUNT | np.uint64(1)


def sketches(bags: list[np.ndarray], side: int = LEAST_SIDE) -> Sketches:
    out = Sketches(len(bags), side)
    if bags:
        out.add(np.repeat(np.arange(len(bags)), [len(b) for b in bags]), np.concatenate(bags))
    return out


def differences(left: list[np.ndarray], right: list[np.ndarray], first: Sketches | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of bags, the digests of the left one only and of the right one only, as the sketches give them back.

    ``first``: the difference of the smallest sketches, if it is there already.
    """
    out: list = [None] * len(left)
    sizes: dict[int, list[int]] = {}
    for i, (a, b) in enumerate(zip(left, right)):
        sizes.setdefault(_first_side(a, b), []).append(i)
    while sizes:
        side = min(sizes)
        todo = sizes.pop(side)
        each = max(1, WINDOW_CELLS // (TABLES * side))
        for k in range(0, len(todo), each):
            some = todo[k:k + each]
            diff = first if first is not None and side == LEAST_SIDE and len(some) == len(left) else (
                sketches([left[i] for i in some], side).minus(sketches([right[i] for i in some], side)))
            owner, digest, sign, clear = diff.peel()
            order = np.argsort(owner, kind="stable")
            owner, digest, sign = owner[order], digest[order], sign[order]
            edges = np.searchsorted(owner, np.arange(len(some) + 1)).tolist()
            for j, i in enumerate(some):
                if clear[j]:
                    d, s = digest[edges[j]:edges[j + 1]], sign[edges[j]:edges[j + 1]]
                    out[i] = d[s > 0], d[s < 0]
                else:
                    sizes.setdefault(side * GROW, []).append(i)
    return out


def _first_side(a: np.ndarray, b: np.ndarray) -> int:
    """Side of tables that hold about as many digests as differ, judged by those with ``SAMPLE_BITS`` zero bits."""
    mask = np.uint64((1 << SAMPLE_BITS) - 1)
    some = np.sort(np.concatenate([a[a & mask == 0], b[b & mask == 0]]))
    lone = len(some) - 2 * int((some[1:] == some[:-1]).sum())
    need = max(abs(len(a) - len(b)), lone << SAMPLE_BITS) // 2  # three tables of this side: one and a half cells a digest
    return max(LEAST_SIDE, 1 << max(0, need - 1).bit_length())


def likeness(left: list[np.ndarray], right: list[np.ndarray], first: Sketches | None = None) -> np.ndarray:
    lone = np.array([len(a) + len(b) for a, b in differences(left, right, first)], np.float64)
    total = np.array([len(a) + len(b) for a, b in zip(left, right)], np.float64)
    return np.where(total > 0, 1 - lone / np.maximum(total, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _rows(docs: list[tuple[int | None, str]], following: str) -> pa.RecordBatch:
    """Results for consecutive documents; ``following``: the text after the last one."""
    texts = [t for _, t in docs]
    changed = [edited(t, n) for t, n in zip(texts, [*texts[1:], following])]
    hashes = _Hashes()
    data = [t.encode() for t in [*texts, following]]
    words = [hashes.of(words_of(x)) for x in data]
    bags = [_bag(w) for w in words]
    new_bags = [_bag(_edited_words(w, x, t.encode(), hashes)) for w, x, t in zip(words, data, changed)]
    own, after = bags[:-1], bags[1:]
    every, new_base = sketches(bags), sketches(new_bags)
    base, after_base = every.part(0, len(own)), every.part(1, len(bags))
    columns = [
        pa.array([k for k, _ in docs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([sha256(t.encode()).hexdigest() for t in changed]),
        pa.array([base.text(k) for k in range(len(docs))]), pa.array([new_base.text(k) for k in range(len(docs))]),
        pa.array(likeness(own, new_bags, base.minus(new_base))), pa.array(likeness(own, after, base.minus(after_base)))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Partitions of (part, tail, id, h, text), sorted; the row with ``tail`` is the document that follows the part's last one."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = pieces(rows, PART_BYTES)
    order = (F.col("id").isNotNull(), F.coalesce("id", F.lit(0)), F.col("h"))
    narrow = durable(rows.select("id", "h").repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    # the first document of each range: three values per partition
    firsts = sorted(tuple(r.first) for r in narrow.groupBy("part").agg(F.min(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])).alias("first")).collect())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [(i is not None, i or 0, h) for i, h in zip(batch.column("id").to_pylist(), batch.column("h").to_pylist())]
            part = [bisect_right(firsts, k) - 1 for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([False] * len(part)), *batch.columns], ["part", "tail", "id", "h", "text"])
            heads = [k for k, p in enumerate(part) if firsts[p] == keys[k]]
            if heads:
                some = batch.take(pa.array(heads))
                yield pa.RecordBatch.from_arrays([pa.array([(part[k] - 1) % len(firsts) for k in heads], pa.int64()), pa.array([True] * len(heads)), *some.columns],
                                                 ["part", "tail", "id", "h", "text"])

    placed = rows.select("id", "h", "text").mapInArrow(place, "part long, tail boolean, id long, h long, text string")
    return placed.repartition(parts, "part").sortWithinPartitions("part", "tail", F.col("id").asc_nulls_first(), "h")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, held = None, [], 0
        for batch in batches:
            for p, tail, key, text in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "id", "text"))):
                if tail:
                    if waiting and p == part:
                        yield _rows(waiting, text)
                        waiting, held = [], 0
                    continue
                if held > WINDOW_BYTES or len(waiting) >= WINDOW_DOCS:
                    yield _rows(waiting, text)
                    waiting, held = [], 0
                part = p
                waiting.append((key, text))
                held += len(text)

    return in_order(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


@query("op4_sketch")
def op4_sketch(spark, sf_dir):
    return fingerprints(documents(spark, sf_dir))
