"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over 32 bytes cuts each text into chunks of about ``CHUNK`` bytes, so equal passages are cut alike wherever they stand. The body of
a chunk lies between its first and last safe space (one before a character other than white space, where a pre-token starts in any text). Equal bodies are encoded
once per shuffle partition whatever the number of documents. What lies between two bodies, around a cut, is the join: it is encoded anew from the left
chunk's last safe space to the right chunk's first one, and where a chunk has none the join grows over it to the next, so
the ids agree with those of the whole text. At the end the tokens of each document must spell as many bytes as its text has, else the task fails.

Texts are handled in groups of ``GROUP_BYTES``. A group asks for each different body once, in one compressed block per bucket of body hashes; a bucket
answers each group with one block of ids, and ids, decoded text and digests are made where the answers of a group meet its recipe of
joins and references. So a body that a third of all documents hold costs one request per group, and no document is spread row by row.

Edge cases. Null text is empty: no tokens. The texts of special tokens get the special ids, as the library does. Rows of equal or null keys each come
out. A text without safe spaces is one join. Nothing in, nothing out. Extra columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pitfeat.llm.bpe import encoder, vocabulary_path
from pitfeat.llm.common import documents, pieces, query, small

CHUNK_BITS, LEAST_CHUNK, WINDOW, SLICE = 10, 256, 32, 1 << 20
GROUP_BYTES, BUCKET_BYTES, LEVEL = 16 << 20, 32 << 20, 9
REQUEST, RECIPE = 0, 1

_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
# bytes that may follow a safe space: not white space, no control character, not the start of a character that may be white space
_FOLLOWS = np.zeros(256, bool)
_FOLLOWS[0x21:0x7F] = True
_FOLLOWS[0xC3:0xE1] = True
_FOLLOWS[0xE4:] = True


def cut_points(data: np.ndarray) -> np.ndarray:
    """Positions whose last ``WINDOW`` bytes hash to 0 in the top ``CHUNK_BITS`` bits."""
    found = []
    for a in range(0, len(data), SLICE):
        start = max(0, a - WINDOW)
        h, step = _GEAR[data[start:a + SLICE]], 1
        while step < WINDOW:
            longer = h.copy()
            longer[step:] += h[:-step] << np.uint32(step)
            h, step = longer, 2 * step
        found.append(a + np.flatnonzero(h[a - start:] >> np.uint32(32 - CHUNK_BITS) == 0) + 1)
    return np.concatenate(found)


def safe_spaces(data: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(data[:-1] == 0x20)
    return at[_FOLLOWS[data[at + 1]]]


def bodies(data: bytes, starts: list[int], ends: list[int]) -> list[list[tuple[int, int]]]:
    """For each text, data[start:end], the spans of its chunk bodies; the joins are what lies between."""
    b = np.frombuffer(data, np.uint8)
    if len(b) < 2:
        return [[] for _ in starts]
    cuts, safe = cut_points(b), safe_spaces(b)
    out = []
    for start, end in zip(starts, ends):
        a, z = np.searchsorted(cuts, (start + LEAST_CHUNK, end))
        chosen, last = [], start
        for c in cuts[a:z].tolist():
            if c - last >= LEAST_CHUNK:
                chosen.append(c)
                last = c
        edges = np.array([start, *chosen, end])
        # a space whose next byte belongs to the next text is none of this one
        first = np.searchsorted(safe, edges[:-1])
        after = np.searchsorted(safe, np.r_[edges[1:-1], max(start, end - 1)])
        some = after - first >= 2
        out.append(list(zip(safe[first[some]].tolist(), safe[after[some] - 1].tolist())))
    return out


def _pack(things) -> bytes:
    return zstandard.ZstdCompressor(LEVEL).compress(pickle.dumps(things, 5))


def _unpack(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["bucket", "g", "kind", "block"])


def _group_blocks(g: int, keys: list[int | None], texts: list[bytes], enc, buckets: int) -> list[tuple[int, int, int, bytes]]:
    """The recipe of a group and its requests: rows of bucket, group, kind and block."""
    data = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts]).tolist()
    starts = [0, *ends[:-1]]
    asked: dict[int, dict[bytes, tuple[int, bytes]]] = {}
    joins: list[str] = []
    recipe: list[list[tuple[int, int] | None]] = []
    for start, end, spans in zip(starts, ends, bodies(data, starts, ends)):
        parts, at = [], start
        for a, z in spans:
            joins.append(data[at:a].decode())
            body = data[a:z]
            name = xxhash.xxh128_digest(body)
            bucket = int.from_bytes(name[:8], "little") % buckets
            mine = asked.setdefault(bucket, {})
            if name not in mine:
                mine[name] = len(mine), body
            parts += [None, (bucket, mine[name][0])]
            at = z
        joins.append(data[at:end].decode())
        recipe.append([*parts, None])
    rows = [(bucket, g, REQUEST, _pack([(name, body) for name, (_, body) in mine.items()])) for bucket, mine in asked.items()]
    return [*rows, (g % buckets, g, RECIPE, _pack((keys, [len(t) for t in texts], recipe, enc.encode(joins))))]


def _merge(found: list[tuple[int, int, bytes]], enc) -> Iterator[tuple[int | None, bytes]]:
    """(key, ids) of each document of one group, from its recipe and the answers."""
    answers = {bucket: _unpack(block) for bucket, kind, block in found if kind == REQUEST}
    for keys, sizes, recipe, joins in (_unpack(block) for _, kind, block in found if kind == RECIPE):
        join = iter(joins)
        for key, size, parts in zip(keys, sizes, recipe):
            ids = b"".join(next(join) if p is None else answers[p[0]][p[1]] for p in parts)
            if int(enc.lengths[np.frombuffer(ids, enc.type)].sum()) != size:
                raise ValueError(f"the tokens of document {key} do not spell its text")
            yield key, ids


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """key, n_tokens, ids (32-bit little-endian) and, if asked for, ``decoded`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    buckets = pieces(rows, BUCKET_BYTES)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, n = encoder(path), TaskContext.get().partitionId(), 0
        keys, texts, held = [], [], 0
        for batch in small(batches):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                keys.append(key)
                texts.append((text or "").encode())
                held += len(texts[-1])
                if held >= GROUP_BYTES:
                    yield _rows(_group_blocks(part << 32 | n, keys, texts, enc, buckets))
                    keys, texts, held, n = [], [], 0, n + 1
        if keys:
            yield _rows(_group_blocks(part << 32 | n, keys, texts, enc, buckets))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, known = encoder(path), {}
        for batch in batches:
            for bucket, g, kind, block in zip(*(batch.column(c).to_pylist() for c in ("bucket", "g", "kind", "block"))):
                if kind == REQUEST:
                    wanted = _unpack(block)
                    new = {name: body.decode() for name, body in wanted if name not in known}
                    known.update(zip(new, enc.encode(list(new.values()))))
                    block = _pack([known[name] for name, _ in wanted])
                yield _rows([(bucket, g, kind, block)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last, found = encoder(path), None, []

        def done() -> Iterator[pa.RecordBatch]:
            some: list[tuple[int | None, bytes]] = []
            held = 0
            for item in _merge(found, enc):
                some.append(item)
                held += len(item[1])
                if held > GROUP_BYTES // 4:
                    yield _result(some, enc, decode)
                    some, held = [], 0
            if some:
                yield _result(some, enc, decode)

        for batch in batches:
            for bucket, g, kind, block in zip(*(batch.column(c).to_pylist() for c in ("bucket", "g", "kind", "block"))):
                if g != last:
                    yield from done()
                    last, found = g, []
                found.append((bucket, kind, block))
        yield from done()

    shape = "bucket long, g long, kind int, block binary"
    asked = rows.mapInArrow(ask, shape).repartitionById(buckets, F.col("bucket").cast("int"))
    met = asked.mapInArrow(answer, shape).repartition(buckets, "g").sortWithinPartitions("g")
    return met.mapInArrow(join, "key long, n_tokens long, ids binary" + ", decoded string" * decode)


def _result(some: list[tuple[int | None, bytes]], enc, decode: bool) -> pa.RecordBatch:
    ids = [np.frombuffer(x, enc.type) for _, x in some]
    columns = [pa.array([k for k, _ in some], pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
    return pa.RecordBatch.from_arrays(columns + [pa.array(enc.decode(ids), pa.string())] * decode, ["key", "n_tokens", "ids"] + ["decoded"] * decode)


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded.select(F.col("key").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_chunk_bpe")
def op5_chunk_bpe(spark, sf_dir):
    return digest(encode_documents(documents(spark, sf_dir), vocabulary_path()))
