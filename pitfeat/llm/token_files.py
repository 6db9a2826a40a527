"""Token ids in binary shard files with a minimal perfect hash index from document keys to offsets.

A shard holds the ids of consecutive documents back to back, then the keys and ends of its rows, then the index: the bit arrays of a
minimal perfect hash (keys alone in their place at a level are settled there, the others go on to the next), and for each key a 32-bit fingerprint,
its first row and its number of rows. A footer tells where each part starts. Looking a key up costs one hash per level, a fingerprint and
one read of the payload; the fingerprint refuses all but one in 2**32 of foreign keys.

Documents are range-partitioned by key, so shards follow each other in key order. Tasks write files under names of their own and return their
names; only names in the written manifest count, so a task that is lost or run twice leaves at most an unused file.

Edge cases. Null text is empty: only the end id. Null keys come first, under no index entry; rows of equal keys stand together, ordered by a
hash of the text, and one look-up returns them all. No documents, no shards. The folder must be one that pyarrow can open by its address.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pitfeat.llm.bpe import encoder, vocabulary_path
from pitfeat.llm.common import documents, pieces, query, small, whole
from pitfeat.session import durable, shared_dir

MAGIC = b"TOKIDS01"
SHARD_BYTES, READ_IDS, END_ID = 64 << 20, 1 << 20, 0
KEPT_UNITS = 900_000  # per Python worker, some 200 MB
LOAD, LEVELS = 1.6, 64


def mix64(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers for each seed."""
    x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class PerfectHash:
    """Maps n distinct 64-bit keys to 0 .. n-1; other keys to anything or to -1."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.cumsum(bits) - 1)
            total += int(bits.sum())
        self.n = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys.astype(np.uint64)
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            at = (mix64(left, len(levels)) % np.uint64(int(LOAD * len(left)) + 1)).astype(np.int64)
            alone = np.bincount(at, minlength=int(LOAD * len(left)) + 1) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys, out = keys.astype(np.uint64), np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (mix64(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = self.ranks[k][at[hit]]
            left = left[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys.astype(np.uint64), 1 << 20) >> np.uint64(32)).astype("<u4")


def _filesystem(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address)


class ShardWriter:
    """Writes documents in key order; ``close`` adds the index and the footer."""

    def __init__(self, address: str, width: int) -> None:
        files, path = _filesystem(address)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.width = files.open_output_stream(path), width
        self.out.write(MAGIC)
        self.keys: list[int | None] = []
        self.counts: list[int] = []

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.keys.append(key)
        self.counts.append(len(ids) // self.width)

    def close(self) -> int:
        """The number of ids."""
        nulls = sum(k is None for k in self.keys)
        keys = np.array(self.keys[nulls:], np.int64)
        distinct, first, rows = np.unique(keys, return_index=True, return_counts=True)
        index = PerfectHash.build(distinct.view(np.uint64))
        place = index.find(distinct.view(np.uint64))
        prints, entry = np.zeros(len(distinct), "<u4"), np.zeros((len(distinct), 2), "<i8")
        prints[place] = fingerprint(distinct.view(np.uint64))
        entry[place, 0], entry[place, 1] = first + nulls, rows
        ends = np.cumsum(np.array(self.counts, "<i8"))
        parts = {"keys": keys.astype("<i8"), "ends": ends, "prints": prints, "entries": entry,
                 **{f"level{k}": np.packbits(bits) for k, bits in enumerate(index.levels)}}
        at = len(MAGIC) + (int(ends[-1]) if len(ends) else 0) * self.width
        where = {}
        for name, part in parts.items():
            self.out.write(part.tobytes())
            where[name] = [at, part.nbytes]
            at += part.nbytes
        footer = json.dumps({"width": self.width, "nulls": nulls, "parts": where, "bits": [len(b) for b in index.levels]}).encode()
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        self.out.close()
        return int(ends[-1]) if len(ends) else 0


class Shard:
    """A shard file opened for keyed access."""

    def __init__(self, address: str) -> None:
        files, path = _filesystem(address)
        self.file = files.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{address} is not a complete shard")
        length = struct.unpack("<I", tail[:4])[0]
        self.footer = json.loads(self.file.read_at(length, size - 12 - length))
        self.width, self.nulls = self.footer["width"], self.footer["nulls"]
        self.keys, self.ends = self._part("keys", "<i8"), self._part("ends", "<i8")
        self.prints, self.entries = self._part("prints", "<u4"), self._part("entries", "<i8").reshape(-1, 2)
        self.index = PerfectHash([np.unpackbits(self._part(f"level{k}", np.uint8), count=n).astype(bool) for k, n in enumerate(self.footer["bits"])])

    def _part(self, name: str, kind) -> np.ndarray:
        at, n = self.footer["parts"][name]
        return np.frombuffer(self.file.read_at(n, at), kind)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """(first row, rows) of each key; (-1, 0) where the key is not in the shard."""
        at = self.index.find(keys.view(np.uint64))
        out = np.tile(np.array([[-1, 0]], np.int64), (len(keys), 1))
        known = np.flatnonzero(at >= 0)
        known = known[self.prints[at[known]] == fingerprint(keys[known].view(np.uint64))]
        out[known] = self.entries[at[known]]
        return out

    def ids(self, row: int, rows: int = 1) -> list[np.ndarray]:
        """The ids of consecutive rows, in one read."""
        start = int(self.ends[row - 1]) if row else 0
        data = np.frombuffer(self.file.read_at((int(self.ends[row + rows - 1]) - start) * self.width, len(MAGIC) + start * self.width), f"<u{self.width}")
        return np.split(data, self.ends[row:row + rows - 1] - start)

    def rows(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, ids before it, ids) of every row, each found through the index."""
        distinct = np.unique(self.keys)
        found = self.find(distinct)
        if (found[:, 1] == 0).any():
            raise ValueError("the index misses a key of its own")
        key_of = np.full(len(self.ends), -1, np.int64)
        for k, (first, n) in enumerate(found.tolist()):
            key_of[first:first + n] = k
        row = 0
        while row < len(self.ends):
            start = int(self.ends[row - 1]) if row else 0
            to = max(row + 1, int(np.searchsorted(self.ends, start + READ_IDS)))
            for r, ids in zip(range(row, to), self.ids(row, to - row)):
                yield (None if r < self.nulls else int(distinct[key_of[r]])), start, ids
                start += len(ids)
            row = to


def write_tokens(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Writes the shards; returns the manifest, stored: shard, file, n_docs, n_ids, first_key, last_key."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), whole(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    parts = pieces(rows, SHARD_BYTES)
    ranged = rows.repartitionByRange(parts, F.col("key").asc_nulls_first(), "h").sortWithinPartitions(F.col("key").asc_nulls_first(), "h").select("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name, writer, enc = f"{folder}/shard-{shard:08d}-{uuid.uuid4().hex}.tok", None, encoder(path, KEPT_UNITS)
        end = np.array([end_id], enc.type).tobytes()
        for batch in small(batches):
            if batch.num_rows:
                writer = writer or ShardWriter(name, enc.type.itemsize)
                for key, ids in zip(batch.column("key").to_pylist(), enc.encode(batch.column("text").to_pylist())):
                    writer.add(key, ids + end)
        if writer:
            n = writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (shard, name, len(writer.keys), n)] + [pa.array([x], pa.int64()) for x in (writer.keys[0], writer.keys[-1])],
                                             ["shard", "file", "n_docs", "n_ids", "first_key", "last_key"])

    return durable(ranged.mapInArrow(write, "shard long, file string, n_docs long, n_ids long, first_key long, last_key long"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """key, start (ids in all rows before), n_tokens and ids (unsigned 32-bit little-endian) of every row, read back through the index."""
    # one row per shard
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_ids")
    placed = manifest.select("shard", "file", before.alias("base")).repartition(max(1, manifest.count()), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                out, held = [], 0
                for key, start, ids in Shard(name).rows():
                    out.append((key, base + start, len(ids), ids.astype("<u4").tobytes()))
                    held += len(ids)
                    if held > READ_IDS:
                        yield _batch(out)
                        out, held = [], 0
                yield _batch(out)

    return placed.mapInArrow(read, "key long, start long, n_tokens long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["key", "start", "n_tokens", "ids"])


def look_up(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """key and ids for each row of the wanted keys (first column of ``keys``, long); keys that are absent give no row."""
    wanted = keys.select(F.col(keys.columns[0]).cast("long").alias("w")).where("w is not null").distinct()
    # three numbers per shard
    bounds = np.array(manifest.where("last_key is not null").select("first_key", "last_key", "shard").orderBy("shard").fillna(-(1 << 63), ["first_key"])
                      .toPandas().values, np.int64).reshape(-1, 3)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column("w").to_numpy()
            a, b = np.searchsorted(bounds[:, 1], w), np.searchsorted(bounds[:, 0], w, "right")  # shards that may hold equal keys follow each other
            n = np.maximum(b - a, 0)
            at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(bounds[at, 2]), pa.array(np.repeat(w, n))], ["s", "w"])

    near = wanted.mapInArrow(place, "s long, w long").join(manifest.select("shard", "file"), F.col("s") == F.col("shard"))
    grouped = near.select("file", "w").repartition("file").sortWithinPartitions("file", "w")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for batch in batches:
            out = []
            for file, key in zip(batch.column("file").to_pylist(), batch.column("w").to_pylist()):
                if file != name:
                    name, shard = file, Shard(file)
                first, n = shard.find(np.array([key], np.int64))[0].tolist()
                out += [(key, ids.astype("<u4").tobytes()) for ids in (shard.ids(first, n) if n else [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["key", "ids"])

    return grouped.mapInArrow(read, "key long, ids binary")


@query("op1_token_files")
def op1_token_files(spark, sf_dir):
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = write_tokens(documents(spark, sf_dir), folder, vocabulary_path())
    rows = read_tokens(manifest)
    return rows.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
