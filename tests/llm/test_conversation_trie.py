"""The conversation trie against a plain trie of tuples, in one range or many, in one layer or many."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from pitfeat.llm import conversation_trie as C

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       *(T.StructField(c, T.StringType()) for c in ("c", "pos", "sym", "key", "i", "root", "part"))])


def remainder(c: int) -> int:
    return abs(c) % 5 * (1 if c >= 0 else -1)


def rebuild(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    def sym(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]

    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, sym(role, text)), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - remainder(c), [])[:h] + turns[h:]
    return out


def plain(convs: dict[int, list]) -> set[tuple]:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += p not in kids
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()}


def built(spark, rows, segment=C.SEGMENT, hot=C.HOT_ROWS) -> list[tuple]:
    df = spark.createDataFrame([(*r, *[None] * 7) for r in rows], SCHEMA).repartition(3)
    turns, lens = C.rebuilt(C.digested(df, hot))
    return [tuple(r) for r in C.prefix_trie(turns, lens, segment).collect()]


def odd_conversations() -> list[tuple]:
    rng = np.random.default_rng(7)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {rng.integers(0, 2)} é日") for c in range(40) for t in range(int(rng.integers(1, 14)))]
    rows += [(c, t, "u", f"same {t}") for c in range(100, 160) for t in range(10)]  # copies
    rows += [(None, 1, "u", "x"), (None, None, None, None), (200, None, None, None), (200, 1, "u", ""), (200, 1, "u", ""), (-3, 1, "a", "b"), (-5, 1, "a", "b"), (-5, 2, "a", "c"),
             (0, 3, "u", "z" * 3000), (301, 5, None, "x"), (302, 5, "x", None), ((1 << 63) - 1, 1, "u", "big"), (-(1 << 63), 1, "u", "small")]
    rows += [(400, t, "u", f"long {t}") for t in range(300)] + [(401, t, "u", f"long {t}") for t in range(280)]
    return rows


@pytest.fixture(scope="module")
def want():
    return plain(rebuild(odd_conversations()))


@pytest.mark.parametrize("segment, part, hot", [(4096, 8 << 20, C.HOT_ROWS), (4096, 200, 50), (64, 500, 50)])
def test_trie(spark, monkeypatch, want, segment, part, hot):
    monkeypatch.setattr(C, "PART_BYTES", part)
    got = built(spark, odd_conversations(), segment, hot)
    assert len(got) == len(set(got)) == len(want)
    assert set(got) == want


def test_short_segments(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_BYTES", 300)
    rng = np.random.default_rng(3)
    rows = [(c, t, "u", str(rng.integers(0, 2))) for c in range(60) for t in range(int(rng.integers(0, 7)))]
    got = built(spark, rows, 2)
    want = plain(rebuild(rows))
    assert len(got) == len(want) and set(got) == want


def test_pieces_of_ids(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_BYTES", 100)
    monkeypatch.setattr(C, "PIECE_IDS", 3)
    rows = [(c, 1, "u", "same") for c in range(95, 130)]
    assert set(built(spark, rows)) == plain(rebuild(rows))


def test_no_turns_and_nothing(spark):
    alone = next(c for c in range(6, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    assert built(spark, [(alone, 1, "u", "gone")]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    assert built(spark, []) == []


def test_fattest():
    for a in range(40):
        for b in range(a + 1, 70):
            f = C.two_fattest(a, b)
            assert a < f <= b and (f & -f) == max(x & -x for x in range(a + 1, b + 1))


def test_exit_nodes():
    rng = np.random.default_rng(11)
    trie, held = C.Trie(), []
    for _ in range(600):
        n = int(rng.integers(1, 40))
        x = b"".join(int(s).to_bytes(16, "little") for s in [0, *rng.integers(0, 2, n).tolist()])
        _, shared = trie.exit(x, hashes := C.prefix_hashes(x, np.zeros(1, np.int64)))
        most = max((next((k for k in range(min(len(x), len(y)) // 16) if x[16 * k:16 * k + 16] != y[16 * k:16 * k + 16]), min(len(x), len(y)) // 16) for y in held), default=0)
        assert shared == most
        assert trie.rep[trie.insert(x, hashes)] == x
        held.append(x)
    assert len(trie.table) == len(trie.upto) - 1 <= 2 * len(held)
