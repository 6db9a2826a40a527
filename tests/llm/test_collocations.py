"""Collocations against plain counting, filters against dictionaries."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat.llm import collocations as C


def plain(rows, words=3, least=10, drop=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, words + 1) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = set()
    for (lang, *w), a in often.items():
        cuts = [(1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = max((b for (m, *v), b in often.items() if m == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v)))), default=0)
        if 100 * longer < drop * a:
            out.add((lang, " ".join(w), a, f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang], score))
    return out


def sample() -> list[tuple]:
    rng = np.random.default_rng(5)
    vocabulary = ["the", "a", "New", "york", "city", "éa", "x\x01", "x", "日本", "rare"]
    out = []
    for k in range(160):
        words = rng.choice(vocabulary, rng.integers(0, 60), p=[.25, .15, .1, .1, .1, .1, .08, .08, .03, .01])
        out.append((["en", "de", None, "und"][k % 4], "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "\x0b", " "]) for w in words)))
    out += [("en", None), ("en", ""), (None, None), ("xx", "a a a a a a a a a a a a a"), ("en", " new york city" * 30), ("en", " new york city" * 30), ("fr", "seul")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "c", "d", 1) for r in sample()], "lang string, text string, word string, ids string, n long").repartition(4)


def got(df):
    return {(r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_collocations(docs, monkeypatch, small):
    if small:  # many windows, shards, rounds, pieces and slices
        for name, value in {"WINDOW_TOKENS": 50, "SLICE_BYTES": 40, "STREAM_IDS": 7, "SHARD_GRAMS": 400, "FILTER_GRAMS": 100, "PIECE": 8, "FAN": 2, "NGRAM_IDS": 11, "BROADCAST_BYTES": 0}.items():
            monkeypatch.setattr(C, name, value)
    found = C.collocations(docs)
    rows = got(found)
    assert rows == plain(sample()) and found.count() == len(rows)
    first = C.top(found, 5)
    want = {}
    for lang in {r[0] for r in rows}:
        want |= {(lang, k + 1): p[1] for k, p in enumerate(sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:5])}
    assert {(r.lang, r.rank): r.phrase for r in first.collect()} == want


def test_longer_phrases(docs):
    assert got(C.collocations(docs, words=5, least=12, drop_pct=70)) == plain(sample(), 5, 12, 70)


def test_nothing(spark, docs):
    assert C.collocations(docs.limit(0)).count() == 0
    assert C.collocations(docs.where("text is null")).count() == 0


def test_long_text(spark, monkeypatch):
    monkeypatch.setattr(C, "SLICE_BYTES", 1000)
    monkeypatch.setattr(C, "WINDOW_TOKENS", 500)
    text = " ".join(f"w{k % 37} v{k % 11}" for k in range(9000)) + ". " + "one more, " * 5000
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    assert got(C.collocations(df)) == plain([("en", text)])


@pytest.mark.parametrize("words, bits", [(3, 16), (3, 21), (3, 42), (5, 25), (2, 16)])
def test_packing_and_filters(words, bits):
    rng = np.random.default_rng(bits)
    packing = C.Packing(words, bits)
    ids = rng.integers(1, 1 << bits, (5000, words))
    ids[::3, -1] = 0 if words > 2 else ids[::3, -1]
    ids[:50] = ids[50:100]
    hi, lo = packing.pack(list(ids.T))
    assert int(hi.max()) < 1 << packing.high and int(lo.max()) < 1 << packing.low
    assert np.array_equal(np.stack(packing.unpack(hi, lo), 1), ids)
    n = rng.integers(1, 1000, 5000)
    run = C.merged([(hi, lo, n)])
    want = Counter()
    for key, c in zip(map(tuple, ids.tolist()), n.tolist()):
        want[key] += c
    back = []
    for batch in C._pieces(packing, run, 3):
        for shard, depth, prefix, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
            assert prefix >> (depth - 3) == shard
            back.append(C.filter_run(packing, depth, prefix, data))
    hi, lo, n = C.merged(back)
    assert all(np.array_equal(x, y) for x, y in zip(run, (hi, lo, n)))
    assert dict(zip(map(tuple, np.stack(packing.unpack(hi, lo), 1).tolist()), n.tolist())) == want


def test_too_many_bits():
    with pytest.raises(ValueError):
        C.Packing(5, 30)


def test_exact_beyond_64_bits(spark):
    big = 10**13
    got = spark.range(1).select(F.lit(big).cast("decimal(15,0)").alias("a")).select((F.col("a") * F.col("a") * F.lit(C.UNIT).cast("decimal(7,0)")).alias("up"), (F.col("a") * F.col("a")).alias("low"))
    assert got.selectExpr("up div low").first()[0] == C.UNIT
