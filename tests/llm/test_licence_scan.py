"""Licence scans against plain search for phrases, and notices with edits."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat.llm import licence_scan as L
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text: str | None) -> tuple:
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(label, i) for label, phrase in L.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for _, i in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for b, _ in places}))


def rows_with_licences() -> list[tuple]:
    rng = np.random.default_rng(1)
    bits = [p for _, p in L.BASE] + ["license", "gnu", "apache", "by", "cc", "mit", "MIT-License", "CC BY-NC 4.0", "\x7fé", "x"]
    rows = [(100 + k, " ".join(rng.choice(bits, rng.integers(0, 40))), "en", "s", 1) for k in range(60)]
    notice = dict((label, text) for label, text, _ in L.NOTICES)
    words = notice["mit"].split()
    edited = " ".join([*words[:20], "really", *words[20:40], *words[42:]])
    rows += [(200, "prose before. " * 30 + notice["mit"] + " after" * 50, "en", "s", 1), (201, edited, "en", "s", 1),
             (202, notice["bsd-2-clause"] + notice["bsd-3-clause"], "en", "s", 1), (203, " ".join(words[60:]), "en", "s", 1), (204, "cc by " * 40_000, "en", "s", 1)]
    return [(*r, *[None] * (len(odd_rows()[0]) - 5)) for r in rows]


def test_scan(spark, odd):
    every = odd.unionAll(spark.createDataFrame(rows_with_licences(), odd.schema))
    done = L.scan_licences(every)
    assert done.select("input.*").columns == odd.columns
    rows = done.collect()
    texts = sorted(((r.input.doc_id, r.input.text) for r in rows), key=str)
    assert texts == sorted(((r[0], r[1]) for r in [*odd_rows(), *rows_with_licences()]), key=str)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(r.input.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(s.label for s in r.spans))
    by_id = {r.input.doc_id: r for r in rows}
    assert by_id[200].labels == "mit" and by_id[200].base_labels == "" and by_id[200].score == 1
    assert by_id[201].labels == "mit"
    assert by_id[202].labels == "bsd-2-clause,bsd-3-clause"
    assert by_id[203].labels == "" and by_id[203].score < 0.75
    assert by_id[204].n_base == 40_000 and by_id[4].labels == "" and by_id[4].score < 0.5
    span = by_id[200].spans[0]
    assert L.words_of(by_id[200].input.text)[span.start:span.end].count(b"sublicense") == 1


def test_nothing(nothing):
    assert L.scan_licences(nothing).count() == 0


@pytest.mark.parametrize("name", [label for label, _, _ in L.NOTICES])
def test_every_notice_is_found_among_prose(name):
    items = L.templates()
    index = L.Index(items, 1000, {w: 900 for w in L.words_of("the of to in and is a this for any you may with or it")})
    text = next(t for label, t, _ in L.NOTICES if label == name)
    _, spans, best = index.scan(L.words_of("the quick software of this file " * 9 + text + " and so on" * 9))
    assert name in spans and best == 1


def test_counts_cover_all_documents(spark, odd):
    n, counts = L.document_counts(odd, {b"cat", b"nowhere"})
    want = [r for r in odd_rows() if b"cat" in L.words_of(r[1])]
    assert (n, counts) == (len(odd_rows()), {b"cat": len(want)})


def test_query(spark, sf_dir):
    from pitfeat.llm.licence_scan import op11_licence_scan

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text")).collect()}
    got = op11_licence_scan(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
