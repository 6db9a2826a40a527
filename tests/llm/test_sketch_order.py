"""Paragraphs in order, edited texts from kept words, texts larger than a window."""

from __future__ import annotations

from collections import Counter

import numpy as np

from pitfeat.llm import sketch
from tests.llm.conftest import PROSE


def text_of(rng, n):
    return " ".join(f"w{k}" for k in rng.integers(0, 400, n))


def test_shuffled_words_are_another_text():
    rng = np.random.default_rng(1)
    words = text_of(rng, 5000).split()
    mixed = [words[k] for k in rng.permutation(len(words))]
    assert sketch.likeness([sketch.digests(" ".join(words))], [sketch.digests(" ".join(mixed))])[0] < 0.2


def test_digests_follow_paragraphs():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 50, 900):
        a, b = text_of(rng, n), text_of(rng, n) + " " + PROSE * 3
        b = a[:len(a) // 2] + b
        x, y = Counter(sketch.paragraphs(a)), Counter(sketch.paragraphs(b))
        left, right = sketch.digests(a), sketch.digests(b)
        assert len(left) == sum(x.values()) == len(set(left.tolist()))
        assert len(np.intersect1d(left, right)) == sum((x & y).values())


def test_edited_words_are_those_of_the_edited_text():
    rng = np.random.default_rng(3)
    hashes = sketch._Hashes()
    texts = ["", "a", "a b", "é" * 50, "日本語" * 30 + " x", " lead", "trail ", "a\n\nb\tc " * 20, text_of(rng, 300), "x" * 90 + " y " * 9, PROSE, PROSE + " " + "z" * 400]
    for t in texts:
        for f in texts:
            c = sketch.edited(t, f).encode()
            words = hashes.of(sketch.words_of(t.encode()))
            assert np.array_equal(sketch._edited_words(words, t.encode(), c, hashes), hashes.of(sketch.words_of(c)))


def test_first_size_only_saves_time(monkeypatch):
    rng = np.random.default_rng(4)
    left = [sketch.digests(text_of(rng, n)) for n in (0, 5, 200, 3000)]
    right = [sketch.digests(text_of(rng, n)) for n in (7, 5, 10, 2500)]
    want = [(set(a.tolist()), set(b.tolist())) for a, b in sketch.differences(left, right)]
    monkeypatch.setattr(sketch, "_first_side", lambda a, b: sketch.LEAST_SIDE)
    assert [(set(a.tolist()), set(b.tolist())) for a, b in sketch.differences(left, right)] == want


def test_text_larger_than_a_window(spark, monkeypatch):
    monkeypatch.setattr(sketch, "WINDOW_BYTES", 10_000)
    rng = np.random.default_rng(5)
    texts = [text_of(rng, n) for n in (10, 9000, 20, 4000, 5)]
    got = sorted(sketch.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    for k, r in enumerate(got):
        after = texts[(k + 1) % len(texts)]
        for near, other in ((r.near_next, after), (r.near_edited, sketch.edited(texts[k], after))):
            a, b = Counter(sketch.paragraphs(texts[k])), Counter(sketch.paragraphs(other))
            assert abs(near - 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))) < 1e-9
