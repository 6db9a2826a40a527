"""Near-dedup of the pipeline against brute force over five-word shingles."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from pitfeat.llm import near_copies
from tests.llm.test_operators import WORD, lowered


def plain_set(text: str | None) -> frozenset:
    words = WORD.findall(lowered(text or ""))
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain_kept(rows: list[tuple[int, str]]) -> set[int]:
    sets, parent = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(key, least.get(find(i), key))
    return set(least.values())


def edits(rng: np.random.Generator, words: list[str], n: int) -> str:
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"x{rng.integers(1 << 30)}"
    return " ".join(out)


def test_pairs_from_80_percent_on_are_found(spark, sf_dir):
    """Texts with a few words changed; the fingerprints of op2 link few of those near 0.8."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(150):
        words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, edits(rng, words, 1 + k % 6))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()}
    want = plain_kept(rows)
    assert len(want) < 250
    assert want <= got and len(got - want) <= 1  # a pair at 0.8 shares no key with probability 0.0007


def test_fingerprints_alone_find_close_copies(spark, monkeypatch):
    """Without any key of least hashes, texts with a word or two changed meet by their fingerprints; texts of one component that are not alike stay apart."""
    monkeypatch.setattr(near_copies, "_shared", lambda nodes: spark.createDataFrame([], "key long, n long, node long, reach long"))
    rng = np.random.default_rng(11)
    rows = []
    for k in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, 1500)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, edits(rng, words, 1 + k % 2))]
    rows += [(100, None), (101, "one"), (102, "one two"), (103, ""), (104, rows[0][1])]
    got = {r.doc_id for r in near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == plain_kept(rows)


def test_neighbours_across_batches(spark):
    """A component's nodes meet over the limits of Arrow batches, and only those within the bits of the fingerprints and the sizes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        nodes = near_copies.durable(spark.createDataFrame([(100 + k, 100, (1 << k) - 1) for k in range(12)] + [(200, 300, 1)], "node long, n long, fp long"))
        got = {(r.a, r.b) for r in near_copies._close(nodes).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(100 + a, 100 + b) for a in range(12) for b in range(a + 1, min(12, a + 5))}


@pytest.mark.parametrize("following", [2, 100])
def test_a_large_group_in_rounds(spark, monkeypatch, following):
    """Chains within a group whose members are alike at about 0.7, and far ones, come out as by brute force."""
    monkeypatch.setattr(near_copies, "NEXT", following)
    rng = np.random.default_rng(9)
    words = [f"w{x}" for x in rng.integers(0, 5000, 150)]
    rows = [(k, edits(rng, words, int(rng.integers(1, 6)))) for k in range(80)]
    rows += [(80 + k, t) for k, t in enumerate(["", None, " \n", "one", "One", "one two", "a b c d e", "a b c d e f"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in near_copies.drop_near_copies(docs).collect()} == plain_kept(rows)


def test_pages_of_a_template_cost_in_proportion(spark, monkeypatch):
    """Pages alike at 0.7 share a template; nearly all pairs of them used to be verified, 15 times as many for four times as many pages."""
    rng = np.random.default_rng(10)
    frame = [f"w{x}" for x in rng.integers(0, 5000, 196)]
    real, pairs = near_copies._verified, []

    def counted(found, sets):
        pairs[-1] += found.count()
        return real(found, sets)

    monkeypatch.setattr(near_copies, "_verified", counted)
    for size in (150, 600):
        pairs.append(0)
        rows = [(k, " ".join(frame + [f"x{rng.integers(1 << 40)}" for _ in range(42)])) for k in range(size)]
        assert near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).count() == size
    assert 0 < pairs[1] < 5 * pairs[0]


@pytest.mark.parametrize("seed", range(2))
def test_rare_shingles_leave_no_pair_out(spark, monkeypatch, seed):
    """With the index of rare shingles from the start, sizes from 1 to 60 and similarities around 0.8 come out as by brute force."""
    monkeypatch.setattr(near_copies, "FAR", near_copies.NEXT)
    rng = np.random.default_rng(20 + seed)
    frames = [[f"w{x}" for x in rng.integers(0, 300, 60)] for _ in range(3)]
    rows = []
    for k in range(120):
        own = [f"z{rng.integers(1 << 40)}" for _ in range(int(rng.integers(0, 9)))]  # a little of its own, or too much
        words = list(frames[rng.integers(3)][int(rng.integers(0, 6)):int(rng.integers(45, 61))])
        for at in rng.choice(len(words), int(rng.integers(0, 3)), replace=False):
            words[at] = f"y{rng.integers(4)}"
        rows.append((k, " ".join(words + own)))
    assert {r.doc_id for r in near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == plain_kept(rows)


def test_awkward_rows(spark, odd, nothing):
    kept = near_copies.drop_near_copies(odd)
    assert kept.columns == odd.columns
    sets = [plain_set(r.text) for r in kept.collect()]
    assert len(set(sets)) == len(sets) and all(5 * len(a & b) < 4 * len(a | b) for k, a in enumerate(sets) for b in sets[:k])
    assert near_copies.drop_near_copies(nothing).count() == 0
