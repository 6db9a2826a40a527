"""The language model's restaurants: every context word has its own, whatever bucket it lies in."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from pitfeat.llm import pitman_yor as lm

TEXTS = ["a b a b a b c", "b c a b a", "", "c c c c c a a b", "d", "a b c d e f g a b c d e f g", *["a b"] * 200, "x a y a z a"]


def hashed(word: str | None) -> int:
    return lm.END_HASH if word is None else xxhash.xxh64_intdigest(word.encode())


def counted(texts: list[str]) -> Counter:
    """(context, word) pairs; None is the end of a text and the context of its first word."""
    return Counter(pair for t in texts for ws in [[*t.split(), None]] for pair in zip([None, *ws], ws))


def exchanged(boxes: dict[int, lm.Bucket], kind) -> dict[int, list]:
    """What each bucket receives, in the order of the senders."""
    out = {b: [] for b in boxes}
    for b in sorted(boxes):
        for to, message in list(kind(boxes[b])):
            out[to].append((b, message))
    return out


@pytest.fixture(scope="module", params=[1, 3])
def fitted(request):
    """Buckets after all sweeps, without Spark, checked sweep by sweep against plain sums over all dishes."""
    buckets = request.param
    group = lm.Group(TEXTS, [True] * len(TEXTS), buckets)
    questions = dict(group.questions())
    made = {b: lm.merged([q], buckets) for b, q in questions.items()}
    boxes = {b: box for b, (box, _) in made.items()}
    names = {hashed(w): w for _, w in counted(TEXTS)}
    words = {b: [names[h] for h in box.words.tolist()] for b, box in boxes.items()}
    dishes = {b: [(names[c], words[b][w]) for c, w in zip(box.asked[box.at].tolist(), box.word.tolist())] for b, box in boxes.items()}
    contents = np.sum([box.contents() for box in boxes.values()], axis=0)
    for b, got in exchanged(boxes, lambda x: x.introduce(buckets)).items():
        boxes[b].meet(got)
    pairs = counted(TEXTS)
    model, models = lm.Model(int(contents[0]), int(contents[1]), 0.7, 0.5, strength=3.0, root_strength=2.0), []
    for n in range(-1, lm.BURN_IN + lm.SAMPLES):
        if n >= 0:
            for b, got in exchanged(boxes, lambda x: x.replies()).items():
                boxes[b].sweep(b, n, got, model)
        for b, got in exchanged(boxes, lambda x: x.sums()).items():
            boxes[b].add(got)
        seated = {pair: 1 for pair in pairs} | {pair: t for b, box in boxes.items() for pair, t in zip(dishes[b], box.seated.tolist())}
        assert all(1 <= seated[pair] <= pairs[pair] for pair in pairs)
        for b, box in boxes.items():
            assert box.tables.tolist() == [sum(t for (c, _), t in seated.items() if c == w) for w in words[b]]
            assert box.below.tolist() == [sum(t for (_, v), t in seated.items() if v == w) for w in words[b]]
            assert box.customers.tolist() == [sum(k for (c, _), k in pairs.items() if c == w) for w in words[b]]  # a word is a context as often as it occurs
            assert ((box.root >= 1) & (box.root <= box.below)).all()
        totals = np.sum([box.totals(model) for box in boxes.values()], axis=0)
        model = model._replace(root_customers=totals[0], root_tables=totals[1])
        if n >= lm.BURN_IN:
            for box in boxes.values():
                box.keep()
            models.append(model)
    return group, made, boxes, words, models, contents


def test_contents(fitted):
    pairs, contents = counted(TEXTS), fitted[-1]
    words, contexts = Counter(), Counter()
    for (_, w), k in pairs.items():
        words[w] += k
        contexts[w] += 1
    assert contents.tolist() == [sum(words.values()), len(words), sum(k == 1 for k in pairs.values()), sum(k == 2 for k in pairs.values()),
                                 sum(k == 1 for k in contexts.values()), sum(k == 2 for k in contexts.values())]


def test_probabilities_sum_to_one(fitted):
    group, made, boxes, words, models, _ = fitted
    total = len(group.words)
    every = np.arange(total * total)  # each word after each word, met or not
    place = {hashed(w): k for k, w in enumerate([w for b in sorted(words) for w in words[b]])}
    assert sorted(place.values()) == list(range(total)) and [place[h] for h in group.words.tolist()] == list(range(total))
    pairs = counted(TEXTS)
    names = [w for b in sorted(words) for w in words[b]]
    # the answers that a group would get if it asked for every pair
    answers = []
    for b in sorted(boxes):
        number = {(int(w), int(a)): k for k, (w, a) in enumerate(zip(boxes[b].word, boxes[b].at))}
        at_of = {}
        for lo_b, lo, hi in boxes[b].asks:
            links = dict(boxes[lo_b].links)[b]
            at_of |= {words[lo_b][r]: lo + k for k, r in enumerate(links.tolist())}
        count, dish = [], []
        for w, name in enumerate(words[b]):
            for context in names:
                k = pairs[context, name]
                count.append(k)
                if k > 1:
                    dish.append(number[w, at_of[context]])
        asked = (np.arange(len(words[b])), np.array(count, np.uint32), np.array(dish, np.int64))
        answers.append(lm.answer(boxes[b], asked))
    p = lm.predicted(answers, every, models).reshape(total, total)
    customers, tables = np.concatenate([a[0] for a in answers]), [np.concatenate([a[2][n][3] for a in answers]) for n in range(len(models))]
    unknown = np.mean([(m.strength + m.discount * t) / (m.strength + customers) * m.root_probability(np.zeros(1), np.zeros(1)) for m, t in zip(models, tables)], axis=0)
    assert np.abs(p.sum(axis=0) + unknown - 1).max() < 1e-6


def test_likelihood_against_single_restaurants():
    rng = np.random.default_rng(2)
    customers = rng.integers(1, 60, 300)
    tables = np.minimum(customers, rng.integers(1, 20, 300))
    got, want = lm.likelihood(customers, tables, 0.6), []
    for s in lm.GRID:
        # the chance of opening tables: (s + d)(s + 2d)...(s + (t-1)d) over (s + 1)...(s + c - 1)
        want.append(sum(sum(math.log(s + 0.6 * k) for k in range(1, t)) - sum(math.log(s + k) for k in range(1, c)) for c, t in zip(customers.tolist(), tables.tolist())))
    shift = np.array(want) - got  # the discount's powers are the same for every strength
    assert np.abs(shift - sum(tables - 1) * math.log(0.6)).max() < 1e-5


def test_seating_follows_the_process():
    """Mean tables of a dish against the exact chain over table counts."""
    count, others, parent, d, s = 30, 4.0, 0.2, 0.5, 3.0
    chance = {1: 1.0}
    for i in range(1, count):
        after = Counter()
        for t, p in chance.items():
            new = (s + d * (others + t)) * parent
            q = new / (new + i - d * t)
            after[t + 1] += p * q
            after[t] += p * (1 - q)
        chance = after
    mean = sum(t * p for t, p in chance.items())
    got = lm.seat(np.random.default_rng(1), np.full(20000, count), np.full(20000, others), np.full(20000, parent), d, s)
    assert abs(got.mean() - mean) < 0.05
