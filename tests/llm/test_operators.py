"""Each operator against a plain version of its contract, on awkward rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitfeat.llm import chunk_bpe, factorisation, line_dedup, mixing, pitman_yor, quality_rules, simhash, sketch, token_files, url_filter
from pitfeat.llm.bpe import encoder, vocabulary_path
from pitfeat.session import shared_dir
from tests.llm.conftest import EXTRA, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def ids_of(library, text: str | None) -> list[int]:
    return library.encode(text or "", add_special_tokens=False).ids


# token files

def test_token_files(spark, odd, nothing, library):
    manifest = token_files.write_tokens(odd, f"{shared_dir(spark)}/tokens-test-{id(odd)}", vocabulary_path())
    rows = sorted(token_files.read_tokens(manifest).collect(), key=lambda r: r.start)
    assert [r.key for r in rows] == sorted((r[0] for r in odd_rows()), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in rows:
        assert (r.start, len(r.ids)) == (at, 4 * r.n_tokens)
        at += r.n_tokens
    want = Counter((r[0], tuple(ids_of(library, r[1]) + [0])) for r in odd_rows())
    assert Counter((r.key, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == want
    found = token_files.look_up(manifest, spark.createDataFrame([(4,), (9,), (1000,), (None,)], "k long")).collect()
    assert sorted(r.key for r in found) == [4, 4, 4, 9]
    assert token_files.read_tokens(token_files.write_tokens(nothing, f"{shared_dir(spark)}/none", vocabulary_path())).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    index = token_files.PerfectHash.build(keys)
    assert np.array_equal(np.sort(index.find(keys)), np.arange(len(keys)))
    assert token_files.PerfectHash.build(keys[:0]).find(keys[:2]).tolist() == [-1, -1]


# near duplicates

def plain_fingerprint(text: str | None) -> int:
    words = WORD.findall(lowered(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows: list[tuple[int | None, int]]) -> list[int | None]:
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    groups: dict[int, list[int]] = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).extend([key] if key is not None else [])
    plain_classes.number = len(groups)
    return [min(groups[find(i)], default=None) for i in range(len(rows))]


@pytest.mark.parametrize("dense", [4096, 1])
def test_near_duplicates(spark, odd, nothing, monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(odd).collect()]
    rows = [(r[0], plain_fingerprint(r[1])) for r in odd_rows()]
    assert Counter(got) == Counter((k, fp, c) for (k, fp), c in zip(rows, plain_classes(rows)))
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.count() == plain_classes.number
    assert simhash.near_duplicates(nothing).count() == 0


def test_dense_neighbours_find_chains(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 63))
    values = {centre}
    while len(values) < 300:  # a ball of many fingerprints and a chain away from it
        values.add(centre ^ sum(1 << int(b) for b in rng.integers(0, 63, 3)))
    chain = [centre ^ (1 << 62) ^ ((1 << 3 * k) - 1) for k in range(12)]
    rows = [(k, v) for k, v in enumerate([*sorted(values), *chain, 1, 1 << 62])]
    df = spark.createDataFrame([(k, v if v < 1 << 63 else v - (1 << 64)) for k, v in rows], "doc_id long, fp long")
    for dense in (4096, 8):
        simhash.DENSE, old = dense, simhash.DENSE
        try:
            got = {r.doc_id: r.component_id for r in df.join(simhash.classes(df), F.col("fp") == F.col("c_fp")).collect()}
        finally:
            simhash.DENSE = old
        assert got == {k: c for (k, _), c in zip(rows, plain_classes(rows))}


def test_golay_keys_meet_within_two_bits():
    x = np.arange(2048, dtype=np.int64)  # one vector of every coset
    keys = simhash.codewords(x)
    flips = [0, *(1 << i for i in range(23)), *(1 << i | 1 << j for i in range(23) for j in range(i))]
    for e in flips:
        other = simhash.codewords(x ^ e)
        assert ((keys[:, :, None] == other[:, None, :]) & (keys[:, :, None] >= 0)).any(axis=(1, 2)).all()


# mixing

def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    free, target = set(names), {}
    while True:
        left, w = 1.5 * sum(sizes.values()) - sum(target.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 2 * sizes[s]] if free else []
        if not over:
            return target | {s: left * weight[s] / w for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.remove(s)


@pytest.mark.parametrize("block", [mixing.BLOCK, 7])
def test_mixing(spark, odd, nothing, block):
    rows = odd.select("doc_id", "source", "text", F.monotonically_increasing_id().alias("rid"))
    sizes = mixing.durable(mixing.sizes_of(rows))
    got = mixing.taken(*mixing.mix(sizes, block)).join(sizes.select("doc_id", "source").distinct(), "doc_id", "left").collect()
    plain = [(r[0], r[3], len(WORD.findall(r[1] or ""))) for r in odd_rows()]
    assert Counter((r.doc_id, r.size) for r in got) >= Counter((k, n) for k, _, n in plain)
    assert all(r.taken <= 2 * r.size for r in got)
    total = Counter()
    for _, s, n in plain:
        total[s] += n
    want = plain_targets(dict(total))
    parts, goal = mixing.mix(sizes, block)
    took = {r.source: r.t for r in parts.groupBy("source").agg(F.coalesce(F.sum("took"), F.lit(0)).alias("t")).collect()}
    for r in goal.collect():
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == total[r.source]
        assert took[r.source] == math.floor(r.target + 0.5)
    mixed = mixing.mix_documents(odd, block)
    assert mixed.columns == odd.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(WORD.findall(r.text))
    assert words == {s: t for s, t in took.items() if t}
    assert mixing.mix_documents(nothing).count() == 0


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), [F.lit(1), F.lit("s")]).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


# sketches

def test_sketches(spark, odd, nothing):
    rows = sorted(((r[0], r[1] or "") for r in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sketch.fingerprints(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in rows)
    by_size = {(r.doc_id, r.n_chars): r for r in got}
    for k in range(len(rows)):
        key, text = rows[k]
        if sum(r[0] == key for r in rows) > 1:
            continue  # equal ids are ordered by a hash
        follows = [r[1] for r in rows if r[0] == (rows[(k + 1) % len(rows)][0])]
        r = by_size[key, len(text)]
        assert r.edited_sha256 in {hashlib.sha256(sketch.edited(text, f).encode()).hexdigest() for f in follows}
        near = []
        for f in follows:
            a, b = Counter(sketch.paragraphs(text)), Counter(sketch.paragraphs(f))
            near.append(2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())) if a or b else 1.0)
        assert min(abs(r.near_next - n) for n in near) < 1e-9
    same = [r.fingerprint for r in got if r.doc_id == 4 and r.n_chars == len(odd_rows()[3][1])]
    assert len(same) == 2 and len(set(same)) == 1
    assert sketch.fingerprints(nothing).count() == 0


def test_difference_gives_back_digests():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 40, 3000):
        a, b, both = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (n, n // 2, 500))
        (left, right), = sketch.differences([np.r_[a, both]], [np.r_[b, both]])
        assert set(left.tolist()) == set(a.tolist()) and set(right.tolist()) == set(b.tolist())


# BPE

def test_chunked_bpe_equals_the_library(spark, odd, nothing, library):
    got = chunk_bpe.encode_documents(odd, vocabulary_path()).collect()
    want = Counter()
    for r in odd_rows():
        ids = ids_of(library, r[1])
        want[r[0], tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.key, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got) == want
    assert chunk_bpe.encode_documents(nothing, vocabulary_path()).count() == 0


def test_units_of_awkward_texts(library):
    rng = np.random.default_rng(1)
    parts = ["a", "b  ", "it's", "\n", "\t x", "日本", "テ　ス", "<|endoftext|>", "é", "  ", "\xa0", "\x85", "123", "!!", " ", "x" * 60, "a.", "b,", "I'll.", "9.", "é.", "\x1c", "᠎", "​"]
    enc = encoder(vocabulary_path())
    texts = ["".join(rng.choice(parts) + str(rng.choice([" ", "", "", "\n"])) for _ in range(rng.integers(1, 40))) for _ in range(500)]
    for text, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, enc.type).tolist() == ids_of(library, text), repr(text)


def test_shared_passages_are_cut_alike():
    shared = " ".join(f"w{k * 7919 % 1009}" for k in range(4000)).encode()
    data = b"first words here " + shared
    a = chunk_bpe.bodies(data, [0], [len(data)])[0]
    b = chunk_bpe.bodies(shared, [0], [len(shared)])[0]
    texts = {data[x:y] for x, y in a}
    assert sum(shared[x:y] in texts for x, y in b) >= len(b) - 1 > 5


# classifier

def test_classifier(spark, odd, nothing, labels):
    model = factorisation.train(odd, labels)
    got = factorisation.score(odd, model).select("input.doc_id", "input.text", "score", "predicted").collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.text == odd_rows()[3][1]}) == 1
    assert factorisation.score(nothing, model).count() == 0
    alone = factorisation.train(odd, labels.where("false"))
    assert {r.score for r in factorisation.score(odd, alone).select("score").collect()} == {0.5}


def test_interactions_in_linear_time():
    rng = np.random.default_rng(4)
    model = factorisation.Model(0.3, rng.normal(size=factorisation.SIZE), rng.normal(size=(factorisation.SIZE, factorisation.RANK)))
    index, value = np.array([3, 8, 20, 7]), rng.normal(size=4)
    plain = 0.3 + model.linear[index] @ value + sum(model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b] for a in range(4) for b in range(a))
    assert abs(model.margin(index, value, np.array([0]))[0][0] - plain) < 1e-9


def test_classifier_on_held_out_rows(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = factorisation.op6_factorisation(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    most = max(Counter(r.quality for r in got).values()) / len(got)
    assert np.mean([r.predicted == r.quality for r in got]) > max(0.9, most)


# language model

def test_language_model(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(pitman_yor, "GROUP_BYTES", 2000)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    got = pitman_yor.score(odd, held).collect()
    docs = [(r[0], [*WORD.findall(lowered(r[1] or "")), None]) for r in odd_rows()]
    out = lambda k: k is not None and zlib.crc32(str(k).encode()) % 10 == 0
    count = Counter(w for k, ws in docs for w in ws if not out(k))
    n, v = sum(count.values()), len(count)
    want = Counter((k, out(k), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for k, ws in docs)
    assert Counter((r.key, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)
    again = pitman_yor.score(odd, held).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert pitman_yor.score(nothing, held).count() == 0


def test_model_beats_base_on_held_out_text(spark, sf_dir):
    got = pitman_yor.op7_pitman_yor(spark, sf_dir).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


# quality rules

def test_quality_counts(spark, odd, nothing, labels):
    got = quality_rules.judge(odd, quality_rules.trusted_ids(labels)).select("input.doc_id", "input.text", *quality_rules.MADE).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        text = r.text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.kept and r.base_failed)
    assert quality_rules.judge(nothing, quality_rules.trusted_ids(labels)).count() == 0
    bare = quality_rules.judge(odd, quality_rules.trusted_ids(labels).where("false")).collect()
    assert all(r.kept != r.base_failed for r in bare)
    assert quality_rules.drop_rejected(odd, quality_rules.trusted_ids(labels)).columns == odd.columns


def test_quality_ratio_is_the_plain_one(spark, odd, labels):
    good, every = Counter(), Counter()
    trusted = {4, 20, 24, 99}
    for key, text, *_ in odd_rows():
        g = Counter(quality_rules.grams((text or "").encode()).tolist())
        every += g
        if key in trusted:
            good += g
    n_good, n = sum(good.values()), sum(every.values())
    for r in quality_rules.judge(odd, quality_rules.trusted_ids(labels)).select("input.text", "ratio").collect():
        g = quality_rules.grams((r.text or "").encode()).tolist()
        want = sum(math.log((good[b] + quality_rules.BUCKETS * every[b] / n) / (n_good + quality_rules.BUCKETS) / (every[b] / n)) for b in g) / max(1, len(g))
        assert abs(r.ratio - want) < 1e-5


# lines

@pytest.mark.parametrize("hot", [False, True])
def test_line_dedup(spark, odd, nothing, monkeypatch, hot):
    if hot:  # every hash is in more rows than half a share of so many partitions
        monkeypatch.setattr(line_dedup, "pieces", lambda df, each: 10_000)
    got = line_dedup.with_kept_lines(odd).select("input.doc_id", "n_lines", "n_dropped", "kept").collect()
    order = lambda k: (k is None, k or 0)
    first: dict[str, tuple] = {}
    keyed = lambda x: lowered(x.strip(" \t\n\x0b\x0c\r"))
    for r in odd_rows():
        for x in (r[1] or "").split("\n"):
            if len(keyed(x)) >= 10:
                first[keyed(x)] = min(first.get(keyed(x), order(r[0])), order(r[0]))
    want = Counter()
    for r in odd_rows():
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if len(keyed(x)) < 10 or first[keyed(x)] == order(r[0])]
        want[r[0], len(lines), len(lines) - len(stay), "\n".join(stay)] += 1
    assert Counter(tuple(r) for r in got) == want
    assert line_dedup.dedup_lines(odd).columns == odd.columns
    assert line_dedup.with_kept_lines(nothing).count() == 0


# URLs

def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?y#z", "http://example.org/en/1", "http://www.x.com/fr", "http://x.com/fr/", "http://x.com/de/1", "http://example.organic/es/",
            "http://m.spam-farm.example.net/a/", "http://spam-farm.example.net/a.html?q=1", "http://other.net/a", "http://other.net/a", "ftp://other.net#://example.org/es/", "http://org/"]
    extra = EXTRA[:3]
    pages = spark.createDataFrame([(k, u, *["x"] * len(extra)) for k, u in enumerate(urls)], "page_id long, url string, " + ", ".join(f"{c} string" for c in extra))
    listed = url_filter.bad_urls(pages)
    assert {r.url for r in listed.collect()} == {"a.example.org/es/x", "example.org/en/1", "x.com/de/1", "spam-farm.example.net/a"}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, listed).select("input.page_id", "host", "path", "rule", "verdict").collect()}
    assert len(got) == len(urls)
    assert [got[k] for k in (0, 1, 2, 3)] == [("", "", None, "allow")] * 4
    assert got[4] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[5][2:] == ("example.org/en/1", "block")
    assert got[6][2:] == (None, "allow") and got[7][2:] == ("com/fr/", "allow") and got[8][2:] == ("com/de/", "block")
    assert got[9][2:] == (None, "allow") and got[10][3] == got[11][3] == "block" and got[10][2] is None
    assert got[12][3] == "allow" and got[14][0] == "other.net" and got[15][2:] == ("org/", "allow")
    none = url_filter.filter_urls(pages, listed.where("false"))
    assert none.where("rule is null and verdict = 'block'").count() == 0
    assert url_filter.filter_urls(pages.where("false"), listed).count() == 0


def test_bloom_passes_every_listed_url_and_few_others(spark, monkeypatch):
    listed = spark.range(3000).select(F.concat(F.lit("host.example/"), "id").alias("url"))
    pages = spark.range(9000).select(F.concat(F.lit("host.example/"), "id").alias("url"))
    for limit in (url_filter.BROADCAST_BYTES, 0):
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
        got = url_filter.with_listed(pages, F.col("url"), listed, "url")
        assert got.where("listed").count() == 3000 and got.count() == 9000
