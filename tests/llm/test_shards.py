"""The shards of the mix."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from pitfeat.llm import mixing
from pitfeat.session import durable
from tests.llm.test_operators import WORD


def test_mixed_documents_come_in_shards(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(7 + k % 50)), "ab"[k % 2]) for k in range(300)], "doc_id long, text string, source string")
    words = sum(7 + k % 50 for k in range(300))
    mixed = mixing.mix_documents(docs, 16, 2000)
    shards = math.ceil(words * 1.5 / 2000)
    each = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    assert shards > 3
    got = Counter()
    for r in mixed.select("source", "text", F.spark_partition_id().alias("p")).collect():
        got[r.p // each, r.source] += len(WORD.findall(r.text))
    sizes = durable(mixing.sizes_of(docs.withColumn("rid", F.monotonically_increasing_id())))
    parts, goal = mixing.mix(sizes, 16, shard_words=2000)
    want = {(r.shard, r.source): r.n for r in parts.where("took is not null").groupBy("shard", "source").agg(F.sum("took").alias("n")).collect()}
    assert got == want and {s for s, _ in got} == set(range(shards))
    target = {r.source: round(r.target) for r in goal.collect()}
    for (_, source), n in got.items():  # binomial counts of blocks of 16 words
        slots, p = target[source] / 16, 1 / shards
        assert abs(n / 16 - slots * p) < 5 * math.sqrt(slots * p * (1 - p)) + 1
