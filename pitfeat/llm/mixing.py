"""Mixing sources to target weights, from built-in expressions only.

The words of a source form one stream, cut into blocks of ``block`` words (the last may be shorter); a document is one or more segments of
blocks. The mix has slots: slot i of pass q of a source takes block perm(i), where perm is a pseudorandom permutation of the
source's full blocks (swap-or-not rounds, a bijection for every number of blocks), so each pass takes every block once. Slots are dealt to
the output shards by independent uniform draws, so every shard's count of a source is multinomial while the totals are exact; ``mix_documents`` writes the shards
one after another. The last
slot of a source is cut to the words still missing, so a source gives its target to the word. Slots meet the segments by block index.

Targets. A source weighs 5, 2 or 1 by its rank in code point order (null last), repeating. ``share`` times all words are shared by weight;
no source goes above ``most`` times its size, the excess is shared among the others by weight. With sources ordered by size over weight, the capped
ones are a prefix, found by running sums over the table of sources (one row per source).

Streams are ordered by a hash of the document. Positions come from running sums in groups of about the square root of all rows, and running
sums of the group totals, so no source is gathered in one task.

Edge cases. Null text has size 0, takes part in no block and is taken 0 times. A null source is a source of its own. Equal rows each have their
place. Nothing in, nothing out. Extra columns are kept by ``mix_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitfeat.llm.common import WORD, documents, numbered, query, same, whole
from pitfeat.session import durable

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BLOCK, ROUNDS, SEED, SHARD_WORDS = 2048, 16, 20, 1 << 24
RUN = 8192  # slots made from one row at a time


def n_words(text: Column | str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def _place() -> Column:
    return F.xxhash64(F.lit(SEED), F.col("doc_id"), whole("text"))


def sizes_of(rows: DataFrame) -> DataFrame:
    """rid, doc_id, source, size and the stream order; ``rows`` has rid, doc_id, source, text."""
    return rows.select("rid", "doc_id", "source", n_words("text").alias("size"), _place().alias("h"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: one row per source."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(named) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sums.select("source", "source_size", w.alias("w"), (F.col("source_size") * most).cast("double").alias("cap"))
    tail = Window.orderBy((F.col("cap") / F.col("w")).desc(), F.col("source").desc_nulls_first())
    rest = ranked.withColumns({
        # of this source and all with a higher cap per weight
        "w_rest": F.sum("w").over(tail.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "cap_rest": F.sum("cap").over(tail.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = rest.withColumn("left", F.sum("cap").over(every) / most * share - (F.sum("cap").over(every) - F.col("cap_rest")))
    rest = rest.withColumn("capped", F.col("cap") * F.col("w_rest") <= F.col("left") * F.col("w"))
    free = ~F.col("capped")
    # the widest uncapped suffix holds all uncapped sources: its level is the common one
    widest = F.max(F.when(free, F.struct("w_rest", (F.col("left") / F.col("w_rest")).alias("level")))).over(every)
    rest = rest.withColumn("level", widest["level"])
    return rest.select("source", "source_size", F.when(free, F.least("cap", F.col("level") * F.col("w"))).otherwise(F.col("cap")).alias("target"))


def positions(sizes: DataFrame, rows: int) -> DataFrame:
    """``sizes`` with ``start``, the number of words before it in its source's stream."""
    grouped = sizes.withColumn("g", F.pmod("h", F.lit(max(1, math.isqrt(rows)))))
    total = grouped.groupBy("source", "g").agg(F.sum("size").alias("n"))
    before = total.select(F.col("source").alias("s_source"), F.col("g").alias("s_g"), (F.sum("n").over(
        Window.partitionBy("source").orderBy("g").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("g_start"))
    inner = Window.partitionBy("source", "g").orderBy("h", "doc_id", "size", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = grouped.withColumn("in_g", F.sum("size").over(inner) - F.col("size"))
    return placed.join(before, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("g") == F.col("s_g"))).select(
        "rid", "doc_id", "source", "size", (F.col("g_start") + F.col("in_g")).alias("start"))


def permuted(i: Column, n: Column, key: list[Column]) -> Column:
    """A bijection of 0 .. n-1: each round swaps i with (k - i) mod n or not, by a hash bit of the larger of the two."""
    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        return F.when(F.xxhash64(r, *key, F.greatest(x, other)).bitwiseAND(1) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i, step)


def slots(goal: DataFrame, block: int, shards: Column | int, most: int = MOST) -> DataFrame:
    """source, pass, slot, shard, block number b, and the words that the slot takes from the front of the block."""
    size, want = F.col("source_size"), F.round("target").cast("long")
    runs = goal.where(want > 0).select(
        "source", size.alias("size"), want.alias("want"), F.ceil(size / block).alias("n"), F.floor(size / block).alias("full"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.ceil(size / block) - 1) / RUN))).alias("run"))
    runs = runs.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass")).where(
        F.col("pass") * F.col("size") + F.col("run") * RUN * block < F.col("want")).repartition("source", "pass", "run")
    each = runs.select("*", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col("n")) - 1)).alias("slot"))
    words = F.least(F.lit(block), F.col("size") - F.col("slot") * block, F.col("want") - F.col("pass") * F.col("size") - F.col("slot") * block)
    each = each.select("source", "pass", "slot", "full", words.alias("words")).where(F.col("words") > 0)
    key = [F.lit(SEED), F.col("source"), F.col("pass")]
    return each.select("source", "pass", "slot", F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("source"), F.col("pass"), F.col("slot")), shards).alias("shard"),
                       F.when(F.col("slot") < F.col("full"), permuted(F.col("slot"), F.greatest(F.col("full"), F.lit(1)), key)).otherwise(F.col("slot")).alias("b"),
                       "words")


def n_shards(words: int, share: float = SHARE, shard_words: int = SHARD_WORDS) -> int:
    return max(1, math.ceil(words * share / shard_words))


def segments(placed: DataFrame, block: int) -> DataFrame:
    """A row per document and block it lies in: lo and hi in the block, and ``skip``, the document's words before it; b is null without words."""
    last = F.col("start") + F.col("size")
    cut = placed.withColumn("b", F.explode_outer(F.when(F.col("size") > 0, F.sequence(
        F.floor(F.col("start") / block), F.floor((last - 1) / block)))))
    lo = F.greatest(F.col("start") - F.col("b") * block, F.lit(0))
    return cut.select("rid", "doc_id", "source", "size", "b", lo.alias("lo"), F.least(last - F.col("b") * block, F.lit(block)).alias("hi"),
                      (F.col("b") * block + lo - F.col("start")).alias("skip"))


def mix(sizes: DataFrame, block: int = BLOCK, weights=WEIGHTS, share: float = SHARE, most: int = MOST, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(parts, goal): a row per segment and slot that takes it, with ``took`` words from word ``skip`` on (null if no slot does), and the targets.

    ``sizes`` must be a stored table of ``sizes_of``.
    """
    goal = durable(targets(sizes, weights, share, most))
    rows, words = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    drawn = slots(goal, block, F.lit(n_shards(words, share, shard_words)), most).withColumnsRenamed({"source": "d_source", "b": "d_b"})
    cut = segments(positions(sizes, rows), block)
    met = cut.join(drawn, F.col("source").eqNullSafe(F.col("d_source")) & (F.col("b") == F.col("d_b")), "left").drop("d_source", "d_b")
    took = F.least("hi", "words") - F.col("lo")
    return met.withColumn("took", F.when(F.col("words").isNotNull() & (took > 0), took)), goal


def taken(parts: DataFrame, goal: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: a row per document."""
    per = parts.groupBy("rid", "doc_id", "source", "size").agg(F.coalesce(F.sum("took"), F.lit(0)).cast("long").alias("taken"))
    goal = goal.withColumnRenamed("source", "g_source")
    return per.join(goal, F.col("source").eqNullSafe(F.col("g_source"))).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The mix as documents: a row per document, pass and shard that takes words of it, whose text holds these words.

    A document taken whole keeps its text; of one taken in part, the taken stretches follow each other, with their own white space. Each shard has
    the same number of partitions, the first shard the first ones, and so on.
    """
    # rows are told by doc_id, source, a hash of the text and, where these repeat, a number
    keys = ["d", "s", "t"]
    rows = docs.select(F.struct("*").alias("input"), F.col("doc_id").alias("d"), F.col("source").alias("s"), F.xxhash64(whole("text")).alias("t"))
    flat = rows.select(F.monotonically_increasing_id().alias("rid"), F.col("d").alias("doc_id"), F.col("s").alias("source"), "t", "input.text")
    sizes = durable(flat.select("rid", "doc_id", "source", "t", n_words("text").alias("size"), _place().alias("h")))
    most = sizes.groupBy("doc_id", "source", "t").count().agg(F.max("count")).first()[0] or 1
    shards = n_shards(sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], shard_words=shard_words)
    each = -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    parts, _ = mix(sizes.drop("t"), block, shard_words=shard_words)
    cuts = parts.where("took is not null").groupBy("rid", "pass", "shard", "size").agg(
        F.sum("took").alias("took"), F.sort_array(F.collect_list(F.struct("skip", "took"))).alias("cuts"))
    named = numbered(sizes.select(F.col("rid").alias("n_rid"), F.col("doc_id").alias("n_d"), F.col("source").alias("n_s"), F.col("t").alias("n_t")), ["n_d", "n_s", "n_t"], most, "n_copy")
    cuts = cuts.join(named, F.col("rid") == F.col("n_rid"))
    met = numbered(rows, keys, most).join(cuts, same({"d": "n_d", "s": "n_s", "t": "n_t", "copy": "n_copy"}))
    words = F.regexp_extract_all(whole("input.text"), F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    some = F.array_join(F.flatten(F.transform("cuts", lambda c: F.slice(words, (c["skip"] + 1).cast("int"), c["took"].cast("int")))), "")
    text = F.when(F.col("took") == F.col("size"), F.col("input.text")).otherwise(some)
    dealt = (F.col("shard") * each + F.pmod(F.xxhash64("rid", "pass"), F.lit(each))).cast("int")
    out = met.withColumn("place", dealt).repartitionById(shards * each, F.col("place"))
    return out.select(*[text.alias("text") if c == "text" else F.col(f"input.`{c}`").alias(c) for c in docs.columns])


@query("op3_mixing")
def op3_mixing(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source", "text", F.monotonically_increasing_id().alias("rid"))
    sizes = durable(sizes_of(rows))
    return taken(*mix(sizes))
