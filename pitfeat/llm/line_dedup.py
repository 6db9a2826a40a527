"""Line dedup: of the lines that several documents share, only the first document keeps its own.

Each line is a pair of 64-bit hashes of its key (white space stripped at both ends, A-Z lower-cased). The hashes are range-partitioned and
sorted by (hash, document, position) within each partition, so one streaming pass over a partition meets the first document of every hash and
marks the lines of all later documents. What comes back is no text but a bitmap per document: 64 lines per word, words without a drop left out.

Hot lines. A hash that holds more rows than half a partition's share would make a partition of its own. Such hashes (fewer than two per
partition, by counting) are reduced by a pre-aggregated minimum instead, and that table, bounded by the number of partitions, is broadcast.

Edge cases. Null or empty text is one empty line. Lines of fewer than ``min_chars`` code points always stay. Rows with equal doc_id are one
document; identical rows get the same bitmap. A null doc_id counts as one document after all others. No rows in, no rows out. Extra
columns are kept by ``dedup_lines`` and never looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pitfeat.llm.common import LOWER, UPPER, WHITE, ascii_lower, documents, pieces, query, whole
from pitfeat.session import durable

LINE_BYTES = 64 << 20


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """doc, row (hash of the text, which tells apart rows of one doc_id), pos, and the two hashes of the line's key."""
    lines = docs.select(F.col(id_col).alias("doc"), whole(text_col).alias("text")).select(
        "doc", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "row", "pos", ascii_lower(F.btrim("line", F.lit(WHITE))).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _later(first: str):
    """True for rows of a document after the first one; null doc_ids come last."""
    return F.col(first).isNotNull() & (F.col("doc").isNull() | (F.col("doc") > F.col(first)))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """doc, row, n_dropped and ``keep``: (word, bits) of every 64 lines of which one is dropped; bit 1 means that the line stays."""
    lines = durable(line_hashes(docs, id_col, text_col, min_chars))
    parts = pieces(lines, LINE_BYTES)
    rows = lines.count()
    hot = (lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
           .where(F.col("n") > max(1, rows // (2 * parts))).select("h1", "h2", "first"))
    hot = F.broadcast(durable(hot))  # fewer than 2 * parts rows
    usual = lines.join(hot, ["h1", "h2"], "left_anti").repartitionByRange(parts, "h1", "h2")
    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc").asc_nulls_last(), "pos")
    usual = usual.withColumn("first", F.first("doc").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    again = usual.where(_later("first")).select("doc", "row", "pos").unionAll(
        lines.join(hot, ["h1", "h2"]).where(_later("first")).select("doc", "row", "pos"))
    words = again.groupBy("doc", "row", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("drop"))
    return words.groupBy("doc", "row").agg(
        F.sum(F.bit_count("drop")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("drop").alias("bits")))).alias("keep"))


def with_kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Columns ``input`` (the row as it came), n_lines, n_dropped and kept (the text of the lines that stay)."""
    marks = keep_bitmaps(docs, id_col, text_col, min_chars).withColumnsRenamed({"doc": "m_doc", "row": "m_row"})
    rows = docs.select(F.struct("*").alias("input")).withColumn("text", whole(F.col(f"input.`{text_col}`")))
    rows = rows.select("input", "text", F.col(f"input.`{id_col}`").alias("doc"), F.xxhash64("text").alias("row"))
    joined = rows.join(marks, F.col("doc").eqNullSafe(F.col("m_doc")) & (F.col("row") == F.col("m_row")), "left")
    lines = F.split("text", "\n", -1)
    keep = F.map_from_entries("keep")
    stays = F.filter(lines, lambda x, i: F.getbit(F.coalesce(F.element_at(keep, F.shiftright(i, 6)), F.lit(-1).cast("long")), i % 64) == 1)
    return joined.select(
        "input", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n")).alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """The same columns with only the lines that stay."""
    done = with_kept_lines(docs, id_col, text_col, min_chars)
    return done.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"input.`{c}`").alias(c) for c in docs.columns])


SQL = f"""with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos from documents),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') as k from lines),
marked as (select *, length(k) >= 10 and doc_id > min(doc_id) over (partition by k) as gone from keyed)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id"""


@query("op9_line_dedup", SQL)
def op9_line_dedup(spark, sf_dir):
    done = with_kept_lines(documents(spark, sf_dir))
    return done.select(F.col("input.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
