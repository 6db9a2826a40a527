"""Price polls: files that a poller drops are flattened and upserted batch by batch.

Every batch goes through the same keyed upsert as a batch job; a replayed batch changes nothing, as its rows win again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pitfeat.sources.price_feed import flatten_price_feed
from pitfeat.sources.keyed import BUCKETS, KeyedTable
from pitfeat.sources.tables import upsert_table

# Key of a stored quote.
QUOTE_KEY = ["event_name", "book", "f1_name", "f2_name"]


def poll_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """One feed entry of JSON text per line of the polled files."""
    return flatten_price_feed(spark.readStream.schema("json string").text(folder), "json")


def upsert_stream(quotes: DataFrame, root: str, checkpoint: str, keys: Sequence[str] = tuple(QUOTE_KEY), position: str = "book_last_update") -> StreamingQuery:
    """Fold all batches that are there into the stored table, then stop."""
    def fold(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert_table(batch.sparkSession, root, batch.withColumn("_at", batch[position]), list(keys), "_at")

    return quotes.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream_buckets(quotes: DataFrame, root: str, checkpoint: str, stream: str, keys: Sequence[str] = tuple(QUOTE_KEY), position: str = "book_last_update",
                          buckets: int = BUCKETS) -> StreamingQuery:
    """The same into a table of hash buckets, which a batch rewrites only where its keys fall. The table remembers the last batch of ``stream``, so a replay changes nothing even after others
    have written newer rows."""
    def fold(batch: DataFrame, number: int) -> None:
        KeyedTable(batch.sparkSession, root, keys, buckets).upsert(batch.withColumn("_at", batch[position]), "_at", (stream, number))

    return quotes.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
