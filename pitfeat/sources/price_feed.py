"""Nested JSON price feed to one row per event and book."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Shape of a feed entry and the market that is read.
FEED = ("struct<id:string,sport_key:string,sport_title:string,commence_time:string,home_team:string,away_team:string,"
        "bookmakers:array<struct<key:string,title:string,last_update:string,"
        "markets:array<struct<key:string,outcomes:array<struct<name:string,price:double>>>>>>>")
MARKET = "h2h"


def flatten_price_feed(feed: DataFrame, column: str = "json", market: str = MARKET) -> DataFrame:
    """First head-to-head market of each book, its first two outcomes; books without two outcomes are left out."""
    entry = feed.select(F.from_json(F.col(column), FEED).alias("e"))
    # explode_outer: plain explode adds a filter on the array's size, for which each text would be parsed once more
    books = entry.select("e.*").withColumn("b", F.explode_outer("bookmakers")).drop("bookmakers")
    # chosen once per book, in one expression that the size test and the columns share after the filter
    at = F.array_position(F.col("b.markets.key"), F.lit(market))
    rows = books.withColumn("m", F.when(at > 0, F.get("b.markets", (at - 1).cast("int")))).where(F.size("m.outcomes") >= 2)
    first, second = F.col("m.outcomes")[0], F.col("m.outcomes")[1]
    versus = F.btrim(F.concat(F.coalesce("home_team", F.lit("")), F.lit(" vs "), F.coalesce("away_team", F.lit(""))))
    return rows.select(
        F.col("id").alias("event_id"), "sport_key", "sport_title", F.col("commence_time").alias("event_time"),
        F.coalesce(F.nullif("sport_title", F.lit("")), versus).alias("event_name"), "home_team", "away_team",
        F.col("b.title").alias("book"), F.col("b.key").alias("book_key"), F.col("b.last_update").alias("book_last_update"),
        F.col("m.key").alias("market_key"), F.size("m.outcomes").alias("outcome_count"),
        first["name"].alias("f1_name"), first["price"].alias("odds_f1"),
        second["name"].alias("f2_name"), second["price"].alias("odds_f2"))
