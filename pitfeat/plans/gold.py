"""Raw tables to silver to one feature row per match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from pitfeat.functions.numbers import safe_ratio
from pitfeat.functions.text import clock_to_seconds, norm_key, strip, to_number
from pitfeat.operators.aggregates import dedupe_first
from pitfeat.operators.joins import asof_backward, enrich
from pitfeat.operators.ordered import HOT_ROWS, no_hot_keys
from pitfeat.operators.pairing import SIDES, matchup, pair_sides, rank_features
from pitfeat.operators.pit import GAP_ROWS, HORIZONS, WINDOWS, pit_features
from pitfeat.operators.pricing import implied_prices, price_features

# Figures of a match summed and averaged over an entity's history, and the ratios made of them.
MEASURES = ["sig_strikes_succ", "sig_strikes_att", "total_strikes_succ", "total_strikes_att", "takedown_succ", "takedown_att",
            "submission_att", "reversals", "ctrl_time_sec"]
RATES = {"sig_acc": ("sig_strikes_succ", "sig_strikes_att"), "td_acc": ("takedown_succ", "takedown_att")}


@dataclass(frozen=True)
class MatchTables:
    """Column names of the entity rows and what is computed from them."""

    match: str = "fight_url"
    entity: str = "fighter_name"
    ts: str = "event_date"
    side_order: Sequence[str] = ("fighter_name",)
    tie: Sequence[str] = ("fight_url",)
    measures: Sequence[str] = tuple(MEASURES)
    rates: Mapping[str, tuple[str, str]] = field(default_factory=lambda: dict(RATES))
    windows: Sequence[int] = tuple(WINDOWS)
    horizons: Sequence[int] = tuple(HORIZONS)

    @property
    def recency(self) -> list[str]:
        return ["days_since", "ordinal", *[f"count_{d}d" for d in self.horizons], f"avg_gap_{GAP_ROWS}"]

    @property
    def rolled(self) -> list[str]:
        names = [*self.measures, *self.rates, *self.recency]
        return [f"{c}_m{w}" for w in self.windows for c in names]

    @property
    def summed(self) -> list[str]:
        return [f"{c}_s{w}" for w in self.windows for c in self.measures]


def silver_matches(events: DataFrame, matches: DataFrame, event: str = "event_url", match: str = "fight_url") -> DataFrame:
    """Matches with date and name of their event."""
    info = events.select(event, F.to_date(F.try_to_timestamp(F.col("event_date").cast("string"))).alias("event_date"), F.col("title").alias("event_name"))
    return enrich(matches.select(match, event), info, event).distinct()


def silver_prices(prices: DataFrame, matches: DataFrame, match: str = "fight_url", order: Sequence[str] = (), p1: str = "odds_f1", p2: str = "odds_f2") -> DataFrame:
    """First price row per match joined to its match, with implied and margin-free probabilities."""
    one = dedupe_first(prices.withColumn(match, norm_key(F.col(match))), [match], order or [c for c in prices.columns if c != match])
    priced = one.select(match, to_number(F.col(p1)).alias(p1), to_number(F.col(p2)).alias(p2))
    return implied_prices(enrich(matches, priced, match), p1, p2)


def silver_ranks(entities: DataFrame, ranks: DataFrame, entity: str = "fighter_name", ts: str = "event_date", match: str = "fight_url",
                 rank_ts: str = "rank_date", rank: str = "rank", segment: str = "weight_class", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Last known rank and segment of each entity at its match; equal dates are decided by segment, then rank."""
    timeline = ranks.select(F.col("fighter").alias(entity), rank_ts, segment, rank)
    return asof_backward(entities.select(entity, match, ts), timeline, [entity], ts, rank_ts, [rank, segment], [segment, rank], [match], hot_rows)


def clean_stats(stats: DataFrame, cfg: MatchTables) -> DataFrame:
    """Numeric measures with missing figures as 0, and the ratios of a match."""
    out = stats.withColumn(cfg.entity, strip(F.col(cfg.entity).cast("string")))
    if "ctrl_time" in out.columns and "ctrl_time_sec" not in out.columns:
        out = out.withColumn("ctrl_time_sec", clock_to_seconds(F.col("ctrl_time")))
    kinds = dict(out.dtypes)
    out = out.withColumns({m: F.coalesce(to_number(F.col(m)) if kinds[m] == "string" else F.col(m).cast("double"), F.lit(0.0)) for m in cfg.measures})
    return out.withColumns({r: safe_ratio(F.col(a), F.col(b)) for r, (a, b) in cfg.rates.items()})


def entity_history(stats: DataFrame, cfg: MatchTables, ranks: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Point-in-time features per entity row; ``ranks`` (entity, rank_date, rank) adds the last known rank.

    Both steps are windows over the entity, so the as-of join and the features share one shuffle.
    """
    if ranks is not None:
        if no_hot_keys([stats, ranks], [cfg.entity], hot_rows):
            hot_rows = None  # asked once for both steps
        stats = asof_backward(stats, ranks, [cfg.entity], cfg.ts, "rank_date", ["rank"], ["rank"], list(cfg.tie), hot_rows)
    out = pit_features(stats, [cfg.entity], cfg.ts, list(cfg.tie), list(cfg.measures), list(cfg.rates), cfg.windows, cfg.horizons, hot_rows=hot_rows)
    keep = dict.fromkeys([cfg.match, cfg.entity, cfg.ts, *cfg.side_order, *(["rank"] if ranks is not None else []), *cfg.recency, *cfg.rolled, *cfg.summed])
    return out.select(*keep)


def match_rows(history: DataFrame, cfg: MatchTables, ranked: bool = False) -> DataFrame:
    """Pair the two sides of each match and add matchup columns."""
    cols = list(dict.fromkeys([cfg.entity, cfg.ts, *(["rank"] if ranked else []), *cfg.recency, *cfg.rolled, *cfg.summed]))
    pairs = pair_sides(history, [cfg.match], list(cfg.side_order), cols)
    out = matchup(pairs, [*cfg.rolled, *cfg.recency], cfg.recency)
    out = rank_features(out) if ranked else out
    return out.withColumn(cfg.ts, F.col(SIDES[0] + cfg.ts))


def attach_prices(pairs: DataFrame, prices: DataFrame, match: str, p1: str, p2: str, name_1: str | None = None, entity: str = "fighter_name") -> DataFrame:
    """Join prices of the match and add price features; with ``name_1`` prices are turned to the side that name is on."""
    cols = [match, F.col(p1).alias("price_1"), F.col(p2).alias("price_2")]
    if name_1:
        cols.append(F.col(name_1).alias("_name"))
    out = pairs.join(prices.select(*cols), match, "left")
    if name_1:
        turn = F.col("_name") == F.col(SIDES[1] + entity)
        a, b = F.col("price_1"), F.col("price_2")
        out = out.withColumns({"price_1": F.when(turn, b).otherwise(a), "price_2": F.when(turn, a).otherwise(b)}).drop("_name")
    return price_features(implied_prices(out, "price_1", "price_2"), "price_1", "price_2")


def gold_features(stats: DataFrame, matches: DataFrame | None = None, prices: DataFrame | None = None, ranks: DataFrame | None = None,
                  cfg: MatchTables = MatchTables(), p1: str = "odds_f1", p2: str = "odds_f2", name_1: str | None = None,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """One feature row per match. ``matches`` brings the date where ``stats`` lacks it."""
    rows = clean_stats(stats, cfg)
    if matches is not None:
        rows = enrich(rows, matches.select(cfg.match, cfg.ts), cfg.match)
    needed = dict.fromkeys([cfg.match, cfg.entity, cfg.ts, *cfg.side_order, *cfg.tie, *cfg.measures, *cfg.rates])
    history = entity_history(rows.select(*needed), cfg, ranks, hot_rows)
    pairs = match_rows(history, cfg, ranks is not None)
    return pairs if prices is None else attach_prices(pairs, prices, cfg.match, p1, p2, name_1, cfg.entity)
