"""Stake sizing, event limits, return figures and bankroll simulation over tables of priced probabilities.

Rows carry ``p`` (probability of side 1), ``y`` (1 when side 1 won), ``price_1`` and ``price_2``; the names can be
changed per call. Nothing loops over rows: event rules are aggregates joined back, histories are running totals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitfeat.functions.numbers import edge, kelly
from pitfeat.operators.aggregates import best_by
from pitfeat.operators.ordered import BEFORE, BLOCK, HOT_ROWS, ordered_blocks, running, running_small, split_hot, with_totals
from pitfeat.session import durable


@dataclass(frozen=True)
class Policy:
    min_edge: float
    cap: float
    multiplier: float = 1.0
    p_min: float = 0.0


# Default policy, the fixed policy of the yearly and hold-out runs, event limits, search grid.
DEFAULT_POLICY = Policy(0.02, 0.05, 1.0, 0.0)
FIXED_POLICY = Policy(0.04, 0.02, 0.25, 0.0)
MAX_BETS_PER_EVENT = 999
MAX_EXPOSURE_PER_EVENT = 0.2
START_BANKROLL = 1000.0
GRID = [Policy(e, c, m, q) for e, c, m, q in product([0.0, 0.02, 0.04, 0.06], [0.02, 0.05, 0.10], [0.25, 0.5, 1.0], [0.0, 0.55, 0.6])]
NO_SCORE = -1e9


def _side(e1: Column, e2: Column, min_edge: Column | float) -> Column:
    return F.when((e1 >= min_edge) & (e1 >= e2), 1).when((e2 >= min_edge) & (e2 > e1), 2).otherwise(0)


def _fraction(side: Column, k1: Column, k2: Column, p: Column, cap, multiplier, p_min) -> Column:
    sized = F.when(side == 1, F.least(k1 * multiplier, cap)).when(side == 2, F.least(k2 * multiplier, cap)).otherwise(0.0)
    chosen = F.when(side == 1, p).when(side == 2, 1.0 - p).otherwise(0.0)
    return F.when(chosen >= p_min, sized).otherwise(0.0)


def _unit(side: Column, y: Column, o1: Column, o2: Column) -> Column:
    """Profit of a stake of 1 on the chosen side."""
    return (F.when(side == 1, F.when(y == 1, o1 - 1.0).otherwise(-1.0))
            .when(side == 2, F.when(y == 1, -1.0).otherwise(o2 - 1.0)).otherwise(0.0))


def choose_side(df: DataFrame, min_edge: float, p: str = "p", price_1: str = "price_1", price_2: str = "price_2") -> DataFrame:
    """Edges and side: 1 or 2 with the larger edge of at least ``min_edge`` (a tie goes to 1), 0 for no bet or a missing price."""
    e1, e2 = edge(F.col(p), F.col(price_1)), edge(1.0 - F.col(p), F.col(price_2))
    return df.select("*", e1.alias("edge_1"), e2.alias("edge_2"), _side(e1, e2, min_edge).alias("side"))


def stake(df: DataFrame, cap: float, multiplier: float = 1.0, p_min: float = 0.0, p: str = "p", price_1: str = "price_1",
          price_2: str = "price_2", name: str = "fraction") -> DataFrame:
    """Fraction of the bankroll on the chosen ``side``: min(kelly * multiplier, cap), 0 below the probability floor."""
    k1, k2 = kelly(F.col(p), F.col(price_1)), kelly(1.0 - F.col(p), F.col(price_2))
    ok = F.col(price_1).isNotNull() & F.col(price_2).isNotNull()
    f = _fraction(F.col("side"), k1, k2, F.col(p), F.lit(cap), multiplier, p_min)
    return df.withColumn(name, F.when(ok, f).otherwise(0.0))


def profit(df: DataFrame, fraction: str = "fraction", y: str = "y", price_1: str = "price_1", price_2: str = "price_2") -> DataFrame:
    """``unit_profit`` of the chosen side and ``profit`` = fraction * unit profit."""
    unit = _unit(F.col("side"), F.col(y), F.col(price_1), F.col(price_2))
    return df.withColumn("unit_profit", unit).withColumn("profit", F.coalesce(F.col(fraction) * F.col("unit_profit"), F.lit(0.0)))


def cap_count(df: DataFrame, event: str, order: Sequence[str], n: int = MAX_BETS_PER_EVENT, fraction: str = "fraction",
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keep the first ``n`` positive stakes of each event in row order, set later ones to 0."""
    placed = F.when(F.col(fraction) > 0, 1).otherwise(0)
    counted = running(df, [event], order, {"_bets": ("sum", placed)}, hot_rows)
    kept = F.when((F.col(fraction) > 0) & (F.col("_bets") > n), 0.0).otherwise(F.col(fraction))
    return counted.withColumn(fraction, kept).drop("_bets")


def cap_exposure(df: DataFrame, event: str, cap: float = MAX_EXPOSURE_PER_EVENT, fraction: str = "fraction") -> DataFrame:
    """Scale the stakes of an event so that they sum to at most ``cap``.

    Only events over the cap are joined back; their sums come from a map-side combined aggregate.
    """
    over = (df.where(F.col(fraction) > 0).groupBy(F.col(event).alias("_event")).agg(F.sum(fraction).alias("_exposure"))
            .where(F.col("_exposure") > cap))
    joined = df.join(over, df[event].eqNullSafe(over["_event"]), "left")
    scaled = F.when(F.col("_exposure").isNotNull(), F.col(fraction) * (F.lit(cap) / F.col("_exposure"))).otherwise(F.col(fraction))
    return joined.withColumn(fraction, scaled).drop("_event", "_exposure")


def apply_event_caps(df: DataFrame, event: str, order: Sequence[str], max_bets: int | None = MAX_BETS_PER_EVENT,
                     max_exposure: float | None = MAX_EXPOSURE_PER_EVENT, fraction: str = "fraction") -> DataFrame:
    if max_bets is not None:
        df = cap_count(df, event, order, max_bets, fraction)
    return cap_exposure(df, event, max_exposure, fraction) if max_exposure else df


def place_bets(df: DataFrame, policy: Policy, event: str | None = None, order: Sequence[str] = (), max_bets: int | None = None,
               max_exposure: float | None = None) -> DataFrame:
    """Side, stake, event limits and profit in one go."""
    out = stake(choose_side(df, policy.min_edge), policy.cap, policy.multiplier, policy.p_min)
    if event:
        out = apply_event_caps(out, event, order, max_bets, max_exposure)
    return profit(out)


def roi_summary(bets: DataFrame, by: Sequence[str] = (), fraction: str = "fraction", gain: str = "profit") -> DataFrame:
    """Wager, profit, return on wager, hit rate, mean and spread of per-row return, bets placed.

    Per-row figures count rows without a bet as 0 (``sharpe_per_bet``); ``sharpe_bets_only`` leaves them out.
    """
    f, g = F.col(fraction), F.col(gain)
    each = g / F.greatest(f, F.lit(1e-9))
    real = F.when(f > 0, each)
    return bets.groupBy(*by).agg(
        F.sum(f).alias("total_wager"), F.sum(g).alias("total_profit"),
        F.coalesce(F.try_divide(F.sum(g), F.sum(f)), F.lit(0.0)).alias("roi"),
        F.coalesce(F.avg(F.when(f > 0, (g > 0).cast("double"))), F.lit(0.0)).alias("hit_rate"),
        (F.avg(each) / (F.stddev_pop(each) + 1e-9)).alias("sharpe_per_bet"),
        (F.avg(real) / (F.stddev_pop(real) + 1e-9)).alias("sharpe_bets_only"),
        F.count_if(f > 0).alias("n_bets"))


def drawdown(df: DataFrame, order: Sequence[str], gain: str = "profit", by: Sequence[str] = (), hot_rows: int = HOT_ROWS,
             start: float | None = None) -> DataFrame:
    """Running profit, its running maximum, and the drop below it, in row order.

    ``start`` adds a value the running profit begins at before the first row counts towards the maximum.
    """
    usual, hot = split_hot(df, by, hot_rows)
    total = {"cum_profit": ("sum", F.col(gain))}
    top = {"running_max": ("max", F.col("cum_profit"))}
    parts = []
    if usual is not None:
        parts.append(running_small(running_small(usual, by, order, total), by, order, top))
    if hot is not None:
        parts.append(_drawdown_in_blocks(hot, by, order, gain))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if start is not None:
        out = out.withColumns({"cum_profit": F.col("cum_profit") + start, "running_max": F.col("running_max") + start})
    return out.withColumn("drawdown", F.col("cum_profit") - F.col("running_max"))


def _drawdown_in_blocks(df: DataFrame, by: Sequence[str], order: Sequence[str], gain: str) -> DataFrame:
    """Running profit and its maximum of hot keys: one pass of windows within blocks, then block figures carried forward.

    A block is told by its sum and its largest running sum, a pair that combines: before a block stand the sum of all earlier sums, and the largest of their running
    sums, each raised by what came before it.
    """
    keys = [*by, BLOCK]
    inside = running_small(running_small(ordered_blocks(df, by, order), keys, order, {"_sum": ("sum", F.col(gain))}), keys, order, {"_top": ("max", F.col("_sum"))})
    inside = durable(inside)
    blocks = inside.groupBy(*keys).agg(F.sum(gain).alias("_all"), F.max("_top").alias("_high"))
    joined = with_totals(inside, _before_blocks(blocks, by).select(*keys, "_base", "_before"), by)
    base = F.coalesce("_base", F.lit(0.0))
    cum = F.when(F.col("_sum").isNull(), F.col("_base")).otherwise(base + F.col("_sum"))
    return joined.select(*df.columns, cum.alias("cum_profit"), F.greatest("_before", F.when(F.col("_top").isNotNull(), base + F.col("_top"))).alias("running_max"))


def _before_blocks(blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per block the running profit before it, and the largest one there."""
    earlier = Window.partitionBy(*by).orderBy(BLOCK) if by else Window.orderBy(BLOCK)  # one row per block
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    raised = blocks.withColumn("_base", F.sum("_all").over(earlier))
    return raised.withColumn("_before", F.max(F.coalesce("_base", F.lit(0.0)) + F.col("_high")).over(earlier))


def max_drawdown(df: DataFrame, order: Sequence[str], gain: str = "profit", by: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """The deepest drop of each key. Only keys, order and gains are read, once, and each block of a hot key is folded to a row."""
    usual, hot = split_hot(durable(df.select(*dict.fromkeys([*by, *order, gain]))), by, hot_rows)
    parts = []
    if usual is not None:
        parts.append(drawdown(usual, order, gain, by, None).groupBy(*by).agg(F.min("drawdown").alias("max_drawdown")))
    if hot is not None:
        parts.append(_deepest_in_blocks(hot, by, order, gain))
    return reduce(DataFrame.unionByName, parts)


def _deepest_in_blocks(df: DataFrame, by: Sequence[str], order: Sequence[str], gain: str) -> DataFrame:
    """The deepest drop of hot keys from one row per block: its sum, its largest and smallest running sum and its own deepest drop.

    A row's drop is the larger of that below the top of its block and that below the top before its block, which is deepest where the running sum is smallest.
    Rows before the first gain of their block stand at the sum before it.
    """
    keys = [*by, BLOCK]
    placed = ordered_blocks(df, by, order, place="_at", keep=list(dict.fromkeys([*by, gain])))
    inside = running_small(running_small(placed, keys, ["_at"], {"_sum": ("sum", F.col(gain))}), keys, ["_at"], {"_top": ("max", F.col("_sum"))})
    blocks = inside.groupBy(*keys).agg(F.sum(gain).alias("_all"), F.max("_sum").alias("_high"), F.min("_sum").alias("_low"), F.min(F.col("_sum") - F.col("_top")).alias("_fall"),
                                       F.count_if(F.col("_sum").isNull()).alias("_none"))
    raised = _before_blocks(blocks, by)
    base = F.coalesce("_base", F.lit(0.0))
    lost = F.isnan(base) | F.coalesce(F.isnan("_before"), F.lit(False))
    deepest = F.least(F.when(lost, F.lit(float("nan"))).otherwise(F.col("_fall")), base + F.col("_low") - F.col("_before"), F.when(F.col("_none") > 0, F.col("_base") - F.col("_before")))
    return raised.groupBy(*by).agg(F.min(deepest).alias("max_drawdown"))


def compound(bets: DataFrame, event: Sequence[str], start: float = START_BANKROLL, by: Sequence[str] = (),
             fraction: str = "fraction", unit: str = "unit_profit", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Bankroll before and after each event, all stakes of an event taken from the bankroll at its start.

    ``event`` holds the columns events are ordered by. Rows are folded to one return per event before any ordering.
    """
    gain = F.when(F.col(fraction) > 0, F.col(fraction) * F.col(unit)).otherwise(0.0)
    events = bets.groupBy(*by, *event).agg(F.sum(gain).alias("event_return"), F.count_if(F.col(fraction) > 0).alias("n_bets"))
    factor = 1.0 + F.col("event_return")
    grown = running(events, by, event, {"_to": ("product", factor), "_from": ("product", factor, BEFORE)}, hot_rows)
    return grown.select(*by, *event, "event_return", "n_bets", (F.lit(start) * F.coalesce("_from", F.lit(1.0))).alias("event_start_bankroll"),
                        (F.lit(start) * F.col("_to")).alias("bankroll"))


def _band(value: Column, floors: Sequence[float]) -> Column:
    """How many of the ascending floors the value reaches."""
    return sum([(value >= f).cast("int") for f in floors[1:]], (value >= floors[0]).cast("int"))


def policy_scores(df: DataFrame, grid: Sequence[Policy] = tuple(GRID), event: str | None = None, max_exposure: float | None = None,
                  p: str = "p", y: str = "y", price_1: str = "price_1", price_2: str = "price_2", max_bets: int | None = None, order: Sequence[str] = (),
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Wager, profit, return, and per-row return ratio of every policy, from one pass and without copying rows.

    A bet goes to the side with the larger edge; the policy's floors only decide whether it is placed. So a row is
    described by how many edge floors and probability floors it reaches, and rows are summed per event and pair of
    these counts, with one pair of sums for each (cap, multiplier). Policies are then sums over the few counts they
    accept; the event exposure limit scales those sums. With ``max_bets`` only the first so many bets of a policy in an event count, in ``order``: what
    a policy bets on depends on its two floors alone, so a running count per pair of floors decides, and sums are kept per pair.
    """
    pc, yc, o1, o2 = F.col(p), F.col(y), F.col(price_1), F.col(price_2)
    edges, floors = sorted({float(g.min_edge) for g in grid}), sorted({float(g.p_min) for g in grid})
    sizes = sorted({(float(g.cap), float(g.multiplier)) for g in grid if g.cap > 0 and g.multiplier > 0})
    e1, e2 = edge(pc, o1), edge(1.0 - pc, o2)
    first = F.col("_e1") >= F.col("_e2")
    at = [F.col(c).alias(f"_at{i}") for i, c in enumerate(order)] if max_bets is not None else []
    rows = df.where(pc.isNotNull() & o1.isNotNull() & o2.isNotNull()).select(
        *at, (F.col(event) if event else F.lit(None).cast("string")).alias("_event"), pc.alias("_p"), yc.alias("_y"), o1.alias("_o1"), o2.alias("_o2"),
        e1.alias("_e1"), e2.alias("_e2"))
    sided = rows.select(
        *[f"_at{i}" for i in range(len(at))], "_event", _band(F.greatest("_e1", "_e2"), edges).alias("_edge"),
        _band(F.when(first, F.col("_p")).otherwise(1.0 - F.col("_p")), floors).alias("_floor"),
        F.when(first, kelly(F.col("_p"), F.col("_o1"))).otherwise(kelly(1.0 - F.col("_p"), F.col("_o2"))).alias("_k"),
        _unit(F.when(first, 1).otherwise(2), F.col("_y"), F.col("_o1"), F.col("_o2")).alias("_u"))
    placed = sided.where("_k > 0 and _edge > 0 and _floor > 0")
    staked = [F.least(F.col("_k") * m, F.lit(c)) for c, m in sizes]
    if max_bets is not None:
        return _table(df, grid, _limited(placed, grid, edges, floors, sizes, staked, max_bets, [f"_at{i}" for i in range(len(at))], hot_rows), max_exposure)
    folded = placed.groupBy("_event", "_edge", "_floor").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_u").alias("_r"), F.sum(F.col("_u") * F.col("_u")).alias("_rr"),
        *[F.sum(f).alias(f"_f{i}") for i, f in enumerate(staked)], *[F.sum(f * F.col("_u")).alias(f"_g{i}") for i, f in enumerate(staked)])
    # one entry per policy: which sums it reads and which counts it accepts
    tried = F.array(*[
        F.struct(F.lit(i).alias("policy"), F.lit(edges.index(g.min_edge)).alias("edge"), F.lit(floors.index(g.p_min)).alias("floor"),
                 F.lit(sizes.index((g.cap, g.multiplier)) if g.cap > 0 and g.multiplier > 0 else -1).alias("size")) for i, g in enumerate(grid)])
    each = folded.select("_event", "_edge", "_floor", "_n", "_r", "_rr", F.array(*[f"_f{i}" for i in range(len(sizes))]).alias("_fs"),
                         F.array(*[f"_g{i}" for i in range(len(sizes))]).alias("_gs"), F.explode(tried).alias("t"))
    each = each.where((F.col("_edge") > F.col("t.edge")) & (F.col("_floor") > F.col("t.floor")) & (F.col("t.size") >= 0))
    per_event = each.groupBy(F.col("t.policy").alias("policy"), "_event").agg(
        F.sum(F.get("_fs", "t.size")).alias("_f"), F.sum(F.get("_gs", "t.size")).alias("_g"), F.sum("_r").alias("_r"), F.sum("_rr").alias("_rr"), F.sum("_n").alias("_n"))
    return _table(df, grid, per_event, max_exposure)


def _limited(placed: DataFrame, grid: Sequence[Policy], edges: list[float], floors: list[float], sizes: list[tuple[float, float]], staked: list[Column],
             max_bets: int, order: list[str], hot_rows: int) -> DataFrame:
    """Sums per policy and event over the first ``max_bets`` bets of the event."""
    pairs = [(i, j) for i in range(len(edges)) for j in range(len(floors))]
    takes = {pair: (F.col("_edge") > pair[0]) & (F.col("_floor") > pair[1]) for pair in pairs}
    counted = running(placed, ["_event"], order, {f"_c{i}_{j}": ("sum", F.when(takes[i, j], 1).otherwise(0)) for i, j in pairs}, hot_rows)

    def sums(i: int, j: int) -> Column:
        def over(c: Column) -> Column:
            return F.sum(F.when(takes[i, j] & (F.col(f"_c{i}_{j}") <= max_bets), c))

        u = F.col("_u")
        return F.struct(F.coalesce(over(F.lit(1)), F.lit(0)).alias("n"), over(u).alias("r"), over(u * u).alias("rr"),
                        F.array(*[over(f) for f in staked]).alias("fs"), F.array(*[over(f * u) for f in staked]).alias("gs"))

    folded = counted.groupBy("_event").agg(*[sums(i, j).alias(f"_s{i}_{j}") for i, j in pairs])
    each = []
    for k, g in enumerate(grid):
        if g.cap > 0 and g.multiplier > 0:
            own, size = F.col(f"_s{edges.index(g.min_edge)}_{floors.index(g.p_min)}"), F.lit(sizes.index((g.cap, g.multiplier)))
            each.append(F.struct(F.lit(k).alias("policy"), F.get(own["fs"], size).alias("_f"), F.get(own["gs"], size).alias("_g"), own["r"].alias("_r"), own["rr"].alias("_rr"), own["n"].alias("_n")))
    return folded.select("_event", F.explode(F.array(*each)).alias("t")).select("_event", "t.*").where("_n > 0")


def _table(df: DataFrame, grid: Sequence[Policy], per_event: DataFrame, max_exposure: float | None) -> DataFrame:
    scale = F.lit(1.0) if not max_exposure else F.when(F.col("_f") > max_exposure, F.lit(max_exposure) / F.col("_f")).otherwise(1.0)
    totals = per_event.groupBy("policy").agg(
        F.sum(F.col("_f") * scale).alias("total_wager"), F.sum(F.col("_g") * scale).alias("total_profit"),
        F.sum("_r").alias("_r"), F.sum("_rr").alias("_rr"), F.sum("_n").alias("n_bets"))
    entries = F.array(*[F.struct(F.lit(i).alias("policy"), F.lit(float(g.min_edge)).alias("min_edge"), F.lit(float(g.cap)).alias("cap"),
                                 F.lit(float(g.multiplier)).alias("multiplier"), F.lit(float(g.p_min)).alias("p_min")) for i, g in enumerate(grid)])
    every = df.agg(F.count(F.lit(1)).alias("_rows")).select("_rows", F.explode(entries).alias("g")).select("_rows", "g.*")
    joined = every.join(totals, "policy", "left")
    mean = F.col("_r") / F.col("_rows")
    spread = F.sqrt(F.greatest(F.col("_rr") / F.col("_rows") - mean * mean, F.lit(0.0)))
    bet = F.col("total_wager") > 0
    return joined.select(
        "policy", "min_edge", "cap", "multiplier", "p_min",
        F.coalesce("total_wager", F.lit(0.0)).alias("total_wager"), F.coalesce("total_profit", F.lit(0.0)).alias("total_profit"),
        F.coalesce("n_bets", F.lit(0)).alias("n_bets"),
        F.when(bet, F.col("total_profit") / F.col("total_wager")).otherwise(NO_SCORE).alias("roi"),
        F.when(bet, mean / (spread + 1e-9)).otherwise(NO_SCORE).alias("sharpe"))


def tune_policy(df: DataFrame, grid: Sequence[Policy] = tuple(GRID), objective: str = "roi", event: str | None = None,
                max_exposure: float | None = None, default: Policy = DEFAULT_POLICY, max_bets: int | None = None, order: Sequence[str] = (), **names: str) -> Policy:
    """The policy with the best objective, first in grid order on ties; ``default`` when no policy places a bet."""
    scores = policy_scores(df, grid, event, max_exposure, max_bets=max_bets, order=order, **names)
    best = best_by(scores.where(F.col(objective) > NO_SCORE), objective, tie=["policy"]).first()
    return Policy(best["min_edge"], best["cap"], best["multiplier"], best["p_min"]) if best else default


def side_suggestion(df: DataFrame, cap: float = DEFAULT_POLICY.cap, min_edge: float = DEFAULT_POLICY.min_edge, p: str = "p",
                    price_1: str = "price_1", price_2: str = "price_2") -> DataFrame:
    """Stake per side, each on its own: min(kelly, cap) when the side's edge reaches the floor."""
    def one(prob: Column, price: Column) -> Column:
        return F.when(edge(prob, price) >= min_edge, F.least(kelly(prob, price), F.lit(cap))).otherwise(0.0)

    return df.select("*", one(F.col(p), F.col(price_1)).alias("kelly_1"), one(1.0 - F.col(p), F.col(price_2)).alias("kelly_2"))


def export_bets(df: DataFrame, keep: Sequence[str], policy: Policy = FIXED_POLICY) -> DataFrame:
    """Placed bets of a hold-out part with stake, edges and unit profit."""
    placed = place_bets(df, policy).where(F.col("fraction") > 0)
    return placed.select(*keep, F.col("side").alias("chosen_side"), F.col("p").alias("p_1"), (1.0 - F.col("p")).alias("p_2"),
                         "price_1", "price_2", "edge_1", "edge_2", F.col("fraction").alias("bet_fraction"), "unit_profit")


def yearly_compounding(df: DataFrame, date: str, event_name: str, keep: Sequence[str], start: float = START_BANKROLL,
                       policy: Policy = FIXED_POLICY, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bets, equity, summary) of a test year with event-level compounding.

    The growth rate is annualised over the span of the test rows, at least one day.
    """
    event = list(dict.fromkeys([date, event_name]))
    rows = place_bets(df, policy)
    equity = compound(rows, event, start, by)
    starts = equity.select(*by, *event, "event_start_bankroll")
    bets = (rows.where(F.col("fraction") > 0).join(starts, [*by, *event])
            .withColumn("wager_amount", F.col("event_start_bankroll") * F.col("fraction"))
            .select(*by, *event, *keep, F.col("side").alias("chosen_side"), F.col("p").alias("p_1"), (1.0 - F.col("p")).alias("p_2"),
                    "price_1", "price_2", "edge_1", "edge_2", F.col("fraction").alias("bet_fraction"), "wager_amount", "event_start_bankroll"))
    falls = drawdown(equity.withColumn("_step", F.col("bankroll") - F.col("event_start_bankroll")), event, "_step", by, start=start)
    at = F.struct(*event)
    figures = falls.groupBy(*by).agg(F.sum("n_bets").alias("n_bets"), F.max_by("bankroll", at).alias("final_bankroll"),
                                     F.min("drawdown").alias("max_drawdown"), F.min(date).alias("_a"), F.max(date).alias("_b"))
    growth = F.col("final_bankroll") / start
    days = F.greatest(F.datediff("_b", "_a"), F.lit(1))
    summary = figures.select(*by, "n_bets", "final_bankroll", (growth - 1.0).alias("total_return"),
                             F.when(growth > 0, F.pow(growth, F.lit(365.0) / days) - 1.0).otherwise(-1.0).alias("cagr"), "max_drawdown")
    return bets, equity, summary
