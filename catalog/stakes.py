"""Stakes, event limits, returns and bankrolls."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import PRICED_ORDER, SQL_PRICED, SQL_PRICED_ORDER, priced, query, rounded
from pitfeat.operators import staking as s
from pitfeat.operators.aggregates import best_by
from pitfeat.operators.splits import year_part

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
SQL_KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber"


def sql_bets(edge: float, cap: float, mult: float, p_min: float) -> str:
    return f"""{SQL_PRICED}, e as (select *, p * price_1 - 1 as edge_1, (1 - p) * price_2 - 1 as edge_2,
  least(greatest(case when price_1 <> 1 then (p * price_1 - 1) / (price_1 - 1) else 0 end, 0), 1) * {mult} as k1, least(greatest(case when price_2 <> 1 then ((1 - p) * price_2 - 1) / (price_2 - 1) else 0 end, 0), 1) * {mult} as k2 from priced),
c as (select *, case when edge_1 >= {edge} and edge_1 >= edge_2 then 1 when edge_2 >= {edge} and edge_2 > edge_1 then 2 else 0 end as side from e),
f as (select *, case when side = 0 then 0.0::double when side = 1 then case when p >= {p_min} then least(k1, {cap}) else 0 end else case when 1 - p >= {p_min} then least(k2, {cap}) else 0 end end as fraction,
  case side when 1 then case when y = 1 then price_1 - 1 else -1 end when 2 then case when y = 1 then -1 else price_2 - 1 end else 0 end as unit_profit from c)"""


POLICY = s.Policy(0.02, 0.05, 0.5, 0.55)
BETS = sql_bets(0.02, 0.05, 0.5, 0.55)
FIXED = sql_bets(0.04, 0.02, 0.25, 0.0)


@query("choose_side", f"with {BETS} select {SQL_KEY}, round(edge_1, 6) + 0.0 as edge_1, round(edge_2, 6) + 0.0 as edge_2, side::bigint as side from f")
def choose_side(spark, d):
    return rounded(s.choose_side(priced(spark, d), 0.02).select(*KEY, "edge_1", "edge_2", "side"))


@query("bets", f"with {BETS} select {SQL_KEY}, side::bigint as side, round(fraction, 6) as fraction, round(unit_profit, 6) + 0.0 as unit_profit, round(fraction * unit_profit, 6) + 0.0 as profit from f")
def bets(spark, d):
    return rounded(s.place_bets(priced(spark, d), POLICY).select(*KEY, "side", "fraction", "unit_profit", "profit"))


CAPPED = BETS + f""", n as (select *, case when fraction > 0 and sum((fraction > 0)::int) over (partition by o_orderdate order by {SQL_PRICED_ORDER} rows unbounded preceding) > 3 then 0 else fraction end as kept from f),
x as (select * exclude (fraction), kept * case when sum(kept) over (partition by o_orderdate) > 0.1 then 0.1 / sum(kept) over (partition by o_orderdate) else 1 end as fraction from n)"""


@query("event_caps", f"with {CAPPED} select {SQL_KEY}, round(fraction, 6) as fraction, round(fraction * unit_profit, 6) + 0.0 as profit from x")
def event_caps(spark, d):
    return rounded(s.place_bets(priced(spark, d), POLICY, "o_orderdate", PRICED_ORDER, 3, 0.1).select(*KEY, "fraction", "profit"))


@query("cap_exposure", f"""with {BETS} select {SQL_KEY}, round(fraction * case when sum(fraction) over (partition by o_orderdate) > 0.2
  then 0.2 / sum(fraction) over (partition by o_orderdate) else 1 end, 6) as fraction from f""")
def cap_exposure(spark, d):
    return rounded(s.cap_exposure(s.place_bets(priced(spark, d), POLICY), "o_orderdate").select(*KEY, "fraction"))


ROI = """select o_orderpriority, round(sum(fraction), 6) as total_wager, round(sum(fraction * unit_profit), 6) as total_profit, round(coalesce(sum(fraction * unit_profit) / nullif(sum(fraction), 0), 0), 6) as roi,
  round(coalesce(avg((fraction * unit_profit > 0)::int) filter (where fraction > 0), 0), 6) as hit_rate, round(avg(r) / (stddev_pop(r) + 1e-9), 6) as sharpe_per_bet,
  round(avg(r) filter (where fraction > 0) / (stddev_pop(r) filter (where fraction > 0) + 1e-9), 6) as sharpe_bets_only, count(*) filter (where fraction > 0) as n_bets
from (select *, fraction * unit_profit / greatest(fraction, 1e-9) as r from {rows}) group by 1"""


@query("roi_summary", f"with {BETS} {ROI.format(rows='f')}")
def roi_summary(spark, d):
    return rounded(s.roi_summary(s.place_bets(priced(spark, d), POLICY), ["o_orderpriority"]))


WALK = f"order by o_orderdate, {SQL_PRICED_ORDER} rows unbounded preceding"


@query("drawdown", f"""with {BETS}, w as (select *, sum(fraction * unit_profit) over ({WALK}) as cum from f), m as (select *, max(cum) over ({WALK}) as top from w)
select {SQL_KEY}, round(cum, 6) + 0.0 as cum_profit, round(top, 6) + 0.0 as running_max, round(cum - top, 6) + 0.0 as drawdown from m""")
def drawdown(spark, d):
    out = s.drawdown(s.place_bets(priced(spark, d), POLICY), ["o_orderdate", *PRICED_ORDER])
    return rounded(out.select(*KEY, "cum_profit", "running_max", "drawdown"))


BYWALK = f"partition by o_orderpriority {WALK}"


@query("max_drawdown", f"""with {BETS}, w as (select *, sum(fraction * unit_profit) over ({BYWALK}) as cum from f), m as (select *, max(cum) over ({BYWALK}) as top from w)
select o_orderpriority, round(min(cum - top), 6) + 0.0 as max_drawdown from m group by 1""")
def max_drawdown(spark, d):
    return rounded(s.max_drawdown(s.place_bets(priced(spark, d), POLICY), ["o_orderdate", *PRICED_ORDER], by=["o_orderpriority"]))


EQUITY = FIXED + """, e0 as (select o_orderdate, o_orderpriority, sum(case when fraction > 0 then fraction * unit_profit else 0 end) as r, count(*) filter (where fraction > 0) as n_bets from f where {when} group by 1, 2),
e1 as (select *, 1000 * product(1 + r) over (order by o_orderdate, o_orderpriority rows unbounded preceding) as bankroll,
  1000 * coalesce(product(1 + r) over (order by o_orderdate, o_orderpriority rows between unbounded preceding and 1 preceding), 1) as before from e0)"""
# a gain of one event is of the order of a percent, so over all years the bankroll grows without bound: compare its logarithm
GROWN = "round(ln({c}), 6) + 0.0"


@query("compound_bankroll", f"with {EQUITY.format(when='true')} select o_orderdate, o_orderpriority, round(r, 6) + 0.0 as event_return, n_bets, {GROWN.format(c='before')} as log_start, {GROWN.format(c='bankroll')} as log_end from e1")
def compound_bankroll(spark, d):
    out = s.compound(s.place_bets(priced(spark, d), s.FIXED_POLICY), ["o_orderdate", "o_orderpriority"])
    return rounded(out.select("o_orderdate", "o_orderpriority", "event_return", "n_bets", F.ln("event_start_bankroll").alias("log_start"), F.ln("bankroll").alias("log_end")))


IN_1999 = "o_orderdate >= timestamp '1999-01-01' and o_orderdate < timestamp '2000-01-01'"


@query("yearly_summary", f"""with {EQUITY.format(when=IN_1999)}, t as (select *, max(bankroll) over (order by o_orderdate, o_orderpriority rows unbounded preceding) as top from e1),
z as (select sum(n_bets)::bigint as n_bets, max_by(bankroll, (o_orderdate, o_orderpriority)) as fin, min(bankroll - top) as dd, greatest(date_diff('day', min(o_orderdate), max(o_orderdate)), 1) as days from t)
select n_bets, {GROWN.format(c='fin')} as log_final, round(pow(fin / 1000, 365.0 / days) / (fin / 1000), 6) as cagr_ratio, round(dd / fin, 6) + 0.0 as fall from z""")
def yearly_summary(spark, d):
    rows = year_part(priced(spark, d), "o_orderdate", 1999)
    _, _, out = s.yearly_compounding(rows, "o_orderdate", "o_orderpriority", ["l_orderkey"])
    return rounded(out.select("n_bets", F.ln("final_bankroll").alias("log_final"), ((F.col("cagr") + 1) / (F.col("final_bankroll") / 1000)).alias("cagr_ratio"), (F.col("max_drawdown") / F.col("final_bankroll")).alias("fall")))


@query("yearly_bets", f"""with {EQUITY.format(when=IN_1999)} select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber, side::bigint as chosen_side, round(p, 6) as p_1, round(fraction, 6) as bet_fraction,
  round(ln(before * fraction), 6) as log_wager from f join e1 using (o_orderdate, o_orderpriority) where fraction > 0""")
def yearly_bets(spark, d):
    rows = year_part(priced(spark, d), "o_orderdate", 1999)
    out, _, _ = s.yearly_compounding(rows, "o_orderdate", "o_orderpriority", KEY)
    return rounded(out.select(*KEY, "chosen_side", "p_1", "bet_fraction", F.ln("wager_amount").alias("log_wager")))


@query("holdout_export", f"""with {FIXED} select {SQL_KEY}, side::bigint as chosen_side, round(p, 6) as p_1, round(1 - p, 6) as p_2, round(price_1, 6) as price_1, round(price_2, 6) as price_2,
  round(edge_1, 6) + 0.0 as edge_1, round(edge_2, 6) + 0.0 as edge_2, round(fraction, 6) as bet_fraction, round(unit_profit, 6) + 0.0 as unit_profit from f where fraction > 0 and o_orderdate >= timestamp '2000-01-01'""")
def holdout_export(spark, d):
    return rounded(s.export_bets(priced(spark, d).where(F.col("o_orderdate") >= F.lit(dt.datetime(2000, 1, 1))), KEY))


@query("side_suggestion", f"with {sql_bets(0.02, 0.05, 1.0, 0.0)} select {SQL_KEY}, round(case when edge_1 >= 0.02 then least(k1, 0.05) else 0 end, 6) as kelly_1, round(case when edge_2 >= 0.02 then least(k2, 0.05) else 0 end, 6) as kelly_2 from e")
def side_suggestion(spark, d):
    return rounded(s.side_suggestion(priced(spark, d)).select(*KEY, "kelly_1", "kelly_2"))


# The whole grid written as a cross join, with the exposure of each (policy, event) capped at 0.2.
GRID = f"""{SQL_PRICED}, g as (select row_number() over (order by a.i, b.i, c.i, d.i) - 1 as policy, a.v as min_edge, b.v as cap, c.v as multiplier, d.v as p_min from
  (values (0, 0.0::double), (1, 0.02), (2, 0.04), (3, 0.06)) a(i, v), (values (0, 0.02::double), (1, 0.05), (2, 0.1)) b(i, v), (values (0, 0.25::double), (1, 0.5), (2, 1.0)) c(i, v), (values (0, 0.0::double), (1, 0.55), (2, 0.6)) d(i, v)),
e as (select o_orderdate, p, y, price_1, price_2, p * price_1 - 1 as e1, (1 - p) * price_2 - 1 as e2,
  least(greatest(case when price_1 <> 1 then (p * price_1 - 1) / (price_1 - 1) else 0 end, 0), 1) as k1, least(greatest(case when price_2 <> 1 then ((1 - p) * price_2 - 1) / (price_2 - 1) else 0 end, 0), 1) as k2 from priced),
c as (select *, case when e1 >= min_edge and e1 >= e2 then 1 when e2 >= min_edge and e2 > e1 then 2 else 0 end as side from e cross join g),
f as (select *, case when side = 1 and p >= p_min then least(k1 * multiplier, cap) when side = 2 and 1 - p >= p_min then least(k2 * multiplier, cap) else 0 end as f0,
  case side when 1 then case when y = 1 then price_1 - 1 else -1 end when 2 then case when y = 1 then -1 else price_2 - 1 end else 0 end as u from c),
h as (select *, f0 * case when sum(f0) over (partition by policy, o_orderdate) > 0.2 then 0.2 / sum(f0) over (partition by policy, o_orderdate) else 1 end as fr from f),
scored as (select policy, min_edge, cap, multiplier, p_min, sum(fr) as w, sum(fr * u) as gain, count(*) filter (where fr > 0) as n_bets, avg(case when fr > 0 then u else 0 end) as m, stddev_pop(case when fr > 0 then u else 0 end) as sd from h group by all)"""
GRID_COLS = "policy, min_edge, cap, multiplier, p_min, round(w, 5) as total_wager, round(gain, 5) + 0.0 as total_profit, n_bets, round(case when w > 0 then gain / w else -1e9 end, 6) as roi, round(case when w > 0 then m / (sd + 1e-9) else -1e9 end, 6) as sharpe"


# Only the first three bets of a policy on a day count.
GRID_LIMITED = GRID.replace("h as (select *, f0 *", """k as (select * exclude (f0), case when f0 > 0 and count(*) filter (where f0 > 0) over (partition by policy, o_orderdate order by {order} rows unbounded preceding) > 3 then 0 else f0 end as f0 from f),
h as (select *, f0 *""".format(order=SQL_PRICED_ORDER)).replace("from f),\nscored", "from k),\nscored").replace("e as (select o_orderdate, p,", f"e as (select o_orderdate, {SQL_PRICED_ORDER}, p,")


@query("policy_grid_limited", f"with {GRID_LIMITED} select {GRID_COLS} from scored")
def policy_grid_limited(spark, d):
    out = s.policy_scores(priced(spark, d), event="o_orderdate", max_exposure=0.2, max_bets=3, order=PRICED_ORDER)
    return rounded(out.withColumns({"total_wager": F.round("total_wager", 5), "total_profit": F.round("total_profit", 5)}))


def _grid(spark, d):
    out = s.policy_scores(priced(spark, d), event="o_orderdate", max_exposure=0.2)
    return rounded(out.withColumns({"total_wager": F.round("total_wager", 5), "total_profit": F.round("total_profit", 5)}))


@query("policy_grid", f"with {GRID} select {GRID_COLS} from scored")
def policy_grid(spark, d):
    return _grid(spark, d)


@query("best_policy", f"with {GRID} select {GRID_COLS} from scored order by gain / w desc, policy limit 1")
def best_policy(spark, d):
    return best_by(_grid(spark, d), "roi", tie=["policy"])
