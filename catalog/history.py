"""Point-in-time windows and as-of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, r6, rounded, table
from pitfeat.operators.joins import asof_backward
from pitfeat.operators.ordered import ordinal, time_index
from pitfeat.operators.pit import WINDOWS, pit_features, rolling

ENTITY = dict(by=["o_custkey"], ts="o_orderdate", tie=["o_orderkey"])
BY = "partition by o_custkey order by o_orderdate, o_orderkey"


def _frames(fn: str, short: str) -> str:
    return ", ".join(f"round({fn}(o_totalprice) over ({BY} rows between {w} preceding and 1 preceding), 6) as o_totalprice_{short}{w}" for w in WINDOWS)


@query("pit_rolling_mean", f"select o_orderkey, {_frames('avg', 'm')} from orders")
def pit_rolling_mean(spark, d):
    out = rolling(table(spark, d, "orders"), **ENTITY, means=["o_totalprice"])
    return out.select("o_orderkey", *[r6(f"o_totalprice_m{w}").alias(f"o_totalprice_m{w}") for w in WINDOWS])


@query("pit_rolling_sum", f"select o_orderkey, {_frames('sum', 's')} from orders")
def pit_rolling_sum(spark, d):
    out = rolling(table(spark, d, "orders"), **ENTITY, sums=["o_totalprice"])
    return out.select("o_orderkey", *[r6(f"o_totalprice_s{w}").alias(f"o_totalprice_s{w}") for w in WINDOWS])


@query("pit_recency", f"""
with a as (select o_orderkey, o_custkey, o_orderdate, lag(o_orderdate) over ({BY}) as prev_ts, row_number() over ({BY}) - 1 as ordinal from orders),
b as (select *, coalesce(date_diff('day', prev_ts, o_orderdate), 1825) as days_since from a)
select o_orderkey, prev_ts, cast(days_since as bigint) as days_since, cast(ordinal as bigint) as ordinal,
  round(coalesce(avg(days_since) over ({BY} rows between 3 preceding and 1 preceding), days_since), 6) as avg_gap_3 from b""")
def pit_recency(spark, d):
    out = pit_features(table(spark, d, "orders"), **ENTITY, windows=[])
    return rounded(out.select("o_orderkey", "prev_ts", "days_since", "ordinal", "avg_gap_3"))


@query("pit_count_365d", f"""
with a as (select *, lag(o_orderdate) over ({BY}) as pd, lag(o_orderkey) over ({BY}) as pk from orders)
select a.o_orderkey, count(*) filter (where b.o_orderdate > a.pd - interval 365 day) as count_365d,
  count(*) filter (where b.o_orderdate > a.pd - interval 730 day) as count_730d
from a left join orders b on a.o_custkey = b.o_custkey and (b.o_orderdate < a.pd or (b.o_orderdate = a.pd and b.o_orderkey <= a.pk))
group by a.o_orderkey""")
def pit_count_365d(spark, d):
    out = pit_features(table(spark, d, "orders"), **ENTITY, windows=[])
    return out.select("o_orderkey", "count_365d", "count_730d")


@query("pit_count_current", """
select a.o_orderkey, count(b.o_orderkey) as count_365d
from orders a left join orders b on a.o_custkey = b.o_custkey and (b.o_orderdate < a.o_orderdate or (b.o_orderdate = a.o_orderdate and b.o_orderkey < a.o_orderkey))
  and b.o_orderdate > a.o_orderdate - interval 365 day
group by a.o_orderkey""")
def pit_count_current(spark, d):
    out = pit_features(table(spark, d, "orders"), **ENTITY, windows=[], horizons=[365], anchor="current")
    return out.select("o_orderkey", "count_365d")


@query("pit_event_counts", """
with a as (select *, lag(ts) over (partition by user_id order by ts, event_id) as pt, lag(event_id) over (partition by user_id order by ts, event_id) as pe from events)
select a.event_id, count(b.event_id) as count_7d
from a left join events b on a.user_id = b.user_id and (b.ts < a.pt or (b.ts = a.pt and b.event_id <= a.pe)) and b.ts > a.pt - interval 7 day
group by a.event_id""")
def pit_event_counts(spark, d):
    out = pit_features(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], windows=[], horizons=[7])
    return out.select("event_id", "count_7d")


# Lines of a part by ship date: the tie repeats and a fifth of the parts is unknown; equal rows are numbered, whichever comes first.
BY_TIE = "partition by part order by day, tie"
SQL_TIED = f"""with h as (select case when l_partkey % 5 <> 0 then l_partkey end as part, l_shipdate as day, l_linenumber % 2 as tie from lineitem)
select part, day, tie::bigint as tie, count_90d, count(*) as n from (select *, row_number() over ({BY_TIE}) - 1
  - count(*) over (partition by part order by day range between unbounded preceding and interval 90 day preceding) as count_90d from h) group by all"""


def _tied(spark, d, **more):
    rows = table(spark, d, "lineitem").select(F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey")).alias("part"), F.col("l_shipdate").alias("day"), (F.col("l_linenumber") % 2).alias("tie"))
    out = pit_features(rows, ["part"], "day", ["tie"], windows=[], horizons=[90], anchor="current", **more)
    return rounded(out.groupBy("part", "day", "tie", "count_90d").agg(F.count("*").alias("n")))


@query("pit_count_repeated_tie", SQL_TIED)
def pit_count_repeated_tie(spark, d):
    return _tied(spark, d)


@query("pit_count_null_entity", SQL_TIED)
def pit_count_null_entity(spark, d):
    """The unknown parts share one history, which is cut into blocks here."""
    return _tied(spark, d, hot_rows=1000)


@query("entity_ordinal", "select event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as ordinal from events")
def entity_ordinal(spark, d):
    return ordinal(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("event_id", "ordinal")


@query("time_index", "select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as idx from orders")
def time_index_query(spark, d):
    return time_index(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "idx")


TIMELINE = "select user_id, ts, max(event_id) as event_id, max_by({value}, event_id) as value from events where event_type = 'view' group by user_id, ts"
ASOF = """with probes as (select event_id, user_id, ts from events where event_type = 'purchase'),
views as (%s)
select p.event_id, v.event_id as view_id, round(v.value, 6) as view_value from probes p asof left join views v on p.user_id = v.user_id and p.ts >= v.ts"""


def _asof(spark, d, value):
    events = table(spark, d, "events")
    views = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), value.alias("view_value"))
    probes = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    out = asof_backward(probes, views, ["user_id"], "ts", "view_ts", ["view_id", "view_value"], ["view_id"], ["event_id"])
    return out.select("event_id", "view_id", r6("view_value").alias("view_value"))


@query("asof_backward", ASOF % TIMELINE.format(value="value"))
def asof_backward_query(spark, d):
    return _asof(spark, d, F.col("value"))


NULLED = "case when value < 50 then value end"


@query("asof_null_carry", ASOF % ("select user_id, ts, event_id, " + NULLED + " as value from events where event_type = 'view'"))
def asof_null_carry(spark, d):
    return _asof(spark, d, F.expr(NULLED))


@query("asof_rank", """with lines as (select l_partkey, l_shipdate, max(l_linenumber) as rnk from lineitem group by all),
probes as (select l_orderkey, l_partkey, l_linenumber, l_suppkey, o_orderdate from lineitem join orders on l_orderkey = o_orderkey)
select p.l_orderkey, p.l_partkey, cast(p.l_linenumber as bigint) as l_linenumber, p.l_suppkey, cast(r.rnk as bigint) as last_rank
from probes p asof left join lines r on p.l_partkey = r.l_partkey and p.o_orderdate >= r.l_shipdate""")
def asof_rank(spark, d):
    items = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    probes = items.join(orders, "l_orderkey").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "o_orderdate")
    ranks = items.select("l_partkey", "l_shipdate", F.col("l_linenumber").alias("last_rank"))
    out = asof_backward(probes, ranks, ["l_partkey"], "o_orderdate", "l_shipdate", ["last_rank"], ["last_rank"], ["l_orderkey", "l_linenumber", "l_suppkey"])
    return rounded(out.drop("o_orderdate"))
