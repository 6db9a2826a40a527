"""Data checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import SQL_PRICED, lines, priced, query, r6, rounded, table
from pitfeat.functions.numbers import softmax
from pitfeat.operators import quality as q
from pitfeat.operators.metrics import metrics_table
from pitfeat.operators.splits import temporal_split

SUITE = q.Suite("orders", "raw", [
    q.columns_match("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    q.columns_match("o_orderkey", "extra"),
    q.has_column("o_custkey"), q.has_column("gone"),
    q.not_null("o_orderkey"), q.not_null("gone"),
    q.matches("o_orderpriority", "^[1-3]"),
    q.between("o_totalprice", 1000, 400000), q.between("o_orderpriority", 0),
    q.date_parseable("o_orderdate"), q.date_parseable("o_orderstatus"),
    q.unique("o_orderkey"), q.unique("o_custkey"),
    q.Check("no_such_check", "o_orderkey"),
])


@query("dq_suite", """with t as (select * from orders)
select v.pos::bigint as position, v.chk as "check", (select count(*) from t) as rows, v.violations::bigint as violations, v.violations = 0 as success from (
  select 0 as pos, 'columns_match' as chk, 0 as violations union all select 1, 'columns_match', 6 union all select 2, 'has_column', 0 union all select 3, 'has_column', 1
  union all select 4, 'not_null', (select count(*) from t where o_orderkey is null) union all select 5, 'not_null', 1
  union all select 6, 'matches', (select count(*) from t where not regexp_matches(o_orderpriority, '^[1-3]'))
  union all select 7, 'between', (select count(*) from t where o_totalprice < 1000 or o_totalprice > 400000) union all select 8, 'between', 0
  union all select 9, 'date_parseable', 0 union all select 10, 'date_parseable', (select count(o_orderstatus) from t)
  union all select 11, 'unique', (select count(o_orderkey) - count(distinct o_orderkey) from t) union all select 12, 'unique', (select count(o_custkey) - count(distinct o_custkey) from t)
  union all select 13, 'no_such_check', 1) v""")
def dq_suite(spark, d):
    return rounded(q.run_suite(table(spark, d, "orders"), SUITE).select("position", "check", "rows", "violations", "success"))


@query("dq_summary", """select 'orders' as suite, (select count(*) from orders) as rows, 14::bigint as checks,
  (5 + (exists (select 1 from orders where not regexp_matches(o_orderpriority, '^[1-3]')))::int + (exists (select 1 from orders where o_totalprice < 1000 or o_totalprice > 400000))::int
   + (exists (select 1 from orders group by o_custkey having count(*) > 1))::int)::bigint as failed""")
def dq_summary(spark, d):
    return q.summarise(q.run_suites({"orders": table(spark, d, "orders"), "absent": None}, [SUITE, q.Suite("absent", "raw", [])]))


ROLES = {"event_date": "o_orderdate", "winner": "w", "winner_encoded": "y", "age": "age", "height": "height", "price_1": "price_1", "price_2": "price_2", "key": "o_custkey"}
SANITY = """select *, case when o_orderstatus <> 'P' then o_orderpriority end as w, case o_orderstatus when 'F' then 1 when 'O' then 0 end as y,
  o_custkey % 60 as age, 120 + o_orderkey % 130 as height, 1.01 + (o_custkey % 9) / 4.0 as price_1, case when o_totalprice > 5000 then 1.01 + (o_orderkey % 7) / 4.0 end as price_2 from orders"""


@query("dq_sanity", f"""with t as ({SANITY}), f as (select
  count(*) filter (where o_orderdate > timestamp '2000-01-01') as a, count(*) filter (where w is null) as b, count(*) filter (where y is null) as c, count(*) filter (where age < 18) as d,
  count(*) filter (where height < 140) as e, count(*) filter (where height > 230) as g,
  avg(case when (1 / price_1 > 1 / price_2 and y = 1) or (not (1 / price_1 > 1 / price_2) and y = 0) then 1.0 else 0 end) filter (where price_2 is not null and y is not null) as r,
  count(*) - count(distinct o_custkey) as k from t)
select 'future_dates' as "check", 'warning' as severity, a::double as figure, a > 0 as triggered from f union all select 'missing_winner', 'error', b, b > 0 from f
union all select 'missing_winner_encoded', 'error', c, c > 0 from f union all select 'under_age', 'error', d, d > 0 from f union all select 'height_low', 'warning', e, e > 0 from f
union all select 'height_high', 'warning', g, g > 0 from f union all select 'favourite_wins_too_often', 'error', round(r, 6), r > 0.95 from f
union all select 'favourite_wins_too_rarely', 'warning', round(r, 6), r < 0.5 from f union all select 'duplicate_keys', 'warning', k, k > 0 from f""")
def dq_sanity(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("_sanity_orders")
    rows = spark.sql(SANITY.replace("from orders", "from _sanity_orders").replace("4.0", "4.0D").replace("1.01", "1.01D"))
    return rounded(q.sanity_report(rows, dt.datetime(2000, 1, 1), ROLES))


@query("dq_layers", """select 'events_raw' as suite, 0::bigint as position, 'table_exists' as "check", 0::bigint as rows, 1::bigint as violations union all
select 'fights_raw', p, 'has_column', (select count(*) from pages), 0 from (values (0), (1)) v(p) union all select 'fights_raw', 2, 'matches', (select count(*) from pages), (select count(*) from pages where not starts_with(url, 'https')) union all
select 'fight_stats_raw', 0, 'has_column', (select count(*) from lineitem), 0 union all select 'fight_stats_raw', 1, 'has_column', (select count(*) from lineitem), 1 union all
select 'fights_silver', 0, 'table_exists', 0, 1""")
def dq_layers(spark, d):
    pages, items = table(spark, d, "pages"), table(spark, d, "lineitem")
    tables = {
        "fights_raw": pages.select(F.when(F.col("url").startswith("https"), F.col("url")).otherwise("ftp").alias("fight_url"), F.col("url").alias("event_url")),
        "fight_stats_raw": items.select(F.col("l_orderkey").alias("fight_url")),
    }
    return rounded(q.layer_contracts(tables, spark).select("suite", "position", "check", "rows", "violations"))


@query("dq_split_leak", """with s as (select *, case when o_orderdate < timestamp '1998-01-01' then 'train' when o_orderdate < timestamp '2000-01-01' then 'val' else 'test' end as split from orders)
select 'train' as "before", 'val' as "after", max(o_orderdate) filter (where split = 'train') as before_max, min(o_orderdate) filter (where split = 'val') as after_min, false as leak from s
union all select 'val', 'test', max(o_orderdate) filter (where split = 'val'), min(o_orderdate) filter (where split = 'test'), false from s""")
def dq_split_leak(spark, d):
    return q.split_leak(temporal_split(table(spark, d, "orders"), "o_orderdate", dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1)), "o_orderdate")


@query("dq_prob_sum", "select count(*) as rows, count(*) filter (where l_quantity > 40) as violations, count(*) filter (where l_quantity > 40) = 0 as success from lineitem")
def dq_prob_sum(spark, d):
    vector = softmax(F.array("l_quantity", "l_tax", "l_discount"), 10.0)
    rows = lines(spark, d).select(F.when(F.col("l_quantity") > 40, F.concat(vector, F.array(F.lit(0.001)))).otherwise(vector).alias("probs"))
    return q.prob_sum(rows, "probs")


@query("dq_metric_gate", f"""with {SQL_PRICED}, m as (select l_linestatus as split, avg(((p >= 0.5) = (y = 1))::int) as value from priced group by 1)
select 'q' as model, w.split, w.floor, round(m.value, 6) as value, coalesce(m.value >= w.floor, false) as passed from (values ('O', 0.4::double), ('F', 0.99::double), ('X', 0.1::double)) w(split, floor) left join m on m.split = w.split""")
def dq_metric_gate(spark, d):
    scores = priced(spark, d).select(F.lit("q").alias("model"), F.col("l_linestatus").alias("split"), F.lit("no").alias("calibrated"), "p", "y")
    out = q.metric_gate(metrics_table(scores), {("q", "O"): 0.4, ("q", "F"): 0.99, ("q", "X"): 0.1})
    return out.withColumn("value", r6("value"))
