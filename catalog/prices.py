"""Pairs, deltas and prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import LINE, NUDGE, SQL_LINES, SQL_SIDES, lines, query, rounded, sides, table
from pitfeat.functions.numbers import kelly, safe_ratio, softmax
from pitfeat.operators.clean import prefix
from pitfeat.operators.pairing import matchup, pair_sides, rank_features
from pitfeat.operators.pricing import consensus_prices, implied_prices, price_features, quote_keys

SQL_PAIRS = SQL_SIDES + """, pairs as (select l_orderkey, max(l_partkey) filter (where side = 0) as f1_l_partkey, max(l_partkey) filter (where side = 1) as f2_l_partkey,
  max(l_quantity) filter (where side = 0) as f1_l_quantity, max(l_quantity) filter (where side = 1) as f2_l_quantity,
  max(l_extendedprice) filter (where side = 0) as f1_l_extendedprice, max(l_extendedprice) filter (where side = 1) as f2_l_extendedprice
  from sides group by l_orderkey having max(side) = 1)"""


def _pairs(spark, d):
    return pair_sides(lines(spark, d), ["l_orderkey"], LINE, ["l_partkey", "l_quantity", "l_extendedprice"])


@query("assign_side", f"with {SQL_SIDES} select l_orderkey, l_partkey, l_suppkey, cast(side as bigint) as side, l_extendedprice from sides")
def assign_side_query(spark, d):
    return rounded(sides(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "side", "l_extendedprice"))


@query("pair_sides", f"with {SQL_PAIRS} select * from pairs")
def pair_sides_query(spark, d):
    return _pairs(spark, d)


@query("side_prefix", f"with {SQL_LINES} select l_orderkey as f1_l_orderkey, l_partkey as f1_l_partkey from lines")
def side_prefix(spark, d):
    return prefix(lines(spark, d).select("l_orderkey", "l_partkey"), "f1_")


@query("matchup_delta", f"""with {SQL_PAIRS} select l_orderkey, round(f1_l_quantity - f2_l_quantity, 6) as delta_l_quantity,
  round(f1_l_extendedprice - f2_l_extendedprice, 6) + 0.0 as delta_l_extendedprice, round((f1_l_quantity + f2_l_quantity) / 2, 6) as mean_l_quantity from pairs""")
def matchup_delta(spark, d):
    out = matchup(_pairs(spark, d), ["l_quantity", "l_extendedprice"], ["l_quantity"])
    return rounded(out.select("l_orderkey", "delta_l_quantity", "delta_l_extendedprice", "mean_l_quantity"))


@query("rank_delta", f"""with {SQL_SIDES}, r as (select l_orderkey, max(case when l_quantity <= 20 then l_quantity end) filter (where side = 0) as a,
  max(case when l_quantity <= 20 then l_quantity end) filter (where side = 1) as b from sides group by 1 having max(side) = 1)
select l_orderkey, coalesce(a, 999) - coalesce(b, 999) as delta_rank, (coalesce(a, 999) + coalesce(b, 999)) / 2 as mean_rank,
  cast((a is not null)::int + (b is not null)::int as bigint) as rank_presence from r""")
def rank_delta(spark, d):
    ranked = lines(spark, d).withColumn("rank", F.expr("case when l_quantity <= 20 then l_quantity end"))
    out = rank_features(pair_sides(ranked, ["l_orderkey"], LINE, ["rank"]))
    return rounded(out.select("l_orderkey", "delta_rank", "mean_rank", "rank_presence"))


# A price per side, always above 1.01.
PRICE = "1.01 + (50 - l_quantity) / 10 + l_tax"
SQL_PRICES = SQL_SIDES + f""", prices as (select l_orderkey, max({PRICE}) filter (where side = 0) as p1, max({PRICE}) filter (where side = 1) as p2
  from sides group by 1 having max(side) = 1)"""


def side_prices(spark, d):
    rows = lines(spark, d).withColumn("p", F.expr(PRICE))
    return pair_sides(rows, ["l_orderkey"], LINE, ["p"], ("odds_1_", "odds_2_")).withColumnsRenamed({"odds_1_p": "p1", "odds_2_p": "p2"})


@query("price_implied", f"""with {SQL_PRICES} select l_orderkey, round(1 / p1, 6) as imp_1, round(1 / p2, 6) as imp_2,
  round((1 / p1) / (1 / p1 + 1 / p2), 6) as fair_1, round((1 / p2) / (1 / p1 + 1 / p2), 6) as fair_2 from prices""")
def price_implied(spark, d):
    return rounded(implied_prices(side_prices(spark, d), "p1", "p2").drop("p1", "p2"))


@query("price_features", f"""with {SQL_PRICES}, i as (select *, 1 / p1 as i1, 1 / p2 as i2 from prices), f as (select *, i1 / (i1 + i2) as f1, i2 / (i1 + i2) as f2 from i)
select l_orderkey, round(f1 - f2, 6) + 0.0 as delta_fair, round(i1 - i2, 6) + 0.0 as delta_imp, round((i1 + i2) / 2, 6) as mean_imp, round((f1 + f2) / 2, 6) as mean_fair,
  round(ln(f1) - ln(f2), 6) + 0.0 as log_ratio_fair, round(p1 - p2, 6) + 0.0 as delta_price, round(i1 + i2 - 1, 6) + 0.0 as margin from f""")
def price_features_query(spark, d):
    out = price_features(implied_prices(side_prices(spark, d), "p1", "p2"), "p1", "p2")
    return rounded(out.select("l_orderkey", "delta_fair", "delta_imp", "mean_imp", "mean_fair", "log_ratio_fair", "delta_price", "margin"))


def quotes(spark, d):
    """Suppliers as books quoting an order; odd suppliers list the names the other way round."""
    return lines(spark, d).select(
        F.col("l_orderkey").alias("match"), F.concat(F.lit("book "), F.col("l_suppkey") % 7).alias("book"), F.col("l_shipdate").alias("updated"),
        F.when(F.col("l_suppkey") % 2 == 0, "alpha").otherwise("beta").alias("n1"), F.when(F.col("l_suppkey") % 2 == 0, "beta").otherwise("alpha").alias("n2"),
        F.when(F.col("l_quantity") < 49, F.expr(PRICE)).alias("o1"), (1.5 + F.col("l_discount")).alias("o2"))


@query("price_consensus", f"""with {SQL_LINES}, q as (select l_orderkey as match, 'book ' || (l_suppkey % 7) as book, l_shipdate as updated,
  case when l_suppkey % 2 = 0 then {PRICE} else 1.5 + l_discount end as a, case when l_suppkey % 2 = 0 then 1.5 + l_discount else {PRICE} end as b
  from lines where l_quantity < 49),
m as (select match, avg(a) as a, avg(b) as b, min(a) as alo, min(b) as blo, max(a) as ahi, max(b) as bhi, count(distinct book) as num_books,
  string_agg(distinct book, ',' order by book) as books, max(updated) as last_update from q group by match)
select match, 'alpha' as side_1, 'beta' as side_2, round(a + {NUDGE}, 6) + 0.0 as price_1, round(b + {NUDGE}, 6) + 0.0 as price_2, round(alo + {NUDGE}, 6) + 0.0 as price_1_min, round(blo + {NUDGE}, 6) + 0.0 as price_2_min,
  round(ahi + {NUDGE}, 6) + 0.0 as price_1_max, round(bhi + {NUDGE}, 6) + 0.0 as price_2_max, round(1 / a + {NUDGE}, 6) + 0.0 as implied_1, round(1 / b + {NUDGE}, 6) + 0.0 as implied_2,
  round((1 / a) / (1 / a + 1 / b) + {NUDGE}, 6) + 0.0 as fair_1, round((1 / b) / (1 / a + 1 / b) + {NUDGE}, 6) + 0.0 as fair_2, round((1 / a + 1 / b - 1) * 100 + {NUDGE}, 6) + 0.0 as margin_percent,
  num_books, books, last_update from m""")
def price_consensus(spark, d):
    return rounded(consensus_prices(quotes(spark, d), ["match"], "book", "updated", "n1", "n2", "o1", "o2"), NUDGE)


@query("quote_keys", """select o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%MZ') || '-' || least(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '-', 'g'))
  || '-vs-' || greatest(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '-', 'g')) as match_id
from orders join customer on o_custkey = c_custkey""")
def quote_keys_query(spark, d):
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("event"), "o_orderdate", "c_name", "c_mktsegment")
    return quote_keys(rows, "event", "o_orderdate", "c_name", "c_mktsegment").select("o_orderkey", "match_id")


@query("safe_ratio", f"with {SQL_LINES} select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, round(case when l_discount = 0 then 0 else l_extendedprice / l_discount end, 6) as ratio from lines")
def safe_ratio_query(spark, d):
    return rounded(lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", safe_ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio")))


@query("kelly", f"""with {SQL_LINES} select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber,
  round(least(greatest((((l_quantity - 0.5) / 50) * ({PRICE}) - 1) / ({PRICE} - 1), 0), 1), 6) as stake from lines""")
def kelly_query(spark, d):
    rows = lines(spark, d).withColumn("o", F.expr(PRICE)).withColumn("p", (F.col("l_quantity") - 0.5) / 50)
    return rounded(rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", kelly(F.col("p"), F.col("o")).alias("stake")))


@query("softmax_temp", f"""with {SQL_LINES}, e as (select *, exp((l_quantity / 10 - greatest(l_quantity / 10, l_discount * 20, l_tax * 20)) / 1.5) as a,
  exp((l_discount * 20 - greatest(l_quantity / 10, l_discount * 20, l_tax * 20)) / 1.5) as b, exp((l_tax * 20 - greatest(l_quantity / 10, l_discount * 20, l_tax * 20)) / 1.5) as c from lines)
select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber, round(a / (a + b + c), 6) as p0, round(b / (a + b + c), 6) as p1, round(c / (a + b + c), 6) as p2 from e""")
def softmax_temp(spark, d):
    rows = lines(spark, d).withColumn("p", softmax(F.array(F.col("l_quantity") / 10, F.col("l_discount") * 20, F.col("l_tax") * 20), 1.5))
    return rounded(rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *[F.col("p")[i].alias(f"p{i}") for i in range(3)]))


@query("argmax_class", f"""with {SQL_LINES} select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber,
  case when l_quantity / 50 >= greatest(l_discount * 10, l_tax * 12) then 'quantity' when l_discount * 10 >= l_tax * 12 then 'discount' else 'tax' end as top from lines""")
def argmax_class_query(spark, d):
    from pitfeat.functions.numbers import argmax_class

    vector = F.array(F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 12)
    return rounded(lines(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", argmax_class(vector, ["quantity", "discount", "tax"]).alias("top")))
