"""Feature lists, imputation, missing flags, row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import SQL_LINES, lines, query, r6, rounded, table
from pitfeat.operators.clean import align, between_dates, binary_only, column_set, drop_features, fill_numeric, safe_features, sample_n, sort_by, to_float
from pitfeat.operators.features import GroupImputer, fit_medians, missing_flags

# Line columns under names of which some are only known after the match, some targets, some descriptive.
NAMES = {"l_quantity": "f_1_sig_strikes_succ", "l_extendedprice": "f_1_fighter_weight", "l_discount": "f_1_odds", "l_tax": "r1_duration_x", "l_linenumber": "finish_round",
         "l_suppkey": "f_2_sig_strikes_succ_m3", "l_returnflag": "referee"}


def _named(spark, d):
    return lines(spark, d).withColumnsRenamed(NAMES)


@query("safe_features", f"with {SQL_LINES} select l_extendedprice as f_1_fighter_weight, l_discount as f_1_odds, l_suppkey as f_2_sig_strikes_succ_m3, l_orderkey, l_partkey from lines")
def safe_features_query(spark, d):
    rows = _named(spark, d)
    return rows.select(*safe_features(rows))


@query("safe_features_no_price", f"with {SQL_LINES} select l_extendedprice as f_1_fighter_weight, l_suppkey as f_2_sig_strikes_succ_m3, l_orderkey, l_partkey from lines")
def safe_features_no_price(spark, d):
    rows = _named(spark, d)
    return rows.select(*safe_features(rows, drop_price=True))


@query("align_features", f"with {SQL_LINES} select l_orderkey, l_tax, null::double as unseen, l_quantity from lines")
def align_features(spark, d):
    return align(lines(spark, d), ["l_tax", "unseen", "l_quantity"], ["l_orderkey"])


@query("drop_features", "select l_orderkey, l_partkey, l_shipdate from lineitem")
def drop_features_query(spark, d):
    rows = table(spark, d, "lineitem")
    gone = column_set(rows, exclude=["l_orderkey", "l_partkey", "l_shipdate"])
    return drop_features(rows, [*gone, "unknown"])


@query("to_float", "select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber, l_extendedprice::float::double as l_extendedprice from lineitem")
def to_float_query(spark, d):
    rows = to_float(table(spark, d, "lineitem"), ["l_extendedprice"]).withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_extendedprice")


@query("fill_numeric", "select o_orderkey, coalesce(case when o_orderstatus = 'F' then o_totalprice end, 0) as price, case when o_orderstatus = 'F' then o_orderpriority end as priority from orders")
def fill_numeric_query(spark, d):
    done = F.col("o_orderstatus") == "F"
    return fill_numeric(table(spark, d, "orders").select("o_orderkey", F.when(done, F.col("o_totalprice")).alias("price"), F.when(done, F.col("o_orderpriority")).alias("priority")))


LABEL = "case o_orderstatus when 'F' then 1 when 'O' then 0 else case when o_totalprice > 200000 then -1 end end"


@query("binary_only", f"select o_orderkey, y::bigint as y from (select o_orderkey, {LABEL} as y from orders) where y in (0, 1)")
def binary_only_query(spark, d):
    return rounded(binary_only(table(spark, d, "orders").select("o_orderkey", F.expr(LABEL).alias("y")), "y"))


@query("drop_draws", f"select o_orderkey, y::bigint as y from (select o_orderkey, {LABEL} as y from orders) where y <> -1")
def drop_draws(spark, d):
    return rounded(binary_only(table(spark, d, "orders").select("o_orderkey", F.expr(LABEL).alias("y")), "y", drop_draws_only=True))


@query("between_dates", "select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1999-01-01'")
def between_dates_query(spark, d):
    return between_dates(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", dt.datetime(1997, 1, 1), dt.datetime(1999, 1, 1))


@query("sample_n", "select * from orders order by md5('42|' || o_orderkey), o_orderkey limit 500")
def sample_n_query(spark, d):
    return sample_n(table(spark, d, "orders"), 500, 42, "o_orderkey")


@query("sort_by", "select o_orderkey, o_custkey, o_orderdate from orders order by o_custkey, o_orderdate, o_orderkey")
def sort_by_query(spark, d):
    return sort_by(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey")


# Seeded gaps: a physical, a price, a rolling and an unassigned feature.
GAPS = {"fighter_weight": "case when o_orderpriority <> '5-LOW' then o_totalprice end", "odds": "case when o_orderstatus <> 'P' then o_totalprice / 7 end",
        "won_3_back": "case when o_orderstatus = 'F' then o_totalprice end", "other": "case when o_totalprice > 50000 then o_totalprice end"}


def gapped(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate", *[F.expr(e).alias(n) for n, e in GAPS.items()])


SQL_GAPS = "g as (select o_orderkey, o_orderdate, " + ", ".join(f"{e} as {n}" for n, e in GAPS.items()) + " from orders)"


@query("medians", f"with {SQL_GAPS} select " + ", ".join(f"round(median({n}), 6) as {n}" for n in GAPS) + " from g")
def medians(spark, d):
    found = fit_medians(gapped(spark, d), list(GAPS))
    return spark.range(1).select(*[r6(F.lit(found[n])).alias(n) for n in GAPS])


@query("impute_median", f"""with {SQL_GAPS}, m as (select median(fighter_weight) as a, median(odds) as b from g where o_orderdate < timestamp '1999-01-01')
select o_orderkey, round(coalesce(fighter_weight, a), 6) as fighter_weight, round(coalesce(odds, b), 6) as odds, coalesce(won_3_back, 0) as won_3_back, coalesce(other, 0) as other,
  (fighter_weight is null)::bigint as fighter_weight_missing, (odds is null)::bigint as odds_missing, (won_3_back is null)::bigint as won_3_back_missing, (other is null)::bigint as other_missing from g, m""")
def impute_median(spark, d):
    rows = gapped(spark, d)
    model = GroupImputer(inputCols=list(GAPS)).fit(rows.where(F.col("o_orderdate") < F.lit(dt.datetime(1999, 1, 1))))
    return rounded(model.transform(rows).drop("o_orderdate"))


@query("missing_flags", f"with {SQL_GAPS} select o_orderkey, (odds is null)::bigint as odds_missing, (other is null)::bigint as other_missing from g")
def missing_flags_query(spark, d):
    return rounded(missing_flags(gapped(spark, d), ["odds", "other"]).select("o_orderkey", "odds_missing", "other_missing"))
