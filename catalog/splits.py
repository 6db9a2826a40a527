"""Temporal splits and folds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import query, rounded, table
from pitfeat.operators.joins import assign_folds
from pitfeat.operators.splits import calibration_tail, fold_calendar, fold_sizes, last_folds, temporal_split, ts_cv, walk_forward, year_window

CALENDAR = fold_calendar(dt.date(1997, 1, 1), dt.date(2001, 1, 1), 90, 30)
SQL_CALENDAR = """cal as (select row_number() over (order by s) as fold, s::date as start, (s + interval 90 day)::date as "end" from range(timestamp '1997-01-01', timestamp '2001-01-01', interval 30 day) r(s))"""
ORDER = ["o_orderdate", "o_orderkey"]
SQL_INDEX = "i as (select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as idx, count(*) over () as n from orders)"


@query("temporal_split", "select o_orderkey, case when o_orderdate < timestamp '1998-01-01' then 'train' when o_orderdate < timestamp '2000-01-01' then 'val' else 'test' end as split from orders")
def temporal_split_query(spark, d):
    return temporal_split(table(spark, d, "orders"), "o_orderdate", dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1)).select("o_orderkey", "split")


SIZES = """select fold, start, "end", count(*) filter (where o_orderdate < start) as n_train, count(*) filter (where o_orderdate >= start and o_orderdate < "end") as n_test from cal cross join orders group by all"""


@query("walk_forward_counts", f"with {SQL_CALENDAR}, f as ({SIZES}) select * from f where n_train >= 1000 and n_test > 0")
def walk_forward_counts(spark, d):
    return rounded(walk_forward(table(spark, d, "orders"), "o_orderdate", CALENDAR))


@query("fold_sizes", f"with {SQL_CALENDAR} {SIZES}")
def fold_sizes_query(spark, d):
    return rounded(fold_sizes(table(spark, d, "orders"), "o_orderdate", CALENDAR))


@query("last_folds", f"with {SQL_CALENDAR} select o_orderkey, fold, 'test' as role from orders join (select * from cal order by start desc limit 12) on o_orderdate >= start and o_orderdate < \"end\"")
def last_folds_query(spark, d):
    return rounded(assign_folds(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", last_folds(CALENDAR, 12)).drop("o_orderdate"))


@query("ts_cv", f"with {SQL_INDEX}, s as (select *, n // 6 as size, n - 5 * (n // 6) as first from i) select o_orderkey, case when idx < first then 0 else (idx - first) // size + 1 end as fold from s")
def ts_cv_query(spark, d):
    return rounded(ts_cv(table(spark, d, "orders"), ORDER, 5).select("o_orderkey", "fold"))


@query("ts_cv_counts", f"with {SQL_INDEX}, s as (select *, n // 6 as size, n - 5 * (n // 6) as first from i) select case when idx < first then 0 else (idx - first) // size + 1 end as fold, count(*) as n from s group by 1")
def ts_cv_counts(spark, d):
    return rounded(ts_cv(table(spark, d, "orders"), ORDER, 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n")))


@query("calibration_tail", f"with {SQL_INDEX} select o_orderkey, idx >= floor(n * 0.9::double) as is_tail from i")
def calibration_tail_query(spark, d):
    return calibration_tail(table(spark, d, "orders"), ORDER).select("o_orderkey", "is_tail")


@query("year_window", "select o_orderkey, case when o_orderdate < timestamp '1997-01-01' then 'train' when o_orderdate < timestamp '1999-01-01' then 'val' else 'test' end as split from orders where o_orderdate < timestamp '2000-01-01'")
def year_window_query(spark, d):
    return year_window(table(spark, d, "orders"), "o_orderdate", 1999).select("o_orderkey", "split")
