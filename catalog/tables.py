"""Keyed updates, choices per key, joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.base import LINE, SQL_LINES, lines, query, rounded, table
from pitfeat.operators.aggregates import best_by, class_weights, coverage_by, dedupe_first, dedupe_last, distinct_rows, first_per_key, summarise_folds
from pitfeat.operators.joins import attach_labels, cross_grid, enrich, enrich_sides, keep_ids, keep_keys, lookup_default, new_keys
from pitfeat.operators.quality import label_coverage
from pitfeat.session import step_dir
from pitfeat.sources.keyed import KeyedTable
from pitfeat.sources.tables import distinct_keys, insert_new, latest, replace_table, upsert_last

# Stored rows: orders that are not open. The new batch: urgent and high orders of any state at a new price, twice per
# order with different positions; cheap orders carry key texts that stand for a missing key.
SQL_BATCHES = """stored as (select case when o_totalprice < 2000 then 'None' else cast(o_orderkey as varchar) end as k, o_totalprice as price, 0 as pos, 0 as batch
  from orders where o_orderstatus <> 'O'),
fresh as (select case when o_totalprice < 3000 then ' nan ' else cast(o_orderkey as varchar) end as k, o_totalprice * (1 + pos) as price, pos, 1 as batch
  from orders cross join (values (1), (2)) v(pos) where o_orderpriority < '3')"""
VALID = "lower(trim(k)) not in ('nan', 'none', '')"


def _batches(spark, d):
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    stored = orders.where("o_orderstatus <> 'O'").select(F.when(F.col("o_totalprice") < 2000, "None").otherwise(key).alias("k"),
                                                         F.col("o_totalprice").alias("price"), F.lit(0).alias("pos"))
    fresh = orders.where("o_orderpriority < '3'").withColumn("pos", F.explode(F.array(F.lit(1), F.lit(2))))
    return stored, fresh.select(F.when(F.col("o_totalprice") < 3000, " nan ").otherwise(key).alias("k"), (F.col("o_totalprice") * (1 + F.col("pos"))).alias("price"), "pos")


@query("upsert_last", f"""with {SQL_BATCHES}, u as (select * from stored union all select * from fresh)
select k, round(price, 6) as price, pos::bigint as pos from (select *, row_number() over (partition by k order by batch desc, pos desc) as rn from u where {VALID}) where rn = 1""")
def upsert_last_query(spark, d):
    stored, fresh = _batches(spark, d)
    return rounded(upsert_last(stored, fresh, ["k"], "pos"))


@query("upsert_unique", f"""with {SQL_BATCHES}, u as (select * from stored union all select * from fresh)
select k, round(price, 6) as price, pos::bigint as pos from (select *, row_number() over (partition by k order by batch desc, pos desc) as rn from u where {VALID}) where rn = 1""")
def upsert_unique(spark, d):
    stored, fresh = _batches(spark, d)
    return rounded(upsert_last(stored, fresh, ["k"], "pos", existing_unique=True))


SQL_TWO_BATCHES = f"""with {SQL_BATCHES}, late as (select k, price + 1 as price, 0 as pos, 2 as batch from fresh where k like '%7'),
u as (select * from stored union all select * from fresh union all select * from late),
last as (select k, price from (select *, row_number() over (partition by k order by batch desc, pos desc, price desc) as rn from u where {VALID}) where rn = 1)"""


@query("upsert_table_buckets", SQL_TWO_BATCHES + " select k, round(price, 6) as price from last")
def upsert_table_buckets(spark, d):
    """Three batches into a stored table of hash buckets, then an insert of keys that are all there."""
    stored, fresh = _batches(spark, d)
    table = KeyedTable(spark, f"{step_dir(spark)}/keyed-{uuid.uuid4().hex}", ["k"], 16)
    table.upsert(stored, "pos", mark=("load", 0))
    table.upsert(fresh, "pos", mark=("load", 1))
    late = fresh.where("k like '%7'").withColumn("price", F.col("price") + 1).withColumn("pos", F.col("price"))
    table.upsert(late, "pos", mark=("load", 2))
    table.upsert(stored, "pos", mark=("load", 0))  # applied before
    table.insert(fresh, "pos")
    return rounded(table.read())


@query("keyed_look_up", f"""with {SQL_BATCHES}, u as (select * from stored union all select * from fresh),
last as (select k, price from (select *, row_number() over (partition by k order by batch desc, pos desc) as rn from u where {VALID}) where rn = 1)
select k, round(price, 6) as price from last where k like '%11'""")
def keyed_look_up(spark, d):
    """Some keys of a stored table, from the buckets that they fall into."""
    stored, fresh = _batches(spark, d)
    table = KeyedTable(spark, f"{step_dir(spark)}/keyed-{uuid.uuid4().hex}", ["k"], 16)
    table.replace(stored, "pos")
    table.upsert(fresh, "pos")
    return rounded(table.look_up(stored.unionByName(fresh).where("k like '%11'")))


@query("insert_new", f"""with {SQL_BATCHES} select k, round(price, 6) as price, pos::bigint as pos from
  (select *, row_number() over (partition by k order by pos desc) as rn from fresh where {VALID} and k not in (select k from stored)) where rn = 1""")
def insert_new_query(spark, d):
    stored, fresh = _batches(spark, d)
    return rounded(insert_new(stored, fresh, ["k"], "pos"))


@query("replace_table", f"""with {SQL_BATCHES} select k, round(price, 6) as price, pos::bigint as pos from
  (select *, row_number() over (partition by k order by pos desc) as rn from fresh where {VALID}) where rn = 1""")
def replace_table_query(spark, d):
    return rounded(replace_table(_batches(spark, d)[1], ["k"], "pos"))


DEDUPED = """with {lines} select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, l_extendedprice from
  (select *, row_number() over (partition by l_orderkey, l_linenumber order by {order}) as rn from lines) where rn = 1"""
REST = LINE[1:]


@query("dedupe_first", DEDUPED.format(lines=SQL_LINES, order=", ".join(REST)))
def dedupe_first_query(spark, d):
    return rounded(dedupe_first(lines(spark, d), ["l_orderkey", "l_linenumber"], REST).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))


@query("dedupe_last", DEDUPED.format(lines=SQL_LINES, order=", ".join(f"{c} desc" for c in REST)))
def dedupe_last_query(spark, d):
    return rounded(dedupe_last(lines(spark, d), ["l_orderkey", "l_linenumber"], REST).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))


@query("distinct_rows", "select distinct l_returnflag, l_linestatus, l_shipdate from lineitem")
def distinct_rows_query(spark, d):
    return distinct_rows(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate"))


@query("first_per_key", """select user_id, arg_min(value, (ts, event_id)) filter (where event_type <> 'view') as value,
  arg_min(event_type, (ts, event_id)) filter (where value > 20) as event_type from events group by user_id""")
def first_per_key_query(spark, d):
    events = table(spark, d, "events").withColumns({"a": F.expr("case when event_type <> 'view' then value end"), "b": F.expr("case when value > 20 then event_type end")})
    return first_per_key(events, ["user_id"], ["a", "b"], ["ts", "event_id"]).withColumnsRenamed({"a": "value", "b": "event_type"})


@query("latest_row", "select o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey, max_by(o_totalprice, (o_orderdate, o_orderkey)) as o_totalprice from orders group by 1")
def latest_row(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", F.struct("o_orderdate", "o_orderkey").alias("at"), "o_orderkey", "o_totalprice")
    return latest(rows, ["o_custkey"], "at").drop("at")


@query("best_by", "select o_orderpriority, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as rn from orders) where rn = 1")
def best_by_query(spark, d):
    return best_by(table(spark, d, "orders"), "o_totalprice", ["o_orderpriority"], tie=["o_orderkey"]).select("o_orderpriority", "o_orderkey", "o_totalprice")


@query("class_weights", """with c as (select o_orderpriority, count(*) as n from orders group by 1), w as (select *, sum(n) over () / (count(*) over () * n) as w from c)
select o_orderpriority, n, round(w, 6) as weight, round(w / avg(w) over (), 6) as weight_mean_1 from w""")
def class_weights_query(spark, d):
    return rounded(class_weights(table(spark, d, "orders"), "o_orderpriority"))


@query("fold_summary", "select o_orderpriority as task, round(avg(m), 6) as price, count(*) as folds from (select o_orderpriority, year(o_orderdate) as y, avg(o_totalprice) as m from orders group by 1, 2) group by 1")
def fold_summary(spark, d):
    folds = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("task"), F.year("o_orderdate").alias("y")).agg(F.avg("o_totalprice").alias("price"))
    return rounded(summarise_folds(folds, ["task"], ["price"]))


@query("enrich_left", "select o_orderkey, c_name, c_mktsegment from orders left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey")
def enrich_left(spark, d):
    known = table(spark, d, "customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return enrich(table(spark, d, "orders"), known, "o_custkey").select("o_orderkey", "c_name", "c_mktsegment")


@query("enrich_sides", """with r as (select l_orderkey, l_partkey, max(l_quantity) as q from lineitem group by 1, 2),
m as (select l_orderkey, min(l_partkey) as a, max(l_partkey) + 1 as b from lineitem group by 1)
select m.l_orderkey, a, b, x.q as f1_q, y.q as f2_q from m left join r x on m.l_orderkey = x.l_orderkey and m.a = x.l_partkey left join r y on m.l_orderkey = y.l_orderkey and m.b = y.l_partkey""")
def enrich_sides_query(spark, d):
    items = table(spark, d, "lineitem")
    values = items.groupBy("l_orderkey", "l_partkey").agg(F.max("l_quantity").alias("q"))
    matches = items.groupBy("l_orderkey").agg(F.min("l_partkey").alias("a"), (F.max("l_partkey") + 1).alias("b"))
    return enrich_sides(matches, values, "l_orderkey", "l_partkey", ["q"], {"f1_": "a", "f2_": "b"})


@query("attach_labels", """select d.doc_id, d.lang, coalesce(case when n_chars > 500 then n_chars end, quality * 10)::bigint as n_chars, quality::bigint as quality
from documents d join labels l on d.doc_id = l.doc_id""")
def attach_labels_query(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("n_chars"))
    labels = table(spark, d, "labels").select("doc_id", "quality", (F.col("quality") * 10).cast("long").alias("n_chars"))
    return rounded(attach_labels(docs, labels, ["doc_id"]).select("doc_id", "lang", "n_chars", "quality"))


@query("keep_keys", "select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def keep_keys_query(spark, d):
    keys = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return keep_keys(table(spark, d, "orders"), keys, "o_custkey").select("o_orderkey", "o_custkey")


@query("keep_ids", "select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def keep_ids_query(spark, d):
    return keep_ids(table(spark, d, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey", "c_mktsegment")


@query("new_keys", "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders)")
def new_keys_query(spark, d):
    stored = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return new_keys(table(spark, d, "customer"), stored, ["c_custkey"]).select("c_custkey", "c_name")


@query("lookup_default", "select d.doc_id, coalesce(l.quality * 0.9, 0.5)::double as prob from documents d left join labels l on d.doc_id = l.doc_id")
def lookup_default_query(spark, d):
    probs = table(spark, d, "labels").select("doc_id", (F.col("quality") * F.lit(0.9)).alias("prob"))
    return lookup_default(table(spark, d, "documents").select("doc_id"), probs, "doc_id", "prob")


@query("cross_grid", """select cap, round(sum(least(l_quantity / 50, cap)), 6) as total from lineitem cross join (values (0.02::double), (0.05::double), (0.1::double)) g(cap) group by cap""")
def cross_grid_query(spark, d):
    tried = cross_grid(table(spark, d, "lineitem").select("l_quantity"), [{"cap": c} for c in (0.02, 0.05, 0.1)])
    return rounded(tried.groupBy(F.col("grid.cap").alias("cap")).agg(F.sum(F.least(F.col("l_quantity") / 50, F.col("grid.cap"))).alias("total")))


@query("distinct_keys", "select distinct l_partkey from lineitem where l_partkey is not null")
def distinct_keys_query(spark, d):
    return distinct_keys(table(spark, d, "lineitem"), "l_partkey")


@query("coverage_by_year", """select year(o_orderdate)::bigint as year, round(avg(case when l.k is not null then 1.0::double else 0 end), 6) as coverage, count(*) as n
from orders left join (select distinct l_orderkey as k from lineitem where l_returnflag = 'R') l on o_orderkey = l.k group by 1""")
def coverage_by_year(spark, d):
    known = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k")).distinct()
    rows = table(spark, d, "orders").join(known, F.col("o_orderkey") == F.col("k"), "left").withColumn("year", F.year("o_orderdate"))
    return rounded(coverage_by(rows, "year", F.col("k").isNotNull()))


@query("label_coverage", """with l as (select l_orderkey, max(case when l_quantity > 25 then l_quantity end) as y from lineitem where l_returnflag = 'R' group by 1),
j as (select cast(year(o_orderdate) as varchar) as grp, l.l_orderkey as k, y from orders left join l on o_orderkey = l.l_orderkey),
g as (select * from j union all select 'all', k, y from j)
select grp, count(*) as n, count(k) as covered, round(count(k) / count(*), 6) as coverage, round(count(y) / count(*), 6) as complete from g group by 1""")
def label_coverage_query(spark, d):
    labels = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("y"))
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    return rounded(label_coverage(orders, labels, "o_orderkey", "year", "y"))


@query("union_named", "select o_orderkey as k, o_totalprice as price, null::varchar as name from orders union all select c_custkey, null, c_name from customer")
def union_named(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)
