"""Metrics and searches over probabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_LINES, SQL_PRICED, lines, priced, query, r6, rounded
from pitfeat.functions.numbers import clip, softmax, sq_err
from pitfeat.operators import metrics as m
from pitfeat.operators.calibrate import temperature_scores
from pitfeat.operators.models import pick_candidate

EPS = "2.220446049250313e-16::double"
LOSS = f"-(case when y = 1 then ln(greatest(least(p, 1 - {EPS}), {EPS})) else ln(1 - greatest(least(p, 1 - {EPS}), {EPS})) end)"
# a finer score than the quantity alone
SQL_FINE = SQL_PRICED + ", fine as (select *, least(l_extendedprice / 100000, 1.0) as q from priced)"


def _fine(spark, d):
    return priced(spark, d).withColumn("q", F.least(F.col("l_extendedprice") / 100000, F.lit(1.0)))


def _auc(p: str, by: str) -> str:
    keys = f"{by}," if by else ""
    part = f"partition by {by}" if by else ""
    return f"""select {keys} (sum(r) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0) / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) as roc_auc
      from (select *, rank() over ({part} order by {p}) + (count(*) over (partition by {keys} {p}) - 1) / 2.0::double as r from fine) {'group by ' + by if by else ''}"""


def _ece(p: str, by: str) -> str:
    keys = f"{by}," if by else ""
    return f"""select {keys} sum(n * abs(a - b)) / sum(n) as expected_calibration_error from (select {keys} b0, count(*) as n, avg(y) as a, avg({p}) as b from
      (select *, (select count(*) from (values (0.1::double), (0.2), (0.30000000000000004), (0.4), (0.5), (0.6000000000000001), (0.7000000000000001), (0.8), (0.9)) e(e) where {p} >= e) as b0 from fine) group by {keys} b0) {'group by ' + by if by else ''}"""


def _table(by: str) -> str:
    keys = f"{by}," if by else ""
    join = f"using ({by})" if by else "on true"
    return f"""with {SQL_FINE}, a as ({_auc('p', by)}), e as ({_ece('p', by)}),
c as (select {keys} count(*) as n, avg({LOSS}) as log_loss, avg(((p >= 0.5) = (y = 1))::int) as accuracy, count(*) filter (where p >= 0.5 and y = 1) as tp, count(*) filter (where p >= 0.5 and y = 0) as fp,
  count(*) filter (where p < 0.5 and y = 1) as fn, avg((p - y) * (p - y)) as brier_score from fine {'group by ' + by if by else ''})
select {keys} n, round(log_loss, 6) as log_loss, round(accuracy, 6) as accuracy, round(roc_auc, 6) as roc_auc, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, round(brier_score, 6) as brier_score, round(expected_calibration_error, 6) as expected_calibration_error from c join a {join} join e {join}"""


@query("metrics_binary", _table(""))
def metrics_binary(spark, d):
    return rounded(m.binary_metrics(_fine(spark, d), "p", "y"))


@query("metrics_table", _table("l_linestatus"))
def metrics_table(spark, d):
    return rounded(m.metrics_table(_fine(spark, d), by=["l_linestatus"]))


@query("metrics_at_threshold", f"""with {SQL_PRICED}, c as (select count(*) filter (where p >= 0.3 and y = 1) as tp, count(*) filter (where p >= 0.3 and y = 0) as fp, count(*) filter (where p < 0.3 and y = 1) as fn, count(*) as n from priced)
select round((n - fp - fn) / n, 6) as accuracy, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c""")
def metrics_at_threshold(spark, d):
    return rounded(m.binary_metrics(priced(spark, d), "p", "y", 0.3).select("accuracy", "precision", "recall", "f1"))


@query("auc", f"with {SQL_FINE} select round(roc_auc, 6) as roc_auc from ({_auc('q', '')})")
def auc(spark, d):
    return rounded(m.auc(_fine(spark, d), "q", "y"))


@query("ece", f"with {SQL_FINE} select l_linestatus, round(expected_calibration_error, 6) as expected_calibration_error from ({_ece('q', 'l_linestatus')})")
def ece(spark, d):
    return rounded(m.ece(_fine(spark, d), "q", "y", ["l_linestatus"]))


@query("brier", f"with {SQL_PRICED} select l_linestatus, round(avg(pow(p - y, 2)), 6) as brier_score from priced group by 1")
def brier(spark, d):
    return rounded(m.brier(priced(spark, d), "p", "y", ["l_linestatus"]))


@query("prob_parts", f"with {SQL_PRICED} select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber, greatest(0.2, least(0.8, p))::double as clipped, round(pow(p - y, 2), 6) as err, round({LOSS}, 6) as loss from priced")
def prob_parts(spark, d):
    p, y = F.col("p"), F.col("y")
    return rounded(priced(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", clip(p, 0.2, 0.8).alias("clipped"), sq_err(p, y).alias("err"), m.log_loss(p, y).alias("loss")))


SQL_LOGITS = f"""{SQL_LINES}, logits as (select *, l_quantity / 10 as a, l_discount * 20 as b, l_tax * 20 as c, case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as y from lines),
probs as (select *, greatest(a, b, c) as top from logits)"""


def _logits(spark, d):
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return lines(spark, d).select(F.array(F.col("l_quantity") / 10, F.col("l_discount") * 20, F.col("l_tax") * 20).alias("logits"), y.alias("y"))


@query("metrics_multiclass", f"""with {SQL_LOGITS}, s as (select *, exp(a - top) as ea, exp(b - top) as eb, exp(c - top) as ec from probs)
select count(*) as n, round(avg(-ln(case y when 0 then ea when 1 then eb else ec end / (ea + eb + ec))), 6) as log_loss, round(avg((y = case when a >= b and a >= c then 0 when b >= c then 1 else 2 end)::int), 6) as accuracy from s""")
def metrics_multiclass(spark, d):
    return rounded(m.multiclass_metrics(_logits(spark, d).withColumn("probs", softmax(F.col("logits"))), "probs", "y"))


@query("temperature_search", f"""with {SQL_LOGITS}, s as (select t, y, exp((a - top) / t) as ea, exp((b - top) / t) as eb, exp((c - top) / t) as ec from probs cross join
  (values (0.5::double), (0.75), (1.0), (1.25), (1.5), (2.0), (2.5), (3.0)) g(t))
select t as temperature, round(avg(-ln(case y when 0 then ea when 1 then eb else ec end / (ea + eb + ec) + 1e-12)), 6) as nll from s group by t""")
def temperature_search(spark, d):
    return rounded(temperature_scores(_logits(spark, d), "logits", "y", classes=3).drop("pos"))


THRESHOLDS = "thr as (select unnest([" + ", ".join(repr(t) for t in m.THRESHOLDS) + "]::double[]) as t)"


@query("threshold_search", f"with {SQL_FINE}, {THRESHOLDS} select t as threshold, round(avg(((q >= t) = (y = 1))::int), 6) as accuracy from fine cross join thr group by t")
def threshold_search(spark, d):
    return m.threshold_scores(_fine(spark, d), "q", "y").select("threshold", r6("accuracy").alias("accuracy"))


@query("best_threshold", f"""with {SQL_FINE}, {THRESHOLDS}, s as (select t, avg(((q >= t) = (y = 1))::int) as a from fine cross join thr group by t), b as (select * from s order by a desc, t limit 1), z as (select avg(((q >= 0.5) = (y = 1))::int) as a from fine)
select case when b.a > z.a then b.t else 0.5 end as threshold, round(greatest(b.a, z.a), 6) as accuracy from b, z""")
def best_threshold(spark, d):
    return m.best_threshold(_fine(spark, d), "q", "y").select("threshold", r6("accuracy").alias("accuracy"))


@query("pick_candidate", f"with {SQL_FINE}, s as (select 'p' as model, avg(pow(p - y, 2)) as b from fine union all select 'q', avg(pow(q - y, 2)) from fine) select model, round(b, 6) as brier_score from s order by b, model limit 1")
def pick_candidate_query(spark, d):
    rows = _fine(spark, d)
    scores = [m.brier(rows, c, "y").withColumn("model", F.lit(c)) for c in ("p", "q")]
    return rounded(pick_candidate(scores[0].unionByName(scores[1])))
