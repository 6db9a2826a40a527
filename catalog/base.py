"""Registry and shared stand-ins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitfeat.operators.pairing import assign_side
from pitfeat.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Rounded to 6 digits, negative zero made positive."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


# Exact ties at the seventh digit would round by last-bit noise of the summing order; this moves them off the tie.
NUDGE = 1e-8


def rounded(df: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Doubles rounded to 6 digits, ints as longs."""
    def double(c: str) -> Column:
        return r6(F.col(c) + nudge) if nudge else r6(c)

    return df.select(*[double(c).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])


# All columns of a line, which together order the lines of an order.
LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

SQL_LINES = """lines as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount + 0.0 as l_discount,
  l_tax + 0.0 as l_tax, l_returnflag, l_linestatus, l_shipdate from lineitem)"""

SQL_LINE_ORDER = ", ".join(LINE)

# The two sides of a match: the first two lines of an order.
SQL_SIDES = f"""{SQL_LINES}, numbered as (select *, row_number() over (partition by l_orderkey order by {SQL_LINE_ORDER}) - 1 as side from lines),
sides as (select * from numbered where side < 2)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with negative zeros made positive."""
    return table(spark, sf_dir, "lineitem").withColumns({c: F.col(c) + F.lit(0.0) for c in ("l_discount", "l_tax")})


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_side(lines(spark, sf_dir), ["l_orderkey"], LINE)


# Priced probabilities: one row per line with a probability, an outcome and two prices; the event is the order date.
SQL_PRICED = f"""{SQL_LINES}, priced as (select l_orderkey, {SQL_LINE_ORDER}, o_orderdate, o_orderpriority,
  (l_quantity - 0.5) / 50 as p, case when l_returnflag = 'R' then 1 else 0 end as y,
  1.01 + (l_partkey % 37) / 10.0::double as price_1, 1.01 + (l_suppkey % 23) / 10.0::double as price_2
  from lines join orders on l_orderkey = o_orderkey)"""

PRICED_ORDER = ["l_orderkey", *LINE]
SQL_PRICED_ORDER = "l_orderkey, " + SQL_LINE_ORDER


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    return lines(spark, sf_dir).join(orders, "l_orderkey").withColumns({
        "p": (F.col("l_quantity") - 0.5) / 50,
        "y": F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
        "price_1": 1.01 + (F.col("l_partkey") % 37) / F.lit(10.0),
        "price_2": 1.01 + (F.col("l_suppkey") % 23) / F.lit(10.0),
    })
