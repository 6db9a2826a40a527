"""Text formats, coercion, JSON fields and the price feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_LINES, lines, query, rounded, table
from pitfeat.functions import text
from pitfeat.functions.numbers import first_date, null_if, round6, to_ts
from pitfeat.operators.clean import alias_missing, clean_columns, rename_map, valid_key
from pitfeat.sources.price_feed import flatten_price_feed


@query("norm_key", "select page_id, rtrim(trim('  ' || url || '//  '), '/') as k, starts_with(url, 'http') as web from pages")
def norm_key(spark, d):
    return table(spark, d, "pages").select("page_id", text.norm_key(F.concat(F.lit("  "), "url", F.lit("//  "))).alias("k"), text.has_prefix(F.col("url")).alias("web"))


@query("valid_key", "select doc_id, source from documents where source is not null and lower(trim(source)) not in ('nan', 'none', '')")
def valid_key_query(spark, d):
    return valid_key(table(spark, d, "documents"), "source").select("doc_id", "source")


SLUG = "coalesce(nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown')"


@query("slugify", f"select page_id, {SLUG.format(c='url')} as slug, {SLUG.format(c='substr(url, 1, 0)')} as none from pages")
def slugify(spark, d):
    return table(spark, d, "pages").select("page_id", text.slugify(F.col("url")).alias("slug"), text.slugify(F.substring("url", 1, 0)).alias("none"))


@query("match_id", f"""select o_orderkey, 'm/' || strftime(o_orderdate, '%Y%m%dT%H%MZ') || '-' || {SLUG.format(c='c_name')} || '-vs-' || {SLUG.format(c='o_orderpriority')} as id
from orders join customer on o_custkey = c_custkey""")
def match_id(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select("o_orderkey", text.match_id(F.col("o_orderdate"), F.col("c_name"), F.col("o_orderpriority"), "m/").alias("id"))


# Clock texts of three kinds: m:ss, a plain number, and text that is neither.
CLOCK = """case when o_orderstatus = 'F' then cast(o_custkey as varchar) || ':' || lpad(cast(o_orderkey % 60 as varchar), 2, '0')
  when o_orderstatus = 'O' then cast(o_totalprice as varchar) else o_orderpriority end"""


@query("clock_to_seconds", "select o_orderkey, case o_orderstatus when 'F' then o_custkey * 60 + o_orderkey % 60 when 'O' then o_totalprice else 0 end::double as seconds from orders")
def clock_to_seconds(spark, d):
    clock = F.expr(CLOCK.replace("varchar", "string"))
    return table(spark, d, "orders").select("o_orderkey", text.clock_to_seconds(clock).alias("seconds"))


@query("x_of_y", f"""with {SQL_LINES} select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber,
  case when l_quantity > 10 then cast(l_linenumber as varchar) else '' end as x, case when l_quantity > 10 then cast(l_suppkey as varchar) else '' end as y from lines""")
def x_of_y(spark, d):
    token = F.when(F.col("l_quantity") > 10, F.concat(F.lit(" "), "l_linenumber", F.lit(" of "), "l_suppkey", F.lit(" "))).otherwise(F.col("l_returnflag"))
    return rounded(lines(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", text.split_x_of_y(token)["x"].alias("x"), text.split_x_of_y(token)["y"].alias("y")))


OUTCOME = "case when contains(lower({c}), 'ko') or contains(lower({c}), 'tko') then 'KO_TKO' when contains(lower({c}), 'sub') then 'SUB' when contains(lower({c}), 'dec') then 'DEC' else 'OTHER' end"


@query("outcome_class", f"select doc_id, {OUTCOME.format(c='text')} as outcome from documents")
def outcome_class(spark, d):
    return table(spark, d, "documents").select("doc_id", text.outcome_class(F.col("text")).alias("outcome"))


@query("to_number", """select page_id, try_cast(regexp_extract(url, '[0-9]+', 0) as double) as n, try_cast(case when contains(url, '?') then 'x' else '-1.5e2' end as double) as m from pages""")
def to_number(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", text.to_number(F.regexp_extract(url, "[0-9]+", 0)).alias("n"),
                                           text.to_number(F.when(url.contains("?"), "x").otherwise(" -1.5e2 ")).alias("m"))


@query("to_ts", "select o_orderkey, case when o_orderstatus = 'F' then o_orderdate end as ts, case when o_orderstatus = 'F' then o_orderdate - interval 2 hour end as shifted from orders")
def to_ts_query(spark, d):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    rows = table(spark, d, "orders").withColumn("t", F.when(F.col("o_orderstatus") == "F", stamp).otherwise(F.lit("soon")))
    return rows.select("o_orderkey", to_ts(F.col("t")).alias("ts"), to_ts(F.concat("t", F.lit("+02:00"))).alias("shifted"))


@query("first_date", "select o_orderkey, case when o_orderstatus = 'F' then o_orderdate::date else date '2000-01-01' end as day from orders")
def first_date_query(spark, d):
    rows = table(spark, d, "orders").withColumn("a", F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("later"))
    return rows.select("o_orderkey", first_date(F.col("a"), F.lit("2000-01-01")).alias("day"))


@query("calendar_parts", "select o_orderkey, year(o_orderdate)::bigint as year, date_diff('day', o_orderdate, timestamp '2001-08-01') as days_to_end, (o_orderdate + interval 30 day)::date as next from orders")
def calendar_parts(spark, d):
    from pitfeat.functions.numbers import days_between, step_days, year_of

    day = F.col("o_orderdate")
    return rounded(table(spark, d, "orders").select("o_orderkey", year_of(day).alias("year"), days_between(day, F.lit("2001-08-01").cast("date")).alias("days_to_end"), step_days(day, 30).alias("next")))


@query("null_if", "select p_partkey, case when p_size > 10 then p_size end::bigint as p_size from part")
def null_if_query(spark, d):
    return rounded(table(spark, d, "part").select("p_partkey", null_if(F.col("p_size"), F.col("p_size") <= 10).alias("p_size")))


@query("clean_columns", "select page_id, trim('  ' || url || ' ') as url, '' as title, page_id as id, page_id as renamed from pages")
def clean_columns_query(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.concat(F.lit("  "), "url", F.lit(" ")).alias("url"), F.col("page_id").alias("old"))
    rows = rename_map(alias_missing(rows, {"id": "page_id", "url": "page_id", "gone": "absent"}), {"old": "renamed", "absent": "x"})
    return clean_columns(rows, ["url", "title"])


@query("round6", "select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber, round(l_extendedprice / 7, 6) as v from lineitem")
def round6_query(spark, d):
    return rounded(table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", round6(F.col("l_extendedprice") / 7).alias("v")))


@query("json_field", "select event_id, json_extract_string(props, '$.k')::bigint as k, json_extract_string(props, '$.none') as none from events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", text.json_field(F.col("props"), "$.k").cast("long").alias("k"), text.json_field(F.col("props"), "$.none").alias("none"))


@query("price_feed_flat", f"""with {SQL_LINES} select cast(l_orderkey as varchar) as event_id, 'sport' as sport_key, null::varchar as sport_title, strftime(l_shipdate, '%Y-%m-%d') as event_time,
  'part ' || l_partkey || ' vs ' || l_returnflag as event_name, 'part ' || l_partkey as home_team, l_returnflag as away_team, 'book ' || l_suppkey as book, cast(l_suppkey as varchar) as book_key,
  strftime(l_shipdate, '%Y-%m-%d') as book_last_update, 'h2h' as market_key, 2::bigint as outcome_count, 'part ' || l_partkey as f1_name, l_quantity + 1 as odds_f1, l_returnflag as f2_name, l_discount + 1 as odds_f2
from lines""")
def price_feed_flat(spark, d):
    """A feed entry per line: one book with a spreads and a head-to-head market, one book that lacks a second outcome."""
    def outcomes(*pairs):
        return F.array(*[F.struct(F.col(n).alias("name"), p.alias("price")) for n, p in pairs])

    rows = lines(spark, d).withColumns({"home": F.concat(F.lit("part "), "l_partkey"), "day": F.date_format("l_shipdate", "yyyy-MM-dd")})
    home, away = ("home", F.col("l_quantity") + 1), ("l_returnflag", F.col("l_discount") + 1)

    def market(key, *pairs):
        return F.struct(F.lit(key).alias("key"), outcomes(*pairs).alias("outcomes"))

    def book(key, title, *markets):
        return F.struct(key.alias("key"), title.alias("title"), F.col("day").alias("last_update"), F.array(*markets).alias("markets"))

    books = F.array(book(F.col("l_suppkey").cast("string"), F.concat(F.lit("book "), "l_suppkey"), market("spreads", away, home), market("h2h", home, away)),
                    book(F.lit("thin"), F.lit("thin"), market("h2h", home)), book(F.lit("none"), F.lit("none"), market("spreads", home, away)))
    entry = F.struct(F.col("l_orderkey").cast("string").alias("id"), F.lit("sport").alias("sport_key"), F.lit(None).cast("string").alias("sport_title"), F.col("day").alias("commence_time"),
                     F.col("home").alias("home_team"), F.col("l_returnflag").alias("away_team"), books.alias("bookmakers"))
    return rounded(flatten_price_feed(rows.select(F.to_json(entry).alias("json"))))
