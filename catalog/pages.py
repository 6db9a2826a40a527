"""Stored pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_SIDES, query, rounded, sides, table
from pitfeat.sources.pages import CELL_POSITION, extract_links, extract_listing, extract_match_stats, union_distinct
from pitfeat.operators.clean import first_n

# anchors of either quoting in these pages
LINKS = r"""select page_id, replace(coalesce(nullif(regexp_extract(t, 'href="([^"]*)"', 1, 'i'), ''), regexp_extract(t, 'href=''([^'']*)''', 1, 'i')), '&amp;', '&') as l
  from (select page_id, unnest(regexp_extract_all(html, '<a\s[^>]*>', 0, 'i')) as t from pages) where regexp_matches(t, '\shref=', 'i')"""


@query("page_links", f"select distinct page_id, rtrim(trim(l), '/') as link from ({LINKS})")
def page_links(spark, d):
    return extract_links(table(spark, d, "pages"), None)


@query("page_links_marker", f"select distinct page_id, rtrim(trim(l), '/') as link from ({LINKS}) where contains(l, 'en')")
def page_links_marker(spark, d):
    return extract_links(table(spark, d, "pages"), "en")


@query("page_links_union", f"select distinct rtrim(trim(l), '/') as link from ({LINKS}) where contains(l, 'en') or contains(l, 'th')")
def page_links_union(spark, d):
    pages = table(spark, d, "pages")
    return union_distinct([extract_links(pages, m).select("link") for m in ("en", "th")], "link")


@query("page_links_known", """select o_orderkey, 'http://x/m?a=' || o_orderkey || '&b=é' as link from orders union all select o_orderkey, 'http://y/' || o_orderkey from orders
  union all select o_orderkey, 'z' || o_orderkey from orders""")
def page_links_known(spark, d):
    """Pages written with anchors of all three quotings, a style sheet link, an anchor without an address, and named and numeric characters."""
    html = F.concat(F.lit('<link href="http://css/m"><a name="m">x</a><A class="k" HREF=" http://x/m?a='), "o_orderkey", F.lit("&amp;b=&#233; \">1</A><a\nhref='http://y/"), "o_orderkey",
                    F.lit("/'>2</a><a id=i href=z"), "o_orderkey", F.lit(' title="href=">3</a><a data-href="no">4</a>'))
    return extract_links(table(spark, d, "orders").select("o_orderkey", html.alias("html")), None, "o_orderkey")


@query("page_listing", """select o_orderkey, 'http://x/' || o_orderkey as event_url, strftime(o_orderdate, '%Y-%m-%d') as event_date, o_orderpriority || ' & é“ more' as title from orders where o_orderstatus <> 'P'""")
def page_listing(spark, d):
    """A listing row per order written as a page; orders in state P lack the date."""
    row = F.concat(F.lit('<table><tr class="head"><th>x</th></tr><tr class="wide b-statistics__table-row">\n<td><a name="top">no</a><i><a  href=" http://x/'), "o_orderkey", F.lit('/ " class="k">\n  <b>'),
                   "o_orderpriority", F.lit("</b> &amp; &eacute;&#x201C; more </a><span class=d> "), F.when(F.col("o_orderstatus") == "P", "soon").when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "EEEE, MMM. d, yyyy")).otherwise(F.date_format("o_orderdate", "d MMMM yyyy")), F.lit(" </span></td></tr></table>"))
    pages = table(spark, d, "orders").select("o_orderkey", row.alias("html"))
    return extract_listing(pages, "o_orderkey").drop("position")


@query("page_first_n", "select page_id, url from pages order by page_id limit 15")
def page_first_n(spark, d):
    return first_n(table(spark, d, "pages").select("page_id", "url"), ["page_id"], 15)


@query("page_stats", f"""with {SQL_SIDES}, ok as (select l_orderkey from sides group by 1 having max(side) = 1)
select 'http://m/' || s.l_orderkey as fight_url, s.side::bigint as side, 'part ' || l_partkey as fighter_name, l_returnflag as weight_class, l_linenumber::varchar as knockdowns,
  l_suppkey::varchar as sig_strikes_succ, l_partkey::varchar as sig_strikes_att, '' as total_strikes_succ, '' as total_strikes_att, l_linenumber::varchar as takedown_succ, l_suppkey::varchar as takedown_att,
  l_linestatus as submission_att, l_returnflag as reversals, l_linenumber || ':05' as ctrl_time from sides s join ok on s.l_orderkey = ok.l_orderkey""")
def page_stats(spark, d):
    """A match page per order with both sides' figures in the cells where match pages have them."""
    two = sides(spark, d)
    texts = {"knockdowns": F.col("l_linenumber").cast("string"), "sig_strikes": F.concat_ws(" of ", "l_suppkey", "l_partkey"), "total_strikes": F.lit("---"),
             "takedown": F.concat_ws(" of ", "l_linenumber", "l_suppkey"), "submission_att": F.col("l_linestatus"), "reversals": F.col("l_returnflag"), "ctrl_time": F.concat("l_linenumber", F.lit(":05"))}
    two = two.select("l_orderkey", "side", "l_returnflag", F.concat(F.lit("part "), "l_partkey").alias("name"), *[c.alias(n) for n, c in texts.items()])
    fields = ["name", "l_returnflag", *texts]
    # a page names one segment: two pages per order, one per side's segment, of which each side reads its own
    both = two.groupBy("l_orderkey").agg(*[F.max(F.when(F.col("side") == s, F.struct(*fields))).alias(f"s{s}") for s in (0, 1)]).where("s1 is not null")
    cells = ["<p class='b-fight-details__table-text'> - </p>"] * 20
    parts = [F.lit("<html><i class='b-fight-details__fight-title'> "), F.col("cls"), F.lit(" Bout </i>")]
    for s in (0, 1):
        parts += [F.lit("<a class='b-fight-details__person-link' href='#'>\n "), F.col(f"s{s}.name"), F.lit(" </a>")]
    at = {pos + s: F.col(f"s{s}.{name}") for name, pos in CELL_POSITION.items() for s in (0, 1)}
    for i, empty in enumerate(cells):
        parts += [F.lit("<p class='b-fight-details__table-text'>\n "), at[i], F.lit(" </p>")] if i in at else [F.lit(empty)]
    pages = both.select(F.col("l_orderkey"), F.col("s0"), F.col("s1"), F.posexplode(F.array("s0.l_returnflag", "s1.l_returnflag")).alias("page", "cls")).withColumn("html", F.concat(*parts))
    found = extract_match_stats(pages.select(F.concat(F.lit("http://m/"), "l_orderkey", F.lit("/#"), "page").alias("url"), "html"))
    own = found.where(F.substring_index("fight_url", "#", -1).cast("int") == F.col("side"))
    return rounded(own.withColumn("fight_url", F.regexp_replace("fight_url", "/#.*$", "")))
