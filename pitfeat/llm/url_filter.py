"""URL filters: longest-match allow and block rules, and a list of canonical URLs behind a blocked Bloom filter.

The list becomes a table of 256-bit blocks: a URL's hash picks one block and a few bits in each of its four words. A page whose bits are all
set may be listed; only such pages reach the exact hash join with the list, which removes the false positives. The filter is broadcast
when its size, known from the number of listed URLs, is within ``BROADCAST_BYTES``; a larger one is joined by block number.

Edge cases. A null URL, or one without ``://``, has an empty host and path, fits no rule and is never listed (verdict allow). Hosts are
lower-cased in A-Z only. Repeated rows are judged alike, each row stays. An empty list allows all that no rule judges. Extra columns
are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pitfeat.llm.common import LOWER, UPPER, ascii_lower, query, whole

# (verdict, rule): a host and the start of a path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
BROADCAST_BYTES = 64 << 20
BLOCK_BITS, BITS_PER_URL, WORDS = 256, 16, 4


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(whole(url), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole(url), r"://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading www. or m., path without a closing slash, index page or page ending; no scheme, query or fragment."""
    return F.concat(F.regexp_replace(host, r"^(?:www\.|m\.)", ""), F.regexp_replace(path, r"(?:/index)?(?:\.html?)?/?$", ""))


def judge(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _mask(h: Column, w: int) -> Column:
    """One bit of the 64-bit word number ``w`` of a block."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * w).bitwiseAND(63).cast("int"))


def bloom_blocks(listed: DataFrame, url_col: str, blocks: int) -> DataFrame:
    """One row per block that is not empty: its number and four words."""
    h = F.xxhash64(F.col(url_col))
    return listed.groupBy(F.pmod(F.xxhash64(F.lit(2), F.col(url_col)), F.lit(blocks)).alias("block")).agg(
        *[F.bit_or(_mask(h, w)).alias(f"w{w}") for w in range(WORDS)])


def with_listed(pages: DataFrame, key: Column, listed: DataFrame, url_col: str) -> DataFrame:
    """``pages`` as column ``input`` plus ``listed``: whether ``key`` is in the list (null keys are not)."""
    distinct = listed.select(F.col(url_col).alias("l_url")).where(F.col("l_url").isNotNull()).distinct()
    n = distinct.count()
    blocks = max(1, -(-n * BITS_PER_URL // BLOCK_BITS))
    bloom = bloom_blocks(distinct, "l_url", blocks)
    if blocks * 48 <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    rows = pages.select(F.struct("*").alias("input"), key.alias("key")).withColumns({
        "h": F.xxhash64("key"), "b": F.pmod(F.xxhash64(F.lit(2), F.col("key")), F.lit(blocks))})
    probed = rows.join(bloom, F.col("b") == F.col("block"), "left")
    maybe = F.col("key").isNotNull()
    for w in range(WORDS):
        m = _mask(F.col("h"), w)
        maybe = maybe & (F.coalesce(F.col(f"w{w}"), F.lit(0).cast("long")).bitwiseAND(m) == m)
    probed = probed.select("input", "key", maybe.alias("maybe"))
    hits = probed.where("maybe").join(distinct, F.col("key") == F.col("l_url"), "left")
    return probed.where("not maybe").select("input", F.lit(False).alias("listed")).unionAll(
        hits.select("input", F.col("l_url").isNotNull().alias("listed")))


def filter_urls(pages: DataFrame, listed: DataFrame, url_col: str = "url", listed_col: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``input`` (the row), host, path, rule, verdict. ``listed`` holds canonical URLs; they are blocked where no rule decides."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    key = F.when(host != "", canonical(host, path))
    done = with_listed(pages, key, listed, listed_col)
    host, path = host_of(F.col(f"input.`{url_col}`")), path_of(F.col(f"input.`{url_col}`"))
    done = done.select("input", "listed", host.alias("host"), path.alias("path"))
    rule, verdict = judge(F.col("host"), F.col("path"), rules)
    return done.select("input", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def bad_urls(pages: DataFrame, url_col: str = "url", labels: Sequence[str] = ("spam-farm",), rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """The list of the query: canonical URLs of all pages that a rule blocks or whose host has one of the labels, so their mirrors go too."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(host.alias("host"), path.alias("path")).where(F.col("host") != "")
    _, verdict = judge(F.col("host"), F.col("path"), rules)
    named = F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, labels)))
    return rows.where((verdict == "block") | named).select(canonical(F.col("host"), F.col("path")).alias("url"))


def _sql_case(what: str) -> str:
    cases = []
    for verdict, text in sorted(RULES, key=lambda r: -len(r[1])):
        name, _, rest = text.partition("/")
        cases.append(f"when (host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '/{rest}') then '{verdict if what == 'verdict' else text}'")
    return f"case {' '.join(cases)} end"


SQL = f"""with parts as (select page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path from pages),
judged as (select *, {_sql_case('rule')} as rule, {_sql_case('verdict')} as said, case when host <> '' then
    regexp_replace(host, '^(?:www\\.|m\\.)', '') || regexp_replace(path, '(?:/index)?(?:\\.html?)?/?$', '') end as k from parts),
listed as (select distinct k from judged where host <> '' and (said = 'block' or list_contains(string_split(host, '.'), 'spam-farm')))
select page_id, host, path, rule, coalesce(said, case when k in (select k from listed) then 'block' else 'allow' end) as verdict from judged"""


@query("op10_url_filter", SQL)
def op10_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, bad_urls(pages)).select(F.col("input.page_id").alias("page_id"), "host", "path", "rule", "verdict")
