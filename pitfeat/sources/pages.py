"""Stored web pages to rows. Elements are cut in one Arrow pass over the pages, all else is built-in text functions.

An end tag closes the last open element of its name and all that was opened in it; an end tag without such an element means nothing; what is still open at
the end of the page ends there. So an element may hold others of its name, and each of them is an element too. Comments and the insides of scripts and styles hold no tags.
A null page has no elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import reduce
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pitfeat.functions.dates import parse_date
from pitfeat.functions.text import norm_key, split_x_of_y, strip
from pitfeat.operators.aggregates import dedupe_first

# Tags and classes the stored pages use, and where each figure of a match page stands.
LISTING_ROW = ("tr", "b-statistics__table-row")
MATCH_TITLE = ("i", "b-fight-details__fight-title")
MATCH_PERSON = ("a", "b-fight-details__person-link")
MATCH_CELL = ("p", "b-fight-details__table-text")
TITLE_WORD = "Bout"
CELL_POSITION = {"knockdowns": 2, "sig_strikes": 4, "total_strikes": 8, "takedown": 10, "submission_att": 14, "reversals": 16, "ctrl_time": 18}
PAIR_CELLS = ["sig_strikes", "total_strikes", "takedown"]
MATCH_MARKER = "fight-details"

# Elements without an end tag, and those whose inside is no markup.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style"}

# A comment, or a tag: end mark, name, attributes (a ">" between quotes does not end the tag, unless a quote stays open).
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^'"<>]++|"[^"]*"|'[^']*')*+|[^>]*+)>""", re.S)
CLASS = re.compile(r"""(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# A link's address: quoted either way, or bare.
HREF = r"""(?is)<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def decoded(text: Column) -> Column:
    """Named and numeric characters of page text as themselves; unknown names stay."""
    names = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))], F.lit("apos"), F.lit("'"))

    def one(part: Column) -> Column:
        body = F.substring_index(F.substring(part, 2, 40), ";", 1)
        number = F.when(body.rlike("^#[0-9]{1,7}$"), F.conv(F.substring(body, 2, 9), 10, 16)).when(body.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.substring(body, 3, 9))
        point = F.conv(number, 16, 10).cast("long")
        fits = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
        char = F.when(fits, F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32"))
        return F.when(part.startswith("&"), F.coalesce(char, F.try_element_at(names, body), part)).otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(r"&#?[0-9A-Za-z]+;|[^&]+|&"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(text)


def text_of(html: Column) -> Column:
    """Text of a page fragment: tags out, named and numeric characters in, trimmed (no-break spaces too)."""
    return F.regexp_replace(decoded(F.regexp_replace(html, "(?s)<[^>]*>", "")), "^[\\s\u00a0]+|[\\s\u00a0]+$", "")


def link_of(tag: Column) -> Column:
    """The address in an anchor's opening tag."""
    return decoded(F.concat(*[F.regexp_extract(tag, HREF, k) for k in (1, 2, 3)]))


def _tags(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(from, to, is an end tag, name, attributes) of each tag, none from comments, scripts and styles."""
    raw = None
    for m in TAG.finditer(html):
        closes, name, attrs = m.groups()
        if not name:
            continue
        name = name.lower()
        if raw is not None and not (closes and name == raw):
            continue
        raw = name if name in RAW and not closes else None
        yield *m.span(), bool(closes), name, attrs


def cut(html: str, wanted: list[tuple[str, str | None]]) -> list[list[str]]:
    """For each wanted (tag, class or None), the inner markup of its elements in page order."""
    places: dict[str, list[tuple[int, str | None]]] = {}
    for k, (tag, css_class) in enumerate(wanted):
        places.setdefault(tag, []).append((k, css_class))
    found: list[list[list[int]]] = [[] for _ in wanted]  # [from, to] of each element
    stack, is_open = [], {}
    for start, end, closes, name, attrs in _tags(html):
        if closes:
            if is_open.get(name):
                last = None
                while last != name:
                    last, spans = stack.pop()
                    is_open[last] -= 1
                    for span in spans:
                        span[1] = start
        elif name not in VOID:
            spans = []
            if name in places:
                of = CLASS.search(attrs)
                classes = of[of.lastindex].split() if of else ()
                for k, css_class in places[name]:
                    if css_class is None or css_class in classes:
                        spans.append([end, len(html)])
                        found[k].append(spans[-1])
            stack.append((name, spans))
            is_open[name] = is_open.get(name, 0) + 1
    return [[html[lo:hi] for lo, hi in each] for each in found]


def elements(html: Column, *wanted: tuple[str, str | None]) -> Column:
    """For each wanted (tag, class or None), the inner texts of its elements in page order: an array of arrays, from one pass over the page."""
    @F.arrow_udf("array<array<string>>")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array([cut(page.as_py() or "", list(wanted)) for page in pages], pa.list_(pa.list_(pa.string())))

    return of(html)


def extract_listing(pages: DataFrame, page: str = "page_id", html: str = "html", row: tuple[str, str | None] = LISTING_ROW) -> DataFrame:
    """Listed events: link and title of the first anchor with a link, and the date, of each row of a listing page; rows lacking any of them are dropped."""
    rows = pages.select(F.col(page), elements(F.col(html), row).alias("_found")).select(page, F.posexplode(F.get("_found", F.lit(0))).alias("position", "_row"))
    anchor = F.regexp_extract("_row", HREF + r"[^>]*>.*?</a\s*>", 0)
    title = text_of(F.regexp_extract(anchor, r"(?is)<a\b[^>]*>(.*?)</a\s*>", 1))
    day = parse_date(text_of(F.regexp_extract("_row", r"(?is)<span\b[^>]*>(.*?)</span\s*>", 1)))
    found = rows.select(page, "position", norm_key(link_of(anchor)).alias("event_url"), F.date_format(day, "yyyy-MM-dd").alias("event_date"), title.alias("title"))
    return found.where((F.col("event_url") != "") & (F.col("title") != "") & F.col("event_date").isNotNull())


def extract_links(pages: DataFrame, marker: str | None = MATCH_MARKER, page: str = "page_id", html: str = "html") -> DataFrame:
    """Distinct links of a page's anchors that contain the marker text, cleaned as keys."""
    tags = pages.select(page, F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(0))).alias("_tag"))
    links = tags.select(page, norm_key(link_of(F.col("_tag"))).alias("link"))
    if marker is not None:
        links = links.where(F.col("link").contains(marker))
    return links.distinct()


def union_distinct(frames: list[DataFrame], key: str) -> DataFrame:
    """Union of extracts, one row per key: of the first extract that has it, the smallest row."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("_from", F.lit(i)) for i, f in enumerate(frames)])
    return dedupe_first(every, [key], ["_from", *[c for c in every.columns if c not in (key, "_from")]]).drop("_from")


def extract_match_stats(pages: DataFrame, url: str = "url", html: str = "html", cells: Mapping[str, int] = CELL_POSITION) -> DataFrame:
    """Two rows per match page, one per entity, with the figures found at fixed cell positions."""
    cut_pages = pages.select(norm_key(F.col(url)).alias("fight_url"), elements(F.col(html), MATCH_CELL, MATCH_PERSON, MATCH_TITLE).alias("_found"))
    last = max(cells.values()) + 2
    page = cut_pages.select(
        "fight_url",
        F.transform(F.slice(F.get("_found", F.lit(0)), 1, last), text_of).alias("_cells"),
        F.transform(F.slice(F.get("_found", F.lit(1)), 1, 2), text_of).alias("_names"),
        F.coalesce(text_of(F.get(F.get("_found", F.lit(2)), F.lit(0))), F.lit("")).alias("_title"))
    sides = page.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))

    def cell(name: str) -> Column:
        return F.coalesce(F.get("_cells", F.lit(cells[name]) + F.col("side")), F.lit(""))

    segment = F.when(F.col("_title").contains(TITLE_WORD), strip(F.replace("_title", F.lit(TITLE_WORD), F.lit("")))).otherwise("")
    out = [F.col("fight_url"), F.col("side"), F.coalesce(F.get("_names", "side"), F.lit("")).alias("fighter_name"), segment.alias("weight_class")]
    for name in cells:
        if name in PAIR_CELLS:
            pair = split_x_of_y(cell(name))
            out += [pair["x"].alias(f"{name}_succ"), pair["y"].alias(f"{name}_att")]
        else:
            out.append(cell(name).alias(name))
    return sides.select(*out)
