"""Text keys, slugs, and small text formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANKS = " \t\n\r\x0b\x0c"

# Key texts that stand for a missing key.
MISSING_TEXTS = ["nan", "none", ""]

# Outcome classes in the order they are tested, with the texts that select them.
OUTCOME_CLASSES = [("KO_TKO", ["ko", "tko"]), ("SUB", ["sub"]), ("DEC", ["dec"])]
OTHER_OUTCOME = "OTHER"

NUMBER_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def norm_key(c: Column) -> Column:
    """Trim, then drop trailing slashes."""
    return F.regexp_replace(strip(c.cast("string")), "/+$", "")


def has_prefix(c: Column, prefix: str = "http") -> Column:
    return c.startswith(prefix)


def key_present(c: Column) -> Column:
    """True when a key is neither null nor one of the texts that mean "missing"."""
    return c.isNotNull() & ~F.lower(strip(c.cast("string"))).isin(*MISSING_TEXTS)


def slugify(c: Column) -> Column:
    dashed = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.btrim(dashed, F.lit("-")), F.lit("")), F.lit("unknown"))


def match_id(ts: Column, first: Column, second: Column, prefix: str = "") -> Column:
    stamp = F.date_format(ts, "yyyyMMdd'T'HHmm'Z'")
    return F.concat(F.lit(prefix), stamp, F.lit("-"), slugify(first), F.lit("-vs-"), slugify(second))


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes null."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def clock_to_seconds(c: Column) -> Column:
    """``m:ss`` to seconds, plain numbers unchanged, everything else 0."""
    parts = F.split(c.cast("string"), ":")
    return F.coalesce(
        F.when(F.size(parts) == 2, to_number(parts.getItem(0)) * 60 + to_number(parts.getItem(1)))
        .when(F.size(parts) == 1, to_number(c)),
        F.lit(0.0),
    )


def split_x_of_y(c: Column) -> Column:
    """``46 of 120`` to a struct of two texts; any other shape gives two empty texts."""
    parts = F.split(c, " of ")
    ok = F.size(parts) == 2
    return F.struct(
        F.when(ok, strip(F.get(parts, F.lit(0)))).otherwise("").alias("x"),
        F.when(ok, strip(F.get(parts, F.lit(1)))).otherwise("").alias("y"),
    )


def outcome_class(c: Column) -> Column:
    low = F.lower(c.cast("string"))
    picked = F.lit(OTHER_OUTCOME)
    for name, texts in reversed(OUTCOME_CLASSES):
        hit = F.lit(False)
        for text in texts:
            hit = hit | low.contains(text)
        picked = F.when(hit, name).otherwise(picked)
    return picked


def clean_text(c: Column | None) -> Column:
    """Trimmed text, empty when null; an absent column (``None``) is empty too."""
    return F.lit("") if c is None else F.coalesce(strip(c.cast("string")), F.lit(""))


def json_field(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)
