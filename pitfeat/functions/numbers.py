"""Ratios, prices, stakes, dates and probability vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Price clip used before logs and margins, and the stand-in for a missing rank in deltas.
TINY = 1e-6
NO_RANK = 999.0


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bounded value; null stays null."""
    out = c
    if lo is not None:
        out = F.when(out < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(hi)).otherwise(out)
    return out


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, with 0 where the ratio is undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def null_if(c: Column, bad: Column) -> Column:
    return F.when(~bad, c)


def implied(price: Column) -> Column:
    return F.try_divide(F.lit(1.0), price)


def margin_free(p1: Column, p2: Column) -> Column:
    """Share of side 1 in the summed implied probabilities."""
    i1, i2 = implied(p1), implied(p2)
    return F.try_divide(i1, i1 + i2)


def margin(p1: Column, p2: Column) -> Column:
    return implied(clip(p1, TINY)) + implied(clip(p2, TINY)) - 1.0


def log_ratio(p1: Column, p2: Column) -> Column:
    return F.ln(clip(p1, TINY, 1.0)) - F.ln(clip(p2, TINY, 1.0))


def delta(a: Column, b: Column, null: float | None = None) -> Column:
    return a - b if null is None else F.coalesce(a, F.lit(null)) - F.coalesce(b, F.lit(null))


def pair_mean(a: Column, b: Column, null: float | None = None) -> Column:
    if null is not None:
        a, b = F.coalesce(a, F.lit(null)), F.coalesce(b, F.lit(null))
    return (a + b) / 2.0


def presence(a: Column, b: Column) -> Column:
    return a.isNotNull().cast("int") + b.isNotNull().cast("int")


def kelly(p: Column, price: Column) -> Column:
    """Growth-optimal share of the bankroll at a decimal price, within [0, 1]; 0 at price 1."""
    raw = F.coalesce(F.try_divide(p * price - 1.0, price - 1.0), F.lit(0.0))
    return F.when(p.isNotNull() & price.isNotNull(), clip(raw, 0.0, 1.0))


def edge(p: Column, price: Column) -> Column:
    return p * price - 1.0


def round6(c: Column) -> Column:
    return F.round(c, 6)


def sq_err(p: Column, y: Column) -> Column:
    return (p - y) * (p - y)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def softmax(scores: Column, temperature: float = 1.0) -> Column:
    """Softmax of an array column divided by a temperature, shifted by its maximum."""
    t = F.lit(float(temperature))
    powers = _let(F.array_max(scores), lambda top: F.transform(scores, lambda x: F.exp((x - top) / t)))
    return renormalise(powers)


def true_class_prob(scores: Column, code: Column, temperature: float = 1.0) -> Column:
    """Softmax probability of one class, without building the vector."""
    t = F.lit(float(temperature))
    top = F.array_max(scores)
    total = _let(top, lambda m: F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + F.exp((x - m) / t)))
    return F.exp((F.get(scores, code) - top) / t) / total


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def renormalise(values: Column) -> Column:
    """Scale an array to sum 1; an all-zero array is left as it is."""
    return _let(values, lambda v: _let(array_sum(v), lambda s: F.transform(v, lambda x: x / F.when(s == 0.0, F.lit(1.0)).otherwise(s))))


def argmax_index(values: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def argmax_class(values: Column, classes: Sequence) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), argmax_index(values))


def to_ts(c: Column, fmt: str | None = None) -> Column:
    """Text to a UTC timestamp without zone; bad text becomes null."""
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), parsed.cast("timestamp_ntz"))


def first_date(*columns: Column) -> Column:
    """First column that parses as a date."""
    return F.coalesce(*[F.try_to_timestamp(c.cast("string")).cast("date") for c in columns])


def year_of(c: Column) -> Column:
    return F.year(c)


def days_between(a: Column, b: Column) -> Column:
    return F.datediff(b, a)


def step_days(c: Column, days: int) -> Column:
    return F.date_add(c, days)
