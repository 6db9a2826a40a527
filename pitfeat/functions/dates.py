"""Dates in free spelling, as an expression of built-in text functions.

A date is a day, a month and a year in any order: a month by name takes the other two numbers as day and year; numbers alone are year-month-day if the first is a year, else
month-day-year, or day-month-year where the first cannot be a month. Weekdays, ordinal endings, a time of day and its zone may stand around it; a missing day is the first, a missing month January. Years of two digits
are 1970 to 2069. What has other words or does not exist on the calendar is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Month names by their first three letters, weekdays, words and zones that may stand around a date.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH = r"(?<![a-z])(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)(?![a-z])"
WEEKDAY = r"(?<![a-z])(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?(?![a-z])"
AROUND = r"(?<![a-z])(?:at|on|and|of|ad)(?![a-z])"
ZONE = r"(?:\s*(?:z|utc|gmt|[ecmp][sd]t)(?![a-z]))?(?:\s*[+-]\d{2}:?\d{2})?"
CLOCK = rf"\d{{1,2}}:\d{{2}}(?::\d{{2}}(?:[.,]\d+)?)?\s*(?:[ap]\.?m\.?(?![a-z]))?{ZONE}"
HOUR = rf"(?<!\d)\d{{1,2}}\s*[ap]\.?m\.?(?![a-z]){ZONE}"


def _number(c: Column) -> Column:
    return F.when(F.length(c) <= 8, c.try_cast("int"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_date(c: Column) -> Column:
    """The day that a text spells, or null."""
    low = F.btrim(F.lower(c))
    low = F.regexp_replace(low, r"(?<=\d)t(?=\d)", " ")
    low = F.regexp_replace(low, r"^(\d{4})(\d{2})(\d{2})(?: ?\d{4,6}z?)?$", "$1-$2-$3")
    for pattern in (CLOCK, HOUR, WEEKDAY, AROUND):
        low = F.regexp_replace(low, pattern, " ")
    low = F.regexp_replace(low, r"(?<=\d)(?:st|nd|rd|th)(?![a-z])", "")
    day = _let(low, lambda text: _let(_read(text), _made))
    return F.coalesce(day, F.try_to_timestamp(c)).cast("date")


def _read(low: Column) -> Column:
    """The numbers of a text without its clock, the month that it names, and whether nothing else is in it."""
    name = F.regexp_extract(low, MONTH, 0)
    by_name = F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(name, 1, 3)), F.lit(0)).cast("int")
    rest = F.regexp_replace(low, MONTH, " ")
    parts = F.regexp_extract_all(rest, F.lit(r"\d+"), F.lit(0))
    plain = rest.rlike(r"^[\d\s.,;/'-]*$") & (F.size(F.regexp_extract_all(low, F.lit(MONTH), F.lit(0))) <= 1)
    return F.struct(parts.alias("parts"), by_name.alias("month"), plain.alias("plain"))


def _made(read: Column) -> Column:
    """The day as a timestamp."""
    parts, by_name = read["parts"], read["month"]
    n = F.size(parts)
    a, b, d = (F.get(parts, F.lit(i)) for i in range(3))

    def is_year(part: Column) -> Column:
        return (F.length(part) >= 3) | (_number(part) > 31)

    def year(part: Column) -> Column:
        v = _number(part)
        return F.when(F.length(part) > 2, v).when(v < 70, v + 2000).otherwise(v + 1900)

    def made(y: Column, m: Column, day: Column) -> Column:
        return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), day.cast("int").alias("d"))

    one = F.lit(1)
    # by name: 5 March 2024, March 5 2024, 2024 March 5, March 2024
    named = (F.when((n == 2) & is_year(a), made(year(a), by_name, _number(b))).when(n == 2, made(year(b), by_name, _number(a)))
             .when((n == 1) & is_year(a), made(year(a), by_name, one)))
    # numbers alone
    second, third = _number(b), _number(d)
    numbers = (F.when((n == 3) & is_year(a), made(year(a), second, third))
               .when((n == 3) & (_number(a) > 12), made(year(d), second, _number(a))).when(n == 3, made(year(d), _number(a), second))
               .when((n == 2) & is_year(a), made(year(a), second, one)).when((n == 2) & is_year(b), made(year(b), _number(a), one))
               .when((n == 1) & (F.length(a) == 4), made(year(a), one, one)))
    found = F.when(by_name.isNotNull(), named).otherwise(numbers)
    return F.when(read["plain"], _let(found, _on_calendar))


def _on_calendar(found: Column) -> Column:
    text = F.concat_ws("-", F.lpad(found["y"].cast("string"), 4, "0"), found["m"].cast("string"), found["d"].cast("string"))
    whole = found["y"].isNotNull() & found["m"].isNotNull() & found["d"].isNotNull()
    return F.when(whole, F.try_to_timestamp(text, F.lit("yyyy-M-d")))
