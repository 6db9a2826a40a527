"""Row and column clean-up: renames, keys, coercion, label filters, feature lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from pitfeat.functions.text import clean_text, key_present

# Target columns, never features.
TARGETS = ["winner", "winner_encoded", "result", "result_details", "finish_round", "finish_time"]

# Descriptive columns, never features.
METADATA = [
    "event_date", "fight_url", "event_name", "event_url", "referee", "event_city", "event_state", "event_country",
    "f_1_name", "f_2_name", "f_1_url", "f_2_url",
    "f_1_fighter_f_name", "f_1_fighter_l_name", "f_1_fighter_nickname",
    "f_2_fighter_f_name", "f_2_fighter_l_name", "f_2_fighter_nickname",
    "f_1_fighter_dob", "f_2_fighter_dob", "fighter_dob_f_1", "fighter_dob_f_2",
    "f_1_fighter_stance", "f_2_fighter_stance",
]

# Names of columns that are only known after the match.
LEAK_PATTERNS = [
    r"_r[1-5]_",
    r"^r[1-5]_",
    r"r[1-5]_duration",
    r"f_[12]_total_strikes_(?:succ|att)$",
    r"f_[12]_sig_strikes_(?:succ|att)$",
    r"f_[12]_knockdowns$",
    r"f_[12]_submission_att$",
    r"f_[12]_ctrl_time_sec$",
    r"fight_duration",
    r"finish_round$",
    r"finish_time$",
    r"f_[12]_reversals$",
    r"f_[12]_td_[12]_(?:succ|att)$",
    r"f_[12]_takedown_(?:succ|att)$",
]

# Words that mark price columns.
PRICE_WORDS = ["odds", "prob", "implied"]


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def alias_missing(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Copy ``source`` to ``target`` where only the source exists; ``names`` maps target to source."""
    new = {t: F.col(s) for t, s in names.items() if t not in df.columns and s in df.columns}
    return df.withColumns(new) if new else df


def valid_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [key_present(F.col(k)) for k in keys]))


def clean_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Trim text columns to non-null text, adding absent ones as empty text."""
    return df.withColumns({n: clean_text(F.col(n) if n in df.columns else None) for n in names})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def leaks(name: str, patterns: Sequence[str] = tuple(LEAK_PATTERNS)) -> bool:
    return any(re.search(p, name) for p in patterns)


def safe_features(df: DataFrame, targets: Sequence[str] = tuple(TARGETS), metadata: Sequence[str] = tuple(METADATA),
                  patterns: Sequence[str] = tuple(LEAK_PATTERNS), drop_price: bool = False) -> list[str]:
    """Sorted numeric columns that are neither targets, nor descriptive, nor known only after the match."""
    names = set(numeric_columns(df)) - set(targets) - set(metadata)
    names = {n for n in names if not leaks(n, patterns)}
    if drop_price:
        names = {n for n in names if not any(w in n.lower() for w in PRICE_WORDS)}
    return sorted(names)


def column_set(df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> list[str]:
    names = set(df.columns) - set(exclude)
    return sorted(names if include is None else names & set(include))


def binary_only(df: DataFrame, label: str, drop_draws_only: bool = False) -> DataFrame:
    """Keep labels 0 and 1, or only drop draws (-1); null labels go either way."""
    y = F.col(label)
    return df.where(y != -1) if drop_draws_only else df.where(y.isin(0, 1))


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training columns in training order; absent ones are null."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(f) if f in have else F.lit(None).cast("double").alias(f) for f in features])


def drop_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def to_float(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("float") for n in (names or numeric_columns(df))})


def prefix(df: DataFrame, text: str) -> DataFrame:
    return df.toDF(*[text + c for c in df.columns])


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    return df.na.fill(value)


def between_dates(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows of [start, end); the bounds are literals, so the filter reaches the scan."""
    return df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def sample_n(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """A repeatable sample of ``n`` rows: those whose seed and keys, joined as text, have the smallest md5."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def sort_by(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order)


def first_n(df: DataFrame, order: Sequence[str | Column], n: int | None = None) -> DataFrame:
    """The first ``n`` rows in order; ``None`` or a non-positive number keeps all."""
    return df.orderBy(*order).limit(n) if n and n > 0 else df
