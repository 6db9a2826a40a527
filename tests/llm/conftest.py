from __future__ import annotations

import pytest
from pyspark.sql import types as T

# Columns that operators use inside, as extra columns of the input.
EXTRA = ["input", "key", "h", "fp", "row", "rid", "kept", "score", "size", "bucket"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in EXTRA)])

PROSE = "the cat sat on the mat and saw a bird fly over the old red barn near the river bank while rain fell on fields"


def odd_rows() -> list[tuple]:
    """Nulls, empties, white space, repeated rows, equal ids, one long text, and some prose."""
    long = "\n".join(f"{PROSE} {k % 977} {k * 7919 % 10007}." for k in range(3000))
    texts = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", "b"), (4, PROSE, "b"), (4, PROSE, "b"), (4, PROSE + " twice", "b"), (None, PROSE, None), (None, None, None),
             (5, long, "a"), (6, PROSE.upper(), "c"), (7, "one", "c"), (8, "éa日本 🙂\x85\xa0x", None), (9, "<|endoftext|> a  b\n\n c ", "a"),
             *((20 + k, f"{PROSE} {k}.\nshared line of some length\nShared Line of some length \n{PROSE} again {k * k}", "abc"[k % 3]) for k in range(30))]
    return [(i, t, "en", s, None if t is None else len(t), *[None] * len(EXTRA)) for i, t, s in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 1, 0), (20, 1, 0), (21, 0, 0), (22, 0, 1), (None, 1, 0), (99, 1, 0), (23, None, None), (24, 1, 0)], "doc_id long, quality int, toxic int")
