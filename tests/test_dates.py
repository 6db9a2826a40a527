"""Free date spellings against the data-frame library's own parser."""

from __future__ import annotations

import datetime as dt
import warnings

import pandas as pd
from pyspark.sql import functions as F

from pitfeat.functions.dates import parse_date

DAYS = [dt.date(2024, 3, 5), dt.date(1999, 12, 31), dt.date(2004, 2, 29), dt.date(2010, 5, 17)]
FORMS = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y", "%B %d, %Y", "%b %d, %Y", "%b. %d, %Y", "%d %B %Y", "%d %b %Y", "%d-%b-%Y", "%d%b%Y", "%Y %B %d", "%Y-%b-%d",
         "%A, %B %d, %Y", "%a, %d %b %Y", "%a %b %d %Y", "%A %d %B %Y", "%B %d %Y", "%d. %B %Y", "%Y%m%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S.%f",
         "%m/%d/%Y %I:%M %p", "%B %d, %Y %I:%M:%S %p", "%a, %d %b %Y %H:%M:%S GMT", "%d %B %Y, %H:%M", "%Y-%m-%d %H:%M:%S+02:00", "%B %d, %Y at %H:%M", "%H:%M %B %d, %Y", "%B %Y", "%b-%Y", "%Y-%m",
         "%Y", "%d of %B %Y", "%d of %B, %Y", "%b %d %Y %I%p", "%Y%m%dT%H%M%S", "%m/%d/%y", "%d %b %y", "%b %d, %y", "%B. %d. %Y"]


def parsed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["d"] for r in df.select("i", parse_date(F.col("t")).alias("d")).orderBy("i").collect()]


def test_spellings(spark):
    texts = [dt.datetime.combine(d, dt.time(13, 45, 7)).strftime(f) for d in DAYS for f in FORMS]
    texts += ["March 5th, 2024", "1st May 2010", "2nd of June 2011", "Sept. 3, 2015", "3/5/2024", "25/12/2023", "JULY 4 2020", "tue, may 1st 2018", "Thu. 4 Jan 2018", "  Oct   7 ,2016 ", "5-March-2024"]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = [pd.to_datetime(t).date() for t in texts]
    got = parsed(spark, texts)
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []


def test_no_date(spark):
    texts = ["soon", "2023-13-05", "", None, "no date 2024", "February 30, 2024", "2024-02-30", "March April 2024", "13/13/2024", "5", "99999999999999999999", "1 2 3 4", "May be 2024", "--", "to be announced"]
    assert [(t, d) for t, d in zip(texts, parsed(spark, texts)) if d is not None] == []
