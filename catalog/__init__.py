"""Queries on the test tables, each next to the SQL that must give the same rows."""

from catalog import features, flows, history, models, pages, prices, quality, scoring, splits, stakes, tables, text  # noqa: F401
from catalog.base import ORACLE, QUERIES  # noqa: F401
