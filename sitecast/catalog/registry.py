"""The list of queries: a name, a Spark function, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.catalog.fixtures import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **ctes: str):
    """Register a query under ``name``; ``sql`` may use the derived views and ``ctes``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, ctes)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, for comparison across engines."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


def each(cols, template: str) -> str:
    """``template`` once per column, joined by UNION ALL; ``{c}`` is the column."""
    return "\nUNION ALL ".join(template.format(c=c) for c in cols)
