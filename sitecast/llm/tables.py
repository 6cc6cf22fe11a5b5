"""Reading the given tables, and sides of a join whose size is checked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most so many narrow rows is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checked_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as a broadcast side if its counted ``rows`` are within ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def same(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of named columns of two tables."""
    out = F.lit(True)
    for x, y in pairs:
        out = out & a[x].eqNullSafe(b[y])
    return out


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names of a working column each, none of which ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return tuple(out)
