"""Sorting, ranking, top lists and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecast.operators.columns import columns_by_kind
from sitecast.operators.ordering import with_running_total


def sort_by_score(df: DataFrame, col: str, key: str) -> DataFrame:
    """Largest score first, ties by key: a range-partitioned sort."""
    return df.orderBy(F.desc_nulls_last(col), key)


def rank_min(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """Rank by descending value; ties share the lowest rank; NULL has none.

    Equal scores are counted before anything is ordered, so the sort sees each
    score once and a score shared by many rows costs one row.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    placed = with_running_total(counts, [F.desc(col)], "_n", "_before")
    ranks = placed.select(col, (F.col("_before") + 1).cast("long").alias(out))
    return df.join(ranks, col, "left").select(*df.columns, out)


def top_by_rank(df: DataFrame, n: int, key: str, rank: str = "rank") -> DataFrame:
    """The ``n`` rows with the smallest rank, ties by key."""
    return df.orderBy(F.asc_nulls_last(rank), key).limit(n)


def top_n(df: DataFrame, col: str, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the largest value, ties by key."""
    return df.orderBy(F.desc_nulls_last(col), key).limit(n)


def top_ranked(df: DataFrame, col: str, n: int, key: str, out: str = "rank") -> DataFrame:
    """The ``n`` best rows with their rank in the whole table.

    Every row that beats one of them is among them, so ranking the ``n`` rows
    gives the same rank as ranking all; the window holds ``n`` rows.
    """
    best = top_n(df.filter(F.col(col).isNotNull()), col, n, key)
    return best.withColumn(out, F.rank().over(Window.orderBy(F.desc(col))).cast("long"))


def append_predictions(df: DataFrame, pred: DataFrame, flag: str = "is_prediction") -> DataFrame:
    """Union by name; columns one side lacks are NULL; the flag is 1 on predictions."""
    return df.unionByName(pred.withColumn(flag, F.lit(1)), allowMissingColumns=True)


def append_mean_row(df: DataFrame, similar: DataFrame, new_id: str, id_col: str = "hotel", exclude: Sequence[str] = ("hotel_id",)) -> DataFrame:
    """Add one row holding the mean of each numeric column of ``similar``."""
    cols = [c for c in columns_by_kind(similar)["numeric"] if c not in exclude]
    row = similar.agg(*[F.avg(c).alias(c) for c in cols]).withColumn(id_col, F.lit(new_id))
    return append_predictions(df, row)
