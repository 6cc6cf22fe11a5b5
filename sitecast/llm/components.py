"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.session import materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst") % 1_000_003)).first())


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges(src, dst)``; the least node names it.

    Alternates two rewrites until nothing changes: each node hands its least
    neighbour to its larger neighbours, then to its smaller ones.  Neighbourhoods
    are never gathered: a minimum is a partial aggregate joined back, and a hot
    centre is split like any skewed join.  Each round is stored, so a lost
    executor repeats one round.  No links give no rows; loops and repeats are
    harmless; a link with a null end is dropped.
    """
    live = edges.select("src", "dst").dropna().where("src <> dst")
    now = materialize(live.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    mark = _mark(now)
    while mark[0]:
        # Larger neighbours of each node get its least neighbour.
        every = _both(now)
        least = every.groupBy("src").agg(F.min("dst").alias("m")).withColumn("m", F.least("m", "src"))
        large = every.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()
        large = materialize(large)
        # A node and its smaller neighbours get the least of them.
        least = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst")
        small = materialize(small.union(least.select("src", F.col("m").alias("dst"))).distinct())
        was, mark, now = mark, _mark(small), small
        if was == mark:
            break
    tops = now.select(F.col("dst").alias("node")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(
        tops.select("node", F.col("node").alias("component"))
    )
