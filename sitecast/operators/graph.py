"""Neighbourhood operators on edge lists ``(src, dst, weight)``.

Softmax groups are never gathered: energies are cut into bands of fixed width,
each band keeps partial sums that Spark combines before the shuffle, and the
few bands of a group are then rescaled to its highest one.  The result is the
usual numerically safe softmax, with a hot group costing one row per band and
task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BAND = 32.0


def normalize_symmetric(edges: DataFrame) -> DataFrame:
    """Weight times the inverse square roots of both ends' row sums; an empty row counts 0."""
    sums = edges.groupBy("src").agg(F.sum("weight").alias("s"))
    factor = sums.select("src", F.when(F.col("s") != 0, F.pow("s", F.lit(-0.5))).otherwise(0.0).alias("f"))
    out = edges.join(factor.withColumnRenamed("f", "_fs"), "src").join(
        factor.select(F.col("src").alias("dst"), F.col("f").alias("_fd")), "dst", "left"
    )
    return out.select("src", "dst", (F.col("_fs") * F.col("weight") * F.coalesce("_fd", F.lit(0.0))).alias("weight"))


def normalize_rows(edges: DataFrame, floor: float = 1e-6) -> DataFrame:
    """Weight over the row sum of its source."""
    sums = edges.groupBy("src").agg(F.greatest(F.sum("weight"), F.lit(floor)).alias("_s"))
    return edges.join(sums, "src").select("src", "dst", (F.col("weight") / F.col("_s")).alias("weight"))


def propagate(edges: DataFrame, nodes: DataFrame, features: Sequence[str], node: str = "node") -> DataFrame:
    """Weighted sum of the neighbours' features per source node."""
    far = nodes.select(F.col(node).alias("dst"), *features)
    return (
        edges.join(far, "dst")
        .groupBy(F.col("src").alias(node))
        .agg(*[F.sum(F.col("weight") * F.col(f)).alias(f) for f in features])
    )


def complete_propagate(nodes: DataFrame, features: Sequence[str], node: str = "node", self_loops: bool = False) -> DataFrame:
    """``propagate`` over the row-normalised complete graph, without its edges.

    Each node's sum over the others is the total less (or, with the doubled
    self loop, plus) its own value, so one row of totals replaces n*n edges.
    """
    total = nodes.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f).cast("double")).alias(f) for f in features]).first()
    own = 1.0 if self_loops else -1.0
    weight = max(total["n"] + own, 1e-6)
    return nodes.select(
        node, *[((F.lit(total[f]).cast("double") + own * F.col(f)) / F.lit(weight)).alias(f) for f in features]
    )


def _dot(weights: Sequence[float], features: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(f) for w, f in zip(weights, features, strict=True)])


def _energies(
    edges: DataFrame, nodes: DataFrame, features: Sequence[str], a_src, a_dst, node: str, slope: float
) -> DataFrame:
    """``(src, dst, head, energy, features of dst)`` for each existing edge and head."""
    near = nodes.select(F.col(node).alias("src"), F.array(*[_dot(a, features) for a in a_src]).alias("_es"))
    far = nodes.select(F.col(node).alias("dst"), F.array(*[_dot(a, features) for a in a_dst]).alias("_ed"), *features)
    met = edges.filter(F.col("weight") > 0).select("src", "dst").join(near, "src").join(far, "dst")
    raw = F.col("_es")[F.col("head")] + F.col("_ed")[F.col("head")]
    return met.withColumn("head", F.explode(F.sequence(F.lit(0), F.lit(len(a_src) - 1)))).select(
        "src", "dst", "head", F.when(raw > 0, raw).otherwise(slope * raw).alias("energy"), *features
    )


def _softmax_sums(df: DataFrame, keys: Sequence[str], energy: Column, values: Sequence[str]) -> DataFrame:
    """Per group: its highest band, the scaled normaliser, and scaled weighted sums."""
    banded = df.withColumn("_e", energy).withColumn("_band", F.floor(F.col("_e") / BAND))
    share = F.exp(F.col("_e") - F.col("_band") * BAND)
    parts = banded.groupBy(*keys, "_band").agg(
        F.sum(share).alias("_z"), *[F.sum(share * F.col(v)).alias(f"_s_{v}") for v in values]
    )
    top = F.max("_band").over(Window.partitionBy(*keys))
    scale = F.exp((F.col("_band") - F.col("_top")) * BAND)
    return (
        parts.withColumn("_top", top)
        .groupBy(*keys, "_top")
        .agg(F.sum(F.col("_z") * scale).alias("_z"), *[F.sum(F.col(f"_s_{v}") * scale).alias(f"_s_{v}") for v in values])
    )


def attention_weights(
    edges: DataFrame, nodes: DataFrame, features: Sequence[str], a_src, a_dst, node: str = "node", slope: float = 0.2
) -> DataFrame:
    """Softmax weight of each edge among its source's edges, per head."""
    e = _energies(edges, nodes, features, a_src, a_dst, node, slope).drop(*features)
    stats = _softmax_sums(e, ["src", "head"], F.col("energy"), [])
    share = F.exp(F.col("energy") - F.col("_top") * BAND) / F.col("_z")
    return e.join(stats, ["src", "head"]).select("head", "src", "dst", share.alias("attention"))


def attention_aggregate(
    edges: DataFrame, nodes: DataFrame, features: Sequence[str], a_src, a_dst, node: str = "node",
    slope: float = 0.2, activate: bool = True,
) -> DataFrame:
    """Attention-weighted neighbour features per node and head, through elu when ``activate``.

    A node without edges yields no row.
    """
    e = _energies(edges, nodes, features, a_src, a_dst, node, slope)
    sums = _softmax_sums(e, ["src", "head"], F.col("energy"), features)

    def out(f: str) -> Column:
        v = F.col(f"_s_{f}") / F.col("_z")
        return (F.when(v > 0, v).otherwise(F.exp(v) - 1) if activate else v).alias(f)

    return sums.select(F.col("src").alias(node), "head", *[out(f) for f in features])


def softmax_pool(df: DataFrame, group: Sequence[str], energy: str, values: Sequence[str], temperature: float = 1.0) -> DataFrame:
    """Sum of values weighted by softmax(energy / temperature) in each group."""
    sums = _softmax_sums(df, group, F.col(energy) / F.lit(float(temperature)), values)
    return sums.select(*group, *[(F.col(f"_s_{v}") / F.col("_z")).alias(v) for v in values])


def mean_pool(df: DataFrame, group: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.groupBy(*group).agg(*[F.avg(v).alias(v) for v in values])


def transform_sequences(df: DataFrame, fn: Callable[[Column], Column], col: str = "x") -> DataFrame:
    """Apply a column function (or a pandas UDF) to the sequence column."""
    return df.withColumn(col, fn(F.col(col)))
