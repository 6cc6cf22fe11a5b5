"""Scaling rows, repeatable splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.operators.summary import _rows
from sitecast.sources.tables import scatter_key

MILLE = 1_000


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows ``(feature, mean, std)``; population deviation, 1 where it is 0."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    return _rows(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"m{i}").alias("mean"),
                F.when(F.col(f"s{i}") == 0, 1.0).otherwise(F.col(f"s{i}")).alias("std"),
            )
            for i, c in enumerate(cols)
        ],
    )


def scaler_dict(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """The scaler as literals; it has one row per feature."""
    return {r["feature"]: (r["mean"], r["std"]) for r in scaler.collect()}


def apply_scaler(df: DataFrame, scaler: DataFrame | dict[str, tuple[float, float]]) -> DataFrame:
    """Replace each feature by (x - mean) / std of the fitted table."""
    fitted = scaler if isinstance(scaler, dict) else scaler_dict(scaler)
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - F.lit(m).cast("double")) / F.lit(s).cast("double")
            for c, (m, s) in fitted.items()
        }
    )


def hash_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42, out: str = "is_train") -> DataFrame:
    """A split that depends on the key alone, so any partitioning gives the same one."""
    return df.withColumn(out, F.pmod(scatter_key(df, key, seed), F.lit(MILLE)) < int(ratio * MILLE))


def assign_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.pmod(scatter_key(df, key, seed), F.lit(k)).cast("int"))
