"""Filling, clamping, outliers and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecast.operators.columns import columns_by_kind
from sitecast.operators.ordering import prefixed
from sitecast.operators.quantiles import iqr_bounds, quantile_values
from sitecast.operators.summary import modes, null_columns


def _filled(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Fill as double: a median or mean of whole numbers need not be whole."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double")) for c, v in values.items()}
    )


def impute_median(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL to the exact median; by default in the numeric columns that hold one."""
    cols = list(cols) if cols is not None else null_columns(df, columns_by_kind(df)["numeric"])
    if not cols:
        return df
    found = quantile_values(df, {c: [0.5] for c in cols})
    return _filled(df, {c: found[c, 0.5] for c in cols})


def impute_mode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL to the most frequent value (ties: smallest); by default where a string column holds one."""
    cols = list(cols) if cols is not None else null_columns(df, columns_by_kind(df)["categorical"])
    if not cols:
        return df
    top = modes(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(top[c]).cast("string")) for c in cols})


def impute_adaptive(df: DataFrame, cols: Sequence[str] | None = None, share: float = 0.05) -> DataFrame:
    """NULL to the median where high outliers are common, else to the mean.

    Common means more than ``share`` of all rows above Q3 + 1.5 IQR.
    """
    cols = list(cols) if cols is not None else null_columns(df, columns_by_kind(df)["numeric"])
    if not cols:
        return df
    q = quantile_values(df, {c: [0.25, 0.5, 0.75] for c in cols})
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        q1, q3 = q[c, 0.25], q[c, 0.75]
        high = F.lit(None).cast("boolean") if q1 is None else F.col(c) > q3 + 1.5 * (q3 - q1)
        aggs += [F.count_if(high).alias(f"h{i}"), F.avg(c).alias(f"m{i}")]
    row = df.agg(*aggs).first()
    return _filled(
        df, {c: q[c, 0.5] if row[f"h{i}"] > row["n"] * share else row[f"m{i}"] for i, c in enumerate(cols)}
    )


def fill_forward_backward(df: DataFrame, cols: Sequence[str], partition: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last known value before each gap, else the first known value after it."""
    specs = {}
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).alias("v")))
        specs[f"_f_{c}"] = ("max", known, "upto")
        specs[f"_b_{c}"] = ("min", known, "from")
    out = prefixed(df, partition, order, specs)
    return out.withColumns(
        {c: F.coalesce(F.col(f"_f_{c}.v"), F.col(f"_b_{c}.v")) for c in cols}
    ).drop(*specs)


def fill_constant(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, subset=list(cols) if cols else None)


def clamp_negative(df: DataFrame, col: str) -> DataFrame:
    zero = F.lit(0).cast(df.schema[col].dataType)
    return df.withColumn(col, F.when(F.col(col) < 0, zero).otherwise(F.col(col)))


def cap_quantile(df: DataFrame, col: str, q: float = 0.999) -> DataFrame:
    """Values above the quantile become the quantile; NULL stays NULL."""
    top = quantile_values(df, {col: [q]})[col, q]
    v = F.col(col).cast("double")
    return df.withColumn(col, F.when(v > F.lit(top).cast("double"), F.lit(top).cast("double")).otherwise(v))


def _outside(col: str, lo: float | None, hi: float | None) -> Column:
    v = F.col(col)
    return F.coalesce((v < F.lit(lo).cast("double")) | (v > F.lit(hi).cast("double")), F.lit(False))


def flag_outliers_iqr(df: DataFrame, col: str, k: float = 1.5, out: str = "is_outlier") -> DataFrame:
    """True outside [Q1 - k IQR, Q3 + k IQR]; NULL is never an outlier."""
    return df.withColumn(out, _outside(col, *iqr_bounds(df, col, k)))


def flag_outliers_zscore(df: DataFrame, col: str, t: float, out: str = "is_outlier") -> DataFrame:
    """True where the distance from the mean exceeds ``t`` population deviations."""
    mean, std = df.agg(F.avg(col), F.stddev_pop(col)).first()
    z = F.abs(F.col(col) - F.lit(mean).cast("double")) / F.lit((std or 0.0) + 1e-10)
    return df.withColumn(out, F.coalesce(z > t, F.lit(False)))


def winsorize(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Values beyond the IQR fences move to the fence; NULL stays NULL."""
    lo, hi = (F.lit(b).cast("double") for b in iqr_bounds(df, col, k))
    v = F.col(col).cast("double")
    return df.withColumn(col, F.when(v < lo, lo).when(v > hi, hi).otherwise(v))


def remove_outliers(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    return df.filter(~_outside(col, *iqr_bounds(df, col, k)))


def log_outliers(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Logarithm of the outliers only.

    When the smallest value is not positive, the whole column first moves up by
    its size plus one; which rows are outliers is decided before that.
    """
    lo, hi = iqr_bounds(df, col, k)
    least = df.agg(F.min(F.col(col).cast("double"))).first()[0]
    shift = abs(least) + 1 if least is not None and least <= 0 else 0.0
    moved = F.col(col).cast("double") + shift
    return df.withColumn(col, F.when(_outside(col, lo, hi), F.log(moved)).otherwise(moved))


def deduplicate(df: DataFrame) -> DataFrame:
    """One of each full-row copy; NULL equals NULL."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and the difference, with copies merged before the shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct")
    ).select("*", (F.col("total") - F.col("distinct")).alias("duplicates"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; ``order`` must end in a unique tie-breaker.

    Spark limits each group before the shuffle, so a hot key sends one row per
    task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
