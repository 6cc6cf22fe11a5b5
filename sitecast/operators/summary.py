"""Aggregates and summary tables.  All columns of a table share one pass."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.operators.columns import any_null, columns_by_kind
from sitecast.operators.ordering import prefixed, with_positions
from sitecast.operators.quantiles import quantile_values


def _rows(one: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn a one-row table into long rows."""
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _numeric(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols is not None else columns_by_kind(df)["numeric"]


def null_profile(df: DataFrame) -> DataFrame:
    """Rows ``(column, nulls, percent)``; percent has two decimals."""
    one = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"x{i}") for i, c in enumerate(df.columns)]
    )
    return _rows(
        one,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"x{i}").alias("nulls"),
                F.round(F.try_divide(F.col(f"x{i}") * 100.0, F.col("n")), 2).alias("percent"),
            )
            for i, c in enumerate(df.columns)
        ],
    )


def null_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns among ``cols`` that hold a NULL (one row reaches the driver)."""
    if not cols:
        return []
    row = df.agg(*[F.bool_or(F.col(c).isNull()).alias(f"x{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[i]]


def high_null_columns(df: DataFrame, ratio: float = 0.3) -> DataFrame:
    """Rows ``(column, null_ratio)`` of the columns above a NULL ratio."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"x{i}") for i, c in enumerate(df.columns)])
    long = _rows(one, [F.struct(F.lit(c).alias("column"), F.col(f"x{i}").alias("null_ratio")) for i, c in enumerate(df.columns)])
    return long.filter(F.col("null_ratio") > ratio)


def null_by_time(df: DataFrame, time_col: str) -> DataFrame:
    """Rows and NULL-bearing rows per time value."""
    return (
        df.withColumn("_any", any_null(df))
        .filter(F.col(time_col).isNotNull())
        .groupBy(time_col)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("_any").alias("with_null"))
    )


def _unbiased(n: Column, skew: Column, excess: Column) -> tuple[Column, Column]:
    """Population skewness and excess kurtosis corrected for sample size."""
    root = F.when(n > 2, F.sqrt(n * (n - 1.0)) / (n - 2.0))
    lead = F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)))
    return root * skew, lead * ((n + 1.0) * excess + 6.0)


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean, median, std, min, max, skew, kurtosis and missing per numeric column."""
    cols = _numeric(df, cols)
    medians = quantile_values(df, {c: [0.5] for c in cols})
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
            F.skewness(v).alias(f"g{i}"),
            F.kurtosis(v).alias(f"k{i}"),
        ]

    def row(i: int, c: str) -> Column:
        skew, kurt = _unbiased(F.col(f"n{i}").cast("double"), F.col(f"g{i}"), F.col(f"k{i}"))
        return F.struct(
            F.lit(c).alias("column"),
            F.col(f"mean{i}").alias("mean"),
            F.lit(medians[c, 0.5]).cast("double").alias("median"),
            F.col(f"std{i}").alias("std"),
            F.col(f"min{i}").alias("min"),
            F.col(f"max{i}").alias("max"),
            skew.alias("skew"),
            kurt.alias("kurtosis"),
            (F.col("n") - F.col(f"n{i}")).alias("missing"),
        )

    return _rows(df.agg(*aggs), [row(i, c) for i, c in enumerate(cols)])


def _counted_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, count)`` of several string columns in one pass.

    Copies of a value are merged before the shuffle, so a hot value costs one
    row per task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return (
        df.select(F.explode(pairs).alias("p"))
        .groupBy("p.column", "p.value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def categorical_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values, top value (ties: smallest), its count, and missing."""
    cols = list(cols) if cols is not None else columns_by_kind(df)["categorical"]
    known = F.col("value").isNotNull()
    return (
        _counted_values(df, cols)
        .groupBy("column")
        .agg(
            F.count("value").alias("unique_values"),
            F.min_by("value", F.when(known, F.struct(-F.col("count"), F.col("value")))).alias("top_value"),
            F.coalesce(F.max(F.when(known, F.col("count"))), F.lit(0)).cast("long").alias("top_freq"),
            F.coalesce(F.sum(F.when(~known, F.col("count"))), F.lit(0)).cast("long").alias("missing"),
        )
    )


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """The most frequent value of each string column, ties to the smallest."""
    rows = categorical_summary(df, cols).select("column", "top_value").collect()
    return {r["column"]: r["top_value"] for r in rows}


def datetime_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """First and last value, whole days between, and missing, per date column."""
    cols = list(cols) if cols is not None else columns_by_kind(df)["datetime"]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        v = F.col(c).cast("timestamp")
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.count(v).alias(f"n{i}")]
    day = 86_400
    return _rows(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"lo{i}").alias("min_date"),
                F.col(f"hi{i}").alias("max_date"),
                F.floor((F.unix_micros(f"hi{i}") - F.unix_micros(f"lo{i}")) / (day * 1_000_000)).alias("range_days"),
                (F.col("n") - F.col(f"n{i}")).alias("missing"),
            )
            for i, c in enumerate(cols)
        ],
    )


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max per numeric column."""
    cols = _numeric(df, cols)
    qs = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    found = quantile_values(df, {c: list(qs) for c in cols})
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"count{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
    return _rows(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"{s}{i}").alias(s) for s in ("count", "mean", "std", "min")],
                *[F.lit(found[c, q]).cast("double").alias(name) for q, name in qs.items()],
                F.col(f"max{i}").alias("max"),
            )
            for i, c in enumerate(cols)
        ],
    )


def group_means(df: DataFrame, keys: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Mean of every numeric column per group; rows with a NULL key are left out."""
    cols = [c for c in columns_by_kind(df)["numeric"] if c not in keys and c not in exclude]
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def column_means_ranked(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(column, mean)``, largest mean first."""
    cols = _numeric(df, cols)
    one = df.agg(*[F.avg(c).alias(f"x{i}") for i, c in enumerate(cols)])
    long = _rows(one, [F.struct(F.lit(c).alias("column"), F.col(f"x{i}").alias("mean")) for i, c in enumerate(cols)])
    return long.orderBy(F.desc_nulls_last("mean"), "column")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows ``(value, count)`` pooled over one or several columns, most frequent first."""
    return (
        df.select(F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(column_a, column_b, correlation)`` for each pair of columns.

    Pairwise complete: a row counts for a pair when both its cells are known.
    Only the lower triangle is kept.
    """
    cols = _numeric(df, cols)
    pairs = [(b, a) for a, b in combinations(cols, 2)]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"x{i}") for i, (a, b) in enumerate(pairs)])
    return _rows(
        one,
        [
            F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"x{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ],
    )


def target_correlations(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Correlation of each other numeric column with the target, largest first."""
    cols = [c for c in _numeric(df, cols) if c != target]
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    long = _rows(one, [F.struct(F.lit(c).alias("column"), F.col(f"x{i}").alias("correlation")) for i, c in enumerate(cols)])
    return long.orderBy(F.desc_nulls_last("correlation"), "column")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins ``(bin, lower, upper, count)``; the last bin is closed.

    A constant column gets unit width, half on either side, as is usual.
    """
    v = F.col(col).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return spine.select("bin", *[F.lit(None).cast("double").alias(c) for c in ("lower", "upper")], F.lit(0).cast("long").alias("count"))
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    counted = (
        df.filter(v.isNotNull())
        .groupBy(F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return spine.join(counted, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("lower"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )


def histograms(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """``histogram`` of many columns in two passes: ``(column, bin, lower, upper, count)``."""
    base = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    spans = base.agg(*[f(f"c{i}").alias(f"{n}{i}") for i in range(len(cols)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    rows, parts = [], []
    for i, c in enumerate(cols):
        lo, hi = spans[f"lo{i}"], spans[f"hi{i}"]
        if lo is not None and lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        width = None if lo is None else (hi - lo) / bins
        rows += [(i, c, k, None if lo is None else lo + k * width, None if lo is None else lo + (k + 1) * width) for k in range(bins)]
        if lo is not None:
            place = F.least(F.floor((F.col(f"c{i}") - lo) / width), F.lit(bins - 1)).cast("int")
            at = F.when(F.col(f"c{i}").isNotNull(), place)  # least() passes over NULL
            parts.append(F.struct(F.lit(i).alias("i"), at.alias("bin")))
    spine = df.sparkSession.createDataFrame(rows, "i int, column string, bin int, lower double, upper double")
    if not parts:
        return spine.select("column", "bin", "lower", "upper", F.lit(0).cast("long").alias("count"))
    counted = base.select(F.inline(F.array(*parts))).filter(F.col("bin").isNotNull()).groupBy("i", "bin").agg(F.count(F.lit(1)).alias("count"))
    return spine.join(counted, ["i", "bin"], "left").select("column", "bin", "lower", "upper", F.coalesce("count", F.lit(0)).alias("count"))


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] | None = None) -> DataFrame:
    """MSE, RMSE, MAE and R2 of (actual, predicted) pairs, whole or per group."""
    pairs = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    e = F.col(y) - F.col(yhat)
    agg = pairs.groupBy(*(by or [])).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(y).alias("_var"), F.count(F.lit(1)).alias("n")
    )
    return agg.select(
        *(by or []),
        "n",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"),
    )


def combined_loss(df: DataFrame, y: str, yhat: str, epsilon: float = 1e-8) -> DataFrame:
    """0.5 MSE + 0.3 smooth L1 + 0.2 squared log error, as one row.

    A pair whose logarithm does not exist makes the log term NULL, and with it
    the combined value, instead of a silent NaN.
    """
    e = F.col(yhat) - F.col(y)
    a = F.abs(e)
    logs = [F.when(F.col(c) + epsilon > 0, F.log(F.col(c) + epsilon)) for c in (yhat, y)]
    sq = F.pow(logs[0] - logs[1], 2.0)
    bad = F.count_if(sq.isNull())
    agg = df.agg(
        F.avg(e * e).alias("mse"),
        F.avg(F.when(a < 1, 0.5 * e * e).otherwise(a - 0.5)).alias("smooth_l1"),
        F.when(bad == 0, F.avg(sq)).alias("msle"),
    )
    return agg.select("*", (0.5 * F.col("mse") + 0.3 * F.col("smooth_l1") + 0.2 * F.col("msle")).alias("combined"))


def cv_summary(metrics: DataFrame) -> DataFrame:
    """Mean and population spread of each metric over folds."""
    return metrics.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, rows out, percent kept; each side is only counted."""
    sides = before.select(F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(after.select(F.lit(0), F.lit(1)))
    return sides.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("o"), F.lit(0)).alias("rows_out")
    ).select("*", F.round(F.try_divide(F.col("rows_out") * 100.0, F.col("rows_in")), 2).alias("percent"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).filter(F.col(col).isNotNull()).distinct()


def early_stop(history: DataFrame, patience: int, run: Sequence[str] = ("run",), epoch: str = "epoch", loss: str = "loss") -> DataFrame:
    """Best and last epoch of each run under a patience rule.

    An epoch improves when its loss is strictly below every earlier one, so the
    last improvement up to an epoch is the first place of the lowest loss so far:
    a running minimum over (loss, place).  The run stops after ``patience`` epochs
    in a row without improvement, counted by row whatever their numbers; a NULL
    loss is no improvement, also before the first one.
    """
    keys = list(run)
    placed = with_positions(history.select(*keys, epoch, loss), [F.col(c) for c in [*keys, epoch]], "_place")
    whole = placed.withColumn("_run", F.struct(F.lit(0), *keys))
    starts = whole.groupBy("_run").agg(F.min("_place").alias("_first"))
    rows = whole.join(starts, "_run").select(*keys, epoch, loss, (F.col("_place") - F.col("_first")).alias("_i"))
    known = F.when(F.col(loss).isNotNull(), F.struct(F.col(loss).alias("l"), F.col("_i").alias("i"), F.col(epoch).alias("e")))
    lowest = prefixed(rows, keys, [F.col("_i")], {"_low": ("min", known, "upto")})
    late = F.col("_i") - F.coalesce("_low.i", F.lit(-1)) >= patience
    stop = F.when(late, F.col("_i"))
    ends = lowest.groupBy(*keys).agg(
        F.min(stop).alias("_stop"),
        F.min_by(F.struct("_low.e"), stop).alias("_best_at_stop"),
        F.min_by(epoch, stop).alias("_stop_epoch"),
        F.max_by(F.struct("_low.e"), "_i").alias("_best_overall"),
        F.max_by(epoch, "_i").alias("_final"),
    )
    stopped = F.col("_stop").isNotNull()
    return ends.select(
        *keys,
        F.when(stopped, F.col("_best_at_stop.e")).otherwise(F.col("_best_overall.e")).alias("best_epoch"),
        F.coalesce("_stop_epoch", "_final").alias("stop_epoch"),
        stopped.alias("stopped_early"),
    )
