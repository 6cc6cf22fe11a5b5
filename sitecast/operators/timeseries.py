"""Resampling, moving averages, decomposition, sequences and time splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.operators.ordering import OWN, POS, framed, with_positions
from sitecast.sources.tables import date_spine


def resample_mean(df: DataFrame, ts: str, col: str, unit: str = "month") -> DataFrame:
    """Mean per calendar period, empty periods kept: ``(period, label, value)``.

    ``label`` is the last day of a month, or the day itself.
    """
    start = F.date_trunc(unit, F.col(ts)).cast("date")
    means = df.filter(F.col(ts).isNotNull()).groupBy(start.alias("period")).agg(F.avg(col).alias("value"))
    first, last = df.agg(F.min(start), F.max(start)).first()
    if first is None:
        spine = means.select("period")
    else:
        spine = date_spine(df.sparkSession, first, last, "period", unit)
    label = F.last_day("period") if unit == "month" else F.col("period")
    return spine.join(means, "period", "left").select("period", label.alias("label"), "value")


def rolling_mean(df: DataFrame, order: Sequence[str], col: str, n: int, out: str = "moving_average", partition: Sequence[str] = ()) -> DataFrame:
    """Mean of the last ``n`` rows; NULL unless all ``n`` values are known."""
    rows, w, _ = framed(df, list(partition), [F.col(c) for c in order], back=n - 1)
    frame = w.rowsBetween(-(n - 1), 0)
    value = F.when(F.count(col).over(frame) == n, F.avg(col).over(frame))
    return rows.withColumn(out, value).filter(OWN).select(*df.columns, out)


def seasonal_decompose(df: DataFrame, order: Sequence[str], col: str, period: int = 12) -> DataFrame:
    """Additive trend, seasonal and residual parts of one series.

    Periods without a value are left out first.  The trend is the centred mean
    over one period (over an even period, the mean of its two nearest frames);
    the seasonal part is the mean distance from the trend per phase, less the
    mean of those means.
    """
    known = df.filter(F.col(col).isNotNull())
    n = known.count()
    if n < 2 * period:
        raise ValueError(f"decomposition needs {2 * period} values, got {n}")
    half = period // 2
    rows, w, _ = framed(known.select(*order, col), [], [F.col(c) for c in order], back=half, ahead=half)

    def full_mean(lo: int, hi: int) -> Column:
        frame = w.rowsBetween(lo, hi)
        return F.when(F.count(col).over(frame) == hi - lo + 1, F.avg(col).over(frame))

    if period % 2:
        trend = full_mean(-half, half)
    else:
        trend = (full_mean(-half, half - 1) + full_mean(-half + 1, half)) / 2
    parts = (
        rows.withColumn("trend", trend)
        .filter(OWN)
        .select(*order, F.col(col).alias("observed"), "trend", F.pmod(POS, F.lit(period)).alias("_phase"))
    )
    by_phase = parts.groupBy("_phase").agg(F.avg(F.col("observed") - F.col("trend")).alias("m")).collect()
    mean = sum(r["m"] for r in by_phase) / len(by_phase)
    season = F.create_map(*[x for r in by_phase for x in (F.lit(r["_phase"]), F.lit(r["m"] - mean))])
    return parts.withColumn("seasonal", season[F.col("_phase")]).select(
        *order, "observed", "trend", "seasonal", (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("residual")
    )


def _sequences(df, features, targets, seq_len, stride, partition, order, next_target):
    keys = list(partition or [])
    missing = [c for c in [*features, *targets] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    cols = list(dict.fromkeys([*keys, *order, *features, *targets]))
    rows, w, placed = framed(
        df.select(*cols), keys, [F.col(c) for c in order], back=seq_len - 1, ahead=1 if next_target else 0
    )
    back = w.rowsBetween(-(seq_len - 1), 0)
    point = F.array(*[F.col(f).cast("double") for f in features])
    y = F.array(*[F.col(t).cast("double") for t in targets])
    windows = rows.withColumns(
        {
            "x": F.collect_list(point).over(back),
            "y": F.lead(y, 1).over(w) if next_target else y,
        }
    ).filter(F.col(OWN) & (F.size("x") == seq_len) & F.col("y").isNotNull())
    ends = [F.col(c).alias(f"end_{c}") for c in order if c not in keys]
    out = windows.select(*keys, *ends, (F.col(POS) - (seq_len - 1)).alias("_start"), "x", "y")
    if keys:
        origin = placed.groupBy(*keys).agg(F.min(POS).alias("_origin"))
        out = out.join(origin, keys)
    else:
        out = out.withColumn("_origin", F.lit(0))
    start = F.col("_start") - F.col("_origin")
    out = out.withColumn("start", start.cast("long")).filter(F.pmod(F.col("start"), F.lit(stride)) == 0)
    return out.select(*keys, "start", *[f"end_{c}" for c in order if c not in keys], "x", "y")


def make_sequences(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    seq_len: int = 7,
    stride: int = 1,
    partition: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Windows of ``seq_len`` rows with the targets of their last row.

    ``(partition..., start, end_order..., x, y)``: ``x`` holds one feature array
    per row.  Windows stay inside a partition; without one the whole table is a
    single series in ``order``, which must be a total order.
    """
    return _sequences(df, features, targets, seq_len, stride, partition, order, next_target=False)


def make_forecast_sequences(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    seq_len: int = 10,
    partition: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Windows of ``seq_len`` rows with the target of the row after them."""
    return _sequences(df, features, [target], seq_len, 1, partition, order, next_target=True)


def series_by_category(df: DataFrame, date: str, value: str, category: str | None = None) -> DataFrame:
    """Points of each series in date order."""
    keys = [category] if category else []
    return df.select(*keys, date, value).orderBy(*keys, date)


def time_split(df: DataFrame, order: Sequence[str], ratio: float = 0.8, out: str = "split") -> DataFrame:
    """Mark the first ``floor(ratio * n)`` rows in time as ``train``, the rest ``validation``.

    ``order`` must be a total order without NULLs.  Only its columns are sorted;
    the row at the boundary then becomes a plain comparison on the table.
    """
    n = df.count()
    cut = int(n * ratio)
    if cut == 0:
        return df.withColumn(out, F.lit("validation"))
    placed = with_positions(df.select(*order), [F.col(c) for c in order])
    edge = placed.filter(F.col(POS) == cut - 1).select(*[F.col(c).cast("string") for c in order]).first()
    limits = [F.lit(edge[c]).cast(df.schema[c].dataType) for c in order]
    within = reduce(
        lambda later, cl: (F.col(cl[0]) < cl[1]) | ((F.col(cl[0]) == cl[1]) & later),
        reversed(list(zip(order, limits))),
        F.lit(True),
    )
    return df.withColumn(out, F.when(within, "train").otherwise("validation"))
