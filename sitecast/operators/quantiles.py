"""Exact interpolated quantiles of very large columns.

The built-in exact percentile keeps every distinct value of a group in one
task.  Here a mergeable sketch of fixed size brackets each wanted order
statistic, one pass counts the rows below the bracket and inside it, and both
are repeated inside the bracket until it holds few rows.  Only those are counted
by value to find the statistic itself.  The answer is exact; the sketches only
decide how much is looked at.  Each round cuts a bracket to about a thousandth.

Only scalars reach the driver: one row of sketch results, one row of counts, and
one row per wanted quantile.  They go back into plans as literals, which keeps
those plans flat and lets a comparison with a quantile be pushed to the scan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
#: Rows that a bracket may hold when it is counted by value.
INSIDE_ROWS = 2_000


@dataclass
class _Bracket:
    """Rows of column ``col`` from ``lo`` to ``hi``: ``inside`` of them, after ``below`` others."""

    key: tuple[str, float]
    col: str
    at: float
    lo: float
    hi: float
    below: int
    inside: int

    def rows(self):
        return F.when(F.col(self.col).between(self.lo, self.hi), F.col(self.col))

    def share(self) -> float:
        """Place of the statistic among the rows inside."""
        return (self.at - self.below) / max(self.inside - 1, 1)


def _narrow(base: DataFrame, brackets: list[_Bracket], accuracy: int) -> bool:
    """Shrink each bracket by one sketch and one count; whether any became smaller.

    A side on which the sketch missed the statistic keeps its old end.
    """
    margin = 5 / accuracy
    ends = [[min(max(b.share() + d, 0.0), 1.0) for d in (-margin, margin)] for b in brackets]
    sketch = base.agg(*[F.percentile_approx(b.rows(), e, accuracy).alias(f"p{t}") for t, (b, e) in enumerate(zip(brackets, ends))]).first()
    tried = []
    for t, (b, (first, last)) in enumerate(zip(brackets, ends)):
        tried.append((b.lo if first == 0 else sketch[f"p{t}"][0], b.hi if last == 1 else sketch[f"p{t}"][1]))
    counted = base.agg(
        *[F.count_if(F.col(b.col) < lo).alias(f"b{t}") for t, (b, (lo, _)) in enumerate(zip(brackets, tried))],
        *[F.count_if(F.col(b.col) <= hi).alias(f"u{t}") for t, (b, (_, hi)) in enumerate(zip(brackets, tried))],
    ).first()
    smaller = False
    for t, (b, (lo, hi)) in enumerate(zip(brackets, tried)):
        before, upto = counted[f"b{t}"], counted[f"u{t}"]
        if before > math.floor(b.at):
            lo, before = b.lo, b.below
        if upto <= math.ceil(b.at):
            hi, upto = b.hi, b.below + b.inside
        smaller |= upto - before < b.inside
        b.lo, b.hi, b.below, b.inside = lo, hi, before, upto - before
    return smaller


def quantile_values(
    df: DataFrame,
    wanted: dict[str, list[float]],
    accuracy: int = ACCURACY,
    inside_rows: int = INSIDE_ROWS,
) -> dict[tuple[str, float], float | None]:
    """``{(column, q): value}`` for every wanted quantile, all columns at once."""
    cols = list(wanted)
    base = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    whole = base.agg(
        *[f(f"c{i}").alias(f"{n}{i}") for i in range(len(cols)) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    ).first()
    out: dict[tuple[str, float], float | None] = {}
    brackets = []
    for i, c in enumerate(cols):
        n = whole[f"n{i}"]
        for q in wanted[c]:
            out[c, q] = None
            if n:
                brackets.append(_Bracket((c, q), f"c{i}", q * (n - 1), whole[f"lo{i}"], whole[f"hi{i}"], 0, n))

    # A bracket that holds one value, however many rows share it, needs no look inside.
    while wide := [b for b in brackets if b.lo < b.hi and b.inside > inside_rows]:
        if not _narrow(base, wide, accuracy):
            break  # a few values with very many rows each
    for b in brackets:
        if b.lo == b.hi:
            out[b.key] = b.lo
    left = [b for b in brackets if b.lo < b.hi]
    if not left:
        return out

    inside = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.lit(b.at).alias("at"), F.lit(b.below).cast("long").alias("below"), b.rows().alias("v"))
            for t, b in enumerate(left)
        ]
    )
    # The brackets go to the scan as a filter, so most rows never build the array.
    anywhere = reduce(lambda a, b: a | b, [F.col(b.col).between(b.lo, b.hi) for b in left])
    near = (
        base.filter(anywhere)
        .select(F.inline(inside))
        .filter(F.col("v").isNotNull())
        .groupBy("t", "at", "below", "v")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    running = Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    picked = (
        near.withColumn("upto", F.col("below") + F.sum("cnt").over(running))
        .groupBy("t")
        .agg(
            F.min(F.when(F.col("upto") > F.floor("at"), F.col("v"))).alias("x0"),
            F.min(F.when(F.col("upto") > F.ceil("at"), F.col("v"))).alias("x1"),
        )
        .collect()
    )
    for r in picked:
        b = left[r["t"]]
        out[b.key] = r["x0"] + (r["x1"] - r["x0"]) * (b.at - math.floor(b.at))
    return out


def quantiles(df: DataFrame, col: str, qs: list[float]) -> DataFrame:
    """Rows ``(q, value)`` of exact, linearly interpolated quantiles."""
    found = quantile_values(df, {col: list(qs)})
    rows = [(float(q), found[col, q]) for q in qs]
    return df.sparkSession.createDataFrame(rows, "q double, value double")


def iqr_bounds(df: DataFrame, col: str, k: float) -> tuple[float | None, float | None]:
    """(Q1 - k*IQR, Q3 + k*IQR)."""
    found = quantile_values(df, {col: [0.25, 0.75]})
    q1, q3 = found[col, 0.25], found[col, 0.75]
    if q1 is None:
        return None, None
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)
