"""Categories, ids, scaling, scores and kernels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def one_hot(df: DataFrame, col: str, prefix: str, values: Sequence[str]) -> DataFrame:
    """A boolean column ``prefix_value`` for each of ``values``; NULL is false in all.

    The values are part of the schema, so they are given and not read from the
    data; ``index_category`` takes a column with any number of them.
    """
    return df.withColumns({f"{prefix}_{v}": F.coalesce(F.col(col) == F.lit(v), F.lit(False)) for v in values})


def index_category(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Category to its index among the sorted values; NULL has none."""
    from sitecast.operators.joins import dense_index

    return dense_index(df, col, out or f"{col}_code")


def format_id(col: Column | str, prefix: str = "LOC_", width: int = 3) -> Column:
    """Fixed-width id; a number longer than the width keeps all its digits."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def row_sum(cols: Sequence[str]) -> Column:
    """Sum across columns; NULL counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def _span(df: DataFrame, col: str | Column) -> tuple[float | None, float]:
    v = F.col(col) if isinstance(col, str) else col
    lo, hi = df.agg(F.min(v.cast("double")), F.max(v.cast("double"))).first()
    width = (hi - lo) if lo is not None and hi > lo else 1.0
    return lo, width


def min_max(df: DataFrame, col: str, hi: float = 1.0, out: str | None = None) -> DataFrame:
    """Scale to 0..``hi``; a constant column becomes 0."""
    lo, width = _span(df, col)
    scaled = (F.col(col) - F.lit(lo).cast("double")) / F.lit(width) * F.lit(float(hi))
    return df.withColumn(out or f"{col}_scaled", scaled)


# Fixed values: (column, weight, divisor) of the two location scores.
ENHANCED_WEIGHTS = [
    ("poi_restaurant_count", 0.25, 1), ("poi_shopping_count", 0.15, 1), ("poi_entertainment_count", 0.15, 1),
    ("poi_transport_count", 0.20, 1), ("poi_tourist_attraction_count", 0.10, 1),
    ("poi_business_center_count", 0.15, 1), ("distance_to_city_center", -0.40, 1),
    ("distance_to_subway", -0.15, 1), ("distance_to_main_road", -0.10, 1), ("population_density", 0.08, 1000),
    ("income_per_capita", 0.12, 10000), ("unemployment_rate", -0.10, 1), ("education_level_score", 0.08, 10),
    ("competitor_count", -0.30, 1), ("competitor_avg_rating", 0.15, 1), ("noise_level", -0.10, 10),
    ("green_space_ratio", 0.08, 0.01), ("crime_rate", -0.15, 1),
]
BASIC_WEIGHTS = [
    ("poi_restaurant_count", 0.3, 1), ("poi_shopping_count", 0.2, 1), ("poi_entertainment_count", 0.2, 1),
    ("poi_transport_count", 0.3, 1), ("distance_to_city_center", -0.5, 1), ("distance_to_subway", -0.2, 1),
    ("population_density", 0.1, 1000), ("income_per_capita", 0.1, 10000), ("competitor_count", -0.3, 1),
]


def weighted_score(
    df: DataFrame, weights: Sequence[tuple[str, float, float]] = BASIC_WEIGHTS, out: str = "score"
) -> DataFrame:
    """Weighted sum of the named columns that exist, scaled to 0..100."""
    terms = [F.lit(float(w)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0)) / F.lit(float(d)) for c, w, d in weights if c in df.columns]
    if not terms:
        raise ValueError("none of the weighted columns is present")
    raw = reduce(lambda a, b: a + b, terms)
    lo, width = _span(df, raw)
    return df.withColumn(out, F.lit(100.0) * (raw - F.lit(lo).cast("double")) / F.lit(width))


def marker_style(df: DataFrame, col: str) -> DataFrame:
    """Marker colour and radius per point from the scaled value.

    Colour is ``#RR00BB`` with red falling and blue rising; radius is 5 to 15.
    """
    lo, width = _span(df, col)
    share = (F.col(col) - F.lit(lo).cast("double")) / F.lit(width)

    def two(x: Column) -> Column:
        return F.lpad(F.lower(F.hex(F.floor(x).cast("long"))), 2, "0")

    return df.withColumns(
        {
            "color": F.concat(F.lit("#"), two(255 * (1 - share)), F.lit("00"), two(255 * share)),
            "radius": 5 + share * 10,
        }
    )


def position_encoding(df: DataFrame, pos: str, d: int, base: float = 10000.0) -> DataFrame:
    """Rows ``(..., dim, code)``: sine on even and cosine on odd dimensions of a position."""
    return df.withColumn("dim", F.explode(F.sequence(F.lit(0), F.lit(d - 1)))).withColumn(
        "code",
        F.when(F.col("dim") % 2 == 0, F.sin(_angle(pos, d, base))).otherwise(F.cos(_angle(pos, d, base))),
    )


def _angle(pos: str, d: int, base: float) -> Column:
    pair = F.col("dim") - F.col("dim") % 2
    return F.col(pos) * F.exp(pair * F.lit(-math.log(base) / d))


def gaussian_weight(col: Column | str, sigma: float, delta: float) -> Column:
    """exp(-(d/sigma)^2) for distances below ``delta``, else 0."""
    v = F.col(col) if isinstance(col, str) else col
    return F.when(v < delta, F.exp(-(v * v) / (sigma * sigma))).when(v.isNotNull(), 0.0)
