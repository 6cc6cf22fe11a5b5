"""Column expressions on candidate sites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.functions.encoding import row_sum

# A distance column that names one of these counts as transport.
TRANSPORT_WORDS = ["bus", "subway", "train", "airport"]


def total_poi(df: DataFrame) -> DataFrame:
    """``total_poi_count``: sum of the point-of-interest counts."""
    cols = [c for c in df.columns if "poi_" in c]
    return df.withColumn("total_poi_count", row_sum(cols).cast("long")) if cols else df


def poi_density(df: DataFrame) -> DataFrame:
    """Points of interest per area; NULL where the area is zero."""
    return df.withColumn("poi_density", F.try_divide(F.col("total_poi_count"), F.col("area_km2")))


def transport_score(df: DataFrame) -> DataFrame:
    """Inverse distance to each kind of transport, and their sum; NULL where the distance is -1."""
    cols = [c for c in df.columns if "distance" in c and any(w in c for w in TRANSPORT_WORDS)]
    if not cols:
        return df
    inverse = {f"{c}_inv": F.try_divide(F.lit(1.0), F.col(c) + 1) for c in cols}
    out = df.withColumns(inverse)
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in inverse])
    return out.withColumn("transport_score", total)


def economic_index(df: DataFrame) -> DataFrame:
    return df.withColumn("economic_index", F.col("income_per_capita") * (1 - F.col("unemployment_rate") / 100))


def competition_index(df: DataFrame) -> DataFrame:
    return df.withColumn("competition_index", F.try_divide(F.col("competitor_count"), F.col("total_poi_count") + 1))
