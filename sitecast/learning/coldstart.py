"""Forecast rows for a hotel without history, from the hotels most like it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sitecast.learning.splits import apply_scaler, fit_scaler
from sitecast.operators.cleaning import first_per_key
from sitecast.operators.joins import dense_index, nearest, semi_filter
from sitecast.operators.ranking import append_mean_row, append_predictions
from sitecast.operators.summary import group_means
from sitecast.session import materialize

# The static features that decide likeness.
STATIC_FEATURES = [
    "hotel", "city", "poi_restaurant_count", "poi_park_count", "poi_shopping_count", "distance_to_city_center",
]


def similar_hotels(
    df: DataFrame, hotel_id: str, hotel_features: dict, order: Sequence[Column], features: Sequence[str] = STATIC_FEATURES, k: int = 5
) -> DataFrame:
    """Rows ``(hotel, distance, rank)`` of the ``k`` nearest known hotels.

    Text features become indexes among the sorted values of the known hotels and
    the new one; all features are scaled by the known hotels.  A known hotel that
    lacks a feature is no neighbour; a new hotel that lacks one is refused.
    """
    used = [c for c in features if c in df.columns]
    if not used:
        raise ValueError("no static feature is present")
    # One row per hotel from here on: the history is read once.
    known = materialize(first_per_key(df, ["hotel"], order).select(*used))
    values = [hotel_id if c == "hotel" else hotel_features.get(c) for c in used]
    new = df.sparkSession.createDataFrame([tuple(values)], known.schema)
    both = known.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    text = [c for c in used if isinstance(df.schema[c].dataType, StringType)]
    for c in text:
        both = dense_index(both, c, f"{c}_code")
    numbers = [c for c in used if c not in text] + [f"{c}_code" for c in text]
    scaler = fit_scaler(both.filter(~F.col("_new")), numbers)
    scaled = materialize(apply_scaler(both, scaler))
    new_row = scaled.filter("_new").select(*numbers).first()
    near = nearest(scaled.filter(~F.col("_new")), {c: new_row[c] for c in numbers}, k, "hotel")
    return near.select("hotel", "distance", "rank")


def cold_start(
    df: DataFrame, hotel_id: str, hotel_features: dict, order: Sequence[Column], features: Sequence[str] = STATIC_FEATURES, k: int = 5
) -> DataFrame:
    """History plus predicted rows for the new hotel, marked ``is_prediction``.

    The predictions are the similar hotels' means per (month, customer type), or
    one overall mean row when those columns are absent.
    """
    near = similar_hotels(df, hotel_id, hotel_features, order, features, k)
    similar = semi_filter(df, near.select("hotel"), "hotel")
    groups = ["arrival_date_month", "customer_type"]
    if not set(groups) <= set(df.columns):
        return append_mean_row(df, similar, hotel_id)
    means = group_means(similar, groups, exclude=["hotel_id"]).withColumn("hotel", F.lit(hotel_id))
    return append_predictions(df, means)
