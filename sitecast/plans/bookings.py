"""Booking tables: cleaning, then features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sitecast.functions.bookings import guest_features, interaction_features, lead_time_band, price_ratio, stay_features
from sitecast.functions.dates import SEASONS, compose_date, date_parts, month_number, season_features
from sitecast.functions.encoding import index_category, one_hot
from sitecast.operators.cleaning import cap_quantile, clamp_negative, deduplicate, impute_median, impute_mode
from sitecast.operators.columns import columns_by_kind, require
from sitecast.operators.summary import null_columns

DATE_PARTS = ["arrival_date_year", "arrival_date_month", "arrival_date_day_of_month"]


def preprocess_bookings(df: DataFrame) -> DataFrame:
    """Impute, clamp and cap the price, repair dates, derive stay and guest columns, drop copies.

    A step whose columns are absent is skipped.  The statistics take several
    column-pruned passes, so give a stored table rather than a costly plan.
    """
    kinds = columns_by_kind(df)
    holed = set(null_columns(df, kinds["numeric"] + kinds["categorical"]))
    out = impute_mode(
        impute_median(df, [c for c in kinds["numeric"] if c in holed]), [c for c in kinds["categorical"] if c in holed]
    )
    if require(out, ["adr"], strict=False):
        out = cap_quantile(clamp_negative(out, "adr"), "adr", 0.999)
    if require(out, ["arrival_date_month"], strict=False):
        out = out.withColumn("arrival_date_month_num", month_number("arrival_date_month"))
    if require(out, DATE_PARTS, strict=False):
        out = out.withColumn(
            "arrival_date",
            compose_date("arrival_date_year", "arrival_date_month_num", "arrival_date_day_of_month"),
        ).withColumns(date_parts("arrival_date"))
    if require(out, ["stays_in_weekend_nights", "stays_in_week_nights"], strict=False):
        out = out.withColumns(stay_features())
    if require(out, ["adults", "children", "babies"], strict=False):
        out = out.withColumns(guest_features())
    return deduplicate(out)


def create_features(
    df: DataFrame, customer_types: Sequence[str] | None = None, market_segments: Sequence[str] | None = None
) -> DataFrame:
    """Lead-time band, price ratio, one-hot columns, season and total price.

    A column per value needs the list of values; without it the category becomes
    its index among the sorted values (``customer_type_code``).
    """
    out = df
    if require(out, ["lead_time"], strict=False):
        out = out.withColumn("lead_time_group", lead_time_band("lead_time"))
    if require(out, ["adr", "arrival_date_month", "hotel"], strict=False):
        out = price_ratio(out)
    if require(out, ["customer_type"], strict=False):
        out = one_hot(out, "customer_type", "customer", customer_types) if customer_types else index_category(out, "customer_type")
    if require(out, ["market_segment"], strict=False):
        out = one_hot(out, "market_segment", "market", market_segments) if market_segments else index_category(out, "market_segment")
    if require(out, ["arrival_date_month_num"], strict=False):
        out = out.withColumns(season_features("arrival_date_month_num"))
        out = one_hot(out, "season", "season", sorted(SEASONS))
    return interaction_features(out)
