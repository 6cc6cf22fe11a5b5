"""Candidate sites: joined sources, features, and the ranked shortlist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sitecast.functions.encoding import BASIC_WEIGHTS, weighted_score
from sitecast.functions.locations import competition_index, economic_index, poi_density, total_poi, transport_score
from sitecast.operators.columns import require
from sitecast.operators.joins import count_pois_within, join_location_sources
from sitecast.operators.ranking import top_ranked
from sitecast.session import materialize


def create_location_features(poi: DataFrame, dist: DataFrame, census: DataFrame, comp: DataFrame) -> DataFrame:
    """Left-join chain and derived location columns; a step without its columns is skipped."""
    out = total_poi(join_location_sources(poi, dist, census, comp))
    if require(out, ["total_poi_count", "area_km2"], strict=False):
        out = poi_density(out)
    out = transport_score(out)
    if require(out, ["income_per_capita", "unemployment_rate"], strict=False):
        out = economic_index(out)
    if require(out, ["competitor_count", "total_poi_count"], strict=False):
        out = competition_index(out)
    return out


def site_shortlist(
    sites: DataFrame,
    pois: DataFrame,
    dist: DataFrame,
    census: DataFrame,
    comp: DataFrame,
    amenities: Sequence[str] | None = None,
    weights=BASIC_WEIGHTS,
    n: int = 10,
    radius_km: float = 1.0,
    **grid,
) -> DataFrame:
    """Points of interest around each site, features, weighted score, rank, best ``n``.

    Counts and features are stored once: the joins need the repeats of a location
    before its rows, the score needs the features' span before the values.
    """
    counted = materialize(count_pois_within(sites, pois, radius_km, amenities, **grid))
    features = materialize(create_location_features(counted, dist, census, comp))
    return top_ranked(weighted_score(features, weights), "score", n, "location_id")
