"""Report tables: what the charts of a report are drawn from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.functions.encoding import marker_style
from sitecast.operators.columns import columns_by_kind, columns_matching
from sitecast.operators.ranking import top_n
from sitecast.operators.summary import (
    categorical_summary, column_means_ranked, datetime_summary, histograms, numeric_summary, regression_metrics, target_correlations,
)
from sitecast.operators.timeseries import resample_mean, rolling_mean, seasonal_decompose


def actual_vs_predicted(df: DataFrame, y: str = "actual", yhat: str = "prediction") -> DataFrame:
    """Each pair with its error, the ends of the ideal line, and R2 of the whole."""
    row = regression_metrics(df, y, yhat).first()
    lo, hi = df.agg(F.least(F.min(y), F.min(yhat)), F.greatest(F.max(y), F.max(yhat))).first()
    return df.select(
        F.col(y).alias("actual"),
        F.col(yhat).alias("prediction"),
        (F.col(yhat) - F.col(y)).alias("error"),
        F.lit(lo).cast("double").alias("line_min"),
        F.lit(hi).cast("double").alias("line_max"),
        F.lit(row["r2"]).cast("double").alias("r2"),
    )


DASHBOARD = ("trend", "top_locations", "feature_means", "actual_vs_predicted")


def dashboard_tables(forecasts: DataFrame, locations: DataFrame, names: Sequence[str] = DASHBOARD) -> dict[str, DataFrame]:
    """Forecast trend, best 15 sites, feature means, and actual against predicted.

    Only the tables in ``names`` are built, and those whose columns are there.
    """
    out = {}
    if "trend" in names and {"date", "prediction"} <= set(forecasts.columns):
        trend = [c for c in ("date", "prediction", "actual") if c in forecasts.columns]
        out["trend"] = forecasts.select(*trend).orderBy(*trend)
    if "top_locations" in names and {"location_id", "predicted_score"} <= set(locations.columns):
        out["top_locations"] = top_n(locations, "predicted_score", 15, "location_id").select("location_id", "predicted_score")
    shown = list(dict.fromkeys(columns_matching(locations, prefix="poi_") + columns_matching(locations, ["distance_", "density"])))
    shown = [c for c in shown if c in columns_by_kind(locations)["numeric"]]
    if "feature_means" in names and shown:
        out["feature_means"] = column_means_ranked(locations, shown)
    if "actual_vs_predicted" in names and {"actual", "prediction"} <= set(forecasts.columns):
        out["actual_vs_predicted"] = actual_vs_predicted(forecasts)
    return out


def spatial_points(df: DataFrame, lat: str, lon: str, value: str | None = None) -> DataFrame:
    """Points with the map centre, and with colour and radius when a value is given."""
    center = df.agg(F.avg(lat), F.avg(lon)).first()
    cols = [F.col(lat).alias("lat"), F.col(lon).alias("lon")] + ([F.col(value).alias("value")] if value else [])
    points = df.select(*cols)
    if value:
        points = marker_style(points, "value")
    return points.withColumns(
        {"center_lat": F.lit(center[0]).cast("double"), "center_lon": F.lit(center[1]).cast("double")}
    )


def eda_report(df: DataFrame, target: str | None = None, bins: int = 50) -> dict[str, DataFrame]:
    """All exploratory tables, with the place and date columns found by name.

    A text column with "date" in its name is read as a date; what does not parse
    is NULL, and a column in which nothing parses stays text.
    """
    texts = [c for c in columns_by_kind(df)["categorical"] if "date" in c.lower() and dict(df.dtypes)[c] == "string"]
    if texts:
        found = df.agg(*[F.count(F.try_to_date(F.col(c))).alias(f"n{i}") for i, c in enumerate(texts)]).first()
        df = df.withColumns({c: F.try_to_date(F.col(c)) for i, c in enumerate(texts) if found[f"n{i}"]})
    kinds = columns_by_kind(df)
    out = {"numeric": numeric_summary(df), "categorical": categorical_summary(df), "distributions": histograms(df, kinds["numeric"], bins)}
    if kinds["datetime"]:
        out["datetime"] = datetime_summary(df)
    if target:
        out["correlations"] = target_correlations(df, target)
    lat = [c for c in kinds["numeric"] if "lat" in c.lower()]
    lon = [c for c in kinds["numeric"] if "lon" in c.lower()]
    if lat and lon:
        out["points"] = spatial_points(df, lat[0], lon[0], target)
    dates = kinds["datetime"] or []
    if dates and target:
        series = resample_mean(df, dates[0], target).select("period", "value")
        out["monthly"] = series
        out["moving_average"] = rolling_mean(series, ["period"], "value", 4)
        if series.filter(F.col("value").isNotNull()).count() >= 24:
            out["decomposition"] = seasonal_decompose(series, ["period"], "value", 12)
    return out


def report_tables(forecasts: DataFrame, ranked: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    """Forecast quality, best sites, and row counts of both inputs."""
    sides = forecasts.select(F.lit("forecasts").alias("table")).unionAll(ranked.select(F.lit("locations")))
    return {
        "metrics": regression_metrics(forecasts, "actual", "prediction"),
        "top_locations": top_n(ranked, "predicted_score", n, "location_id"),
        "counts": sides.groupBy("table").agg(F.count(F.lit(1)).alias("rows")),
    }
