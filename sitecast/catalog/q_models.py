"""Splits, scaling, cold start, regressors."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitecast.catalog.fixtures import view
from sitecast.catalog.registry import each, query, rounded
from sitecast.functions.dates import month_number
from sitecast.functions.encoding import weighted_score
from sitecast.learning import coldstart as CS
from sitecast.learning import regression as M
from sitecast.learning import splits as S
from sitecast.operators.joins import PAIRS_PER_TASK, spread_left_joins
from sitecast.operators.ordering import sorted_positions
from sitecast.plans.locations import create_location_features
from sitecast.session import materialize, shared_dir

SCALED = ["lead_time", "adults", "adr"]


@query(
    "fit_scaler",
    each(SCALED, "SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM v_bookings"),
)
def _(spark, d):
    return rounded(S.fit_scaler(view(spark, d, "v_bookings"), SCALED))


@query(
    "apply_scaler",
    "SELECT booking_id, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) + 0e0 AS {c}" for c in SCALED) + " FROM v_bookings, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED) + " FROM v_bookings WHERE is_canceled = 0)",
)
def _(spark, d):
    df = view(spark, d, "v_bookings")
    scaler = S.fit_scaler(df.filter("is_canceled = 0"), SCALED)
    return rounded(S.apply_scaler(df.select("booking_id", *SCALED), scaler))


HASH = "(booking_id % 2147483647 * 48271 + 42 * 7919) % 2147483647"


@query("hash_split", f"SELECT booking_id, {HASH} % 1000 < 800 AS is_train FROM v_bookings")
def _(spark, d):
    return S.hash_split(view(spark, d, "v_bookings").select("booking_id"), "booking_id")


@query("assign_folds", f"SELECT booking_id, CAST({HASH} % 5 AS INT) AS fold FROM v_bookings")
def _(spark, d):
    return S.assign_folds(view(spark, d, "v_bookings").select("booking_id"), "booking_id")


COLD_NUMBERS = ["booking_id", "poi_restaurant_count", "poi_park_count", "distance_to_city_center", "adr", "adults"]
NEW_HOTEL = {"city": "east", "poi_restaurant_count": 10, "poi_park_count": 4, "distance_to_city_center": 1.5}
SCALE_COLUMNS = ["poi_restaurant_count", "poi_park_count", "distance_to_city_center", "hotel_code", "city_code"]
COLD = {
    "known": "SELECT DISTINCT hotel, city, poi_restaurant_count, poi_park_count, distance_to_city_center, 0 AS is_new FROM v_hotel_history",
    "pool": "SELECT * FROM known UNION ALL SELECT 'H_NEW', 'east', 10, 4, 1.5e0, 1",
    "coded": "SELECT *, dense_rank() OVER (ORDER BY hotel) - 1 AS hotel_code, dense_rank() OVER (ORDER BY city) - 1 AS city_code FROM pool",
    "near": "SELECT hotel, sqrt(d2) AS distance, row_number() OVER (ORDER BY d2, hotel) AS rank FROM (SELECT o.hotel, "
    + " + ".join(f"((o.{c} - n.{c}) / s_{c}) ** 2" for c in SCALE_COLUMNS) + " AS d2 FROM coded o, coded n, (SELECT "
    + ", ".join(f"CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in SCALE_COLUMNS)
    + " FROM coded WHERE is_new = 0) s WHERE o.is_new = 0 AND n.is_new = 1) t QUALIFY rank <= 5",
}


@query("similar_hotels", "SELECT hotel, round(distance, 6) AS distance, CAST(rank AS INT) AS rank FROM near", **COLD)
def _(spark, d):
    return rounded(CS.similar_hotels(view(spark, d, "v_hotel_history"), "H_NEW", NEW_HOTEL, [F.col("booking_id")]))


@query(
    "cold_start",
    "SELECT hotel, city, arrival_date_month, customer_type, "
    + ", ".join(f"round(CAST({c} AS DOUBLE), 8) AS {c}" for c in COLD_NUMBERS)
    + ", CAST(NULL AS INT) AS is_prediction FROM v_hotel_history UNION ALL SELECT 'H_NEW', NULL, arrival_date_month, customer_type, "
    + ", ".join(f"round(avg({c}), 8)" for c in COLD_NUMBERS) + ", 1 FROM v_hotel_history WHERE hotel IN (SELECT hotel FROM near) GROUP BY 3, 4",
    **COLD,
)
def _(spark, d):
    return rounded(CS.cold_start(view(spark, d, "v_hotel_history"), "H_NEW", NEW_HOTEL, [F.col("booking_id")]), 8)


FEATURES = [
    "poi_restaurant_count", "poi_shopping_count", "poi_business_center_count", "distance_to_city_center", "distance_to_airport",
    "distance_to_subway", "income_per_capita", "unemployment_rate", "competitor_count", "area_km2",
]


LOCATION_ROWS = (
    "SELECT p.location_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURES)
    + " FROM v_loc_poi p LEFT JOIN v_loc_distance USING (location_id) LEFT JOIN v_loc_census USING (location_id) LEFT JOIN v_loc_competitor USING (location_id)"
)


def scored_sites(spark, d):
    """Location features with the weighted score as label, stored once for the many passes of a fit."""
    df = create_location_features(*[view(spark, d, f"v_loc_{s}") for s in ("poi", "distance", "census", "competitor")])
    keyed = weighted_score(df, out="historical_score").withColumn("site_key", F.substring("location_id", 5, 12).cast("bigint"))
    return materialize(keyed)


FOREST = {"n_estimators": 20, "max_depth": 5}


def forest(spark, d):
    sites = scored_sites(spark, d)
    return sites, M.fit_location_model(sites, FEATURES, "historical_score", "randomforest", FOREST)


def _metric_rows(spark, metrics: dict):
    return spark.createDataFrame(sorted((k, float(v)) for k, v in metrics.items()), "metric string, value double")


# What fits must hold, whatever the learner: SQL states it, the query measures it.


def _checks(spark, **held: bool):
    return spark.createDataFrame(sorted(held.items()), "property string, holds boolean")


def _check_sql(*names: str) -> str:
    return each(names, "SELECT '{c}' AS property, true AS holds")


@query("fit_location_model", _check_sql("better_than_the_mean", "metrics_named", "rmse_is_root_of_mse"))
def _(spark, d):
    sites = scored_sites(spark, d)
    m = M.fit_location_model(sites, FEATURES, "historical_score", "randomforest").metrics
    return _checks(
        spark, better_than_the_mean=m["r2"] > 0.5, metrics_named=set(m) == {"mse", "rmse", "mae", "r2"}, rmse_is_root_of_mse=abs(m["rmse"] ** 2 - m["mse"]) < 1e-6
    )


@query("fit_with_validation", _check_sql("better_than_the_mean", "gbdt_keeps_all_trees", "stops_early"))
def _(spark, d):
    sites = S.hash_split(scored_sites(spark, d), "site_key")
    train, valid = sites.filter("is_train").drop("is_train"), sites.filter("NOT is_train").drop("is_train")
    settings = {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.5}
    # A tolerance that no tree can meet stops a watched fit at once, and only that.
    stopped = M.fit_with_validation(train, valid, FEATURES, "historical_score", "xgboost", settings, tol=1e6)
    plain = M.fit_with_validation(train, valid, FEATURES, "historical_score", "gbdt", settings, tol=1e6)
    trees = lambda m: m.model.stages[-1].getNumTrees
    return _checks(spark, stops_early=trees(stopped) < 12, gbdt_keeps_all_trees=trees(plain) == 12, better_than_the_mean=plain.metrics["valid_r2"] > 0)


@query("cross_validate", each(range(5), "SELECT {c} AS fold, 3 AS metrics, true AS finite"))
def _(spark, d):
    out = M.cross_validate(scored_sites(spark, d), FEATURES, "historical_score", "site_key", "randomforest", FOREST, 5)
    # R² of a fold of two sites says little; every metric of every fold must be a number.
    finite = F.bool_and(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < F.lit(float("inf"))))
    return out.groupBy("fold").agg(F.count("value").cast("int").alias("metrics"), finite.alias("finite"))


@query("grid_search", "SELECT trees AS n_estimators, depth AS max_depth, depth = 5 AS deeper_is_no_worse FROM (SELECT unnest([5, 10]) AS trees), (SELECT unnest([3, 5]) AS depth)")
def _(spark, d):
    grid = {"n_estimators": [5, 10], "max_depth": [3, 5]}
    _, table = M.grid_search(scored_sites(spark, d), FEATURES, "historical_score", "site_key", "randomforest", grid, 3)
    tried = table.select(F.from_json("params", "n_estimators int, max_depth int").alias("p"), "mse").select("p.*", "mse")
    shallow = tried.filter("max_depth = 3").select("n_estimators", F.col("mse").alias("other"))
    return tried.join(shallow, "n_estimators").select(
        "n_estimators", "max_depth", ((F.col("max_depth") == 5) & (F.col("mse") <= F.col("other") * 1.05)).alias("deeper_is_no_worse")
    )


@query("score_locations", "SELECT location_id, true AS scored, true AS in_order FROM v_loc_poi")
def _(spark, d):
    sites, model = forest(spark, d)
    # Stored once: both orders, the counts of the join and the join read the scores.
    placed = sorted_positions(M.score_locations(model, sites).select("location_id", "predicted_score"), "_place")
    wanted = sorted_positions(M.sort_by_score(placed.drop("_place"), "predicted_score", "location_id"), "_want")
    # Scores of later rows of the sorted table are never higher: ranks by row and by score agree.
    # A location that repeats pairs all its rows, far more than their bytes show; without an id it has no pair.
    keyed = placed.filter("location_id IS NOT NULL").select("location_id", F.col("predicted_score").isNotNull().alias("scored"), "_place")
    ranks = spread_left_joins(keyed, [wanted.select("location_id", "_want")], "location_id", PAIRS_PER_TASK)
    return ranks.select("location_id", "scored", (F.col("_place") == F.col("_want")).alias("in_order"))


@query("evaluate_candidates", each(range(1, 11), "SELECT CAST({c} AS BIGINT) AS place, true AS above_the_rest"))
def _(spark, d):
    sites, model = forest(spark, d)
    best = materialize(M.evaluate_candidates(model, sites, 10).select("location_id", "predicted_score", "rank"))
    rest = model.predict(sites).join(best, "location_id", "left_anti").agg(F.max("predicted_score").alias("top")).first()["top"]
    # Ten rows: equal scores share a rank, so places are counted.
    places = Window.orderBy("rank", F.desc("predicted_score"), "location_id")
    # With ten candidates or fewer there is no rest, and each is above it.
    above = F.coalesce(F.col("predicted_score") >= F.lit(rest), F.lit(True))
    return best.select(F.row_number().over(places).cast("bigint").alias("place"), above.alias("above_the_rest"))


@query("feature_importance", each(FEATURES, "SELECT '{c}' AS feature, true AS share_of_one, true AS sums_to_one"))
def _(spark, d):
    out = materialize(M.feature_importance(spark, forest(spark, d)[1], 20))
    total = out.agg(F.sum("importance")).first()[0]
    return out.select("feature", F.col("importance").between(0, 1).alias("share_of_one"), F.lit(abs(total - 1) < 1e-9).alias("sums_to_one"))


@query(
    "location_factors",
    each(FEATURES, "SELECT location_id, '{c}' AS feature, round(CAST({c} AS DOUBLE), 6) AS value, true AS size_of_impact FROM sites"),
    sites=LOCATION_ROWS,
)
def _(spark, d):
    sites, model = forest(spark, d)
    out = M.location_factors(model, sites)
    same = F.col("abs_impact") == F.abs("impact")
    return out.select("location_id", "feature", F.round("value", 6).alias("value"), same.alias("size_of_impact"))


@query("save_model", "SELECT location_id, true AS same FROM v_loc_poi")
def _(spark, d):
    sites, model = forest(spark, d)
    path = M.save_model(model, f"{shared_dir(spark)}/model-{uuid.uuid4().hex}")
    loaded = M.load_model(spark, path)
    both = loaded.predict(model.predict(sites, "before"), "after")
    return both.select("location_id", (F.col("before") == F.col("after")).alias("same"))


WINDOW_ROWS = (
    "SELECT node, booking_id, status_ts AS date, adr AS actual FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY status_ts, booking_id) AS place FROM v_bookings) t WHERE place >= 7"
)


def _demand(spark, d):
    df = view(spark, d, "v_bookings").withColumn("arrival_date_month_num", month_number("arrival_date_month"))
    stored = materialize(df.na.fill(0, ["children"]))
    return stored, M.fit_demand_model(
        stored, "booking_id", ["status_ts", "booking_id"], ["node"], params={"n_estimators": 5}
    )


@query("fit_demand_model", _check_sql("error_is_finite", "metrics_named"))
def _(spark, d):
    m = _demand(spark, d)[1].valid_metrics
    return _checks(spark, metrics_named=set(m) == {"mse", "rmse", "mae", "r2"}, error_is_finite=0 < m["rmse"] < float("inf"))


@query("generate_forecasts", f"SELECT *, true AS forecast FROM ({WINDOW_ROWS}) t")
def _(spark, d):
    stored, model = _demand(spark, d)
    out = M.generate_forecasts(model, stored, "status_ts")
    return out.select("node", "booking_id", "date", "actual", F.col("prediction").isNotNull().alias("forecast"))


@query("forecast_without_target", f"SELECT node, booking_id, date, true AS same FROM ({WINDOW_ROWS}) t")
def _(spark, d):
    """A saved model, loaded again, on a table that has no target column."""
    stored, model = _demand(spark, d)
    loaded = M.load_demand_model(spark, M.save_demand_model(model, f"{shared_dir(spark)}/demand-{uuid.uuid4().hex}"))
    keys = ["node", "booking_id", "date"]
    before = M.generate_forecasts(model, stored, "status_ts").select(*keys, F.col("prediction").alias("before"))
    after = M.generate_forecasts(loaded, stored.drop("adr"), "status_ts").filter("actual IS NULL")
    return before.join(after, keys).select(*keys, (F.col("before") == F.col("prediction")).alias("same"))
