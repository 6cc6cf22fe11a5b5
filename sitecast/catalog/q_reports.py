"""Report tables and the composed jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sitecast.catalog.fixtures import view
from sitecast.catalog.q_joins import AMENITIES, BAND, COUNTS, GRID, GUESTS, LOCATIONS, MONTH_LIST, NEAR, PARTS, PEAK, POIS, SEASON, STAY
from sitecast.catalog.q_models import FEATURES, scored_sites
from sitecast.catalog.registry import each, query, rounded
from sitecast.plans import reports as P
from sitecast.plans.bookings import create_features, preprocess_bookings
from sitecast.plans.endtoend import run_all
from sitecast.plans.locations import create_location_features, site_shortlist
from sitecast.plans.nulls import clean_nulls
from sitecast.session import materialize, shared_dir

R2 = "1 - avg((actual - prediction) ** 2) / var_pop(actual)"


@query(
    "actual_vs_predicted",
    "SELECT actual, prediction, round(prediction - actual, 6) AS error, line_min, line_max, round(r2, 6) AS r2 FROM v_pred, "
    f"(SELECT least(min(actual), min(prediction)) AS line_min, greatest(max(actual), max(prediction)) AS line_max, {R2} AS r2 FROM v_pred)",
)
def _(spark, d):
    return rounded(P.actual_vs_predicted(view(spark, d, "v_pred")))


def dashboard(spark, d, name):
    forecasts = view(spark, d, "v_pred")
    sites = [view(spark, d, f"v_loc_{s}") for s in ("poi", "distance", "census", "competitor")]
    ranked = create_location_features(*sites).withColumn("predicted_score", F.col("income_per_capita").cast("double"))
    return P.dashboard_tables(forecasts, ranked, [name])[name]


@query("dashboard_trend", "SELECT date, prediction, actual FROM v_pred")
def _(spark, d):
    return dashboard(spark, d, "trend")


@query(
    "dashboard_top_locations",
    f"SELECT location_id, CAST(income_per_capita AS DOUBLE) AS predicted_score FROM ({LOCATIONS}) t ORDER BY 2 DESC, 1 LIMIT 15",
)
def _(spark, d):
    return dashboard(spark, d, "top_locations")


MEANS = {
    **{c: c for c in ["poi_restaurant_count", "poi_shopping_count", "poi_business_center_count", "distance_to_city_center", "distance_to_airport", "distance_to_subway"]},
    "poi_density": f"({POIS}) / nullif(area_km2, 0)",
    "distance_to_airport_inv": "1 / (distance_to_airport + 1)",
    "distance_to_subway_inv": "1 / (distance_to_subway + 1)",
}


@query(
    "dashboard_feature_means",
    "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg({e}), 6) AS mean FROM loc" for c, e in MEANS.items()),
    loc=LOCATIONS,
)
def _(spark, d):
    return rounded(dashboard(spark, d, "feature_means"))


@query(
    "spatial_points",
    "SELECT lat_e4 AS lat, lon_e4 AS lon, adr AS value, round(clat, 6) AS center_lat, round(clon, 6) AS center_lon, "
    "CASE WHEN adr IS NOT NULL THEN concat('#', lpad(printf('%x', CAST(floor(255 * (1 - n)) AS INT)), 2, '0'), '00', lpad(printf('%x', CAST(floor(255 * n) AS INT)), 2, '0')) END AS color, "
    "round(5 + n * 10, 6) AS radius FROM (SELECT lat_e4, lon_e4, adr, clat, clon, (adr - lo) / (hi - lo) AS n FROM v_bookings, "
    "(SELECT avg(lat_e4) AS clat, avg(lon_e4) AS clon, min(adr) AS lo, max(adr) AS hi FROM v_bookings)) t",
)
def _(spark, d):
    return rounded(P.spatial_points(view(spark, d, "v_bookings"), "lat_e4", "lon_e4", "adr"))


EDA_NUMBERS = ["booking_id", "adr", "lead_time", "children", "lat_e4", "lon_e4"]
EDA_BINS = each(
    EDA_NUMBERS,
    "SELECT '{c}' AS \"column\", CAST(least(floor((CAST({c} AS DOUBLE) - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, count(*) AS \"count\" FROM v_bookings, "
    "(SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM v_bookings) WHERE {c} IS NOT NULL GROUP BY 2",
)


def eda(spark, d):
    """The report's input: its date is text and is found by its name."""
    df = view(spark, d, "v_bookings").withColumn("status_date", F.date_format("status_ts", "yyyy-MM-dd"))
    return P.eda_report(df.select(*EDA_NUMBERS, "hotel", "status_date"), "adr")


@query(
    "eda_distributions",
    "SELECT c.name AS \"column\", CAST(b.bin AS INT) AS bin, coalesce(n.\"count\", 0) AS \"count\" FROM "
    f"(SELECT unnest({EDA_NUMBERS}) AS name) c CROSS JOIN (SELECT unnest(range(50)) AS bin) b LEFT JOIN bins n ON n.\"column\" = c.name AND n.bin = b.bin",
    bins=EDA_BINS,
)
def _(spark, d):
    return eda(spark, d)["distributions"].select("column", "bin", "count")


MONTHS = "SELECT date_trunc('month', status_ts) AS m, count(adr) AS known FROM v_bookings GROUP BY 1"


@query(
    "eda_report",
    "SELECT 'numeric' AS \"table\", 6 AS rows UNION ALL SELECT 'categorical', 1 UNION ALL SELECT 'datetime', 1 UNION ALL SELECT 'correlations', 5 "
    "UNION ALL SELECT 'distributions', 300 UNION ALL SELECT 'points', count(*) FROM v_bookings UNION ALL SELECT 'monthly', span FROM months "
    "UNION ALL SELECT 'moving_average', span FROM months UNION ALL SELECT 'decomposition', known FROM months",
    months=f"SELECT date_diff('month', min(m), max(m)) + 1 AS span, count(CASE WHEN known > 0 THEN 1 END) AS known FROM ({MONTHS}) t",
)
def _(spark, d):
    tables = eda(spark, d)
    counts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def reports(spark, d):
    ranked = view(spark, d, "v_loc_census").withColumn("predicted_score", F.col("income_per_capita").cast("double"))
    return P.report_tables(view(spark, d, "v_pred"), ranked.select("location_id", "predicted_score"), 10)


@query(
    "report_metrics",
    f"SELECT count(actual) AS n, round(avg((actual - prediction) ** 2), 6) AS mse, round(sqrt(avg((actual - prediction) ** 2)), 6) AS rmse, "
    f"round(avg(abs(actual - prediction)), 6) AS mae, round({R2}, 6) AS r2 FROM v_pred",
)
def _(spark, d):
    return rounded(reports(spark, d)["metrics"])


@query(
    "report_top_locations",
    "SELECT location_id, CAST(income_per_capita AS DOUBLE) AS predicted_score FROM v_loc_census ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(spark, d):
    return reports(spark, d)["top_locations"]


@query(
    "report_counts",
    "SELECT 'forecasts' AS \"table\", count(*) AS rows FROM v_pred UNION ALL SELECT 'locations', count(*) FROM v_loc_census",
)
def _(spark, d):
    return reports(spark, d)["counts"]


# Booking jobs.

KEPT = [
    "booking_id", "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month",
    "stays_in_weekend_nights", "stays_in_week_nights", "adults", "babies", "market_segment", "customer_type", "is_repeated_guest",
    "status_ts", "node", "lat_e4", "lon_e4",
]
TOP_COUNTRY = "(SELECT country FROM v_bookings_dup WHERE country IS NOT NULL GROUP BY country ORDER BY count(*) DESC, country LIMIT 1)"
PRE = {
    "filled": f"SELECT {', '.join(KEPT)}, CAST(coalesce(children, (SELECT median(children) FROM v_bookings_dup)) AS DOUBLE) AS children, "
    f"coalesce(country, {TOP_COUNTRY}) AS country, coalesce(adr, (SELECT median(adr) FROM v_bookings_dup)) AS adr FROM v_bookings_dup",
    "clamped": "SELECT * EXCLUDE (adr), CASE WHEN adr < 0 THEN 0 ELSE adr END AS adr FROM filled",
    "capped": "SELECT * EXCLUDE (adr), CASE WHEN adr > q THEN q ELSE adr END AS adr, "
    f"CAST(nullif(list_position({MONTH_LIST}, arrival_date_month), 0) AS INT) AS arrival_date_month_num FROM clamped, (SELECT quantile_cont(adr, 0.999) AS q FROM clamped)",
    "dated": "SELECT * EXCLUDE (q), coalesce(CAST(try_strptime(concat_ws('-', arrival_date_year, arrival_date_month_num, arrival_date_day_of_month), '%Y-%m-%d') AS DATE), "
    "make_date(arrival_date_year, arrival_date_month_num, 1)) AS arrival_date FROM capped",
    "pre": f"SELECT DISTINCT *, {PARTS.format(c='arrival_date')}, {STAY}, {GUESTS} FROM dated",
}


@query("preprocess_bookings", "SELECT * REPLACE (round(adr, 8) AS adr, round(weekend_ratio, 8) AS weekend_ratio) FROM pre", **PRE)
def _(spark, d):
    return rounded(preprocess_bookings(materialize(view(spark, d, "v_bookings_dup"))), 8)


CUSTOMERS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SEGMENTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLAGS = [(f"customer_{v}", "customer_type", v) for v in CUSTOMERS] + [(f"market_{v}", "market_segment", v) for v in SEGMENTS]
S_EXPR = SEASON.format(m="arrival_date_month_num")


@query(
    "create_features",
    f"SELECT * REPLACE (round(adr, 8) AS adr, round(weekend_ratio, 8) AS weekend_ratio), {BAND}, "
    "round(avg(adr) OVER (PARTITION BY arrival_date_month, hotel), 8) AS avg_price_month_hotel, "
    "round(adr / avg(adr) OVER (PARTITION BY arrival_date_month, hotel), 8) AS price_ratio, "
    + ", ".join(f"coalesce({c} = '{v}', false) AS \"{n}\"" for n, c, v in FLAGS)
    + f", {S_EXPR} AS season, {PEAK.format(m='arrival_date_month_num')} AS is_peak_season, "
    + ", ".join(f"{S_EXPR} = '{s}' AS season_{s}" for s in ("autumn", "spring", "summer", "winter"))
    + ", round(adr * total_nights, 8) + 0e0 AS total_price FROM pre",
    **PRE,
)
def _(spark, d):
    cleaned = materialize(preprocess_bookings(materialize(view(spark, d, "v_bookings_dup"))))
    return rounded(create_features(cleaned, CUSTOMERS, SEGMENTS), 8)


LOCATION_SQL = (
    f"*, CAST({POIS} AS BIGINT) AS total_poi_count, round(({POIS}) / nullif(area_km2, 0), 6) AS poi_density, "
    "round(1 / (distance_to_airport + 1), 6) AS distance_to_airport_inv, round(1 / (distance_to_subway + 1), 6) AS distance_to_subway_inv, "
    "round(1 / (distance_to_airport + 1) + 1 / (distance_to_subway + 1), 6) AS transport_score, "
    "round(income_per_capita * (1 - unemployment_rate / 100), 6) AS economic_index, "
    f"round(competitor_count * 1e0 / ({POIS} + 1), 6) AS competition_index"
)


@query(
    "create_location_features",
    f"SELECT {LOCATION_SQL} FROM (SELECT * REPLACE (CAST(competitor_count AS INT) AS competitor_count, CAST(poi_restaurant_count AS INT) AS poi_restaurant_count, "
    f"CAST(poi_shopping_count AS INT) AS poi_shopping_count, CAST(poi_business_center_count AS INT) AS poi_business_center_count) FROM ({LOCATIONS}) t) l",
)
def _(spark, d):
    out = create_location_features(*[view(spark, d, f"v_loc_{s}") for s in ("poi", "distance", "census", "competitor")])
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


@query(
    "clean_nulls",
    "SELECT event_id, event_type, round(coalesce(value, (SELECT CASE WHEN high > 0.05 * n THEN med ELSE mean END FROM "
    "(SELECT count(CASE WHEN value > q3 + 1.5 * (q3 - q1) THEN 1 END) AS high, count(*) AS n, any_value(med) AS med, avg(value) AS mean "
    "FROM v_event_nulls, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, median(value) AS med FROM v_event_nulls)))), 6) AS value, "
    "coalesce(last_value(month_no IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "first_value(month_no IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS month_no FROM v_event_nulls",
)
def _(spark, d):
    out = clean_nulls(materialize(view(spark, d, "v_event_nulls")), ["ts", "event_id"])["cleaned"]
    return rounded(out.select("event_id", "event_type", "value", "month_no"))


# Flagship: the ten best candidate sites.

SHORT_FEATURES = [
    "distance_to_city_center", "distance_to_airport", "distance_to_subway", "income_per_capita", "unemployment_rate", "area_km2", "competitor_count",
]
WEIGHTS = [(f"poi_{a}_count", 0.5, 1) for a in AMENITIES] + [
    ("distance_to_city_center", -0.5, 1), ("distance_to_subway", -0.2, 1), ("income_per_capita", 0.1, 10000), ("competitor_count", -0.3, 1),
]
RAW = (
    " + ".join(f"0.5e0 * poi_{a}_count" for a in AMENITIES)
    + " - 0.5e0 * distance_to_city_center - 0.2e0 * distance_to_subway + 0.1e0 * income_per_capita / 10000 - 0.3e0 * competitor_count"
)
TOTAL = " + ".join(f"poi_{a}_count" for a in AMENITIES)


@query(
    "site_shortlist",
    "SELECT location_id, total_poi_count, round(transport_score, 6) AS transport_score, round(economic_index, 6) AS economic_index, round(score, 6) AS score, rank FROM "
    f"(SELECT location_id, {TOTAL} AS total_poi_count, 1 / (distance_to_airport + 1) + 1 / (distance_to_subway + 1) AS transport_score, "
    "income_per_capita * (1 - unemployment_rate / 100) AS economic_index, 100 * (raw - lo) / (hi - lo) AS score, "
    "rank() OVER (ORDER BY 100 * (raw - lo) / (hi - lo) DESC) AS rank FROM scored, (SELECT min(raw) AS lo, max(raw) AS hi FROM scored)) t ORDER BY score DESC, location_id LIMIT 10",
    near=NEAR,
    joined="SELECT n.*, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in SHORT_FEATURES)
    + " FROM near n LEFT JOIN v_loc_distance USING (location_id) LEFT JOIN v_loc_census USING (location_id) LEFT JOIN v_loc_competitor USING (location_id)",
    scored=f"SELECT *, {RAW} AS raw FROM joined",
)
def _(spark, d):
    sites = view(spark, d, "v_sites")
    others = [view(spark, d, f"v_loc_{s}") for s in ("distance", "census", "competitor")]
    best = site_shortlist(sites, view(spark, d, "v_pois"), *others, AMENITIES, WEIGHTS, 10, 2.0, **GRID)
    return rounded(best.select("location_id", "total_poi_count", "transport_score", "economic_index", "score", "rank"))


@query(
    "end_to_end",
    "SELECT booking_id, round(adr, 8) AS adr, total_nights, arrival_date, " + ", ".join(f"poi_{a}_count" for a in AMENITIES) + " FROM pre JOIN "
    f"(SELECT b.lat_e4, b.lon_e4, {COUNTS} FROM (SELECT DISTINCT lat_e4, lon_e4 FROM v_bookings) b LEFT JOIN v_pois p ON "
    "(p.lat_e4 - b.lat_e4) * (p.lat_e4 - b.lat_e4) + (p.lon_e4 - b.lon_e4) * (p.lon_e4 - b.lon_e4) <= (1e4 / 111) * (1e4 / 111) GROUP BY 1, 2) n USING (lat_e4, lon_e4)",
    **PRE,
)
def _(spark, d):
    out = run_all(
        spark, materialize(view(spark, d, "v_bookings_dup")), view(spark, d, "v_pois"), scored_sites(spark, d),
        f"{shared_dir(spark)}/job-{uuid.uuid4().hex}", FEATURES, demand_params={"n_estimators": 5},
        location_params={"n_estimators": 20, "max_depth": 5}, location_kind="randomforest", amenities=AMENITIES, **GRID,
    )
    counts = [f"poi_{a}_count" for a in AMENITIES]
    return rounded(out["features"].select("booking_id", "adr", "total_nights", "arrival_date", *counts), 8)
