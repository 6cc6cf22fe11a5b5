"""Joins, scalar functions, ranking and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecast.catalog.fixtures import table, view
from sitecast.catalog.registry import query, rounded
from sitecast.functions import bookings as B
from sitecast.functions import dates as D
from sitecast.functions import encoding as E
from sitecast.functions import locations as L
from sitecast.operators import joins as J
from sitecast.operators import ranking as R

AMENITIES = ["economy", "large", "medium", "promo", "small", "standard"]
RADIUS2 = "(2e4 / 111) * (2e4 / 111)"
GRID = {"lat": "lat_e4", "lon": "lon_e4", "units_per_degree": 1e4}


@query(
    "group_mean_join_back",
    "SELECT booking_id, country, round(adr, 8) AS adr, round(CASE WHEN country IS NOT NULL THEN avg(adr) OVER (PARTITION BY arrival_date_month, country) END, 8) AS mean_price FROM v_bookings",
)
def _(spark, d):
    df = view(spark, d, "v_bookings").select("booking_id", "arrival_date_month", "country", "adr")
    return rounded(J.group_mean_join_back(df, ["arrival_date_month", "country"], "adr", "mean_price"), 8).drop("arrival_date_month")


LOCATION_COLUMNS = [
    "poi_restaurant_count", "poi_shopping_count", "poi_business_center_count", "distance_to_city_center", "distance_to_airport",
    "distance_to_subway", "income_per_capita", "unemployment_rate", "area_km2", "competitor_count",
]
LOCATIONS = (
    "SELECT p.location_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in LOCATION_COLUMNS)
    + " FROM v_loc_poi p LEFT JOIN v_loc_distance USING (location_id) LEFT JOIN v_loc_census USING (location_id) LEFT JOIN v_loc_competitor USING (location_id)"
)


def locations(spark, d):
    return J.join_location_sources(*[view(spark, d, f"v_loc_{s}") for s in ("poi", "distance", "census", "competitor")])


@query("join_location_sources", LOCATIONS)
def _(spark, d):
    return locations(spark, d)


COUNTS = ", ".join(
    f"count(CASE WHEN amenity = '{a}' THEN 1 END) AS poi_{a}_count" for a in AMENITIES
)
NEAR = (
    "SELECT s.location_id, s.site_key, " + COUNTS + " FROM v_sites s LEFT JOIN v_pois p ON "
    "(p.lat_e4 - s.lat_e4) * (p.lat_e4 - s.lat_e4) + (p.lon_e4 - s.lon_e4) * (p.lon_e4 - s.lon_e4) <= " + RADIUS2 + " GROUP BY 1, 2"
)


@query("count_pois_within", NEAR)
def _(spark, d):
    # So few pairs for a task that crowded cells take the split path.
    out = J.count_pois_within(view(spark, d, "v_sites"), view(spark, d, "v_pois"), 2.0, AMENITIES, pairs_per_task=50, **GRID)
    return out.select("location_id", "site_key", *[f"poi_{a}_count" for a in AMENITIES])


@query(
    "distance_edges",
    "SELECT a.node AS src, b.node AS dst, round(1 / (abs(a.distance - b.distance) + 1e-6), 6) AS weight FROM v_nodes a JOIN v_nodes b "
    "ON a.node <> b.node AND abs(a.distance - b.distance) <= 500",
)
def _(spark, d):
    return rounded(J.distance_edges(view(spark, d, "v_nodes"), "node", "distance", 500.0), 6)


@query(
    "count_pois_map",
    "SELECT location_id, site_key, amenity, CAST(count(*) AS BIGINT) AS n FROM v_sites s JOIN v_pois p ON amenity IS NOT NULL AND "
    "(p.lat_e4 - s.lat_e4) * (p.lat_e4 - s.lat_e4) + (p.lon_e4 - s.lon_e4) * (p.lon_e4 - s.lon_e4) <= " + RADIUS2 + " GROUP BY 1, 2, 3",
)
def _(spark, d):
    out = J.count_pois_within(view(spark, d, "v_sites"), view(spark, d, "v_pois"), 2.0, **GRID)
    return out.select("location_id", "site_key", F.explode("poi_counts").alias("amenity", "n"))


NEAR_NODES = "SELECT node, CASE WHEN node % 10 = 3 THEN NULL ELSE x1 END AS x1, distance / 1e3 AS d FROM v_nodes"


@query(
    "knn_join",
    "SELECT node, round(sqrt(d2), 6) AS distance, CAST(row_number() OVER (ORDER BY d2, node) AS INT) AS rank FROM "
    "(SELECT node, (x1 - 3e0) * (x1 - 3e0) + (d - 4e0) * (d - 4e0) AS d2 FROM base) t WHERE d2 IS NOT NULL ORDER BY d2, node LIMIT 20",
    base=NEAR_NODES,
)
def _(spark, d):
    base = view(spark, d, "v_nodes").select(
        "node", F.when(F.col("node") % 10 != 3, F.col("x1")).alias("x1"), (F.col("distance") / F.lit(1e3)).alias("d")
    )
    return rounded(J.nearest(base, {"x1": 3.0, "d": 4.0}, 20, "node"), 6)


@query(
    "knn_join_table",
    "SELECT query, node, round(sqrt(d2), 6) AS distance, CAST(rank AS INT) AS rank FROM ("
    " SELECT q.node AS query, b.node, (b.x1 - q.x1) * (b.x1 - q.x1) + (b.d - q.d) * (b.d - q.d) AS d2,"
    " row_number() OVER (PARTITION BY q.node ORDER BY (b.x1 - q.x1) * (b.x1 - q.x1) + (b.d - q.d) * (b.d - q.d), b.node) AS rank"
    " FROM base q, base b WHERE q.node % 50 = 0 AND q.x1 IS NOT NULL AND b.x1 IS NOT NULL) t WHERE rank <= 5",
    base=NEAR_NODES,
)
def _(spark, d):
    """Five nearest nodes of every node whose id is divisible by 50, among all nodes."""
    base = view(spark, d, "v_nodes").select(
        "node", F.when(F.col("node") % 10 != 3, F.col("x1")).alias("x1"), (F.col("distance") / F.lit(1e3)).alias("d")
    )
    queries = base.where(F.col("node") % 50 == 0).withColumnRenamed("node", "query")
    return rounded(J.knn_join(queries, base, ["x1", "d"], 5, "query", "node"), 6)


@query(
    "semi_filter",
    "SELECT booking_id, node FROM v_bookings WHERE node IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def _(spark, d):
    keys = table(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("node"))
    return J.semi_filter(view(spark, d, "v_bookings"), keys, "node").select("booking_id", "node")


@query(
    "dense_index",
    "SELECT booking_id, country, CASE WHEN country IS NOT NULL THEN dense_rank() OVER (ORDER BY country NULLS LAST) - 1 END AS country_idx FROM v_bookings",
)
def _(spark, d):
    return J.dense_index(view(spark, d, "v_bookings").select("booking_id", "country"), "country", "country_idx")


@query(
    "join_calendar",
    "SELECT day, event_type, n, temp_max, precipitation, coalesce(is_holiday, false) AS is_holiday FROM v_daily "
    "LEFT JOIN v_calendar c ON day = c.date LEFT JOIN v_holidays h ON day = h.date",
)
def _(spark, d):
    daily = view(spark, d, "v_daily").select("day", "event_type", "n")
    return J.join_calendar(daily, view(spark, d, "v_calendar"), view(spark, d, "v_holidays"), "day")


# Scalar functions over all bookings.

MONTH_LIST = "['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', 'November', 'December']"
MONTH = f"CAST(nullif(list_position({MONTH_LIST}, arrival_date_month), 0) AS INT)"
DATE = (
    f"coalesce(CAST(try_strptime(concat_ws('-', arrival_date_year, {MONTH}, arrival_date_day_of_month), '%Y-%m-%d') AS DATE), "
    f"make_date(arrival_date_year, {MONTH}, 1))"
)


def bookings(spark, d, *cols):
    df = view(spark, d, "v_bookings")
    return df.select("booking_id", *cols) if cols else df


@query("month_number", f"SELECT booking_id, {MONTH} AS month FROM v_bookings")
def _(spark, d):
    return bookings(spark, d, D.month_number("arrival_date_month").alias("month"))


def _date():
    return D.compose_date("arrival_date_year", D.month_number("arrival_date_month"), "arrival_date_day_of_month")


@query("compose_date", f"SELECT booking_id, {DATE} AS arrival_date FROM v_bookings")
def _(spark, d):
    return bookings(spark, d, _date().alias("arrival_date"))


PARTS = (
    "CAST(isodow({c}) - 1 AS INT) AS arrival_dayofweek, CAST(quarter({c}) AS INT) AS arrival_quarter, "
    "CAST(CASE WHEN isodow({c}) >= 6 THEN 1 ELSE 0 END AS INT) AS arrival_is_weekend"
)


@query("date_parts", "SELECT booking_id, " + PARTS.format(c="status_ts") + " FROM v_bookings")
def _(spark, d):
    return bookings(spark, d).withColumns(D.date_parts("status_ts")).select(
        "booking_id", "arrival_dayofweek", "arrival_quarter", "arrival_is_weekend"
    )


STAY = (
    "stays_in_weekend_nights + stays_in_week_nights AS total_nights, "
    "stays_in_weekend_nights * 1e0 / CASE WHEN stays_in_weekend_nights + stays_in_week_nights = 0 THEN 1 ELSE stays_in_weekend_nights + stays_in_week_nights END AS weekend_ratio"
)


@query("stay_features", f"SELECT booking_id, total_nights, round(weekend_ratio, 6) AS weekend_ratio FROM (SELECT booking_id, {STAY} FROM v_bookings) t")
def _(spark, d):
    return rounded(bookings(spark, d).withColumns(B.stay_features()).select("booking_id", "total_nights", "weekend_ratio"), 6)


GUESTS = (
    "adults + children + babies AS total_guests, "
    "CAST(CASE WHEN coalesce(children, 0) > 0 OR coalesce(babies, 0) > 0 THEN 1 ELSE 0 END AS INT) AS has_children"
)


@query("guest_features", f"SELECT booking_id, {GUESTS} FROM v_bookings")
def _(spark, d):
    return bookings(spark, d).withColumns(B.guest_features()).select("booking_id", "total_guests", "has_children")


BAND = (
    "CASE WHEN lead_time <= 0 THEN NULL WHEN lead_time <= 7 THEN 'last_minute' WHEN lead_time <= 30 THEN 'one_week' WHEN lead_time <= 90 THEN 'one_month' "
    "WHEN lead_time <= 180 THEN 'three_months' WHEN lead_time <= 365 THEN 'six_months' ELSE 'early_bird' END AS lead_time_group"
)


@query("lead_time_band", f"SELECT booking_id, {BAND} FROM v_bookings")
def _(spark, d):
    return bookings(spark, d, B.lead_time_band("lead_time").alias("lead_time_group"))


@query(
    "price_ratio",
    "SELECT booking_id, round(m, 8) AS avg_price_month_hotel, round(adr / m, 8) AS price_ratio FROM "
    "(SELECT booking_id, adr, avg(adr) OVER (PARTITION BY arrival_date_month, hotel) AS m FROM v_bookings) t",
)
def _(spark, d):
    out = B.price_ratio(bookings(spark, d))
    return out.select("booking_id", F.round("avg_price_month_hotel", 8).alias("avg_price_month_hotel"), F.round("price_ratio", 8).alias("price_ratio"))


SEASON = (
    "CASE WHEN {m} IN (12, 1, 2) THEN 'winter' WHEN {m} IN (3, 4, 5) THEN 'spring' WHEN {m} IN (6, 7, 8) THEN 'summer' WHEN {m} IN (9, 10, 11) THEN 'autumn' END"
)
PEAK = "CAST(CASE WHEN {m} IN (1, 2, 6, 7, 8, 12) THEN 1 ELSE 0 END AS INT)"


@query(
    "season_features",
    f"SELECT booking_id, {SEASON.format(m='month(status_ts)')} AS season, {PEAK.format(m='month(status_ts)')} AS is_peak_season FROM v_bookings",
)
def _(spark, d):
    return bookings(spark, d).withColumns(D.season_features(F.month("status_ts"))).select("booking_id", "season", "is_peak_season")


@query(
    "interaction_features",
    "SELECT booking_id, round(adr * (stays_in_weekend_nights + stays_in_week_nights), 6) + 0e0 AS total_price, is_repeated_guest AS is_returning_customer FROM v_bookings",
)
def _(spark, d):
    df = bookings(spark, d).withColumn("total_nights", F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights"))
    out = B.interaction_features(df.withColumn("reservation_status", F.lit("Check-Out")))
    return rounded(out.select("booking_id", "total_price", "is_returning_customer"))


COUNTRIES = [f"N{i}" for i in range(25)]


@query(
    "one_hot",
    "SELECT booking_id, " + ", ".join(f"coalesce(country = '{v}', false) AS \"country_{v}\"" for v in COUNTRIES) + " FROM v_bookings",
)
def _(spark, d):
    return E.one_hot(bookings(spark, d, "country"), "country", "country", COUNTRIES).drop("country")


@query(
    "index_category",
    "SELECT booking_id, customer_type, dense_rank() OVER (ORDER BY customer_type) - 1 AS customer_type_code FROM v_bookings",
)
def _(spark, d):
    return E.index_category(bookings(spark, d, "customer_type"), "customer_type")


@query("format_id", "SELECT site_key, concat('LOC_', lpad(CAST(site_key AS VARCHAR), CAST(greatest(length(CAST(site_key AS VARCHAR)), 3) AS INT), '0')) AS id FROM v_sites")
def _(spark, d):
    return view(spark, d, "v_sites").select("site_key", E.format_id("site_key").alias("id"))


POIS = "coalesce(poi_restaurant_count, 0) + coalesce(poi_shopping_count, 0) + coalesce(poi_business_center_count, 0)"


@query("row_sum", f"SELECT location_id, {POIS} AS total FROM v_loc_poi")
def _(spark, d):
    df = view(spark, d, "v_loc_poi")
    return df.select("location_id", E.row_sum([c for c in df.columns if c.startswith("poi_")]).alias("total"))


@query("poi_density", f"SELECT location_id, round(({POIS}) / nullif(area_km2, 0), 6) AS poi_density FROM ({LOCATIONS}) t")
def _(spark, d):
    return rounded(L.poi_density(L.total_poi(locations(spark, d))).select("location_id", "poi_density"), 6)


# Every fifth site lies at distance -1, where the inverse has no value.
AIRPORT = "CASE WHEN location_id LIKE '%5' THEN -1e0 ELSE distance_to_airport END"


@query(
    "transport_score",
    "SELECT location_id, round(1 / nullif(a + 1, 0), 6) AS distance_to_airport_inv, round(1 / (distance_to_subway + 1), 6) AS distance_to_subway_inv, "
    f"round(coalesce(1 / nullif(a + 1, 0), 0) + 1 / (distance_to_subway + 1), 6) AS transport_score FROM (SELECT *, {AIRPORT} AS a FROM ({LOCATIONS}) t) t",
)
def _(spark, d):
    out = L.transport_score(locations(spark, d).withColumn("distance_to_airport", F.expr(AIRPORT)))
    return rounded(out.select("location_id", "distance_to_airport_inv", "distance_to_subway_inv", "transport_score"), 6)


@query("economic_index", f"SELECT location_id, round(income_per_capita * (1 - unemployment_rate / 100), 6) AS economic_index FROM ({LOCATIONS}) t")
def _(spark, d):
    return rounded(L.economic_index(locations(spark, d)).select("location_id", "economic_index"))


@query("competition_index", f"SELECT location_id, round(competitor_count * 1e0 / ({POIS} + 1), 6) AS competition_index FROM ({LOCATIONS}) t")
def _(spark, d):
    return rounded(L.competition_index(L.total_poi(locations(spark, d))).select("location_id", "competition_index"), 6)


@query(
    "min_max",
    "SELECT booking_id, round((adr - lo) / (hi - lo), 6) AS share, round((adr - lo) / (hi - lo) * 100, 6) AS percent FROM v_bookings, (SELECT min(adr) AS lo, max(adr) AS hi FROM v_bookings)",
)
def _(spark, d):
    df = bookings(spark, d, "adr")
    out = E.min_max(E.min_max(df, "adr", 1.0, "share"), "adr", 100.0, "percent")
    return out.select("booking_id", F.round("share", 6).alias("share"), F.round("percent", 6).alias("percent"))


RAW_SCORE = (
    "0.3e0 * poi_restaurant_count + 0.2e0 * poi_shopping_count - 0.5e0 * distance_to_city_center - 0.2e0 * distance_to_subway "
    "+ 0.1e0 * income_per_capita / 10000 - 0.3e0 * competitor_count"
)
SCORED = f"SELECT *, {RAW_SCORE} AS raw FROM ({LOCATIONS}) t"


@query(
    "weighted_score",
    "SELECT location_id, round(100 * (raw - lo) / (hi - lo), 6) AS score FROM scored, (SELECT min(raw) AS lo, max(raw) AS hi FROM scored)",
    scored=SCORED,
)
def _(spark, d):
    return rounded(E.weighted_score(locations(spark, d)).select("location_id", "score"))


@query(
    "marker_style",
    "SELECT location_id, concat('#', lpad(printf('%x', CAST(floor(255 * (1 - n)) AS INT)), 2, '0'), '00', lpad(printf('%x', CAST(floor(255 * n) AS INT)), 2, '0')) AS color, "
    "round(5 + n * 10, 6) AS radius FROM (SELECT location_id, (raw - lo) / (hi - lo) AS n FROM (SELECT location_id, CAST(income_per_capita AS DOUBLE) AS raw FROM v_loc_census), "
    "(SELECT min(income_per_capita) AS lo, max(income_per_capita) AS hi FROM v_loc_census)) t",
)
def _(spark, d):
    return rounded(E.marker_style(view(spark, d, "v_loc_census"), "income_per_capita").select("location_id", "color", "radius"))


@query(
    "parse_date",
    "SELECT booking_id, CAST(try_strptime(t, '%Y-%m-%d') AS DATE) AS day FROM (SELECT booking_id, concat(arrival_date_year, '-', "
    "lpad(CAST(1 + booking_id % 13 AS VARCHAR), 2, '0'), '-', lpad(CAST(arrival_date_day_of_month AS VARCHAR), 2, '0')) AS t FROM v_bookings) x",
)
def _(spark, d):
    text = F.concat_ws(
        "-", "arrival_date_year", F.lpad((1 + F.col("booking_id") % 13).cast("string"), 2, "0"), F.lpad(F.col("arrival_date_day_of_month").cast("string"), 2, "0")
    )
    return bookings(spark, d, D.parse_date(text).alias("day"))


@query(
    "position_encoding",
    "SELECT event_id, CAST(dim AS INT) AS dim, round(CASE WHEN dim % 2 = 0 THEN sin(a) ELSE cos(a) END, 6) + 0e0 AS code FROM "
    "(SELECT event_id, dim, (event_id % 30) * exp((dim - dim % 2) * (-ln(10000.0e0) / 8)) AS a FROM events, (SELECT unnest(range(8)) AS dim)) t",
)
def _(spark, d):
    df = table(spark, d, "events").select("event_id", (F.col("event_id") % 30).alias("pos"))
    return rounded(E.position_encoding(df, "pos", 8).drop("pos"), 6)


@query(
    "gaussian_weight",
    "SELECT node, round(CASE WHEN abs(distance) < 4000 THEN exp(-(distance * distance) / (2500e0 * 2500e0)) ELSE 0 END, 6) AS weight FROM v_nodes",
)
def _(spark, d):
    return rounded(view(spark, d, "v_nodes").select("node", E.gaussian_weight(F.abs("distance"), 2500.0, 4000.0).alias("weight")), 6)


# Ranking and unions.


@query("sort_by_score", "SELECT booking_id, adr FROM v_bookings")
def _(spark, d):
    return R.sort_by_score(bookings(spark, d, "adr"), "adr", "booking_id")


@query(
    "rank_min",
    "SELECT booking_id, lead_time, CASE WHEN lead_time IS NOT NULL THEN rank() OVER (ORDER BY lead_time DESC NULLS LAST) END AS rank FROM v_bookings",
)
def _(spark, d):
    return R.rank_min(bookings(spark, d, "lead_time"), "lead_time")


RANKED = "SELECT booking_id, adr, rank() OVER (ORDER BY adr DESC NULLS LAST) AS rank FROM v_bookings"


@query("top_by_rank", f"SELECT * FROM ({RANKED}) t ORDER BY rank, booking_id LIMIT 20")
def _(spark, d):
    return R.top_by_rank(R.rank_min(bookings(spark, d, "adr"), "adr"), 20, "booking_id")


@query("top_n", "SELECT booking_id, adr FROM v_bookings ORDER BY adr DESC NULLS LAST, booking_id LIMIT 15")
def _(spark, d):
    return R.top_n(bookings(spark, d, "adr"), "adr", 15, "booking_id")


@query(
    "append_predictions",
    "SELECT booking_id, hotel, adr, CAST(NULL AS INT) AS is_prediction FROM v_bookings UNION ALL "
    "SELECT NULL, hotel, round(avg(adr), 8), 1 FROM v_bookings GROUP BY hotel",
)
def _(spark, d):
    df = bookings(spark, d, "hotel", "adr")
    pred = df.groupBy("hotel").agg(F.avg("adr").alias("adr"))
    return rounded(R.append_predictions(df, pred), 8)


@query(
    "append_mean_row",
    "SELECT CAST(booking_id AS DOUBLE) AS booking_id, hotel, round(adr, 8) AS adr, CAST(NULL AS INT) AS is_prediction FROM v_bookings UNION ALL "
    "SELECT round(avg(booking_id), 8), 'H_NEW', round(avg(adr), 8), 1 FROM v_bookings WHERE hotel = 'City Hotel'",
)
def _(spark, d):
    df = bookings(spark, d, "hotel", "adr")
    return rounded(R.append_mean_row(df, df.filter(F.col("hotel") == "City Hotel"), "H_NEW"), 8)
