"""Scans, sinks, spine, samples; column and row selection."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sitecast.catalog.fixtures import table, view
from sitecast.catalog.registry import each, query, rounded
from sitecast.operators import columns as C
from sitecast.operators import summary as A
from sitecast.session import shared_dir
from sitecast.sources import geojson as G
from sitecast.sources import tables as S

BOOKING_COLUMNS = ["booking_id", "hotel", "lead_time", "children", "country", "adr"]
BOOKING_SCHEMA = "booking_id bigint, hotel string, lead_time int, children int, country string, adr double"
BOOKING_SQL = f"SELECT {', '.join(BOOKING_COLUMNS)} FROM v_bookings"


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("read_table", BOOKING_SQL)
def _(spark, d):
    path = scratch(spark, "bookings-csv")
    S.write_table(view(spark, d, "v_bookings").select(*BOOKING_COLUMNS), path, "csv")
    return S.read_table(spark, path, BOOKING_SCHEMA, "csv")


@query("write_table", BOOKING_SQL)
def _(spark, d):
    path = scratch(spark, "bookings")
    S.write_table(view(spark, d, "v_bookings").select(*BOOKING_COLUMNS), path)
    return S.read_table(spark, path, BOOKING_SCHEMA, "parquet")


POI_ROWS = "SELECT amenity, CAST(NULL AS VARCHAR) AS tourism, shop, name, lat_e4 / 1e4 AS lat, lon_e4 / 1e4 AS lon FROM v_pois"


def _pois(spark, d):
    return view(spark, d, "v_pois").select(
        "amenity", "shop", "name", (F.col("lat_e4") / F.lit(1e4)).alias("lat"), (F.col("lon_e4") / F.lit(1e4)).alias("lon")
    )


@query("read_geojson", POI_ROWS)
def _(spark, d):
    return G.read_geojson(spark, G.write_geojson(_pois(spark, d), scratch(spark, "pois")))


@query("read_feature_collection", POI_ROWS)
def _(spark, d):
    """A collection with one feature per line between the lines of its wrapper."""
    lines = spark.read.text(G.write_geojson(_pois(spark, d), scratch(spark, "pois")))
    head = spark.createDataFrame([('{"type": "FeatureCollection", "features": [',), ("]}",)], "value string")
    path = scratch(spark, "collection")
    lines.select(F.concat("value", F.lit(",")).alias("value")).unionByName(head).write.text(path)
    return G.read_geojson(spark, path)


@query("write_geojson", "SELECT count(*) AS features, count(amenity) AS with_amenity FROM v_pois")
def _(spark, d):
    lines = spark.read.text(G.write_geojson(_pois(spark, d), scratch(spark, "pois")))
    kind = F.get_json_object("value", "$.properties.amenity")
    return lines.agg(F.count(F.lit(1)).alias("features"), F.count(kind).alias("with_amenity"))


@query(
    "select_pois",
    f"SELECT amenity, shop, name, lat, lon FROM ({POI_ROWS}) p WHERE lat BETWEEN 31.18 AND 31.24 AND lon BETWEEN 121.46 AND 121.54 "
    "AND (amenity IN ('promo', 'small') OR shop IN ('brand#11', 'brand#12', 'brand#13'))",
)
def _(spark, d):
    tags = {"amenity": ["promo", "small"], "shop": ["brand#11", "brand#12", "brand#13"]}
    return G.select_pois(_pois(spark, d), G.DEFAULT_BOX, tags)


@query(
    "date_spine",
    "SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders",
)
def _(spark, d):
    first, last = table(spark, d, "orders").agg(*[f(F.col("o_orderdate").cast("date")) for f in (F.min, F.max)]).first()
    return S.date_spine(spark, first, last)


METRICS_SQL = "SELECT hotel, count(*) AS n, round(avg(abs(actual - prediction)), 6) AS mae FROM v_pred GROUP BY hotel"


@query("append_metrics", f"SELECT * FROM ({METRICS_SQL}) a UNION ALL SELECT * FROM ({METRICS_SQL}) b")
def _(spark, d):
    path = scratch(spark, "metrics")
    p = view(spark, d, "v_pred")
    m = p.groupBy("hotel").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.col("actual") - F.col("prediction"))), 6).alias("mae")
    )
    S.append_metrics(m, path)
    S.append_metrics(m, path)
    return spark.read.parquet(path)


@query("write_if_absent", "SELECT location_id, site_key FROM v_sites")
def _(spark, d):
    path = scratch(spark, "stage")
    sites = view(spark, d, "v_sites").select("location_id", "site_key")
    S.write_if_absent(sites, path)
    S.write_if_absent(sites.withColumn("location_id", F.lit("second write")), path)
    return spark.read.parquet(path)


NULL_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "month_no"]
NULL_SQL = each(
    NULL_COLUMNS,
    "SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0e0 / count(*), 2) AS percent FROM v_event_nulls",
)


@query("write_summary_json", NULL_SQL)
def _(spark, d):
    path = S.write_summary_json({"nulls": A.null_profile(view(spark, d, "v_event_nulls"))}, scratch(spark, "summary"))
    return S.read_summary_json(spark, path, "nulls", "column string, nulls bigint, percent double")


@query(
    "sample_n",
    "SELECT booking_id, adr FROM v_bookings ORDER BY (booking_id % 2147483647 * 48271 + 42 * 7919) % 2147483647, booking_id LIMIT 500",
)
def _(spark, d):
    return S.sample_n(view(spark, d, "v_bookings").select("booking_id", "adr"), 500, "booking_id")


KINDS = {
    "numeric": ["event_id", "user_id", "value", "month_no"],
    "categorical": ["event_type"],
    "datetime": ["ts"],
}


@query(
    "columns_by_kind",
    "\nUNION ALL ".join(
        each(cols, f"SELECT '{kind}' AS kind, '{{c}}' AS \"column\", count({{c}}) AS known FROM v_event_nulls")
        for kind, cols in KINDS.items()
    ),
)
def _(spark, d):
    df = view(spark, d, "v_event_nulls")
    pairs = [(k, c) for k, cols in C.columns_by_kind(df).items() for c in cols]
    one = df.agg(*[F.count(c).alias(c) for _, c in pairs])
    return one.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column"), F.col(c).alias("known")) for k, c in pairs])).alias("r")
    ).select("r.*")


@query("columns_matching", "SELECT location_id, poi_restaurant_count, poi_business_center_count FROM v_loc_poi")
def _(spark, d):
    df = view(spark, d, "v_loc_poi")
    return df.select("location_id", *C.columns_matching(df, ["poi_"], ["shopping"]))


@query("require", "SELECT hotel, count(*) AS n FROM v_bookings GROUP BY hotel")
def _(spark, d):
    df = view(spark, d, "v_bookings")
    C.require(df, ["hotel"])
    keys = [c for c in ("hotel", "city") if C.require(df, [c], strict=False)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("overwrite_where", "SELECT booking_id, CASE WHEN adr < 0 THEN 0e0 ELSE adr END AS adr FROM v_bookings")
def _(spark, d):
    return C.overwrite_where(view(spark, d, "v_bookings"), "adr", F.col("adr") < 0, F.lit(0.0)).select("booking_id", "adr")


@query(
    "rows_where",
    "SELECT booking_id, hotel, adr FROM v_bookings WHERE hotel IN ('City Hotel', 'Airport Hotel') AND is_canceled = 0",
)
def _(spark, d):
    cond = F.col("hotel").isin("City Hotel", "Airport Hotel") & (F.col("is_canceled") == 0)
    return C.rows_where(view(spark, d, "v_bookings"), cond).select("booking_id", "hotel", "adr")


@query("rows_with_null", "SELECT event_id, value, month_no FROM v_event_nulls WHERE value IS NULL OR month_no IS NULL")
def _(spark, d):
    return C.rows_with_null(view(spark, d, "v_event_nulls")).select("event_id", "value", "month_no")


@query(
    "drop_null_rows",
    "SELECT event_id, user_id, month_no FROM v_event_nulls WHERE month_no IS NOT NULL",
)
def _(spark, d):
    return C.drop_null_rows(view(spark, d, "v_event_nulls").select("event_id", "user_id", "month_no"), 0.01)


@query(
    "high_null_columns",
    "SELECT * FROM (" + each(
        ["booking_id", "children", "country", "adr", "lead_time"],
        "SELECT '{c}' AS \"column\", round(1 - count({c}) * 1e0 / count(*), 6) AS null_ratio FROM v_bookings",
    ) + ") t WHERE null_ratio > 0.06",
)
def _(spark, d):
    df = view(spark, d, "v_bookings").select("booking_id", "children", "country", "adr", "lead_time")
    return rounded(A.high_null_columns(df, 0.06), 6)


@query("project", "SELECT adr AS price, booking_id AS id FROM v_bookings")
def _(spark, d):
    df = view(spark, d, "v_bookings").select("booking_id", "adr", "hotel")
    return C.project(df, {"adr": "price", "booking_id": "id"}, ["hotel"], ["price", "id"])
