"""Time series and graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecast.catalog.fixtures import table, view
from sitecast.catalog.registry import query, rounded
from sitecast.operators import graph as G
from sitecast.operators import timeseries as T
from sitecast.operators.joins import distance_edges


@query(
    "resample_mean",
    "SELECT period, last_day(period) AS label, round(value, 6) AS value FROM "
    "(SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM v_monthly) s LEFT JOIN v_monthly USING (period)",
)
def _(spark, d):
    o = table(spark, d, "orders").filter((F.year("o_orderdate") * 12 + F.month("o_orderdate")) % 13 != 5)
    return rounded(T.resample_mean(o, "o_orderdate", "o_totalprice", "month"))



@query(
    "rolling_mean",
    "SELECT day, event_type, round(value, 6) AS value, CASE WHEN count(value) OVER w = 4 THEN round(avg(value) OVER w, 6) END AS moving_average FROM v_daily "
    "WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)",
)
def _(spark, d):
    df = view(spark, d, "v_daily").select("day", "event_type", "value")
    return rounded(T.rolling_mean(df, ["day"], "value", 4, partition=["event_type"]))


@query(
    "seasonal_decompose",
    "SELECT period, round(value, 6) AS observed, round(trend, 6) AS trend, round(seasonal, 6) + 0e0 AS seasonal, round(value - trend - seasonal, 6) + 0e0 AS residual FROM parts JOIN season USING (phase)",
    numbered="SELECT period, value, row_number() OVER (ORDER BY period) - 1 AS pos FROM v_monthly WHERE value IS NOT NULL",
    parts="SELECT period, value, pos % 12 AS phase, CASE WHEN count(*) OVER a = 12 AND count(*) OVER b = 12 THEN (avg(value) OVER a + avg(value) OVER b) / 2 END AS trend FROM numbered "
    "WINDOW a AS (ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING), b AS (ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)",
    phases="SELECT phase, avg(value - trend) AS m FROM parts GROUP BY phase",
    season="SELECT phase, m - (SELECT avg(m) FROM phases) AS seasonal FROM phases",
)
def _(spark, d):
    return rounded(T.seasonal_decompose(view(spark, d, "v_monthly"), ["period"], "value", 12))





def _exploded(df, keys):
    steps = df.select(*keys, "start", "end_booking_id", F.col("y")[0].alias("target"), F.posexplode("x").alias("step", "v"))
    return steps.select(*keys, "start", "end_booking_id", "target", "step", F.col("v")[0].alias("lead_time"), F.col("v")[1].alias("adults"))


NUMBERED = (
    "SELECT *, row_number() OVER (PARTITION BY node ORDER BY status_ts, booking_id) - 1 AS pos, "
    "count(*) OVER (PARTITION BY node) AS n FROM v_bookings"
)


@query(
    "make_sequences",
    "SELECT e.node, e.pos - 6 AS start, e.booking_id AS end_booking_id, CAST(e.babies AS DOUBLE) AS target, CAST(r.pos - (e.pos - 6) AS INT) AS step, "
    "CAST(r.lead_time AS DOUBLE) AS lead_time, CAST(r.adults AS DOUBLE) AS adults FROM numbered e JOIN numbered r ON r.node = e.node AND r.pos BETWEEN e.pos - 6 AND e.pos "
    "WHERE e.pos >= 6 AND (e.pos - 6) % 2 = 0",
    numbered=NUMBERED,
)
def _(spark, d):
    df = view(spark, d, "v_bookings")
    seqs = T.make_sequences(df, ["lead_time", "adults"], ["babies"], 7, 2, ["node"], ["status_ts", "booking_id"])
    return _exploded(seqs, ["node"])


@query(
    "make_forecast_sequences",
    "SELECT e.pos - 9 AS start, e.booking_id AS end_booking_id, CAST(f.babies AS DOUBLE) AS target, CAST(r.pos - (e.pos - 9) AS INT) AS step, "
    "CAST(r.lead_time AS DOUBLE) AS lead_time, CAST(r.adults AS DOUBLE) AS adults FROM numbered e JOIN numbered f ON f.pos = e.pos + 1 JOIN numbered r ON r.pos BETWEEN e.pos - 9 AND e.pos WHERE e.pos >= 9",
    numbered="SELECT *, row_number() OVER (ORDER BY status_ts, booking_id) - 1 AS pos FROM v_bookings",
)
def _(spark, d):
    df = view(spark, d, "v_bookings")
    seqs = T.make_forecast_sequences(df, ["lead_time", "adults"], "babies", 10, None, ["status_ts", "booking_id"])
    return _exploded(seqs, [])


@query("series_by_category", "SELECT event_type, day, n FROM v_daily")
def _(spark, d):
    return T.series_by_category(view(spark, d, "v_daily"), "day", "n", "event_type")


@query(
    "time_split",
    "SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor((SELECT count(*) FROM events) * 0.8) THEN 'train' ELSE 'validation' END AS split FROM events",
)
def _(spark, d):
    return T.time_split(table(spark, d, "events"), ["ts", "event_id"]).select("event_id", "split")


EDGES = (
    "SELECT a.node AS src, b.node AS dst, 1 / (abs(a.distance - b.distance) + 1e-6) AS weight FROM v_nodes a JOIN v_nodes b "
    "ON a.node <> b.node AND abs(a.distance - b.distance) <= 500"
)


def edges(spark, d):
    return distance_edges(view(spark, d, "v_nodes"), "node", "distance", 500.0)


@query(
    "normalize_symmetric",
    "SELECT e.src, e.dst, round(e.weight / sqrt(a.s) / sqrt(b.s), 6) AS weight FROM edges e JOIN sums a ON a.src = e.src JOIN sums b ON b.src = e.dst",
    edges=EDGES,
    sums="SELECT src, sum(weight) AS s FROM edges GROUP BY src",
)
def _(spark, d):
    return rounded(G.normalize_symmetric(edges(spark, d)), 6)


@query(
    "normalize_rows",
    "SELECT src, dst, round(weight / greatest(sum(weight) OVER (PARTITION BY src), 1e-6), 6) AS weight FROM edges",
    edges=EDGES,
)
def _(spark, d):
    return rounded(G.normalize_rows(edges(spark, d)), 6)


@query(
    "propagate",
    "SELECT src AS node, round(sum(w * x1), 6) AS x1, round(sum(w * x2), 6) AS x2 FROM "
    "(SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS w FROM edges) e JOIN v_nodes ON node = dst GROUP BY src",
    edges=EDGES,
)
def _(spark, d):
    return rounded(G.propagate(G.normalize_rows(edges(spark, d)), view(spark, d, "v_nodes"), ["x1", "x2"]))


@query(
    "complete_propagate",
    "SELECT node, round((s1 - x1) / (n - 1), 6) AS x1, round((s2 - x2) / (n - 1), 6) AS x2 FROM v_nodes, "
    "(SELECT sum(x1) AS s1, sum(x2) AS s2, count(*) AS n FROM v_nodes)",
)
def _(spark, d):
    return rounded(G.complete_propagate(view(spark, d, "v_nodes"), ["x1", "x2"]), 6)


# Attention coefficients of two heads.
A_SRC = [[0.30, -0.10], [-0.20, 0.05]]
A_DST = [[0.20, 0.10], [0.40, -0.02]]
HEADS = "SELECT * FROM (VALUES (0, 0.30e0, -0.10e0, 0.20e0, 0.10e0), (1, -0.20e0, 0.05e0, 0.40e0, -0.02e0)) AS h(head, s1, s2, d1, d2)"
ENERGY = (
    "SELECT src, dst, head, x1, x2, CASE WHEN raw > 0 THEN raw ELSE 0.2 * raw END AS energy FROM (SELECT e.src, e.dst, h.head, b.x1, b.x2, "
    "h.s1 * a.x1 + h.s2 * a.x2 + h.d1 * b.x1 + h.d2 * b.x2 AS raw FROM edges e JOIN v_nodes a ON a.node = e.src JOIN v_nodes b ON b.node = e.dst CROSS JOIN heads h) t"
)
SOFT = "SELECT *, exp(energy - max(energy) OVER (PARTITION BY src, head)) AS ex FROM energies"


@query(
    "attention_weights",
    "SELECT head, src, dst, round(ex / sum(ex) OVER (PARTITION BY src, head), 6) AS attention FROM soft",
    edges=EDGES, heads=HEADS, energies=ENERGY, soft=SOFT,
)
def _(spark, d):
    out = G.attention_weights(edges(spark, d), view(spark, d, "v_nodes"), ["x1", "x2"], A_SRC, A_DST)
    return rounded(out, 6)


@query(
    "attention_aggregate",
    "SELECT src AS node, head, round(CASE WHEN x1 > 0 THEN x1 ELSE exp(x1) - 1 END, 6) AS x1, round(CASE WHEN x2 > 0 THEN x2 ELSE exp(x2) - 1 END, 6) AS x2 FROM "
    "(SELECT src, head, sum(ex * x1) / sum(ex) AS x1, sum(ex * x2) / sum(ex) AS x2 FROM soft GROUP BY src, head) t",
    edges=EDGES, heads=HEADS, energies=ENERGY, soft=SOFT,
)
def _(spark, d):
    out = G.attention_aggregate(edges(spark, d), view(spark, d, "v_nodes"), ["x1", "x2"], A_SRC, A_DST)
    return rounded(out, 6)


@query(
    "softmax_pool",
    "SELECT event_type, round(sum(ex * user_id) / sum(ex), 6) AS user_id, round(sum(ex * value) / sum(ex), 6) AS value FROM "
    "(SELECT event_type, user_id, value, exp(value / 0.5 - max(value / 0.5) OVER (PARTITION BY event_type)) AS ex FROM events) t GROUP BY event_type",
)
def _(spark, d):
    return rounded(G.softmax_pool(table(spark, d, "events"), ["event_type"], "value", ["user_id", "value"], 0.5))


@query("mean_pool", "SELECT grp, round(avg(x1), 6) AS x1, round(avg(distance), 6) AS distance FROM v_nodes GROUP BY grp")
def _(spark, d):
    out = G.mean_pool(view(spark, d, "v_nodes"), ["grp"], ["x1", "distance"])
    return out.select("grp", F.round("x1", 6).alias("x1"), F.round("distance", 6).alias("distance"))


@query(
    "transform_sequences",
    "SELECT e.node, e.pos - 6 AS start, e.booking_id AS end_booking_id, CAST(e.babies AS DOUBLE) AS target, CAST(r.pos - (e.pos - 6) AS INT) AS step, "
    "round(r.lead_time / 4e2, 6) AS lead_time, round(r.adults / 4e2, 6) AS adults FROM numbered e JOIN numbered r ON r.node = e.node AND r.pos BETWEEN e.pos - 6 AND e.pos WHERE e.pos >= 6",
    numbered=NUMBERED,
)
def _(spark, d):
    df = view(spark, d, "v_bookings")
    seqs = T.make_sequences(df, ["lead_time", "adults"], ["babies"], 7, 1, ["node"], ["status_ts", "booking_id"])
    scaled = G.transform_sequences(seqs, lambda x: F.transform(x, lambda row: F.transform(row, lambda v: v / F.lit(400.0))))
    return rounded(_exploded(scaled, ["node"]), 6)
