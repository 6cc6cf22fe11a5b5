"""Aggregates and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitecast.catalog.fixtures import view
from sitecast.catalog.q_sources import NULL_SQL
from sitecast.catalog.registry import each, query, rounded
from sitecast.operators import cleaning as C
from sitecast.operators import summary as A
from sitecast.operators.quantiles import quantiles

NUMBERS = ["adr", "lead_time", "children", "is_canceled"]


def bookings(spark, d):
    return view(spark, d, "v_bookings")


@query("null_profile", NULL_SQL)
def _(spark, d):
    return A.null_profile(view(spark, d, "v_event_nulls"))


@query(
    "null_by_time",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS total, count(CASE WHEN value IS NULL OR month_no IS NULL THEN 1 END) AS with_null "
    "FROM v_event_nulls GROUP BY 1",
)
def _(spark, d):
    df = view(spark, d, "v_event_nulls").select(F.col("ts").cast("date").alias("day"), "value", "month_no")
    return A.null_by_time(df, "day")


@query(
    "numeric_summary",
    each(
        NUMBERS,
        "SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, round(stddev_samp({c}), 6) AS std, "
        "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(skewness({c}), 6) + 0e0 AS skew, "
        "round(kurtosis({c}), 6) + 0e0 AS kurtosis, count(*) - count({c}) AS missing FROM v_bookings",
    ),
)
def _(spark, d):
    return rounded(A.numeric_summary(bookings(spark, d), NUMBERS))


TEXTS = ["hotel", "country", "market_segment", "customer_type"]


@query(
    "categorical_summary",
    each(
        TEXTS,
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values, "
        "(SELECT {c} FROM v_bookings WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top_value, "
        "(SELECT count(*) FROM v_bookings WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS top_freq, "
        "count(*) - count({c}) AS missing FROM v_bookings",
    ),
)
def _(spark, d):
    return A.categorical_summary(bookings(spark, d), TEXTS)


@query(
    "datetime_summary",
    "SELECT 'ts' AS \"column\", min(ts) AS min_date, max(ts) AS max_date, "
    "CAST(floor(epoch_us(max(ts) - min(ts)) / 86400e6) AS BIGINT) AS range_days, count(*) - count(ts) AS missing FROM v_event_nulls",
)
def _(spark, d):
    return A.datetime_summary(view(spark, d, "v_event_nulls"))


@query(
    "describe_numeric",
    each(
        ["adr", "lead_time", "children"],
        "SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        "CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
        "round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM v_bookings",
    ),
)
def _(spark, d):
    return rounded(A.describe_numeric(bookings(spark, d), ["adr", "lead_time", "children"]))


@query(
    "quantiles",
    "\nUNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(adr, {q}), 6) AS value FROM v_bookings" for q in (0.01, 0.25, 0.5, 0.75, 0.999)
    ),
)
def _(spark, d):
    return rounded(quantiles(bookings(spark, d), "adr", [0.01, 0.25, 0.5, 0.75, 0.999]))


@query(
    "group_means",
    "SELECT arrival_date_month, customer_type, round(avg(adr), 8) AS adr, round(avg(lead_time), 8) AS lead_time, "
    "round(avg(children), 8) AS children FROM v_bookings GROUP BY 1, 2",
)
def _(spark, d):
    df = bookings(spark, d).select("arrival_date_month", "customer_type", "adr", "lead_time", "children", "node")
    return rounded(A.group_means(df, ["arrival_date_month", "customer_type"], ["node"]), 8)


@query(
    "column_means_ranked",
    each(["adr", "lead_time", "adults", "children"], "SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean FROM v_bookings"),
)
def _(spark, d):
    return rounded(A.column_means_ranked(bookings(spark, d), ["adr", "lead_time", "adults", "children"]))


@query(
    "value_counts",
    "SELECT value, count(*) AS count FROM (SELECT amenity AS value FROM v_pois UNION ALL SELECT shop FROM v_pois) t "
    "WHERE value IS NOT NULL GROUP BY value",
)
def _(spark, d):
    return A.value_counts(view(spark, d, "v_pois"), ["amenity", "shop"])


CORR = ["adr", "lead_time", "children", "adults"]


@query(
    "correlation_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{b}' AS column_a, '{a}' AS column_b, round(corr({b}, {a}), 6) + 0e0 AS correlation FROM v_bookings"
        for i, a in enumerate(CORR) for b in CORR[i + 1:]
    ),
)
def _(spark, d):
    return rounded(A.correlation_matrix(bookings(spark, d), CORR), 6)


@query(
    "target_correlations",
    each(CORR[1:], "SELECT '{c}' AS \"column\", round(corr({c}, adr), 6) + 0e0 AS correlation FROM v_bookings"),
)
def _(spark, d):
    return rounded(A.target_correlations(bookings(spark, d), "adr", CORR), 6)


@query(
    "histogram",
    "SELECT CAST(g.bin AS INT) AS bin, round(lo + g.bin * w, 6) AS lower, round(lo + (g.bin + 1) * w, 6) AS upper, count(b.bin) AS count "
    "FROM (SELECT unnest(range(50)) AS bin) g CROSS JOIN span LEFT JOIN "
    "(SELECT least(floor((adr - lo) / w), 49) AS bin FROM v_bookings, span WHERE adr IS NOT NULL) b ON b.bin = g.bin GROUP BY 1, 2, 3",
    span="SELECT min(adr) AS lo, (max(adr) - min(adr)) / 50 AS w FROM v_bookings",
)
def _(spark, d):
    return rounded(A.histogram(bookings(spark, d), "adr", 50), 6)


@query(
    "regression_metrics",
    "SELECT hotel, count(actual) AS n, round(avg((actual - prediction) ** 2), 6) AS mse, round(sqrt(avg((actual - prediction) ** 2)), 6) AS rmse, "
    "round(avg(abs(actual - prediction)), 6) AS mae, round(1 - avg((actual - prediction) ** 2) / var_pop(actual), 6) AS r2 FROM v_pred GROUP BY hotel",
)
def _(spark, d):
    m = A.regression_metrics(view(spark, d, "v_pred"), "actual", "prediction", ["hotel"])
    return m.withColumns({**{c: F.round(c, 6) for c in ("mse", "rmse", "mae")}, "r2": F.round("r2", 6)})


@query(
    "combined_loss",
    "SELECT round(mse, 6) AS mse, round(smooth_l1, 6) AS smooth_l1, round(msle, 6) AS msle, "
    "round(0.5 * mse + 0.3 * smooth_l1 + 0.2 * msle, 6) AS combined FROM parts",
    parts="SELECT avg((prediction - actual) ** 2) AS mse, "
    "avg(CASE WHEN abs(prediction - actual) < 1 THEN 0.5 * (prediction - actual) ** 2 ELSE abs(prediction - actual) - 0.5 END) AS smooth_l1, "
    "avg((ln(prediction + 1e-8) - ln(actual + 1e-8)) ** 2) AS msle FROM (SELECT coalesce(abs(actual), 0) AS actual, coalesce(abs(prediction), 0) AS prediction FROM v_pred) t",
)
def _(spark, d):
    sizes = view(spark, d, "v_pred").select(*[F.coalesce(F.abs(c), F.lit(0.0)).alias(c) for c in ("actual", "prediction")])
    loss = A.combined_loss(sizes, "actual", "prediction")
    return loss.withColumns({**{c: F.round(c, 6) for c in ("mse", "smooth_l1", "combined")}, "msle": F.round("msle", 6)})


@query(
    "cv_summary",
    "SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM folds GROUP BY metric",
    errors="SELECT booking_id % 5 AS fold, actual, prediction FROM v_pred",
    folds="SELECT fold, 'mae' AS metric, avg(abs(actual - prediction)) AS value FROM errors GROUP BY fold "
    "UNION ALL SELECT fold, 'rmse', sqrt(avg((actual - prediction) ** 2)) FROM errors GROUP BY fold",
)
def _(spark, d):
    p = view(spark, d, "v_pred").withColumn("fold", F.col("booking_id") % 5)
    folds = A.regression_metrics(p, "actual", "prediction", ["fold"]).select("fold", "mae", "rmse")
    return rounded(A.cv_summary(folds.unpivot("fold", ["mae", "rmse"], "metric", "value")))


@query(
    "early_stop",
    "SELECT run, CAST(coalesce(best_at_stop, best_overall) AS INT) AS best_epoch, CAST(coalesce(stop, final) AS INT) AS stop_epoch, "
    "stop IS NOT NULL AS stopped_early FROM ends",
    seen="SELECT run, epoch, loss, min(loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM v_history",
    marked="SELECT run, epoch, max(CASE WHEN best IS NULL OR loss < best THEN epoch END) OVER (PARTITION BY run ORDER BY epoch "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last FROM seen",
    ends="SELECT run, min(CASE WHEN epoch - last >= 3 THEN epoch END) AS stop, "
    "arg_min(last, CASE WHEN epoch - last >= 3 THEN epoch END) AS best_at_stop, max(last) AS best_overall, max(epoch) AS final FROM marked GROUP BY run",
)
def _(spark, d):
    return A.early_stop(view(spark, d, "v_history"), 3)


@query(
    "retention",
    "SELECT count(*) AS rows_in, count(CASE WHEN value IS NOT NULL AND month_no IS NOT NULL THEN 1 END) AS rows_out, "
    "round(count(CASE WHEN value IS NOT NULL AND month_no IS NOT NULL THEN 1 END) * 100e0 / count(*), 2) AS percent FROM v_event_nulls",
)
def _(spark, d):
    df = view(spark, d, "v_event_nulls")
    return A.retention(df, df.na.drop())


@query("distinct_values", "SELECT DISTINCT amenity FROM v_pois WHERE amenity IS NOT NULL")
def _(spark, d):
    return A.distinct_values(view(spark, d, "v_pois"), "amenity")


@query(
    "impute_median",
    "SELECT booking_id, coalesce(adr, (SELECT median(adr) FROM v_bookings)) AS adr, "
    "CAST(coalesce(children, (SELECT median(children) FROM v_bookings)) AS DOUBLE) AS children, lead_time FROM v_bookings",
)
def _(spark, d):
    return C.impute_median(bookings(spark, d).select("booking_id", "adr", "children", "lead_time"))


@query(
    "impute_mode",
    "SELECT booking_id, hotel, coalesce(country, (SELECT country FROM v_bookings WHERE country IS NOT NULL GROUP BY country "
    "ORDER BY count(*) DESC, country LIMIT 1)) AS country FROM v_bookings",
)
def _(spark, d):
    return C.impute_mode(bookings(spark, d).select("booking_id", "hotel", "country"))


ADAPTIVE = (
    "round(CAST(coalesce({c}, (SELECT CASE WHEN high > 0.05 * n THEN med ELSE mean END FROM "
    "(SELECT count(CASE WHEN {c} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS high, count(*) AS n, any_value(med) AS med, avg({c}) AS mean "
    "FROM v_event_nulls, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, median({c}) AS med FROM v_event_nulls)))) AS DOUBLE), 6) AS {c}"
)


@query(
    "impute_adaptive",
    f"SELECT event_id, {ADAPTIVE.format(c='value')}, {ADAPTIVE.format(c='month_no')} FROM v_event_nulls",
)
def _(spark, d):
    return rounded(C.impute_adaptive(view(spark, d, "v_event_nulls").select("event_id", "value", "month_no")))


@query(
    "fill_forward_backward",
    "SELECT event_id, event_type, coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id "
    "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM v_event_nulls",
)
def _(spark, d):
    df = view(spark, d, "v_event_nulls").select("event_id", "ts", "event_type", "value")
    return C.fill_forward_backward(df, ["value"], ["event_type"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("fill_constant", "SELECT booking_id, coalesce(children, 0) AS children, coalesce(adr, 0) AS adr FROM v_bookings")
def _(spark, d):
    return C.fill_constant(bookings(spark, d).select("booking_id", "children", "adr"), 0)


@query("clamp_negative", "SELECT booking_id, CASE WHEN adr < 0 THEN 0 ELSE adr END AS adr FROM v_bookings")
def _(spark, d):
    return C.clamp_negative(bookings(spark, d), "adr").select("booking_id", "adr")


@query(
    "cap_quantile",
    "SELECT booking_id, round(CASE WHEN adr > q THEN q ELSE adr END, 6) AS adr FROM v_bookings, (SELECT quantile_cont(adr, 0.99) AS q FROM v_bookings)",
)
def _(spark, d):
    return rounded(C.cap_quantile(bookings(spark, d), "adr", 0.99).select("booking_id", "adr"))


FENCE = "SELECT quantile_cont(adr, 0.25) AS q1, quantile_cont(adr, 0.75) AS q3 FROM v_bookings"
OUT = "(adr < q1 - 0.4 * (q3 - q1) OR adr > q3 + 0.4 * (q3 - q1))"


@query("flag_outliers_iqr", f"SELECT booking_id, coalesce({OUT}, false) AS is_outlier FROM v_bookings, fence", fence=FENCE)
def _(spark, d):
    return C.flag_outliers_iqr(bookings(spark, d), "adr", 0.4).select("booking_id", "is_outlier")


@query(
    "flag_outliers_zscore",
    "SELECT booking_id, coalesce(abs(adr - m) / (s + 1e-10) > 1.6, false) AS is_outlier FROM v_bookings, "
    "(SELECT avg(adr) AS m, stddev_pop(adr) AS s FROM v_bookings)",
)
def _(spark, d):
    return C.flag_outliers_zscore(bookings(spark, d), "adr", 1.6).select("booking_id", "is_outlier")


@query(
    "winsorize",
    "SELECT booking_id, round(CASE WHEN adr < q1 - 0.4 * (q3 - q1) THEN q1 - 0.4 * (q3 - q1) "
    "WHEN adr > q3 + 0.4 * (q3 - q1) THEN q3 + 0.4 * (q3 - q1) ELSE adr END, 6) AS adr FROM v_bookings, fence",
    fence=FENCE,
)
def _(spark, d):
    return rounded(C.winsorize(bookings(spark, d), "adr", 0.4).select("booking_id", "adr"))


@query("remove_outliers", f"SELECT booking_id, adr FROM v_bookings, fence WHERE NOT coalesce({OUT}, false)", fence=FENCE)
def _(spark, d):
    return C.remove_outliers(bookings(spark, d), "adr", 0.4).select("booking_id", "adr")


@query(
    "log_outliers",
    f"SELECT booking_id, round(CASE WHEN {OUT} THEN ln(adr + shift) ELSE adr + shift END, 6) AS adr FROM v_bookings, fence, "
    "(SELECT CASE WHEN min(adr) <= 0 THEN abs(min(adr)) + 1 ELSE 0 END AS shift FROM v_bookings)",
    fence=FENCE,
)
def _(spark, d):
    return rounded(C.log_outliers(bookings(spark, d), "adr", 0.4).select("booking_id", "adr"))


@query("deduplicate", "SELECT DISTINCT booking_id, hotel, adr, children FROM v_bookings_dup")
def _(spark, d):
    return C.deduplicate(view(spark, d, "v_bookings_dup")).select("booking_id", "hotel", "adr", "children")


@query(
    "duplicate_count",
    "SELECT count(*) AS total, count(DISTINCT booking_id) AS \"distinct\", count(*) - count(DISTINCT booking_id) AS duplicates FROM v_bookings_dup",
)
def _(spark, d):
    return C.duplicate_count(view(spark, d, "v_bookings_dup"))


@query(
    "first_per_key",
    "SELECT node, booking_id, adr FROM (SELECT node, booking_id, adr, row_number() OVER (PARTITION BY node ORDER BY status_ts, booking_id) AS rn "
    "FROM v_bookings) t WHERE rn = 1",
)
def _(spark, d):
    df = bookings(spark, d).select("node", "booking_id", "adr", "status_ts")
    return C.first_per_key(df, ["node"], [F.col("status_ts"), F.col("booking_id")]).drop("status_ts")
