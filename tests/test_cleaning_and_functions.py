"""Hand-written edge cases: missing values, dates, bands, ranks, outliers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitecast.functions.bookings import guest_features, lead_time_band, stay_features
from sitecast.functions.dates import compose_date, date_parts, month_number, season_features
from sitecast.functions.encoding import format_id, marker_style, min_max, one_hot, row_sum, weighted_score
from sitecast.functions.locations import poi_density, transport_score
from sitecast.operators import cleaning as C
from sitecast.operators import summary as A
from sitecast.operators.columns import columns_by_kind, columns_matching, drop_null_rows, overwrite_where, require
from sitecast.operators.joins import group_mean_join_back, join_location_sources, spread_left_joins, spread_rows
from sitecast.operators.ranking import rank_min, top_ranked
from sitecast.sources.tables import read_table, sample_n


def col(df, name, key="id"):
    return [r[name] for r in df.orderBy(key).collect()]


def numbered(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")


def test_dates(spark):
    rows = [(0, 2023, "February", 30), (1, 2024, "February", 29), (2, 2023, "Febuary", 3), (3, 2023, "December", 31)]
    df = spark.createDataFrame(rows, "id int, y int, m string, d int").withColumn("n", month_number("m"))
    out = df.withColumn("date", compose_date("y", "n", "d"))
    assert col(out, "n") == [2, 2, None, 12]
    assert col(out, "date") == [dt.date(2023, 2, 1), dt.date(2024, 2, 29), None, dt.date(2023, 12, 31)]
    parts = out.withColumns(date_parts("date"))
    assert col(parts, "arrival_dayofweek") == [2, 3, None, 6]
    assert col(parts, "arrival_is_weekend") == [0, 0, 0, 1]
    seasons = out.withColumns(season_features("n"))
    assert col(seasons, "season") == ["winter", "winter", None, "winter"]
    assert col(seasons, "is_peak_season") == [1, 1, 0, 1]


def test_dates_survive_fractional_parts_of_imputed_columns(spark):
    df = spark.createDataFrame([(0, 2023.0, 2.0, 28.0)], "id int, y double, m double, d double")
    assert col(df.withColumn("x", compose_date("y", "m", "d")), "x") == [dt.date(2023, 2, 28)]


def test_lead_band(spark):
    df = numbered(spark, [0, 7, 8, 30, 365, 366, None], "int")
    assert col(df.withColumn("b", lead_time_band("v")), "b") == [
        None, "last_minute", "one_week", "one_week", "six_months", "early_bird", None,
    ]


def test_transport_at_distance_minus_one(spark):
    df = spark.createDataFrame([(-1.0, 1.0), (1.0, None)], "distance_to_bus double, distance_to_airport double")
    assert [tuple(r) for r in transport_score(df).select("distance_to_bus_inv", "transport_score").collect()] == [(None, 0.5), (0.5, 0.5)]


def test_stay_and_guests(spark):
    df = spark.createDataFrame(
        [(0, 0, 0, 1, None, 0), (1, 1, 3, 2, 1, 0)],
        "id int, stays_in_weekend_nights int, stays_in_week_nights int, adults int, children int, babies int",
    )
    out = df.withColumns(stay_features()).withColumns(guest_features())
    assert col(out, "total_nights") == [0, 4]
    assert col(out, "weekend_ratio") == [0.0, 0.25]
    assert col(out, "total_guests") == [None, 3]
    assert col(out, "has_children") == [0, 1]


def test_mode_tie_and_median(spark):
    df = spark.createDataFrame([(0, "b", 1.0), (1, "a", None), (2, "b", 4.0), (3, "a", 2.0), (4, None, 3.0)], "id int, s string, v double")
    assert A.modes(df, ["s"]) == {"s": "a"}
    assert col(C.impute_mode(df), "s") == ["b", "a", "b", "a", "a"]
    assert col(C.impute_median(df), "v") == [1.0, 2.5, 4.0, 2.0, 3.0]


def test_impute_leaves_whole_columns_alone(spark):
    df = spark.createDataFrame([(0, 1, "x"), (1, 2, "y")], "id int, v int, s string")
    assert C.impute_median(df).dtypes == df.dtypes
    assert C.impute_mode(df).collect() == df.collect()


def test_clamp_cap_and_null(spark):
    df = numbered(spark, [-5.0, None, 2.0, 3.0, 10.0])
    assert col(C.clamp_negative(df, "v"), "v") == [0.0, None, 2.0, 3.0, 10.0]
    capped = col(C.cap_quantile(numbered(spark, [1.0, 2.0, 3.0, 10.0, None]), "v", 0.999), "v")
    assert capped[3] == pytest.approx(9.979) and capped[4] is None


def test_outliers(spark):
    df = numbered(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None])
    assert col(C.flag_outliers_iqr(df, "v"), "is_outlier") == [False, False, False, False, True, False]
    assert col(C.winsorize(df, "v"), "v") == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    assert C.remove_outliers(df, "v").count() == 5
    assert col(C.flag_outliers_zscore(numbered(spark, [5.0, 5.0]), "v", 3.0), "is_outlier") == [False, False]


def test_log_shift_moves_all_and_logs_flagged(spark):
    import math

    out = col(C.log_outliers(numbered(spark, [-4.0, 1.0, 2.0, 3.0, 100.0]), "v"), "v")
    assert out[1:4] == [6.0, 7.0, 8.0]
    assert out[4] == pytest.approx(math.log(105.0))
    assert out[0] == pytest.approx(math.log(1.0))


def test_fill_forward_backward_within_partition(spark):
    rows = [(0, "a", 1, None), (1, "a", 2, 5.0), (2, "a", 3, None), (3, "b", 1, None), (4, "b", 2, None), (5, "c", 1, 2.0)]
    df = spark.createDataFrame(rows, "id int, k string, t int, v double")
    out = C.fill_forward_backward(df, ["v"], ["k"], [F.col("t")])
    assert col(out, "v") == [5.0, 5.0, 5.0, None, None, 2.0]


def test_duplicates_with_null(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("x", 1)], "s string, v int")
    assert C.deduplicate(df).count() == 2
    assert C.duplicate_count(df).first().asDict() == {"total": 3, "distinct": 2, "duplicates": 1}


def test_group_mean_with_null_key(spark):
    df = spark.createDataFrame([(0, "a", 1.0), (1, "a", 3.0), (2, None, 9.0)], "id int, k string, v double")
    assert col(group_mean_join_back(df, ["k"], "v", "m"), "m") == [2.0, 2.0, None]


def test_location_chain_multiplies_duplicates_and_skips_keyless(spark):
    poi = spark.createDataFrame([("A", 1), ("B", 2)], "location_id string, poi_x_count int")
    dist = spark.createDataFrame([("A", 1.0), ("A", 2.0)], "location_id string, distance_to_subway double")
    census = spark.createDataFrame([(1,)], "other int")
    comp = spark.createDataFrame([("B", 3)], "location_id string, competitor_count int")
    out = join_location_sources(poi, dist, census, comp)
    assert out.count() == 3 and "other" not in out.columns
    assert out.filter("location_id = 'B'").first()["distance_to_subway"] == 0.0


def test_one_hot_null_and_names(spark):
    df = spark.createDataFrame([(0, "x"), (1, None), (2, "y")], "id int, c string")
    out = one_hot(df, "c", "c", ["x", "y"])
    assert out.columns == ["id", "c", "c_x", "c_y"]
    assert out.orderBy("id").select("c_x", "c_y").collect()[1] == (False, False)


def test_scaling_constant_and_scores(spark):
    assert col(min_max(numbered(spark, [3.0, 3.0]), "v", out="s"), "s") == [0.0, 0.0]
    df = spark.createDataFrame([(0, 10), (1, 20), (2, 30)], "id int, poi_restaurant_count int")
    assert col(weighted_score(df), "score") == [0.0, 50.0, 100.0]
    style = marker_style(numbered(spark, [0.0, 1.0]), "v").orderBy("id").collect()
    assert [r["color"] for r in style] == ["#ff0000", "#0000ff"] and [r["radius"] for r in style] == [5.0, 15.0]


def test_small_expressions(spark):
    df = spark.createDataFrame([(0, 1, None, 0.0), (1, 2, 3, 4.0)], "id int, a int, b int, area_km2 double")
    out = df.withColumn("total_poi_count", row_sum(["a", "b"]))
    assert col(out, "total_poi_count") == [1, 5]
    assert col(poi_density(out), "poi_density") == [None, 1.25]
    assert col(df.select("id", format_id("id").alias("k")), "k") == ["LOC_000", "LOC_001"]
    assert format_id is not None
    t = spark.createDataFrame([(0, 1.0, 3.0)], "id int, distance_to_subway double, distance_to_beach double")
    assert col(transport_score(t), "transport_score") == [0.5]


def test_ranks(spark):
    assert col(rank_min(numbered(spark, [3.0, 1.0, 3.0, 2.0, None]), "v"), "rank") == [1, 4, 1, 3, None]
    assert [(r["id"], r["rank"]) for r in top_ranked(numbered(spark, [3.0, 1.0, 3.0, 2.0]), "v", 3, "id").orderBy("rank", "id").collect()] == [(0, 1), (2, 1), (3, 3)]


def test_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0, dt.date(2024, 1, 1))], "poi_x int, s string, poi_y double, d date")
    assert columns_by_kind(df) == {"numeric": ["poi_x", "poi_y"], "categorical": ["s"], "datetime": ["d"]}
    assert columns_matching(df, ["poi_"], ["y"]) == ["poi_x"]
    assert not require(df, ["zz"], strict=False)
    with pytest.raises(ValueError, match="zz"):
        require(df, ["zz"])


def test_drop_rows_only_when_few(spark):
    df = numbered(spark, [None, 1.0, 2.0, 3.0])
    assert drop_null_rows(df, 0.01).count() == 4
    assert drop_null_rows(df, 0.5).count() == 3
    assert col(overwrite_where(df, "v", F.col("v") > 1, F.lit(0.0)), "v") == [None, 1.0, 0.0, 0.0]


def test_csv_nan_and_empty_are_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,v,s\n0,NaN,a\n1,,\n2,3.5,b\n")
    rows = read_table(spark, str(tmp_path / "t.csv"), "id int, v double, s string").orderBy("id").collect()
    assert [r["v"] for r in rows] == [None, None, 3.5] and rows[1]["s"] is None


def test_sample_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r[0] for r in sample_n(df, 20, "k").collect()]
    b = [r[0] for r in sample_n(df.repartition(7), 20, "k").collect()]
    assert a == b and len(a) == 20


def test_spread_left_joins_give_every_combination_in_bounded_tasks(spark):
    """Repeated, null, missing and equal rows: the same rows as plain left joins, and no task with most of them."""
    left = spark.createDataFrame([("hot", i % 7) for i in range(30)] + [("one", 1), ("lone", 2)] + [(None, 3)] * 40, "k string, a int")
    x = spark.createDataFrame([("hot", i) for i in range(20)] + [("one", 5), (None, 6)], "k string, x int")
    y = spark.createDataFrame([("hot", float(i % 3)) for i in range(10)] + [(None, 1.0), ("other", 2.0)], "k string, y double")
    plain = left.join(x, "k", "left").join(y, "k", "left")
    for limit in (100, 1_000, 10**6):
        out = spread_left_joins(left, [x, y], "k", limit)
        assert out.columns == plain.columns
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    sizes = spread_left_joins(left, [x, y], "k", 300).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 0.5 * plain.count()
    assert spread_left_joins(left.filter("false"), [x, y], "k", 1).count() == 0


def test_spread_rows_keeps_the_rows(spark):
    df = spark.range(1000).coalesce(1)
    out = spread_rows(df, 100)
    assert out.rdd.getNumPartitions() == 10 and sorted(r.id for r in out.collect()) == list(range(1000))
    assert spread_rows(df, 1000).rdd.getNumPartitions() == 1
