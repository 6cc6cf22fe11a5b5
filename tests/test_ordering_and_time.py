"""Positions, chunks, sequences, decomposition."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitecast.operators import timeseries as T
from sitecast.operators.ordering import OWN, POS, framed, prefixed, sorted_positions, with_positions, with_running_total


def test_positions_are_dense_over_partitions(spark):
    df = spark.range(5_000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("k"), "id").repartition(16)
    placed = with_positions(df, [F.desc("k"), F.col("id")]).collect()
    want = sorted(((r["k"], r["id"]) for r in placed), key=lambda t: (-t[0], t[1]))
    assert [(r["k"], r["id"]) for r in sorted(placed, key=lambda r: r[POS])] == want
    assert sorted(r[POS] for r in placed) == list(range(5_000))


@pytest.mark.parametrize("parts", [1, 5])
def test_positions_of_a_sorted_table_keep_its_order(spark, parts):
    df = spark.range(1_000).repartition(7).repartitionByRange(parts, F.desc("id")).sortWithinPartitions(F.desc("id"))
    assert {(r["id"], r["_place"]) for r in sorted_positions(df, "_place").collect()} == {(i, 999 - i) for i in range(1_000)}


def test_running_total(spark):
    df = spark.range(100).withColumn("w", F.lit(2))
    rows = with_running_total(df, [F.col("id")], "w", "before").collect()
    assert all(r["before"] == 2 * r["id"] for r in rows)


@pytest.mark.parametrize("chunk", [4, 7, 100_000])
def test_chunked_frames_equal_one_window(spark, chunk):
    df = spark.range(200).select("id", (F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(100)).alias("v"))
    rows, w, _ = framed(df, ["k"], [F.col("id")], back=3, ahead=2, chunk_rows=chunk)
    got = rows.withColumn("s", F.sum("v").over(w.rowsBetween(-3, 2))).filter(OWN)
    plain = df.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("id").rowsBetween(-3, 2)))
    assert sorted((r["id"], r["s"]) for r in got.collect()) == sorted((r["id"], r["s"]) for r in plain.collect())


@pytest.mark.parametrize("chunk", [5, 100_000])
def test_chunked_prefix_equals_one_window(spark, chunk):
    df = spark.range(200).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"))
    specs = {"a": ("min", F.col("v"), "before"), "b": ("max", F.col("v"), "upto"), "c": ("min", F.col("v"), "from")}
    got = prefixed(df, ["k"], [F.col("id")], specs, chunk_rows=chunk).select("id", "a", "b", "c").collect()
    w = Window.partitionBy("k").orderBy("id")
    plain = df.select(
        "id",
        F.min("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("a"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("b"),
        F.min("v").over(w.rowsBetween(0, Window.unboundedFollowing)).alias("c"),
    ).collect()
    assert sorted(got) == sorted(plain)


def series(spark, n, step=1):
    return spark.range(n).select(F.col("id").alias("t"), (F.col("id") * step).cast("double").alias("f"), F.col("id").cast("double").alias("y"))


def test_sequences(spark):
    assert T.make_sequences(series(spark, 6), ["f"], ["y"], 7, 1, None, ["t"]).count() == 0
    out = T.make_sequences(series(spark, 10), ["f"], ["y"], 7, 2, None, ["t"]).orderBy("start").collect()
    assert [r["start"] for r in out] == [0, 2]
    assert [r["y"] for r in out] == [[6.0], [8.0]]
    assert [v[0] for v in out[1]["x"]] == [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    nxt = T.make_forecast_sequences(series(spark, 10), ["f"], "y", 7, None, ["t"]).orderBy("start").collect()
    assert [r["y"][0] for r in nxt] == [7.0, 8.0, 9.0]


def test_sequences_stay_inside_a_partition(spark):
    df = series(spark, 20).withColumn("node", F.when(F.col("t") < 8, "a").otherwise("b"))
    out = T.make_sequences(df, ["f"], ["y"], 7, 3, ["node"], ["t"]).collect()
    assert sorted((r["node"], r["start"], r["y"][0]) for r in out) == [("a", 0, 6.0), ("b", 0, 14.0), ("b", 3, 17.0)]


def test_resample_keeps_gaps(spark):
    rows = [(dt.date(2024, 1, 5), 1.0), (dt.date(2024, 1, 20), 2.0), (dt.date(2024, 3, 1), 5.0)]
    out = T.resample_mean(spark.createDataFrame(rows, "d date, v double"), "d", "v").orderBy("period").collect()
    assert [(r["label"], r["value"]) for r in out] == [
        (dt.date(2024, 1, 31), 1.5), (dt.date(2024, 2, 29), None), (dt.date(2024, 3, 31), 5.0),
    ]


def test_rolling_needs_a_full_frame(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, None, 6.0])], "t int, v double")
    got = [r["moving_average"] for r in T.rolling_mean(df, ["t"], "v", 4).orderBy("t").collect()]
    assert got == [None, None, None, 2.5, None, None]


def test_decomposition(spark):
    n = 48
    df = spark.createDataFrame([(i, 2.0 * i + [5, -1, -4][i % 3]) for i in range(n)] + [(100, None)], "t int, v double")
    for period in (3, 6):
        rows = T.seasonal_decompose(df, ["t"], "v", period).orderBy("t").collect()
        half = period // 2
        assert all(r["trend"] is None for r in rows[:half])
        for r in rows[half : n - half]:
            assert r["trend"] == pytest.approx(2.0 * r["t"])
            assert r["seasonal"] == pytest.approx([5, -1, -4][r["t"] % 3])
            assert r["residual"] == pytest.approx(0.0, abs=1e-9)
    with pytest.raises(ValueError, match="24"):
        T.seasonal_decompose(df.filter("t < 20"), ["t"], "v", 12)


def test_time_split(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1 + i // 4), i) for i in range(11)], "ts timestamp, id int")
    out = T.time_split(df, ["ts", "id"], 0.8).orderBy("id").collect()
    assert [r["split"] for r in out] == ["train"] * 8 + ["validation"] * 3


def test_stage_tables_go_with_their_job(spark):
    from sitecast.session import materialize, stage_tables

    with stage_tables(spark):
        inside = materialize(spark.range(3))
        assert inside.count() == 3
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
    outside = materialize(spark.range(4))
    assert outside.count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
