"""Grid and bucket joins against brute force; graph steps against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from sitecast.operators import graph as G
from sitecast.operators import joins as J


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def points(n, a, b):
    return [(i, f"k{i % 3}" if i % 7 else None, (i * a) % 300, (i * b) % 300) for i in range(n)]


@pytest.mark.parametrize("pairs_per_task", [50, 5_000_000])
def test_radius_counts_equal_brute_force(spark, pairs_per_task):
    sites = [(i, (i * 37) % 300, (i * 91) % 300) for i in range(40)] + [(100, 0, 0), (101, 0, 0)]
    pois = points(300, 53, 71) + [(999, "k1", 0, 30)] * 50 + [(998, "k1", 0, 31), (997, "k2", 30, 0), (996, "k2", -30, 0)]
    s = spark.createDataFrame(sites, "site int, y int, x int")
    p = spark.createDataFrame(pois, "id int, amenity string, y int, x int")
    got = {
        (r["y"], r["x"], r["amenity"]): r["n"]
        for r in J.poi_counts_long(s, p, 30.0, "y", "x", units_per_degree=111.0, pairs_per_task=pairs_per_task).collect()
    }
    want = {}
    for y, x in {(y, x) for _, y, x in sites}:
        for _, k, py, px in pois:
            if k and (py - y) ** 2 + (px - x) ** 2 <= 30.0**2:
                want[y, x, k] = want.get((y, x, k), 0) + 1
    assert got == want


def test_radius_wide_keeps_sites_without_points(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 50.0)], "site int, latitude double, longitude double")
    p = spark.createDataFrame([("a", 0.0, 0.005), (None, 0.0, 0.0)], "amenity string, latitude double, longitude double")
    out = J.count_pois_within(s, p, amenities=["a"]).orderBy("site")
    assert [r["poi_a_count"] for r in out.collect()] == [1, 0]
    text = plan(out)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("pairs_per_task", [3, 5_000_000])
def test_distance_edges_equal_brute_force(spark, pairs_per_task):
    nodes = [(i, float((i * 29) % 100) - 50) for i in range(60)] + [(100 + i, 7.0) for i in range(20)]
    df = spark.createDataFrame(nodes, "node int, d double")
    got = {(r["src"], r["dst"]): r["weight"] for r in J.distance_edges(df, "node", "d", 4.0, pairs_per_task=pairs_per_task).collect()}
    want = {(a, b): 1 / (abs(x - y) + 1e-6) for a, x in nodes for b, y in nodes if a != b and abs(x - y) <= 4.0}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    text = plan(J.distance_edges(df, "node", "d", 4.0))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_distance_edges_need_a_positive_threshold(spark):
    with pytest.raises(ValueError, match="positive"):
        J.distance_edges(spark.createDataFrame([(1, 0.0)], "node int, d double"), "node", "d", 0.0)


def test_radius_without_a_list_counts_every_kind(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 50.0)], "site int, latitude double, longitude double")
    p = spark.createDataFrame([(f"kind{i}", 0.0, 0.001) for i in range(3_000)], "amenity string, latitude double, longitude double")
    out = J.count_pois_within(s, p.union(p.limit(1))).orderBy("site").collect()
    assert len(out[0]["poi_counts"]) == 3_000 and sum(out[0]["poi_counts"].values()) == 3_001 and out[1]["poi_counts"] == {}


def test_distance_edges_refuse_a_repeated_node(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 1.0)], "node int, d double")
    with pytest.raises(Exception, match="node given twice"):
        J.distance_edges(df, "node", "d", 1.0).collect()


def test_hot_key_is_split_and_pairs_are_whole(spark):
    left = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    for limit in (100, 1_000, 11_000):
        out = J.split_hot_join(left, right, ["k"], pairs_per_task=limit)
        assert out.count() == 12_000 and out.distinct().count() == 12_000
    tasks = J.split_hot_join(left, right, ["k"], pairs_per_task=1_000).groupBy(F.spark_partition_id()).count()
    assert tasks.count() > 1 and tasks.agg(F.max("count")).first()[0] < 12_000


def test_nearest(spark):
    base = spark.createDataFrame([(i, float(i), 0.0) for i in range(10)] + [(90, None, 0.0), (91, 2.5, None)], "base_id int, a double, b double")
    near = [(r["base_id"], r["rank"]) for r in J.nearest(base, {"a": 2.5, "b": 0.0}, 3).collect()]
    assert sorted(near, key=lambda r: r[1]) == [(2, 1), (3, 2), (1, 3)]
    assert J.nearest(base, {"a": 0.0, "b": 0.0}, 50).count() == 10
    with pytest.raises(ValueError, match="lacks"):
        J.nearest(base, {"a": None, "b": 0.0})


def complete(nodes, loops=False):
    """All pairs of a few nodes; with loops the diagonal weighs 2."""
    ids = [r["node"] for r in nodes.collect()]
    rows = [(a, b, 2.0 if a == b else 1.0) for a in ids for b in ids if loops or a != b]
    return nodes.sparkSession.createDataFrame(rows, "src int, dst int, weight double")


def test_complete_propagate_equals_edges(spark):
    nodes = spark.createDataFrame([(i, float(i * i)) for i in range(6)], "node int, x double")
    for loops in (False, True):
        edges = G.normalize_rows(complete(nodes, loops))
        a = {r["node"]: r["x"] for r in G.propagate(edges, nodes, ["x"]).collect()}
        b = {r["node"]: r["x"] for r in G.complete_propagate(nodes, ["x"], self_loops=loops).collect()}
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_isolated_end_counts_zero(spark):
    edges = spark.createDataFrame([(1, 2, 4.0)], "src int, dst int, weight double")
    assert G.normalize_symmetric(edges).first()["weight"] == 0.0


@pytest.mark.parametrize("spread", [1.0, 500.0])
def test_softmax_over_wide_energies(spark, spread):
    """Energies far apart overflow a plain exponential; a third share one row."""
    rows = [(i % 2, (-1) ** i * spread * (i % 11) / 3, float(i)) for i in range(60)] + [(0, spread, 2.0)] * 30
    df = spark.createDataFrame(rows, "g int, e double, v double")
    got = {r["g"]: r["v"] for r in G.softmax_pool(df, ["g"], "e", ["v"], 0.5).collect()}
    for g in (0, 1):
        part = [(e / 0.5, v) for k, e, v in rows if k == g]
        top = max(e for e, _ in part)
        z = sum(math.exp(e - top) for e, _ in part)
        assert got[g] == pytest.approx(sum(math.exp(e - top) * v for e, v in part) / z)


def test_attention_sums_to_one(spark):
    nodes = spark.createDataFrame([(i, float(i), float(-i)) for i in range(5)], "node int, x double, y double")
    edges = complete(nodes)
    w = G.attention_weights(edges, nodes, ["x", "y"], [[1.0, 2.0]], [[0.5, -3.0]])
    for r in w.groupBy("src").agg(F.sum("attention").alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)
    lone = G.attention_aggregate(edges.filter("src = 1 and dst = 3"), nodes, ["x", "y"], [[1.0, 2.0]], [[0.5, -3.0]])
    row = lone.collect()
    assert len(row) == 1 and row[0]["x"] == 3.0 and row[0]["y"] == pytest.approx(math.exp(-3) - 1)
