"""Exact k-nearest join for a table of queries, against brute force."""

import math
import random

import pytest

from sitecast.operators import joins as J


def brute(queries, base, k):
    out = set()
    for qk, *qx in queries:
        if any(v is None or (isinstance(v, float) and math.isnan(v)) for v in qx):
            continue
        near = sorted(
            (math.dist(qx, bx), bk) for bk, *bx in base if not any(v is None or (isinstance(v, float) and math.isnan(v)) for v in bx)
        )
        out |= {(qk, bk, round(d, 9), r + 1) for r, (d, bk) in enumerate(near[:k])}
    return out


def run(spark, queries, base, k, d, **kw):
    cols = ", ".join(f"f{i} double" for i in range(d))
    q = spark.createDataFrame(queries, f"qid long, {cols}")
    b = spark.createDataFrame(base, f"bid long, {cols}").repartition(3)
    out = J.knn_join(q, b, [f"f{i}" for i in range(d)], k, "qid", "bid", **kw)
    return {(r.qid, r.bid, round(r.distance, 9), r.rank) for r in out.collect()}


@pytest.mark.parametrize("d", [1, 2, 3])
def test_knn_matches_brute_force(spark, d):
    draw = random.Random(d)
    base = [(i, *[float(draw.randint(0, 20)) for _ in range(d)]) for i in range(300)]  # many ties
    base += [(1000 + i, *[5.0] * d) for i in range(200)]  # one hot cell
    base += [(2000, *[None] * d), (2001, *[float("nan")] * d), (2002, *[1e4] * d)]
    queries = [(i, *[draw.uniform(-5, 25) for _ in range(d)]) for i in range(40)]
    queries += [(100, *[5.0] * d), (101, *[-1e3] * d), (102, *[None] * d), (103, *[5.0] * d)]
    for k in (1, 7):
        assert run(spark, queries, base, k, d, per_cell=8) == brute(queries, base, k)


def test_knn_k_above_rows_and_empty(spark):
    base = [(1, 0.0, 0.0), (2, 3.0, 4.0)]
    queries = [(9, 0.0, 0.0)]
    assert run(spark, queries, base, 5, 2) == {(9, 1, 0.0, 1), (9, 2, 5.0, 2)}
    assert run(spark, queries, [], 3, 2) == set()
    assert run(spark, [], base, 3, 2) == set()
    base = [(i, 2.0, 2.0) for i in range(50)]  # all base rows in one place
    assert run(spark, [(1, 1e6, -1e6)], base, 3, 2) == brute([(1, 1e6, -1e6)], base, 3)
