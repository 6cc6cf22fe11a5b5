"""Statistics against published values and plain Python."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sitecast.operators import quantiles
from sitecast.operators import summary as A
from sitecast.operators.quantiles import quantile_values


def exact(values, q):
    v = sorted(x for x in values if x is not None)
    at = q * (len(v) - 1)
    lo = int(math.floor(at))
    hi = min(lo + 1, len(v) - 1)
    return v[lo] + (v[hi] - v[lo]) * (at - lo)


@pytest.mark.parametrize(
    "ones, mean, std, skew, kurt",
    [
        (1516, 0.3032, 0.45968687430084504, 0.856577651037091, -1.2667816004565262),
        (482, 0.0964, 0.29516853642110735, 2.73580314146903, 5.486813394373157),
    ],
)
def test_published_moments(spark, ones, mean, std, skew, kurt):
    df = spark.range(5000).select(F.when(F.col("id") < ones, 1).otherwise(0).alias("x"))
    row = A.numeric_summary(df, ["x"]).first()
    assert row["mean"] == pytest.approx(mean, abs=1e-12)
    assert row["std"] == pytest.approx(std, abs=1e-12)
    assert row["skew"] == pytest.approx(skew, rel=1e-12)
    assert row["kurtosis"] == pytest.approx(kurt, rel=1e-10)


def test_small_sample_moments(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    row = A.numeric_summary(df).first()
    assert row["skew"] == pytest.approx(1.763632614803888)
    assert row["kurtosis"] == pytest.approx(3.228)
    assert row["missing"] == 1


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_small(spark, n):
    rnd = random.Random(n)
    values = [rnd.choice([None, rnd.random(), 5.0]) for _ in range(n)] + [1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantile_values(df, {"x": [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]})
    for (_, q), v in got.items():
        assert v == pytest.approx(exact(values, q), abs=1e-12)


def test_quantiles_through_brackets_with_a_hot_value(spark):
    """A third of the rows share one value, and the sketch has to bracket."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003).alias("x"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)).cast("int").alias("y"),
    ).persist()
    qs = [0.001, 0.25, 0.333, 0.5, 0.66, 0.75, 0.999]
    got = quantile_values(df, {"x": qs, "y": qs}, accuracy=1_000, inside_rows=100)
    for c in ("x", "y"):
        values = [float(r[0]) for r in df.select(c).collect()]
        for q in qs:
            assert got[c, q] == pytest.approx(exact(values, q), abs=1e-12), (c, q)


def test_last_step_of_a_quantile_stays_small(spark, monkeypatch):
    """A million distinct values: what is counted by value at the end is bounded."""
    seen = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda base, wide, acc: (narrow(base, wide, acc), seen.append([b.inside for b in wide]))[0])
    df = spark.range(1_000_000).select(F.col("id").cast("double").alias("x"))
    got = quantile_values(df, {"x": [0.1, 0.5, 0.999]}, accuracy=500)
    assert [got["x", q] for q in (0.1, 0.5, 0.999)] == pytest.approx([99_999.9, 499_999.5, 998_999.001])
    assert len(seen) >= 2 and max(seen[-1]) <= quantiles.INSIDE_ROWS


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    """A sketch that answers nonsense costs passes, not the answer."""
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, e, a: F.array(F.max(c), F.max(c)))
    df = spark.range(5_000).select(F.col("id").cast("double").alias("x"))
    assert quantile_values(df, {"x": [0.25, 0.5]}) == {("x", 0.25): 1249.75, ("x", 0.5): 2499.5}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantile_values(df, {"x": [0.5]}) == {("x", 0.5): None}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4]] + [(None,)], "x double")
    assert [r["count"] for r in A.histogram(df, "x", 4).orderBy("bin").collect()] == [1, 1, 1, 2]
    flat = A.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 2).orderBy("bin").collect()
    assert sum(r["count"] for r in flat) == 2


def test_losses(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 4.0)], "y double, p double")
    row = A.combined_loss(df, "y", "p").first()
    mse = (0.25 + 4) / 2
    l1 = (0.125 + 1.5) / 2
    msle = (math.log(1.5) ** 2 + math.log(2) ** 2) / 2
    assert row["combined"] == pytest.approx(0.5 * mse + 0.3 * l1 + 0.2 * msle, rel=1e-6)
    bad = spark.createDataFrame([(1.0, -1.0), (2.0, 4.0)], "y double, p double")
    assert A.combined_loss(bad, "y", "p").first()["combined"] is None


def test_metrics_perfect_and_constant(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "y double, p double")
    row = A.regression_metrics(df, "y", "p").first()
    assert row["mse"] == 0 and row["r2"] == 1
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    assert A.regression_metrics(flat, "y", "p").first()["r2"] is None


def test_early_stop_tie_is_no_improvement(spark):
    losses = [9.0, 7.0, 7.5, 6.0, 6.0, 6.2, 6.1, 5.0, 5.5]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(losses)], "run int, epoch int, loss double")
    row = A.early_stop(df, 3).first()
    assert (row["best_epoch"], row["stop_epoch"], row["stopped_early"]) == (3, 6, True)
    row = A.early_stop(df, 5).first()
    assert (row["best_epoch"], row["stop_epoch"], row["stopped_early"]) == (7, 8, False)


def test_early_stop_counts_rows_not_numbers(spark):
    rows = [(1, 0, 9.0), (1, 5, 9.5), (1, 6, 8.0), (2, 10, None), (2, 20, None), (2, 30, 1.0)]
    df = spark.createDataFrame(rows, "run int, epoch int, loss double")
    got = {r["run"]: (r["best_epoch"], r["stop_epoch"], r["stopped_early"]) for r in A.early_stop(df, 3).collect()}
    assert got == {1: (6, 6, False), 2: (30, 30, False)}
    got = {r["run"]: (r["best_epoch"], r["stop_epoch"], r["stopped_early"]) for r in A.early_stop(df, 2).collect()}
    assert got == {1: (6, 6, False), 2: (None, 20, True)}


def test_spread_of_folds(spark):
    df = spark.createDataFrame([("mae", 1.0), ("mae", 3.0)], "metric string, value double")
    row = A.cv_summary(df).first()
    assert row["mean"] == 2.0 and row["std"] == statistics.pstdev([1.0, 3.0])


def test_retention_of_empty(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert A.retention(df, df.filter("x > 5")).first().asDict() == {"rows_in": 2, "rows_out": 0, "percent": 0.0}
