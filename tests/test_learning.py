"""Model invariants, cold start, and the report tables."""

import json

import pytest
from pyspark.sql import functions as F

from sitecast.catalog.load import QUERIES
from sitecast.learning import regression as M
from sitecast.learning.coldstart import cold_start, similar_hotels
from sitecast.learning.splits import apply_scaler, assign_folds, fit_scaler, hash_split
from sitecast.operators.summary import null_profile
from sitecast.plans.reports import dashboard_tables, eda_report
from sitecast.sources.geojson import read_geojson
from sitecast.sources.tables import read_summary_json, read_table, write_summary_json

FEATURES = ["a", "b", "c"]
SMALL = {"n_estimators": 5, "max_depth": 4}


@pytest.fixture(scope="module")
def sites(spark):
    df = spark.range(200).select(
        F.format_string("LOC_%03d", "id").alias("location_id"), F.col("id").alias("k"),
        (F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 7 % 13).cast("double").alias("b"), F.lit(1.0).alias("c"),
    )
    return df.withColumn("y", 3 * F.col("a") - F.col("b")).persist()


@pytest.fixture(scope="module")
def model(sites):
    return M.fit_location_model(sites, FEATURES, "y", "randomforest", {"n_estimators": 10, "max_depth": 6})


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "x double, z double")
    rows = {r["feature"]: (r["mean"], r["std"]) for r in fit_scaler(df, ["x", "z"]).collect()}
    assert rows == {"x": (2.0, 1.0), "z": (4.0, 1.0)}
    assert [tuple(r) for r in apply_scaler(df, fit_scaler(df, ["x", "z"])).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_splits_do_not_depend_on_partitions(spark):
    df = spark.range(1_000)
    a = hash_split(df, "id").filter("is_train").count()
    assert a == hash_split(df.repartition(5), "id").filter("is_train").count()
    assert 700 < a < 900
    assert {r["fold"] for r in assign_folds(df, "id").select("fold").distinct().collect()} == set(range(5))


def test_fit_beats_the_mean_and_repeats(sites, model):
    spread = sites.agg(F.stddev_pop("y")).first()[0]
    assert model.metrics["rmse"] < spread
    again = M.fit_location_model(sites, FEATURES, "y", "randomforest", {"n_estimators": 10, "max_depth": 6})
    assert again.metrics["rmse"] == pytest.approx(model.metrics["rmse"])


def test_ranking_and_importance(spark, sites, model):
    best = M.evaluate_candidates(model, sites, 5).orderBy("rank", "location_id").collect()
    scores = [r["predicted_score"] for r in M.score_locations(model, sites).collect()]
    assert best[0]["rank"] == 1 and best[0]["predicted_score"] == max(scores)
    assert scores == sorted(scores, reverse=True)
    imp = M.feature_importance(spark, model)
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert imp.first()["feature"] == "a"


def test_scored_sites_that_share_an_id_are_paired_in_several_tasks(spark, tmp_path):
    # Nine keys are cut to LOC_1000, eight of them with competitors: 9 * 9 * 9 * 8 rows, each paired with all.
    keys = [None, *range(1, 31), 1000, *range(10_000, 10_008)]
    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    found = QUERIES["score_locations"](spark, str(tmp_path)).groupBy("location_id", "scored", "in_order", F.spark_partition_id().alias("task")).count().collect()
    total = lambda ordered, at: sum(r["count"] for r in found if r["scored"] and r["in_order"] == ordered and (r["location_id"] == "LOC_1000") == at)
    n = 9 * 9 * 9 * 8
    assert (total(True, True), total(False, True), total(True, False), total(False, False)) == (n, n * n - n, 30, 0)
    most = max(r["count"] for r in found)
    assert most < n * n / 2 and len({r["task"] for r in found}) > 2


def test_factors_of_an_unused_feature_are_zero(sites, model):
    rows = M.location_factors(model, sites, "LOC_003").collect()
    assert len(rows) == 3
    assert next(r for r in rows if r["feature"] == "c")["impact"] == 0.0
    assert [r["abs_impact"] for r in rows] == sorted((r["abs_impact"] for r in rows), reverse=True)


def test_save_and_load(spark, sites, model, tmp_path):
    loaded = M.load_model(spark, M.save_model(model, str(tmp_path / "m")))
    assert loaded.features == FEATURES and loaded.scaler == model.scaler
    both = loaded.predict(model.predict(sites, "p"), "q")
    assert both.filter("p <> q").count() == 0


def test_kinds_and_mapping():
    assert M.spark_params("lightgbm")["maxDepth"] == 5
    assert M.spark_params("randomforest", {"max_depth": None})["maxDepth"] == 30
    assert M.spark_params("xgboost")["featureSubsetStrategy"] == "0.8"
    with pytest.raises(ValueError):
        M.spark_params("svm")


def test_boosting_with_validation_and_search(sites):
    parts = hash_split(sites, "k")
    m = M.fit_with_validation(parts.filter("is_train"), parts.filter("NOT is_train"), FEATURES, "y", "xgboost", SMALL)
    assert m.metrics["valid_rmse"] > 0
    best, table = M.grid_search(sites, FEATURES, "y", "k", "randomforest", {"n_estimators": [3], "max_depth": [1, 6]}, 3, 2)
    assert best["max_depth"] == 6 and table.count() == 2


def test_cold_start_without_groups(spark):
    df = spark.createDataFrame([(1, "A", 10, 1.0), (2, "A", 10, 3.0), (3, "B", 90, 9.0)], "id int, hotel string, poi_park_count int, adr double")
    near = similar_hotels(df, "N", {"poi_park_count": 12}, [F.col("id")], k=1).collect()
    assert [r["hotel"] for r in near] == ["B"] or [r["hotel"] for r in near] == ["A"]
    out = cold_start(df, "N", {"poi_park_count": 12}, [F.col("id")], ["poi_park_count", "hotel"], k=5)
    new = out.filter("is_prediction = 1").collect()
    assert len(new) == 1 and new[0]["hotel"] == "N" and new[0]["adr"] == pytest.approx(13 / 3)


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, "x"), (2.0, 4.0, None)], "actual double, prediction double, date string")
    locs = spark.createDataFrame([(f"L{i:02d}", float(i), i) for i in range(20)], "location_id string, predicted_score double, poi_a_count int")
    tables = dashboard_tables(df, locs)
    assert set(tables) == {"trend", "top_locations", "feature_means", "actual_vs_predicted"}
    assert tables["top_locations"].count() == 15
    assert {"numeric", "categorical", "correlations", "distributions"} <= set(eda_report(df, "actual"))
    path = write_summary_json({"nulls": null_profile(df)}, str(tmp_path / "s"))
    rows = read_summary_json(spark, path, "nulls", "column string, nulls long").collect()
    assert {r["column"]: r["nulls"] for r in rows} == {"actual": 0, "prediction": 0, "date": 1}


def test_geojson_collection(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"amenity": "cafe", "name": "n"}, "geometry": {"type": "Point", "coordinates": [121.5, 31.2]}}
    lines = ['{"type": "FeatureCollection", "features": [', json.dumps(feature) + ",", "  " + json.dumps(feature), "]}"]
    (tmp_path / "f.geojson").write_text("\n".join(lines))
    rows = read_geojson(spark, str(tmp_path / "f.geojson")).collect()
    assert [(r["amenity"], r["lat"], r["lon"], r["shop"]) for r in rows] == [("cafe", 31.2, 121.5, None)] * 2


def test_nan_is_null_in_every_format(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "id int, x double")
    for fmt in ("parquet", "csv", "json"):
        path = str(tmp_path / fmt)
        df.write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)
        back = read_table(spark, path, "id int, x double", fmt)
        assert back.filter("x is null").count() == 2 and back.filter("isnan(x)").count() == 0, fmt


def test_boosting_without_early_stop_keeps_its_trees(sites):
    parts = hash_split(sites, "k")
    m = M.fit_with_validation(parts.filter("is_train"), parts.filter("NOT is_train"), FEATURES, "y", "gbdt", SMALL, tol=1e6)
    assert m.model.stages[-1].getNumTrees == SMALL["n_estimators"]


def test_forecasts_of_unknown_rows(spark, tmp_path):
    df = spark.range(60).select("id", F.lit("h").alias("hotel"), (F.col("id") % 5).alias("lead_time"), F.when(F.col("id") < 50, F.col("id") * 1.0).alias("adr"))
    model = M.fit_demand_model(df, "id", ["id"], ["hotel"], params={"n_estimators": 2})
    out = M.generate_forecasts(model, df, "id").collect()
    assert sorted(r["date"] for r in out) == list(range(6, 60))
    assert {r["date"] for r in out if r["actual"] is None} == set(range(50, 60)) and all(r["prediction"] is not None for r in out)
    loaded = M.load_demand_model(spark, M.save_demand_model(model, str(tmp_path / "d")))
    bare = M.generate_forecasts(loaded, df.drop("adr"), "id").collect()
    assert {(r["date"], r["prediction"]) for r in bare} == {(r["date"], r["prediction"]) for r in out}


def test_similar_hotels_need_all_features(spark):
    df = spark.createDataFrame([(1, "A", 10), (2, "B", None), (3, "C", 90)], "id int, hotel string, poi_park_count int")
    near = similar_hotels(df, "N", {"poi_park_count": 12}, [F.col("id")], ["poi_park_count", "hotel"], k=5).collect()
    assert {r["hotel"] for r in near} == {"A", "C"}
    with pytest.raises(ValueError, match="lacks"):
        similar_hotels(df, "N", {}, [F.col("id")], ["poi_park_count", "hotel"])


def test_fits_spread_rows_that_lie_in_one_partition(spark, monkeypatch):
    """A tree fit holds far more of a row than its stored bytes: its rows are spread by their number."""
    from sitecast.learning import regression as R
    from sitecast.operators.joins import spread_rows

    seen = []

    def small(df):
        out = spread_rows(df, 40)
        seen.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(R, "spread_rows", small)
    df = spark.range(200).selectExpr("id AS k", "CAST(id % 17 AS DOUBLE) AS a", "id % 5 AS b", "3e0 * (id % 17) + id % 5 AS y").coalesce(1)
    params = {"n_estimators": 3, "max_depth": 4}
    model = R.fit_location_model(df, ["a", "b"], "y", "randomforest", params)
    assert seen == [5] and model.metrics["r2"] > 0.8
    assert R.location_factors(model, df, key="k").count() == 400 and seen == [5, 5]
    assert R.cross_validate(df, ["a", "b"], "y", "k", "randomforest", params, 3).count() == 9
    assert min(seen) > 1


def test_spread_rows_of_a_fit_lie_beside_rows_like_them(spark, monkeypatch):
    """A forest's histograms outgrow the cache: rows in no order cost about twice the time of sorted ones."""
    from sitecast.learning import regression as R
    from sitecast.operators.joins import spread_rows

    monkeypatch.setattr(R, "spread_rows", lambda df: spread_rows(df, 50))
    df = spark.range(200).selectExpr("id * 7 % 17 AS a", "id * 5 % 11 AS b", "CAST(id AS DOUBLE) AS y").coalesce(1)
    tasks = R._prepared(df, ["a", "b"], "y", {"a": (0.0, 1.0), "b": (0.0, 1.0)}).select("a", "b").rdd.glom().collect()
    rows = [[tuple(r) for r in task] for task in tasks]
    assert len(rows) == 4 and all(r == sorted(r) for r in rows)
    assert sorted(sum(rows, [])) == sorted((i * 7 % 17, i * 5 % 11) for i in range(200))


def test_search_prepares_its_rows_once(spark, monkeypatch):
    """The errors are CrossValidator's own; the table is read for the scaler, the row count and one store, and no fit is thrown away."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    read, fits = spark.sparkContext.accumulator(0), []
    fit = RandomForestRegressor._fit
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, data: fits.append(1) or fit(self, data))

    def seen(batches):
        for b in batches:
            read.add(len(b))
            yield b

    rows = spark.range(200).selectExpr("id AS k", "CAST(id % 17 AS DOUBLE) AS a", "id * 7 % 13 AS b", "3e0 * (id % 17) - id * 7 % 13 AS y").coalesce(1)
    table = M.grid_search(rows.mapInPandas(seen, rows.schema), ["a", "b"], "y", "k", "randomforest", {"n_estimators": [3, 5], "max_depth": [1, 4]}, 3)[1]
    assert read.value <= 3 * 200 and len(fits) == 3 * 4
    found = {tuple(json.loads(r["params"]).values()): r["mse"] for r in table.collect()}
    scaler = {r["feature"]: (r["mean"], r["std"]) for r in fit_scaler(rows, ["a", "b"]).collect()}
    vectors = M._assembler(["a", "b"]).transform(M._prepared(assign_folds(rows, "k", 3, out="_fold"), ["a", "b"], "y", scaler)).select(M.VECTOR, "y", "_fold")
    est = M.regressor("randomforest", "y")
    maps = ParamGridBuilder().addGrid(est.numTrees, [3, 5]).addGrid(est.maxDepth, [1, 4]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, numFolds=3, foldCol="_fold", evaluator=RegressionEvaluator(labelCol="y", metricName="mse")).fit(vectors)
    assert found == {(m[est.numTrees], m[est.maxDepth]): pytest.approx(v) for m, v in zip(maps, cv.avgMetrics)}


def test_search_refuses_rows_without_a_fold(spark):
    rows = spark.range(60).selectExpr("nullif(id, 7) AS k", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id AS DOUBLE) AS y")
    with pytest.raises(ValueError, match="range"):
        M.grid_search(rows, ["a"], "y", "k", "randomforest", {"n_estimators": [2]}, 3)
