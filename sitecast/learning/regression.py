"""Tree regressors on Spark ML: fit, tune, score, explain, save.

Gradient boosting of any flavour is fitted with ``GBTRegressor``.  Its settings
map by meaning (trees, rate, depth, row share, feature share), but it is a
different learner, so fits agree in kind and not in value.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.learning.splits import apply_scaler, assign_folds, fit_scaler, hash_split, scaler_dict
from sitecast.operators.joins import ROWS_PER_TASK, spread_rows
from sitecast.operators.ranking import sort_by_score, top_n, top_ranked
from sitecast.operators.summary import regression_metrics
from sitecast.operators.timeseries import make_sequences

# Default settings and search grids per kind of model.
DEFAULTS = {
    "xgboost": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 1, "random_state": 42},
    "lightgbm": {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, "max_depth": -1, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_samples": 20, "random_state": 42},
    "randomforest": {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1, "random_state": 42},
    "gbdt": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "min_samples_split": 2, "min_samples_leaf": 1, "random_state": 42},
}
DEFAULT_GRIDS = {
    "xgboost": {"n_estimators": [50, 100, 200], "max_depth": [3, 6, 9], "learning_rate": [0.01, 0.1, 0.2], "subsample": [0.7, 0.8, 0.9], "colsample_bytree": [0.7, 0.8, 0.9]},
    "lightgbm": {"n_estimators": [50, 100, 200], "num_leaves": [15, 31, 63], "learning_rate": [0.01, 0.1, 0.2], "subsample": [0.7, 0.8, 0.9], "colsample_bytree": [0.7, 0.8, 0.9]},
    "randomforest": {"n_estimators": [50, 100, 200], "max_depth": [None, 10, 20], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
    "gbdt": {"n_estimators": [50, 100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.2], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
}
# The features of the demand model.
DEMAND_FEATURES = [
    "lead_time", "arrival_date_month_num", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children",
    "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled", "booking_changes",
    "required_car_parking_spaces", "total_of_special_requests",
]
MAX_DEPTH = 30
# Histograms a task of a forest fills in one pass.  The trees do not depend on it as each node sees all
# features; deep levels are split into several passes, each over nodes that stay nearer to the processor.
FOREST_MB = 64
# The kinds whose boosting watches a validation set.
EARLY_STOPPING = ("xgboost", "lightgbm")
VECTOR = "_features"


def _depth(params: dict) -> int:
    """Depth limit; a leaf limit without one gives the depth that holds as many leaves."""
    depth = params.get("max_depth")
    if depth is None:
        return MAX_DEPTH
    if depth < 0:
        return max(1, (params["num_leaves"] - 1).bit_length()) if "num_leaves" in params else MAX_DEPTH
    return min(depth, MAX_DEPTH)


def spark_params(kind: str, params: dict | None = None) -> dict:
    """Settings of the Spark regressor for a kind of model."""
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model kind: {kind}")
    p = {**DEFAULTS[kind], **(params or {})}
    leaf = max(int(p.get("min_samples_leaf", p.get("min_child_samples", p.get("min_child_weight", 1)))), 1)
    # A split needs twice a leaf's rows, so a split minimum raises the leaf minimum.
    leaf = max(leaf, -(-int(p.get("min_samples_split", 2)) // 2))
    out = {"maxDepth": _depth(p), "minInstancesPerNode": leaf, "seed": int(p["random_state"])}
    if kind == "randomforest":
        return {**out, "numTrees": int(p["n_estimators"]), "featureSubsetStrategy": "all"}
    return {
        **out,
        "maxIter": int(p["n_estimators"]),
        "stepSize": float(p["learning_rate"]),
        "subsamplingRate": float(p.get("subsample", 1.0)),
        "featureSubsetStrategy": str(p["colsample_bytree"]) if "colsample_bytree" in p else "all",
    }


def regressor(kind: str, label: str, params: dict | None = None, **extra):
    cls = RandomForestRegressor if kind == "randomforest" else GBTRegressor
    if kind == "randomforest":
        extra = {"maxMemoryInMB": FOREST_MB, **extra}
    return cls(featuresCol=VECTOR, labelCol=label, predictionCol="prediction", **spark_params(kind, params), **extra)


@dataclass
class LocationModel:
    """A fitted regressor with all it needs to score a table."""

    model: PipelineModel
    kind: str
    features: list[str]
    label: str
    params: dict
    scaler: dict[str, tuple[float, float]]
    metrics: dict[str, float] = field(default_factory=dict)

    def predict(self, df: DataFrame, out: str = "predicted_score") -> DataFrame:
        """Append the prediction; the table's own columns stay as they are."""
        copies = {f"_x_{c}": F.col(c) for c in self.features}
        scaled = apply_scaler(df.withColumns(copies), {f"_x_{c}": v for c, v in self.scaler.items()})
        return self.model.transform(scaled).select(*df.columns, F.col("prediction").alias(out))


def _prepared(df: DataFrame, features: Sequence[str], label: str, scaler: dict) -> DataFrame:
    """The columns a fit reads, spread: a tree fit holds each row with a draw per tree, far more than its stored bytes.

    A forest's histograms are far larger than a processor's cache.  In spread rows those alike
    lie side by side, so a row finds the nodes of the row before it there.
    """
    picked = df.select(*dict.fromkeys([*features, label, *[c for c in ("_fold", "_valid") if c in df.columns]]))
    df = spread_rows(picked)
    if df is not picked:
        df = df.sortWithinPartitions(*[c for c in ("_fold",) if c in df.columns], *features)
    copies = {f"_x_{c}": F.col(c) for c in features}
    scaled = apply_scaler(df.withColumns(copies), {f"_x_{c}": v for c, v in scaler.items()})
    return scaled.withColumn(label, F.col(label).cast("double"))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"_x_{c}" for c in features], outputCol=VECTOR)


def _metrics(model: LocationModel, df: DataFrame) -> dict[str, float]:
    row = regression_metrics(model.predict(df, "_p"), model.label, "_p").first()
    return {m: row[m] for m in ("mse", "rmse", "mae", "r2")}


def fit_location_model(
    df: DataFrame, features: Sequence[str], label: str, kind: str = "xgboost", params: dict | None = None
) -> LocationModel:
    """Scale, assemble and fit; metrics on the training rows are kept."""
    features = list(features)
    scaler = scaler_dict(fit_scaler(df, features))
    fitted = Pipeline(stages=[_assembler(features), regressor(kind, label, params)]).fit(
        _prepared(df, features, label, scaler)
    )
    out = LocationModel(fitted, kind, features, label, {**DEFAULTS[kind], **(params or {})}, scaler)
    out.metrics = _metrics(out, df)
    return out


def fit_with_validation(
    train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, kind: str = "xgboost",
    params: dict | None = None, tol: float = 0.01,
) -> LocationModel:
    """Boosting that stops when the validation error no longer falls by ``tol``.

    The scaler sees the training rows only.  Kinds outside ``EARLY_STOPPING`` are
    fitted on the training rows with all their trees.
    """
    if kind not in EARLY_STOPPING:
        out = fit_location_model(train, features, label, kind, params)
    else:
        features = list(features)
        scaler = scaler_dict(fit_scaler(train, features))
        both = train.withColumn("_valid", F.lit(False)).unionByName(valid.withColumn("_valid", F.lit(True)))
        stages = [_assembler(features), regressor(kind, label, params, validationIndicatorCol="_valid", validationTol=tol)]
        fitted = Pipeline(stages=stages).fit(_prepared(both, features, label, scaler))
        out = LocationModel(fitted, kind, features, label, {**DEFAULTS[kind], **(params or {})}, scaler)
        out.metrics = _metrics(out, train)
    out.metrics |= {f"valid_{k}": v for k, v in _metrics(out, valid).items()}
    return out


def cross_validate(
    df: DataFrame, features: Sequence[str], label: str, key: str, kind: str = "xgboost", params: dict | None = None, k: int = 5
) -> DataFrame:
    """Rows ``(fold, metric, value)``: each fold scored by a model that has not seen it."""
    folds = spread_rows(assign_folds(df, key, k, out="_fold").select(*dict.fromkeys([*features, label, "_fold"]))).persist()
    rows = []
    try:
        for f in range(k):
            model = fit_location_model(folds.filter(F.col("_fold") != f), features, label, kind, params)
            held = regression_metrics(model.predict(folds.filter(F.col("_fold") == f), "_p"), label, "_p").first()
            rows += [(f, m, held[m]) for m in ("rmse", "mae", "r2")]
    finally:
        folds.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, metric string, value double")


def _check_folds(df: DataFrame, folds: int) -> int:
    """The number of rows; an error if one is in no fold, or if no row is in a fold or outside it."""
    sizes = {r["_fold"]: r["count"] for r in df.groupBy("_fold").count().collect()}
    strange = [f for f in sizes if f is None or not 0 <= f < folds]
    if strange:
        raise ValueError(f"fold numbers must be in range [0, {folds}), but there is {strange[0]}")
    for f in range(folds):
        if len(sizes) == 1:
            raise ValueError(f"the training data at fold {f} is empty")
        if f not in sizes:
            raise ValueError(f"the validation data at fold {f} is empty")
    return sum(sizes.values())


def grid_search(
    df: DataFrame, features: Sequence[str], label: str, key: str, kind: str = "xgboost",
    grid: dict[str, list] | None = None, folds: int = 5, parallelism: int = 4,
) -> tuple[dict, DataFrame]:
    """Best settings by mean squared error over folds, and the table of all.

    Settings that Spark maps to the same parameters are tried once.  The rows are
    prepared and stored once for all folds and settings.  Spread rows fill the
    cluster, so their fits run one at a time and hold the memory of one; small
    ones run ``parallelism`` at a time.
    """
    grid = grid or DEFAULT_GRIDS[kind]
    est = regressor(kind, label)
    tried: dict[str, tuple[dict, dict]] = {}
    for values in product(*grid.values()):
        choice = dict(zip(grid, values))
        mapped = spark_params(kind, choice)
        tried.setdefault(json.dumps(mapped, sort_keys=True), (choice, mapped))
    maps = []
    for _, mapped in tried.values():
        builder = ParamGridBuilder()
        for name, v in mapped.items():
            builder = builder.baseOn({est.getParam(name): v})
        maps += builder.build()
    scaler = scaler_dict(fit_scaler(df, list(features)))
    data = _prepared(assign_folds(df, key, folds, out="_fold"), features, label, scaler)
    vectors = _assembler(features).transform(data).select(VECTOR, label, "_fold").persist()
    evaluator = RegressionEvaluator(labelCol=label, metricName="mse")
    try:
        spread = _check_folds(vectors, folds) > ROWS_PER_TASK
        errors = []
        with ThreadPool(1 if spread else min(parallelism, len(maps))) as pool:
            for f in range(folds):
                train, held = vectors.filter(F.col("_fold") != f), vectors.filter(F.col("_fold") == f)

                def error(setting, train=train, held=held):
                    return evaluator.evaluate(est.fit(train, setting).transform(held))

                errors.append(pool.map(inheritable_thread_target(df.sparkSession)(error), maps))
    finally:
        vectors.unpersist()
    rows = [(json.dumps(choice), float(sum(e) / folds)) for (choice, _), e in zip(tried.values(), zip(*errors))]
    best = min(range(len(rows)), key=lambda i: rows[i][1])
    table = df.sparkSession.createDataFrame(rows, "params string, mse double").orderBy("mse", "params")
    return json.loads(rows[best][0]), table


def score_locations(model: LocationModel, df: DataFrame, key: str = "location_id") -> DataFrame:
    """Every candidate with its predicted score, best first."""
    return sort_by_score(model.predict(df), "predicted_score", key)


def evaluate_candidates(model: LocationModel, df: DataFrame, n: int = 10, key: str = "location_id") -> DataFrame:
    """The ``n`` best candidates with score and rank."""
    return top_ranked(model.predict(df), "predicted_score", n, key)


def feature_importance(spark: SparkSession, model: LocationModel, n: int = 20) -> DataFrame:
    """Rows ``(feature, importance)``, most important first."""
    values = model.model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(model.features, values))
    return top_n(spark.createDataFrame(rows, "feature string, importance double"), "importance", n, "feature")


def location_factors(
    model: LocationModel, df: DataFrame, location_id: str | None = None, key: str = "location_id"
) -> DataFrame:
    """How much each feature moves a site's score away from an average site.

    ``impact`` is the score less the score with that one feature at its training
    mean.  These are single-feature replacement effects, not Shapley values:
    they need not add up to the whole difference.
    """
    one = df if location_id is None else df.filter(F.col(key) == location_id)
    names = model.features
    scored = model.predict(spread_rows(one.select(key, *names)), "_full")
    means = {c: model.scaler[c][0] for c in names}
    variants = scored.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in names]))).withColumns(
        {
            "value": F.coalesce(*[F.when(F.col("feature") == c, F.col(c).cast("double")) for c in names]),
            **{c: F.when(F.col("feature") == c, F.lit(means[c])).otherwise(F.col(c)) for c in names},
        }
    )
    moved = model.predict(variants, "_moved")
    impact = F.col("_full") - F.col("_moved")
    return moved.select(
        key, "feature", "value", impact.alias("impact"), F.abs(impact).alias("abs_impact")
    ).orderBy(key, F.desc("abs_impact"), "feature")


def save_model(model: LocationModel, path: str) -> str:
    """Model directory plus one JSON line with features, settings and scaler."""
    spark = SparkSession.active()
    model.model.write().overwrite().save(f"{path}/model")
    meta = {k: getattr(model, k) for k in ("kind", "features", "label", "params", "scaler", "metrics")}
    spark.createDataFrame([(json.dumps(meta),)], "value string").write.mode("overwrite").text(f"{path}/meta")
    return path


def load_model(spark: SparkSession, path: str) -> LocationModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    meta["scaler"] = {k: tuple(v) for k, v in meta["scaler"].items()}
    return LocationModel(model=PipelineModel.load(f"{path}/model"), **meta)


@dataclass
class DemandModel:
    """A regressor on flattened windows of booking rows."""

    model: object
    features: list[str]
    target: str
    seq_len: int
    scaler: dict[str, tuple[float, float]]
    partition: list[str]
    order: list[str]
    valid_metrics: dict[str, float] = field(default_factory=dict)

    def windows(self, df: DataFrame) -> DataFrame:
        """One window per row that has enough rows before it; ``actual`` is NULL where it is not known."""
        if self.target not in df.columns:
            df = df.withColumn(self.target, F.lit(None).cast("double"))
        cols = dict.fromkeys([*self.partition, *self.order, *self.features, self.target])
        seqs = make_sequences(
            apply_scaler(df.select(*cols), self.scaler), self.features, [self.target], self.seq_len, 1, self.partition, self.order
        )
        return seqs.withColumn(VECTOR, array_to_vector(F.flatten("x"))).withColumn("actual", F.col("y")[0])


def fit_demand_model(
    df: DataFrame, key: str, order: Sequence[str], partition: Sequence[str] = (), features: Sequence[str] = DEMAND_FEATURES,
    target: str = "adr", seq_len: int = 7, kind: str = "gbdt", params: dict | None = None,
) -> DemandModel:
    """Fit on 80 % of the windows and measure on the rest.

    ``key`` identifies a window's last row and decides its side.  Features the
    table lacks are skipped; windows whose target is not known are not fitted on.
    """
    used = [c for c in features if c in df.columns]
    if not used:
        raise ValueError("none of the demand features is present")
    scaler = scaler_dict(fit_scaler(df, used))
    shell = DemandModel(None, used, target, seq_len, scaler, list(partition), list(order))
    rows = hash_split(shell.windows(df).filter(F.col("actual").isNotNull()), f"end_{key}").persist()
    shell.model = regressor(kind, "actual", params).fit(rows.filter("is_train"))
    held = shell.model.transform(rows.filter(~F.col("is_train")))
    row = regression_metrics(held, "actual", "prediction").first()
    shell.valid_metrics = {m: row[m] for m in ("mse", "rmse", "mae", "r2")}
    rows.unpersist()
    return shell


def generate_forecasts(model: DemandModel, df: DataFrame, date: str) -> DataFrame:
    """Rows ``(partition..., date, prediction, actual)``, one per window.

    The target is not needed: ``actual`` is NULL where a row lacks it, and for all
    rows of a table without that column.
    """
    out = model.model.transform(model.windows(df))
    keys = [*model.partition, *[F.col(f"end_{c}").alias(c) for c in model.order if c not in (*model.partition, date)]]
    return out.select(*keys, F.col(f"end_{date}").alias("date"), "prediction", "actual")


_DEMAND_META = ("features", "target", "seq_len", "scaler", "partition", "order", "valid_metrics")


def save_demand_model(model: DemandModel, path: str) -> str:
    """Regressor directory plus one JSON line with what scoring needs."""
    spark = SparkSession.active()
    model.model.write().overwrite().save(f"{path}/model")
    meta = {k: getattr(model, k) for k in _DEMAND_META} | {"class": type(model.model).__name__}
    spark.createDataFrame([(json.dumps(meta),)], "value string").write.mode("overwrite").text(f"{path}/meta")
    return path


def load_demand_model(spark: SparkSession, path: str) -> DemandModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    meta["scaler"] = {k: tuple(v) for k, v in meta["scaler"].items()}
    kinds = {c.__name__: c for c in (GBTRegressionModel, RandomForestRegressionModel)}
    return DemandModel(kinds[meta.pop("class")].load(f"{path}/model"), **meta)
