"""Forecast models: naive, least squares on MLlib and boosted trees, their search and attribution."""

from __future__ import annotations

import math
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions.labels import clamp_prediction
from tidedock.functions.timefns import interval
from tidedock.operators import boosting
from tidedock.operators.boosting import best_round  # noqa: F401
from tidedock.operators.curate import newest_rows
from tidedock.operators.metrics import regression_metrics
from tidedock.staging import stage

# Boosting defaults.
BOOSTING = {
    "stepSize": 0.05, "maxIter": 1000, "seed": 42, "regAlpha": 0.0, "subsamplingRate": 1.0, "columnShare": 1.0, "numLeaves": None,
}
PATIENCE = 50
PRESETS = {
    "lgbm": {**BOOSTING, "numLeaves": 31, "maxDepth": 5, "maxBins": 64, "minInstancesPerNode": 20, "regLambda": 0.0},
    "xgb": {**BOOSTING, "maxDepth": 6, "maxBins": 32, "minInstancesPerNode": 1, "regLambda": 1.0},
}
# Searched ranges; learning rate and both penalties are drawn on a log scale.
SEARCH_SPACE = {
    "num_leaves": (20, 100),
    "learning_rate": (0.01, 0.3),
    "max_depth": (3, 12),
    "min_child_samples": (5, 100),
    "subsample": (0.5, 1.0),
    "colsample_bytree": (0.5, 1.0),
    "reg_alpha": (1e-8, 10.0),
    "reg_lambda": (1e-8, 10.0),
}
LOG_SCALE = ("learning_rate", "reg_alpha", "reg_lambda")


class NaiveBaseline:
    """Predicts the previous observation, ``bikes_lag_1``."""

    def fit(self, train: DataFrame) -> NaiveBaseline:
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.col("bikes_lag_1").cast("double"))


def _assembler(columns: list[str] = schemas.FEATURE_COLS) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features")


def _numeric(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in [*schemas.FEATURE_COLS, schemas.TARGET_COL] if c in df.columns})


def fit_linear(train: DataFrame, features: list[str] = schemas.FEATURE_COLS) -> PipelineModel:
    """Ordinary least squares by distributed normal equations, one pass over the rows."""
    regression = LinearRegression(labelCol=schemas.TARGET_COL, solver="normal", regParam=0.0)
    return Pipeline(stages=[_assembler(features), regression]).fit(_numeric(train))


def fit_boosted(
    train: DataFrame, val: DataFrame | None = None, preset: str = "lgbm", stop_early: bool | None = None,
    patience: int = PATIENCE, path: str | None = None, **overrides,
) -> boosting.BoostedTrees:
    """Boosted trees on squared error, ``maxIter`` rounds at most.

    With a validation frame the error after every round is measured there (mean absolute error). Boosting
    ends once ``patience`` rounds in a row have not improved it, and the model of the best round is returned. A fit that
    is given a ``path`` keeps its state there and goes on from it when called again.
    """
    params = {**PRESETS[preset], **overrides}
    stop_early = preset == "lgbm" if stop_early is None else stop_early
    how = boosting.Growth(
        rate=params["stepSize"], depth=params["maxDepth"], leaves=params["numLeaves"], bins=params["maxBins"],
        least_rows=params["minInstancesPerNode"], l1=params["regAlpha"], l2=params["regLambda"],
        row_share=params["subsamplingRate"], column_share=params["columnShare"], seed=params["seed"],
    )
    held = val if stop_early else None
    return boosting.fit(train, held, schemas.FEATURE_COLS, how, params["maxIter"], patience, path)


def score(model, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction``; works for a fitted pipeline and for the naive model."""
    scored = model.transform(df)
    return scored.drop("features") if "features" in scored.columns else scored


def score_saved(spark, path: str, df: DataFrame) -> DataFrame:
    return score(load_model(spark, path), df)


def load_model(spark, path: str):
    """A written pipeline or boosted model."""
    meta = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/nodes")
    boosted = meta.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(meta)
    return boosting.BoostedTrees.load(spark, path) if boosted else PipelineModel.load(path)


def compare_models(models: dict[str, object], test: DataFrame) -> DataFrame:
    """Metrics of all models from one pass over the test rows."""
    scored = test
    for name, model in models.items():
        scored = score(model, scored).withColumnRenamed("prediction", f"p_{name}")
    keep = scored.select(schemas.TARGET_COL, *[F.col(f"p_{n}").alias(n) for n in models])
    long = keep.unpivot([schemas.TARGET_COL], list(models), "model", "prediction")
    return regression_metrics(long, schemas.TARGET_COL, "prediction", ["model"])


def feature_importance(model: boosting.BoostedTrees) -> DataFrame:
    """Total gain of the splits of each feature, largest first."""
    rows = model.by_feature("gain")
    return _session().createDataFrame(rows, schemas.IMPORTANCE).orderBy(F.col("importance").desc(), "feature")


def split_counts(model: boosting.BoostedTrees) -> DataFrame:
    """How often each feature is split on."""
    rows = model.by_feature("split")
    return _session().createDataFrame(rows, schemas.IMPORTANCE).orderBy(F.col("importance").desc(), "feature")


def tree_attribution(model: boosting.BoostedTrees, df: DataFrame) -> DataFrame:
    """Mean absolute contribution of each feature along the decision paths, largest first."""
    names = F.array(*[F.lit(c) for c in model.features])
    pairs = model.contributions(df).select(F.explode(F.arrays_zip(names.alias("feature"), F.col("contributions"))).alias("p"))
    means = pairs.groupBy(F.col("p.feature").alias("feature")).agg(F.avg(F.abs("p.contributions")).alias("mean_abs_contribution"))
    return means.orderBy(F.col("mean_abs_contribution").desc(), "feature")


def sample_params(rng: random.Random) -> dict[str, float]:
    """One seeded draw from the search space; rates on a log scale."""
    drawn: dict[str, float] = {}
    for name, (low, high) in SEARCH_SPACE.items():
        if name in LOG_SCALE:
            drawn[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            drawn[name] = rng.randint(low, high) if isinstance(low, int) else rng.uniform(low, high)
    return drawn


def boosting_params(drawn: dict[str, float]) -> dict[str, object]:
    """Drawn values as tree parameters."""
    return {
        "numLeaves": int(drawn["num_leaves"]),
        "maxDepth": int(drawn["max_depth"]),
        "stepSize": drawn["learning_rate"],
        "minInstancesPerNode": int(drawn["min_child_samples"]),
        "subsamplingRate": drawn["subsample"],
        "columnShare": drawn["colsample_bytree"],
        "regAlpha": drawn["reg_alpha"],
        "regLambda": drawn["reg_lambda"],
    }


def tune_boosted(train: DataFrame, val: DataFrame, n_trials: int = 50, seed: int = 42, max_iter: int = BOOSTING["maxIter"]) -> DataFrame:
    """One row per trial with its parameters and MAE on the temporal validation rows, best first.

    Each trial is a distributed fit over the same written train and validation tables.
    """
    train, val = stage(train, "tune-train"), stage(val, "tune-val")
    rng = random.Random(seed)
    rows = []
    for trial in range(n_trials):
        drawn = sample_params(rng)
        model = fit_boosted(train, val, maxIter=max_iter, **boosting_params(drawn))
        mae = regression_metrics(score(model, val), schemas.TARGET_COL, "prediction").first()["mae"]
        rows.append((trial, float(mae), *[float(drawn[k]) for k in SEARCH_SPACE]))
    schema = "trial int, mae double, " + ", ".join(f"{k} double" for k in SEARCH_SPACE)
    return train.sparkSession.createDataFrame(rows, schema).orderBy("mae", "trial")


def latest_feature_rows(df: DataFrame) -> DataFrame:
    """Newest row per station."""
    return newest_rows(df, "station_id", "timestamp", ["timestamp"])


def predict_latest(
    model, df: DataFrame, station_ids: DataFrame | None, as_of: Column, model_name: str, horizon: str = "15 minutes"
) -> DataFrame:
    """Clamped prediction for the newest row of each requested station; ``known`` is false without rows."""
    rows = df if station_ids is None else df.join(station_ids.select("station_id").distinct(), "station_id", "left_semi")
    scored = score(model, latest_feature_rows(rows)).select(
        "station_id", clamp_prediction(F.col("prediction")).alias("predicted_bikes")
    )
    if station_ids is not None:
        scored = station_ids.select("station_id").distinct().join(scored, "station_id", "left")
    return scored.select(
        "station_id",
        "predicted_bikes",
        F.col("predicted_bikes").isNotNull().alias("known"),
        (as_of + interval(horizon)).alias("target_time"),
        F.lit(model_name).alias("model_name"),
    )


def linear_attribution(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Mean absolute contribution ``coefficient * (x - mean(x))`` per feature of a linear model."""
    coefficients = dict(zip(schemas.FEATURE_COLS, [float(c) for c in model.stages[-1].coefficients]))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in schemas.FEATURE_COLS])
    centre = values.agg(F.struct(*[F.avg(c).alias(c) for c in schemas.FEATURE_COLS]).alias("m")).scalar()
    means = values.agg(
        *[F.avg(F.abs(F.lit(k) * (F.col(c) - centre[c]))).alias(c) for c, k in coefficients.items()]
    )
    return means.unpivot([], schemas.FEATURE_COLS, "feature", "mean_abs_contribution").orderBy(
        F.col("mean_abs_contribution").desc(), "feature"
    )


def permutation_importance(
    model: PipelineModel, df: DataFrame, features: list[str] = schemas.FEATURE_COLS, seed: int = 42,
    block_rows: int = 10_000,
) -> DataFrame:
    """Rise of the MAE when one feature is shuffled.

    Rows are dealt into random blocks; inside a block every row takes the feature value of the next
    row in hash order and the last takes the first one's, which is a permutation of the column. All
    shuffled versions of a row are scored in one pass.
    """
    n_rows = df.count()
    blocks = max(1, math.ceil(n_rows / block_rows))
    place = F.xxhash64("station_id", "timestamp", F.lit(seed))
    rows = _numeric(df.select("station_id", "timestamp", *schemas.FEATURE_COLS, schemas.TARGET_COL))
    rows = rows.withColumn("_h", place).withColumn(
        "_block", F.pmod(F.xxhash64("station_id", "timestamp", F.lit(seed + 1)), F.lit(blocks))
    )
    order = W.partitionBy("_block").orderBy("_h", "station_id", "timestamp")
    wrap = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    shifted = rows.withColumn("_v", F.array(*schemas.FEATURE_COLS))
    shifted = shifted.withColumn("_w", F.coalesce(F.lead("_v").over(order), F.first("_v").over(wrap)))
    index = {c: i for i, c in enumerate(schemas.FEATURE_COLS)}
    versions = [
        F.struct(
            F.lit(c).alias("feature"),
            F.array(*[F.col("_w" if j == index[c] else "_v")[j] for j in range(len(index))]).alias("x"),
        )
        for c in features
    ] + [F.struct(F.lit("").alias("feature"), F.col("_v").alias("x"))]
    long = shifted.select(schemas.TARGET_COL, F.explode(F.array(*versions)).alias("e")).select(
        schemas.TARGET_COL, "e.feature", array_to_vector("e.x").alias("features")
    )
    scored = model.stages[-1].transform(long)
    errors = scored.groupBy("feature").agg(F.avg(F.abs(F.col(schemas.TARGET_COL) - F.col("prediction"))).alias("mae"))
    per_feature = errors.agg(
        F.max(F.when(F.col("feature") == "", F.col("mae"))).alias("base"),
        F.collect_list(F.when(F.col("feature") != "", F.struct("feature", "mae"))).alias("all"),
    )
    return (
        per_feature.select("base", F.explode("all").alias("e"))
        .select("e.feature", "e.mae", (F.col("e.mae") - F.col("base")).alias("mae_increase"))
        .orderBy(F.col("mae_increase").desc(), "feature")
    )


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()
