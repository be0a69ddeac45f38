"""Key-based merges on plain tables: append-if-absent, last-write-wins, backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedock.functions.labels import null_if_nan


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Earliest row per key. An aggregate, so each map task already reduces a repeated key to one row."""
    return _pick(df, keys, order_by, F.min_by)


def last_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    return _pick(df, keys, order_by, F.max_by)


def _pick(df: DataFrame, keys: list[str], order_by: list[str], choose) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    order = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    picked = df.groupBy(*keys).agg(choose(F.struct(*payload), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def new_rows(target: DataFrame | None, batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Rows of ``batch`` that an insert skipping existing keys would add.

    Inside the batch the first row per key in ``order_by`` order wins. Equal places in that order are decided by the
    other columns, so the result never depends on how the batch is spread.
    """
    rest = [c for c in batch.columns if c not in (*keys, *order_by)]
    # A rank and not ``first_per_key``: whole rows as aggregates take two sorts and no generated code. Spark limits such
    # a rank to one before the shuffle too, so each map task already reduces a repeated key to one row.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by, *rest))
    unique = batch.withColumn("_place", place).where("_place = 1").drop("_place")
    return unique if target is None else unique.join(target.select(*keys), keys, "left_anti")


def append_ignore_conflicts(
    target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str]
) -> DataFrame:
    """The table after the insert: existing rows are never touched."""
    fresh = new_rows(target, batch, keys, order_by)
    return target.unionByName(fresh.select(*target.columns))


def upsert_latest_wins(
    current: DataFrame | None, batch: DataFrame, keys: list[str], seq: str, as_of: Column, stamp: str = "updated_at"
) -> DataFrame:
    """The snapshot after the upsert: the batch beats the table, later batch rows beat earlier ones."""
    winners = last_per_key(batch, keys, [seq]).drop(seq).withColumn(stamp, as_of)
    if current is None:
        return winners
    kept = current.join(winners.select(*keys), keys, "left_anti")
    return kept.unionByName(winners.select(*current.columns))


def first_actuals(actuals: DataFrame, order_by: list[str]) -> DataFrame:
    """The observation per ``(station_id, target_time)`` that a backfill uses: the first known one in ``order_by`` order."""
    known = actuals.withColumn("actual_value", null_if_nan(F.col("actual_value").cast("double"))).where("actual_value IS NOT NULL")
    order = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    return known.groupBy("station_id", "target_time").agg(F.min_by("actual_value", order).alias("actual_value"))


def backfill_actuals(predictions: DataFrame, actuals: DataFrame, order_by: list[str]) -> DataFrame:
    """Set missing ``actual_value`` from observations at exactly ``(station_id, target_time)``.

    All models are filled alike; the first observation per key in ``order_by`` order is the one used. Null and
    NaN are missing on both sides. The extra column ``updated`` marks the rows that changed.
    """
    return fill_actuals(predictions, first_actuals(actuals, order_by))


def fill_actuals(predictions: DataFrame, observed: DataFrame) -> DataFrame:
    """``backfill_actuals`` from one observation per key, as ``first_actuals`` gives them."""
    keys = ["station_id", "target_time"]
    predictions = predictions.withColumn("actual_value", null_if_nan(F.col("actual_value").cast("double")))
    joined = predictions.join(observed.withColumnRenamed("actual_value", "_observed"), keys, "left")
    return joined.select(
        *[c for c in predictions.columns if c != "actual_value"],
        F.coalesce("actual_value", "_observed").alias("actual_value"),
        (F.col("actual_value").isNull() & F.col("_observed").isNotNull()).alias("updated"),
    )


def prediction_records(
    scored: DataFrame, model_name: str, run_at: Column, horizon: str = "15 minutes", prediction: str = "prediction"
) -> DataFrame:
    """Scored rows as prediction records: one run time, target one step after the features."""
    return scored.select(
        F.col("station_id").cast("string").alias("station_id"),
        run_at.alias("prediction_time"),
        (F.col("timestamp") + F.expr(f"INTERVAL '{horizon}'")).alias("target_time"),
        F.lit(model_name).alias("model_name"),
        F.col(prediction).cast("double").alias("predicted_value"),
    )
