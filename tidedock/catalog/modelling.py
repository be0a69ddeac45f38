"""Queries: error metrics, models, drift, monitoring and anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.catalog import adapters as a
from tidedock.catalog.oracles import (
    PREDICTIONS, STATUS, STUCK, drift_ctes, feature_ctes, feature_long, metrics, series_ctes, split_ctes, with_,
)
from tidedock.catalog.registry import query
from tidedock.functions import labels
from tidedock.functions.stats import mae_alert as mae_alert_expr
from tidedock.operators import aggregates, anomaly, drift, models, profiles
from tidedock.operators import metrics as m
from tidedock.plans import anomalies as anomaly_plan
from tidedock.plans import monitoring, training
from tidedock.sources import tables
from tidedock.staging import stage

ERRORS = ["mae", "rmse", "r2"]
PLACE = ["lat", "lon"]
TEST = "test AS (SELECT *, bikes_lag_1 AS naive, bikes_rolling_mean_1h AS mean FROM splits WHERE split = 'test')"


def _naive(df):
    return models.score(models.NaiveBaseline(), df)


# -- metrics -------------------------------------------------------------------------------------


@query(
    "naive_metrics",
    with_(f"{split_ctes()}, {TEST}", f"SELECT {metrics('y', 'naive')} FROM test", ERRORS),
)
def naive_metrics(spark, sf):
    return m.regression_metrics(_naive(a.test_split(spark, sf)), "y", "prediction")


@query(
    "regression_metrics",
    with_(f"{feature_ctes()}, {PREDICTIONS}", f"""SELECT model_name, {metrics('actual_value', 'predicted_value')},
      count(*) AS n FROM predictions GROUP BY 1""", ERRORS),
)
def regression_metrics(spark, sf):
    return m.regression_metrics(
        a.predictions(spark, sf), "actual_value", "predicted_value", ["model_name"], with_count=True
    )


@query(
    "metrics_by_station",
    with_(f"{split_ctes()}, {TEST}", f"SELECT station_id, {metrics('y', 'naive')} FROM test GROUP BY 1", ERRORS),
)
def metrics_by_station(spark, sf):
    return m.metrics_by_station(_naive(a.test_split(spark, sf)))


@query(
    "metrics_by_hour",
    with_(f"{split_ctes()}, {TEST}", f"SELECT hour, {metrics('y', 'naive')} FROM test GROUP BY 1", ERRORS),
)
def metrics_by_hour(spark, sf):
    return m.metrics_by_hour(_naive(a.test_split(spark, sf)))


MODEL_ROWS = f"""{split_ctes()}, {TEST}, scored AS (
  SELECT 'naive' AS model, {metrics('y', 'naive')} FROM test
  UNION ALL SELECT 'mean', {metrics('y', 'mean')} FROM test)"""


def _compared(spark, sf):
    test = a.test_split(spark, sf)
    long = test.select("y", F.col("bikes_lag_1").alias("naive"), F.col("bikes_rolling_mean_1h").alias("mean"))
    return m.regression_metrics(long.unpivot(["y"], ["naive", "mean"], "model", "prediction"), "y", "prediction", ["model"])


@query(
    "model_improvement",
    with_(MODEL_ROWS, """SELECT model, mae, rmse, r2,
      (1 - mae / (SELECT mae FROM scored WHERE model = 'naive')) * 100 AS improvement_pct FROM scored""",
          [*ERRORS, "improvement_pct"]),
)
def model_improvement(spark, sf):
    return m.model_improvement(_compared(spark, sf))


def _extreme(order: str) -> str:
    return with_(f"{split_ctes()}, {TEST}", f"""SELECT * FROM (SELECT station_id, {metrics('y', 'naive')}
      FROM test GROUP BY 1) ORDER BY mae {order}, station_id LIMIT 10""", ERRORS)


@query("hardest_stations", _extreme("DESC"))
def hardest_stations(spark, sf):
    return m.extreme_stations(m.metrics_by_station(_naive(a.test_split(spark, sf))), 10)


@query("easiest_stations", _extreme("ASC"))
def easiest_stations(spark, sf):
    return m.extreme_stations(m.metrics_by_station(_naive(a.test_split(spark, sf))), 10, hardest=False)


@query(
    "predict_latest",
    with_(f"{split_ctes()}, {TEST}", """SELECT i.station_id, p.predicted_bikes,
      p.predicted_bikes IS NOT NULL AS known, TIMESTAMP '2024-01-31 00:15:00' AS target_time, 'naive' AS model_name
      FROM station_information i LEFT JOIN (SELECT station_id,
        greatest(0.0, round_even(arg_max(naive, "timestamp"), 2)) AS predicted_bikes FROM test GROUP BY 1) p
      ON p.station_id = i.station_id""", ["predicted_bikes"]),
)
def predict_latest(spark, sf):
    requested = a.information(spark, sf).select("station_id")
    return models.predict_latest(models.NaiveBaseline(), a.test_split(spark, sf), requested, a.as_of(), "naive")


# -- models --------------------------------------------------------------------------------------


def _staged_splits(spark, sf):
    rows = a.splits(spark, sf)
    return {s: rows.where(F.col("split") == s) for s in ("train", "val", "test")}


@query("linear_regression_predictions")
def linear_regression_predictions(spark, sf):
    parts = _staged_splits(spark, sf)
    scored = models.score(models.fit_linear(parts["train"]), parts["test"])
    return scored.select("station_id", "timestamp", "y", "prediction")


@query("gbt_predictions")
def gbt_predictions(spark, sf):
    parts = _staged_splits(spark, sf)
    model = models.fit_boosted(parts["train"], parts["val"], "lgbm")
    return models.score(model, parts["test"]).select("station_id", "timestamp", "y", "prediction")


@query("xgb_predictions")
def xgb_predictions(spark, sf):
    parts = _staged_splits(spark, sf)
    model = models.fit_boosted(parts["train"], None, "xgb")
    return models.score(model, parts["test"]).select("station_id", "timestamp", "y", "prediction")


@query("model_comparison")
def model_comparison(spark, sf):
    return m.model_improvement(training.train_and_compare(a.splits(spark, sf)))


@query("feature_importance")
def feature_importance(spark, sf):
    parts = _staged_splits(spark, sf)
    return models.feature_importance(models.fit_boosted(parts["train"], parts["val"]))


@query("feature_split_counts")
def feature_split_counts(spark, sf):
    parts = _staged_splits(spark, sf)
    return models.split_counts(models.fit_boosted(parts["train"], parts["val"]))


@query("tree_attribution")
def tree_attribution(spark, sf):
    parts = _staged_splits(spark, sf)
    return models.tree_attribution(models.fit_boosted(parts["train"], parts["val"]), parts["test"])


@query("linear_attribution")
def linear_attribution(spark, sf):
    parts = _staged_splits(spark, sf)
    return models.linear_attribution(models.fit_linear(parts["train"]), parts["test"])


@query("permutation_importance")
def permutation_importance(spark, sf):
    parts = _staged_splits(spark, sf)
    return models.permutation_importance(models.fit_linear(parts["train"]), parts["test"])


# -- drift ---------------------------------------------------------------------------------------

DRIFT = ["psi", "ks_statistic", "ks_p_value"]
FEATURE_DRIFT = f"{split_ctes()}, {drift_ctes('feature', feature_long())}"
VERDICT = """SELECT *, psi > 0.2 OR ks_p_value < 0.05 AS drifted,
  CASE WHEN psi > 0.2 OR ks_p_value < 0.05 THEN 'Drifted' ELSE 'Stable' END AS status,
  CASE WHEN psi > 0.2 THEN 'significant' WHEN psi > 0.1 THEN 'moderate' ELSE 'stable' END AS severity FROM drift"""


def _split_long(spark, sf):
    return drift.split_sides(a.drift_splits(spark, sf), schemas.FEATURE_COLS)


@query(
    "psi",
    with_(f"{split_ctes()}, {drift_ctes('feature', feature_long(), 20)}", "SELECT feature, psi FROM drift", ["psi"]),
)
def psi(spark, sf):
    return drift.psi_scores(_split_long(spark, sf), n_bins=20).select("feature", "psi")


@query("ks_statistic", with_(FEATURE_DRIFT, "SELECT feature, ks_statistic FROM drift", ["ks_statistic"]))
def ks_statistic(spark, sf):
    return drift.ks_statistics(_split_long(spark, sf)).select("feature", "ks_statistic")


@query("ks_p_value", with_(FEATURE_DRIFT, "SELECT feature, ks_p_value FROM drift", ["ks_p_value"]))
def ks_p_value(spark, sf):
    return drift.compare_distributions(_split_long(spark, sf)).select("feature", "ks_p_value")


HALVES = """SELECT station_id, num_bikes_available AS value, (hour(last_reported) < 12)::INT AS ref,
  (hour(last_reported) >= 12)::INT AS cur FROM status"""
#: The share of orderings that reach the statistic, diagonal by diagonal, as one list per station.
EXACT_KS = f"""{STATUS}, {drift_ctes('station_id', HALVES)},
start AS (SELECT station_id, nr::BIGINT AS n, nc::BIGINT AS m, round(ks_statistic * nr * nc)::BIGINT AS g
  FROM ks JOIN lim USING (station_id) WHERE nr >= 2 AND nc >= 2),
sweep AS (
  SELECT station_id, n, m, g, 0::BIGINT AS s, [CASE WHEN g <= 0 THEN 1.0::DOUBLE ELSE 0.0 END FOR i IN range(n + 1)] AS b
  FROM start WHERE n * m <= 250000
  UNION ALL
  SELECT station_id, n, m, g, s + 1, list_transform(range(n + 1), lambda i: CASE WHEN abs(i * m - (s + 1 - i) * n) >= g THEN 1.0
    ELSE (CASE WHEN i > 0 THEN i * b[i] ELSE 0 END + greatest(s + 1 - i, 0) * b[i + 1]) / (s + 1)::DOUBLE END)
  FROM sweep WHERE s < n + m)"""


@query(
    "station_ks",
    f"""WITH RECURSIVE {EXACT_KS} SELECT station_id, round(ks_statistic, 6) AS ks_statistic, n AS n_ref, m AS n_cur,
      round(coalesce(w.b[w.n + 1], ks_p_value), 6) AS ks_p_value
      FROM start JOIN drift USING (station_id)
      LEFT JOIN (SELECT station_id, n, b FROM sweep WHERE s = n + m) w USING (station_id)""".replace("n AS n_ref", "start.n AS n_ref"),
)
def station_ks(spark, sf):
    """Loads of each station before and after noon; stations have few reports, so most p-values are exact."""
    early = F.hour("last_reported") < 12
    long = a.status(spark, sf).select(
        "station_id",
        F.col("num_bikes_available").cast("double").alias("value"),
        early.cast("int").alias("ref"),
        (~early).cast("int").alias("cur"),
    )
    return drift.with_p_values(drift.ks_statistics(long, "station_id"))


@query("feature_drift", with_(FEATURE_DRIFT, VERDICT, DRIFT))
def feature_drift(spark, sf):
    return drift.ranked(drift.split_feature_drift(a.drift_splits(spark, sf)))


#: Days up to this one are the reference side of stored profiles, later ones the current side.
PROFILE_CUT = "2024-01-20"


@query(
    "feature_drift_from_profiles",
    with_(f"""{split_ctes()}, {drift_ctes('feature', feature_long(
        f'"timestamp" < DATE {chr(39)}{PROFILE_CUT}{chr(39)}', f'"timestamp" >= DATE {chr(39)}{PROFILE_CUT}{chr(39)}'))}""",
          VERDICT, DRIFT),
)
def feature_drift_from_profiles(spark, sf):
    counts = stage(profiles.daily_counts(a.drift_features(spark, sf)), "daily-counts")
    early = F.col("day") < F.lit(PROFILE_CUT).cast("date")
    return profiles.feature_drift_from_profiles(counts, early, ~early)


@query(
    "feature_summary_sketched",
    with_(f"""{feature_ctes()}, long AS (SELECT feature, value FROM (SELECT {', '.join(
        f'CAST({c} AS DOUBLE) AS {c}' for c in schemas.FEATURE_COLS)} FROM features)
      UNPIVOT (value FOR feature IN ({', '.join(schemas.FEATURE_COLS)})))""",
          """SELECT feature, count(*) AS n, avg(value) AS mean, min(value) AS min, max(value) AS max,
      true AS q25_within, true AS q50_within, true AS q75_within FROM long GROUP BY 1""", ["mean", "min", "max"]),
)
def feature_summary_sketched(spark, sf):
    """Daily sketches merged over all days; the flags compare each estimate's exact rank with 1 % tolerance."""
    rows = a.staged_features(spark, sf)
    summary = profiles.merged_summary(profiles.daily_sketches(rows), ["feature"])
    checked = profiles.quantiles_within(summary, profiles.daily_counts(rows), 0.01)
    return checked.select("feature", "n", "mean", "min", "max", "q25_within", "q50_within", "q75_within")


@query(
    "drift_summary",
    with_(FEATURE_DRIFT, f"""SELECT *, CASE WHEN drift_score * 100 < 20 THEN 'low' WHEN drift_score * 100 < 50
      THEN 'medium' ELSE 'high' END AS severity FROM (SELECT count(*) FILTER (WHERE drifted) / count(*) AS drift_score,
        count(*) AS n_features, count(*) FILTER (WHERE drifted) AS n_drifted, avg(psi) AS avg_psi, max(psi) AS max_psi
        FROM ({VERDICT}))""", ["drift_score", "avg_psi", "max_psi"]),
)
def drift_summary(spark, sf):
    return drift.drift_summary(drift.split_feature_drift(a.drift_splits(spark, sf)))


@query(
    "data_drift_table",
    with_(f"{split_ctes()}, {drift_ctes('feature', feature_long(current=chr(39) + 'val' + chr(39) + ' = split'))}",
          VERDICT, DRIFT),
)
def data_drift_table(spark, sf):
    rows = a.drift_splits(spark, sf)
    side = lambda s: rows.where(F.col("split") == s).select(*schemas.FEATURE_COLS)
    return drift.data_drift_table(side("train"), side("val"))


@query(
    "regression_quality_table",
    with_(split_ctes(), f"""SELECT side, {metrics('y', 'bikes_lag_1')}, count(*) AS n, avg(bikes_lag_1 - y) AS mean_error,
      stddev_samp(bikes_lag_1 - y) AS error_std FROM (SELECT *, CASE split WHEN 'train' THEN 'reference'
        ELSE 'current' END AS side FROM splits WHERE split <> 'val') GROUP BY 1""",
          [*ERRORS, "mean_error", "error_std"]),
)
def regression_quality_table(spark, sf):
    rows = a.splits(spark, sf).withColumnsRenamed({"y": "target", "bikes_lag_1": "prediction"})
    side = lambda s: rows.where(F.col("split") == s)
    return drift.regression_quality_table(side("train"), side("test"))


BASELINES = f"""baselines AS (
  SELECT 'naive' AS model_name, avg(abs(y - bikes_lag_1)) AS baseline_mae FROM splits WHERE split = 'train'
  UNION ALL SELECT 'mean', avg(abs(y - bikes_rolling_mean_1h)) FROM splits WHERE split = 'train')"""
PAIR_LONG = """SELECT model_name, actual_value AS value, 1.0 AS ref, 0.0 AS cur FROM pairs
  UNION ALL SELECT model_name, predicted_value, 0.0, 1.0 FROM pairs"""
REPORT = f"""{split_ctes()}, {PREDICTIONS}, {BASELINES},
pairs AS (SELECT * FROM predictions WHERE target_time >= TIMESTAMP '2024-01-24 00:00:00'),
{drift_ctes('model_name', PAIR_LONG)},
errors AS (SELECT model_name, avg(abs(actual_value - predicted_value)) AS current_mae, count(*) AS n_predictions
  FROM pairs GROUP BY 1 HAVING count(*) >= 96)"""
REPORT_DOUBLES = ["current_mae", "baseline_mae", "psi_score", "ks_statistic", "ks_p_value"]


@query(
    "drift_report",
    with_(REPORT, """SELECT model_name, current_mae, baseline_mae,
      CASE WHEN baseline_mae <= 0 THEN current_mae > 0 ELSE current_mae > baseline_mae * 1.2::DOUBLE END AS mae_alert,
      psi AS psi_score, ks_statistic, ks_p_value, ks_p_value < 0.05 AS distribution_drift, n_predictions
      FROM errors JOIN baselines USING (model_name) JOIN drift USING (model_name)""", REPORT_DOUBLES),
)
def drift_report(spark, sf):
    rows = a.splits(spark, sf)
    pairs = monitoring.recent_pairs(a.predictions_of(rows), a.as_of(), 7)
    return drift.drift_report(pairs, a.baselines_of(rows))


@query(
    "mae_alert",
    with_(f"{split_ctes()}, {TEST}", """SELECT station_id, mae AS current_mae,
      mae > base * 1.2::DOUBLE AS alert FROM (SELECT station_id, avg(abs(y - naive)) AS mae FROM test GROUP BY 1),
      (SELECT avg(abs(y - bikes_lag_1)) AS base FROM splits WHERE split = 'train')""", ["current_mae"]),
)
def mae_alert(spark, sf):
    rows = _naive(a.splits(spark, sf))
    side = lambda s: rows.where(F.col("split") == s)
    base = m.regression_metrics(side("train"), "y", "prediction").select("mae").scalar()
    per_station = m.metrics_by_station(side("test"))
    return per_station.select(
        "station_id", F.col("mae").alias("current_mae"), mae_alert_expr(F.col("mae"), base).alias("alert")
    )


@query(
    "monitoring_status",
    with_(REPORT, """SELECT w.model_name, coalesce(n_predictions, 0) AS n_predictions, current_mae,
      CASE WHEN b.model_name IS NULL THEN 'unknown_model' WHEN n_predictions IS NULL THEN 'no_data'
        WHEN current_mae > baseline_mae * 1.2::DOUBLE THEN 'alert' ELSE 'ok' END AS status
      FROM (SELECT DISTINCT model_name FROM predictions UNION ALL SELECT DISTINCT event_type FROM events) w
      LEFT JOIN errors e ON e.model_name = w.model_name LEFT JOIN baselines b ON b.model_name = w.model_name""",
          ["current_mae"]),
)
def monitoring_status(spark, sf):
    rows = a.splits(spark, sf)
    predictions = a.predictions_of(rows)
    asked = predictions.select("model_name").unionByName(
        a.table(spark, sf, "events").select(F.col("event_type").alias("model_name"))
    )
    return monitoring.monitoring_status(predictions, a.baselines_of(rows), asked, a.as_of(), 7)


ROLL = "CASE WHEN count(*) OVER w = 96 THEN avg(abs(y - bikes_lag_1)) OVER w END AS rolling_mae"


@query(
    "rolling_mae_by_station",
    with_(feature_ctes(), f"""SELECT station_id, "timestamp", {ROLL} FROM features
      WINDOW w AS (PARTITION BY station_id ORDER BY "timestamp" ROWS BETWEEN 95 PRECEDING AND CURRENT ROW)""",
          ["rolling_mae"]),
)
def rolling_mae_by_station(spark, sf):
    out = drift.rolling_mae_by_station(a.features(spark, sf), "y", "bikes_lag_1", "timestamp")
    return out.select("station_id", "timestamp", "rolling_mae")


@query(
    "rolling_mae_global",
    with_(split_ctes(), f"""SELECT "timestamp", station_id, {ROLL},
      row_number() OVER (ORDER BY "timestamp", station_id) - 1 AS idx FROM splits WHERE split = 'test'
      WINDOW w AS (ORDER BY "timestamp", station_id ROWS BETWEEN 95 PRECEDING AND CURRENT ROW)""", ["rolling_mae"]),
)
def rolling_mae_global(spark, sf):
    return drift.rolling_mae_global(
        a.test_split(spark, sf), "y", "bikes_lag_1", ["timestamp", "station_id"], block_rows=1000
    )


# -- anomalies -----------------------------------------------------------------------------------

STUCK_SERIES = f"{series_ctes()}, {STUCK.format(src='series')}"


@query(
    "stuck_stations",
    with_(STUCK_SERIES, "SELECT * FROM stuck_all WHERE duration_hours >= 2", ["duration_hours"]),
)
def stuck_stations(spark, sf):
    return anomaly.stuck_stations(a.series(spark, sf))


@query(
    "stuck_stations_half_hour",
    with_(STUCK_SERIES, "SELECT * FROM stuck_all WHERE duration_hours >= 0.5", ["duration_hours"]),
)
def stuck_stations_half_hour(spark, sf):
    return anomaly.stuck_stations(a.series(spark, sf), 0.5)


@query(
    "top_stuck_stations",
    with_(STUCK_SERIES, """SELECT * FROM stuck_all WHERE duration_hours >= 0.5
      ORDER BY duration_hours DESC, station_id LIMIT 20""", ["duration_hours"]),
)
def top_stuck_stations(spark, sf):
    return anomaly.top_stuck(anomaly.stuck_stations(a.series(spark, sf), 0.5))


@query(
    "stuck_table",
    with_(STUCK_SERIES, """SELECT coalesce(i.name, s.station_id) AS station_name, s.station_id,
      round_even(duration_hours, 1) AS duration_hours, last_bikes, is_renting,
      coalesce(strftime(last_change, '%Y-%m-%d %H:%M'), 'Never (in window)') AS last_change
      FROM stuck_all s LEFT JOIN station_information i ON i.station_id = s.station_id
      WHERE duration_hours >= 0.5""", ["duration_hours"]),
)
def stuck_table(spark, sf):
    names = tables.station_names(a.information(spark, sf))
    return anomaly.stuck_table(anomaly.stuck_stations(a.series(spark, sf), 0.5), names)


ACTIVITY = ["avg_bikes", "std_bikes", "zero_pct", "change_rate", "avg_docks", "capacity"]


@query(
    "station_activity",
    with_(STUCK_SERIES, """SELECT station_id, avg(num_bikes_available) AS avg_bikes,
      stddev_pop(num_bikes_available) AS std_bikes, avg(CASE WHEN num_bikes_available = 0 THEN 1.0 ELSE 0.0 END)
        AS zero_pct,
      CASE WHEN count(*) > 1 THEN count(*) FILTER (WHERE num_bikes_available <> prev) / (count(*) - 1) ELSE 0.0 END AS change_rate,
      avg(num_docks_available) AS avg_docks, CAST(arg_min(capacity, "timestamp") AS DOUBLE) AS capacity
      FROM moves GROUP BY 1""", ACTIVITY),
)
def station_activity(spark, sf):
    return anomaly.station_activity(a.series(spark, sf))


@query(
    "activity_histogram",
    with_(f"""{STUCK_SERIES}, act AS (SELECT station_id,
      count(*) FILTER (WHERE num_bikes_available <> prev) / (count(*) - 1) AS change_rate FROM moves GROUP BY 1)""",
          """SELECT CAST(b AS INTEGER) AS bin, lo + b * w AS bin_low, lo + (b + 1) * w AS bin_high,
      coalesce(c.n, 0) AS n FROM range(0, 30) s(b),
      (SELECT min(change_rate) AS lo, (max(change_rate) - min(change_rate)) / 30.0 AS w FROM act) l
      LEFT JOIN (SELECT len([i FOR i IN range(1, 30) IF change_rate >= lo + i * w]) AS bin, count(*) AS n
        FROM act, (SELECT min(change_rate) AS lo, (max(change_rate) - min(change_rate)) / 30.0 AS w FROM act)
        GROUP BY ALL) c ON c.bin = b""", ["bin_low", "bin_high"]),
)
def activity_histogram(spark, sf):
    return aggregates.histogram(anomaly.station_activity(a.series(spark, sf)), "change_rate", 30)


@query("isolation_forest")
def isolation_forest(spark, sf):
    from tidedock.operators.forest import isolation_forest as forest

    names = tables.station_names(a.information(spark, sf))
    return anomaly.activity_profile(forest(anomaly.station_activity(a.series(spark, sf))), names)


@query("isolation_score_histogram")
def isolation_score_histogram(spark, sf):
    from tidedock.operators.forest import isolation_forest as forest

    scored = forest(anomaly.station_activity(a.series(spark, sf)))
    labelled = scored.withColumn("status", labels.outlier_status(F.col("anomaly_label")))
    return aggregates.histogram(labelled, "anomaly_score", 30, "status")


@query("analyze_anomalies")
def analyze_anomalies(spark, sf):
    return anomaly.rounded_results(anomaly_plan.analyze_anomalies(a.series(spark, sf)))


@query("anomaly_kpis")
def anomaly_kpis(spark, sf):
    rows = a.series(spark, sf)
    return anomaly.anomaly_kpis(rows, anomaly_plan.analyze_anomalies(rows))


@query(
    "anomaly_map",
    with_(STUCK_SERIES, """SELECT p.station_id, p.lat, p.lon,
      CASE WHEN s.station_id IS NULL THEN 'Normal' ELSE 'Anomalous' END AS status,
      coalesce(i.name, p.station_id) AS station_name
      FROM (SELECT station_id, arg_min(lat, "timestamp") AS lat, arg_min(lon, "timestamp") AS lon
        FROM series GROUP BY 1) p
      LEFT JOIN (SELECT station_id FROM stuck_all WHERE duration_hours >= 0.5) s ON s.station_id = p.station_id
      LEFT JOIN station_information i ON i.station_id = p.station_id""", PLACE),
)
def anomaly_map(spark, sf):
    rows = a.series(spark, sf)
    names = tables.station_names(a.information(spark, sf))
    return anomaly.anomaly_map(rows, anomaly.stuck_stations(rows, 0.5), names)
