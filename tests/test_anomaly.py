import random
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidedock.operators import anomaly
from tidedock.operators.forest import average_path_length, isolation_forest
from tidedock.plans.anomalies import analyze_anomalies


def test_stuck_from_the_start(activity):
    row = anomaly.stuck_stations(activity({"a": [5] * 12})).first()
    assert (row.duration_hours, row.last_bikes, row.last_change, row.is_renting) == (2.75, 5, None, True)


def test_short_history_is_not_stuck(activity):
    assert anomaly.stuck_stations(activity({"a": [5] * 4})).count() == 0
    assert anomaly.stuck_stations(activity({"a": [5] * 12}), 3.0).count() == 0


def test_stuck_after_activity(activity):
    row = anomaly.stuck_stations(activity({"a": [1, 2, 3, 4] + [7] * 12, "b": list(range(16))})).collect()
    assert [(r.station_id, r.duration_hours) for r in row] == [("a", 2.75)]
    assert row[0].last_change is not None


def test_missing_columns_fail_early(activity):
    with pytest.raises(KeyError):
        anomaly.stuck_stations(activity({"a": [1]}).drop("timestamp"))


def test_stuck_without_flag_column(activity):
    assert anomaly.stuck_stations(activity({"a": [5] * 12}).drop("is_renting")).first().is_renting is None


def test_activity_values(activity):
    rows = {r.station_id: r for r in anomaly.station_activity(
        activity({"z": [0, 0, 0, 5, 5], "flat": [5] * 10, "busy": list(range(10)), "one": [3]})).collect()}
    assert rows["z"].zero_pct == pytest.approx(0.6) and rows["z"].change_rate == pytest.approx(0.25)
    assert rows["flat"].change_rate == 0.0 and rows["flat"].std_bikes == 0.0
    assert rows["busy"].change_rate == 1.0 and rows["busy"].std_bikes == pytest.approx(np.std(range(10)))
    assert (rows["one"].change_rate, rows["one"].std_bikes) == (0.0, 0.0)
    assert rows["busy"].avg_docks == pytest.approx(15.5) and rows["busy"].capacity == 20.0


@pytest.mark.parametrize("slice_width", ["1 day", "1 hour", "7 days"])
def test_slices_chain_into_whole_series(activity, slice_width):
    """Two levels (slice, station) equal one pass over the sorted series, also with changes at midnight."""
    rng = np.random.default_rng(9)
    data = {f"s{i}": list(rng.choice([3, 3, 3, 4, 0], 300)) for i in range(6)}
    data["midnight"] = [2] * 64 + [6] * 30
    rows = {r.station_id: r for r in anomaly.station_profiles(activity(data), slice_width).collect()}
    for sid, values in data.items():
        x = np.array(values, dtype=float)
        moved = np.flatnonzero(np.diff(x) != 0)
        assert rows[sid].changes == len(moved)
        assert rows[sid].std_bikes == pytest.approx(x.std())
        span = (rows[sid].last_ts - rows[sid].first_ts).total_seconds() / 900
        assert span == len(x) - 1
        if len(moved):
            at = (rows[sid].last_change - rows[sid].first_ts).total_seconds() / 900
            assert at == moved[-1] + 1


def _points(spark, values):
    return spark.createDataFrame([(f"s{i:03d}", *map(float, v)) for i, v in enumerate(values)],
                                 "station_id string, avg_bikes double, std_bikes double, zero_pct double, change_rate double")


def test_few_stations_are_all_inliers(spark):
    out = isolation_forest(_points(spark, [(1, 1, 0, 0), (2, 1, 0, 0)])).collect()
    assert [(r.anomaly_label, r.anomaly_score) for r in out] == [(1, 0.0), (1, 0.0)]


def test_planted_outlier_is_found(spark):
    rng = np.random.default_rng(42)
    normal = np.column_stack([rng.normal(10, 2, 49), rng.normal(3, 0.5, 49), rng.uniform(0, 0.1, 49), rng.uniform(0.2, 0.5, 49)])
    out = isolation_forest(_points(spark, [*normal, (0, 0, 1, 0)]), contamination=0.05).collect()
    worst = min(out, key=lambda r: r.anomaly_score)
    assert worst.station_id == "s049" and worst.anomaly_label == -1
    assert sum(r.anomaly_label == -1 for r in out) in (2, 3)


def test_forest_is_reproducible_over_partitionings(spark):
    rng = np.random.default_rng(1)
    points = _points(spark, rng.normal(0, 1, (700, 4)))
    scores = lambda df: {r.station_id: r.anomaly_score for r in isolation_forest(df).collect()}
    assert scores(points) == scores(points.repartition(7))


def test_average_path_length():
    assert [average_path_length(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert average_path_length(256) == pytest.approx(10.2448, abs=1e-3)


def test_analyze_combines_both(activity):
    rng = np.random.default_rng(4)
    data = {f"s{i:02d}": list(rng.integers(3, 12, 60)) for i in range(30)}
    data["stuck"] = [0] * 60
    rows = {r.station_id: r for r in anomaly.rounded_results(analyze_anomalies(activity(data))).collect()}
    assert rows["stuck"].is_stuck and rows["stuck"].is_statistical_outlier and rows["stuck"].isolation_score < 0
    assert all(r.is_anomalous for r in rows.values())


def test_thresholds_are_checked(activity):
    df = activity({"a": [1]})
    for hours, share in ((0.1, 0.05), (25, 0.05), (2, 0.0), (2, 0.6)):
        with pytest.raises(ValueError):
            analyze_anomalies(df, hours, share)


def test_kpis_and_map(spark, activity):
    df = activity({"a": [5] * 12, "b": list(range(12))})
    results = anomaly.combine(
        anomaly.stuck_stations(df), spark.createDataFrame([], "station_id string, anomaly_label int, anomaly_score double"))
    kpis = anomaly.anomaly_kpis(df, results).first()
    assert (kpis.total_stations, kpis.anomalous, kpis.anomalous_pct, kpis.stuck, kpis.outliers) == (2, 1, 50.0, 1, 0)
    names = spark.createDataFrame([("a", "Plaza")], "station_id string, name string")
    places = {r.station_id: (r.station_name, r.status) for r in anomaly.anomaly_map(df, results, names).collect()}
    assert places == {"a": ("Plaza", "Anomalous"), "b": ("b", "Normal")}
    table = anomaly.stuck_table(anomaly.stuck_stations(df), names).first()
    assert table.last_change == "Never (in window)" and table.duration_hours == 2.8
    open_rows = anomaly.unresolved(anomaly.anomaly_records(results, F.current_timestamp()))
    assert open_rows.count() == 1


def test_forest_scores_equal_a_walk_in_sql(spark):
    import duckdb

    from tidedock.operators import forest

    rng = random.Random(4)
    rows = [(f"s{i}", [rng.random(), rng.gauss(0, 1), float(i % 3)]) for i in range(400)]
    points = spark.createDataFrame(rows, "station_id string, features array<double>")
    nodes = forest.fit_forest(points, "station_id", 400, 12, 64, 7).toPandas()
    scored = forest.score_forest(points, spark.createDataFrame(nodes, forest.NODE_SCHEMA), 64)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    pts = points.toPandas()  # noqa: F841
    want = dict(duckdb.sql(f"""
      WITH RECURSIVE walk AS (
        SELECT p.station_id, p.features, n.* FROM pts p JOIN nodes n ON n.node = 0
        UNION ALL
        SELECT w.station_id, w.features, n.* FROM walk w JOIN nodes n ON n.tree = w.tree AND w.feature >= 0
          AND n.node = CASE WHEN w.features[w.feature + 1] <= w.threshold THEN w."left" ELSE w."right" END)
      SELECT station_id, -pow(2, -avg(depth + CASE WHEN size <= 1 THEN 0 WHEN size = 2 THEN 1
        ELSE 2 * (ln(size - 1) + {forest.EULER_GAMMA}) - 2 * (size - 1) / size END) / {average_path_length(64)!r})
      FROM walk WHERE feature < 0 GROUP BY station_id""").fetchall())
    got = {r.station_id: r.raw_score for r in scored.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
