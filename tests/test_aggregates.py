import numpy as np
import pytest
from pyspark.sql import functions as F

from tidedock.functions import labels
from tidedock.operators import aggregates, features


@pytest.fixture
def frame(activity):
    rng = np.random.default_rng(2)
    df = activity({s: list(rng.integers(0, 15, 200)) for s in "abc"})
    return features.add_temporal_features(df)


def test_hourly_and_heatmap(frame):
    pdf = frame.toPandas()
    hourly = {(r.hour, r.is_weekend): (r.avg_bikes, r.day_type) for r in aggregates.hourly_availability(frame).collect()}
    want = pdf.groupby(["hour", "is_weekend"])["num_bikes_available"].mean()
    assert {k: v[0] for k, v in hourly.items()} == pytest.approx(want.to_dict())
    assert {v[1] for v in hourly.values()} == {"Weekday", "Weekend"}
    heat = aggregates.weekday_hour_heatmap(frame)
    assert len(heat.columns) == 25 and heat.where(F.col("h00").isNull()).count() == 0


def test_peak_hours_break_ties_by_first_row(activity):
    df = features.add_temporal_features(activity({"a": [5.0] * 100}))
    kpis = aggregates.peak_hour_kpis(df).first()
    assert kpis.busiest_hour == kpis.quietest_hour == "00:00" and kpis.busiest_avg_bikes == 5.0


def test_station_summary_takes_first_non_null(activity):
    df = activity({"a": [4, 6]}).withColumn("lat", F.when(F.col("num_bikes_available") == 6, F.col("lat")))
    row = aggregates.station_summary(df).first()
    assert (row.avg_bikes, row.min_bikes, row.max_bikes, row.lat, row.fill_pct) == (5.0, 4.0, 6.0, -23.5, 25.0)


def test_histogram_is_dense(spark):
    values = np.random.default_rng(0).normal(0, 1, 400)
    df = spark.createDataFrame([(float(v), "ab"[i % 2]) for i, v in enumerate(values)], "x double, g string")
    rows = aggregates.histogram(df, "x", 30).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r.n for r in rows] == counts.tolist()
    assert [r.bin_low for r in rows] == pytest.approx(edges[:-1].tolist())
    assert aggregates.histogram(df, "x", 30, "g").count() == 60


def test_correlation_with_constant_column(frame):
    pairs = {(r.column_a, r.column_b): r.correlation for r in aggregates.correlation_matrix(
        frame, ["num_bikes_available", "num_docks_available", "capacity"]).collect()}
    assert pairs[("num_bikes_available", "num_docks_available")] == pytest.approx(-1.0)
    assert pairs[("num_bikes_available", "capacity")] is None


def test_summary_delta(spark, frame):
    other = frame.withColumn("num_bikes_available", F.col("num_bikes_available") + 2)
    rows = {r.metric: r.delta for r in aggregates.feature_summary_delta(frame, other, ["num_bikes_available"]).collect()}
    assert rows["median"] == pytest.approx(2.0) and rows["std"] == pytest.approx(0.0) and rows["max"] == pytest.approx(2.0)


def test_labels(spark):
    df = spark.range(1).select(
        labels.availability_band(F.lit(10.0), F.lit(True)).alias("red"),
        labels.availability_band(F.lit(70.1), F.lit(True)).alias("green"),
        labels.availability_band(F.lit(70.1), F.lit(False)).alias("black"),
        labels.clamp_prediction(F.lit(-0.4)).alias("zero"),
        labels.clamp_prediction(F.lit(2.125)).alias("even"),
        labels.fill_pct(F.lit(3.0), F.lit(0)).alias("no_capacity"),
        labels.day_type(F.lit(7)).alias("other"),
        labels.score_severity(F.lit(0.5)).alias("severity"),
        labels.psi_severity(F.lit(0.15)).alias("psi"),
    ).first()
    assert tuple(df) == ("red", "green", "black", 0.0, 2.12, None, None, "high", "moderate")


def test_date_range_is_inclusive_and_pushed(spark, tmp_path):
    df = spark.sql("SELECT 'a' station_id, 1.0D num_bikes_available, explode(sequence(TIMESTAMP_NTZ'2026-03-01',"
                   " TIMESTAMP_NTZ'2026-03-05', INTERVAL 6 HOURS)) AS timestamp")
    df.write.parquet(str(tmp_path / "t"))
    out = aggregates.availability_timeline(spark.read.parquet(str(tmp_path / "t")), "2026-03-02", "2026-03-03")
    assert out.count() == 8
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp,2026-03-02" in plan and "LessThan(timestamp,20" in plan
