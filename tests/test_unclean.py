"""Missing and odd values where operators read them, against pandas or by hand."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidedock.operators import aggregates, anomaly, drift, merge, models, regularise, split
from tidedock.operators.ordered import exact_quantiles
from tidedock.sources import tables, writers
from tidedock.staging import stage


def test_rolling_mae_recovers_after_bad_errors(spark, activity):
    values = [1.0, float("nan"), 2.0, 3.0, 1e17, 0.1, 0.1, 0.1, 0.1]
    df = activity({"a": values}).withColumn("p", F.lit(0.0))
    got = [r.rolling_mae for r in drift.rolling_mae_by_station(df, "num_bikes_available", "p", "timestamp", 3)
           .orderBy("timestamp").collect()]
    want = pd.Series(values).rolling(3, min_periods=3).mean().tolist()
    assert got[-1] == pytest.approx(0.1)
    assert [v is None for v in got] == [math.isnan(w) for w in want]


def test_backfill_takes_the_first_observation_and_fills_nan(spark):
    stored = spark.sql("SELECT 'a' station_id, TIMESTAMP_NTZ'2026-03-01' target_time, 'm' model_name, 1D predicted_value,"
                       " double('nan') actual_value")
    seen = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP_NTZ'2026-03-01', 9D, 1), ('a', TIMESTAMP_NTZ'2026-03-01', 3D, 2),"
                     " ('a', TIMESTAMP_NTZ'2026-03-01', double('nan'), 0) AS t(station_id, target_time, actual_value, seq)")
    row = merge.backfill_actuals(stored, seen, ["seq"]).first()
    assert (row.actual_value, row.updated) == (9.0, True)


def test_activity_ignores_reports_without_a_value(spark, activity):
    df = activity({"a": [4, 4, 4, 4, 6]})
    df = df.withColumn("num_bikes_available", F.when(F.minute("timestamp") != 15, F.col("num_bikes_available")))
    row = anomaly.station_activity(df).first()
    assert row.avg_bikes == pytest.approx(4.5) and row.change_rate == pytest.approx(1 / 3)


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(rng.normal(size=(40, 3)), columns=list("abc")).assign(d=1.0)
    frame.loc[3, "a"] = np.nan
    frame.loc[7, "b"] = np.nan
    got = {(r.column_a, r.column_b): r.correlation
           for r in aggregates.correlation_matrix(spark.createDataFrame(frame), list("abcd")).collect()}
    want = frame.corr()
    for (x, y), value in got.items():
        assert value is None if "d" in (x, y) else value == pytest.approx(want.loc[x, y])
    assert len(got) == 6


def test_histogram_leaves_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    rows = aggregates.histogram(df, "v", 2).orderBy("bin").collect()
    assert [(r.bin_low, r.bin_high, r.n) for r in rows] == [(1.0, 1.5, 1), (1.5, 2.0, 1)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_fill_equals_a_dense_forward_fill(spark, activity, seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 9, 60).astype(float)
    present, known = rng.random(60) < 0.5, rng.random(60) < 0.6
    present[0] = known[0] = True
    df = activity({"a": list(values)})
    at = {t: i for i, t in enumerate(sorted(r.timestamp for r in df.select("timestamp").collect()))}
    keep = spark.createDataFrame([(t, bool(known[i])) for t, i in at.items() if present[i]], "timestamp timestamp_ntz, known boolean")
    rows = df.join(keep, "timestamp").withColumn("num_bikes_available", F.when(F.col("known"), F.col("num_bikes_available")))
    bins = rows.select("station_id", "timestamp", "num_bikes_available")
    filled = regularise.fill_forward(bins, min_days=None).na.drop(subset=["num_bikes_available"])
    got = {at[r.timestamp]: r.num_bikes_available for r in filled.collect()}
    dense = pd.Series(np.where(present & known, values, np.nan))[: present.nonzero()[0][-1] + 1]
    assert got == dense.ffill(limit=4).dropna().to_dict()


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ks_and_quantiles_do_not_depend_on_partitions(spark, partitions):
    rng = np.random.default_rng(6)
    ref, cur = rng.normal(0, 1, 700), rng.normal(0.3, 1, 500)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = lambda x: spark.createDataFrame([(float(v),) for v in x], "x double")
        long = drift.two_sides(frame(ref), frame(cur), ["x"])
        at = np.concatenate([ref, cur])
        cdf = lambda x: np.searchsorted(np.sort(x), at, side="right") / len(x)
        assert drift.ks_statistics(long).first().ks_statistic == pytest.approx(np.abs(cdf(ref) - cdf(cur)).max())
        assert list(exact_quantiles(frame(ref), "x", [0.1, 0.5])[["q0", "q1"]].first()) == pytest.approx(np.quantile(ref, [0.1, 0.5]).tolist())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("statistic,n,m,p", [  # from tables of the exact two-sample distribution, asymptotic form
    (0.2, 100, 100, 0.0366), (0.1, 500, 500, 0.0135), (0.3, 50, 50, 0.0222)])
def test_ks_p_values(spark, statistic, n, m, p):
    from tidedock.functions.stats import ks_p_value

    got = spark.range(1).select(ks_p_value(F.lit(statistic), F.lit(n), F.lit(m)).alias("p")).first().p
    assert got == pytest.approx(p, rel=0.35)


def test_split_ranges_reach_the_files(spark, activity):
    rows = split.time_based_split(stage(activity({s: list(range(50)) for s in "ab"}), "split-input"))
    for name in ("train", "val", "test"):
        plan = rows.where(F.col("split") == name)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert "timestamp" in pushed and ("LessThan" in pushed or "GreaterThan" in pushed)
    assert rows.groupBy("split").count().count() == 3 and rows.count() == 100


def test_best_round_follows_patience():
    assert models.best_round([5, 4, 3, 3.5, 3.4, 2.9], 2) == 3
    assert models.best_round([5, 4, 3, 3.5, 3.4, 2.9], 3) == 6
    assert models.best_round([1.0], 5) == 1


def test_append_adds_nothing_in_another_time_zone(spark, raw_status, tmp_path):
    path = str(tmp_path / "status")
    zoned = [F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else c
             for c, t in raw_status([("a", 0, 1)]).dtypes]
    batch = stage(raw_status([("a", m, 1) for m in range(0, 3000, 500)]).select(*zoned), "zone-batch")
    assert writers.append_status(batch, path, ["ingestion_timestamp"]) == 6
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert writers.append_status(batch, path, ["ingestion_timestamp"]) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_backfill_sink_updates_only_open_rows(spark, tmp_path):
    path = str(tmp_path / "predictions")
    batch = spark.sql("""SELECT concat('s', id % 3) station_id, timestamp'2026-03-01' AS prediction_time,
      timestamp_seconds(1772352000 + id * 40000) AS target_time, concat('m', id % 2) model_name, double(id) predicted_value FROM range(12)""")
    assert writers.save_predictions(batch, path, F.lit("2026-03-01").cast("timestamp"), ["predicted_value"]) == 12
    seen = batch.where("predicted_value < 5").select("station_id", "target_time", (F.col("predicted_value") + 1).alias("actual_value"))
    assert writers.backfill_predictions(spark, path, seen, ["actual_value"]) == 5
    assert writers.backfill_predictions(spark, path, seen.withColumn("actual_value", F.lit(99.0)), ["actual_value"]) == 0
    stored = tables.read_predictions(spark, path).collect()
    assert len(stored) == 12
    assert {r.predicted_value: r.actual_value for r in stored} == {float(i): float(i) + 1 if i < 5 else None for i in range(12)}
