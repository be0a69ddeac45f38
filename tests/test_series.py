import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.operators import features, regularise, split
from tidedock.plans import dataset
from times import START


def _pandas_grid(rows, freq="15min", limit=4):
    """The same rule in pandas, for small frames."""
    out = []
    for sid, g in rows.groupby("station_id"):
        r = g.set_index("last_reported").sort_index()[["num_bikes_available"]].resample(freq).mean()
        r = r.ffill(limit=limit).dropna()
        out += [(sid, t.to_pydatetime(), v) for t, v in r["num_bikes_available"].items()]
    return out


def test_grid_and_bounded_fill(spark, raw_status):
    # a gap of 45 minutes is filled, a gap of three hours only for one hour
    out = regularise.resample(raw_status([("a", 0, 4), ("a", 5, 6), ("a", 60, 8), ("a", 240, 2)]))
    rows = out.orderBy("timestamp").collect()
    minutes = [(r.timestamp - START).seconds // 60 for r in rows]
    assert minutes == [0, 15, 30, 45, 60, 75, 90, 105, 120, 240]
    assert [r.num_bikes_available for r in rows] == [5.0] * 4 + [8.0] * 5 + [2.0]


def test_grid_equals_pandas_and_dense_form(spark, raw_status):
    rng = random.Random(7)
    data = [(f"s{i % 5}", rng.randrange(0, 3000), rng.randrange(0, 20)) for i in range(400)]
    data = list({(s, m): (s, m, b) for s, m, b in data}.values())
    raw = raw_status(data)
    got = sorted((r.station_id, r.timestamp, r.num_bikes_available) for r in regularise.resample(raw).collect())
    pdf = pd.DataFrame([(s, START + dt.timedelta(minutes=m), b) for s, m, b in data],
                       columns=["station_id", "last_reported", "num_bikes_available"])
    assert got == sorted(_pandas_grid(pdf))
    bins = regularise.bin_status(raw, lasts=[]).drop("first_seen", "last_seen")
    cols = schemas.COUNT_COLS
    dense = regularise.ffill_limited(regularise.dense_grid(bins), cols).na.drop(subset=cols)
    assert sorted((r.station_id, r.timestamp, r.num_bikes_available) for r in dense.collect()) == got


def test_dense_grid_shuffles_bins_and_not_the_grid(spark, raw_status):
    bins = regularise.bin_status(raw_status([("a", 0, 1), ("a", 60, 2), ("b", 30, 3)]), lasts=[]).drop("first_seen", "last_seen")
    filled = regularise.ffill_limited(regularise.dense_grid(bins), schemas.COUNT_COLS)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    physical = filled._jdf.queryExecution().sparkPlan().toString()
    prepared = filled._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in physical and "Exchange" not in prepared.split("Generate")[0]
    grid = regularise.dense_grid(bins).groupBy("station_id").agg(F.count("*").alias("n"), F.count("num_bikes_available").alias("v"))
    assert {r.station_id: (r.n, r.v) for r in grid.collect()} == {"a": (5, 2), "b": (1, 1)}


def test_last_non_null_flags(spark, raw_status):
    raw = raw_status([("a", 0, 1), ("a", 3, 1)]).withColumn(
        "is_renting", F.when(F.minute("last_reported") == 0, F.lit(False)))
    assert regularise.bin_status(raw).first().is_renting is False


def test_empty_input(spark, raw_status):
    assert regularise.resample(raw_status([("a", 0, 1)]).limit(0)).count() == 0


def test_whole_days_are_floored(spark, raw_status):
    week = 7 * 24 * 60
    raw = raw_status([("full", 0, 1), ("full", week, 1), ("short", 0, 1), ("short", week - 60, 1)])
    kept = {r.station_id for r in regularise.min_history(raw, 7).collect()}
    assert kept == {"full"}
    assert {r.station_id for r in regularise.resample(raw, min_days=7).collect()} == {"full"}


def test_hot_station_leaves_one_row_per_bin(spark, raw_status):
    raw = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("station_id"),
        (F.lit(START).cast("timestamp_ntz") + F.make_interval(secs=F.col("id") % 3600)).alias("last_reported"),
        (F.col("id") % 7).cast("int").alias("num_bikes_available"),
    )
    bins = regularise.bin_status(raw, means=["num_bikes_available"], lasts=[])
    assert bins.where("station_id = 'hot'").count() == 4


def test_lags_target_and_rolling(spark, activity):
    df = activity({"a": list(range(10)), "b": list(range(100, 110))})
    out = features.add_target(features.add_rolling_features(features.add_lag_features(df)))
    rows = out.where("station_id = 'a'").orderBy("timestamp").collect()
    assert [r.bikes_lag_1 for r in rows] == [None, *map(float, range(9))]
    assert [r.bikes_lag_4 for r in rows][:5] == [None] * 4 + [0.0]
    assert [r.bikes_rolling_mean_1h for r in rows][:6] == [None] * 4 + [1.5, 2.5]
    assert rows[4].bikes_rolling_std_1h == pytest.approx(np.std([0, 1, 2, 3], ddof=1))
    assert rows[-1].y is None and rows[0].y == 1.0
    assert out.where("station_id = 'b'").agg(F.min("bikes_lag_1")).first()[0] == 100.0


def test_lags_cross_gaps_unless_limited(spark, activity):
    df = activity({"a": [1, 2, 3]}).where(F.col("num_bikes_available") != 2)
    assert features.add_lag_features(df).where("bikes_lag_1 = 1").count() == 1
    assert features.add_lag_features(df, max_gap="15 minutes").where("bikes_lag_1 = 1").count() == 0


def test_calendar(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-03-01 23:10:00' timestamp")  # a Sunday
    row = features.add_temporal_features(df).first()
    assert (row.hour, row.weekday, row.is_weekend, row.month) == (23, 6, 1, 3)


def test_station_features_must_exist(activity):
    with pytest.raises(KeyError, match="capacity"):
        features.build_features(activity({"a": [1, 2]}).drop("capacity"))


def test_build_features_has_no_nulls_and_drops_unknown_stations(spark, activity):
    df = activity({"a": list(range(12)), "b": list(range(12))}).withColumn(
        "capacity", F.when(F.col("station_id") == "a", F.col("capacity")))
    out = features.feature_frame(features.build_features(df))
    assert out.columns == ["station_id", "timestamp", *schemas.FEATURE_COLS, "y"]
    assert {r.station_id for r in out.collect()} == {"a"} and out.count() == 12 - 4 - 1


@pytest.mark.parametrize("block_rows", [6, 9, 64])
def test_blocked_features_equal_plain_windows(spark, activity, block_rows):
    rng = random.Random(block_rows)
    data = {"hot": [rng.randrange(15) for _ in range(70)], "b": list(range(11)), "c": [3] * 5, "d": [2]}
    df = activity(data)
    key = lambda out: sorted(tuple(r) for r in features.feature_frame(out).collect())
    plain = key(features.build_features(df))
    assert len(plain) == 65 + 6 and key(features.build_features(df, block_rows=block_rows)) == plain


def test_staged_tables_are_released(spark):
    from pathlib import Path

    from tidedock import staging

    staged = staging.stage(spark.range(3), "gone")
    path = Path(staged.inputFiles()[0].removeprefix("file://")).parent
    assert staged.count() == 3 and path.exists()
    keep = list(staging._written[:-1])
    staging._written[:] = staging._written[-1:]
    assert staging.release_staged(spark) == 1 and not path.exists()
    staging._written[:] = keep


def test_feature_chain_needs_one_exchange(spark, activity):
    df = activity({"a": list(range(12))})
    plan = features.build_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan


def test_split_fractions_and_order(spark, activity):
    df = activity({"a": list(range(100)), "b": list(range(100))})
    out = split.time_based_split(df)
    summary = {r.split: r for r in split.split_summary(out).collect()}
    assert {k: v.n_rows for k, v in summary.items()} == {"train": 144, "val": 16, "test": 40}
    assert all(v.n_stations == 2 for v in summary.values())
    assert summary["train"].last_timestamp < summary["val"].first_timestamp
    assert summary["val"].last_timestamp < summary["test"].first_timestamp


@pytest.mark.parametrize("n", [2, 3, 7, 97, 131])
def test_split_equals_sorted_array_rule(spark, activity, n):
    df = activity({"a": list(range(n))}, minutes=95)
    got = split.split_cuts(df).first()
    t = [START + dt.timedelta(minutes=95 * i) for i in range(n)]
    e = int(n * 0.8)
    assert (got.test_from, got.val_from) == (t[e], t[int(e * (1 - 0.1))])


def test_split_of_one_timestamp_fails(spark, activity):
    with pytest.raises(Exception, match="leaves train or test empty"):
        split.time_based_split(activity({"a": [1]}))


def test_leakage_report_finds_planted_leak(spark, activity):
    series = activity({"a": list(range(40))})
    good = split.time_based_split(features.build_features(series))
    assert all(r.passed for r in split.leakage_report(good, series).collect())
    bad = good.withColumn("bikes_lag_1", F.col("y"))
    failed = {r.check for r in split.leakage_report(bad, series).collect() if not r.passed}
    assert failed == {"bikes_lag_1"}


def test_written_dataset_round_trip(spark, raw_status, tmp_path):
    raw = raw_status([("a", 30 * i, i % 9) for i in range(400)])
    info = spark.sql("SELECT 'a' station_id, -23.5D lat, -46.6D lon, 20 capacity")
    dataset.build_dataset(raw.drop("capacity", "lat", "lon"), info, str(tmp_path / "d"), min_days=7)
    back = spark.read.parquet(str(tmp_path / "d"))
    assert {r.split for r in back.select("split").distinct().collect()} == {"train", "val", "test"}
    assert set(back.columns) == {"station_id", "timestamp", *schemas.FEATURE_COLS, "y", "split"}


def test_hash_sample_is_exact_and_stable(spark, activity):
    df = activity({"a": list(range(50))})
    first = features.hash_sample(df, 10, ["station_id", "timestamp"]).collect()
    assert len(first) == 10
    assert first == features.hash_sample(df.repartition(5), 10, ["station_id", "timestamp"]).collect()
    assert features.hash_sample(df, 500, ["station_id", "timestamp"]).count() == 50
