import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidedock.functions import stats
from tidedock.operators import drift, metrics
from tidedock.operators.ordered import blocked_window, exact_quantiles, global_index
from tidedock.plans.monitoring import monitoring_status


def _frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())],
                                 ", ".join(f"{n} double" for n in names))


def _psi(ref, cur, n=10):
    edges = np.linspace(min(ref.min(), cur.min()), max(ref.max(), cur.max()), n + 1)
    r = np.histogram(ref, edges)[0] / len(ref) + 1e-4
    c = np.histogram(cur, edges)[0] / len(cur) + 1e-4
    return float(((c - r) * np.log(c / r)).sum())


def _ks(ref, cur):
    at = np.concatenate([ref, cur])
    cdf = lambda x: np.searchsorted(np.sort(x), at, side="right") / len(x)
    return float(np.abs(cdf(ref) - cdf(cur)).max())


CASES = {
    "normal": lambda r: (r.normal(0, 1, 3000), r.normal(0.1, 1.2, 1700)),
    "integers": lambda r: (r.integers(0, 30, 2000).astype(float), r.integers(3, 34, 900).astype(float)),
    "one hot value": lambda r: (np.where(r.random(2000) < 0.4, 5.0, r.normal(0, 9, 2000)), r.normal(4, 2, 800)),
    "narrow with outlier": lambda r: (np.append(r.normal(0, 1e-3, 2000), 1e6), r.normal(0, 2e-3, 500)),
    "constant": lambda r: (np.full(50, 3.0), np.full(20, 3.0)),
    "disjoint": lambda r: (r.uniform(0, 1, 300), r.uniform(2, 3, 300)),
}


@pytest.mark.parametrize("name", CASES)
def test_psi_and_ks_equal_numpy(spark, name):
    ref, cur = CASES[name](np.random.default_rng(42))
    row = drift.feature_drift(_frame(spark, x=ref), _frame(spark, x=cur), ["x"]).first()
    assert row.psi == pytest.approx(_psi(ref, cur), abs=1e-9)
    assert row.ks_statistic == pytest.approx(_ks(ref, cur), abs=1e-12)


def test_feature_drift_flags_order_and_skips(spark):
    rng = np.random.default_rng(1)
    ref = _frame(spark, a=rng.normal(0, 1, 400), b=rng.normal(0, 1, 400), c=[math.nan] * 400)
    cur = _frame(spark, a=rng.normal(0, 1, 400), b=rng.normal(5, 1, 400), c=rng.normal(0, 1, 400))
    rows = drift.ranked(drift.feature_drift(ref, cur, ["a", "b", "c"])).collect()
    assert [r.feature for r in rows] == ["b", "a"]
    assert (rows[0].drifted, rows[0].status, rows[0].severity) == (True, "Drifted", "significant")
    summary = drift.drift_summary(drift.feature_drift(ref, cur, ["b"])).first()
    assert (summary.drift_score, summary.n_features, summary.n_drifted) == (1.0, 1, 1)
    empty = drift.drift_summary(drift.feature_drift(ref, cur, ["c"])).first()
    assert (empty.drift_score, empty.n_features, empty.max_psi) == (0.0, 0, 0.0)


def test_identical_data_has_no_drift(spark):
    x = np.random.default_rng(3).normal(0, 1, 500)
    row = drift.feature_drift(_frame(spark, x=x), _frame(spark, x=x), ["x"]).first()
    assert row.psi < 0.05 and row.ks_statistic == 0.0 and row.ks_p_value == 1.0 and not row.drifted


@pytest.mark.parametrize("current,baseline,alert", [
    (0.25, 0.30, False), (0.40, 0.30, True), (0.36, 0.30, False), (0.01, 0.0, True), (0.0, 0.0, False)])
def test_mae_alert(spark, current, baseline, alert):
    df = spark.range(1).select(stats.mae_alert(F.lit(current), F.lit(baseline)).alias("a"))
    assert df.first().a is alert


def test_kolmogorov_tail(spark):
    # Known points of the limiting distribution: Q(1.3581) = 0.05, Q(1.6276) = 0.01.
    n = 10.0 ** 12
    for lam, p in ((1.3581, 0.05), (1.6276, 0.01)):
        d = lam / math.sqrt(n / 2)
        got = spark.range(1).select(stats.ks_p_value(F.lit(d), F.lit(n), F.lit(n)).alias("p")).first().p
        assert got == pytest.approx(p, abs=1e-4)


@pytest.mark.parametrize("n, m", [(2, 3), (5, 5), (6, 4), (1, 7)])
def test_small_sample_share_equals_a_count_of_all_orderings(spark, n, m):
    gaps = []
    for chosen in itertools.combinations(range(n + m), n):
        i = np.cumsum(np.isin(np.arange(n + m), chosen))
        gaps.append(np.abs(i * m - (np.arange(1, n + m + 1) - i) * n).max())
    rows = [(int(g), float(g) / (n * m), n, m) for g in {0, *gaps}]
    df = spark.createDataFrame(rows, "g long, d double, n long, m long")
    for r in df.withColumn("p", drift.exceeding_share(F.col("d"), F.col("n"), F.col("m"))).collect():
        assert r.p == pytest.approx(np.mean([g >= r.g for g in gaps]), rel=1e-12)


def test_p_values_switch_at_the_parameter(spark):
    rows = spark.createDataFrame([(0.5, 30, 40), (0.2, 50, 5), (0.03, 9000, 8000)], "ks_statistic double, n_ref long, n_cur long")
    got = {r.n_ref: r.ks_p_value for r in drift.with_p_values(rows).collect()}
    plain = {r.n_ref: r.ks_p_value for r in drift.with_p_values(rows, 0).collect()}
    assert got[9000] == plain[9000] and got[30] != plain[30]
    assert got[30] == pytest.approx(plain[30], abs=0.005) and got[50] == pytest.approx(plain[50], abs=0.05)


def test_bin_index_follows_histogram(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 3, 500), np.linspace(-9, 9, 37)])
    lo, hi, n = float(values.min()), float(values.max()), 7
    df = _frame(spark, x=values).select(stats.bin_index(F.col("x"), F.lit(lo), F.lit(hi), n).alias("b"))
    got = np.bincount([r.b for r in df.collect()], minlength=n)
    assert got.tolist() == np.histogram(values, np.linspace(lo, hi, n + 1))[0].tolist()


def test_rolling_mae_by_station(spark, activity):
    df = activity({"a": [0.0] * 20}).withColumn("p", F.lit(1.0))
    rows = drift.rolling_mae_by_station(df, "num_bikes_available", "p", "timestamp", window=5).orderBy("timestamp").collect()
    assert [r.rolling_mae for r in rows] == [None] * 4 + [1.0] * 16


@pytest.mark.parametrize("block_rows", [5, 8, 1000])
def test_rolling_mae_global_equals_single_window(spark, activity, block_rows):
    rng = np.random.default_rng(0)
    df = activity({s: list(rng.integers(0, 9, 40)) for s in "abc"}).withColumn("p", F.lit(4.0))
    out = drift.rolling_mae_global(df, "num_bikes_available", "p", ["timestamp", "station_id"], 5, block_rows)
    got = {r.idx: r.rolling_mae for r in out.collect()}
    pdf = df.toPandas().sort_values(["timestamp", "station_id"])
    want = (pdf["num_bikes_available"] - 4).abs().rolling(5, min_periods=5).mean().tolist()
    assert len(got) == 120
    assert [got[i] for i in range(120)] == [None if math.isnan(w) else pytest.approx(w) for w in want]


def test_global_index_with_one_crowded_timestamp(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("t"), F.col("id").alias("k"))
    rows = global_index(df, ["t", "k"]).orderBy("t", "k").collect()
    assert [r.idx for r in rows] == list(range(5000))


def test_block_must_hold_a_window(spark):
    with pytest.raises(ValueError):
        blocked_window(spark.range(3).withColumnRenamed("id", "idx"), 4, 0, lambda rows, order: rows, block_rows=4)


def test_rolling_mae_in_blocks_equals_plain_windows(spark, activity):
    rng = np.random.default_rng(3)
    df = activity({"hot": list(rng.integers(0, 9, 90)), "a": [1] * 7, "b": list(rng.integers(0, 9, 20))}).withColumn("p", F.lit(4.0))
    args = (df, "num_bikes_available", "p", "timestamp", 6)
    key = lambda out: {(r.station_id, r.timestamp): r.rolling_mae for r in out.collect()}
    plain = key(drift.rolling_mae_by_station(*args))
    assert sum(v is not None for v in plain.values()) == 85 + 2 + 15
    assert key(drift.rolling_mae_by_station(*args, block_rows=11)) == pytest.approx(plain)


def test_alert_lines_and_delta(spark):
    df = spark.sql("SELECT 0.5D current_mae, 0.4D baseline_mae")
    assert drift.mae_delta(df).first().mae_delta == pytest.approx(0.1)
    row = drift.with_alert_lines(spark.range(1), F.lit(0.5)).first()
    assert (row.baseline_mae, row.alert_mae) == (0.5, 0.6)


@pytest.mark.parametrize("seed", [0, 1])
def test_exact_quantiles(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(3001) < 0.3, 2.0, rng.normal(0, 5, 3001))
    ps = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    row = exact_quantiles(_frame(spark, x=values), "x", ps).first()
    assert list(row) == pytest.approx(np.quantile(values, ps).tolist())


def _pairs(spark, n, model="naive", shift=0.0):
    return spark.range(n).select(
        F.lit(model).alias("model_name"),
        (F.lit("2026-03-01").cast("timestamp_ntz") + F.make_interval(mins=F.col("id") * 15)).alias("target_time"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("station_id"),
        (F.col("id") % 10).cast("double").alias("actual_value"), (F.col("id") % 10 + shift).cast("double").alias("predicted_value"))


def test_monitoring_statuses(spark):
    pairs = _pairs(spark, 200, "good", 0.1).unionByName(_pairs(spark, 200, "bad", 2.0)).unionByName(_pairs(spark, 10, "few"))
    baselines = spark.createDataFrame([("good", 0.1), ("bad", 0.1), ("few", 0.1), ("idle", 0.1)], "model string, mae double")
    asked = spark.createDataFrame([(m,) for m in ("good", "bad", "few", "idle", "who")], "model_name string")
    out = monitoring_status(pairs, baselines, asked, F.lit("2026-03-03").cast("timestamp_ntz"), 30)
    assert {r.model_name: r.status for r in out.collect()} == {
        "good": "ok", "bad": "alert", "few": "insufficient", "idle": "no_data", "who": "unknown_model"}
    report = drift.rounded_report(drift.drift_report(pairs, baselines)).collect()
    assert {r.model_name for r in report} == {"good", "bad"}


def test_metrics_edge_cases(spark):
    frame = lambda rows: spark.createDataFrame(rows, "y double, p double")
    get = lambda rows: metrics.regression_metrics(frame(rows), "y", "p").first()
    assert tuple(get([(1.0, 1.0), (2.0, 2.0)])) == (0.0, 0.0, 1.0)
    assert get([(2.0, 2.0), (2.0, 2.0)]).r2 == 1.0 and get([(2.0, 3.0), (2.0, 2.0)]).r2 == 0.0
    assert get([(2.0, 2.0)]).r2 is None
    row = get([(1.0, 2.0), (3.0, 2.0), (5.0, 5.0)])
    assert (row.mae, row.rmse) == (pytest.approx(2 / 3), pytest.approx(math.sqrt(2 / 3)))
    assert row.r2 == pytest.approx(1 - 2 / 8)


def test_exact_p_values_are_spread_over_tasks(spark):
    rows = [(f"s{g}", float((g * 7 + i * 3) % 11), i % 2, 1 - i % 2) for g in range(40) for i in range(12)]
    long = spark.createDataFrame(rows, "station_id string, value double, ref int, cur int")
    out = drift.with_p_values(drift.ks_statistics(long, "station_id"))
    out.collect()
    per_task = out.rdd.glom().map(len).collect()
    assert sum(per_task) == 40 and max(per_task) < 40 and sum(n > 0 for n in per_task) > 1
