import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.operators import drift, profiles
from tidedock.sources import tables, versions, writers

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def facts(spark):
    draw = random.Random(5)
    rows = [
        (dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(draw.randrange(40 + i // 50)), draw.choice([None, float("nan"), 1.5, -2.0]))
        for i in range(24 * 20)
    ]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, a double, b double").cache()


def _days(first, last):
    return F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_drift_of_stored_days_is_drift_of_the_rows(spark, facts, tmp_path):
    path = str(tmp_path / "counts")
    day = F.to_date("timestamp")
    whole = facts.where(day < F.lit("2024-01-15"))
    assert writers.write_profiles(profiles.daily_counts(whole, FEATURES), path) == 1
    # A later batch brings new days and a corrected one, which is profiled from all of its rows.
    later = facts.where(day >= F.lit("2024-01-14"))
    assert writers.write_profiles(profiles.daily_counts(later, FEATURES), path) == 2
    stored = tables.read_profiles(spark, path, schemas.VALUE_COUNTS)
    assert stored.groupBy("day").agg(F.sum("n")).count() == 20
    got = profiles.feature_drift_from_profiles(stored, _days("2024-01-01", "2024-01-10"), _days("2024-01-11", "2024-01-20"))
    side = lambda low, high: facts.where(day.between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    wanted = drift.feature_drift(side("2024-01-01", "2024-01-10"), side("2024-01-11", "2024-01-20"), FEATURES)
    assert _rows(got) == _rows(wanted) and got.count() == 2


def test_a_new_day_writes_and_reads_its_own_partition_only(spark, facts, tmp_path):
    path = str(tmp_path / "counts")
    day = F.to_date("timestamp")
    writers.write_profiles(profiles.daily_counts(facts.where(day < F.lit("2024-01-20")), FEATURES), path)
    before = {f for f in tables.read_profiles(spark, path, schemas.VALUE_COUNTS).inputFiles() if "/data/" in f}
    writers.write_profiles(profiles.daily_counts(facts.where(day == F.lit("2024-01-20")), FEATURES), path)
    after = {f for f in tables.read_profiles(spark, path, schemas.VALUE_COUNTS).inputFiles() if "/data/" in f}
    assert before <= after and all("day=2024-01-20" in f for f in after - before)
    chosen = tables.read_profiles(spark, path, schemas.VALUE_COUNTS).where(_days("2024-01-20", "2024-01-20"))
    assert "PartitionFilters: [isnotnull(day" in chosen._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_like_their_rows(spark, facts, tmp_path):
    path = str(tmp_path / "sketches")
    writers.write_profiles(profiles.daily_sketches(facts, FEATURES), path)
    stored = tables.read_profiles(spark, path, schemas.VALUE_SKETCHES)
    summary = profiles.merged_summary(stored, ["feature"])
    found = {r.feature: r for r in summary.collect()}
    values = [r.a for r in facts.collect()]
    a = found["a"]
    assert (a.n, a.min, a.max) == (len(values), min(values), max(values))
    assert a.mean == pytest.approx(sum(values) / len(values))
    assert a.n_distinct == pytest.approx(len(set(values)), abs=2)
    checked = profiles.quantiles_within(summary, profiles.daily_counts(facts, FEATURES), 0.02).collect()
    assert len(checked) == 2 and all(r.q25_within and r.q50_within and r.q75_within for r in checked)


def test_empty_and_missing(spark, facts, tmp_path):
    none = facts.limit(0)
    assert profiles.daily_counts(none, FEATURES).count() == 0
    assert profiles.merged_summary(profiles.daily_sketches(none, FEATURES), ["feature"]).count() == 0
    with pytest.raises(KeyError, match="missing columns: c"):
        profiles.daily_counts(facts, ["c"])
    with pytest.raises(FileNotFoundError):
        tables.read_profiles(spark, str(tmp_path / "absent"), schemas.VALUE_COUNTS)
    assert versions.current(spark, str(tmp_path / "absent")) is None
