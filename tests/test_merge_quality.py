import datetime as dt

from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.operators import curate, merge, quality

T0 = dt.datetime(2026, 3, 1, 8)


def _facts(spark, rows):
    return spark.createDataFrame(rows, "station_id string, last_reported timestamp_ntz, v int, seq int")


def test_append_keeps_existing_and_first_of_batch(spark):
    target = _facts(spark, [("a", T0, 1, 0)])
    batch = _facts(spark, [("a", T0, 9, 0), ("b", T0, 2, 2), ("b", T0, 3, 1)])
    out = merge.append_ignore_conflicts(target, batch, schemas.STATUS_GRAIN, ["seq"])
    assert sorted((r.station_id, r.v) for r in out.collect()) == [("a", 1), ("b", 3)]
    again = merge.append_ignore_conflicts(out, batch, schemas.STATUS_GRAIN, ["seq"])
    assert again.count() == out.count()


def test_append_with_one_hot_key(spark):
    batch = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("station_id"),
        F.lit(T0).cast("timestamp_ntz").alias("last_reported"), F.col("id").cast("int").alias("v"), F.col("id").alias("seq"),
    )
    out = merge.new_rows(None, batch, schemas.STATUS_GRAIN, ["seq"])
    assert out.count() == 20_000 - 6_667 + 1
    assert out.where("station_id = 'hot'").first().v == 0


def test_upsert_last_wins(spark):
    current = spark.sql("SELECT 'a' station_id, 'old' name, TIMESTAMP_NTZ'2026-01-01' updated_at UNION ALL"
                        " SELECT 'z', 'kept', TIMESTAMP_NTZ'2026-01-01'")
    batch = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "n", 1)], "station_id string, name string, seq int")
    out = merge.upsert_latest_wins(current, batch, ["station_id"], "seq", F.expr("TIMESTAMP_NTZ'2026-02-01'"))
    assert sorted((r.station_id, r.name, r.updated_at.month) for r in out.collect()) == [
        ("a", "y", 2), ("b", "n", 2), ("z", "kept", 1)]


def test_backfill_fills_all_models_only_where_null(spark):
    predictions = spark.createDataFrame(
        [("a", T0, "m1", 1.0, None), ("a", T0, "m2", 2.0, None), ("a", T0, "m3", 2.0, 7.0), ("b", T0, "m1", 1.0, None)],
        "station_id string, target_time timestamp_ntz, model_name string, predicted_value double, actual_value double")
    actuals = spark.createDataFrame([("a", T0, 5.0)], "station_id string, target_time timestamp_ntz, actual_value double")
    rows = {(r.station_id, r.model_name): (r.actual_value, r.updated)
            for r in merge.backfill_actuals(predictions, actuals, ["actual_value"]).collect()}
    assert rows == {("a", "m1"): (5.0, True), ("a", "m2"): (5.0, True), ("a", "m3"): (7.0, False), ("b", "m1"): (None, False)}


def _information(spark):
    return spark.sql("SELECT 'a' station_id, 'Plaza' name, -23.5D lat, -46.6D lon, 0 capacity, CAST(NULL AS STRING) address,"
                     " array('g') groups, TIMESTAMP_NTZ'2026-01-01' updated_at")


def test_curated_views(spark, raw_status):
    status = raw_status([("a", 0, 5), ("a", 15, 6), ("x", 0, 1)])
    enriched = curate.station_status_enriched(status, _information(spark))
    assert len(enriched.columns) == 17 and enriched.count() == 3
    assert enriched.where("name is null").count() == 1
    latest = {r.station_id: r.num_bikes_available for r in curate.station_status_latest(status, _information(spark)).collect()}
    assert latest == {"a": 6, "x": 1}
    geo = curate.station_geo_snapshot(curate.latest_rows(status), _information(spark)).collect()
    assert [(r.availability_pct, r.band) for r in geo] == [(600.0, "green")]
    assert [r.station_id for r in curate.orphan_station_ids(status, _information(spark)).collect()] == ["x"]
    assert curate.filter_by_stations(status, []).count() == 3
    assert curate.filter_by_stations(status, ["x"]).count() == 1


def test_quality_report(spark, raw_status):
    status = raw_status([("a", 0, 5), ("a", 0, 5), ("x", 0, -1)])
    rows = {r.name: (r.violation_count, r.passed) for r in quality.dq_report(status, _information(spark)).collect()}
    assert rows == {"orphan_status_rows": (1, False), "negative_availability": (1, False),
                    "ingestion_before_last_reported": (0, True), "duplicate_grain_keys": (1, False)}
    summary = quality.dq_summary(quality.dq_report(status, _information(spark)), F.lit("now")).first()
    assert summary.overall_passed is False and summary.summary.startswith('{"timestamp":"now","checks":[{"name":"orphan')


def test_quality_report_on_empty_table(spark, raw_status):
    empty = raw_status([("a", 0, 5)]).limit(0)
    assert all(r.passed for r in quality.dq_report(empty, _information(spark)).collect())


def test_null_profile_marks_missing_columns(spark):
    df = spark.createDataFrame([("a", 1.0), (None, float("nan"))], "station_id string, x double")
    rows = {r.field: (r.null_count, r.verdict) for r in quality.null_profile(df, ["station_id", "x"], ["zz"]).collect()}
    assert rows == {"station_id": (1, "WARNING"), "x": (1, "WARNING"), "zz": (None, "NOT FOUND")}
