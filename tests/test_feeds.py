import json

import pytest
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.sources import feeds, tables, writers
from tidedock.plans.ingestion import ingest

STATION = {
    "station_id": "1", "num_bikes_available": 5, "num_docks_available": 10, "num_bikes_disabled": 1,
    "num_docks_disabled": 0, "last_reported": 1772352000, "is_renting": True, "is_returning": True,
    "status": "IN_SERVICE", "surprise": {"x": 1},
}
INFO = {"station_id": "1", "name": "Plaza", "lat": -23.5, "lon": -46.6, "capacity": 15, "address": "A St",
        "groups": ["g"]}


def _docs(spark, *payloads):
    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "document string")


def _envelope(*stations):
    return {"last_updated": 1772352000, "ttl": 30, "data": {"stations": list(stations)}}


def _now():
    return F.lit("2026-03-01 09:00:00").cast("timestamp")


def test_status_is_typed_and_stamped(spark):
    docs = _docs(spark, _envelope(STATION, {**STATION, "station_id": 2}))
    rows = feeds.parse_station_status(docs, _now()).orderBy("station_id").collect()
    assert [r.station_id for r in rows] == ["1", "2"]
    assert (rows[0].num_bikes_available, rows[0].num_bikes_disabled, rows[0].is_renting) == (5, 1, True)
    assert str(rows[0].last_reported) == "2026-03-01 08:00:00"
    assert len({r.ingestion_timestamp for r in rows}) == 1
    assert [r.seq for r in rows] == [0, 1]


def test_missing_or_null_required_field_is_skipped(spark):
    bad = {"station_id": "9"}
    null = {**STATION, "status": None}
    checked = feeds.check_station_status(_docs(spark, _envelope(bad, null, STATION)))
    assert checked.where("reject_reason is null").count() == 1
    reasons = {r.reject_reason for r in feeds.rejected(checked).collect()}
    assert "missing: status" in reasons and len(reasons) == 2


def test_optional_counts_default_to_zero(spark):
    short = {k: v for k, v in STATION.items() if not k.endswith("disabled")}
    row = feeds.parse_station_status(_docs(spark, _envelope(short)), _now()).first()
    assert (row.num_bikes_disabled, row.num_docks_disabled) == (0, 0)


def test_malformed_value_rejects_one_record(spark):
    bad = {**STATION, "num_bikes_available": "many"}
    checked = feeds.check_station_status(_docs(spark, _envelope(bad, STATION)))
    assert [r.reject_reason for r in feeds.rejected(checked).collect()] == ["malformed: num_bikes_available"]


def test_decimal_counts_are_cut(spark):
    row = feeds.parse_station_status(_docs(spark, _envelope({**STATION, "num_bikes_available": 3.9})), _now()).first()
    assert row.num_bikes_available == 3


def test_bad_envelope_is_quarantined_or_raises(spark):
    docs = _docs(spark, {"bad": 1}, _envelope(STATION))
    checked = feeds.check_station_status(docs)
    assert [r.reject_reason for r in feeds.rejected(checked).collect()] == ["envelope"]
    assert feeds.parse_station_status(docs, _now()).count() == 1
    with pytest.raises(Exception, match="document without data.stations"):
        feeds.parse_station_status(docs, _now(), strict=True).collect()


def test_empty_station_list_is_valid(spark):
    assert feeds.check_station_status(_docs(spark, _envelope())).count() == 0


def test_information_optional_fields(spark):
    bare = {k: v for k, v in INFO.items() if k not in ("address", "groups")}
    row = feeds.parse_station_information(_docs(spark, _envelope(bare))).first()
    assert row.address is None and row.groups == []


def test_discovery_falls_back(spark):
    feed = {"feeds": [{"name": "station_status", "url": "u"}]}
    docs = _docs(spark, {"version": "2.2", "ttl": 30, "last_updated": 1772352000, "data": {"pt": feed}})
    assert [tuple(r) for r in feeds.discover_feeds(docs).collect()] == [("station_status", "u")]
    meta = feeds.feed_metadata(docs).first()
    assert (meta.version, meta.ttl) == ("2.2", 30)


def test_vehicle_types(spark):
    kind = {"vehicle_type_id": "3", "name": "Bike", "form_factor": "bicycle", "propulsion_type": "human", "x": 1}
    rows = feeds.read_vehicle_types(_docs(spark, {"data": {"vehicle_types": [kind]}})).collect()
    assert [tuple(r) for r in rows] == [("3", "Bike", "bicycle", "human")]


def test_ingest_twice_adds_nothing(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "status.json").write_text(json.dumps(_envelope(STATION, {**STATION, "station_id": "2"}, STATION), indent=1))
    (land / "info.json").write_text(json.dumps(_envelope(INFO, {**INFO, "name": "Plaza B"}), indent=1))
    args = (spark, str(land / "status.json"), str(land / "info.json"), str(tmp_path / "status"), str(tmp_path / "info"))
    assert ingest(*args, _now()) == {"status_inserted": 2, "information_upserted": 2}
    assert ingest(*args, _now()) == {"status_inserted": 0, "information_upserted": 2}
    assert tables.read_status(spark, str(tmp_path / "status")).count() == 2
    snapshot = tables.read_snapshot(spark, str(tmp_path / "info")).collect()
    assert [(r.station_id, r.name) for r in snapshot] == [("1", "Plaza B")]


def test_metrics_and_importance_files(spark, tmp_path):
    metrics = spark.createDataFrame([("lgbm", 0.15, 0.5, 0.98)], "model string, mae double, rmse double, r2 double")
    writers.write_metrics(metrics, str(tmp_path / "metrics"))
    assert tuple(tables.read_metrics(spark, str(tmp_path / "metrics")).first()) == ("lgbm", 0.15, 0.5, 0.98)
    assert tables.read_metrics(spark, str(tmp_path / "none"), missing_ok=True).count() == 0
    assert tables.read_feature_importance(spark, str(tmp_path / "none")).columns == ["feature", "importance"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_metrics(spark, str(tmp_path / "none"))


def test_prediction_and_anomaly_sinks(spark, tmp_path):
    path = str(tmp_path / "predictions")
    batch = spark.sql("""SELECT * FROM VALUES ('a', TIMESTAMP'2026-01-01 00:00:00', TIMESTAMP'2026-01-01 00:15:00',
        'naive', 1.0D), ('a', TIMESTAMP'2026-01-01 00:00:00', TIMESTAMP'2026-01-01 00:30:00', 'naive', 2.0D)
        AS t(station_id, prediction_time, target_time, model_name, predicted_value)""")
    assert writers.save_predictions(batch, path, _now(), ["predicted_value"]) == 2
    assert writers.save_predictions(batch, path, _now(), ["predicted_value"]) == 0
    stored = tables.read_predictions(spark, path)
    assert stored.where("actual_value is null").count() == 2
    results = spark.sql("SELECT 'a' station_id, true is_stuck, false is_statistical_outlier, 3.0D stuck_duration_hours,"
                        " 0.0D isolation_score")
    anomalies = str(tmp_path / "anomalies")
    assert writers.append_anomalies(results, anomalies, _now()) == 1
    assert writers.append_anomalies(results, anomalies, _now()) == 0


def test_append_reads_only_the_days_of_its_batch(spark, raw_status, tmp_path):
    path = str(tmp_path / "status")
    day = 24 * 60
    cols = schemas.STATUS.fieldNames()
    old = raw_status([("a", d * day, d) for d in range(10)]).select(*cols)
    late = raw_status([("a", 3 * day, 99), ("b", 3 * day, 1)]).select(*cols)
    assert writers.append_status(old, path, ["ingestion_timestamp"]) == 10
    assert writers.append_status(late, path, ["ingestion_timestamp"]) == 1
    stored = tables.read_status(spark, path)
    assert stored.where("station_id = 'a' AND num_bikes_available = 99").count() == 0 and stored.count() == 11
    batch = late.withColumn("reported_on", F.to_date("last_reported"))
    scan = writers.of_days(stored, batch, "reported_on").select("station_id")
    assert scan.count() == 2
    plan = scan._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "reported_on" in partition_filters and "2026-03-04" in partition_filters
