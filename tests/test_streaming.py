import json

import pytest
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.operators import regularise
from tidedock.operators.anomaly import stuck_stations
from tidedock.sources import tables
from tidedock.streaming import feed

BASE = 1772352000  # 2026-03-01 08:00 UTC


def _land(folder, polls):
    folder.mkdir(exist_ok=True)
    for i, stations in enumerate(polls):
        rows = [
            {"station_id": s, "num_bikes_available": b, "num_docks_available": 20 - b, "last_reported": BASE + 60 * m,
             "is_renting": True, "is_returning": True, "status": "IN_SERVICE"}
            for s, m, b in stations
        ]
        (folder / f"poll-{i:03d}.json").write_text(json.dumps({"ttl": 30, "data": {"stations": rows}}))


POLLS = [[("a", 5 * i, 5 if i > 2 else i), ("b", 5 * i, i % 7)] for i in range(40)] + [[("a", 0, 0)], [("z", 600, 1)]]


def test_append_stream_is_idempotent(spark, tmp_path):
    _land(tmp_path / "in", POLLS)
    status = feed.status_stream(feed.read_document_stream(spark, str(tmp_path / "in")))
    for run in ("c1", "c2"):
        feed.append_stream(status, str(tmp_path / "table"), str(tmp_path / run)).awaitTermination()
    stored = tables.read_status(spark, str(tmp_path / "table"))
    assert stored.count() == 81
    assert stored.groupBy(*schemas.STATUS_GRAIN).count().where("count > 1").count() == 0


def test_append_stream_keeps_late_facts(spark, tmp_path):
    _land(tmp_path / "in", [[("a", 600, 1)], [("a", 0, 2)], [("a", 300, 3)], [("a", 300, 4)]])
    docs = feed.read_document_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    feed.append_stream(feed.status_stream(docs), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    stored = tables.read_status(spark, str(tmp_path / "t")).collect()
    assert sorted(r.num_bikes_available for r in stored) == [1, 2, 3]


def test_binned_stream_equals_batch(spark, tmp_path):
    _land(tmp_path / "in", POLLS)
    docs = feed.read_document_stream(spark, str(tmp_path / "in"))
    bins = feed.binned_stream(feed.status_stream(docs))
    (bins.writeStream.format("parquet").option("path", str(tmp_path / "bins"))
     .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(str(tmp_path / "bins"))
    batch_docs = spark.read.text(str(tmp_path / "in"), wholetext=True).select(F.col("value").alias("document"))
    status = feed.parse_station_status(batch_docs, F.current_timestamp()).dropDuplicates(schemas.STATUS_GRAIN)
    want = regularise.bin_status(status, lasts=schemas.FLAG_COLS).where("station_id <> 'z'")
    key = lambda df: sorted((r.station_id, r.timestamp, r.num_bikes_available) for r in df.collect())
    assert key(got.where("station_id <> 'z'")) == key(want)


LATE = [[("a", 0, 5), ("b", 0, 1)], [("a", 300, 5)], [("a", 310, 5)], [("a", 30, 7)], [("b", 200, 2)], [("b", 100, 2)]]


def test_stuck_stream_equals_the_batch_rule_on_late_files(spark, tmp_path):
    _land(tmp_path / "in", LATE)
    docs = feed.read_document_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    states = {}

    def keep(rows, epoch):
        states.update({r.station_id: tuple(r) for r in rows.collect()})

    feed.stuck_stream(feed.status_stream(docs), str(tmp_path / "t"), str(tmp_path / "c"), keep, 0.0).awaitTermination()
    facts = tables.read_status(spark, str(tmp_path / "t")).withColumnRenamed("last_reported", "timestamp")
    batch = {r.station_id: tuple(r) for r in stuck_stations(facts, 0.0).collect()}
    assert states == batch
    assert batch["a"][2] == pytest.approx(10 / 60) and batch["b"][2] == pytest.approx(100 / 60)


def test_stuck_stream_reads_the_same_facts_however_long_the_history(spark, tmp_path, monkeypatch):
    days = 6
    polls = [[("a", 1440 * d + m, d + m) for m in (0, 5, 10)] for d in range(days)] + [[("a", 1440 * 2 + 7, 50)]]
    _land(tmp_path / "in", polls)
    docs = feed.read_document_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    read, states, whole = [], {}, feed.slice_summaries

    def counted(facts):
        read.append(facts.count())
        return whole(facts)

    def keep(rows, epoch):
        states.update({r.station_id: tuple(r) for r in rows.collect()})

    monkeypatch.setattr(feed, "slice_summaries", counted)
    feed.stuck_stream(feed.status_stream(docs), str(tmp_path / "t"), str(tmp_path / "c"), keep, 0.0).awaitTermination()
    assert sorted(read) == [3] * days + [4]
    facts = tables.read_status(spark, str(tmp_path / "t")).withColumnRenamed("last_reported", "timestamp")
    assert states == {r.station_id: tuple(r) for r in stuck_stations(facts, 0.0).collect()}


def test_quality_stream_counts(spark, tmp_path):
    _land(tmp_path / "in", [[("a", 0, -1), ("b", 0, 3), ("b", 0, 4)]])
    seen = []
    status = feed.status_stream(feed.read_document_stream(spark, str(tmp_path / "in")))
    known = spark.sql("SELECT 'a' AS station_id")
    feed.quality_stream(status, known, lambda df, epoch: seen.append(df.first().asDict()), str(tmp_path / "c")).awaitTermination()
    assert seen == [{"orphan_status_rows": 2, "negative_availability": 1, "ingestion_before_last_reported": 0,
                     "duplicate_grain_keys": 1, "n_rows": 3}]
