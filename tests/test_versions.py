import pytest
from pyspark.sql import functions as F

from tidedock import schemas, staging
from tidedock.sources import tables, versions, writers


def _table(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, day string")


def _read(spark, path, version=None):
    kind = _table(spark, []).schema
    return sorted(map(tuple, versions.read(spark, path, kind, ["day"], version).collect()), key=str)


def test_append_replace_and_older_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        _read(spark, path)
    first = [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]
    assert versions.append(_table(spark, first), path, ["day"], None) == 1
    assert versions.append(_table(spark, [(4, "d", "x")]), path, ["day"], 1) == 2
    assert versions.replace(_table(spark, [(9, "z", "x"), (8, "n", None)]), path, ["day"], 2) == 3
    assert _read(spark, path) == sorted([(9, "z", "x"), (8, "n", None), (2, "b", "y")], key=str)
    assert _read(spark, path, 1) == sorted(first, key=str)
    assert versions.expire(spark, path, ["day"], _table(spark, []).schema, keep=1) > 0
    assert len(_read(spark, path)) == 3 and versions.current(spark, path) == 3


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.append(_table(spark, [(1, "a", "x")]), path, ["day"], None)
    versions.append(_table(spark, [(2, "b", "x")]), path, ["day"], 1)
    with pytest.raises(versions.VersionConflict):
        versions.replace(_table(spark, [(3, "c", "x")]), path, ["day"], 1)
    assert _read(spark, path) == [(1, "a", "x"), (2, "b", "x")]


def test_backfill_that_is_lost_before_it_is_published(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    now = F.lit("2026-03-01").cast("timestamp")
    batch = spark.sql("""SELECT 's' AS station_id, TIMESTAMP'2026-03-01 00:00:00' AS prediction_time, m AS model_name,
        TIMESTAMP'2026-03-01 00:00:00' + make_interval(0, 0, 0, d) AS target_time, 1.0D AS predicted_value
        FROM VALUES (0, 'a'), (1, 'a'), (0, 'b') AS t(d, m)""")
    assert writers.save_predictions(batch, path, now, ["predicted_value"]) == 3
    seen = spark.sql("SELECT 's' AS station_id, TIMESTAMP'2026-03-01 00:00:00' AS target_time, 7.0D AS actual_value")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            writers.backfill_predictions(spark, path, seen, ["actual_value"])
    old = tables.read_predictions(spark, path)
    assert old.count() == 3 and old.where("actual_value IS NOT NULL").count() == 0
    assert writers.backfill_predictions(spark, path, seen, ["actual_value"]) == 2
    assert tables.read_predictions(spark, path).count() == 3
    assert tables.read_predictions(spark, path).where("actual_value = 7").count() == 2
    schema = tables._with_day(schemas.PREDICTIONS, "target_on")
    versions.expire(spark, path, tables.PREDICTION_PARTS, schema)
    assert tables.read_predictions(spark, path).where("actual_value = 7").count() == 2


def test_predictions_are_written_once_and_actuals_read_once(spark, tmp_path):
    path = str(tmp_path / "p")
    batch = spark.sql("""SELECT concat('s', id) AS station_id, TIMESTAMP'2026-03-01' AS prediction_time,
      TIMESTAMP'2026-03-01' + make_interval(0, 0, 0, CAST(id % 2 AS INT)) AS target_time, concat('m', id % 3) AS model_name,
      double(id) AS predicted_value FROM range(60)""")
    staged = len(staging._written)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would end in one task
    try:
        assert writers.save_predictions(batch, path, F.lit("2026-03-01").cast("timestamp"), ["predicted_value"]) == 60
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(staging._written) == staged
    assert len(list((tmp_path / "p" / "data").rglob("*.parquet"))) == 6  # one file per model and day
    assert writers.save_predictions(batch, path, F.lit("2026-03-01").cast("timestamp"), ["predicted_value"]) == 0
    assert versions.current(spark, path) == 1

    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    actuals = batch.select("station_id", "target_time", (F.col("predicted_value") + 1).alias("actual_value"))
    assert writers.backfill_predictions(spark, path, actuals.mapInArrow(seen, actuals.schema), ["actual_value"]) == 60
    assert read.value == 60
    assert tables.read_predictions(spark, path).where("actual_value = predicted_value + 1").count() == 60
