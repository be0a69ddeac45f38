from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from times import START  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidedock-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stage")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def activity(spark):
    """Frame of one or more stations from lists of counts, one row every ``minutes``."""

    def build(counts: dict[str, list[float]], minutes: int = 15, **extra):
        rows = [
            (sid, START + dt.timedelta(minutes=minutes * i), float(v), 20.0 - float(v), 20, -23.5, -46.6, True)
            for sid, values in counts.items()
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(
            rows,
            "station_id string, timestamp timestamp_ntz, num_bikes_available double, num_docks_available double,"
            " capacity int, lat double, lon double, is_renting boolean",
        )

    return build


@pytest.fixture
def raw_status(spark):
    """Raw reports from ``(station, minute offset, bikes)`` triples."""

    def build(rows):
        data = [
            (s, START + dt.timedelta(minutes=m), b, 20 - b, 0, 0, True, True, "IN_SERVICE",
             START + dt.timedelta(minutes=m + 1), 20, -23.5, -46.6)
            for s, m, b in rows
        ]
        return spark.createDataFrame(
            data,
            "station_id string, last_reported timestamp_ntz, num_bikes_available int, num_docks_available int,"
            " num_bikes_disabled int, num_docks_disabled int, is_renting boolean, is_returning boolean, status string,"
            " ingestion_timestamp timestamp_ntz, capacity int, lat double, lon double",
        )

    return build
