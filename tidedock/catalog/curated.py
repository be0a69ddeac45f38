"""Queries: ingestion, merges, curated views and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.catalog import adapters as a
from tidedock.catalog.oracles import INFO, LATEST, STATUS, feature_ctes, series_ctes, with_, PREDICTIONS, STUCK
from tidedock.catalog.registry import query
from tidedock.functions import labels
from tidedock.operators import anomaly, curate, merge, quality, regularise
from tidedock.sources import feeds, tables

FACTS = ", ".join(curate.FACT_COLS)
R_FACTS = ", ".join(f"r.{c}" for c in curate.FACT_COLS)
DIM = "i.name, i.lat, i.lon, i.capacity, i.address, i.updated_at AS station_info_updated_at"
PLACE = ["lat", "lon"]

DOCUMENTS = f"""{STATUS}, docs AS (
  SELECT seq AS event_id, station_id, num_bikes_available, num_docks_available,
    CASE WHEN seq % 7 = 0 THEN 0 ELSE num_bikes_disabled END AS num_bikes_disabled,
    CASE WHEN seq % 7 = 0 THEN 0 ELSE num_docks_disabled END AS num_docks_disabled,
    date_trunc('second', last_reported) AS last_reported, is_renting, is_returning,
    CASE WHEN seq % 11 = 0 THEN NULL ELSE status END AS status, seq % 101 = 0 AS broken
  FROM status)"""


def _no_groups(df):
    return df.drop("groups")


# -- feeds ---------------------------------------------------------------------------------------


@query(
    "parse_station_status",
    with_(DOCUMENTS, """SELECT event_id, station_id, num_bikes_available, num_docks_available, num_bikes_disabled,
      num_docks_disabled, last_reported, is_renting, is_returning, status,
      TIMESTAMP '2024-01-31 00:00:00' AS ingestion_timestamp
      FROM docs WHERE NOT broken AND status IS NOT NULL"""),
)
def parse_station_status(spark, sf):
    return feeds.parse_station_status(a.status_documents(spark, sf), a.as_of()).drop("seq")


@query(
    "parse_station_information",
    with_(INFO, """SELECT station_id, name, lat, lon, capacity, address,
      CASE WHEN CAST(station_id AS INTEGER) % 5 = 0 THEN 0 ELSE 1 END AS n_groups
      FROM station_information WHERE CAST(station_id AS INTEGER) % 13 <> 0""", PLACE),
)
def parse_station_information(spark, sf):
    parsed = feeds.parse_station_information(a.information_documents(spark, sf))
    return parsed.withColumn("n_groups", F.size("groups")).drop("groups", "seq")


@query(
    "validate_required",
    with_(DOCUMENTS, """SELECT coalesce(CASE WHEN broken THEN 'envelope' WHEN status IS NULL THEN 'missing: status' END,
      'accepted') AS outcome, count(*) AS n FROM docs GROUP BY 1"""),
)
def validate_required(spark, sf):
    checked = feeds.check_station_status(a.status_documents(spark, sf))
    return checked.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


@query(
    "coerce_status",
    with_(DOCUMENTS, """SELECT station_id, CAST(sum(num_bikes_disabled) AS BIGINT) AS bikes_disabled,
      CAST(sum(num_docks_disabled) AS BIGINT) AS docks_disabled, count(*) FILTER (WHERE is_renting) AS renting,
      min(last_reported) AS first_reported FROM docs WHERE NOT broken AND status IS NOT NULL GROUP BY 1"""),
)
def coerce_status(spark, sf):
    parsed = feeds.parse_station_status(a.status_documents(spark, sf), a.as_of())
    return parsed.groupBy("station_id").agg(
        F.sum("num_bikes_disabled").alias("bikes_disabled"),
        F.sum("num_docks_disabled").alias("docks_disabled"),
        F.count_if("is_renting").alias("renting"),
        F.min("last_reported").alias("first_reported"),
    )


# -- merges --------------------------------------------------------------------------------------

DAILY = """daily AS (SELECT * REPLACE (date_trunc('day', last_reported) AS last_reported) FROM status),
existing AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY station_id, last_reported
  ORDER BY seq) AS rn FROM daily WHERE status = 'view') WHERE rn = 1)"""


@query(
    "append_ignore_conflicts",
    with_(f"{STATUS}, {DAILY}", f"""SELECT {FACTS}, seq FROM existing UNION ALL
      SELECT {FACTS}, seq FROM (SELECT *, row_number() OVER (PARTITION BY station_id, last_reported ORDER BY seq) AS rn
        FROM daily d WHERE NOT EXISTS (SELECT 1 FROM existing e
          WHERE e.station_id = d.station_id AND e.last_reported = d.last_reported)) WHERE rn = 1"""),
)
def append_ignore_conflicts(spark, sf):
    return merge.append_ignore_conflicts(
        a.first_daily_views(spark, sf), a.daily_status(spark, sf), schemas.STATUS_GRAIN, ["seq"]
    )


@query(
    "upsert_latest_wins",
    with_(INFO, """SELECT station_id, name, lat, lon, capacity, address, updated_at FROM (
        SELECT CAST(user_id AS VARCHAR) AS station_id, 'Dock ' || event_id AS name,
          CAST(-23.5 - 0.001 * (event_id % 25) AS DOUBLE) AS lat,
          CAST(-46.6 - 0.001 * (event_id % 50) AS DOUBLE) AS lon,
          CAST(20 + event_id % 20 AS INTEGER) AS capacity, event_type AS address,
          TIMESTAMP '2024-02-01 00:00:00' AS updated_at,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
      UNION ALL
      SELECT station_id, name, lat, lon, capacity, address, updated_at FROM station_information
      WHERE CAST(station_id AS BIGINT) NOT IN (SELECT user_id FROM events)""", PLACE),
)
def upsert_latest_wins(spark, sf):
    return _no_groups(
        merge.upsert_latest_wins(
            a.information(spark, sf),
            a.information_batch(spark, sf),
            ["station_id"],
            "seq",
            F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"),
        )
    )


@query(
    "save_predictions",
    with_(f"{feature_ctes()}, {PREDICTIONS}", """SELECT station_id, target_time, model_name, predicted_value
      FROM predictions WHERE NOT (model_name = 'naive' AND hour(target_time) < 12)""", ["predicted_value"]),
)
def save_predictions(spark, sf):
    batch = a.predictions(spark, sf).drop("actual_value", "prediction_time")
    stored = batch.where((F.col("model_name") == "naive") & (F.hour("target_time") < 12))
    return merge.new_rows(stored, batch, schemas.PREDICTION_GRAIN, ["predicted_value"])


@query(
    "backfill_actuals",
    with_(
        f"{feature_ctes()}, {PREDICTIONS}, stored AS (SELECT * REPLACE (CASE WHEN hour(target_time) < 12 "
        "THEN actual_value END AS actual_value) FROM predictions)",
        """SELECT p.station_id, p.target_time, p.model_name, p.predicted_value,
      coalesce(p.actual_value, s.num_bikes_available) AS actual_value,
      p.actual_value IS NULL AND s.num_bikes_available IS NOT NULL AS updated
      FROM stored p LEFT JOIN series s ON s.station_id = p.station_id AND s."timestamp" = p.target_time""",
        ["predicted_value", "actual_value"],
    ),
)
def backfill_actuals(spark, sf):
    known = F.when(F.hour("target_time") < 12, F.col("actual_value"))
    stored = a.predictions(spark, sf).drop("prediction_time").withColumn("actual_value", known)
    observed = a.series(spark, sf).select(
        "station_id", F.col("timestamp").alias("target_time"), F.col("num_bikes_available").alias("actual_value")
    )
    return merge.backfill_actuals(stored, observed, ["target_time"])


@query(
    "build_prediction_records",
    with_(feature_ctes(), """SELECT station_id, TIMESTAMP '2024-01-31 00:00:00' AS prediction_time,
      "timestamp" + INTERVAL 15 MINUTE AS target_time, 'naive' AS model_name, bikes_lag_1 AS predicted_value
      FROM features""", ["predicted_value"]),
)
def build_prediction_records(spark, sf):
    from tidedock.operators.models import NaiveBaseline, score

    return merge.prediction_records(score(NaiveBaseline(), a.features(spark, sf)), "naive", a.as_of())


@query(
    "load_predictions",
    with_(f"{feature_ctes()}, {PREDICTIONS}", """SELECT station_id, target_time, predicted_value, actual_value
      FROM predictions WHERE model_name = 'mean' AND actual_value IS NOT NULL
      AND target_time >= TIMESTAMP '2024-01-24 00:00:00'""", ["predicted_value", "actual_value"]),
)
def load_predictions(spark, sf):
    return tables.load_predictions(a.predictions(spark, sf), "mean", a.as_of() - F.expr("INTERVAL 7 DAYS"))


@query(
    "unresolved_anomalies",
    with_(
        f"{series_ctes()}, {STUCK.format(src='series')}",
        """SELECT station_id, TIMESTAMP '2024-01-31 00:00:00' AS detected_at, true AS is_stuck,
      false AS is_statistical_outlier, duration_hours AS stuck_duration_hours, 0.0::DOUBLE AS isolation_score
      FROM stuck_all WHERE duration_hours >= 1 AND is_renting""",
        ["stuck_duration_hours", "isolation_score"],
    ),
)
def unresolved_anomalies(spark, sf):
    stuck = anomaly.stuck_stations(a.series(spark, sf), 1.0)
    results = stuck.select(
        "station_id",
        F.lit(True).alias("is_stuck"),
        F.lit(False).alias("is_statistical_outlier"),
        F.col("duration_hours").alias("stuck_duration_hours"),
        F.lit(0.0).alias("isolation_score"),
        "is_renting",
    )
    stored = anomaly.anomaly_records(results, a.as_of()).join(results.select("station_id", "is_renting"), "station_id")
    closed = F.when(~F.col("is_renting"), F.col("detected_at")).cast("timestamp_ntz")
    stored = stored.withColumn("resolved_at", closed).drop("is_renting")
    return anomaly.unresolved(stored).drop("resolved_at", "notes")


# -- curated views -------------------------------------------------------------------------------


@query(
    "station_status_enriched",
    with_(f"{STATUS}, {INFO}", f"""SELECT {R_FACTS}, {DIM} FROM status r
      LEFT JOIN station_information i ON i.station_id = r.station_id""", PLACE),
)
def station_status_enriched(spark, sf):
    return _no_groups(curate.station_status_enriched(a.status(spark, sf), a.information(spark, sf)))


@query(
    "station_status_latest",
    with_(f"{STATUS}, {INFO}, {LATEST}", f"""SELECT {R_FACTS}, {DIM} FROM latest r
      LEFT JOIN station_information i ON i.station_id = r.station_id""", PLACE),
)
def station_status_latest(spark, sf):
    return _no_groups(curate.station_status_latest(a.status(spark, sf), a.information(spark, sf)))


@query(
    "with_station_name",
    with_(f"{STATUS}, {INFO}", """SELECT r.station_id, r.last_reported, coalesce(i.name, r.station_id) AS station_name
      FROM status r LEFT JOIN station_information i ON i.station_id = r.station_id"""),
)
def with_station_name(spark, sf):
    facts = a.status(spark, sf).select("station_id", "last_reported")
    return curate.with_station_name(facts, tables.station_names(a.information(spark, sf)))


BAND = """i.lat, i.lon, i.name, i.capacity, r.is_renting, r.num_bikes_available,
  r.num_bikes_available / CAST(CASE WHEN i.capacity = 0 THEN 1 ELSE i.capacity END AS DOUBLE) * 100
    AS availability_pct"""
SNAPSHOT = f"""{STATUS}, {INFO}, {LATEST}, snap AS (SELECT r.station_id, {BAND} FROM latest r
  JOIN station_information i ON i.station_id = r.station_id), banded AS (SELECT *,
  CASE WHEN NOT is_renting THEN 'black' WHEN availability_pct <= 10 THEN 'red' WHEN availability_pct <= 30
    THEN 'orange' WHEN availability_pct <= 70 THEN 'blue' ELSE 'green' END AS band FROM snap)"""


@query("station_geo_snapshot", with_(SNAPSHOT, "SELECT * FROM banded", [*PLACE, "availability_pct"]))
def station_geo_snapshot(spark, sf):
    return curate.station_geo_snapshot(curate.latest_rows(a.status(spark, sf)), a.information(spark, sf))


@query(
    "availability_band",
    with_(f"{STATUS}, {INFO}", """SELECT band, count(*) AS n FROM (SELECT CASE WHEN NOT is_renting THEN 'black'
      WHEN p <= 10 THEN 'red' WHEN p <= 30 THEN 'orange' WHEN p <= 70 THEN 'blue' ELSE 'green' END AS band
      FROM (SELECT is_renting, num_bikes_available / CAST(capacity AS DOUBLE) * 100 AS p
        FROM status JOIN station_information USING (station_id))) GROUP BY 1"""),
)
def availability_band(spark, sf):
    rows = a.status(spark, sf).join(a.information(spark, sf).select("station_id", "capacity"), "station_id")
    pct = labels.availability_pct(F.col("num_bikes_available"), F.col("capacity"))
    return rows.groupBy(labels.availability_band(pct, F.col("is_renting")).alias("band")).agg(F.count("*").alias("n"))


@query(
    "orphan_station_ids",
    with_(f"{STATUS}, {INFO}", """SELECT DISTINCT station_id FROM status
      WHERE station_id NOT IN (SELECT station_id FROM station_information)"""),
)
def orphan_station_ids(spark, sf):
    return curate.orphan_station_ids(a.status(spark, sf), a.information(spark, sf))


@query(
    "filter_by_stations",
    with_(f"{STATUS}, {INFO}", f"""SELECT {FACTS} FROM status WHERE station_id IN
      (SELECT station_id FROM station_information WHERE capacity >= 35)"""),
)
def filter_by_stations(spark, sf):
    large = a.information(spark, sf).where("capacity >= 35")
    return curate.filter_by_stations(a.status(spark, sf), large)


@query(
    "load_raw_status",
    with_(f"{STATUS}, {INFO}", f"""SELECT r.station_id, last_reported, num_bikes_available, num_docks_available,
      num_bikes_disabled, num_docks_disabled, is_renting, is_returning, capacity, lat, lon
      FROM status r LEFT JOIN station_information i ON i.station_id = r.station_id
      WHERE r.station_id IN (SELECT station_id FROM status GROUP BY 1
        HAVING floor(epoch(max(last_reported) - min(last_reported)) / 86400) >= 29)""", PLACE),
)
def load_raw_status(spark, sf):
    enriched = curate.station_status_enriched(a.status(spark, sf), a.information(spark, sf))
    return tables.load_raw_status(enriched, 29)


@query(
    "min_history_stations",
    with_(STATUS, """SELECT station_id, CAST(floor(epoch(max(last_reported) - min(last_reported)) / 86400) AS INTEGER)
      AS whole_days FROM status GROUP BY 1"""),
)
def min_history_stations(spark, sf):
    return regularise.station_spans(a.status(spark, sf))


@query("station_names", with_(INFO, "SELECT station_id, coalesce(name, station_id) AS name FROM station_information"))
def station_names(spark, sf):
    return tables.station_names(a.information(spark, sf))


@query(
    "list_stations",
    with_(INFO, "SELECT station_id, name, lat, lon, capacity FROM station_information", PLACE),
)
def list_stations(spark, sf):
    return tables.list_stations(a.information(spark, sf))


@query("station_count", "SELECT count(*) AS count FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def station_count(spark, sf):
    return tables.station_count(a.information(spark, sf))


@query(
    "label_formatting",
    with_(f"{STATUS}, {INFO}", """SELECT r.station_id, last_reported, upper(status) AS status_label,
      lpad(CAST(hour(last_reported) AS VARCHAR), 2, '0') || ':00' AS hour_label,
      substring(coalesce(i.name, r.station_id), 1, 12) AS short_name,
      CASE WHEN is_renting THEN strftime(last_reported, '%Y-%m-%d %H:%M') ELSE 'Never (in window)' END AS last_text
      FROM status r LEFT JOIN station_information i ON i.station_id = r.station_id"""),
)
def label_formatting(spark, sf):
    facts = a.status(spark, sf).select("station_id", "last_reported", "status", "is_renting")
    named = curate.with_station_name(facts, tables.station_names(a.information(spark, sf)))
    t = F.col("last_reported")
    return named.select(
        "station_id",
        "last_reported",
        F.upper("status").alias("status_label"),
        labels.hour_label(F.hour(t)).alias("hour_label"),
        labels.short_name(F.col("station_name"), 12).alias("short_name"),
        labels.last_change_text(F.when(F.col("is_renting"), t)).alias("last_text"),
    )


# -- data quality --------------------------------------------------------------------------------

ORPHANS = """SELECT count(*) AS violation_count FROM status r WHERE NOT EXISTS
  (SELECT 1 FROM station_information s WHERE s.station_id = r.station_id)"""
NEGATIVE = """SELECT count(*) AS violation_count FROM status WHERE num_bikes_available < 0
  OR num_docks_available < 0 OR num_bikes_disabled < 0 OR num_docks_disabled < 0"""
EARLY = "SELECT count(*) AS violation_count FROM status WHERE ingestion_timestamp < last_reported"
DUPLICATES = """SELECT count(*) AS violation_count FROM (SELECT station_id, last_reported FROM {src}
  GROUP BY 1, 2 HAVING count(*) > 1)"""


@query("dq_orphan_status", with_(f"{STATUS}, {INFO}", ORPHANS))
def dq_orphan_status(spark, sf):
    return quality.orphan_rows(a.status(spark, sf), a.information(spark, sf))


@query("dq_negative", with_(STATUS, NEGATIVE))
def dq_negative(spark, sf):
    return quality.negative_rows(a.status(spark, sf))


@query("dq_ingest_before_report", with_(STATUS, EARLY))
def dq_ingest_before_report(spark, sf):
    return quality.early_ingestion_rows(a.status(spark, sf))


@query("dq_duplicate_grain", with_(f"{STATUS}, {DAILY}", DUPLICATES.format(src="daily")))
def dq_duplicate_grain(spark, sf):
    return quality.duplicate_keys(a.daily_status(spark, sf))


@query(
    "dq_unique_key",
    with_(f"{STATUS}, {DAILY}", """SELECT count(*) AS violation_count FROM (SELECT 1 FROM daily
      GROUP BY station_id, last_reported, status HAVING count(*) > 1)"""),
)
def dq_unique_key(spark, sf):
    return quality.duplicate_keys(a.daily_status(spark, sf), ["station_id", "last_reported", "status"])


@query(
    "dq_report",
    with_(f"{STATUS}, {INFO}, {DAILY}", f"""SELECT *, violation_count = 0 AS passed FROM (
      SELECT 1 AS ordinal, 'orphan_status_rows' AS name, violation_count FROM ({ORPHANS.replace('FROM status', 'FROM daily')})
      UNION ALL SELECT 2, 'negative_availability', violation_count FROM ({NEGATIVE.replace('FROM status', 'FROM daily')})
      UNION ALL SELECT 3, 'ingestion_before_last_reported', violation_count
        FROM ({EARLY.replace('FROM status', 'FROM daily')})
      UNION ALL SELECT 4, 'duplicate_grain_keys', violation_count FROM ({DUPLICATES.format(src='daily')}))"""),
)
def dq_report(spark, sf):
    return quality.dq_report(a.daily_status(spark, sf), a.information(spark, sf))


@query(
    "dq_summary",
    with_(f"{STATUS}, {INFO}", f"""SELECT false AS overall_passed,
      '{{"timestamp":"2024-01-31 00:00:00","checks":[{{"name":"orphan_status_rows","violation_count":'
      || (SELECT violation_count FROM ({ORPHANS}))
      || ',"passed":false}},{{"name":"negative_availability","violation_count":0,"passed":true}},'
      || '{{"name":"ingestion_before_last_reported","violation_count":' || (SELECT violation_count FROM ({EARLY}))
      || ',"passed":false}},{{"name":"duplicate_grain_keys","violation_count":0,"passed":true}}],'
      || '"overall_passed":false}}' AS summary"""),
)
def dq_summary(spark, sf):
    report = quality.dq_report(a.status(spark, sf), a.information(spark, sf))
    return quality.dq_summary(report, F.lit(a.AS_OF))


@query(
    "dq_exploratory",
    with_(f"{STATUS}, {INFO}", """SELECT name, violation_count, CASE WHEN violation_count = 0 THEN 'OK'
      WHEN name IN ('zero_capacity', 'orphan_ids') THEN 'NOTE' ELSE 'ANOMALY' END AS verdict FROM (
        SELECT 'negative_bikes' AS name, count(*) FILTER (WHERE num_bikes_available < 0) AS violation_count FROM status
        UNION ALL SELECT 'negative_docks', count(*) FILTER (WHERE num_docks_available < 0) FROM status
        UNION ALL SELECT 'future_reports', count(*) FILTER (WHERE last_reported > TIMESTAMP '2024-01-30 00:05:00') FROM status
        UNION ALL SELECT 'orphan_ids', count(DISTINCT station_id) FROM status
          WHERE station_id NOT IN (SELECT station_id FROM station_information)
        UNION ALL SELECT 'zero_capacity', count(*) FILTER (WHERE capacity = 0) FROM station_information)"""),
)
def dq_exploratory(spark, sf):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    out = quality.dq_exploratory(a.status(spark, sf), a.information(spark, sf), as_of)
    return out.withColumn("violation_count", F.col("violation_count").cast("long"))


NULL_FIELDS = ["station_id", "num_bikes_available", "num_docks_available", "last_reported"]


@query(
    "null_profile",
    with_(f"{STATUS}, {INFO}", " UNION ALL ".join(
        [f"SELECT '{c}' AS field, 'required' AS kind, count(*) FILTER (WHERE r.{c} IS NULL) AS null_count, 'OK' AS verdict "
         "FROM status r" for c in NULL_FIELDS]
        + ["""SELECT 'capacity', 'bonus', count(*) FILTER (WHERE i.station_id IS NULL),
              CASE WHEN count(*) FILTER (WHERE i.station_id IS NULL) = 0 THEN 'OK' ELSE 'WARNING' END
              FROM status r LEFT JOIN station_information i ON i.station_id = r.station_id""",
           "SELECT 'vehicle_types_available', 'missing', NULL, 'NOT FOUND'"])),
)
def null_profile(spark, sf):
    enriched = curate.station_status_enriched(a.status(spark, sf), a.information(spark, sf))
    return quality.null_profile(enriched, NULL_FIELDS, ["capacity", "vehicle_types_available"])


@query(
    "integrity_report",
    with_(f"{STATUS}, {INFO}", f"""SELECT 'status_rows' AS field, CAST(count(*) AS VARCHAR) AS value FROM status
      UNION ALL SELECT 'first_reported', strftime(min(last_reported), '%Y-%m-%d %H:%M:%S') FROM status
      UNION ALL SELECT 'last_reported', strftime(max(last_reported), '%Y-%m-%d %H:%M:%S') FROM status
      UNION ALL SELECT 'information_rows', CAST(count(*) AS VARCHAR) FROM station_information
      UNION ALL SELECT 'orphan_status_rows', CAST(violation_count AS VARCHAR) FROM ({ORPHANS})
      UNION ALL SELECT 'negative_availability', CAST(violation_count AS VARCHAR) FROM ({NEGATIVE})
      UNION ALL SELECT 'ingestion_before_last_reported', CAST(violation_count AS VARCHAR) FROM ({EARLY})
      UNION ALL SELECT 'duplicate_grain_keys', CAST(violation_count AS VARCHAR)
        FROM ({DUPLICATES.format(src='status')})"""),
)
def integrity_report(spark, sf):
    return quality.integrity_report(a.status(spark, sf), a.information(spark, sf))
