"""Queries: grid, features, splits and exploratory aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.catalog import adapters as a
from tidedock.catalog.oracles import (
    COUNTS, FEATURES, LATEST, STATUS, feature_ctes, series_ctes, split_ctes, with_,
)
from tidedock.catalog.registry import query
from tidedock.operators import aggregates, features, regularise, split
from tidedock.operators.drift import split_sides
from tidedock.sources import tables

PLACE = ["lat", "lon"]
SERIES_COLS = "station_id, \"timestamp\", " + ", ".join(COUNTS) + ", is_renting, is_returning, capacity, lat, lon"
FEATURE_DOUBLES = [c for c in FEATURES if c not in ("hour", "weekday", "is_weekend", "month", "capacity")] + ["y"]


def _resample(freq):
    def run(spark, sf):
        return a.series(spark, sf, freq)

    return run


for _name, _freq in (("resample_15min", "15 minutes"), ("resample_6h", "6 hours")):
    query(_name, with_(series_ctes(_freq), f"SELECT {SERIES_COLS} FROM series", [*COUNTS, *PLACE]))(_resample(_freq))


@query(
    "resample_min_days",
    with_(series_ctes(), """SELECT station_id, count(*) AS n, sum(num_bikes_available) AS total FROM series
      WHERE station_id IN (SELECT station_id FROM status GROUP BY 1
        HAVING floor(epoch(max(last_reported) - min(last_reported)) / 86400) >= 29) GROUP BY 1""", ["total"]),
)
def resample_min_days(spark, sf):
    rows = regularise.resample(a.status(spark, sf), min_days=29, lasts=[])
    return rows.groupBy("station_id").agg(F.count("*").alias("n"), F.sum("num_bikes_available").alias("total"))


@query(
    "ffill_limited",
    with_(series_ctes(), f"""SELECT station_id, "timestamp", {', '.join(COUNTS)} FROM filled
      WHERE num_bikes_available IS NOT NULL""", COUNTS),
)
def ffill_limited(spark, sf):
    bins = regularise.bin_status(a.status(spark, sf), lasts=[]).drop("first_seen", "last_seen")
    grid = regularise.dense_grid(bins)
    return regularise.ffill_limited(grid, COUNTS).na.drop(subset=COUNTS)


KEY = 'station_id, "timestamp"'
LAGS = ", ".join(f"bikes_lag_{n}" for n in (1, 2, 3, 4))


@query("lag_features", with_(feature_ctes(), f"SELECT {KEY}, {LAGS} FROM built", LAGS.split(", ")))
def lag_features(spark, sf):
    out = features.add_lag_features(a.series(spark, sf))
    return out.select("station_id", "timestamp", *LAGS.split(", "))


@query(
    "lag_features_max_gap",
    with_(series_ctes(), f"""SELECT {KEY}, CASE WHEN lag("timestamp") OVER o >= "timestamp" - INTERVAL 15 MINUTE
      THEN lag(num_bikes_available) OVER o END AS bikes_lag_1 FROM series
      WINDOW o AS (PARTITION BY station_id ORDER BY "timestamp")""", ["bikes_lag_1"]),
)
def lag_features_max_gap(spark, sf):
    out = features.add_lag_features(a.series(spark, sf), lags=(1,), max_gap="15 minutes")
    return out.select("station_id", "timestamp", "bikes_lag_1")


ROLLING = ["bikes_rolling_mean_1h", "bikes_rolling_std_1h"]


@query("rolling_features", with_(feature_ctes(), f"SELECT {KEY}, {', '.join(ROLLING)} FROM built", ROLLING))
def rolling_features(spark, sf):
    return features.add_rolling_features(a.series(spark, sf)).select("station_id", "timestamp", *ROLLING)


@query("add_target", with_(feature_ctes(), f"SELECT {KEY}, y FROM built", ["y"]))
def add_target(spark, sf):
    return features.add_target(a.series(spark, sf)).select("station_id", "timestamp", "y")


@query("temporal_features", with_(feature_ctes(), f"SELECT {KEY}, hour, weekday, is_weekend, month FROM built"))
def temporal_features(spark, sf):
    out = features.add_temporal_features(a.series(spark, sf))
    return out.select("station_id", "timestamp", "hour", "weekday", "is_weekend", "month")


def _features(freq):
    def run(spark, sf):
        return a.features(spark, sf, freq)

    return run


for _name, _freq in (("build_features", "15 minutes"), ("build_features_6h", "6 hours")):
    query(
        _name, with_(feature_ctes(_freq), f"SELECT {KEY}, {', '.join(FEATURES)}, y FROM features", FEATURE_DOUBLES)
    )(_features(_freq))


# -- split ---------------------------------------------------------------------------------------


@query("time_based_split", with_(split_ctes(), f"SELECT {KEY}, y, split FROM splits", ["y"]))
def time_based_split(spark, sf):
    return a.splits(spark, sf).select("station_id", "timestamp", "y", "split")


@query(
    "split_cuts",
    with_(split_ctes(), "SELECT val_from, test_from, (SELECT count(*) FROM stamps) AS n_timestamps FROM cuts"),
)
def split_cuts(spark, sf):
    return split.split_cuts(a.features(spark, sf))


@query(
    "load_splits",
    with_(split_ctes(), f"SELECT {KEY}, num_bikes_available, hour, y, split FROM splits", ["num_bikes_available", "y"]),
)
def load_splits(spark, sf):
    rows = a.splits(spark, sf)
    parts = [rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")]
    return tables.union_splits(*parts).select("station_id", "timestamp", "num_bikes_available", "hour", "y", "split")


@query("split_counts", with_(split_ctes(), "SELECT split, count(*) AS n_rows FROM splits GROUP BY 1"))
def split_counts(spark, sf):
    return a.splits(spark, sf).groupBy("split").agg(F.count("*").alias("n_rows"))


@query(
    "split_summary",
    with_(split_ctes(), """SELECT split, count(*) AS n_rows, min("timestamp") AS first_timestamp,
      max("timestamp") AS last_timestamp, count(DISTINCT station_id) AS n_stations FROM splits GROUP BY 1"""),
)
def split_summary(spark, sf):
    return split.split_summary(a.splits(spark, sf))


@query(
    "rows_per_interval",
    with_(split_ctes(), 'SELECT split, "timestamp", count(*) AS n_rows FROM splits GROUP BY 1, 2'),
)
def rows_per_interval(spark, sf):
    return split.rows_per_interval(a.splits(spark, sf))


@query(
    "leakage_report",
    with_(
        f"""{split_ctes()}, checked AS (SELECT s.*, b.bikes_lag_1 AS e1, b.bikes_lag_2 AS e2, b.bikes_lag_3 AS e3,
          b.bikes_lag_4 AS e4, b.y AS ey FROM splits s JOIN built b ON b.station_id = s.station_id
          AND b."timestamp" = s."timestamp")""",
        """SELECT "check", violations, violations = 0 AS passed FROM (
      SELECT 'bikes_lag_1' AS "check", count(*) FILTER (WHERE bikes_lag_1 IS DISTINCT FROM e1) AS violations FROM checked
      UNION ALL SELECT 'bikes_lag_2', count(*) FILTER (WHERE bikes_lag_2 IS DISTINCT FROM e2) FROM checked
      UNION ALL SELECT 'bikes_lag_3', count(*) FILTER (WHERE bikes_lag_3 IS DISTINCT FROM e3) FROM checked
      UNION ALL SELECT 'bikes_lag_4', count(*) FILTER (WHERE bikes_lag_4 IS DISTINCT FROM e4) FROM checked
      UNION ALL SELECT 'target', count(*) FILTER (WHERE y IS DISTINCT FROM ey) FROM checked
      UNION ALL SELECT 'nulls', count(*) FILTER (WHERE y IS NULL OR lat IS NULL OR bikes_rolling_std_1h IS NULL) FROM checked
      UNION ALL SELECT 'train_val_overlap', CAST(max("timestamp") FILTER (WHERE split = 'train')
        >= min("timestamp") FILTER (WHERE split = 'val') AS BIGINT) FROM checked
      UNION ALL SELECT 'val_test_overlap', CAST(max("timestamp") FILTER (WHERE split = 'val')
        >= min("timestamp") FILTER (WHERE split = 'test') AS BIGINT) FROM checked)"""),
)
def leakage_report(spark, sf):
    return split.leakage_report(a.splits(spark, sf), a.series(spark, sf))


# -- aggregations --------------------------------------------------------------------------------

HOURLY = """hourly AS (SELECT hour, is_weekend, avg(num_bikes_available) AS avg_bikes,
  CASE is_weekend WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Weekend' END AS day_type FROM features GROUP BY 1, 2)"""
SUMMARY = """SELECT *, round_even(avg_bikes / capacity * 100, 1) AS fill_pct FROM (
  SELECT station_id, avg(num_bikes_available) AS avg_bikes, min(num_bikes_available) AS min_bikes,
    max(num_bikes_available) AS max_bikes, arg_min(lat, "timestamp") AS lat, arg_min(lon, "timestamp") AS lon,
    arg_min(capacity, "timestamp") AS capacity FROM {src} GROUP BY 1)"""
SUMMARY_DOUBLES = ["avg_bikes", "min_bikes", "max_bikes", *PLACE, "fill_pct"]


@query("hourly_availability", with_(f"{feature_ctes()}, {HOURLY}", "SELECT * FROM hourly", ["avg_bikes"]))
def hourly_availability(spark, sf):
    return aggregates.hourly_availability(a.features(spark, sf))


@query("station_summary", with_(feature_ctes(), SUMMARY.format(src="features"), SUMMARY_DOUBLES))
def station_summary(spark, sf):
    return aggregates.station_summary(a.features(spark, sf))


@query(
    "station_summary_at_hour",
    with_(feature_ctes(), SUMMARY.format(src="(SELECT * FROM features WHERE hour = 12)"), SUMMARY_DOUBLES),
)
def station_summary_at_hour(spark, sf):
    return aggregates.station_summary_at_hour(a.features(spark, sf), 12)


HEAT = [f"h{h:02d}" for h in range(24)]


@query(
    "weekday_hour_heatmap",
    with_(feature_ctes(), "SELECT weekday, " + ", ".join(
        f"coalesce(avg(num_bikes_available) FILTER (WHERE hour = {h}), 0.0) AS h{h:02d}" for h in range(24)
    ) + " FROM features GROUP BY 1", HEAT),
)
def weekday_hour_heatmap(spark, sf):
    return aggregates.weekday_hour_heatmap(a.features(spark, sf))


@query(
    "peak_hour_kpis",
    with_(f"{feature_ctes()}, {HOURLY}", """SELECT
      (SELECT avg(avg_bikes) FROM hourly WHERE day_type = 'Weekday') AS weekday_avg,
      (SELECT avg(avg_bikes) FROM hourly WHERE day_type = 'Weekend') AS weekend_avg,
      lpad(CAST(lo.hour AS VARCHAR), 2, '0') || ':00' AS busiest_hour, lo.avg_bikes AS busiest_avg_bikes,
      lpad(CAST(hi.hour AS VARCHAR), 2, '0') || ':00' AS quietest_hour, hi.avg_bikes AS quietest_avg_bikes
      FROM (SELECT * FROM hourly ORDER BY avg_bikes, hour, is_weekend LIMIT 1) lo,
        (SELECT * FROM hourly ORDER BY avg_bikes DESC, hour, is_weekend LIMIT 1) hi""",
        ["weekday_avg", "weekend_avg", "busiest_avg_bikes", "quietest_avg_bikes"]),
)
def peak_hour_kpis(spark, sf):
    return aggregates.peak_hour_kpis(a.features(spark, sf))


@query(
    "fleet_kpis_at_hour",
    with_(feature_ctes(), f"""SELECT avg(lat) AS center_lat, avg(lon) AS center_lon, count(*) AS n_stations,
      avg(avg_bikes) AS avg_bikes_per_station, avg(fill_pct) AS avg_fill_pct
      FROM ({SUMMARY.format(src='(SELECT * FROM features WHERE hour = 12)')})""",
        ["center_lat", "center_lon", "avg_bikes_per_station", "avg_fill_pct"]),
)
def fleet_kpis_at_hour(spark, sf):
    return aggregates.fleet_kpis_at_hour(a.features(spark, sf), 12)


RANGE = "CAST(\"timestamp\" AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"


@query(
    "availability_timeline",
    with_(feature_ctes(), f"SELECT {KEY}, num_bikes_available FROM features WHERE {RANGE}", ["num_bikes_available"]),
)
def availability_timeline(spark, sf):
    return aggregates.availability_timeline(a.features(spark, sf), "2024-01-10", "2024-01-12")


@query(
    "station_means_in_range",
    with_(feature_ctes(), f"""SELECT station_id, avg(num_bikes_available) AS avg_bikes FROM features
      WHERE {RANGE} GROUP BY 1""", ["avg_bikes"]),
)
def station_means_in_range(spark, sf):
    return aggregates.station_means_in_range(a.features(spark, sf), "2024-01-10", "2024-01-12")


@query(
    "snapshot_totals",
    with_(f"{STATUS}, {LATEST}", """SELECT count(*) AS total_stations, count(*) FILTER (WHERE is_renting) AS renting,
      count(*) FILTER (WHERE is_returning) AS returning, count(*) FILTER (WHERE NOT is_renting) AS not_renting,
      CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes, CAST(sum(num_docks_available) AS BIGINT) AS total_docks,
      sum(num_bikes_available) / CAST(sum(num_bikes_available + num_docks_available) AS DOUBLE) * 100 AS occupancy_pct
      FROM latest""", ["occupancy_pct"]),
)
def snapshot_totals(spark, sf):
    from tidedock.operators.curate import latest_rows

    return aggregates.snapshot_totals(latest_rows(a.status(spark, sf)))


def _histogram(src: str, value: str, n_bins: int, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM {src})" if by else "(SELECT 1)"
    match = f"AND c.{by} = g.{by}" if by else ""
    return f"""SELECT {f'g.{by}, ' if by else ''}CAST(b AS INTEGER) AS bin, lo + b * w AS bin_low, lo + (b + 1) * w AS bin_high,
      coalesce(c.n, 0) AS n FROM {groups} g, range(0, {n_bins}) s(b),
      (SELECT min({value}) AS lo, (max({value}) - min({value})) / {n_bins}.0 AS w FROM {src}) l
      LEFT JOIN (SELECT {keys}len([i FOR i IN range(1, {n_bins}) IF {value} >= lo + i * w]) AS bin, count(*) AS n
        FROM {src}, (SELECT min({value}) AS lo, (max({value}) - min({value})) / {n_bins}.0 AS w FROM {src})
        GROUP BY ALL) c ON c.bin = b {match}"""


EDGES = ["bin_low", "bin_high"]


@query("histogram", with_(feature_ctes(), _histogram("features", "y", 50), EDGES))
def histogram(spark, sf):
    return aggregates.histogram(a.features(spark, sf), "y", 50)


@query("histogram_by_group", with_(split_ctes(), _histogram("splits", "bikes_rolling_mean_1h", 50, "split"), EDGES))
def histogram_by_group(spark, sf):
    return aggregates.histogram(a.splits(spark, sf), "bikes_rolling_mean_1h", 50, "split")


@query(
    "residual_histogram",
    with_(f"{split_ctes()}, res AS (SELECT y - bikes_lag_1 AS residual FROM splits WHERE split = 'test')",
          _histogram("res", "residual", 60), EDGES),
)
def residual_histogram(spark, sf):
    from tidedock.operators.metrics import residuals

    return aggregates.histogram(residuals(a.test_split(spark, sf), "y", "bikes_lag_1"), "residual", 60)


def _corr(x: str, y: str) -> str:
    x, y = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    return (
        f"CASE WHEN stddev_pop({x}) > 1e-12 AND stddev_pop({y}) > 1e-12 THEN "
        f"covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END"
    )


_ALL = [*FEATURES, "y"]


@query(
    "feature_correlation",
    with_(feature_ctes() + ", f AS MATERIALIZED (SELECT * FROM features)", " UNION ALL ".join(
        f"SELECT '{x}' AS column_a, '{y}' AS column_b, {_corr(x, y)} AS correlation FROM f"
        for i, x in enumerate(_ALL) for y in _ALL[i + 1:]
    ), ["correlation"]),
)
def feature_correlation(spark, sf):
    return aggregates.correlation_matrix(a.staged_features(spark, sf))


@query(
    "target_correlation",
    with_(feature_ctes(), " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {_corr(x, 'y')} AS correlation FROM features" for x in FEATURES
    ), ["correlation"]),
)
def target_correlation(spark, sf):
    return aggregates.target_correlation(a.staged_features(spark, sf))


_STATS = {
    "count": "CAST(count(v) AS DOUBLE)",
    "mean": "avg(v)", "std": "stddev_samp(v)", "min": "min(v)", "q25": "quantile_cont(v, 0.25)",
    "median": "quantile_cont(v, 0.5)", "q75": "quantile_cont(v, 0.75)", "max": "max(v)",
}


@query(
    "feature_summary_delta",
    with_(split_ctes() + ", v AS (SELECT feature, split, value AS v FROM (SELECT split, "
          + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
          + f" FROM splits WHERE split <> 'val') UNPIVOT (value FOR feature IN ({', '.join(FEATURES)})))",
          "SELECT r.feature, r.metric, r.x AS reference, c.x AS current, c.x - r.x AS delta FROM ("
          + " UNION ALL ".join(f"SELECT feature, '{m}' AS metric, {e} AS x FROM v WHERE split = 'train' GROUP BY 1"
                               for m, e in _STATS.items()) + ") r JOIN ("
          + " UNION ALL ".join(f"SELECT feature, '{m}' AS metric, {e} AS x FROM v WHERE split = 'test' GROUP BY 1"
                               for m, e in _STATS.items()) + ") c ON r.feature = c.feature AND r.metric = c.metric",
          ["reference", "current", "delta"]),
)
def feature_summary_delta(spark, sf):
    return aggregates.summary_delta(split_sides(a.splits(spark, sf), schemas.FEATURE_COLS))


@query(
    "hash_sample",
    with_(feature_ctes(), f"""SELECT {KEY}, {', '.join(FEATURES)}, y FROM features
      ORDER BY md5(concat_ws('|', station_id, CAST("timestamp" AS VARCHAR), '42')), station_id, "timestamp" LIMIT 5000""",
          FEATURE_DOUBLES),
)
def hash_sample(spark, sf):
    return features.hash_sample(a.features(spark, sf), 5000, ["station_id", "timestamp"])
