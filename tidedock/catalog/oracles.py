"""DuckDB statements for the registered queries, written independently of the Spark plans.

The grid is built densely here, windows are plain windows, and distribution tests sort all values.
"""

from __future__ import annotations

STATUS = """status AS (
  SELECT CAST(user_id AS VARCHAR) AS station_id, ts AS last_reported,
    CAST(FLOOR(value) AS INTEGER) % 31 AS num_bikes_available,
    30 - CAST(FLOOR(value) AS INTEGER) % 31 AS num_docks_available,
    CAST(event_id % 3 AS INTEGER) AS num_bikes_disabled,
    CAST(event_id % 2 AS INTEGER) AS num_docks_disabled,
    event_type <> 'error' AS is_renting, event_type <> 'signup' AS is_returning,
    event_type AS status,
    CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 1 MINUTE ELSE ts + INTERVAL 1 MINUTE END
      AS ingestion_timestamp,
    event_id AS seq
  FROM events)"""

INFO = """station_information AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS station_id, s.s_name AS name,
    CAST(-23.5 - 0.001 * s.s_nationkey AS DOUBLE) AS lat,
    CAST(-46.6 - 0.001 * (s.s_suppkey % 50) AS DOUBLE) AS lon,
    CAST(30 + s.s_suppkey % 10 AS INTEGER) AS capacity,
    CAST(NULL AS VARCHAR) AS address, n.n_name AS group_name,
    TIMESTAMP '2024-01-31 00:00:00' AS updated_at
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey)"""

LATEST = """latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id
      ORDER BY last_reported DESC, ingestion_timestamp DESC) AS rn FROM status) WHERE rn = 1)"""

COUNTS = ["num_bikes_available", "num_docks_available", "num_bikes_disabled", "num_docks_disabled"]
FEATURES = [
    "num_bikes_available", "num_docks_available", "bikes_lag_1", "bikes_lag_2", "bikes_lag_3", "bikes_lag_4",
    "bikes_rolling_mean_1h", "bikes_rolling_std_1h", "hour", "weekday", "is_weekend", "month",
    "capacity", "lat", "lon",
]


def series_ctes(freq: str = "15 minutes") -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in COUNTS)
    fills = ", ".join(
        f"last_value(b.{c} IGNORE NULLS) OVER w AS {c}" for c in [*COUNTS, "is_renting", "is_returning"]
    )
    return f"""{STATUS}, {INFO}, bins AS (
  SELECT station_id, time_bucket(INTERVAL '{freq}', last_reported) AS "timestamp", {means},
    arg_max(is_renting, last_reported) AS is_renting, arg_max(is_returning, last_reported) AS is_returning
  FROM status GROUP BY 1, 2),
grid AS (
  SELECT station_id, unnest(generate_series(min("timestamp"), max("timestamp"), INTERVAL '{freq}')) AS "timestamp"
  FROM bins GROUP BY station_id),
filled AS (
  SELECT g.station_id, g."timestamp", {fills}
  FROM grid g LEFT JOIN bins b ON b.station_id = g.station_id AND b."timestamp" = g."timestamp"
  WINDOW w AS (PARTITION BY g.station_id ORDER BY g."timestamp" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
series AS (
  SELECT f.*, i.capacity, i.lat, i.lon FROM filled f
  LEFT JOIN station_information i ON i.station_id = f.station_id
  WHERE f.num_bikes_available IS NOT NULL)"""


def feature_ctes(freq: str = "15 minutes") -> str:
    lags = ", ".join(f"lag(num_bikes_available, {n}) OVER o AS bikes_lag_{n}" for n in (1, 2, 3, 4))
    return f"""{series_ctes(freq)}, built AS (
  SELECT station_id, "timestamp", num_bikes_available, num_docks_available, {lags},
    CASE WHEN count(num_bikes_available) OVER p = 4 THEN avg(num_bikes_available) OVER p END
      AS bikes_rolling_mean_1h,
    CASE WHEN count(num_bikes_available) OVER p = 4 THEN stddev_samp(num_bikes_available) OVER p END
      AS bikes_rolling_std_1h,
    CAST(hour("timestamp") AS INTEGER) AS hour, CAST((dayofweek("timestamp") + 6) % 7 AS INTEGER) AS weekday,
    CASE WHEN (dayofweek("timestamp") + 6) % 7 >= 5 THEN 1 ELSE 0 END AS is_weekend,
    CAST(month("timestamp") AS INTEGER) AS month, capacity, lat, lon,
    lead(num_bikes_available, 1) OVER o AS y
  FROM series
  WINDOW o AS (PARTITION BY station_id ORDER BY "timestamp"),
    p AS (PARTITION BY station_id ORDER BY "timestamp" ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)),
features AS (
  SELECT * FROM built WHERE bikes_lag_4 IS NOT NULL AND bikes_rolling_mean_1h IS NOT NULL
    AND bikes_rolling_std_1h IS NOT NULL AND y IS NOT NULL AND capacity IS NOT NULL)"""


def split_ctes() -> str:
    return f"""{feature_ctes()}, stamps AS (
  SELECT t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT "timestamp" AS t FROM features)),
ends AS (SELECT max(CAST(trunc(n * 0.8::DOUBLE) AS BIGINT)) AS e FROM stamps),
cuts AS (
  SELECT (SELECT t FROM stamps, ends WHERE i = e) AS test_from,
    (SELECT t FROM stamps, ends WHERE i = CAST(trunc(e * 0.9::DOUBLE) AS BIGINT)) AS val_from),
splits AS (
  SELECT f.*, CASE WHEN "timestamp" >= test_from THEN 'test' WHEN "timestamp" >= val_from THEN 'val'
    ELSE 'train' END AS split FROM features f, cuts)"""


PREDICTIONS = """predictions AS (
  SELECT station_id, "timestamp" + INTERVAL 15 MINUTE AS target_time, 'naive' AS model_name,
    bikes_lag_1 AS predicted_value, y AS actual_value, "timestamp" FROM features
  UNION ALL
  SELECT station_id, "timestamp" + INTERVAL 15 MINUTE, 'mean', bikes_rolling_mean_1h, y, "timestamp"
  FROM features)"""


def metrics(actual: str, predicted: str) -> str:
    e = f"({actual} - {predicted})"
    return (
        f"avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse, "
        f"CASE WHEN count(*) < 2 THEN NULL WHEN var_pop({actual}) = 0 THEN "
        f"CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END "
        f"ELSE 1 - sum({e} * {e}) / (count(*) * var_pop({actual})) END AS r2"
    )


def drift_ctes(group: str, long: str, n_bins: int = 10) -> str:
    """``drift`` with psi, ks_statistic and ks_p_value per group of ``long`` (group, value, ref, cur)."""
    return f"""long AS ({long}),
lim AS (SELECT {group}, min(value) AS lo, max(value) AS hi, sum(ref) AS nr, sum(cur) AS nc
  FROM long GROUP BY 1),
binned AS (
  SELECT l.{group}, len([i FOR i IN range(1, {n_bins}) IF value >= lo + i * ((hi - lo) / {n_bins}.0)]) AS bin,
    ref, cur FROM long l JOIN lim USING ({group})),
bin_counts AS (SELECT {group}, bin, sum(ref) AS r, sum(cur) AS c FROM binned GROUP BY 1, 2),
psi AS (
  SELECT {group}, sum((c / nc + 1e-4::DOUBLE - (r / nr + 1e-4::DOUBLE))
    * ln((c / nc + 1e-4::DOUBLE) / (r / nr + 1e-4::DOUBLE))) AS psi
  FROM bin_counts JOIN lim USING ({group}) GROUP BY 1),
cdf AS (
  SELECT {group}, value, sum(sum(ref)) OVER (PARTITION BY {group} ORDER BY value) AS r,
    sum(sum(cur)) OVER (PARTITION BY {group} ORDER BY value) AS c
  FROM long GROUP BY 1, 2),
ks AS (SELECT {group}, max(abs(r / nr - c / nc)) AS ks_statistic FROM cdf JOIN lim USING ({group}) GROUP BY 1),
lam AS (
  SELECT {group}, ks_statistic, (sqrt(nr * nc / (nr + nc)) + 0.12 + 0.11 / sqrt(nr * nc / (nr + nc)))
    * ks_statistic AS l FROM ks JOIN lim USING ({group})),
pval AS (
  SELECT {group}, CASE WHEN max(l) < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
    sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * l * l)))) END AS ks_p_value
  FROM lam, range(1, 101) s(k) GROUP BY 1),
drift AS (
  SELECT p.{group}, psi, ks_statistic, ks_p_value FROM psi p JOIN ks USING ({group}) JOIN pval USING ({group}))"""


def feature_long(reference: str = "split = 'train'", current: str = "split = 'test'") -> str:
    rolled = ("bikes_rolling_mean_1h", "bikes_rolling_std_1h")
    cols = ", ".join(f"round({c}, 9) AS {c}" if c in rolled else f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
    return f"""SELECT feature, value, CASE WHEN side THEN 1.0 ELSE 0.0 END AS ref,
    CASE WHEN side THEN 0.0 ELSE 1.0 END AS cur
  FROM (SELECT {reference} AS side, {cols} FROM splits WHERE {reference} OR {current})
  UNPIVOT (value FOR feature IN ({', '.join(FEATURES)}))"""


STUCK = """moves AS (
  SELECT *, lag(num_bikes_available) OVER (PARTITION BY station_id ORDER BY "timestamp") AS prev FROM {src}),
stuck_all AS (
  SELECT station_id, max("timestamp") FILTER (WHERE num_bikes_available <> prev) AS last_change,
    epoch(max("timestamp") - coalesce(max("timestamp") FILTER (WHERE num_bikes_available <> prev),
      min("timestamp"))) / 3600.0 AS duration_hours,
    CAST(trunc(arg_max(num_bikes_available, "timestamp")) AS INTEGER) AS last_bikes,
    arg_max(is_renting, "timestamp") AS is_renting
  FROM moves GROUP BY station_id)"""


def rounded(body: str, doubles: list[str]) -> str:
    """Both sides round doubles to six places; adding 0 removes the sign of a negative zero."""
    if not doubles:
        return body
    wrapped = ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({wrapped}) FROM ({body})"


def with_(ctes: str, body: str, doubles: list[str] = ()) -> str:
    return f"WITH {ctes} {rounded(body, list(doubles))}"
