"""Leakage-free features: lags, past-only rolling statistics, calendar fields and the lead target.

All windows share one partitioning and order, so the whole chain costs a single exchange and sort.
On the grid the rows of a station are bounded by time (see ``regularise``); other frames can be evaluated
in blocks. Lags count rows, so they cross gaps;
``max_gap`` nulls values that would reach further back than that.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions.timefns import calendar_fields, require_utc
from tidedock.operators.ordered import keyed_windows

LAGS = (1, 2, 3, 4)  # fixed values: 15 to 60 minutes
WINDOW = 4


def station_order(key: str = "station_id", time_col: str = "timestamp") -> WindowSpec:
    return W.partitionBy(key).orderBy(time_col)


def lag_columns(
    order: WindowSpec, value: str = "num_bikes_available", lags=LAGS, time_col: str = "timestamp",
    max_gap: str | None = None,
) -> dict[str, Column]:
    def lagged(n: int) -> Column:
        v = F.lag(value, n).over(order)
        if max_gap is None:
            return v
        close = F.lag(time_col, n).over(order) >= F.col(time_col) - F.expr(f"{n} * INTERVAL '{max_gap}'")
        return F.when(close, v)

    return {f"bikes_lag_{n}": lagged(n) for n in lags}


def past_columns(order: WindowSpec, value: str = "num_bikes_available", window: int = WINDOW) -> dict[str, Column]:
    """The previous ``window`` values, newest first, as helper columns of :func:`rolling_columns`."""
    return {f"_past_{n}": F.lag(value, n).over(order) for n in range(1, window + 1)}


def rolling_columns(window: int = WINDOW) -> dict[str, Column]:
    """Mean and sample deviation of the previous ``window`` rows; null until that many exist.

    Plain arithmetic over the lagged values instead of sliding aggregates, so it stays in generated code.
    """
    past = [F.col(f"_past_{n}") for n in range(window, 0, -1)]
    mean = reduce(add, past) / F.lit(float(window))
    squares = reduce(add, [(p - mean) * (p - mean) for p in past])
    return {
        "bikes_rolling_mean_1h": mean,
        "bikes_rolling_std_1h": F.sqrt(squares / F.lit(float(window - 1))),
    }


def target_column(order: WindowSpec, value: str = "num_bikes_available", horizon: int = 1) -> dict[str, Column]:
    return {schemas.TARGET_COL: F.lead(value, horizon).over(order)}


def add_lag_features(df: DataFrame, **options) -> DataFrame:
    return df.withColumns(lag_columns(station_order(), **options))


def add_rolling_features(df: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    past = past_columns(station_order(), window=window, **options)
    return df.withColumns(past).withColumns(rolling_columns(window)).drop(*past)


def add_temporal_features(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    if dict(df.dtypes)[time_col] == "timestamp":
        require_utc(df.sparkSession)
    return df.withColumns(calendar_fields(F.col(time_col)))


def add_station_features(df: DataFrame) -> DataFrame:
    return schemas.require_columns(df, schemas.STATIC_COLS)


def add_target(df: DataFrame, **options) -> DataFrame:
    return df.withColumns(target_column(station_order(), **options))


def build_features(
    df: DataFrame, horizon: int = 1, max_gap: str | None = None, block_rows: int | None = None
) -> DataFrame:
    """Feature table without nulls in any column, so stations unknown to the dimension drop out.

    ``block_rows`` evaluates the windows in blocks of that many rows, for frames that are not on a grid
    and in which one station may hold any share of the rows.
    """
    add_station_features(df)

    def windows(rows: DataFrame, order: WindowSpec) -> DataFrame:
        return rows.withColumns(
            {
                **lag_columns(order, max_gap=max_gap),
                **past_columns(order),
                **target_column(order, horizon=horizon),
            }
        )

    if block_rows is None:
        built = windows(df, station_order())
    else:
        reach = max(max(LAGS), WINDOW)
        built = keyed_windows(df, ["station_id"], ["timestamp"], reach, horizon, windows, block_rows)
    rolled = built.withColumns(rolling_columns()).drop(*[c for c in built.columns if c.startswith("_past_")])
    return add_temporal_features(rolled).na.drop("any")


def feature_frame(df: DataFrame) -> DataFrame:
    """Keys, the ordered features and the target."""
    return df.select("station_id", "timestamp", *schemas.FEATURE_COLS, schemas.TARGET_COL)


def hash_sample(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones on every run: the smallest MD5 digests of keys and seed."""
    text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return df.orderBy(F.md5(F.concat_ws("|", *text, F.lit(seed))), *keys).limit(n)
