"""Registration of named queries with their oracle statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf: comparable(fn(spark, sf))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Wall-clock timestamps, plain integers and doubles with six places, as the oracles give them."""
    casts = {}
    for name, kind in df.dtypes:
        if kind == "timestamp":
            casts[name] = F.col(name).cast("timestamp_ntz")
        elif kind == "tinyint":
            casts[name] = F.col(name).cast("int")
        elif kind == "double":
            casts[name] = F.round(name, 6)
    return df.withColumns(casts) if casts else df
