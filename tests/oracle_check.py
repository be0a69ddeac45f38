"""Compare registered queries with their DuckDB statements; also runnable as a script."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.01"


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(name: str, spark: SparkSession, con, sf: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, sf)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return bool(got[1]), f"{len(got[1])} rows, no oracle"
    cursor = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return False, f"rows {len(got[1])} != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got[1])} rows differ, columns {got[0]}, e.g. {bad[0]}"
    odd = {c: k for c, k in kinds.items() if k in ("HUGEINT",) or k.startswith("DECIMAL")}
    if odd:
        return False, f"oracle types {odd}"
    if not got[1]:
        return False, "no rows"
    return True, f"{len(got[1])} rows"


if __name__ == "__main__":
    names = sys.argv[1:] or list(entry.queries())
    spark, con = session(), duck(SF)
    failed = []
    for name in names:
        start = time.time()
        try:
            ok, note = compare(name, spark, con, SF)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")
