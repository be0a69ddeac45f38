"""Data-quality counters and reports.

Row-level counters need one scan: violations are counted per station with map-side combine, so a
station that holds a third of the facts leaves each task as one row, and only these small rows meet
the dimension.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedock import schemas

# Check names in report order.
CHECKS = [
    "orphan_status_rows",
    "negative_availability",
    "ingestion_before_last_reported",
    "duplicate_grain_keys",
]


def negative_counts() -> Column:
    return reduce(lambda a, b: a | b, [F.col(c) < 0 for c in schemas.COUNT_COLS])


def ingested_before_report() -> Column:
    return F.col("ingestion_timestamp") < F.col("last_reported")


def _per_station(status: DataFrame) -> DataFrame:
    return status.groupBy("station_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(negative_counts()).alias("negative"),
        F.count_if(ingested_before_report()).alias("early"),
        F.min("last_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
    )


def orphan_rows(status: DataFrame, information: DataFrame) -> DataFrame:
    per_station = status.groupBy("station_id").agg(F.count("*").alias("n"))
    return per_station.join(information.select("station_id"), "station_id", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("violation_count")
    )


def negative_rows(status: DataFrame) -> DataFrame:
    return status.agg(F.count_if(negative_counts()).alias("violation_count"))


def early_ingestion_rows(status: DataFrame) -> DataFrame:
    return status.agg(F.count_if(ingested_before_report()).alias("violation_count"))


def duplicate_keys(df: DataFrame, keys: list[str] = schemas.STATUS_GRAIN) -> DataFrame:
    """Number of keys (not rows) that occur more than once."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("violation_count"))
    )


def _row_counters(status: DataFrame, information: DataFrame) -> DataFrame:
    known = information.select("station_id", F.lit(True).alias("_known"))
    per_station = _per_station(status).join(known, "station_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_station.agg(
        total(F.when(F.col("_known").isNull(), F.col("n_rows")).otherwise(0)).alias("orphans"),
        total(F.col("negative")).alias("negative"),
        total(F.col("early")).alias("early"),
        total(F.col("n_rows")).alias("n_rows"),
        F.min("first_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
    )


def dq_report(status: DataFrame, information: DataFrame) -> DataFrame:
    """One row per check in stable order: two passes over the facts for all four."""
    counters = _row_counters(status, information).select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("ordinal"), F.lit(CHECKS[0]).alias("name"), F.col("orphans").alias("n")),
                F.struct(F.lit(2).alias("ordinal"), F.lit(CHECKS[1]).alias("name"), F.col("negative").alias("n")),
                F.struct(F.lit(3).alias("ordinal"), F.lit(CHECKS[2]).alias("name"), F.col("early").alias("n")),
            )
        ).alias("c")
    ).select("c.ordinal", "c.name", F.col("c.n").alias("violation_count"))
    duplicates = duplicate_keys(status).select(
        F.lit(4).alias("ordinal"), F.lit(CHECKS[3]).alias("name"), "violation_count"
    )
    return counters.unionByName(duplicates).withColumn("passed", F.col("violation_count") == 0)


def dq_summary(report: DataFrame, as_of: Column) -> DataFrame:
    """The report as one JSON object with the overall verdict."""
    checks = F.transform(
        F.array_sort(F.collect_list(F.struct("ordinal", "name", "violation_count", "passed"))),
        lambda c: F.struct(c["name"].alias("name"), c["violation_count"].alias("violation_count"),
                           c["passed"].alias("passed")),
    )
    summary = report.agg(checks.alias("checks"), F.bool_and("passed").alias("overall_passed"))
    return summary.select(
        F.to_json(F.struct(as_of.alias("timestamp"), "checks", "overall_passed")).alias("summary"),
        "overall_passed",
    )


def null_profile(df: DataFrame, required: list[str], bonus: list[str] = ()) -> DataFrame:
    """Null (or NaN) count per field; fields the table does not have are reported as missing."""
    fields = [(c, "required") for c in required] + [(c, "bonus") for c in bonus]
    types = dict(df.dtypes)

    def is_null(name: str) -> Column:
        if types[name] in ("double", "float"):
            return F.col(name).isNull() | F.isnan(F.col(name))
        return F.col(name).isNull()

    present = [c for c, _ in fields if c in types]
    counted = df.agg(*[F.count_if(is_null(c)).alias(c) for c in present])
    entries = [
        F.struct(
            F.lit(c).alias("field"),
            F.lit(kind if c in types else "missing").alias("kind"),
            (F.col(c) if c in types else F.lit(None).cast("long")).alias("null_count"),
        )
        for c, kind in fields
    ]
    rows = counted.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    verdict = (
        F.when(F.col("kind") == "missing", "NOT FOUND").when(F.col("null_count") == 0, "OK").otherwise("WARNING")
    )
    return rows.withColumn("verdict", verdict)


def dq_exploratory(status: DataFrame, information: DataFrame, as_of: Column, tolerance: str = "5 minutes") -> DataFrame:
    """Negative counts, reports from the future, zero capacities and orphan ids with verdicts."""
    future = F.col("last_reported") > as_of + F.expr(f"INTERVAL '{tolerance}'")
    per_station = status.groupBy("station_id").agg(
        F.count_if(F.col("num_bikes_available") < 0).alias("neg_bikes"),
        F.count_if(F.col("num_docks_available") < 0).alias("neg_docks"),
        F.count_if(future).alias("future"),
    )
    known = information.select("station_id", F.lit(True).alias("_known"))
    facts = (
        per_station.join(known, "station_id", "left")
        .agg(
            F.sum("neg_bikes").alias("negative_bikes"),
            F.sum("neg_docks").alias("negative_docks"),
            F.sum("future").alias("future_reports"),
            F.count_if(F.col("_known").isNull()).alias("orphan_ids"),
        )
        .select(F.expr("stack(4, 'negative_bikes', negative_bikes, 'negative_docks', negative_docks,"
                       " 'future_reports', future_reports, 'orphan_ids', orphan_ids) AS (name, violation_count)"))
    )
    zero = information.agg(F.count_if(F.col("capacity") == 0).alias("violation_count")).select(
        F.lit("zero_capacity").alias("name"), "violation_count"
    )
    rows = facts.unionByName(zero)
    note = F.col("name").isin("zero_capacity", "orphan_ids")
    verdict = F.when(F.col("violation_count") == 0, "OK").when(note, "NOTE").otherwise("ANOMALY")
    return rows.withColumn("verdict", verdict)


def integrity_report(status: DataFrame, information: DataFrame) -> DataFrame:
    """Row counts, covered time span and all counters in one row-per-field report."""
    counters = _row_counters(status, information)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    facts = counters.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("field"), value.alias("value"))
                    for name, value in [
                        ("status_rows", F.col("n_rows").cast("string")),
                        ("first_reported", text("first_reported")),
                        ("last_reported", text("last_reported")),
                        (CHECKS[0], F.col("orphans").cast("string")),
                        (CHECKS[1], F.col("negative").cast("string")),
                        (CHECKS[2], F.col("early").cast("string")),
                    ]
                ]
            )
        ).alias("e")
    ).select("e.*")
    dimension = information.agg(F.count("*").cast("string").alias("value")).select(
        F.lit("information_rows").alias("field"), "value"
    )
    duplicates = duplicate_keys(status).select(
        F.lit(CHECKS[3]).alias("field"), F.col("violation_count").cast("string").alias("value")
    )
    return facts.unionByName(dimension).unionByName(duplicates)
