"""Landed feed files into the fact and dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from tidedock.sources import feeds, writers


def ingest(
    spark: SparkSession, status_files: str, information_files: str, status_table: str, information_table: str,
    as_of: Column,
) -> dict[str, int]:
    """Append new status rows and upsert the dimension; returns both row counts."""
    order = ["source_file", "seq"]
    status = feeds.parse_station_status(feeds.read_documents(spark, status_files), as_of)
    information = feeds.parse_station_information(feeds.read_documents(spark, information_files))
    inserted = writers.append_status(status, status_table, order)
    ordered = information.withColumn("seq", _order(order)).drop("source_file")
    affected = writers.write_snapshot(ordered, information_table, as_of)
    return {"status_inserted": inserted, "information_upserted": affected}


def _order(columns: list[str]) -> Column:
    from pyspark.sql import functions as F

    return F.struct(*columns)
