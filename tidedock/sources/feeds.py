"""Feed documents: landed JSON envelopes to typed records.

Every parser works on a DataFrame with one JSON document per row, so the same code serves files
in a landing folder, a stream of files and documents that are already a text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions.timefns import epoch_to_timestamp


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed file, text in ``document``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("document"), F.col("_metadata.file_path").alias("source_file")
    )


def _as_int(text: Column) -> Column:
    """Whole numbers as they are, decimals cut towards zero, anything else null."""
    return F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"))


def _as_flag(text: Column) -> Column:
    return F.when(F.lower(text).isin("true", "1"), True).when(F.lower(text).isin("false", "0"), False)


def _records(documents: DataFrame, envelope, member: str, column: str) -> DataFrame:
    parsed = F.from_json(F.col(column), envelope)
    carried = [c for c in documents.columns if c != column]
    return documents.select(*carried, parsed.alias("_envelope")).select(
        *carried, F.col(f"_envelope.data.{member}").alias("_members")
    )


def explode_members(
    documents: DataFrame, envelope, member: str = "stations", column: str = "document", strict: bool = False
) -> DataFrame:
    """One row per array element as ``record``, with its position as ``seq``.

    A document without the array yields a single row with a null ``record`` (and ``seq`` -1), or
    fails the job when ``strict``.
    """
    rows = _records(documents, envelope, member, column)
    members = F.col("_members")
    if strict:
        members = F.when(members.isNull(), F.raise_error(F.lit(f"document without data.{member}"))).otherwise(
            members
        )
    rows = rows.withColumn("_members", members)
    carried = [c for c in rows.columns if c != "_members"]
    return rows.select(*carried, "_members", F.posexplode_outer("_members").alias("seq", "record")).select(
        *carried,
        F.when(F.col("_members").isNull(), -1).otherwise(F.col("seq")).alias("seq"),
        "record",
        F.col("_members").isNull().alias("bad_envelope"),
    ).where(F.col("bad_envelope") | F.col("record").isNotNull())


def missing_fields(required: list[str], record: str = "record") -> Column:
    """Names of required fields that are absent or null."""
    return F.filter(
        F.array(*[F.when(F.col(f"{record}.{c}").isNull(), F.lit(c)) for c in required]),
        lambda name: name.isNotNull(),
    )


def _typed_status() -> dict[str, Column]:
    r = lambda name: F.col(f"record.{name}")
    return {
        "station_id": r("station_id"),
        "num_bikes_available": _as_int(r("num_bikes_available")),
        "num_docks_available": _as_int(r("num_docks_available")),
        "num_bikes_disabled": _as_int(F.coalesce(r("num_bikes_disabled"), F.lit("0"))),
        "num_docks_disabled": _as_int(F.coalesce(r("num_docks_disabled"), F.lit("0"))),
        "last_reported": epoch_to_timestamp(r("last_reported").try_cast("decimal(20,6)")),
        "is_renting": _as_flag(r("is_renting")),
        "is_returning": _as_flag(r("is_returning")),
        "status": r("status"),
    }


def _typed_information() -> dict[str, Column]:
    r = lambda name: F.col(f"record.{name}")
    return {
        "station_id": r("station_id"),
        "name": r("name"),
        "lat": r("lat").try_cast("double"),
        "lon": r("lon").try_cast("double"),
        "capacity": _as_int(r("capacity")),
        "address": r("address"),
        "groups": F.coalesce(r("groups"), F.array().cast("array<string>")),
    }


def _carried(exploded: DataFrame) -> list[str]:
    return [c for c in exploded.columns if c not in ("record", "bad_envelope")]


def _checked(exploded: DataFrame, required: list[str], typed: dict[str, Column], nullable: set[str]) -> DataFrame:
    """Typed columns plus ``reject_reason``: null for good records, else what was wrong."""
    rows = exploded.select(
        *_carried(exploded),
        "bad_envelope",
        F.col("record.station_id").alias("raw_station_id"),
        missing_fields(required).alias("_missing"),
        *[c.alias(n) for n, c in typed.items()],
    )
    uncast = F.filter(
        F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in typed if n not in nullable]),
        lambda name: name.isNotNull(),
    )
    reason = (
        F.when(F.col("bad_envelope"), F.lit("envelope"))
        .when(F.size("_missing") > 0, F.concat(F.lit("missing: "), F.concat_ws(",", "_missing")))
        .when(F.size(uncast) > 0, F.concat(F.lit("malformed: "), F.concat_ws(",", uncast)))
    )
    return rows.withColumn("reject_reason", reason).drop("bad_envelope", "_missing")


def _accepted(exploded: DataFrame, typed: dict[str, Column], nullable: set[str]) -> DataFrame:
    """The records without a reject reason: every column that must have a value got one.

    A missing, null or malformed field and a bad envelope all leave a null here, so no reason text is built.
    """
    rows = exploded.select(*_carried(exploded), *[c.alias(n) for n, c in typed.items()])
    return rows.na.drop("any", subset=[n for n in typed if n not in nullable])


INFORMATION_NULLABLE = {"address"}


def check_station_status(documents: DataFrame, column: str = "document", strict: bool = False) -> DataFrame:
    """All status records with their ``reject_reason``; split it to keep the rejects."""
    exploded = explode_members(documents, schemas.STATUS_FEED, "stations", column, strict)
    return _checked(exploded, schemas.REQUIRED_STATUS, _typed_status(), set())


def check_station_information(documents: DataFrame, column: str = "document", strict: bool = False) -> DataFrame:
    exploded = explode_members(documents, schemas.INFORMATION_FEED, "stations", column, strict)
    return _checked(exploded, schemas.REQUIRED_INFORMATION, _typed_information(), INFORMATION_NULLABLE)


def rejected(checked: DataFrame) -> DataFrame:
    """The quarantine side of a checked feed."""
    return checked.where(F.col("reject_reason").isNotNull())


def parse_station_status(
    documents: DataFrame, ingested_at: Column, column: str = "document", strict: bool = False
) -> DataFrame:
    """Valid status records with one ingestion time; ``seq`` keeps the order inside a document."""
    exploded = explode_members(documents, schemas.STATUS_FEED, "stations", column, strict)
    return _accepted(exploded, _typed_status(), set()).withColumn("ingestion_timestamp", ingested_at)


def parse_station_information(documents: DataFrame, column: str = "document", strict: bool = False) -> DataFrame:
    exploded = explode_members(documents, schemas.INFORMATION_FEED, "stations", column, strict)
    return _accepted(exploded, _typed_information(), INFORMATION_NULLABLE)


def feed_metadata(documents: DataFrame, envelope=schemas.DISCOVERY_FEED, column: str = "document") -> DataFrame:
    """Version, time to live and refresh time of each document."""
    doc = F.from_json(F.col(column), envelope)
    return documents.select(doc.alias("d")).select(
        F.coalesce("d.version", F.lit("N/A")).alias("version"),
        F.col("d.ttl").alias("ttl"),
        F.timestamp_seconds("d.last_updated").alias("last_updated"),
    )


def discover_feeds(
    documents: DataFrame, language: str = "en", fallback: str = "pt", column: str = "document"
) -> DataFrame:
    """``(name, url)`` of the feeds offered in ``language``, else in ``fallback``."""
    data = F.from_json(F.col(column), schemas.DISCOVERY_FEED)["data"]
    chosen = F.coalesce(F.try_element_at(data, F.lit(language)), F.try_element_at(data, F.lit(fallback)))
    return documents.select(F.explode(chosen["feeds"]).alias("f")).select("f.name", "f.url")


def read_vehicle_types(documents: DataFrame, column: str = "document") -> DataFrame:
    rows = explode_members(documents, schemas.VEHICLE_TYPES_FEED, "vehicle_types", column)
    return rows.where(~F.col("bad_envelope")).select("record.*")
