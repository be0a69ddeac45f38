"""Polled feed files as a stream: the batch parsers and merges under Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions.timefns import GRID, utc_day
from tidedock.operators import quality
from tidedock.operators.anomaly import STUCK_HOURS, slice_summaries, stuck_from_slices
from tidedock.sources import versions
from tidedock.sources.feeds import parse_station_status
from tidedock.sources.tables import read_status
from tidedock.sources.writers import append_status, of_days
from tidedock.staging import stage

LATENESS = "1 hour"
#: Which of several reports of one key is the first: file time and name, then the place in the file.
ORDER = ["file_time", "source_file", "seq"]


def read_document_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Landed files, at most ``files_per_trigger`` per micro-batch.

    A feed document lists a station once, so this also bounds the rows of a station in a micro-batch.
    """
    reader = spark.readStream.format("text").option("wholetext", True)
    files = reader.option("maxFilesPerTrigger", files_per_trigger).load(path)
    return files.select(
        F.col("value").alias("document"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def status_stream(documents: DataFrame) -> DataFrame:
    """Parsed status records, the trigger time as their ingestion time."""
    return parse_station_status(documents, F.current_timestamp())


def append_stream(
    status: DataFrame, table: str, checkpoint: str, order_by: list[str] = ORDER, available_now: bool = True
):
    """Append every micro-batch with the idempotent batch operator, so a replayed batch adds nothing.

    Rows go in unfiltered: a fact may arrive at any time and is stored unless its key is there already.
    """

    def write(batch: DataFrame, _epoch: int) -> None:
        append_status(batch, table, order_by)

    return _started(status, write, checkpoint, available_now)


def _started(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True):
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def binned_stream(status: DataFrame, freq: str = GRID, lateness: str = LATENESS) -> DataFrame:
    """Closed grid bins of each station, emitted once the watermark has passed them.

    Repeated reports of a key count once. Facts later than ``lateness`` are not in the emitted bins; they are in
    the appended table, from which bins can be computed again. Feed the written bins to
    ``regularise.fill_forward``.
    """
    t = F.col("last_reported")
    once = status.withWatermark("last_reported", lateness).dropDuplicatesWithinWatermark(schemas.STATUS_GRAIN)
    binned = once.groupBy("station_id", F.window(t, freq).alias("_bin")).agg(
        *[F.avg(c).alias(c) for c in schemas.COUNT_COLS],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), t)).alias(c) for c in schemas.FLAG_COLS],
        F.min(t).alias("first_seen"),
        F.max(t).alias("last_seen"),
    )
    return binned.select(
        "station_id", F.col("_bin.start").alias("timestamp"), *schemas.COUNT_COLS, *schemas.FLAG_COLS,
        "first_seen", "last_seen",
    )


def update_slices(spark: SparkSession, table: str, slices: str, touched: DataFrame) -> None:
    """Summarise the (station_id, reported_on) slices in ``touched`` anew from the status table.

    Reads the days that occur in ``touched`` and nothing else of the facts; other stations' summaries of these days are
    carried over. The days are replaced in one committed version, so a repeated call changes nothing.
    """
    facts = of_days(read_status(spark, table), touched, "reported_on")
    facts = facts.join(touched, ["station_id", "reported_on"], "left_semi")
    facts = facts.select("station_id", F.col("last_reported").alias("timestamp"), "num_bikes_available", "is_renting")
    fresh = slice_summaries(facts)
    fresh = fresh.withColumn("slice_on", utc_day(fresh, "slice")).select(*schemas.SLICES.fieldNames())
    base = versions.current(spark, slices)
    if base is not None:
        days = touched.withColumnRenamed("reported_on", "slice_on")
        stored = of_days(versions.read(spark, slices, schemas.SLICES, ["slice_on"], base), days, "slice_on")
        fresh = fresh.unionByName(stored.join(days, ["station_id", "slice_on"], "left_anti"))
    versions.replace(fresh, slices, ["slice_on"], base)


def stuck_stream(
    status: DataFrame, table: str, checkpoint: str, sink: Callable[[DataFrame, int], None],
    threshold_hours: float = STUCK_HOURS, order_by: list[str] = ORDER, slices: str | None = None,
):
    """The stuck rule for every station of a micro-batch, from its stored slice summaries.

    A late report can move a change that lies behind newer ones, but only inside its day or at the day's edges. Each
    micro-batch is appended, the (station, day) slices in it are summarised anew, and the summaries of its
    stations, one row per station and day, are chained. Facts of other days are not read, however long the history is.
    Stream and batch agree in whatever order files arrive, and a replayed batch ends in the same state.
    """
    slices = slices or f"{table}-slices"

    def follow(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = stage(batch, "stuck-batch")
        if batch.isEmpty():
            return
        append_status(batch, table, order_by)
        touched = batch.select("station_id", utc_day(batch, "last_reported").alias("reported_on")).distinct()
        touched = stage(touched, "stuck-slices")
        update_slices(spark, table, slices, touched)
        known = versions.read(spark, slices, schemas.SLICES, ["slice_on"])
        sink(stuck_from_slices(known.join(touched, "station_id", "left_semi"), threshold_hours), epoch)

    return _started(status, follow, checkpoint)


def quality_stream(
    status: DataFrame, information: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
    labels: list[str] | None = None,
):
    """The four quality counters of every micro-batch, handed to ``sink`` with its row count.

    ``labels`` are columns with one value per micro-batch, such as a partition of the landed files; the least is passed on.
    """

    def check(batch: DataFrame, epoch: int) -> None:
        rows = stage(batch, "quality-batch")
        report = quality.dq_report(rows, information)
        counters = report.groupBy().pivot("name", quality.CHECKS).agg(F.first("violation_count"))
        sizes = rows.agg(F.count("*").alias("n_rows"), *[F.min(c).alias(c) for c in labels or []]).first().asDict()
        sink(counters.withColumns({c: F.lit(v) for c, v in sizes.items()}), epoch)

    return _started(status, check, checkpoint)
