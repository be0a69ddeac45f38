"""Shared table helpers: inputs, written intermediate tables, selection of kept documents."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedock import staging

#: Columns of ``documents``; other columns of an input are carried along or ignored.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: ASCII white space as words, lines and normalised texts use it.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_CLASS = r"[\x20\x09-\x0D]"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs here go when it ends; a written table needs them no more."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``staging.stage`` that also frees the shuffle files of the write."""
    with freed_shuffles(df.sparkSession):
        return staging.stage(df, f"llm-{name}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cached_bytes(words: dict[str, bytes], newest: int) -> int:
    """About the memory of the newest entries of a word cache: keys, values and what an entry takes itself."""
    return sum(170 + 2 * len(w) + len(words[w]) for w in islice(reversed(words), newest))


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def without(text: Column, characters: str) -> Column:
    """``text`` without the given characters; much cheaper than a pattern or ``translate``."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def crc_fold(parts: int) -> Column:
    """Fold number of a document: CRC-32 of its id in decimal, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def keep_once(docs: DataFrame, kept: DataFrame, identity: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose identity is in ``kept``; identities that ``kept`` names twice give one row.

    ``identity`` has expressions over ``docs`` by the names of their columns in ``kept``; nulls are equal. Only rows of
    repeated identities are grouped, so the others pass through one join. Of rows that share an identity, one with the
    longest text stays.
    """
    names = [f"_kept_{c}" for c in identity]
    ids = kept.groupBy(*[F.col(c).alias(n) for c, n in zip(identity, names)]).agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    own = docs.withColumns({f"_own_{c}": e for c, e in identity.items()})
    same = [F.col(f"_own_{c}").eqNullSafe(F.col(n)) for c, n in zip(identity, names)]
    rows = own.join(ids, same)
    single = rows.where(~F.col("_repeated")).select(*docs.columns)
    # As JSON, so that columns without an order (maps) can take part.
    rest = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    order = F.struct(F.length(text_or_empty()), "text", rest)
    several = rows.where("_repeated").groupBy(*names).agg(F.max_by(F.struct(*docs.columns), order).alias("_r"))
    return single.unionByName(several.select("_r.*"))
