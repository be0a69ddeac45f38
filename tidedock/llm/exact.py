"""Exact dedup with a heavy-hitter split.

Texts are equal if identical without ``[\\x20\\x09-\\x0D]``; null counts as empty. Of equal texts the row
with the most code points, then the smallest ``doc_id`` (null last) stays. One narrow row per document
holds the digests. Misra-Gries counters (``freqItems``) name the digests that may hold more than a
thousandth of all rows; their exact counts and winners are verified and broadcast (a few thousand rows at
any size), so rows of hot digests never shuffle. All others meet in windows over the digest, each of at
most about a thousandth of the rows.

Rows that repeat one ``doc_id`` with equal text are one document and share its verdict; of the documents that stay each
gives one row, its longest. Rows that share an id, or have none, with different texts are different documents. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedock.llm.tables import SPACES, keep_once, stage, text_or_empty, without

#: Share of rows from which a digest counts as heavy.
SUPPORT = 0.001


def _size() -> Column:
    return F.length(text_or_empty())


def _plain() -> Column:
    return without(text_or_empty(), SPACES)


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per row of ``docs``."""
    plain = docs.select("doc_id", _size().alias("size"), _plain().alias("_t"))
    return plain.select(
        "doc_id", "size", F.sha2("_t", 256).alias("text_sha256"), F.xxhash64("_t").alias("check")
    )


def _best() -> Column:
    """Greatest for the row that stays; a null id loses."""
    return F.struct("size", F.bitwise_not(F.col("doc_id").cast("long")).alias("inverse_id"))


def _verdict(rows: DataFrame) -> DataFrame:
    keep_id = F.bitwise_not(F.col("best.inverse_id"))
    return rows.select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def heavy_winners(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Exact winner and count of every digest that may be heavy.

    A digest whose second hash disagrees between rows is no winner and goes the ordinary way.
    """
    found = rows.stat.freqItems(["text_sha256"], support)  # at most 1 / support items
    items = found.select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    per_digest = rows.join(F.broadcast(items), "text_sha256", "left_semi").groupBy("text_sha256")
    exact = per_digest.agg(
        F.max(_best()).alias("best"),
        F.count(F.lit(1)).alias("group_size"),
        F.min("check").alias("low"),
        F.max("check").alias("high"),
    )
    return exact.where("low = high AND group_size > 1").select("text_sha256", "best", "group_size")


def _judged(docs: DataFrame, support: float) -> DataFrame:
    """Digests of every row of ``docs`` with the ``best`` and ``group_size`` of its group."""
    rows = stage(digests(docs), "digests")
    winners = stage(heavy_winners(rows, support), "heavy-digests")
    hot = rows.join(F.broadcast(winners), "text_sha256")
    same = Window.partitionBy("text_sha256", "check")
    rest = rows.join(F.broadcast(winners), "text_sha256", "left_anti").withColumns(
        {"best": F.max(_best()).over(same), "group_size": F.count(F.lit(1)).over(same)}
    )
    return hot.unionByName(rest)


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    return _verdict(_judged(docs, support))


def kept_documents(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with the columns they came with; a document given twice stays once."""
    kept = _judged(docs, support).where(_best().eqNullSafe(F.col("best"))).select("doc_id", "size", "text_sha256")
    identity = {"doc_id": F.col("doc_id"), "size": _size(), "text_sha256": F.sha2(_plain(), 256)}
    return keep_once(docs, kept, identity)
