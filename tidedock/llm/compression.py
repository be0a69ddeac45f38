"""Shared parts of the classifiers that compare compressed lengths under several zstandard dictionaries."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable

import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-cased words of letters, one space around each."""
    return f" {_OTHER.sub(' ', (text or '').lower())} "


def document_frequency(texts: Iterable[str]) -> Counter:
    """In how many of the texts (as ``letters`` gives them) a word occurs."""
    found: Counter = Counter()
    for text in texts:
        found.update(set(text.split()))
    return found


def distinct_texts(texts: list[str]) -> list[int]:
    """Positions of texts without later near copies, so that a passage copied often counts once.

    A text is a near copy if two of four least hashes of its word triples occurred at an earlier text.
    """
    seen: set[tuple[int, int]] = set()
    out = []
    for at, text in enumerate(texts):
        words = text.split()
        triples = [zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))]
        marks = {(k, min((t * m + k) & 0xFFFFFFFF for t in triples)) for k, m in enumerate(_MULTIPLIERS)}
        if len(marks & seen) < 2:
            out.append(at)
        seen |= marks
    return out


def dictionary(words: list[str], size: int) -> bytes:
    """Raw content from words in order of importance; the most important stand last, where matches are cheapest."""
    kept, total = [], 1
    for word in words:
        total += len(word.encode()) + 1
        if total > size:
            break
        kept.append(word)
    return f" {' '.join(reversed(kept))} ".encode()


def compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    """Frames without size, checksum and dictionary id, so that only content counts."""
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def hash_share(salt: int) -> Column:
    """A number in [0, 1) that depends on the document's id and text."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def passage(limit: int) -> Column:
    """The text, or of a longer one ``limit`` characters from a place that its hash chooses."""
    start = F.pmod(F.xxhash64("text"), F.length("text") - limit + 1) + 1
    return F.when(F.length("text") <= limit, F.col("text")).otherwise(F.substring(F.col("text"), start.cast("int"), F.lit(limit)))


def cut_share(per_label: int, count: int) -> float:
    """Share of hashes that holds a little more than ``per_label`` of ``count`` rows."""
    return min(1.0, (1.2 * per_label + 50) / count)


def bounded_sample(rows: DataFrame, label: str, per_label: int, salt: int, counts: dict | None = None) -> DataFrame:
    """``per_label`` rows of each label, all of a rarer one: those with the least hashes of id and text.

    A first cut keeps a little more than that whatever the number of rows, so the ranks are of few rows. ``counts`` has the number of
    all rows per label, for ``rows`` that are counted already or hold only those of the cut.
    """
    if counts is None:
        counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    chosen = F.lit(False)
    for value, count in counts.items():
        chosen = chosen | ((F.col(label) == F.lit(value)) & (hash_share(salt) < cut_share(per_label, count)))
    order = Window.partitionBy(label).orderBy(hash_share(salt), "doc_id", "text")
    return rows.where(chosen).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_label).drop("_rank")
