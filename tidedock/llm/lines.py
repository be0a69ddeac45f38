"""Line dedup that returns keep bitmaps.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of at least
``min_chars`` code points that occur in at least ``min_docs`` documents keep their lines only in the largest
``doc_id``. Key digests are range-partitioned with a secondary sort by document (descending) and
position, so the first document of a group is the one that keeps its lines and all later ones lose them.
Digests that may hold a thousandth of the lines are found by Misra-Gries counters, verified by an
aggregate with map-side combine and broadcast; their lines never shuffle as a group.

The result names dropped lines as a run-length compressed keep bitmap per document: lengths of alternating
runs, starting with kept lines (``[n]``: all ``n`` lines stay). A null text is one empty line. Rows that repeat
a ``doc_id`` with equal text are one document; rows with an equal id and other text count as the same document
for ``min_docs`` and have bitmaps of their own. A null id is smaller than every other and counts as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedock.llm.tables import SPACES, shuffle_partitions, stage, text_or_empty
from tidedock.llm.urls import LOWER, UPPER

MIN_CHARS = 40
MIN_DOCS = 5
SUPPORT = 0.001


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _version() -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(text_or_empty())


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, version, pos, h, digest) for every line with a long enough key."""
    lines = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("doc"),
        _version().alias("version"),
        F.posexplode(F.split(text_or_empty(), "\n")).alias("pos", "line"),
    )
    lines = lines.where(F.length("line") >= min_chars)  # a key is never longer than its line
    keyed = lines.select("doc", "version", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.where(F.length("key") >= min_chars)
    return keyed.select("doc", "version", "pos", F.xxhash64("key").alias("h"), F.unhex(F.md5("key")).alias("digest"))


def heavy_keys(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Exact document count and largest document of the keys that may be heavy (at most 1 / support hashes)."""
    items = rows.stat.freqItems(["h"], support).select(F.explode("h_freqItems").alias("h"))
    some = rows.join(F.broadcast(items), "h", "left_semi")
    # Once per document first, so that the count needs no set per key.
    once = some.groupBy("h", "digest", "doc").agg(F.lit(1).alias("one"))
    return once.groupBy("h", "digest").agg(F.count("one").alias("n_docs"), F.max("doc").alias("keep_doc"))


def dropped_lines(rows: DataFrame, min_docs: int = MIN_DOCS, support: float = SUPPORT) -> DataFrame:
    """(doc, version, pos) of every line that goes."""
    spark = rows.sparkSession
    heavy = F.broadcast(stage(heavy_keys(rows, support), "heavy-lines"))
    hot = rows.join(heavy, ["h", "digest"]).where((F.col("n_docs") >= min_docs) & (F.col("doc") < F.col("keep_doc")))
    rest = rows.join(heavy, ["h", "digest"], "left_anti")
    rest = rest.repartitionByRange(shuffle_partitions(spark), "h", "digest")
    rest = rest.sortWithinPartitions("h", "digest", F.desc("doc"), "pos")
    group = Window.partitionBy("h", "digest")
    rest = rest.withColumn("rank", F.dense_rank().over(group.orderBy(F.desc("doc"))))
    rest = rest.withColumn("n_docs", F.max("rank").over(group))
    cold = rest.where((F.col("n_docs") >= min_docs) & (F.col("rank") > 1))
    return hot.select("doc", "version", "pos").unionByName(cold.select("doc", "version", "pos"))


def _bitmap(drops: Column, n_lines: Column) -> Column:
    """Lengths of alternating runs of kept and dropped lines, from sorted dropped positions; one pass, no growing array."""
    before = F.concat(F.array(F.lit(-2)), drops)
    after = F.concat(F.slice(drops, 2, F.greatest(F.size(drops), F.lit(1))), F.array(F.lit(2**31 - 1)))
    near = F.arrays_zip(drops.alias("p"), F.slice(before, 1, F.size(drops)).alias("b"), after.alias("a"))
    begins = F.transform(F.filter(near, lambda x: x["p"] - x["b"] > 1), lambda x: x["p"])
    ends = F.transform(F.filter(near, lambda x: x["a"] - x["p"] > 1), lambda x: x["p"] + 1)
    bounds = F.flatten(F.zip_with(begins, ends, lambda x, y: F.array(x, y)))
    runs = F.zip_with(F.concat(bounds, F.array(n_lines)), F.concat(F.array(F.lit(0)), bounds), lambda x, y: x - y)
    open_end = F.element_at(drops, -1) < n_lines - 1
    return F.when(F.size(drops) == 0, F.array(n_lines)).when(open_end, runs).otherwise(F.slice(runs, 1, F.size(runs) - 1))


def n_dropped(bitmap: Column) -> Column:
    """Number of lines that a keep bitmap drops."""
    return F.aggregate(F.transform(bitmap, lambda n, i: n * (i % 2)), F.lit(0), lambda a, n: a + n)


def kept_text(text: Column, bitmap: Column) -> Column:
    """``text`` with the lines that its keep bitmap keeps; no kept line gives an empty text."""
    keeps = F.flatten(F.transform(bitmap, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    pairs = F.arrays_zip(F.split(text, "\n").alias("line"), keeps.alias("keep"))
    left = F.transform(F.filter(pairs, lambda x: x["keep"]), lambda x: x["line"])
    return F.when(F.size(bitmap) == 1, text).otherwise(F.array_join(left, "\n"))


def line_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, support: float = SUPPORT
) -> DataFrame:
    """(doc_id, version, n_lines, keep_bitmap, kept_text) for every row of ``docs``; the text follows from the bitmap.

    An empty table gives no rows; a text of any length is one row with one bitmap.
    """
    rows = stage(line_rows(docs, min_chars), "lines")
    drops = dropped_lines(rows, min_docs, support).distinct()  # rows given twice name their lines twice
    per_doc = drops.groupBy("doc", "version").agg(F.sort_array(F.collect_list("pos")).alias("drops"))
    whole = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("doc"),
        _version().alias("version"),
        text_or_empty().alias("text"),
    )
    joined = whole.join(per_doc, ["doc", "version"], "left")
    # A text has one line more than line breaks; cheaper than a split of texts that keep all lines.
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    bitmap = F.when(F.col("drops").isNull(), F.array("n_lines")).otherwise(_bitmap(F.col("drops"), F.col("n_lines")))
    marked = joined.withColumn("n_lines", n_lines).withColumn("keep_bitmap", bitmap)
    return marked.select(
        "doc_id", "version", "n_lines", "keep_bitmap", kept_text(F.col("text"), F.col("keep_bitmap")).alias("kept_text")
    )
