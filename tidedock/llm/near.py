"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

Words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; a document's set holds its distinct 5-word
shingles (fewer words: the whole sequence as one; none: empty). Two documents are linked if their sets have a
Jaccard similarity of at least ``percent`` / 100; groups are the connected components of the links.

1. A sketch of ``COORDINATES`` values per document. In round ``i`` every shingle is thrown into one bin with the
   value (i, hash); a bin keeps its least value. Rounds go on until all bins are full; from round t on,
   round ``t + j`` throws every shingle into bin ``j``, so all bins fill at the latest after 2t rounds. Documents with
   equal sets form a class; only its first document goes on, so exact copies never meet.
2. Bands of the sketch: classes that share a band are candidates. Each band links its members to its smallest
   member only (a star, found by a map-side combined minimum and a join that can split hot bands).
3. Candidates are verified on the full sets of 64-bit shingle hashes.
4. Bands whose members are in several components after that are completed. A member's *own* shingles, which no other
   member of such a band has, bound its similarity to all others; most members outside are done by that bound alone.
   The rest is compared with the band's most central member (fewest own shingles), again a star. Shingles shared with the centre
   and those outside it that are not a member's own bound what two members can have in common; only pairs in different
   components that these bounds and the distances to the first star's centre (a metric) leave possible are compared
   one by one.

With 32 bands of 4 coordinates, a pair with similarity 0.75 is no candidate with probability 5e-6.

Null and empty texts have the empty set, no links, and are kept. A document is an id with a text: rows with equal ids, or
without one, are told apart by their texts, also in ``kept``. Nodes are numbers of the classes; a component is named by its
first document, the smallest id and of equal ids the smallest digest of the text. A null id counts as -2**63 in comparisons
and is returned as null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedock.llm.components import connected_components
from tidedock.llm.tables import keep_once, stage, text_or_empty
from tidedock.llm.textbytes import batches_of, flat, mix, trimmed, word_hashes

SHINGLE = 5
PERCENT = 75
BANDS = 32
ROWS = 4
COORDINATES = BANDS * ROWS

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1
_ORDER = [np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xABC98388FB8FAC03), np.uint64(0x2545F4914F6CDD1D),
          np.uint64(0xD1342543DE82EF95), np.uint64(0xF1357AEA2E62A9C5)]
_NULL_ID = -(2**63)
#: Texts of one step of a task; sorted shingles take several times that.
STEP_BYTES = 1 << 20
_NO_TEXT = b""


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document in ascending order, and where each document's begin."""
    word, owner = word_hashes(data, offsets)
    n_docs = len(offsets) - 1
    begin = np.searchsorted(owner, np.arange(n_docs + 1))
    count = np.diff(begin)
    parts, owners = [], []
    n = len(word) - SHINGLE + 1
    if n > 0:
        inside = np.flatnonzero(owner[:n] == owner[SHINGLE - 1 :])
        h = np.zeros(len(inside), np.uint64)
        for k in range(SHINGLE):
            h += word[inside + k] * _ORDER[k]
        parts.append(mix(h))
        owners.append(owner[inside])
    for size in range(1, SHINGLE):  # short documents
        docs = np.flatnonzero(count == size)
        h = np.full(len(docs), size, np.uint64)
        for k in range(size):
            h += word[begin[docs] + k] * _ORDER[k]
        parts.append(mix(h + _STEP))
        owners.append(docs)
    h, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
        h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(n_docs + 1))


def sketches(h: np.ndarray, begin: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches, one row per document with a non-empty set (others: all zero)."""
    n_docs = len(begin) - 1
    size = np.diff(begin)
    out = np.full(n_docs * t, np.iinfo(np.uint64).max, np.uint64)
    empty = out[0] if n_docs else None
    active = np.flatnonzero(size)
    for i in range(2 * t):
        if not len(active):
            break
        n = size[active]
        index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[active], n)
        thrown = mix(h[index] + np.uint64((i + 1) * int(_STEP) & _MASK))
        bin_of = (thrown >> np.uint64(48)).astype(np.int64) % t if i < t else np.full(len(thrown), i - t)
        value = (np.uint64(i) << np.uint64(48)) | (mix(thrown) >> np.uint64(16))
        np.minimum.at(out, np.repeat(active, n) * t + bin_of, value)
        full = (out.reshape(n_docs, t)[active] != empty).all(1)
        active = active[~full]
    out = out.reshape(n_docs, t)
    out[size == 0] = 0
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    rows = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _STEP
    for k in range(ROWS):
        key = mix(key ^ rows[:, :, k]) * _ORDER[k]
    return key


def _identity() -> dict[str, Column]:
    """What tells documents apart: id and text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))
    return {"doc": doc, "text_sha256": F.unhex(F.sha2(text_or_empty(), 256))}


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*[e.alias(c) for c, e in _identity().items()], "text")


def features(docs: DataFrame) -> DataFrame:
    """(doc, text_sha256, n_shingles, digest of the set, bands) for every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", STEP_BYTES):
                h, begin = shingle_sets(*flat(part.column("text")))
                size = np.diff(begin)
                keys = band_keys(sketches(h, begin)).view(np.int64)
                digest = [hashlib.md5(h[a:b].tobytes()).digest() if b > a else None for a, b in zip(begin[:-1], begin[1:])]
                bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel()))
                yield pa.record_batch(
                    [part.column("doc"), part.column("text_sha256"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), bands],
                    names=["doc", "text_sha256", "n_shingles", "digest", "bands"],
                )

    return _documents(docs).mapInArrow(
        trimmed(sketch), "doc long, text_sha256 binary, n_shingles long, digest binary, bands array<long>"
    )


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Full sets of the documents named by ``ids`` (doc, text_sha256, rep), one row (rep, shingles) each."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", STEP_BYTES):
                h, begin = shingle_sets(*flat(part.column("text")))
                sets = [h[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])]
                yield pa.record_batch([part.column("rep"), pa.array(sets, pa.binary())], names=["doc", "shingles"])

    rows = _documents(docs).join(ids, ["doc", "text_sha256"]).select("rep", "text")
    sets = stage(rows.mapInArrow(trimmed(collect), "doc long, shingles binary"), "sets")
    several = stage(sets.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "repeated-rows")
    if several.isEmpty():
        return sets
    once = sets.join(several, "doc", "left_semi").groupBy("doc").agg(F.first("shingles").alias("shingles"))
    return stage(sets.join(several, "doc", "left_anti").unionByName(once), "sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the sizes of intersection and union of their sets."""
    first = sets.withColumnsRenamed({"doc": "a", "shingles": "set_a"})
    second = sets.withColumnsRenamed({"doc": "b", "shingles": "set_b"})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, either = [], []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                merged = np.concatenate((x, y))
                merged.sort(kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                both.append(common)
                either.append(len(merged) - common)
            yield pa.record_batch(
                [batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(either, pa.int64())],
                names=["a", "b", "both", "either"],
            )

    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(trimmed(compare), "a long, b long, both long, either long")


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """(doc, text_sha256, n_shingles, component, kept) for every row of ``docs``."""
    rows = stage(features(docs), "sketches")
    classes = rows.where("n_shingles > 0").groupBy("digest").agg(
        F.min(F.struct("doc", "text_sha256")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    # Written, so the numbers stay what they are.
    classes = stage(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    members = classes.select("rep", "n", F.explode("bands").alias("band"))
    pivots = members.groupBy("band").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("size"))
    pivots = pivots.where("size > 1").drop("size")
    # Bands with one member are gone here; of the others every member, the pivot included.
    banded = stage(members.join(pivots, "band"), "bands")

    ids = classes.select("first.doc", "first.text_sha256", "rep")
    sets = _sets_of(docs, ids.join(banded.select("rep").distinct(), "rep", "left_semi"))

    fits = F.expr(f"100 * least(n, pivot_n) >= {percent} * greatest(n, pivot_n)")
    sizes = classes.select(F.col("rep").alias("pivot"), F.col("n").alias("pivot_n"))
    star = banded.where("rep <> pivot").select("pivot", "rep", "n").distinct().join(sizes, "pivot")
    checked = stage(
        _verified(star.where(fits).select(F.col("pivot").alias("a"), F.col("rep").alias("b")), sets), "star-links"
    )
    linked = F.expr(f"100 * both >= {percent} * either")
    links = checked.where(linked).select("a", "b")
    part_of = stage(connected_components(links), "components")

    # Bands in several components: a star around the most central member, then what is still possible.
    members = _open_members(banded, checked, part_of, sets, percent)
    if members is not None:
        centred = _centred(members)
        pairs = centred.where("rep <> centre").select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
        central = stage(_verified(pairs.distinct(), sets), "central-links")
        links = stage(links.unionByName(central.where(linked).select("a", "b")), "links")
        part_of = stage(connected_components(links), "components")
        rest = _remaining_pairs(centred, central, part_of, percent)
        more = stage(_verified(stage(rest, "pairs"), sets), "more-links")
        links = stage(links.unionByName(more.where(linked).select("a", "b")), "links")
        part_of = stage(connected_components(links), "components")

    # A component's first document names it; classes without links name themselves.
    nodes = part_of.withColumnRenamed("node", "rep")
    names = classes.select("rep", "first").join(nodes, "rep").groupBy("component").agg(F.min("first").alias("name"))
    named = classes.select("rep", "digest", "first").join(nodes.join(names, "component").drop("component"), "rep", "left")
    of_class = named.select("digest", F.coalesce("name", "first").alias("name"))
    joined = rows.select("doc", "text_sha256", "n_shingles", "digest").join(of_class, "digest", "left")
    own = F.struct("doc", "text_sha256")
    name = F.coalesce("name", own)
    return joined.select("doc", "text_sha256", "n_shingles", name["doc"].alias("component"), (own == name).alias("kept"))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; ``kept`` goes by ids alone, unlike `kept_documents`."""
    return _judged(docs, percent).select(
        F.when(F.col("doc") != _NULL_ID, F.col("doc")).alias("doc_id"),
        "n_shingles",
        F.when(F.col("component") != _NULL_ID, F.col("component")).alias("component_id"),
        (F.col("doc") == F.col("component")).alias("kept"),
    )


def _in_open_bands(rows: DataFrame) -> DataFrame:
    """Rows of bands that hold several components."""
    spread = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(spread.where("low <> high").select("band", "low"), "band")


def _open_members(
    banded: DataFrame, checked: DataFrame, part_of: DataFrame, sets: DataFrame, percent: int
) -> DataFrame | None:
    """Members that can still have an unknown link inside a band of several components; None if there are no such bands.

    ``own`` counts shingles that no other member of an open band has. They are in the union with any partner and never
    in the intersection, so a member whose own shingles already rule out every partner size of the band is done.
    """
    component = part_of.withColumnRenamed("node", "rep")
    rows = banded.join(component, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    rows = stage(_in_open_bands(rows).drop("low"), "open-bands")
    if rows.isEmpty():
        return None

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, raw in zip(batch.column("doc"), batch.column("shingles")):
                h = np.frombuffer(raw.as_py(), np.int64)
                yield pa.record_batch([pa.array(h), pa.array(np.full(len(h), doc.as_py()))], names=["h", "doc"])

    open_sets = sets.join(rows.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")
    single = open_sets.mapInArrow(explode, "h long, doc long").groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc").alias("rep")
    )
    own = single.where("n = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    known = checked.select(
        F.col("a").alias("pivot"), F.col("b").alias("rep"), (1 - F.col("both") / F.col("either")).alias("distance")
    )
    rows = rows.join(own, "rep", "left").join(known, ["pivot", "rep"], "left").select(
        "band", "rep", "n", "component", F.coalesce("own", F.lit(0)).alias("own"),
        F.when(F.col("rep") == F.col("pivot"), 0.0).otherwise(F.col("distance")).alias("distance"),
    )
    least = rows.groupBy("band").agg(F.min("n").alias("least"))
    rows = rows.join(least, "band").where(f"100 * (n - own) >= {percent} * (least + own)").drop("least")
    return stage(_in_open_bands(rows), "open-members")


def _centred(members: DataFrame) -> DataFrame:
    """Members with the member of their band that has the fewest shingles of its own, and the band's least size."""
    centre = members.groupBy("band").agg(
        F.min_by("rep", F.struct("own", "rep")).alias("centre"), F.min("n").alias("least")
    )
    return stage(members.drop("component", "low").join(centre, "band"), "centred")


def _remaining_pairs(centred: DataFrame, central: DataFrame, part_of: DataFrame, percent: int) -> DataFrame:
    """Pairs of a band in different components that no bound rules out.

    ``inner`` shingles are shared with the centre; ``extra`` ones are outside it and not the member's own. Two members have at most
    ``least(inner) + least(extra)`` shingles in common. Where a member's inner shingles alone are too few for a link, only members
    with extra shingles are partners; in a group of independent copies of the centre there are none.
    """
    known = central.select("a", "b", F.col("both").alias("inner"))
    rows = centred.withColumn("a", F.least("rep", "centre")).withColumn("b", F.greatest("rep", "centre"))
    rows = rows.join(known, ["a", "b"], "left").drop("a", "b")
    rows = rows.withColumn("inner", F.when(F.col("rep") == F.col("centre"), F.col("n")).otherwise(F.col("inner")))
    rows = rows.withColumn("extra", F.greatest(F.col("n") - F.col("inner") - F.col("own"), F.lit(0)))
    rows = rows.join(part_of.withColumnRenamed("node", "rep"), "rep", "left")
    rows = rows.withColumn("component", F.coalesce("component", "rep"))
    rows = stage(_in_open_bands(rows).where("rep <> centre"), "open-bands")
    bands = rows.groupBy("rep").agg(F.collect_set("band").alias("bands"))  # at most BANDS each
    rows = rows.join(bands, "rep")

    columns = ("rep", "n", "inner", "extra", "component", "distance", "bands")
    side = lambda df, p: df.select("band", *[F.col(c).alias(f"{p}_{c}") for c in columns])
    # One of two components is not the band's smallest: its members meet the others.
    left = rows.where("component <> low")
    few = F.expr(f"100 * inner < {percent} * (n + least - inner)")
    most = "(least(x_inner, y_inner) + least(x_extra, y_extra))"
    met = F.expr(
        f"x_component <> y_component AND 100 * {most} >= {percent} * (x_n + y_n - {most})"
        f" AND coalesce(abs(x_distance - y_distance) <= {1 - percent / 100 + 1e-9}, true)"  # a metric; null: sizes too unlike
    )
    found = []
    for x, y in ((left.where(few & (F.col("extra") > 0)), rows.where("extra > 0")), (left.where(~few), rows)):
        x, y = side(x, "x"), side(y, "y")
        once = x["band"] == F.array_min(F.array_intersect("x_bands", "y_bands"))  # in the first band they share
        pairs = x.join(y, (x["band"] == y["band"]) & met & once)
        found.append(pairs.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")))
    return found[0].unionByName(found[1]).distinct()


def kept_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document per group (the smallest id) and all documents without a group, with their own columns."""
    kept = _judged(docs, percent).where("kept").select("doc", "text_sha256")
    return keep_once(docs, kept, _identity())
