"""Merkle manifest of a document table, and inclusion proofs by octopus multiproofs.

A leaf is the digest of a document's fields. The leaves of one language, in the order of their ids, form a
binary tree: every two consecutive nodes become their parent, a last single one becomes a parent alone. The roots of
these trees, in the order of their languages, form one more tree, whose root is the manifest's. Digests are lower-case hex of
SHA-256; inputs are concatenated, digests as hex text.

*Building*: positions come from a sort by range partitions that is written once. Trees are built in storeys of
``BLOCK_BITS`` levels: blocks of so many consecutive nodes of one tree are independent of each other, so a
language that holds most of the rows is spread over its blocks. Every node is written.

*Proving*: the wanted leaves are dealt by blocks too. A leaf partition (one block) computes the minimal union of node
coordinates that it cannot derive itself, level by level: siblings of what it has or derives, each once. These are fetched by one join with
the node table. The block then derives the interiors its leaves share and expands the proof of every leaf from them.
A subset of the leaves is proved in the same way and fetches accordingly more.

Nulls: a null field enters its leaf as ``-``; null languages form the first tree, null ids come first in theirs. Texts are hashed
whole, whatever their length. Ties: leaves with one id are ordered by their digest, and equal rows are equal leaves, each
with a place of its own. An empty table gives an empty manifest. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedock.llm.tables import stage
from tidedock.operators.ordered import global_index
from tidedock.staging import BROADCAST_ROWS

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Levels per storey; a block has 2 ** BLOCK_BITS leaves.
BLOCK_BITS = 12
#: Number of the tree whose leaves are the roots of all others.
TOP = -1
NODE_SCHEMA = "tree long, level int, place long, hash string"


def _sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(changed: dict[str, Column] | None = None) -> Column:
    """Digest of a document's fields; ``changed`` has other values for some of them."""
    return F.sha2(F.concat(*[_field((changed or {}).get(c, F.col(c))) for c in FIELDS]), 256)


def height(size: int) -> int:
    """Levels above the leaves of a tree with ``size`` leaves."""
    return (size - 1).bit_length()


def _width(size: int, level: int) -> int:
    """Nodes of a level: the leaves divided by 2 ** level, rounded up."""
    return -(-size >> level)


@dataclass
class Manifest:
    """``leaves`` (doc_id, lang, leaf, extra..., tree, size, place), ``nodes`` (tree, level, place, hash), ``root`` (None without rows)."""

    leaves: DataFrame
    nodes: DataFrame
    n_trees: int
    root: str | None


# --- building -----------------------------------------------------------------------------------------------------


def _grow(rows: DataFrame, level: int, bits: int) -> DataFrame:
    """Nodes of the ``bits`` levels above ``level`` from its nodes (tree, size, place, hash); a tree ends at its root."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        tree, size = table.column("tree")[0].as_py(), table.column("size")[0].as_py()
        base = table.column("place")[0].as_py()
        have = [h.encode() for h in table.column("hash").to_pylist()]
        levels, places, hashes = [], [], []
        for up in range(level + 1, level + bits + 1):
            if _width(size, up - 1) <= 1:
                break
            base >>= 1
            have = [_sha(b"".join(have[i : i + 2])) for i in range(0, len(have), 2)]
            levels += [up] * len(have)
            places += range(base, base + len(have))
            hashes += have
        return pa.table(
            [
                pa.array([tree] * len(levels), pa.int64()),
                pa.array(levels, pa.int32()),
                pa.array(places, pa.int64()),
                pa.array([h.decode() for h in hashes], pa.string()),
            ],
            names=["tree", "level", "place", "hash"],
        )

    groups = rows.select("tree", "size", "place", "hash").groupBy("tree", F.shiftright("place", bits).alias("_block"))
    return groups.applyInArrow(build, NODE_SCHEMA)


def _all_levels(leaves: DataFrame, sizes: DataFrame, tallest: int, bits: int, name: str) -> DataFrame:
    """Nodes of all levels above the leaves (tree, size, place, hash), one written storey after the other."""
    nodes = leaves.sparkSession.createDataFrame([], NODE_SCHEMA)
    rows, level = leaves, 0
    while level < tallest:
        storey = stage(_grow(rows, level, bits), f"{name}-{level}")
        nodes = nodes.unionByName(storey)
        level += bits
        rows = storey.where(F.col("level") == level).join(sizes, "tree")
    return nodes


def build(docs: DataFrame, extra: dict[str, Column] | None = None, bits: int = BLOCK_BITS) -> Manifest:
    """The manifest of ``docs``; ``extra`` has further columns over ``docs`` that its leaves carry along."""
    fields = [F.col("doc_id").cast("long"), "lang", leaf_digest().alias("leaf")]
    digests = stage(docs.select(*fields, *[c.alias(n) for n, c in (extra or {}).items()]), "leaves")
    ordered = global_index(digests, ["lang", "doc_id", "leaf"], "leaves-ordered")
    trees = ordered.groupBy("lang").agg(F.min("idx").alias("_first"), F.count(F.lit(1)).alias("size"))
    trees = stage(global_index(stage(trees, "trees"), ["lang"], "trees-ordered").withColumnRenamed("idx", "tree"), "trees")
    n_trees, tallest = trees.agg(F.count(F.lit(1)), F.max("size")).first()
    if not n_trees:
        leaves = ordered.select("*", *[F.lit(0).cast("long").alias(c) for c in ("tree", "size", "place")]).drop("idx")
        return Manifest(leaves, docs.sparkSession.createDataFrame([], NODE_SCHEMA), 0, None)
    # Counted first: one row per language.
    of_lang = trees.withColumnRenamed("lang", "_lang")
    of_lang = F.broadcast(of_lang) if n_trees <= BROADCAST_ROWS else of_lang
    placed = ordered.join(of_lang, F.col("lang").eqNullSafe(F.col("_lang")))
    placed = placed.withColumn("place", F.col("idx") - F.col("_first")).drop("_lang", "_first", "idx")
    leaves = stage(placed, "leaves-placed")

    ground = leaves.select("tree", "size", "place", F.col("leaf").alias("hash"))
    sizes = trees.select("tree", "size")
    sizes = F.broadcast(sizes) if n_trees <= BROADCAST_ROWS else sizes
    nodes = ground.select("tree", F.lit(0).alias("level"), "place", "hash").unionByName(
        _all_levels(ground, sizes, height(tallest), bits, "nodes")
    )
    # The root of a tree is the only node of its level.
    alone = F.ceil(F.col("size") / F.pow(F.lit(2.0), F.col("level"))) == 1
    first = (F.col("level") == 0) | (F.ceil(F.col("size") / F.pow(F.lit(2.0), F.col("level") - 1)) > 1)
    roots = nodes.where(F.col("place") == 0).join(sizes, "tree").where(alone & first)
    top = stage(
        roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("size"), F.col("tree").alias("place"), "hash"),
        "subroots",
    )
    top_size = top.sparkSession.createDataFrame([(TOP, n_trees)], "tree long, size long")
    above = top.select("tree", F.lit(0).alias("level"), "place", "hash").unionByName(
        _all_levels(top, F.broadcast(top_size), height(n_trees), bits, "top")
    )
    root = above.where((F.col("level") == height(n_trees)) & (F.col("place") == 0)).first()["hash"]
    return Manifest(leaves, nodes.unionByName(above), n_trees, root)


# --- proving ------------------------------------------------------------------------------------------------------


def missing_nodes(places: np.ndarray, size: int) -> list[tuple[int, np.ndarray]]:
    """Octopus: per level the places of nodes that the proofs of all ``places`` (sorted, distinct) need and these cannot derive."""
    out, level, width = [], 0, size
    have = places
    while width > 1:
        beside = have ^ 1
        beside = beside[beside < width]
        need = np.setdiff1d(beside, have, assume_unique=True)
        if len(need):
            out.append((level, need))
        have = np.unique(have >> 1)
        width = (width + 1) // 2
        level += 1
    return out


def coordinates(wanted: DataFrame, n_trees: int, bits: int) -> DataFrame:
    """(tree, block, at, level, place): the nodes of tree ``at`` that each block of wanted leaves has to fetch."""

    def union(key: tuple, table: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        size = table.column("size")[0].as_py()
        own = [(tree, *n) for n in missing_nodes(np.unique(table.column("place").to_numpy()), size)]
        above = [(TOP, *n) for n in missing_nodes(np.array([tree]), n_trees)]
        found = [(at, level, p) for at, level, need in own + above for p in need.tolist()]
        at, levels, places = zip(*found) if found else ((), (), ())
        return pa.table(
            [
                pa.array([tree] * len(found), pa.int64()),
                pa.array([block] * len(found), pa.int64()),
                pa.array(at, pa.int64()),
                pa.array(levels, pa.int32()),
                pa.array(places, pa.int64()),
            ],
            names=["tree", "block", "at", "level", "place"],
        )

    rows = wanted.select("tree", "size", "place", F.shiftright("place", bits).alias("block"))
    return rows.groupBy("tree", "block").applyInArrow(union, "tree long, block long, at long, level int, place long")


def _complete(known: list[dict[int, bytes]], size: int) -> None:
    """Derives the interiors of a tree level by level from what is known of the level below."""
    for level in range(height(size)):
        below, width = known[level], _width(size, level)
        for parent in {p >> 1 for p in below}:
            if parent not in known[level + 1]:
                left, right = below.get(2 * parent), below.get(2 * parent + 1)
                if left is not None and (right is not None or 2 * parent + 1 >= width):
                    known[level + 1][parent] = _sha(left + (right or b""))


def _siblings(known: list[dict[int, bytes]], place: int, size: int) -> list[tuple[bytes, bool]]:
    """Sibling (empty if there is none) and whether it stands on the left, from the leaf up."""
    out = []
    for level in range(height(size)):
        beside = place ^ 1
        out.append((known[level][beside] if beside < _width(size, level) else b"", beside < place))
        place >>= 1
    return out


def fold(leaf: bytes, siblings: list[tuple[bytes, bool]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for other, left in siblings:
        leaf = _sha(other + leaf if left else leaf + other)
    return leaf


PROOF_SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(manifest: Manifest, wanted: DataFrame, claimed: str = "leaf", bits: int = BLOCK_BITS) -> DataFrame:
    """One row per wanted leaf (rows of ``manifest.leaves``), with the digest of its siblings and the root they fold to.

    The fold starts at column ``claimed`` where it is not null, else at the leaf; ``verified`` says whether it ends at the root.
    """
    n_trees, root = manifest.n_trees, manifest.root
    if not n_trees:
        return wanted.sparkSession.createDataFrame([], PROOF_SCHEMA)
    places = stage(coordinates(wanted, n_trees, bits), "coordinates")
    lowest = places.agg(F.min("level")).first()[0] or 0
    nodes = manifest.nodes.where(F.col("level") >= lowest).withColumnRenamed("tree", "at")
    fetched = places.join(nodes, ["at", "level", "place"])
    n_bytes = root.encode()

    def expand(key: tuple, mine: pa.Table, other: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        if not mine.num_rows:
            return pa.table([[]] * 7, names=names)
        size = mine.column("size")[0].as_py()
        known: list[dict[int, bytes]] = [{} for _ in range(height(size) + 1)]
        top: list[dict[int, bytes]] = [{} for _ in range(height(n_trees) + 1)]
        for at, level, place, digest in zip(*[other.column(c).to_pylist() for c in ("at", "level", "place", "hash")]):
            (top if at == TOP else known)[level][place] = digest.encode()
        leaves = [h.encode() for h in mine.column("leaf").to_pylist()]
        at_place = mine.column("place").to_pylist()
        known[0].update(zip(at_place, leaves))
        _complete(known, size)
        subroot = known[-1][0]
        shared = _siblings(top, tree, n_trees)
        proofs, folded = [], []
        for place, leaf, other_leaf in zip(at_place, leaves, mine.column("claimed").to_pylist()):
            path = _siblings(known, place, size) + shared
            proofs.append(hashlib.sha256(b"".join([s for s, _ in path])).hexdigest())
            folded.append(fold(other_leaf.encode() if other_leaf else leaf, path))
        n = len(leaves)
        return pa.table(
            [
                mine.column("doc_id"),
                mine.column("leaf"),
                pa.array([subroot.decode()] * n),
                pa.array([root] * n),
                pa.array(proofs, pa.string()),
                pa.array([f.decode() for f in folded], pa.string()),
                pa.array([f == n_bytes for f in folded], pa.bool_()),
            ],
            names=names,
        )

    rows = wanted.select("tree", "size", "place", "doc_id", "leaf", F.col(claimed).alias("claimed"), F.shiftright("place", bits).alias("block"))
    got = fetched.select("tree", "block", "at", "level", "place", "hash")
    return rows.groupBy("tree", "block").cogroup(got.groupBy("tree", "block")).applyInArrow(expand, PROOF_SCHEMA)
