"""Cross-tokenizer alignment of texts, each distinct text once.

Two tokenizers cut the same bytes at different places; where both cut, a group ends. Tokens of one group are linked with each
other. Texts are shuffled as a whole, so that equal ones meet; each distinct text is tokenised and aligned once and carries
its multiplicity. The count of a pair of ids is the number of documents that hold it linked: the sum of the multiplicities of the texts that do.
Measures of a text that need these counts are joined back to it, and all measures to the documents.

Neither tokenizer joins what is before white space with it: the byte-level one splits there, and pieces of the other hold no space behind
other characters. So texts are aligned in units of white space and what follows it. A unit is tokenised and
aligned once per worker; known units are forgotten when they take more than ``UNIT_BYTES``. White space that occurs inside pieces
does not begin a unit. With a model whose pieces go across spaces every text is one unit.

Skew: a text that a third of all rows repeat is one row after map-side counting; its measures reach its documents by a broadcast
of the at most 1,000 texts that hold a thousandth of the rows each. A pair that most texts hold is resolved by a broadcast of the at most
``HEAVY_PAIRS`` pairs with so large a share of all occurrences; the other pairs are joined by id.
Links of a group are counted from the numbers of its ids, never listed one by one.

Defined results: null and empty texts, and texts whose tokens do not give back their bytes, have no tokens (zeros and an empty digest).
Texts are aligned whole. Repeated rows count as documents of their own. Ties for an id's highest count are all highest. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedock.llm.tables import stage
from tidedock.llm.textbytes import batches_of

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
#: Bound of the units a worker knows, and of the text of one step, in bytes.
UNIT_BYTES, STEP_BYTES = 64 << 20, 1 << 20
#: Links of a group that are listed one by one.
SMALL_GROUP = 1024
#: A pair is broadcast if it is at least this part of all (text, pair) rows, so no more than this many are.
HEAVY_PAIRS = 200_000
#: A text is broadcast with its measures if it is at least this part of all documents.
HEAVY_TEXTS = 1_000

#: White space of the byte-level tokenizer's pattern.
_SPACES = "\t-\r \x85\xa0  -     　"
_SHIFT = 32


def _byte_of_char() -> dict[str, int]:
    """Byte of each character in byte-level entries: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Tokenises and aligns units, and keeps what it found for known ones in flat arrays."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        byte = _byte_of_char()
        a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            if all(c in byte for c in entry):
                a_bytes[i] = bytes([byte[c] for c in entry])
        self.b = SentencePieceProcessor(model_file=pieces)
        b_bytes, texts = [], []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                b_bytes.append(piece.replace(MARK, " ").encode())
                texts.append(piece)
        self.bytes_of = [np.array(t, object) for t in (a_bytes, b_bytes)]
        self.length_of = [np.array([len(x) for x in t]) for t in (a_bytes, b_bytes)]
        # Ids as text inside and at the end of their side of a group.
        self.inner = [np.array([f"{i}," for i in range(len(t))], object) for t in (a_bytes, b_bytes)]
        self.last = [np.array([f"{i}{end}" for i in range(len(t))], object) for t, end in ((a_bytes, "|"), (b_bytes, ";"))]
        self.mark = self.b.piece_to_id(MARK)
        joined = all(re.fullmatch(f"{MARK}*[^{MARK}]*", p) for p in texts)
        used = set("".join(texts))
        begins = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{_SPACES}]", c) and c not in used) if joined else ""
        inner = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{_SPACES}]", c) and c not in begins)
        space, other, inside = f"[{_SPACES}]", f"[^{_SPACES}]", f"[{re.escape(inner)}]"
        self.unit = re.compile(rf"(?s:.){space}*{other}*(?:{inside}{space}*{other}*)*") if joined else re.compile(r"(?s:.+)")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((4, 0), np.int64)  # tokens of A and B, groups, links; -1 tokens if bytes differ
        self.first, self.pairs, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = 0

    def tokens(self, units: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both tokenizers for units, which begin with white space."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # The model adds a space of its own.
        b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for unit, x, y in zip(units, a, b):
            if unit == " ":
                y = [self.mark]
            elif unit[0] != " ":
                y = y[1:] if y[:1] == [self.mark] else []
            yield x, y

    def _learn(self, units: list[str]) -> None:
        """Adds units: their sizes, groups as text, and distinct pairs with their numbers of links."""
        found = list(zip(*self.tokens(units)))
        raws = [u.encode() for u in units]
        kept = np.arange(len(units))
        ids, owners = in_a_row(found, kept)
        for same in (self._same_length, self._same_bytes):  # bytes in a row can be compared once lengths agree
            fits = same([raws[i] for i in kept.tolist()], [np.searchsorted(kept, o) for o in owners], ids)
            if not fits.all():
                kept = kept[fits]
                ids, owners = in_a_row(found, kept)
        good = np.zeros(len(units), bool)
        good[kept] = True
        ends = [np.cumsum(self.length_of[side][ids[side]]) for side in (0, 1)]
        cut = aligned_ends(*ends)
        group = [np.cumsum(c) - c for c in cut]
        n_groups = int(cut[0].sum())
        tokens = [np.bincount(g, minlength=n_groups) for g in group]
        before = [np.cumsum(t) - t for t in tokens]
        links = tokens[0] * tokens[1]
        holder = owners[0][cut[0]]
        sizes = np.zeros((4, len(units)), np.int64)
        sizes[0, ~good] = -1
        for row, at, add in ((0, owners[0], 1), (1, owners[1], 1), (2, holder, 1), (3, holder, links)):
            np.add.at(sizes[row], at, add)

        place = [np.arange(len(ids[0])) + before[1][group[0]], np.arange(len(ids[1])) + (before[0] + tokens[0])[group[1]]]
        words = np.empty(len(ids[0]) + len(ids[1]), object)
        for side in (0, 1):
            words[place[side]] = np.where(cut[side], self.last[side][ids[side]], self.inner[side][ids[side]])
        words, stop = words.tolist(), np.cumsum(np.where(good, sizes[0] + sizes[1], 0)).tolist()
        texts = ["".join(words[i:j])[:-1] for i, j in zip([0, *stop], stop)]

        unit, pair, times = linked_pairs(ids, tokens, before, links, holder)
        count = np.bincount(unit, minlength=len(units))
        self.known.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        self.groups += texts
        self.sizes = np.concatenate([self.sizes, sizes], 1)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(count)])
        self.pairs, self.times = np.concatenate([self.pairs, pair]), np.concatenate([self.times, times])
        self.bytes += 250 * len(units) + sum(map(len, raws)) + sum(map(len, texts)) + 16 * len(pair)

    def _same_length(self, raws: list[bytes], owners: list[np.ndarray], ids: list[np.ndarray]) -> np.ndarray:
        total = [np.bincount(owners[side], self.length_of[side][ids[side]], len(raws)) for side in (0, 1)]
        want = np.array([len(r) for r in raws])
        return (total[0] == want) & (total[1] == want)

    def _same_bytes(self, raws: list[bytes], owners: list[np.ndarray], ids: list[np.ndarray]) -> np.ndarray:
        raw = np.frombuffer(b"".join(raws), np.uint8)
        of_byte = np.repeat(np.arange(len(raws)), [len(r) for r in raws])
        fits = np.ones(len(raws), bool)
        for side in (0, 1):
            data = np.frombuffer(b"".join(self.bytes_of[side][ids[side]].tolist()), np.uint8)
            fits[of_byte[data != raw]] = False
        return fits

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Measures of each text (n_a, n_b, n_groups, n_links, groups), and its distinct pairs: (owner, pair, times)."""
        if self.bytes > UNIT_BYTES:
            self.clear()
        split = [self.unit.findall(" " + t) for t in texts]
        new = [u for u in dict.fromkeys(u for units in split for u in units) if u not in self.known]
        if new:
            self._learn(new)
        known, groups = self.known, self.groups
        numbers = [[known[u] for u in units] for units in split]
        flat = np.array([n for ns in numbers for n in ns], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(ns) for ns in numbers])
        sizes = self.sizes[:, flat]
        broken = np.bincount(owner, sizes[0] < 0, len(texts)) > 0
        sums = [np.bincount(owner, s, len(texts)).astype(np.int64) for s in sizes]
        rows = [
            (0, 0, 0, 0, "") if bad else (*n, ";".join([groups[i] for i in ns]))
            for bad, ns, *n in zip(broken.tolist(), numbers, *[s.tolist() for s in sums])
        ]
        # Distinct units of each text, then the pairs of those.
        width = len(groups)
        keys, times = np.unique(owner * width + flat, return_counts=True)
        holder, unit = keys // width, keys % width
        whole = ~broken[holder]
        holder, unit, times = holder[whole], unit[whole], times[whole]
        n = self.first[unit + 1] - self.first[unit]
        at = np.repeat(self.first[unit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return rows, *summed(np.repeat(holder, n), self.pairs[at], np.repeat(times, n) * self.times[at])


def in_a_row(found: list[tuple[list[int], ...]], kept: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of the kept units of both sides in a row, and the unit of each."""
    chosen = [[side[i] for i in kept.tolist()] for side in found]
    ids = [np.fromiter(chain.from_iterable(lists), np.int64) for lists in chosen]
    return ids, [np.repeat(kept, [len(x) for x in lists]) for lists in chosen]


def summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order of owner and pair, equal ones as one with the sum of their times."""
    order = np.lexsort((pair, owner))
    owner, pair, times = owner[order], pair[order], times[order]
    fresh = np.ones(len(pair), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
    begin = np.flatnonzero(fresh)
    return owner[begin], pair[begin], np.add.reduceat(times, begin) if len(begin) else times


def aligned_ends(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """For the ascending byte offsets where tokens of each side end: which are ends of tokens of the other side too."""
    out = []
    for x, y in ((a, b), (b, a)):
        at = np.searchsorted(y, x)
        out.append(np.append(y, -1)[at] == x)
    return out


def linked_pairs(
    ids: list[np.ndarray], tokens: list[np.ndarray], before: list[np.ndarray], links: np.ndarray, holder: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids with their numbers of links per holder; a pair is one number with the first id in the upper half.

    ``tokens`` and ``before`` give the tokens of each group and those ahead of it on both sides. Links of small groups are
    listed; those of larger ones are products of how often their ids occur.
    """
    small = links <= SMALL_GROUP
    n = np.where(small, links, 0)
    group = np.repeat(np.arange(len(links)), n)
    k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    left = ids[0][before[0][group] + k // tokens[1][group]]
    right = ids[1][before[1][group] + k % tokens[1][group]]
    parts = [(holder[group], left << _SHIFT | right, np.ones(len(group), np.int64))]
    for g in np.flatnonzero(~small).tolist():
        x, m = np.unique(ids[0][before[0][g] : before[0][g] + tokens[0][g]], return_counts=True)
        y, n = np.unique(ids[1][before[1][g] : before[1][g] + tokens[1][g]], return_counts=True)
        pair = (x[:, None] << _SHIFT | y).ravel()
        parts.append((np.full(len(pair), holder[g]), pair, (m[:, None] * n).ravel()))
    return summed(*[np.concatenate(c) for c in zip(*parts)])


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_level: str | None = None, pieces: str | None = None) -> Aligner:
    """One per Python worker, so that units stay known from task to task."""
    if byte_level is None or pieces is None:
        import public_tokenizers

        byte_level = byte_level or public_tokenizers.path(BYTE_LEVEL)
        pieces = pieces or public_tokenizers.path(PIECES)
    if (byte_level, pieces) not in _aligners:
        _aligners[byte_level, pieces] = Aligner(byte_level, pieces)
    return _aligners[byte_level, pieces]


MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
_TEXT_SCHEMA = "text_key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def align_texts(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, keep_groups: bool = False) -> DataFrame:
    """One row per distinct text: its SHA-256, multiplicity, measures and linked pairs of ids with their numbers of links.

    A pair is one number, the byte-level id times 2**32 plus the piece id. With ``keep_groups`` the groups themselves are kept as text
    (``a1,a2|b1;a3|b2,b3``). The tokenizers are files that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_level, pieces)
        for batch in batches:
            for part in batches_of(batch, "text", STEP_BYTES):
                texts = part.column("text").to_pylist()
                rows, holder, pair, times = tool.align(texts)
                where = np.searchsorted(holder, np.arange(len(texts) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(where), pa.array(v, pa.int64())) for v in (pair, times)]
                digests = [hashlib.sha256(r[4].encode()).hexdigest() if r[4] else "" for r in rows]
                columns = [
                    part.column("text_key"),
                    part.column("copies"),
                    *[pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                    pa.array(digests, pa.string()),
                    *lists,
                    *([pa.array([r[4] for r in rows], pa.string())] if keep_groups else []),
                ]
                yield pa.record_batch(columns, names=names)

    names = ["text_key", "copies", *MEASURES, "groups_sha256", "pairs", "times", *(["groups"] if keep_groups else [])]
    schema = _TEXT_SCHEMA + ", pairs array<long>, times array<long>" + (", groups string" if keep_groups else "")
    texts = docs.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return texts.select("text", F.sha2("text", 256).alias("text_key"), "copies").mapInArrow(run, schema)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, documents, best) from written `align_texts`: in how many documents a pair is linked, and whether no other of its first id is in more."""
    linked = texts.select("copies", F.explode("pairs").alias("pair"))
    counts = stage(linked.groupBy("pair").agg(F.sum("copies").alias("documents")), "pair-counts")
    first = F.shiftright("pair", _SHIFT).alias("first")
    highest = counts.groupBy(first).agg(F.max("documents").alias("highest"))
    joined = counts.withColumn("first", first).join(highest, "first")
    return joined.select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def link_measures(texts: DataFrame, counts: DataFrame, heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """(text_id, n_best, count_sum) of written texts with ``text_id``: links whose pair is best, and documents summed over links."""
    total = counts.agg(F.sum("documents")).first()[0] or 0
    heavy = counts.where(F.col("documents") * heavy_pairs >= F.lit(total)).orderBy("pair").collect()
    table = np.array([tuple(r) for r in heavy], np.int64).reshape(-1, 3)
    shared = texts.sparkSession.sparkContext.broadcast(table)  # at most heavy_pairs rows of three numbers

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, documents, best = shared.value.T
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            n = pairs.value_lengths().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(n)), n)
            pair, many = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            here = at[hit]
            sums = np.zeros((2, len(n)), np.int64)
            np.add.at(sums[0], owner[hit], many[hit] * best[here])
            np.add.at(sums[1], owner[hit], many[hit] * documents[here])
            where = np.searchsorted(owner[~hit], np.arange(len(n) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(where), pa.array(v[~hit], pa.int64())) for v in (pair, many)]
            yield pa.record_batch(
                [batch.column("text_id"), pa.array(sums[0]), pa.array(sums[1]), *lists],
                names=["text_id", "n_best", "count_sum", "pairs", "times"],
            )

    schema = "text_id long, n_best long, count_sum long, pairs array<long>, times array<long>"
    resolved = stage(texts.select("text_id", "pairs", "times").mapInArrow(resolve, schema), "resolved")
    rest = resolved.select("text_id", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    rest = rest.select("text_id", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n")).join(counts, "pair")
    light = rest.groupBy("text_id").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("documents")).alias("count_sum"),
    )
    both = resolved.select("text_id", "n_best", "count_sum").unionByName(light)
    return both.groupBy("text_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """One row per document with the measures of its text."""
    texts = stage(align_texts(docs, byte_level, pieces).withColumn("text_id", F.monotonically_increasing_id()), "aligned")
    counts = stage(pair_counts(texts), "pairs-best")
    found = texts.select("text_key", "copies", *MEASURES, "groups_sha256", "text_id").join(
        link_measures(texts, counts, heavy_pairs), "text_id"
    )
    values = [*MEASURES, "n_best", "count_sum", "groups_sha256"]
    found = stage(found.select("text_key", "copies", *values), "text-measures")
    total = found.agg(F.sum("copies")).first()[0] or 0
    # At most HEAVY_TEXTS texts can be so frequent; the others are joined by their digest.
    often = F.col("copies") * HEAVY_TEXTS >= F.lit(total)
    heavy = F.broadcast(found.where(often).select("text_key", F.struct(*values).alias("_m")))
    seldom = found.where(~often).select("text_key", *values)

    present = F.length("text") > 0
    own = docs.where(present).select(F.col("doc_id").cast("long"), F.sha2("text", 256).alias("text_key"))
    marked = own.join(heavy, "text_key", "left")
    fast = marked.where(F.col("_m").isNotNull()).select("doc_id", *[F.col(f"_m.{v}").alias(v) for v in values])
    slow = marked.where(F.col("_m").isNull()).select("doc_id", "text_key").join(seldom, "text_key")
    zeros = [F.lit(0).cast("long").alias(v) for v in values[:-1]]
    empty = docs.where(~F.coalesce(present, F.lit(False))).select(F.col("doc_id").cast("long"), *zeros, F.lit("").alias("groups_sha256"))
    return fast.unionByName(slow.select("doc_id", *values)).unionByName(empty)
