"""Best-fit packing of tokenised documents into sequences of bounded length.

A document's tokens are the ids of its text (null: none) and a final 0. Only longer documents are cut. What has to
be packed is described completely by the number of pieces per length, at most ``capacity`` rows at any input size;
these are reduced and packed on the driver:

1. *Martello-Toth dominance*: for a length ``j`` let ``k`` be the longest other piece that still fits beside
   it. ``{j}`` alone dominates if nothing fits, ``{j, k}`` if they fill the sequence, if no two pieces fit
   beside ``j``, or if no three fit and ``k`` is at least as long as the best pair. Such sets are fixed, as many
   as there are, and the check goes on over the smaller instance.
2. *Best fit* of what remains, longest first, all pieces of one length at a time.

Pieces then find their place by their rank among the pieces of equal length. Ranks come from windows over
(length, salt), so a length that a third of all pieces share is spread over the salts.

Repeated rows are packed as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidedock.llm.tables import stage
from tidedock.llm.textbytes import batches_of, trimmed

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"

#: Bytes of known units per generation, and of the texts of one step.
CACHE_BYTES, STEP_BYTES = 24 << 20, 8 << 20

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

# --- tokens -----------------------------------------------------------------------------------------------------

#: What the tokenizer's normalizer takes as white space.
_SPACES = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
#: Letters of which the normalizer makes a letter and a mark; the mark joins punctuation behind it.
_MARKED = (
    "[\u0130\u0958-\u095f\u09dc-\u09dd\u09df\u0a33\u0a36\u0a59-\u0a5b\u0a5e"
    "\u0b5c-\u0b5d\u0f43\u0f4d\u0f52\u0f57\u0f5c\u0f69\ufb1d\ufb1f\ufb2a-\ufb36\ufb38-\ufb3c\ufb3e\ufb40-\ufb41\ufb43-\ufb44\ufb46-\ufb4e]"
)
#: A unit that stands between others where they are encoded in one call; a unit that holds it is encoded alone.
_MARK = "\0"


def _known(units: pa.Array | None = None, ids: pa.Array | None = None) -> pa.Table:
    columns = [pa.array([], pa.large_string()) if units is None else units, pa.array([], pa.large_binary()) if ids is None else ids]
    return pa.table(columns, names=["unit", "ids"])


def _runs(ids: pa.Array, firsts: np.ndarray) -> pa.Array:
    """Runs of ``ids`` in a row; a run begins at its entry of ``firsts`` and ends where the next one begins."""
    _, offsets, data = ids.buffers()
    ends = np.frombuffer(offsets, np.int64)[firsts + ids.offset] if len(ids) else np.zeros(len(firsts), np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(firsts) - 1, [None, pa.py_buffer(ends), data or pa.py_buffer(b"")])


class WordIds:
    """Token ids of texts by way of their words, as little-endian bytes.

    The tokenizer never joins across white space, so a text's ids are those of its words in a row. Words are cut at ASCII white
    space; one that holds other white space is the words around that in a row. A word of letters with punctuation behind it is
    the two in a row as well, and case is dropped. What is left are the units. All of this is done by Arrow, over the
    distinct words of a step; only units not known yet are handled one by one. Known units are Arrow columns too, in two
    generations of about ``limit`` bytes each; the older is forgotten when the younger is full. A step looks its units up
    by a hash table over both, so it should hold many texts.

    With ``plain`` the tokenizer's added tokens are text like any other; without, as the tokenizer does when loaded, each is one
    id wherever it occurs. They hold no white space, so an occurrence lies in one word.
    """

    def __init__(self, path: str, limit: int = CACHE_BYTES, plain: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.limit = limit
        self.young, self.old = _known(), _known()
        self.bytes = 0

    def _learn(self, units: list[str], found: dict[str, bytes]) -> None:
        letters = [u for u in units if u.isalpha()]
        if letters:
            # Each is one unit, so ids with an end-of-word mark tell them apart.
            (e,) = self.tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)
            ids = np.array(e.ids, np.uint32)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            raw = ids.astype("<u4").tobytes()
            if len(cuts) == len(letters):
                begin = 0
                for unit, end in zip(letters, cuts.tolist()):
                    found[unit] = raw[begin:end]
                    begin = end
            else:
                units = letters + [u for u in units if not u.isalpha()]
                letters = []
        rest = [u for u in units if not u.isalpha()] if letters else units
        if rest and self.mark is not None:
            # One call is much cheaper than one per unit; a mark of its own behind each tells them apart.
            (e,) = self.tokenizer.encode_batch_fast([f" {_MARK} ".join([*rest, ""])], add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) == len(rest):
                raw, begin = ids.tobytes(), 0
                for unit, end in zip(rest, (cuts * 4).tolist()):
                    found[unit] = raw[begin:end]
                    begin = end + 4
                return
        for unit, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            found[unit] = np.array(e.ids, "<u4").tobytes()

    def _unit_ids(self, units: pa.Array) -> pa.Array:
        """Ids of distinct units, which ``young`` holds afterwards."""
        if self.bytes > self.limit:
            self.old, self.young, self.bytes = self.young, _known(), 0
        known = pa.concat_tables([self.young, self.old])
        at = pc.index_in(units, value_set=known["unit"])
        todo = units.filter(pc.is_null(at))
        learned = []
        for i in range(0, len(todo), 2000):
            block, found = todo.slice(i, 2000).to_pylist(), {}
            self._learn(block, found)
            learned.append(pa.array([found[u] for u in block], pa.large_binary()))
        place = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        place[place < 0] = len(known) + np.arange(len(todo))
        ids = pa.concat_arrays([*known["ids"].chunks, *learned]).take(pa.array(place))
        fresh = pa.array(place >= len(self.young))
        added = _known(units.filter(fresh), ids.filter(fresh))
        self.young = pa.concat_tables([self.young, added]).combine_chunks()
        self.bytes += added.nbytes
        return ids

    def _word_ids(self, words: pa.Array) -> pa.Array:
        """Ids of words without ASCII white space."""
        others = words.filter(pc.invert(pc.string_is_ascii(words)))
        if pc.any(pc.match_substring_regex(others, _SPACES)).as_py():
            inner = pc.split_pattern_regex(words, _SPACES)
            firsts = np.concatenate([[0], np.cumsum(pc.list_value_length(inner).to_numpy())])
            return _runs(self._core_ids(inner.flatten()), firsts)
        return self._core_ids(words)

    def _core_ids(self, words: pa.Array) -> pa.Array:
        """Ids of words without white space."""
        core = pc.utf8_rtrim(words, ".,!?;:")
        simple = pc.and_not(pc.utf8_is_alpha(core), pc.match_substring_regex(core, _MARKED))
        _, offsets, data = words.buffers()
        starts = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        # Core and punctuation of each word by turns, over the same bytes; other words are all core.
        turns = np.repeat(starts, 2)[:-1]
        turns[1::2] += np.where(simple, pc.binary_length(core), np.diff(starts))
        halves = pa.Array.from_buffers(pa.large_string(), 2 * len(words), [None, pa.py_buffer(turns), data])
        lower = pc.if_else(pa.array(np.repeat(simple, 2)), pc.utf8_lower(halves), halves)
        units = lower.dictionary_encode()
        return _runs(self._unit_ids(units.dictionary).take(units.indices), 2 * np.arange(len(words) + 1))

    def encode(self, texts: list[str | None] | pa.Array) -> Iterator[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        words = split.flatten().dictionary_encode()
        firsts = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        if not len(words):
            yield from [b""] * len(column)
            return
        known = self._word_ids(words.dictionary.cast(pa.large_string()))
        for ids in _runs(known.take(words.indices), firsts):
            yield ids.as_py()


_encoders: dict[tuple[str, bool], WordIds] = {}


def _encoder(path: str | None, plain: bool) -> WordIds:
    """One per Python worker, so that words known from earlier tasks are not encoded again."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if (path, plain) not in _encoders:
        _encoders[path, plain] = WordIds(path, plain=plain)
    return _encoders[path, plain]


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, plain: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids; ``tokenizer`` is a file that every executor has, ``plain`` as in `WordIds`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, plain)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            # Steps of about equal size: a small rest would cost a look-up of its own.
            size = batch.column("text").nbytes
            for part in batches_of(batch, "text", int(1.1 * size / (size // STEP_BYTES + 1)) + 1):
                rows = []
                encoded = encoder.encode(part.column("text"))
                for doc_id, raw in zip(part.column("doc_id").to_pylist(), encoded):
                    raw += end
                    for k in range(0, len(raw), 4 * capacity):
                        ids = raw[k : k + 4 * capacity]
                        rows.append((doc_id, k // (4 * capacity), k // 4, len(ids) // 4, zlib.crc32(ids)))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(cut), PIECE_SCHEMA)


# --- packing of lengths -----------------------------------------------------------------------------------------


class Lengths:
    """Available lengths in order, with how many pieces have each."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sorted = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            del self.sorted[bisect_left(self.sorted, length)]

    def longest(self, room: int) -> int | None:
        at = bisect_left(self.sorted, room + 1)
        return self.sorted[at - 1] if at else None

    def shortest(self, n: int) -> list[int]:
        out: list[int] = []
        for s in self.sorted[:n]:
            out += [s] * min(self.count[s], n - len(out))
        return out[:n]

    def best_pair(self, room: int) -> int:
        """Largest sum of two pieces within ``room``, 0 if there is none."""
        low, high, best = 0, bisect_left(self.sorted, room) - 1, 0
        while 0 <= low <= high:
            a, b = self.sorted[low], self.sorted[high]
            if a + b > room or (low == high and self.count[a] < 2):
                if low == high:
                    break
                high -= 1
            else:
                best = max(best, a + b)
                low += 1
        return best


def dominating_sets(lengths: Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixes dominating sets until no more is found; takes them out of ``lengths``."""
    fixed = []
    changed = True
    while changed:
        changed = False
        for j in reversed(list(lengths.sorted)):
            while lengths.count.get(j):
                lengths.take(j, 1)  # one j in hand: the others may be its partners
                room = capacity - j
                k = lengths.longest(room)
                few = lengths.shortest(3)
                alone = k is None
                two_fit = len(few) > 1 and few[0] + few[1] <= room
                three_fit = len(few) > 2 and sum(few) <= room
                pair = not alone and (
                    k == room or not two_fit or (not three_fit and k >= lengths.best_pair(room))
                )
                left = lengths.count.get(j, 0) + 1
                lengths.count[j] = left
                if left == 1:
                    insort(lengths.sorted, j)
                if alone:
                    fixed.append(((j,), left))
                    lengths.take(j, left)
                elif pair:
                    n = left // 2 if k == j else min(left, lengths.count[k])
                    fixed.append(((j, k), n))
                    lengths.take(j, n)
                    lengths.take(k, n)
                else:
                    break
                changed = True
    return fixed


def best_fit(lengths: Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, of whole groups of equal pieces into groups of equal sequences."""
    rooms: list[int] = []
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def put(room: int, content: tuple[int, ...], n: int) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append((content, n))

    for s in reversed(lengths.sorted):
        left = lengths.count[s]
        while left:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = capacity // s
                if left >= each:
                    put(capacity - each * s, (s,) * each, left // each)
                if left % each:
                    put(capacity - left % each * s, (s,) * (left % each), 1)
                break
            room = rooms[at]
            content, n = groups[room].pop()
            if not groups[room]:
                rooms.pop(at)
            used = min(n, left)
            if n > used:
                put(room, content, n - used)
            put(room - s, (*content, s), used)
            left -= used
    return [entry for room in rooms for entry in groups[room]]


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Contents of sequences with how many sequences have each."""
    lengths = Lengths(counts)
    fixed = dominating_sets(lengths, capacity)
    return fixed + best_fit(lengths, capacity)


def placements(packed: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Runs of ranks: pieces of ``length`` with ranks from ``rank`` on go to sequences from ``sequence`` on, at ``offset``."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for content, n in packed:
        offset = 0
        for s in content:
            rows.append((s, used[s], sequence, offset))
            used[s] += n
            offset += s
        sequence += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T))


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, salts: int = 64, plain: bool = True
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``."""
    table = stage(pieces(docs, capacity, tokenizer, plain), "pieces")
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int")
    table = table.withColumn("salt", salt)
    counts = table.groupBy("length", "salt").count().collect()  # at most capacity * salts rows
    total: dict[int, int] = defaultdict(int)
    before: dict[tuple[int, int], int] = {}
    for row in sorted(counts, key=lambda r: (r["length"], r["salt"])):
        before[row["length"], row["salt"]] = total[row["length"]]
        total[row["length"]] += row["count"]
    first = np.zeros((capacity + 1) * salts, np.int64)
    for (length, number), n in before.items():
        first[length * salts + number] = n
    places = placements(pack_lengths(dict(total), capacity))
    shift = np.int64(1) << np.int64(50)

    same = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = table.withColumn("rank", F.row_number().over(same) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = places["length"] * shift + places["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + first[length * salts + batch.column("salt").to_numpy()]
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            sequence = places["sequence"][at] + rank - places["rank"][at]
            columns = [batch.column(i) for i in range(5)]
            yield pa.record_batch(
                [*columns, pa.array(sequence), pa.array(places["offset"][at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "salt", "rank").mapInArrow(
        place, PIECE_SCHEMA + ", sequence_id long, offset long"
    )
