"""Removal of byte strings that occur in a document with a smaller id, by suffix sorting.

Every window of ``span`` bytes that also starts in a document with a smaller ``doc_id`` is removed; windows may
overlap and are judged on the input. Only a part of all suffixes is sorted:

1. The *key* of a window is the least hash of its ``gram``-byte substrings, so equal windows have equal keys.
   Neighbouring windows with the same key form a *run*, about one per 16 bytes. Each task sends a key
   at most once unless it is new to it; a key found in two documents marks its runs (`shared_runs`).
2. The bytes of marked runs, each different one once per task, meet by key and are suffix-sorted by hash comparison
   (`suffixes`): first whole runs, then, where runs of one key differ, all their windows. Equal neighbours in the
   order have the same window; all but those in the smallest document are removed (`repeated_stretches`).
3. Stretches are united per document (`remove_repeats`).

Keys with at least ``HOT_RUNS`` runs (found in step 1) are broadcast and cut into single windows that meet
by their own hash, so no group grows with one frequent passage. At most ``HOT_KEYS`` keys, those with most runs, are
broadcast; further ones are sorted like all others. The number of buckets follows the bytes of the texts, so a bucket, which
a task holds whole, does not grow with the table. Nothing is sampled or capped.

Null text is empty and a null id counts as smaller than all others. Rows with equal ``doc_id`` never remove
anything from each other; each row is judged by its own text. Texts shorter than ``span`` bytes stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidedock.llm.suffixes import Prefixes, running_sums, suffix_sort, tables
from tidedock.llm.tables import shuffle_partitions, stage, text_or_empty
from tidedock.llm.textbytes import batches_of, flat, mix, trimmed

SPAN = 50
GRAM = 20
#: Longest run, in windows, that travels as one record.
MAX_RUN = 64
#: Runs from which a key counts as hot, whatever the size of the table.
HOT_RUNS = 20_000
#: Most hot keys that are broadcast (8 bytes each).
HOT_KEYS = 1_000_000
#: Bytes of text per shuffle partition, each of two buckets; their keys and marked runs take about as much.
PARTITION_BYTES = 64 << 20

_KEY = np.uint64(0xA0761D6478BD642F)
_NULL_ID = -(2**63)
#: Texts of one step of a task.
STEP_BYTES = 1 << 20


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


def window_runs(
    data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM, block: int = 1 << 18
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and key of every run, in order of position."""
    valid = np.ones(len(data), bool)
    for k in range(1, span):
        at = offsets[1:] - k
        valid[at[at >= 0]] = False
    power, inverse = tables(block + span)
    starts, ends, keys = [], [], []
    for low in range(0, len(data), block):
        part = data[low : low + block + span - 1]
        n = len(part) - span + 1
        if n <= 0 or not valid[low : low + n].any():
            continue
        ok = valid[low : low + n]
        sums = running_sums(part, power)
        grams = mix((sums[gram:] - sums[:-gram]) * inverse[: len(part) - gram + 1])
        least = _sliding_min(grams, span - gram + 1)
        change = least[1:] != least[:-1]
        first, last = ok.copy(), ok.copy()
        first[1:] &= ~ok[:-1] | change
        last[:-1] &= ~ok[1:] | change
        begin, end = np.flatnonzero(first), np.flatnonzero(last)
        starts.append(begin + low)
        ends.append(end + low)
        keys.append(mix(least[begin] ^ _KEY))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start, end, key = np.concatenate(starts), np.concatenate(ends), np.concatenate(keys)
    # A run that a block's border has cut is one run: numbers must not depend on what else is in a batch.
    whole = np.r_[True, (start[1:] != end[:-1] + 1) | (key[1:] != key[:-1])]
    end = end[np.r_[np.flatnonzero(whole)[1:], len(end)] - 1] if len(end) else end
    start, key = start[whole[: len(start)]], key[whole[: len(key)]]
    parts = (end - start) // MAX_RUN + 1
    if parts.max() > 1:  # periodic text
        inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, end, key = np.repeat(start, parts) + inside * MAX_RUN, np.repeat(end, parts), np.repeat(key, parts)
        end = np.minimum(end, start + MAX_RUN - 1)
    return start, end, key


def _numbers(first_of: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Number of each run within its document."""
    return np.arange(len(owner)) - first_of[owner]


def _runs_of_batch(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    data, offsets = flat(batch.column("text"))
    start, end, key = window_runs(data, offsets)
    owner = np.searchsorted(offsets, start, side="right") - 1
    first_of = np.searchsorted(start, offsets[:-1])
    return data, offsets, start, end, key, owner, _numbers(first_of, owner)


def _blob(a: np.ndarray) -> bytes:
    return a.tobytes()


# --- 1: keys that occur in two documents -----------------------------------------------------------------------

_KEY_ROWS = "bucket int, keys binary, docs binary, numbers binary, counts binary, found_docs binary, found_numbers binary"
_FOUND = "doc long, number int, hot_key long"


def _send_keys(key: np.ndarray, doc: np.ndarray, number: np.ndarray, buckets: int, turn: int) -> pa.RecordBatch:
    """One row per bucket. Keys of two documents in hand are settled here but still announced once."""
    order = np.lexsort((doc, key))
    key, doc, number = key[order], doc[order], number[order]
    new = np.r_[True, key[1:] != key[:-1]]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    new_doc = new | np.r_[True, doc[1:] != doc[:-1]]
    n_docs = np.add.reduceat(new_doc.astype(np.int64), first)
    several = n_docs[group] > 1
    send = ~several | new
    bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
    rows: dict[str, list] = {c.split()[0]: [] for c in _KEY_ROWS.split(", ")}
    at = np.flatnonzero(send)
    at = at[np.argsort(bucket[at], kind="stable")]
    cuts = np.searchsorted(bucket[at], np.arange(buckets + 1))
    found = np.flatnonzero(several)
    shares = np.array_split(found, buckets)
    for b in range(buckets):
        part = at[cuts[b] : cuts[b + 1]]
        share = shares[(b + turn) % buckets]
        if not len(part) and not len(share):
            continue
        rows["bucket"].append(b)
        rows["keys"].append(_blob(key[part]))
        rows["docs"].append(_blob(doc[part]))
        rows["numbers"].append(_blob(number[part].astype(np.int32)))
        rows["counts"].append(_blob(n_docs[group[part]].astype(np.int32)))
        rows["found_docs"].append(_blob(doc[share]))
        rows["found_numbers"].append(_blob(number[share].astype(np.int32)))
    kinds = [pa.int32()] + [pa.binary()] * 6
    return pa.record_batch([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))


def _joined(table: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(column)), kind)


def _shared_keys(hot_limit: int):
    def reduce(table: pa.Table) -> pa.Table:
        key = _joined(table, "keys", np.uint64)
        doc = _joined(table, "docs", np.int64)
        number = _joined(table, "numbers", np.int32)
        count = _joined(table, "counts", np.int32)
        order = np.lexsort((doc, key))
        key, doc, number, count = key[order], doc[order], number[order], count[order]
        hot, hot_size = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        docs, numbers = np.zeros(0, np.int64), np.zeros(0, np.int32)
        if len(key):
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            last = first + size - 1
            shared = (doc[first] != doc[last]) | (np.maximum.reduceat(count, first) > 1)
            marked = np.repeat(shared, size) & (count == 1)
            docs, numbers = doc[marked], number[marked]
            runs = np.add.reduceat(count.astype(np.int64), first)
            hot, hot_size = key[first][runs >= hot_limit], np.minimum(runs[runs >= hot_limit], 2**31 - 1)
        docs = np.r_[docs, _joined(table, "found_docs", np.int64)]
        numbers = np.r_[numbers, _joined(table, "found_numbers", np.int32)]
        # One row without document per hot key; its number is that of the key's runs.
        return pa.table(
            {
                "doc": pa.array(np.r_[docs, np.zeros(len(hot), np.int64)], mask=np.r_[np.zeros(len(docs), bool), np.ones(len(hot), bool)]),
                "number": pa.array(np.r_[numbers, hot_size].astype(np.int32)),
                "hot_key": pa.array(np.r_[np.zeros(len(docs), np.int64), hot.view(np.int64)], mask=np.r_[np.ones(len(docs), bool), np.zeros(len(hot), bool)]),
            }
        )

    return reduce


def shared_runs(docs: DataFrame, partitions: int, hot_limit: int, flush: int = 1 << 19) -> DataFrame:
    """(doc, number) of runs whose key occurs in two documents; and rows with a ``hot_key``."""
    buckets = 2 * partitions

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = turn = 0
        for batch in batches:
            for part in batches_of(batch, "text", STEP_BYTES):
                _, _, _, _, key, owner, number = _runs_of_batch(part)
                held.append((key, part.column("doc").to_numpy()[owner], number))
                size += len(key)
                if size >= flush:
                    yield _send_keys(*map(np.concatenate, zip(*held)), buckets, turn)
                    held, size, turn = [], 0, turn + 1
        if size:
            yield _send_keys(*map(np.concatenate, zip(*held)), buckets, turn)

    rows = docs.select(_doc().alias("doc"), "text").mapInArrow(trimmed(keys_of), _KEY_ROWS)
    return rows.repartition(partitions, "bucket").groupBy("bucket").applyInArrow(_shared_keys(hot_limit), _FOUND)


# --- 2: marked runs meet and are sorted -------------------------------------------------------------------------

_RUN_ROWS = "bucket int, keys binary, docs binary, versions binary, starts binary, sizes binary, bytes binary, done binary"
_STRETCHES = "doc long, version long, start long, stop long"


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes of the given stretches one after another."""
    if not len(start):
        return np.zeros(0, np.uint8)
    first = np.cumsum(size) - size
    return data[np.arange(size.sum()) - np.repeat(first, size) + np.repeat(start, size)]


def _settle(data, key, doc, start, size):
    """Which runs are byte for byte equal to one of a smaller document in hand, and which stay to be sent."""
    digest = Prefixes(data).hash(start, size)
    order = np.lexsort((start, doc, digest, key))
    k, g, z = key[order], digest[order], size[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (g[1:] != g[:-1]) | (z[1:] != z[:-1])]
    first = np.flatnonzero(new)
    leader = order[first][np.cumsum(new) - 1]
    later = doc[order] > doc[leader]
    mine, theirs = order[later], leader[later]
    done = np.zeros(len(key), bool)
    for at in range(0, len(mine), 1 << 13):
        a, b = mine[at : at + (1 << 13)], theirs[at : at + (1 << 13)]
        unequal = _gather(data, start[a], size[a]) != _gather(data, start[b], size[b])
        done[a] = ~np.logical_or.reduceat(unequal, np.cumsum(size[a]) - size[a])
    return done


def _send_runs(held: list[tuple[np.ndarray, ...]], buckets: int, span: int, turn: int) -> pa.RecordBatch:
    data = np.concatenate([h[0] for h in held])
    key, route, doc, version, start, size = (np.concatenate([h[i] for h in held]) for i in range(1, 7))
    at_byte = np.cumsum(size) - size
    done = _settle(data, key, doc, at_byte, size)
    bucket = (route % np.uint64(buckets)).astype(np.int64)
    send = np.flatnonzero(~done)
    send = send[np.lexsort((key[send], bucket[send]))]
    cuts = np.searchsorted(bucket[send], np.arange(buckets + 1))
    # Settled stretches are united as far as they touch and spread over the buckets.
    gone = np.flatnonzero(done)
    gone = gone[np.lexsort((start[gone], version[gone], doc[gone]))]
    stretches = united(doc[gone], version[gone], start[gone], (start + size)[gone])
    shares = np.array_split(np.stack(stretches, 1), buckets)
    rows: dict[str, list] = {c.split()[0]: [] for c in _RUN_ROWS.split(", ")}
    for b in range(buckets):
        part = send[cuts[b] : cuts[b + 1]]
        share = shares[(b + turn) % buckets]
        if not len(part) and not len(share):
            continue
        rows["bucket"].append(b)
        rows["keys"].append(_blob(key[part]))
        rows["docs"].append(_blob(doc[part]))
        rows["versions"].append(_blob(version[part]))
        rows["starts"].append(_blob(start[part]))
        rows["sizes"].append(_blob(size[part].astype(np.uint8)))
        rows["bytes"].append(_blob(_gather(data, at_byte[part], size[part])))
        rows["done"].append(_blob(share))
    kinds = [pa.int32()] + [pa.binary()] * 7
    return pa.record_batch([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))


def united(doc, version, start, stop) -> tuple[np.ndarray, ...]:
    """Unions of overlapping or touching stretches; input ordered by document, version and start."""
    if not len(doc):
        return doc, version, start, stop
    other = np.r_[True, (doc[1:] != doc[:-1]) | (version[1:] != version[:-1])]
    owner = np.cumsum(other)
    wide = np.int64(1) << np.int64(40)  # longer than any text: keeps the running maximum within its document
    reach = np.maximum.accumulate(stop + owner * wide) - owner * wide
    new = other.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], version[first], start[first], reach[last]


def _explode_windows(start, size, span):
    """Single windows of runs: index of the run and first byte."""
    n = size - span + 1
    run = np.repeat(np.arange(len(size)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return run, inside, start[run] + inside


def _least_per_class(order: np.ndarray, equal: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix the number of its class and the smallest document of the class."""
    first = np.flatnonzero(~equal)
    number = np.cumsum(~equal) - 1
    least = np.minimum.reduceat(doc[order], first)[number]
    of, low = np.empty(len(order), np.int64), np.empty(len(order), doc.dtype)
    of[order], low[order] = number, least
    return of, low


def _repeats_in(data, key, doc, version, start, size, span):
    """Stretches of the given runs (ordered by key, bytes in ``data`` in that order) that a smaller document has."""
    at = np.cumsum(size) - size
    order, equal = suffix_sort(data, at, size)
    kind, low = _least_per_class(order, equal, doc)
    whole = doc > low
    out = [(doc[whole], version[whole], start[whole], (start + size)[whole])]
    # One run of each class goes on where its key has several classes: the others are removed or of the same document.
    first = np.r_[True, key[1:] != key[:-1]]
    group = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    mixed = (np.maximum.reduceat(kind, begin) != np.minimum.reduceat(kind, begin))[group]
    some_docs = (np.maximum.reduceat(doc, begin) != np.minimum.reduceat(doc, begin))[group]
    rest = np.flatnonzero(mixed & some_docs & ~whole)
    if len(rest):
        run, inside, byte = _explode_windows(at[rest], size[rest], span)
        order, equal = suffix_sort(data, byte, np.full(len(byte), span, np.int64))
        _, low = _least_per_class(order, equal, doc[rest][run])
        hit = doc[rest][run] > low
        who, where = rest[run[hit]], inside[hit]
        out.append((doc[who], version[who], start[who] + where, start[who] + where + span))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sort_runs(span: int, limit: int = 1 << 20):
    def reduce(table: pa.Table) -> pa.Table:
        key = _joined(table, "keys", np.uint64)
        doc, version, start = (_joined(table, c, np.int64) for c in ("docs", "versions", "starts"))
        size = _joined(table, "sizes", np.uint8).astype(np.int64)
        data = _joined(table, "bytes", np.uint8)
        done = _joined(table, "done", np.int64).reshape(-1, 4)
        out = [tuple(done.T)]
        byte = np.cumsum(size) - size
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order][1:] != key[order][:-1]] if len(key) else np.zeros(0, bool)
        groups = np.flatnonzero(new)
        sums = np.r_[0, np.cumsum(size[order])]
        g = 0
        while g < len(groups):  # whole groups, about ``limit`` bytes at a time
            begin = groups[g]
            stop = int(np.searchsorted(sums[groups], sums[begin] + limit, side="right"))
            g = max(stop, g + 1)
            part = order[begin : groups[g] if g < len(groups) else len(order)]
            out.append(
                _repeats_in(_gather(data, byte[part], size[part]), key[part], doc[part], version[part], start[part], size[part], span)
            )
        doc, version, start, stop = (np.concatenate(x) for x in zip(*out))
        by = np.lexsort((start, version, doc))
        doc, version, start, stop = united(doc[by], version[by], start[by], stop[by])
        return pa.table({"doc": doc, "version": version, "start": start, "stop": stop})

    return reduce


def repeated_stretches(docs: DataFrame, found: DataFrame, hot: np.ndarray, partitions: int, flush: int = 3 << 20) -> DataFrame:
    """(doc, version, start, stop) of byte stretches to remove; several rows per document, which may overlap."""
    buckets = 2 * partitions
    marks = found.where("doc IS NOT NULL").groupBy("doc").agg(F.collect_list("number").alias("numbers"))
    rows = docs.select(_doc().alias("doc"), F.xxhash64(text_or_empty()).alias("version"), "text").join(marks, "doc")

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        total = turn = 0
        for batch in batches:
            for part in batches_of(batch, "text", STEP_BYTES):
                data, offsets, start, end, key, owner, number = _runs_of_batch(part)
                column = part.column("numbers")
                lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
                wanted = lists.flatten().to_numpy()
                wanted_of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                first_of = np.searchsorted(start, offsets[:-1])
                n_of = np.searchsorted(start, offsets[1:]) - first_of
                # A number beyond the runs of its row comes from another row with the same id.
                fits = wanted < n_of[wanted_of]
                chosen = np.unique(first_of[wanted_of[fits]] + wanted[fits])
                s, z, k, o = start[chosen], end[chosen] + SPAN - start[chosen], key[chosen], owner[chosen]
                route = mix(k)
                if len(hot):
                    is_hot = np.isin(k, hot)
                    run, _, byte = _explode_windows(s[is_hot], z[is_hot], SPAN)
                    hashes = mix(Prefixes(data).hash(byte, SPAN)) if len(byte) else np.zeros(0, np.uint64)
                    s, z = np.r_[s[~is_hot], byte], np.r_[z[~is_hot], np.full(len(byte), SPAN)]
                    k, o = np.r_[k[~is_hot], hashes], np.r_[o[~is_hot], o[is_hot][run]]
                    route = np.r_[route[~is_hot], mix(hashes)]
                doc = part.column("doc").to_numpy()[o]
                version = part.column("version").to_numpy()[o]
                held.append((_gather(data, s, z), k, route, doc, version, s - offsets[o], z))
                total += int(z.sum())
                if total >= flush:
                    yield _send_runs(held, buckets, SPAN, turn)
                    held, total, turn = [], 0, turn + 1
        if total:
            yield _send_runs(held, buckets, SPAN, turn)

    sent = rows.mapInArrow(trimmed(runs_of), _RUN_ROWS)
    return sent.repartition(partitions, "bucket").groupBy("bucket").applyInArrow(_sort_runs(SPAN), _STRETCHES)


# --- 3: documents without the repeats -----------------------------------------------------------------------------


def remove_repeats(
    docs: DataFrame, carry: tuple[str, ...] = (), hot_runs: int = HOT_RUNS, hot_keys: int = HOT_KEYS,
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) and the columns in ``carry`` for every row of ``docs``.

    ``kept`` holds the remaining bytes. The result does not depend on ``hot_runs``, ``hot_keys`` and ``partition_bytes``.
    """
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(shuffle_partitions(spark), -(-n_bytes // partition_bytes))
    found = stage(shared_runs(docs, partitions, hot_runs), "shared-runs")
    # A key lies in one bucket, so it is named once.
    most = found.where("hot_key IS NOT NULL").orderBy(F.col("number").desc(), "hot_key").limit(hot_keys)
    hot = np.array([r[0] for r in most.select("hot_key").collect()], np.int64).view(np.uint64)
    stretches = stage(repeated_stretches(docs, found, hot, partitions), "stretches")
    per_doc = stretches.groupBy("doc", "version").agg(
        F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")
    )
    carried = {f"carry_{i}": c for i, c in enumerate(carry)}
    whole = docs.select(
        "doc_id",
        _doc().alias("doc"),
        F.xxhash64(text_or_empty()).alias("version"),
        "text",
        *[F.col(c).alias(name) for name, c in carried.items()],
    )
    joined = whole.join(per_doc, ["doc", "version"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for text, starts, stops in zip(*(part.column(c).to_pylist() for c in ("text", "starts", "stops"))):
                    raw = (text or "").encode()
                    pieces, n_removed, n_spans, last = [], 0, 0, 0
                    for begin, end in union_of(starts or [], stops or []):
                        pieces.append(raw[last:begin])
                        n_removed += end - begin
                        n_spans += 1
                        last = end
                    pieces.append(raw[last:])
                    rows.append((len(raw), n_removed, n_spans, b"".join(pieces)))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.record_batch(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))]
                    + [part.column(c) for c in carried],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *carried],
                )

    inputs = joined.select("doc_id", "text", "starts", "stops", *carried)
    own = [f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", "n_bytes long", "n_removed long", "n_spans long"]
    kinds = [f"{name} {docs.schema[c].dataType.simpleString()}" for name, c in carried.items()]
    return inputs.mapInArrow(cut, ", ".join([*own, "kept binary", *kinds]))


def shortened_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with shorter texts. Characters of which only a part remains go too; ``n_chars`` follows the text."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    rows = remove_repeats(docs, others)
    text = F.when(F.col("n_removed") == 0, F.col("_text")).otherwise(_decoded(F.col("kept")))
    named = rows.withColumnsRenamed({f"carry_{i}": f"_{c}" for i, c in enumerate(others)})
    named = named.withColumn("_text", text)
    if "n_chars" in docs.columns:
        named = named.withColumn("_n_chars", F.when(F.col("n_removed") == 0, F.col("_n_chars")).otherwise(F.length("_text")))
    return named.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_{c}").alias(c) for c in docs.columns])


@F.pandas_udf(T.StringType())
def _decoded(kept: pd.Series) -> pd.Series:
    return kept.map(lambda raw: raw.decode("utf-8", "ignore"))


def union_of(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(zip(starts, stops)):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out
