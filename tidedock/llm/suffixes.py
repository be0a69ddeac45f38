"""Suffix sort by hash comparison.

Suffixes (here always cut off at a given length) are compared by their longest common extension, which a binary
search over prefix polynomial hashes finds in a logarithmic number of steps. A mergesort over whole arrays of
comparisons orders them. The order is then verified on the bytes themselves, so a hash collision cannot change a
result.
"""

from __future__ import annotations

import numpy as np

from tidedock.llm.textbytes import inverse_powers, powers

_HEAD = 8


#: Longest table that stays with a process.
KEPT = 1 << 20

_tables: list[np.ndarray] = [powers(1), inverse_powers(1)]


def tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and their inverses; a process keeps one table, as long as the longest needed so far up to ``KEPT``."""
    if count > KEPT:
        return powers(count), inverse_powers(count)
    if len(_tables[0]) < count:
        size = (count + (1 << 18)) >> 18 << 18
        _tables[:] = [powers(size), inverse_powers(size)]
    return _tables[0][:count], _tables[1][:count]


def running_sums(data: np.ndarray, power: np.ndarray) -> np.ndarray:
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    sums[1:] = data
    sums[1:] += np.uint64(1)
    sums[1:] *= power[: len(data)]
    np.cumsum(sums[1:], out=sums[1:])
    return sums


class Prefixes:
    """Prefix polynomial hashes of a byte string modulo 2**64."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        power, self.inverse = tables(len(data) + 1)
        self.sums = running_sums(data, power)

    def hash(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hash of the bytes from ``start``, independent of where they stand."""
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at ``a`` and ``b``, at most ``limit``."""
        whole = self.hash(a, limit) == self.hash(b, limit)  # copies are frequent: one step settles them
        low = np.where(whole, limit, 0)
        high = np.where(whole, limit, limit - 1)
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                return low
            middle = (low[todo] + high[todo] + 1) >> 1
            same = self.hash(a[todo], middle) == self.hash(b[todo], middle)
            low[todo[same]] = middle[same]
            high[todo[~same]] = middle[~same] - 1

    def before(self, a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix ``a`` of length ``la`` comes before ``b`` (or is equal, where asked)."""
        limit = np.minimum(la, lb)
        n = self.common(a, b, limit)
        ended = n == limit
        inside = np.where(ended, 0, n)
        byte_a, byte_b = self.data[a + inside], self.data[b + inside]
        return np.where(ended, (la < lb) | (or_equal & (la == lb)), byte_a < byte_b)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as a big-endian number; zeros follow the data."""
    padded = np.concatenate((data, np.zeros(_HEAD, np.uint8)))
    out = np.zeros(len(data), np.uint64)
    for k in range(_HEAD):
        out <<= np.uint64(8)
        out |= padded[k : k + len(data)]
    return out


def _merge_levels(prefixes: Prefixes, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray, heads: np.ndarray) -> None:
    """Mergesort of ``order`` within stretches of equal heads, all stretches at once."""
    sorted_heads = heads[order]
    first = np.flatnonzero(np.r_[True, sorted_heads[1:] != sorted_heads[:-1]])
    size = np.diff(np.r_[first, len(order)])
    width = 1
    while True:
        large = size > width
        if not large.any():
            return
        begin, count = first[large], size[large]
        local = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        base = np.repeat(begin, count)
        total = np.repeat(count, count)
        run = local // width
        other = (run ^ 1) * width
        there = np.clip(total - other, 0, width)
        right = (run & 1).astype(bool)
        mine = order[base + local]
        low, high = np.zeros(len(mine), np.int64), there.copy()
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) >> 1
            them = order[(base + other)[todo] + middle]
            me = mine[todo]
            # An element of the left run stays ahead of equal ones of the right run.
            less = prefixes.before(starts[them], lengths[them], starts[me], lengths[me], right[todo])
            low[todo[less]] = middle[less] + 1
            high[todo[~less]] = middle[~less]
        order[base + (run & ~1) * width + (local - run * width) + low] = mine
        width *= 2


def _matrix(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Bytes of each suffix as big-endian numbers, zero-padded."""
    out = np.zeros((len(starts), width // _HEAD), np.uint64)
    for k in range(width // _HEAD):
        left = np.clip(lengths - _HEAD * k, 0, _HEAD)
        mask = np.where(left > 0, np.uint64(2**64 - 1) << (8 * (_HEAD - np.maximum(left, 1))).astype(np.uint64), np.uint64(0))
        out[:, k] = words[np.minimum(starts + _HEAD * k, len(words) - 1)] & mask
    return out


def _verify(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray | None:
    """For each suffix in order, whether it equals the one before; None if the order is wrong."""
    width = -(-int(lengths.max()) // 8) * 8
    equal = np.zeros(len(order), bool)
    step = 1 << 14
    for low in range(0, len(order), step):
        part = order[max(low - 1, 0) : low + step]
        rows = _matrix(words, starts[part], lengths[part], width)
        size = lengths[part]
        differ = rows[1:] != rows[:-1]
        some = differ.any(1)
        at = differ.argmax(1)
        line = np.arange(len(at))
        up = np.where(some, rows[1:][line, at] > rows[:-1][line, at], size[1:] >= size[:-1])
        if not up.all():
            return None
        equal[low + (low == 0) : low + (low == 0) + len(at)] = ~some & (size[1:] == size[:-1])
    return equal


def suffix_sort(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, and whether each equals its predecessor in that order.

    Every length is at least eight. Lengths are small against ``data``; its size bounds the memory.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    words = _words(data)
    heads = words[starts]
    order = np.argsort(heads, kind="stable")
    _merge_levels(Prefixes(data), starts, lengths, order, heads)
    equal = _verify(words, starts, lengths, order)
    if equal is None:  # a collision misled the comparisons: order by the bytes
        width = -(-int(lengths.max()) // 8) * 8
        keys = _matrix(words, starts, lengths, width)
        order = np.lexsort((lengths, *keys.T[::-1]))
        equal = _verify(words, starts, lengths, order)
    return order, equal
