"""Documents that every operator has to survive, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def corpus(seed: int = 7, n: int = 60) -> list[str | None]:
    """Random prose with exact and near copies, shared passages and lines, odd characters, nulls and a long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7))) for _ in range(120)]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared = prose(25)
    line = "A line of at least forty characters, found often."
    texts: list[str | None] = [None, "", " \t\n", "one", "two words", "Ä" * 60, "x" * 500, "ab " * 300]
    for i in range(n):
        text = prose(rng.randint(5, 90))
        if i % 4 == 0:
            text = f"{prose(10)} {shared} {prose(10)}"
        if i % 5 == 0:
            text += f"\n {line.upper() if i % 2 else line}\t\nend {i}"
        if i % 6 == 0 and i:
            words = (texts[-1] or "x").split(" ")
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        if i % 7 == 0:
            text = rng.choice([t for t in texts if t])
        if i % 11 == 0:
            text = text.replace(" ", "\t ")
        texts.append(text)
    texts.append("\n".join(prose(40) for _ in range(150)))
    return texts


def repeats(rows: list[tuple[int, str | None]], span: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept) by a table of all windows."""
    first: dict[bytes, int] = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - span + 1):
            w = raw[p : p + span]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - span + 1):
            if first[raw[p : p + span]] < i:
                gone[p : p + span] = b"\1" * span
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, kept))
    return out


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def near_groups(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def exact_groups(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    out = {}
    for text, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(text.encode()).hexdigest())
    return out


def dropped_lines(rows: list[tuple[int, str | None]], min_chars: int = 40, min_docs: int = 5) -> dict[int, list[int]]:
    key = lambda s: s.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    return {
        i: [
            p for p, line in enumerate((t or "").split("\n"))
            if len(holders.get(key(line), ())) >= min_docs and i != max(holders[key(line)])
        ]
        for i, t in rows
    }


def base_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )
