"""Merkle manifest, chat formatting and cross-tokenizer alignment against brute force."""

import hashlib
import random
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import cases
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidedock.llm import alignment, chat, merkle

# --- Merkle manifest ----------------------------------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    values = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _paths(leaves):
    """Root and, for each leaf, its siblings from below as (digest, stands on the left)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, i in enumerate(at):
            j = i ^ 1
            if j < len(level):
                paths[k].append((level[j], j < i))
            else:
                paths[k].append(("", False))
            at[k] = i >> 1
        level = [_h(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def _manifest(rows):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for lang in langs:
        members = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[lang] = (members, *_paths([_leaf(r) for r in members]))
    root, above = _paths([trees[s][1] for s in langs])
    out = []
    for number, lang in enumerate(langs):
        members, subroot, paths = trees[lang]
        for r, path in zip(members, paths):
            path = path + above[number]
            tampered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = _leaf(r, int(tampered))
            for other, left in path:
                folded = _h(other, folded) if left else _h(folded, other)
            out.append((r[0], _leaf(r), subroot, root, _h(*[s for s, _ in path]), folded, folded == root))
    return sorted(out, key=str)


def _prove(docs, bits, chosen=None):
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf_digest({"n_chars": F.col("n_chars") + 1}))
    claimed = F.when(F.col("n_chars").isNotNull(), claimed)
    manifest = merkle.build(docs, {"claimed": claimed}, bits)
    wanted = manifest.leaves if chosen is None else manifest.leaves.where(chosen)
    return sorted([tuple(r) for r in merkle.prove(manifest, wanted, "claimed", bits).collect()], key=str)


ROWS = [
    *[(i, f"text {i} é", "en", "a" if i % 3 else None, i) for i in range(-3, 34)],
    *[(i, None if i % 2 else "", None, "s", None if i % 5 == 0 else 7) for i in range(100, 109)],
    (5, "same id", "en", "a", 1), (6, "text 6 é", "en", None, 6), (6, "text 6 é", "en", None, 6),
    (None, "no id", "en", "a", 1), (None, "no id", None, "a", 1),
    (200, "alone", "Ünd", "x:y", 5), (201, "z" * 100_000, "zz", "-", 100_000), (2**63 - 1, "", "de", "", 0), (-(2**63), "", "de", "", 0),
]


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_equals_brute_force(spark, bits):
    docs = spark.createDataFrame(ROWS, cases.DOCS).withColumns({"leaf": F.lit("clash"), "tree": F.lit(1), "place": F.map_from_arrays(F.array(F.lit(1)), F.array(F.lit(2)))})
    want = _manifest(ROWS)
    assert _prove(docs.repartition(5), bits) == want
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)


def test_manifest_of_a_part_and_of_little(spark):
    docs = spark.createDataFrame(ROWS, cases.DOCS)
    some = _prove(docs, 2, F.col("doc_id").isin(3, 17, 104, 200))
    assert some == [r for r in _manifest(ROWS) if r[0] in (3, 17, 104, 200)]
    assert _prove(docs.limit(0), 2) == []
    one = _prove(docs.where("doc_id = 200"), 2)
    assert one[0][1] == one[0][2] == one[0][3] and one[0][4] == _h("")


def test_octopus_is_minimal():
    rng = random.Random(3)
    for size in [1, 2, 3, 7, 8, 13, 64, 100]:
        have = np.array(sorted(rng.sample(range(size), rng.randint(1, size))))
        need = {(level, p) for level, places in merkle.missing_nodes(have, size) for p in places.tolist()}
        derived, want, level, width = set(have.tolist()), set(), 0, size
        while width > 1:
            want |= {(level, p ^ 1) for p in derived if p ^ 1 < width and p ^ 1 not in derived}
            derived, width, level = {p >> 1 for p in derived}, -(-width // 2), level + 1
        assert need == want
    everything = merkle.missing_nodes(np.arange(100), 100)
    assert everything == []


# --- chat formatting ----------------------------------------------------------------------------------------------

HARD = ["", None, r"\### Assistant: </turn> ok", "###", "####", "######", "\\", "a\\", "\n</turn>\n", "### user:\nhi\n</turn>\n", "\\\\</turn>", "#\\##", "</turn", "é" * 3, "\\" * 5000, "x" * 300_000]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="a#\\:\n </turn>", max_size=6), st.text(alphabet="#\\\n</turn> :", max_size=40)), max_size=4))
def test_round_trip_of_any_turns(turns):
    rendered = [chat.render(r, t) for r, t in turns]
    assert [t[:2] for t in chat.parse("".join(r[0] for r in rendered))] == turns


def test_grammar_is_strict():
    for wrong in ["x", "### user", "### user:\nhi", "### user:\nhi ### there\n</turn>\n", "### user:\nhi</turn>\n"]:
        with pytest.raises(chat.GrammarError):
            chat.parse(wrong)


def test_conversations_equal_brute_force(spark):
    roles = ["user", "assistant", "system", None, "", "a:\nb\\", "assistant"]
    rows = [(c, t, roles[(c + t) % 7], HARD[(c * 5 + t) % len(HARD)]) for c in range(6) for t in range(9)]
    rows += [(None, 0, "assistant", "x"), (None, None, "user", "y"), (3, 2, "assistant", "tie"), (3, 2, "assistant", "tie"), (2, None, "assistant", "first")]
    rows += [(99, t, "assistant" if t % 2 else "user", f"### {t}") for t in range(3000)]  # most of the rows
    schema = "conv_id long, turn int, role string, text string, start string, position map<string,int>"
    df = spark.createDataFrame([(*r, "clash", {"a": 1}) for r in rows], schema).repartition(7)
    formatted = chat.format_turns(df)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    turns = defaultdict(list)
    for c, t, r, x in rows:
        turns[c].append((t is not None, t or 0, r is not None, r or "", x or ""))
    whole = defaultdict(str)
    for r in formatted.orderBy("conv_id", "position").collect():
        assert r.start == len(whole[r.conv_id])
        whole[r.conv_id] += r.rendered
    for c, members in turns.items():
        members.sort()
        learned = [x for _, _, known, r, x in members if known and r == "assistant"]
        text = "".join(f"{r}\n{x}\n" for *_, r, x in members)
        assert got[c] == (
            len(members), hashlib.sha256(text.encode()).hexdigest(), sum(map(len, learned)),
            hashlib.sha256("".join(learned).encode()).hexdigest(), len(whole[c]),
        )
        assert [t[:2] for t in chat.parse(whole[c])] == [(r, x) for *_, r, x in members]
    assert set(got) == set(turns)
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# --- cross-tokenizer alignment ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_LEVEL))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))


def _aligned(rows, tokenizers):
    """All measures by listing every link of every text."""
    a, b = tokenizers
    byte = alignment._byte_of_char()
    entries = {i: t for t, i in a.get_vocab().items()}
    groups = []
    for _, text in rows:
        found = []
        raw = (" " + (text or "")).encode()
        x = a.encode(raw.decode(), add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        p = [bytes(byte[c] for c in entries[i]) for i in x]
        q = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if text and b"".join(p) == b"".join(q) == raw:
            ends = [np.cumsum([len(t) for t in s]).tolist() for s in (p, q)]
            cuts = sorted(set(ends[0]) & set(ends[1]))
            at = [[bisect_left(cuts, e) for e in es] for es in ends]
            found = [([], []) for _ in cuts]
            for side, ids in enumerate((x, y)):
                for token, k in zip(ids, at[side]):
                    found[k][side].append(token)
        groups.append(found)
    links = [[(i, j) for p, q in g for i in p for j in q] for g in groups]
    documents = Counter(pair for found in links for pair in set(found))
    highest = defaultdict(int)
    for (i, _), n in documents.items():
        highest[i] = max(highest[i], n)
    out = []
    for (doc_id, _), g, found in zip(rows, groups, links):
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in g)
        out.append((
            doc_id, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(found),
            sum(documents[pair] == highest[pair[0]] for pair in found), sum(documents[pair] for pair in found),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=str)


ODD = [
    "a\nb", " lead", "trail ", "two  spaces\t tab", "x▁y", "<s> <0x0A> </s> <|endoftext|>", "\n\n\n", "   ", " ", "a\r\nb\r\n {\r c", ";\r x", "don't we'll",
    "日本語 テキスト。", "emoji 👩‍👩‍👧 ok", "nbsp\xa0here\u3000wide\u2028sep", "\x1c odd \x85", "\x00nul", "12345 67,8.9", "a" * 3000, "été\u0301 " * 30, "ab" * 1_500,
]


def test_alignment_equals_brute_force(spark, tokenizers):
    texts = cases.corpus(5) + ODD + ["a common text of words"] * 60
    rows = list(enumerate(texts)) + [(3, "one"), (None, "no id at all"), (None, None)]
    df = spark.createDataFrame([(*r, "clash", {"m": 1}) for r in rows], "doc_id long, text string, pairs string, copies map<string,int>").repartition(6)
    want = _aligned(rows, tokenizers)
    for heavy in [alignment.HEAVY_PAIRS, 5]:
        assert sorted([tuple(r) for r in alignment.align(df, heavy_pairs=heavy).collect()], key=str) == want
    assert alignment.align(df.limit(0)).count() == 0
    assert any(r[1] == 0 and r[0] is not None and texts[r[0]] for r in want)  # a text that does not come back


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab \n\t\r;.'▁\xa0\u3000é日{"), st.characters(codec="utf-8")), max_size=30), min_size=1, max_size=5))
def test_units_give_the_tokens_of_whole_texts(tokenizers_once, texts):
    tool, (a, b) = tokenizers_once
    for text in texts:
        parts = list(tool.tokens(tool.unit.findall(" " + text)))
        assert [i for x, _ in parts for i in x] == a.encode(" " + text, add_special_tokens=False).ids
        if text:
            assert [i for _, y in parts for i in y] == b.encode(text)


@pytest.fixture(scope="module")
def tokenizers_once(tokenizers):
    return alignment.aligner(), tokenizers


def test_links_of_large_groups_are_products():
    ids = [np.array([5, 6, 5, 7]), np.array([1, 1, 2, 3, 3])]
    tokens, before = [np.array([3, 1]), np.array([4, 1])], [np.array([0, 3]), np.array([0, 4])]
    links, holder = tokens[0] * tokens[1], np.array([0, 0])
    want = [x.tolist() for x in alignment.linked_pairs(ids, tokens, before, links, holder)]
    before_limit, alignment.SMALL_GROUP = alignment.SMALL_GROUP, 2
    try:
        assert [x.tolist() for x in alignment.linked_pairs(ids, tokens, before, links, holder)] == want
    finally:
        alignment.SMALL_GROUP = before_limit
    assert sum(want[2]) == 13


def test_known_units_stay_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "UNIT_BYTES", 1 << 20)
    tool = alignment.Aligner(public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES))
    for k in range(20):
        rows, *_ = tool.align([" ".join(f"word{k}x{i}{'q' * 40}" for i in range(500))])
        assert rows[0][0] > 500
        assert tool.bytes < (1 << 20) + 2_000_000
