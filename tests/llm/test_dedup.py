import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidedock.llm import exact, lines, near, repeats, suffixes


@pytest.mark.parametrize("seed,hot", [(1, 20_000), (2, 1)])
def test_repeats_equal_brute_force(spark, seed, hot):
    rows = list(enumerate(cases.corpus(seed)))
    df = cases.documents(spark, [t for _, t in rows]).withColumn("kept", F.lit("clash")).repartition(5)
    got = repeats.remove_repeats(df, ("kept",), hot).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == cases.repeats(rows)
    assert {r.carry_0 for r in got} == {"clash"}


def test_repeats_on_null_ids_repeated_rows_and_nothing(spark):
    text = "exactly the same text, somewhat longer than fifty bytes, in all of these rows"
    df = cases.documents(spark, [text, text, text, "short"], [None, 3, 3, 4])
    got = sorted((r.doc_id or 0, r.n_removed) for r in repeats.remove_repeats(df).collect())
    assert got == [(0, 0), (3, len(text)), (3, len(text)), (4, 0)]
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_shortened_documents_keep_columns_and_whole_characters(spark):
    passage = "ü" * 40
    df = cases.documents(spark, [f"first {passage} end", f"second {passage} é"], [1, 2])
    rows = {r.doc_id: r for r in repeats.shortened_documents(df).collect()}
    assert repeats.shortened_documents(df).columns == df.columns
    assert rows[1].text == f"first {passage} end" and passage not in rows[2].text
    assert rows[2].n_chars == len(rows[2].text)


def test_suffix_sort_orders_like_bytes():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 700)
    lengths = rng.integers(8, 90, 700)
    order, equal = suffixes.suffix_sort(data, starts, lengths)
    keys = [data[s : s + n].tobytes() for s, n in zip(starts, lengths)]
    in_order = [keys[i] for i in order]
    assert in_order == sorted(keys)
    assert equal.tolist() == [False] + [a == b for a, b in zip(in_order, in_order[1:])]


def test_suffix_sort_survives_collisions(monkeypatch):
    data = np.frombuffer(b"abcdefgh-1 abcdefgh-2 abcdefgh-1 abcdefgh-3", np.uint8)
    monkeypatch.setattr(suffixes.Prefixes, "hash", lambda self, start, length: np.zeros(len(start), np.uint64))
    starts = np.array([0, 11, 22, 33])
    order, equal = suffixes.suffix_sort(data, starts, np.full(4, 10))
    assert [data[starts[i] + 9] for i in order] == [49, 49, 50, 51] and equal.tolist() == [False, True, False, False]


@pytest.mark.parametrize("seed", [3, 4])
def test_near_groups_equal_brute_force(spark, seed):
    rows = list(enumerate(cases.corpus(seed)))
    got = near.near_groups(cases.documents(spark, [t for _, t in rows]).repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == cases.near_groups(rows)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(cases.shingles(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_groups_of_a_chain_and_its_ends(spark):
    words = [f"w{i}" for i in range(300)]
    chain = [" ".join([f"v{j}" for j in range(18 * k)] + words[18 * k :]) for k in range(8)]
    rows = list(enumerate(chain))
    assert len(set(cases.near_groups(rows).values())) == 1
    assert {r.component_id for r in near.near_groups(cases.documents(spark, chain)).collect()} == {0}


def test_near_groups_edge_rows(spark):
    df = cases.documents(spark, ["a b", "A  b", None, "", "a b"], [5, 4, 3, 2, None])
    got = {(r.doc_id, r.component_id, r.n_shingles, r.kept) for r in near.near_groups(df).collect()}
    assert got == {(5, None, 1, False), (4, None, 1, False), (3, 3, 0, True), (2, 2, 0, True), (None, None, 1, True)}
    assert near.near_groups(df.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in near.kept_documents(df).collect()) == [0, 2, 3]


def test_sketch_fills_all_coordinates_and_estimates_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    b = np.concatenate((a[:800], rng.integers(0, 2**63, 100).astype(np.uint64)))
    single = a[:1]
    h = np.concatenate([np.sort(x) for x in (a, b, single)])
    sketch = near.sketches(h, np.array([0, 900, 1800, 1801]))
    assert (sketch != np.iinfo(np.uint64).max).all()
    assert (sketch[0] == sketch[1]).mean() == pytest.approx(0.8, abs=0.12)


@pytest.mark.parametrize("support", [0.001, 0.05])
def test_exact_groups_equal_brute_force(spark, support):
    rows = list(enumerate(cases.corpus(6))) + [(1000 + i, "hot copy" + " " * (i % 3)) for i in range(90)]
    df = cases.documents(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("size", F.lit(1))
    got = exact.exact_groups(df, support).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == cases.exact_groups(rows)
    kept = exact.kept_documents(df, support)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, v in cases.exact_groups(rows).items() if v[2])


def test_exact_groups_edge_rows(spark):
    df = cases.documents(spark, ["a b", "ab", "ab", "x"], [None, 2, 2, 3])
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(df).collect())
    assert got == [(0, None, 3, True), (2, None, 3, False), (2, None, 3, False), (3, 3, 1, True)]
    assert exact.kept_documents(cases.documents(spark, ["ab", "ab"], [2, 2])).count() == 1
    assert exact.exact_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_exact_keeps_different_texts_under_null_and_repeated_ids(spark, support):
    rows = [(None, "one"), (None, "two"), (None, "t wo"), (7, "aaa"), (7, "bbb"), (7, "b bb"), (8, "a  aa"), (None, None), (9, "")]
    df = cases.documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted(((r.doc_id or 0, r.text) for r in exact.kept_documents(df, support).collect()))
    assert got == [(0, "one"), (0, "t wo"), (7, "b bb"), (8, "a  aa"), (9, "")]


def test_near_keeps_different_texts_under_null_and_repeated_ids(spark):
    prose = lambda k: [f"{k}{i}" for i in range(60)]
    text = lambda words: " ".join(words)
    a, b, c, d = (prose(k) for k in "abcd")
    rows = [(None, text(a)), (None, text(b)), (1, text([*a, "end"])), (2, text([*b, "end"])), (7, text(c)), (7, text(d)),
            (8, text([*c, "end"])), (5, text([*d, "end"])), (None, text(a)), (None, ""), (7, "")]
    df = cases.documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted(((r.doc_id or 0, r.text) for r in near.kept_documents(df).collect()))
    assert got == sorted([(0, text(a)), (0, text(b)), (7, text(c)), (5, text([*d, "end"])), (0, ""), (7, "")])
    component = {(r.doc_id, r.component_id, r.kept) for r in near.near_groups(df).where("n_shingles > 0").collect()}
    assert component == {(None, None, True), (1, None, False), (2, None, False), (7, 7, True), (8, 7, False), (7, 5, False), (5, 5, True)}


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_line_bitmaps_equal_brute_force(spark, support):
    rows = list(enumerate(cases.corpus(8)))
    df = cases.documents(spark, [t for _, t in rows]).withColumn("pos", F.lit(1)).repartition(3)
    want = cases.dropped_lines(rows)
    assert sum(map(len, want.values())) > 5
    got = lines.line_bitmaps(df, support=support)
    for r in got.withColumn("n", lines.n_dropped(F.col("keep_bitmap"))).collect():
        parts = (rows[r.doc_id][1] or "").split("\n")
        assert r.n_lines == len(parts) == sum(r.keep_bitmap) and r.n == len(want[r.doc_id])
        assert r.kept_text == "\n".join(x for p, x in enumerate(parts) if p not in want[r.doc_id])
        decoded = [bool(k % 2) for k, n in enumerate(r.keep_bitmap) for _ in range(n)]
        assert decoded == [p in want[r.doc_id] for p in range(len(parts))]


def test_lines_of_repeated_and_null_ids(spark):
    line = "this line is certainly longer than forty characters"
    df = cases.documents(spark, [line] * 7, [None, 1, 2, 3, 4, 9, 9])
    got = sorted((r.doc_id or 0, r.keep_bitmap, r.kept_text) for r in lines.line_bitmaps(df).collect())
    assert got == [*((k, [0, 1], "") for k in range(5)), (9, [1], line), (9, [1], line)]
    assert lines.line_bitmaps(df.limit(0)).count() == 0


def test_bitmap_of_a_long_text_is_linear(spark):
    """100,000 lines of which every second one goes."""
    lost = "this passage is in every one of these six documents %d"
    long = "\n".join(x for i in range(50000) for x in (lost % (i % 7), f"own {i}"))
    others = "\n".join(lost % i for i in range(7))
    df = cases.documents(spark, [long, *[others] * 5], [1, 2, 3, 4, 5, 6])
    rows = {r.doc_id: r for r in lines.line_bitmaps(df).collect()}
    assert rows[1].keep_bitmap == [0, *[1] * 100000] and rows[1].kept_text == "\n".join(f"own {i}" for i in range(50000))
    assert rows[6].keep_bitmap == [7] and rows[2].keep_bitmap == [0, 7] and rows[2].kept_text == ""
