import math
import random
import tracemalloc
import zlib
from collections import Counter

import cases
import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidedock.llm import language, packing, quality, queries, subwords, toxicity, urls


def test_quality_counts_equal_brute_force(spark):
    texts = cases.corpus(9) + ["a b c a b c x", "same\nsame\n \nsame", "#tag $5 <b>"]
    df = cases.documents(spark, texts).withColumn("n_words", F.lit("clash"))
    for r in quality.judge(df).collect():
        want = cases.base_counts(texts[r.doc_id])
        assert tuple(r[m] for m in quality.MEASURES) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
    assert quality.judge(df.limit(0)).count() == 0
    assert set(quality.kept_documents(df).columns) == set(df.columns)


def test_quality_rules_tell_prose_from_junk(spark):
    prose = " ".join(f"the house{i} of man{i} was in street{i}." for i in range(12))
    junk = " ".join(f"w{i}$$$ ***x{i}" for i in range(60))
    kept = {r.doc_id: r.kept for r in quality.judge(cases.documents(spark, [prose, junk, prose.upper() + " "])).collect()}
    assert kept == {0: True, 1: False, 2: True}


def _rule(url, rules=urls.RULES):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else None
    if rest is None:
        return "", "", None, "allow"
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, tail = rest[:cut].translate(cases.LOWER), rest[cut:]
    path = tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    "http://example.com/en/x", "https://www.EXAMPLE.com/en/", "http://a.example.com/en", "http://b.net/es/1?x=/fr/",
    "http://net/fr/", "http://xnet/es/", "http://x.com", "http://x.com/", "x.com/en/", "", None, "://example.com/en/#a",
    "http://.com/", "ftp://a..net/es/", "http://example.com?u=http://b.net/es/", "http://y.com:80/", "a://b\n.net/es/\n",
]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_urls_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "BROADCAST_RULES", limit)
    pages = spark.createDataFrame([(i, u, "rule") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, action string")
    got = {r.page_id: tuple(r)[1:] for r in urls.filter_urls(pages, rules).collect()}
    assert got == {i: _rule(u) for i, u in enumerate(URLS * 2)}
    assert urls.filter_urls(pages, rules.limit(0)).where("verdict = 'block'").count() == 0
    assert urls.filter_urls(pages.limit(0), rules).count() == 0


def _ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


ODD = ["It's we'll 'S don'T", "ΟΔΟΣ Σ. ὈΔΥΣΣΕΎΣ", "a\x1cb\x1d c\u3000d\u200be", "e\u0301 É\u0301, İstanbul ﬁ", "<|endoftext|> 12ab34,",
       "naïve…?!  (x).", "日本語 テスト，", "\x85a\xa0b\u1680", "😀😀 x😀.", "ß SS ǅ"]


def test_word_ids_equal_the_tokenizer():
    texts = cases.corpus(10) + ODD
    encoder = packing.WordIds(public_tokenizers.path(packing.TOKENIZER), limit=4_000)
    for _ in range(2):
        got = [np.frombuffer(b, "<u4").tolist() + [0] for b in encoder.encode(texts)]
        assert got == _ids(texts)


def test_unknown_words_are_encoded_together():
    from types import SimpleNamespace

    for plain in (True, False):
        encoder = packing.WordIds(public_tokenizers.path(packing.TOKENIZER), plain=plain)
        tool, asked = encoder.tokenizer, []

        def fast(units, **options):
            asked.extend(units)
            return tool.encode_batch_fast(units, **options)

        encoder.tokenizer = SimpleNamespace(encode=lambda u, **o: fast([u], **o)[0], encode_batch_fast=fast)
        texts = [None, "", " ", *[f"ab{'c' * i}##{i} <|endoftext|>x{i}" for i in range(50)], "x\u0301## \u0301#,", "a\u3000b\xa0Ç#", *ODD]
        # Together unless one holds the mark that stands between them.
        for extra, most in (([], 10), (["\0", "a\0 #\0#", "b \0\0c"], 100)):
            asked.clear()
            got = list(encoder.encode(pa.array([*texts, *extra])[1:]))
            assert [np.frombuffer(b, "<u4").tolist() for b in got] == [
                tool.encode(t or "", add_special_tokens=False).ids for t in [*texts, *extra][1:]
            ]
            assert len(asked) <= most


def test_units_stay_known_in_little_memory():
    from string import ascii_lowercase
    from types import SimpleNamespace

    encoder = packing.WordIds(public_tokenizers.path(packing.TOKENIZER), limit=2 << 20)
    tool, asked = encoder.tokenizer, []

    def fast(units, **options):
        asked.extend(units)
        return tool.encode_batch_fast(units, **options)

    encoder.tokenizer = SimpleNamespace(encode_batch_fast=fast)
    words = [f"{a}{b}{c}x{c}{b}{a}" for a in ascii_lowercase for b in ascii_lowercase for c in ascii_lowercase]
    steps = [words[k : k + 2_500] for k in range(0, len(words), 2_500)]
    for step in steps:
        list(encoder.encode([" ".join(step)]))
    assert {*" ".join(asked).split()} >= {*words}
    asked.clear()
    for step in steps:
        list(encoder.encode([" ".join(step).title().replace(" ", ", ")]))
    assert len(asked) == 1  # the comma


def test_punctuation_joins_marks_that_normalizing_makes():
    texts = ["x\u0958.,", "\u09dc! \u0958", "\ufb1d?; a\ufb4e.", "x\u0130., \u0130", "\u0958\xa0\u0958., \u0958x.,"]
    for plain in (True, False):
        got = list(packing.WordIds(public_tokenizers.path(packing.TOKENIZER), plain=plain).encode(texts))
        assert [np.frombuffer(b, "<u4").tolist() + [0] for b in got] == _ids(texts)


def test_added_tokens_are_one_id_as_loaded(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "it<|startoftext|>'s", "<|endoftext|><|startoftext|>s.", "ΑΣ<|endoftext|>Σ", "<|ENDOFTEXT|> <|end of", *ODD]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [320, 49407, 321]
    got = packing.WordIds(path, plain=False).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == want
    docs = cases.documents(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sums = {i: zlib.crc32(np.array(x + [0], "<u4").tobytes()) for i, x in enumerate(want)}
    for rows in (queries.best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, docs, "")):
        assert {r.doc_id: r.ids_crc32 for r in rows.collect()} == sums


def test_pack_is_gapless_and_exact(spark):
    texts = cases.corpus(11) + ODD + ["word " * 1500]
    rows = packing.pack(cases.documents(spark, texts).repartition(4), capacity=256).collect()
    ids = _ids(texts)
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.piece * 256 == r.start
        by_doc.setdefault(r.doc_id, []).extend(part)
    assert by_doc == dict(enumerate(ids))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in sequences.values():
        ends = 0
        for offset, length in sorted(content):
            assert offset == ends
            ends += length
        assert ends <= 256
    assert len(sequences) <= math.ceil(sum(map(len, ids)) / 256) + 2
    assert packing.pack(cases.documents(spark, texts).limit(0)).count() == 0


def _fewest(sizes, capacity):
    """Exact optimum by search; sizes descending."""
    best = [len(sizes)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, bins[:i] + [bins[i] + sizes[k]] + bins[i + 1 :])
        place(k + 1, [*bins, sizes[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_dominating_sets_keep_the_optimum(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(3, 20) for _ in range(9)), reverse=True)
    lengths = packing.Lengths(Counter(sizes))
    fixed = packing.dominating_sets(lengths, 20)
    rest = sorted(Counter(lengths.count).elements(), reverse=True)
    assert sum(n for _, n in fixed) + _fewest(rest, 20) == _fewest(sizes, 20)
    packed = packing.pack_lengths(Counter(sizes), 20)
    assert Counter(s for c, n in packed for s in c * n) == Counter(sizes)
    assert all(sum(c) <= 20 for c, _ in packed)


def _naive(lattice, word):
    """Best segmentation over all of them; of equal scores the one with the longer last pieces."""
    best = [(0.0, b"")]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            found = lattice.score.get(word[start:end])
            if found:
                options.append((best[start][0] + found[0], -start, best[start][1] + found[1]))
        if not lattice.score.get(word[end - 1]):
            unknown = subwords._bytes(lattice._unknown(word[end - 1]))
            options.append((best[end - 1][0] + lattice.unknown_score, -len(word), best[end - 1][1] + unknown))
        top = max(options, key=lambda o: (o[0], o[1]))
        best.append((top[0], top[2]))
    return best[-1][1]


def test_shared_prefix_viterbi_equals_plain_viterbi():
    lattice = subwords.lattice()
    words = sorted({w for t in cases.corpus(12) + ODD if t for w in lattice.words(t)})
    assert len(words) > 300
    assert dict(lattice.segment(words)) == {w: _naive(lattice, w) for w in words}


def test_viterbi_scores_equal_the_library(tmp_path):
    """The same pieces read as a unigram model by the library: equal best scores."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(public_tokenizers.path(subwords.MODEL), "rb").read())
    proto.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    library, own = SentencePieceProcessor(model_file=str(path)), subwords.Lattice(str(path))
    score = lambda ids: sum(library.get_score(i) for i in ids)
    for text, raw in zip(TEXTS, own.encode(TEXTS)):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert score(ids) == pytest.approx(score(library.encode(text)), rel=1e-5)


TEXTS = [t for t in cases.corpus(13) if t] + ["plain words of a text", "two  spaces and\nlines\t"]


def test_encode_and_decode_round_trip(spark):
    texts = cases.corpus(14) + ODD
    encoded = subwords.encode(cases.documents(spark, texts).withColumn("ids", F.lit(1)))
    got = {r.doc_id: r.text for r in subwords.decode(encoded).collect()}
    assert got == {i: t or "" for i, t in enumerate(texts)}
    assert subwords.decode(subwords.encode(cases.documents(spark, texts).limit(0))).count() == 0


def _language_texts(rng, n):
    stems = {"aa": ["kola", "rumi", "tepa", "sonu"], "bb": ["schritz", "pflang", "wechst", "dringt"], "cc": ["eauxi", "oille", "uette", "aisou"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(stems))
        rows.append((" ".join(rng.choice(stems[lang]) + rng.choice(["", "n", "ra", "s"]) for _ in range(40)), lang))
    return rows


def test_language_held_out_accuracy_and_edges(spark):
    rows = _language_texts(random.Random(1), 120)
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")
    learned = language.learn(df.where("doc_id < 60").unionByName(df.limit(2).withColumn("lang", F.lit(None).cast("string"))))
    assert sorted(learned) == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language.identify(df, learned).collect()}
    assert all(got[i].lang_pred == g and 0 <= got[i].score <= 1 for i, (_, g) in enumerate(rows) if i >= 60)
    odd = language.identify(cases.documents(spark, [None, "", "12 34!", "x" * 300_000]), learned).collect()
    assert [r.lang_pred for r in sorted(odd, key=lambda r: r.doc_id)][:3] == ["und"] * 3
    assert language.identify(df, language.learn(df.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert language.identify(df.limit(0), learned).count() == 0


def test_toxicity_sample_moves_texts_of_the_first_cut_only(spark, monkeypatch):
    rows = [(i % 590, f"text {i % 595}", int(i % 590 < 40)) for i in range(600)]  # repeated ids, with equal and with other texts
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    whole = {k: toxicity.bounded_sample(df.where(f"toxic = {k}"), "toxic", 10, toxicity.SALT).collect() for k in (0, 1)}
    moved, learned, sample = [], [], toxicity.bounded_sample
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 10)
    monkeypatch.setattr(toxicity, "SAMPLE_ORDINARY", 10)

    def watched(rows, *rest):
        moved.append(rows.count())
        return sample(rows, *rest)

    monkeypatch.setattr(toxicity, "bounded_sample", watched)
    monkeypatch.setattr(toxicity, "fit", lambda sample, counts: learned.append((sample, counts)))
    toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    (got, counts), = learned
    assert sum(moved) < 200 and counts == {k: sum(r[2] == k for r in rows) for k in (0, 1)}
    for k in (0, 1):
        assert sorted((r.doc_id, r.text) for r in got if r.toxic == k) == sorted((r.doc_id, r.text) for r in whole[k])


def test_toxicity_held_out_accuracy_and_edges(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bad = ["grumblefish", "zorkwad", "plinkhead", "vexmonger"]
    rows = []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 150))]
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(2, 6) * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int"))
    model = toxicity.learn(df.where("doc_id < 400").select("doc_id", "text"), labels.where("doc_id < 400"))
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    held = [(got[i], t) for i, _, t in rows if i >= 400]
    assert np.mean([(s >= 0.5) == bool(t) for s, t in held]) > 0.93
    edges = toxicity.score(cases.documents(spark, [None, "", "!!", "word " * 60_000]), model).collect()
    assert all(0 <= r.score <= 1 for r in edges)
    unlabelled = toxicity.learn(df.select("doc_id", "text"), labels.limit(0))
    assert {r.score for r in toxicity.score(df, unlabelled).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


def test_long_words_take_memory_by_length():
    tool = subwords.lattice()
    word = "a" * 400_000 + "é▁b" * 5
    tracemalloc.start()
    (ids,) = tool.encode([word])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 and tool.decode(ids) == tool.model.normalize(word)[1:].replace("▁", " ")


def test_word_caches_stay_bounded_in_bytes():
    encoder = packing.WordIds(public_tokenizers.path(packing.TOKENIZER), limit=1 << 20)
    for k in range(12):
        list(encoder.encode([" ".join(f"w{k}x{i}{'q' * 45}" for i in range(2_000))]))
        assert encoder.bytes < (1 << 20) + 2_000 * 600
        assert len(encoder.young) + len(encoder.old) < 30_000


def test_learning_rows_without_ids_are_bounded(spark):
    from tidedock.llm.compression import bounded_sample

    rows = spark.createDataFrame([(None, f"text {i}", "x") for i in range(2_000)] + [(1, "t", "y")], "doc_id long, text string, lang string")
    counts = {r.lang: r["count"] for r in bounded_sample(rows, "lang", 50, 6).groupBy("lang").count().collect()}
    assert counts == {"x": 50, "y": 1}


def test_a_language_of_long_texts_only_is_learned(spark):
    rng = random.Random(5)
    prose = lambda stem, n: " ".join(f"{stem}{rng.choice('aeiou')}{rng.choice(stem)}" for _ in range(n))
    rows = [(i, prose("brk", 9_000), "long") for i in range(6)] + [(50 + i, prose("zmt", 40), "short") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(docs, language.learn(docs)).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {i: lang for i, _, lang in rows}


def test_host_of_many_labels(spark):
    host = ".".join(["a"] * 20_000) + ".example.com"
    pages = spark.createDataFrame([(1, f"http://{host}/en/"), (2, "http://com/")], "page_id long, url string")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, action string")
    assert {r.page_id: r.rule for r in urls.filter_urls(pages, rules).collect()} == {1: "example.com/en/", 2: "com/"}


def test_stages_keep_the_values_of_clashing_columns(spark):
    prose = " ".join(f"the house{i} of man{i} was in street{i}." for i in range(12))
    df = cases.documents(spark, [prose, prose + " ", prose, "junk"], [1, 2, -(2**63), 3])
    df = df.withColumns({"kept": F.lit("clash"), "n_words": F.lit("mine"), "m": F.create_map(F.lit(1), F.lit("x"))})
    df = df.unionByName(df)
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup):
        df = stage(spark, df, "")
        for r in df.collect():
            assert (r.kept, r.n_words, r.m) == ("clash", "mine", {1: "x"})
    assert [r.doc_id for r in df.collect()] == [2]


def test_near_kept_goes_by_ids(spark):
    from tidedock.llm import near

    words = [f"w{i}" for i in range(60)]
    df = cases.documents(spark, [" ".join(words), " ".join(["x", *words[1:]]), "other words here"], [7, 7, 8])
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near.near_groups(df).collect())
    assert got == [(7, 7, True), (7, 7, True), (8, 8, True)]
    assert near.kept_documents(df).count() == 2
