import cases
import corpus_pipeline
import duckdb
import oracle_check
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidedock.llm import quality

NAMES = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]


def _prose(k):
    return " ".join(f"the house{i}{k} of man{i}{k} was in street{i}{k}." for i in range(14))


def test_stages_on_planted_cases(spark, tmp_path):
    first, near = _prose("a"), _prose("a").replace("house7a", "home")
    passage = " ".join(f"passage{i}" for i in range(60))
    texts = [first, first + " ", near, _prose("b"), _prose("c") + "\n" + passage, _prose("d") + "\n" + passage, "junk", None]
    df = cases.documents(spark, texts).withColumn("kept", F.lit("clash"))
    path = str(tmp_path / "docs")
    df.write.parquet(path)
    docs = spark.read.parquet(path)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == df.columns
        out.write.parquet(f"{path}-{name}")
        docs = spark.read.parquet(f"{path}-{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert set(seen["quality_rules"]) == {0, 1, 2, 3, 4, 5}
    assert set(seen["exact_dedup"]) == {1, 2, 3, 4, 5}  # the longer of two equal texts
    assert set(seen["near_dedup"]) == {1, 3, 4, 5}
    kept = seen["suffix_array_dedup"]
    assert kept[4].text == texts[4] and "passage30" not in kept[5].text and kept[5].text.startswith(_prose("d")[:200])
    assert set(seen["best_fit_packing"]) == {1, 3, 4, 5}


def test_stages_on_an_empty_table(spark):
    docs = cases.documents(spark, ["x"]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert rows and {r.doc_id for r in rows} <= good


@pytest.mark.parametrize("name", NAMES)
def test_queries_on_small_tables(spark, name):
    con = oracle_check.duck("/root/testdata/sf0.001")
    ok, note = oracle_check.compare(name, spark, con, "/root/testdata/sf0.001")
    assert ok, note


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in NAMES] == list(range(1, 14)) and duckdb
