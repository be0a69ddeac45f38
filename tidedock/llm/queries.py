"""One query per operator over whole tables, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedock.catalog.registry import query
from tidedock.llm import (
    alignment, chat, exact, language, lines, merkle, near, packing, quality, repeats, subwords, toxicity, urls,
)
from tidedock.llm.tables import crc_fold, read

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"), plain=False)


@query("op2_sentencepiece")
def sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Encodes every text and decodes the ids again."""
    docs = read(spark, sf, "documents")
    decoded = subwords.decode(subwords.encode(docs.withColumn("doc_id", F.struct("doc_id", F.sha2("text", 256).alias("sha")))))
    plain = F.sha2(F.coalesce("text", F.lit("")), 256)
    return decoded.select(
        "doc_id.doc_id",
        (F.length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        plain.alias("decoded_sha256"),
        (plain == F.coalesce("doc_id.sha", F.sha2(F.lit(""), 256))).alias("restored"),
    )


@query("op3_toxicity")
def toxic_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    held_out = F.coalesce(crc_fold(5) == 0, F.lit(False))
    model = toxicity.learn(docs.where(~held_out), labels.where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP4_SQL = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS p FROM docs)),
firsts AS (SELECT w, min(doc_id) AS first_doc FROM starts GROUP BY w HAVING count(*) > 1),
hits AS (SELECT s.doc_id, s.p FROM starts s JOIN firsts f ON s.w = f.w WHERE s.doc_id > f.first_doc),
marked AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS fresh FROM hits),
numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked),
spans AS (SELECT doc_id, span, min(p) AS b, max(p) + 50 AS e FROM numbered GROUP BY doc_id, span),
edges AS (
  SELECT doc_id, e AS b, coalesce(lead(b) OVER (PARTITION BY doc_id ORDER BY b), 1000000000) AS e FROM spans
  UNION ALL SELECT doc_id, 0, min(b) FROM spans GROUP BY doc_id),
kept AS (
  SELECT x.doc_id, string_agg(substr(d.h, 2 * x.b + 1, 2 * (x.e - x.b)), '' ORDER BY x.b) AS h
  FROM edges x JOIN docs d ON x.doc_id = d.doc_id GROUP BY x.doc_id),
totals AS (SELECT doc_id, sum(e - b)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
  coalesce(t.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN totals t ON d.doc_id = t.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query("op4_suffix_array_dedup", OP4_SQL)
def suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = repeats.remove_repeats(read(spark, sf, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""


@query("op5_exact_dedup", OP5_SQL)
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_groups(read(spark, sf, "documents"))


@query("op6_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    held_out = F.coalesce(crc_fold(4) == 2, F.lit(False))
    dictionaries = language.learn(docs.where(~held_out))
    predicted = language.identify(docs, dictionaries)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0))),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


@query("op7_minhash_near_dedup", OP7_SQL)
def minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near.near_groups(read(spark, sf, "documents"))


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
OP8_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
pos AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM t),
tri AS (
  SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM pos WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
found AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL),
cover AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM found WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words, len(l)::BIGINT AS n_lines
  FROM t LEFT JOIN cover ON cover.doc_id = t.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND word_chars >= 2.0 * n_words AND word_chars <= 16.0 * n_words AND n_symbols <= 0.1 * n_words
    AND n_stop_words >= 0.06 * n_words AND n_dup_lines <= 0.7 * n_lines AS kept
FROM m
"""


@query("op8_quality_rules", OP8_SQL)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(read(spark, sf, "documents"))
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


OP9_SQL = rf"""
WITH p AS (
  SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(h, q, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
urls AS (SELECT DISTINCT host, path FROM p),
fits AS (
  SELECT host, path, max_by(h || q, length(h || q)) AS rule, max_by(action, length(h || q)) AS action
  FROM urls JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN fits ON p.host = fits.host AND p.path = fits.path
"""


@query("op9_url_filters", OP9_SQL)
def url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(urls.RULES, "host string, path string, action string")
    return urls.filter_urls(read(spark, sf, "pages"), rules)


_KEY_SQL = _LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")
OP10_SQL = f"""
WITH l AS (
  SELECT doc_id, i, line, {_KEY_SQL} AS key FROM (
    SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
k AS (SELECT key, max(doc_id) AS keep FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT l.*, k.keep IS NOT NULL AND l.doc_id <> k.keep AS dropped FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines.line_bitmaps(read(spark, sf, "documents"))
    return rows.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        lines.n_dropped(F.col("keep_bitmap")).cast("long").alias("n_dropped"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )

_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_FIELDS = " || ".join(_FIELD.format(c) for c in ["doc_id", "source", "lang", "{n}", "text"])
_CRC = (  # CRC-32 of a string, byte by byte
    "list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
    "lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"
)
_TREE = """
  SELECT tree, 0 AS level, p, h, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY tree, level, p // 2, n"""
_FOLD = """
  SELECT tree, p AS leaf, 0 AS level, p, {h} AS h, {proof} AS proof FROM {start}
  UNION ALL
  SELECT f.tree, f.leaf, f.level + 1, f.p // 2,
    sha256(CASE WHEN f.p % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END), f.proof || coalesce(s.h, '')
  FROM {name} f JOIN {tree} o ON o.tree = f.{key} AND o.level = f.level AND o.p = f.p AND o.n > 1
  LEFT JOIN {tree} s ON s.tree = f.{key} AND s.level = f.level AND s.p = xor(f.p, 1)"""
OP11_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT id, xor({_CRC.format("id")}, 4294967295) AS c FROM (SELECT DISTINCT doc_id::VARCHAR AS id FROM documents)),
leaves AS (
  SELECT doc_id, lang, sha256({_FIELDS.format(n="n_chars")}) AS leaf,
    CASE WHEN c % 7 = 0 AND n_chars IS NOT NULL THEN sha256({_FIELDS.format(n="(n_chars::HUGEINT + 1)")}) END AS altered
  FROM documents LEFT JOIN crc ON id = doc_id::VARCHAR),
placed AS (
  SELECT *, leaf AS h, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
nodes AS ({_TREE.format(leaves="placed", name="nodes")}),
subroots AS (SELECT -1::BIGINT AS tree, tree AS p, h, (SELECT count(DISTINCT tree) FROM placed) AS n FROM nodes WHERE n = 1),
top AS ({_TREE.format(leaves="subroots", name="top")}),
low AS ({_FOLD.format(h="coalesce(altered, leaf)", proof="''", start="placed", name="low", tree="nodes", key="tree")}),
reached AS (
  SELECT l.leaf AS place, l.tree AS own, l.h, l.proof, r.h AS subroot FROM low l
  JOIN nodes r ON r.n = 1 AND r.tree = l.tree AND r.level = l.level),
begun AS (SELECT own * 4294967296 + place AS tree, own AS p, h, proof FROM reached),
high AS (
  SELECT tree, 0 AS level, p, h, proof FROM begun
  UNION ALL
  SELECT f.tree, f.level + 1, f.p // 2,
    sha256(CASE WHEN f.p % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END), f.proof || coalesce(s.h, '')
  FROM high f JOIN top o ON o.level = f.level AND o.p = f.p AND o.n > 1
  LEFT JOIN top s ON s.level = f.level AND s.p = xor(f.p, 1)),
root AS (SELECT h, level FROM top WHERE n = 1)
SELECT d.doc_id, d.leaf, x.subroot, root.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM placed d JOIN reached x ON x.own = d.tree AND x.place = d.p
JOIN high f ON f.tree = d.tree * 4294967296 + d.p JOIN root ON root.level = f.level
"""


@query("op11_merkle_manifest", OP11_SQL)
def merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Proofs of all documents; those whose id's CRC-32 is a multiple of 7 claim one character more than they have."""
    docs = read(spark, sf, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    claimed = F.when(tampered & F.col("n_chars").isNotNull(), merkle.leaf_digest({"n_chars": more}))
    manifest = merkle.build(docs, {"claimed": claimed})
    return merkle.prove(manifest, manifest.leaves, "claimed")


#: A conversation whose texts hold escaped control strings.
TRAP = [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(["user", "assistant"])]
OP12_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '{TRAP[0][3]}'),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, text, role IS NOT DISTINCT FROM 'assistant' AS learned,
    len(regexp_extract_all(text, '###|</turn>')) + 4 + 2 + 9 + length(text) AS n,
    length(regexp_replace(coalesce(role, ''), '[\\\n:]', '..', 'g')) AS r
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE learned), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE learned), '')) AS loss_sha256,
  sum(n + r)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op12_chat_formatting", OP12_SQL)
def chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame(TRAP, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(rows.unionByName(trap)))


@query("op13_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(read(spark, sf, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
