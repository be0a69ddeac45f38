"""URL filter lists: host-suffix and path-prefix expressions looked up by digest.

A URL expands into every host suffix joined with every path prefix that some rule could have. Each expression
gets a SHA-256 digest; the first four bytes are the equi-join key against the rules, full digests confirm.
The longest fitting rule (host and path together, then the longer host, then the action ``block``) decides,
otherwise the verdict is ``allow``. Expressions are deduplicated before the join, so a host that holds a third
of all rows is looked up once per distinct expression.

Null or malformed URLs (no ``://``) have an empty host and path, fit no rule and are allowed. Repeated rows
give equal rows; rows of ``pages`` with null ``page_id`` are judged like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to this count are broadcast; beyond it the equi-join shuffles.
BROADCAST_RULES = 100_000

# The rules of the contract, as (host, path, action).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _suffixes(host: Column, sizes: list[int]) -> Column:
    """Those of the host and its parent domains that have as many labels as some rule's host."""
    known = F.array(*[F.lit(n) for n in sizes]).cast("array<int>")
    n_labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    fitting = F.transform(F.filter(known, lambda n: n <= n_labels), lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(fitting)


def _prefixes(path: Column, lengths: list[int]) -> Column:
    """Prefixes of the lengths that some rule's path has."""
    known = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    return F.transform(F.filter(known, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with their digests; of equal expressions ``block`` wins. Null parts are dropped."""
    clean = rules.where("host IS NOT NULL AND path IS NOT NULL AND action IN ('allow', 'block')")
    clean = clean.withColumn("host", F.translate("host", UPPER, LOWER))
    one = clean.groupBy("host", "path").agg(F.max("action").alias("action"))
    digest = _digest(F.col("host"), F.col("path"))
    return one.select(
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        "action",
        digest.alias("rule_digest"),
        F.substring(digest, 1, 8).alias("prefix"),
    )


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict."""
    table = rule_table(rules)
    count = table.count()
    # Distinct lengths, not rules: bounded by the longest path of a rule.
    lengths = [r[0] for r in table.select(F.length("rule_path").alias("n")).distinct().orderBy("n").collect()]
    labels = F.size(F.split("rule_host", r"\.")).alias("n")
    sizes = [r[0] for r in table.select(labels).distinct().orderBy("n").collect()]
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("_head", F.substring("path", 1, max(lengths, default=0)))

    heads = parts.select("host", "_head").distinct()
    pairs = heads.withColumn("h", F.explode(_suffixes(F.col("host"), sizes)))
    pairs = pairs.withColumn("p", F.explode(_prefixes(F.col("_head"), lengths)))
    digest = _digest(F.col("h"), F.col("p"))
    pairs = pairs.withColumn("digest", digest).withColumn("prefix", F.substring("digest", 1, 8))

    hits = pairs.join(F.broadcast(table) if count <= BROADCAST_RULES else table, "prefix")
    hits = hits.where(F.col("digest") == F.col("rule_digest"))
    order = F.struct(
        F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("action"), F.col("rule_path")
    )
    best = hits.groupBy("host", "_head").agg(
        F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "action"), order).alias("best")
    )
    judged = parts.join(best, ["host", "_head"], "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit("allow")).alias("verdict"),
    )
