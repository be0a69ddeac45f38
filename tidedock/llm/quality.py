"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Words are maximal runs outside ``[\\x20\\x09-\\x0D]``. A null text counts as empty: no words, no lines with
words, ``base_failed``. Every input row gives one output row; repeated rows give equal rows. Columns other
than ``text`` are passed through untouched, columns of the same names as new ones are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedock.llm.tables import SPACE_CLASS, SPACES, text_or_empty, without

# Characters that count as symbols, and frequent function words of four languages.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to in that is was for with as on be by this are from at an it or "
    "der die das und den von zu mit sich des auf für ist im nicht ein eine dem auch "
    "le la les de et en un une du que est pour dans qui par sur pas au "
    "el los las y del por con para es se no lo al como su"
).split()

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class Rule(NamedTuple):
    """Keeps a document if ``low * per <= measure`` and ``measure <= high * per``; both sides are counts."""

    measure: str
    per: str
    low: float | None = None
    high: float | None = None


#: The method's own verdict, besides ``base_failed``.
THRESHOLDS = (
    Rule("word_chars", "n_words", 2.0, 16.0),
    Rule("n_symbols", "n_words", high=0.1),
    Rule("n_stop_words", "n_words", low=0.06),
    Rule("n_dup_lines", "n_lines", high=0.7),
)


def _hashes(words: Column) -> Column:
    """A 64-bit hash of every 3-word window."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def _windows(words: Column) -> Column:
    """All 3-word windows with a leading hash, which decides most comparisons, and their position."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
            w.alias("a"),
            F.get(words, i + 1).alias("b"),
            F.get(words, i + 2).alias("c"),
            i.alias("i"),
        ),
    )


def _same(x: Column, y: Column) -> Column:
    equal = (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    return F.coalesce(equal, F.lit(False))


def _covered(positions: Column) -> Column:
    """Words in the union of the windows at the sorted ``positions``."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        positions,
        start,
        lambda s, p: F.struct(p.alias("last"), (s["total"] + F.least(F.lit(3), p - s["last"])).alias("total")),
        lambda s: s["total"],
    )


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of ``MEASURES`` and ``n_stop_words``, ``n_lines`` (lines with a word)."""
    text = text_or_empty()
    split = docs.withColumns(
        {
            "_words": F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != ""),
            "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    # Without two equal hashes there is no repeat, and nothing to sort.
    hashed = split.withColumn("_hashes", _hashes(F.col("_words")))
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ordered = hashed.withColumn("_windows", F.when(some, F.sort_array(_windows(F.col("_words")))))
    w = F.col("_windows")
    same = F.filter(w, lambda x, i: _same(x, F.get(w, i - 1)) | _same(x, F.get(w, i + 1)))
    repeated = ordered.withColumn("_repeats", F.sort_array(F.transform(same, lambda x: x["i"])))
    counted = repeated.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(without(text, SPACES)).cast("long"),
            "n_symbols": (F.length(text) - F.length(without(text, SYMBOLS))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(_covered(F.col("_repeats")), F.lit(0)).cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
        }
    )
    return counted.drop("_words", "_lines", "_hashes", "_windows", "_repeats")


def verdict(rules: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """One boolean expression from the table of thresholds."""
    passed = F.lit(True)
    for rule in rules:
        value, base = F.col(rule.measure), F.col(rule.per)
        if rule.low is not None:
            passed = passed & (value >= F.lit(rule.low) * base)
        if rule.high is not None:
            passed = passed & (value <= F.lit(rule.high) * base)
    return passed


def judge(docs: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """``docs`` with all counts, ``base_failed`` and ``kept``."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measure(docs).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def kept_documents(docs: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """The rows that pass, with the columns they came with.

    Counts are taken beside the row, so input columns of their names stay as they are. The row number keeps the filter above the counts: pushed below them it would repeat their expressions, the sorted windows
    inside a lambda among them, once per element.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_input"), "text")
    judged = judge(rows, rules).withColumn("_row", F.monotonically_increasing_id())
    return judged.where("kept AND _row >= 0").select("_input.*")
