"""Toxicity by compression distance.

Two zstandard dictionaries are learned from labelled documents: both hold the words that ordinary and toxic text
share, the toxic one also the words that are typical of toxic text (``typical_words``). Every window of a
text is compressed with both; the bytes saved by the toxic dictionary are its margin. The largest margin, the mean
margin, the share of windows over a threshold and the number of windows enter a logistic function whose weights are
calibrated on labelled documents that the dictionaries have not seen.

The sample of labelled rows is bounded (``SAMPLE_TOXIC``, ``SAMPLE_ORDINARY``, ``SAMPLE_CHARS``); every document is
scored whole. Null and empty texts have no windows and get the score of all-zero margins. Without labelled documents of
both classes every score is 0. Rows of ``labels`` that repeat an id count as toxic if one of them is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedock.llm.compression import (
    bounded_sample, compressor, cut_share, dictionary, distinct_texts, document_frequency, hash_share, letters, passage,
)

SAMPLE_TOXIC = 3_000
SAMPLE_ORDINARY = 6_000
SAMPLE_CHARS = 20_000
SALT = 3
WINDOW = 256
OVERLAP = 12
LEVEL = 7
SHARED_BYTES = 200 * 1024
TYPICAL_BYTES = 8 * 1024
#: A typical word occurs in this share of toxic documents and that many times as often as in ordinary ones.
TYPICAL_SHARE = 0.015
TYPICAL_RATIO = 50.0
#: Margin in bytes from which a window counts as conspicuous.
CONSPICUOUS = 3
N_FEATURES = 6


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    mean: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()


def typical_words(toxic: list[str], ordinary: list[str]) -> tuple[list[str], list[str]]:
    """Words typical of toxic text, and words for both dictionaries, each in order of importance."""
    in_toxic, in_ordinary = document_frequency(toxic), document_frequency(ordinary)
    n, m = len(toxic) + 1, len(ordinary) + 1

    def ratio(word: str) -> float:
        return ((in_toxic[word] + 0.5) / n) / ((in_ordinary[word] + 0.5) / m)

    least = max(3, TYPICAL_SHARE * len(toxic))
    bar = min(TYPICAL_RATIO, m / 4)  # few ordinary documents cannot show a large ratio
    typical = {w for w, c in in_toxic.items() if c >= least and ratio(w) >= bar}
    shared = [w for w in in_toxic.keys() | in_ordinary.keys() if w not in typical and ratio(w) < 4]
    shared.sort(key=lambda w: (-(in_toxic[w] + in_ordinary[w]), w))
    return sorted(typical, key=lambda w: (-in_toxic[w] * math.log(ratio(w)), w)), shared


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.toxic = compressor(model.toxic, LEVEL)
        self.ordinary = compressor(model.ordinary, LEVEL)

    def margins(self, text: str | None) -> np.ndarray:
        raw = letters(text).encode()
        if not raw.strip():
            return np.zeros(0)
        windows = [raw[i : i + WINDOW + OVERLAP] for i in range(0, len(raw), WINDOW)]
        plain, toxic = self.ordinary.compress, self.toxic.compress
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows], float)

    def features(self, text: str | None) -> list[float]:
        d = self.margins(text)
        if not len(d):
            return [0.0] * N_FEATURES
        positive = np.maximum(d, 0)
        return [
            float(d.max()),
            float(d.mean()),
            float((d >= CONSPICUOUS).mean()),
            float(np.log1p(len(d))),
            float(np.sqrt(positive.sum())),
            float(np.sort(d)[-3:].sum()),
        ]

    def score(self, text: str | None) -> float:
        if not self.model.weights:
            return 0.0
        x = (np.array(self.features(text)) - self.model.mean) / self.model.scale
        z = self.model.weights[0] + float(x @ np.array(self.model.weights[1:]))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> tuple[np.ndarray, ...]:
    """Weighted logistic regression by Newton steps on standardised features."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - penalty @ w
        curve = (z.T * (weight * p * (1 - p) + 1e-9)) @ z + penalty
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), both only of rows that may be learned from."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", passage(SAMPLE_CHARS).alias("text"))
    marks = marks.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    counts = {r[0]: r[1] for r in rows.select("doc_id").join(marks, "doc_id").groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return Model(b" ", b" ")
    # Which rows the first cut keeps is decided on hashes; texts move only for the ids that it names, few at any size.
    sizes = {1: SAMPLE_TOXIC, 0: SAMPLE_ORDINARY}
    hashed = rows.select("doc_id", hash_share(SALT).alias("share")).join(marks, "doc_id")
    least = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, cut_share(n, counts[k]))])
    named = hashed.where(F.col("share") < least[F.col("toxic")]).select("doc_id", "toxic").distinct()
    rows = rows.join(F.broadcast(named), "doc_id")
    toxic = bounded_sample(rows.where("toxic = 1"), "toxic", SAMPLE_TOXIC, SALT, {1: counts[1]})
    ordinary = bounded_sample(rows.where("toxic = 0"), "toxic", SAMPLE_ORDINARY, SALT, {0: counts[0]})
    sample = toxic.unionByName(ordinary).select("doc_id", "text", "toxic").collect()  # bounded by the parameters
    return fit(sample, counts)


def fit(sample: list, counts: dict[int, int]) -> Model:
    """Model from sampled rows (doc_id, text, toxic); ``counts`` has the number of all rows of each class."""
    sample = sorted(sample, key=lambda r: (r["doc_id"], r["text"]))
    texts = [letters(r["text"]) for r in sample]
    distinct = distinct_texts(texts)
    texts = [texts[i] for i in distinct]
    marked = np.array([sample[i]["toxic"] for i in distinct])
    # Every third document of each class calibrates, the others make the dictionaries.
    number = np.where(marked == 1, np.cumsum(marked), np.cumsum(1 - marked))
    held = number % 3 == 0
    if not (held & (marked == 1)).any() or not (held & (marked == 0)).any():
        held = np.ones(len(marked), bool)  # too few to keep some apart
        teach = held
    else:
        teach = ~held
    typical, shared = typical_words(
        [t for t, k in zip(texts, teach & (marked == 1)) if k], [t for t, k in zip(texts, teach & (marked == 0)) if k]
    )
    base = dictionary(shared, SHARED_BYTES)
    model = Model(dictionary(typical, TYPICAL_BYTES) + base, base)
    scorer = Scorer(model)
    x = np.array([scorer.features(t) for t, h in zip(texts, held) if h])
    y = marked[held].astype(float)
    drawn = {1: marked.sum() / counts[1], 0: (1 - marked).sum() / counts[0]}
    weight = np.where(y == 1, 1 / drawn[1], 1 / drawn[0])
    mean, scale, w = calibrate(x, y, weight / weight.mean())
    return Model(model.toxic, model.ordinary, tuple(mean), tuple(scale), tuple(w))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score double")
