"""Language identification by compressed length.

For every language a zstandard raw-content dictionary holds its words, learned from a bounded sample
of labelled documents. A text is encoded whole with each dictionary; the smallest result names the language.
``score`` is the softmax of the differences, and ``accepted`` is false where the margin is narrow.

Null texts and texts without a letter are ``und`` with score 0, as is everything if no labelled document exists.
Ties go to the alphabetically first language. Repeated rows give equal rows; an empty table an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedock.llm.compression import bounded_sample, compressor, dictionary, distinct_texts, document_frequency, letters, passage

#: Documents per language that are learned from, and the longest of them in characters.
SAMPLE_PER_LANGUAGE = 400
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 32 * 1024
LEVEL = 6
#: Bytes of difference for which the odds change by a factor of e, and the least accepted share of saved bytes.
TEMPERATURE = 4.0
MARGIN = 0.02
UNDETERMINED = "und"


def learn(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, bytes]:
    """Dictionaries from rows of (doc_id, text, lang); null texts and labels are left out."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = bounded_sample(rows.select("doc_id", passage(SAMPLE_CHARS).alias("text"), "lang"), "lang", per_language, 6)
    texts: dict[str, list[str]] = {}
    for row in sample.select("lang", "text").collect():  # bounded by languages x per_language x SAMPLE_CHARS
        texts.setdefault(row["lang"], []).append(letters(row["text"]))
    out = {}
    for lang in sorted(texts):
        ordered = sorted(texts[lang])
        found = document_frequency([ordered[i] for i in distinct_texts(ordered)])
        words = sorted(found, key=lambda w: (-found[w], w))
        out[lang] = dictionary(words, DICTIONARY_BYTES)
    return out


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) for every row of ``docs``."""
    names = sorted(dictionaries)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [compressor(dictionaries[n], LEVEL) for n in names]
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py()
                if not models or not text or not any(map(str.isalpha, text)):
                    rows.append((UNDETERMINED, 0.0, False))
                    continue
                raw = letters(text).encode()
                sizes = np.array([len(m.compress(raw)) for m in models], float)
                best = int(sizes.argmin())
                odds = np.exp((sizes[best] - sizes) / TEMPERATURE)
                others = np.delete(sizes, best)
                wide = not len(others) or others.min() - sizes[best] >= margin * sizes[best]
                rows.append((names[best], float(1 / odds.sum()), bool(wide)))
            columns = list(zip(*rows)) or [()] * 3
            kinds = [pa.string(), pa.float64(), pa.bool_()]
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, accepted boolean"
    )
