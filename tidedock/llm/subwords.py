"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Text is normalised as the model asks (white space becomes a mark) and cut into marked words: a run of marks with
the characters up to the next mark. No piece of a suitable model crosses that border, so the best segmentation of
a text is that of its words. The distinct unknown words of a batch are sorted, which lines up the branches of their
trie in depth-first order; going from one word to the next keeps the forward scores of the common prefix and only
computes those of the characters behind it.

A segmentation's score is the sum of its pieces' scores; of equal ones the longer last piece wins. A character that
no piece covers costs ten less than the worst piece and is written as byte pieces (or the unknown id if the model
has none). Models with pieces across marks are treated as one word per text. The model is used as a lattice of
scored pieces whatever it was trained for: on a merge-trained vocabulary ids can differ from those of its merges.

Null text is empty: no ids, decoded as the empty text. Repeated rows give equal rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidedock.llm.tables import cached_bytes
from tidedock.llm.textbytes import batches_of

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes of known words per generation, and of the texts of one step.
CACHE_BYTES, STEP_BYTES = 16 << 20, 1 << 20

_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Lattice:
    """Pieces and scores of a model, and the ids of known words in two generations of about ``limit`` bytes each."""

    def __init__(self, path: str, limit: int = CACHE_BYTES) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        count = self.model.get_piece_size()
        self.score: dict[str, tuple[float, bytes]] = {}
        self.reach: dict[str, int] = {}  # length of the longest piece that ends with a character
        self.byte = [-1] * 256
        self.out: list[bytes] = [b""] * count
        worst = 0.0
        for number in range(count):
            piece = self.model.id_to_piece(number)
            if self.model.is_byte(number):
                value = int(piece[3:5], 16)
                self.byte[value] = number
                self.out[number] = bytes([value])
            elif self.model.is_unknown(number):
                self.out[number] = " ⁇ ".encode()
            elif not self.model.is_control(number) and not self.model.is_unused(number):
                self.score[piece] = (self.model.get_score(number), _bytes([number]))
                self.reach[piece[-1]] = max(self.reach.get(piece[-1], 0), len(piece))
                self.out[number] = piece.replace(MARK, " ").encode()
                worst = min(worst, self.model.get_score(number))
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.by_word = all(re.fullmatch(f"{MARK}*[^{MARK}]*", p) for p in self.score)
        self.dummy = self.model.normalize("a").startswith(MARK) if hasattr(self.model, "normalize") else True
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.bytes = 0

    def words(self, text: str) -> list[str]:
        marked = self.model.normalize(text)
        return _WORD.findall(marked) if self.by_word else [marked] if marked else []

    def _unknown(self, char: str) -> list[int]:
        numbers = [self.byte[b] for b in char.encode()]
        return numbers if min(numbers) >= 0 else [self.model.unk_id()]

    def segment(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of the best pieces of each distinct word, in sorted order.

        ``best`` holds the forward score of every prefix of the word at hand, ``start`` and ``last`` where its last piece begins and
        that piece's ids, so that memory follows the length of a word; the ids are traced back from its end.
        """
        best, start, last_ids = [0.0], [0], [b""]
        path = ""
        find, reach = self.score.get, self.reach.get
        for word in sorted(words):
            shared = 0
            for a, b in zip(path, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], start[shared + 1 :], last_ids[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                char = word[end - 1]
                top = None
                for s in range(max(0, end - reach(char, 0)), end):
                    found = find(word[s:end])
                    if found is not None:
                        score = best[s] + found[0]
                        if top is None or score > top:
                            top, where, last = score, s, found[1]
                if char not in self.score:
                    score = best[end - 1] + self.unknown_score
                    if top is None or score > top:
                        top, where, last = score, end - 1, _bytes(self._unknown(char))
                best.append(top)
                start.append(where)
                last_ids.append(last)
            path = word
            pieces, at = [], len(word)
            while at:
                pieces.append(last_ids[at])
                at = start[at]
            yield word, b"".join(reversed(pieces))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = [self.words(t) if t else [] for t in texts]
        if self.bytes > self.limit:
            self.old, self.young, self.bytes = self.young, {}, 0
        before = len(self.young)
        unknown = {w for words in split for w in words} - self.young.keys()
        for word in list(unknown):
            if word in self.old:
                self.young[word] = self.old[word]
                unknown.discard(word)
        self.young.update(self.segment(list(unknown)))
        self.bytes += cached_bytes(self.young, len(self.young) - before)
        known = self.young
        for words in split:
            yield b"".join([known[w] for w in words])

    def decode(self, ids: bytes) -> str:
        out = self.out
        raw = b"".join([out[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return raw[1:] if self.dummy and raw.startswith(" ") else raw


_lattices: dict[str, Lattice] = {}


def lattice(path: str | None = None) -> Lattice:
    """One per Python worker, so that known words stay known from task to task."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    if path not in _lattices:
        _lattices[path] = Lattice(path)
    return _lattices[path]


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids) with ids as little-endian unsigned 32-bit numbers; ``model`` is a file every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lattice(model)
        for batch in batches:
            for part in batches_of(batch, "text", STEP_BYTES):
                ids = list(known.encode(part.column("text").to_pylist()))
                yield pa.record_batch([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lattice(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [known.decode(i.as_py() or b"") for i in part.column("ids")]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")
