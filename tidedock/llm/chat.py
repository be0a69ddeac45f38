"""Chat formatting with a grammar round trip.

The grammar of a rendered conversation::

    conversation := turn*
    turn         := "### " role ":\n" text "\n</turn>\n"

A role has its backslashes, line ends and colons escaped (``\\\\``, ``\\n``, ``\\c``). The control strings ``###`` and ``</turn>`` may stand
in a text only behind a backslash, and the parser takes that one backslash off.

Every turn is rendered as it is, parsed again and compared with its source. If the parser fails or gives
another turn, a backslash is put before each control string, and it is tried again until both are identical. A turn begins
and ends with marks that its text cannot hold, so what holds for turns holds for a whole conversation; `read_back` nevertheless parses
the output as a stream, conversation by conversation.

Turns are rendered where they lie. Places within a conversation are running sums over its turns in order, and `read_back` passes over
sorted turns with one open hash per digest, so no conversation is held as a whole however many of the rows it has.

Nulls: a null text is empty, a null role is the empty role, null turn numbers come first, and rows without an id are one conversation.
Ties: turns with one number are ordered by role, then rendered text; repeated rows are turns as well. Texts are rendered whole, whatever
their length. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"

# The template.
OPEN, OPENED, CLOSE = "### ", ":\n", "\n</turn>\n"
CONTROL = ("###", "</turn>")

_CONTROL = re.compile("|".join(CONTROL))
_ESCAPED = re.compile(rf"\\({'|'.join(CONTROL)})")
_ROLE_ESCAPES = {"\\": "\\\\", "\n": "\\n", ":": "\\c"}
_ROLE_ESCAPED = re.compile(r"\\([\\nc])")
_ROLE_PLAIN = {"\\": "\\", "n": "\n", "c": ":"}


class GrammarError(ValueError):
    """A rendered conversation that the grammar does not allow."""


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns; start and end give the text's place in ``rendered``, still escaped."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(OPEN, at):
            raise GrammarError(f"no turn begins at {at}")
        head = rendered.find(OPENED, at)
        if head < 0 or "\n" in rendered[at:head]:
            raise GrammarError(f"no role at {at}")
        begin = head + len(OPENED)
        end = begin
        for m in _CONTROL.finditer(rendered, begin):
            if rendered[m.start() - 1] != "\\":
                end = m.start() - 1
                break
        else:
            raise GrammarError(f"the turn at {at} does not end")
        if not rendered.startswith(CLOSE, end) or end < begin:
            raise GrammarError(f"control string inside the turn at {at}")
        role = _ROLE_ESCAPED.sub(lambda m: _ROLE_PLAIN[m[1]], rendered[at + len(OPEN) : head])
        turns.append((role, _ESCAPED.sub(r"\1", rendered[begin:end]), begin, end))
        at = end + len(CLOSE)
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn and the place of its text in it, escaped until the parser gives back role and text."""
    head = OPEN + "".join(_ROLE_ESCAPES.get(c, c) for c in role) + OPENED
    body = text
    while True:
        rendered = head + body + CLOSE
        try:
            found = parse(rendered)
        except GrammarError:
            found = []
        if [t[:2] for t in found] == [(role, text)]:
            return rendered, found[0][2], found[0][3]
        body = _CONTROL.sub(r"\\\g<0>", body)


TURN_FIELDS = "rendered string, text_start long, text_end long, n_points long"


def format_turns(conversations: DataFrame, learned: str = LEARNED_ROLE) -> DataFrame:
    """One row per turn (conv_id, position, role, rendered, start, loss_start, loss_end).

    ``start`` is the place of the rendered turn in its conversation's output, whose turns follow each other in the order of ``position``;
    ``loss_start`` and ``loss_end`` bound the text in that output if the loss covers it (turns of role ``learned``), else they are null. All
    places count code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [render(r or "", t or "") for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            texts, starts, ends = zip(*done) if done else ((), (), ())
            yield pa.record_batch(
                [
                    *[batch.column(c) for c in ("conv_id", "turn", "role")],
                    pa.array(texts, pa.string()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["conv_id", "turn", "role", "rendered", "text_start", "text_end", "n_points"],
            )

    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn", "role")}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role {kinds['role']}, {TURN_FIELDS}"
    turns = conversations.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "rendered")
    running = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumns(
        {
            "position": F.row_number().over(order) - 1,
            "start": F.coalesce(F.sum("n_points").over(running), F.lit(0)),
        }
    )
    inside = F.col("role").eqNullSafe(F.lit(learned))
    return placed.select(
        "conv_id",
        "position",
        "role",
        "rendered",
        "start",
        F.when(inside, F.col("start") + F.col("text_start")).alias("loss_start"),
        F.when(inside, F.col("start") + F.col("text_end")).alias("loss_end"),
    )


class _Digest:
    """What is read back from one conversation's output."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, start: int, loss: tuple[int | None, int | None]) -> None:
        if start != self.chars:
            raise GrammarError("turns out of order")
        for role, text, begin, end in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if loss[0] is not None and loss[0] <= start + begin and start + end <= loss[1]:
                # The mask covers escaped text; what it stands for is the turn's.
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.chars += len(rendered)

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from parsing its output (rows of `format_turns`) as a stream in order."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = _Digest()
        for batch in batches:
            rows = []
            for conv, _, last, rendered, start, *loss in zip(*[c.to_pylist() for c in batch.columns]):
                digest.add(rendered, start, loss)
                if last:
                    rows.append((conv, *digest.row()))
                    digest = _Digest()
            columns = list(zip(*rows)) or [()] * 6
            kinds = [batch.schema.field("conv_id").type, *[pa.int64(), pa.string()] * 2, pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    # Leaves the rows of a conversation together and in order; needs no exchange behind `format_turns`.
    order = Window.partitionBy("conv_id").orderBy("position")
    ordered = formatted.withColumn("last", F.lead("position").over(order).isNull())
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.select("conv_id", "position", "last", "rendered", "start", "loss_start", "loss_end").mapInArrow(run, schema)
