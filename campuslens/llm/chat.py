"""Chat formatting of turns with typed content parts.

A turn is ``<|role|>``, a line feed, its flattened parts, ``<|end|>`` and a line feed. Texts (and
roles) are escaped so that no control string of this or other common templates survives in them: a
backslash becomes ``\\-``, and each control string gets ``\\+`` after its first character. Reading
back removes the second and restores the first."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm.common import stage

#: Control strings that texts must not contain after escaping (fixed values).
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_MARK = re.compile("|".join(rf"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"\\([-+])")
_TURN = re.compile(r"<\|([^|]*(?:\|(?!>)[^|]*)*)\|>\n(.*?)<\|end\|>\n", re.S)
#: Characters after which a conversation's output goes on in another row.
CHUNK_CHARS = 1 << 20
TRAINED_ROLE = "assistant"

PART = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("ref", T.StringType()), T.StructField("width", T.LongType()),
    T.StructField("height", T.LongType()), T.StructField("seconds", T.DoubleType()),
    T.StructField("pages", T.LongType())])
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
ATTACHMENT = T.StructType([
    T.StructField("turn", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("ref", T.StringType()), T.StructField("place", T.LongType()),
    T.StructField("tokens", T.LongType())])
FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("chunk", T.LongType()),
    T.StructField("formatted", T.StringType()), T.StructField("loss", T.ArrayType(SPAN)),
    T.StructField("attachments", T.ArrayType(ATTACHMENT))])
READ_BACK = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def escape(text: str) -> str:
    return _MARK.sub(r"\g<0>\\+", text.replace("\\", "\\-"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "-" else "", text)


@dataclass
class Visitor:
    """Flattens the parts of a turn in order. Attachments become numbered placeholders; the record
    of each has its reference, its place in the output and the tokens it will expand to."""

    trained: bool
    turn: int | None
    start: int
    number: int
    out: list[str] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    size: int = 0

    patch: int = 28
    audio_tokens_per_second: int = 25
    tokens_per_page: int = 640

    def visit(self, part: dict | None) -> None:
        if part is not None:
            kind = part.get("kind") or "text"
            getattr(self, f"visit_{kind}", self.visit_other)(part)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def visit_text(self, part: dict) -> None:
        text = escape(part.get("text") or "")
        if self.trained and text:
            at = self.start + self.size
            self.loss.append({"start": at, "end": at + len(text)})
        self._put(text)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"turn": self.turn, "kind": kind, "ref": part.get("ref"),
                                 "place": self.start + self.size, "tokens": tokens})
        self._put(f"<|{escape(kind)}:{self.number + len(self.attachments)}|>")

    def visit_image(self, part: dict) -> None:
        w, h = part.get("width") or 0, part.get("height") or 0
        self._attach("image", part, math.ceil(w / self.patch) * math.ceil(h / self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0)
                                              * self.audio_tokens_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.tokens_per_page)

    def visit_other(self, part: dict) -> None:
        self._attach(part["kind"], part, 0)


def text_part(text: Column) -> Column:
    """One text part, for tables of plain texts."""
    empty = {f.name: F.lit(None).cast(f.dataType) for f in PART.fields[2:]}
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"),
                            *[v.alias(k) for k, v in empty.items()]))


def format_chat(turns: DataFrame) -> DataFrame:
    """Formats ``turns`` (conv_id, turn, role, parts: array of PART).

    Returns rows of whole turns, conversations contiguous and chunks ascending in each partition:
    conv_id, chunk, formatted, loss (spans of the trained role's texts, escaped, in code points of
    this row) and attachments (place in code points of this row). A conversation goes on in further
    rows after CHUNK_CHARS, so memory stays bounded for any length. Turns go by (turn, role,
    content), null first; repeated rows are turns of their own; null roles and texts are empty, null
    parts and null lists hold nothing, a part without a kind is text, one of an unknown kind is an
    attachment of no tokens; rows with a null conv_id are one conversation; other columns are
    ignored. The turns of one conversation are read in order by one task, which streams them."""
    from pyspark.errors import PySparkTypeError
    if not isinstance(turns.schema["parts"].dataType, T.ArrayType):
        raise PySparkTypeError("parts must be an array of content parts")
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.col("role").cast("string"), F.col("parts"))
    rows = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", F.to_json("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chunk, number = (), 0, 0
        out, loss, attachments, size = [], [], [], 0

        def flush():
            row = {"conv_id": [current[0]], "chunk": [chunk], "formatted": ["".join(out)],
                   "loss": [loss], "attachments": [attachments]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema(
                [(f.name, _arrow(f.dataType)) for f in FORMATTED.fields]))

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in batch.slice(at, 512).to_pylist():
                    fresh = current != (row["conv_id"],)
                    if out and (fresh or size >= CHUNK_CHARS):
                        yield flush()
                        chunk += 1
                        out, loss, attachments, size = [], [], [], 0
                    if fresh:
                        current, chunk, number = (row["conv_id"],), 0, 0
                    role = row["role"] or ""
                    head = f"<|{escape(role)}|>\n"
                    visitor = Visitor(role == TRAINED_ROLE, row["turn"], size + len(head), number)
                    for part in row["parts"] or []:
                        visitor.visit(part)
                    text = f"{head}{''.join(visitor.out)}<|end|>\n"
                    out.append(text)
                    size += len(text)
                    loss += visitor.loss
                    attachments += visitor.attachments
                    number += len(visitor.attachments)
        if out:
            yield flush()

    return rows.mapInArrow(run, FORMATTED)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, content) of each turn, unescaped; placeholders stay as they are."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        yield unescape(m[1]), unescape(m[2])
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation from ``format_chat``'s rows, in the order it leaves them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = (), None

        def done():
            turns, loss, n, chars, total = state
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array([current[0]], pa.int64()), "n_turns": [n],
                "turns_sha256": [turns.hexdigest()], "loss_chars": [chars],
                "loss_sha256": [loss.hexdigest()], "formatted_chars": [total]})

        for batch in batches:
            for row in batch.to_pylist():
                if current != (row["conv_id"],):
                    if state:
                        yield done()
                    current, state = (row["conv_id"],), [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                text = row["formatted"]
                for role, content in parse(text):
                    state[0].update(f"{role}\n{content}\n".encode())
                    state[2] += 1
                for span in row["loss"]:
                    part = unescape(text[span["start"]:span["end"]])
                    state[1].update(part.encode())
                    state[3] += len(part)
                state[4] += len(text)
        if state:
            yield done()

    return formatted.mapInArrow(run, READ_BACK)


def chat_round_trip(turns: DataFrame) -> DataFrame:
    """Writes the formatted rows of ``turns`` to the shared folder and digests what is read back; the
    rows of a conversation are gathered again, as readers split and pack files as they like."""
    written = stage(format_chat(turns), "chat")
    return read_back(written.repartition("conv_id").sortWithinPartitions("conv_id", "chunk"))
