"""Conversations of typed parts as training texts with a loss mask.

A message is a list of parts: text, image, audio or document.  A visitor flattens the parts
of all messages of a conversation, in order, into one text.  Attachments leave a numbered
placeholder; what they refer to and how many tokens they stand for in the model's input is
recorded beside the text.  Texts are escaped, so whatever stands between angle brackets in
the result was written by the template, and the result can be read back without loss.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
TURN, OPENED, CLOSED = "<turn ", ">\n", "</turn>\n"
#: Escapes, in the order in which they are written; they are read back in reverse.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))

#: One part: its kind, the text or the reference, and the sizes that decide on its tokens.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<number:int,kind:string,ref:string,turn:int,place:long,tokens:long>"
FORMATTED = f"formatted string, n_turns long, loss array<struct<start:long,end:long>>, attachments array<{ATTACHMENT}>, text_tokens long, expanded_tokens long"


def escape(text: str) -> str:
    for plain, written in ESCAPES:
        text = text.replace(plain, written)
    return text


def unescape(text: Column) -> Column:
    """Undoes :func:`escape`: every backslash of an escaped text begins one of the escapes."""
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


@dataclass(frozen=True)
class Expansion:
    """Tokens that attachments take in the model's input, as parameters of the model."""

    patch: int = 28  # pixels of a side of an image patch, one token each
    default_image: int = 256
    audio_rate: float = 25.0  # tokens a second
    default_audio: int = 750
    page: int = 512  # tokens of a document page

    def image(self, width: int | None, height: int | None) -> int:
        if not width or not height or width < 0 or height < 0:
            return self.default_image
        return -(-width // self.patch) * -(-height // self.patch)

    def audio(self, seconds: float | None) -> int:
        if seconds is None or not math.isfinite(seconds) or seconds < 0:
            return self.default_audio
        return math.ceil(seconds * self.audio_rate)

    def document(self, pages: int | None) -> int:
        return self.page * max(pages if pages is not None else 1, 0)


@dataclass
class Flattener:
    """Visits the parts of one conversation and holds what it has written so far."""

    expansion: Expansion
    count: Callable[[str], int]
    written: list[str] = field(default_factory=list)
    length: int = 0
    turn: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    text_tokens: int = 0

    def write(self, text: str) -> None:
        self.written.append(text)
        self.length += len(text)

    def visit(self, part: dict) -> None:
        """Dispatches on the kind; a kind that is not known ends with an error."""
        visitor = getattr(self, f"visit_{part['kind']}", None)
        if visitor is None:
            raise ValueError(f"no such kind of part: {part['kind']!r}")
        visitor(part)

    def visit_text(self, part: dict) -> None:
        text = part["text"] or ""
        self.text_tokens += self.count(text)
        self.write(escape(text))

    def visit_image(self, part: dict) -> None:
        self._attach(part, self.expansion.image(part["width"], part["height"]))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, self.expansion.audio(part["seconds"]))

    def visit_document(self, part: dict) -> None:
        self._attach(part, self.expansion.document(part["pages"]))

    def _attach(self, part: dict, tokens: int) -> None:
        number = len(self.attachments)
        self.attachments.append(
            {"number": number, "kind": part["kind"], "ref": part["ref"], "turn": self.turn, "place": self.length, "tokens": tokens}
        )
        self.write(f"<{part['kind']} {number}>")

    def message(self, role: str | None, parts: list[dict], learnt: bool) -> None:
        self.write(f"{TURN}{escape(role or '')}{OPENED}")
        start = self.length
        for part in parts:
            self.visit(part)
        if learnt:
            self.loss.append({"start": start, "end": self.length})
        self.write(CLOSED)
        self.turn += 1

    def result(self) -> dict:
        return {
            "formatted": "".join(self.written),
            "n_turns": self.turn,
            "loss": self.loss,
            "attachments": self.attachments,
            "text_tokens": self.text_tokens,
            "expanded_tokens": self.text_tokens + sum(a["tokens"] for a in self.attachments),
        }


def count_words(text: str) -> int:
    """Stands for a tokenizer where none is given."""
    return len(text.split())


def text_part(text: Column) -> Column:
    """A text as a message's only part."""
    none = F.lit(None)
    return F.struct(
        F.lit("text").alias("kind"), text.alias("text"), none.cast("string").alias("ref"), none.cast("int").alias("width"),
        none.cast("int").alias("height"), none.cast("double").alias("seconds"), none.cast("int").alias("pages"),
    )


def format_conversations(
    messages: DataFrame,
    learn: str = "assistant",
    expansion: Expansion = Expansion(),
    count: Callable[[str], int] = count_words,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
) -> DataFrame:
    """One row per conversation: its id and the columns of ``FORMATTED``.

    ``parts`` is an array of ``PART`` structs.  ``loss`` spans the bodies of the messages of
    role ``learn``, in code points of ``formatted``, placeholders included.
    ``expanded_tokens`` counts the texts by ``count`` and each attachment as what its
    placeholder expands to.

    Messages are ordered by turn, NULL first, and on a tie by role and parts; repeated rows
    are messages of their own.  A NULL role is an empty one; NULL parts, NULL text and empty
    arrays give an empty body.  Rows without a conversation id form one conversation.  An
    empty table gives no rows; other columns are not read.  A conversation is one row, so its
    texts have to fit into one.
    """
    body = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    message = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), body.alias("parts"))
    grouped = messages.groupBy(F.col(conversation).alias("_conversation")).agg(F.sort_array(F.collect_list(message)).alias("messages"))
    kind = messages.schema[conversation].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out = []
                for found in some.column("messages").to_pylist():
                    flat = Flattener(expansion, count)
                    for m in found:
                        flat.message(m["role"], [p for p in m["parts"] if p is not None], m["role"] == learn)
                    out.append(flat.result())
                columns = [pa.array([x[f.name] for x in out], type=f.type) for f in schema]
                yield pa.RecordBatch.from_arrays([some.column("_conversation"), *columns], names=["_conversation", *schema.names])

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    attachment = pa.struct(
        [("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("turn", pa.int32()), ("place", pa.int64()), ("tokens", pa.int64())]
    )
    schema = pa.schema(
        [("formatted", pa.string()), ("n_turns", pa.int64()), ("loss", span), ("attachments", pa.list_(attachment)), ("text_tokens", pa.int64()), ("expanded_tokens", pa.int64())]
    )
    return grouped.mapInArrow(run, f"_conversation {kind}, {FORMATTED}").withColumnRenamed("_conversation", conversation)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, body>>``, bodies still escaped."""
    pieces = F.split(formatted, CLOSED)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, OPENED, 1)
        return F.struct(
            unescape(F.substring(head, F.lit(len(TURN) + 1), F.length(head))).alias("role"),
            F.substring(piece, F.length(head) + len(OPENED) + 1, F.length(piece)).alias("body"),
        )

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def read_parts(body: Column) -> Column:
    """The parts of an escaped body: ``array<struct<text, kind, number>>``.

    Neighbouring texts come back as one, empty texts not at all.
    """
    def part(piece: Column) -> Column:
        mark = piece.startswith("<")
        inner = F.split(F.substring(piece, 2, F.length(piece) - 2), " ")
        return F.struct(
            F.when(~mark, unescape(piece)).alias("text"),
            F.when(mark, F.get(inner, F.lit(0))).alias("kind"),
            F.when(mark, F.get(inner, F.lit(1)).try_cast("int")).alias("number"),
        )

    return F.transform(F.filter(F.split(body, "(?=<)|(?<=>)"), lambda x: x != ""), part)


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, one span after the other, without the escapes."""
    spans = F.transform(loss, lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return unescape(F.array_join(spans, ""))
