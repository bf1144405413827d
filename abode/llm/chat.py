"""Chat formatting with typed content parts.

A visitor flattens the parts of a turn, in order, into one string: text with
control strings escaped, and a placeholder for every image, audio clip or
document, whose reference, place and expanded token count are recorded. Turns
are marked by control strings that cannot occur inside escaped text, so the
output can be read back without loss.
"""

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

from abode.llm.common import col, released

START, END = "<|im_start|>", "<|im_end|>"
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
TILE, TILE_TOKENS, IMAGE_TOKENS = 512, 170, 85
AUDIO_TOKENS_A_SECOND = 25
PAGE_TOKENS = 1000

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document|part)\|>")


def escape(text: str) -> str:
    """``<|`` gets a backslash inside; one with backslashes gets one more."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Flattened:
    """What the visitor has built of one turn so far; places count code points."""

    text: str = ""
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)


class PartVisitor:
    """Flattens parts; ``learn`` says whether text of this turn is under the loss mask."""

    def __init__(self, opening: str, learn: bool):
        self.out, self.learn = Flattened(opening), learn

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        start = len(self.out.text)
        self.out.text += escape(part["text"] or "")
        if self.learn and len(self.out.text) > start:
            self.out.loss.append((start, len(self.out.text)))

    def visit_image(self, part: dict) -> None:
        tiles = math.ceil((part["width"] or 0) / TILE) * math.ceil((part["height"] or 0) / TILE)
        self._attach("image", part, IMAGE_TOKENS + TILE_TOKENS * tiles)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * AUDIO_TOKENS_A_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        self._attach("part", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.out.attachments.append({"kind": kind, "ref": part["ref"], "at": len(self.out.text), "tokens": tokens})
        self.out.text += f"<|{kind}|>"


def text_part(text: Column) -> Column:
    """A plain text as a list with one typed part."""
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), null("string").alias("ref"), null("int").alias("width"),
                            null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages"))).cast(PARTS)


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ATTACHMENT = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("ref", T.StringType()),
                                        T.StructField("at", T.IntegerType()), T.StructField("tokens", T.LongType())]))


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", learn_role: str = "assistant") -> DataFrame:
    """One row for each turn with its formatted ``piece``.

    The pieces of a conversation, in the order of ``turn_col``, then role and
    piece, are its formatted text; so no conversation is ever held as a whole.
    ``loss`` lists the spans of the piece under the loss mask, ``attachments``
    the references with kind, place and expanded token count, and
    ``expanded_tokens`` their sum.

    Null role: empty. Null or empty parts: an empty turn. Null text: empty.
    Parts of an unknown kind become ``<|part|>`` with no tokens. Repeated rows
    stay. Null conversation ids form a conversation of their own.
    """
    slim = turns.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"), F.coalesce(col(role_col), F.lit("")).alias("role"),
                        col(parts_col).cast(PARTS).alias("parts"))
    schema = T.StructType([*slim.schema.fields[:3], T.StructField("piece", T.StringType()), T.StructField("loss", _SPAN),
                           T.StructField("attachments", _ATTACHMENT), T.StructField("expanded_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        held = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int64())]))
        for batch in batches:
            flat = []
            for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                visitor = PartVisitor(f"{START}{escape_role(role)}\n", role == learn_role)
                for part in parts or ():
                    if part is not None:
                        visitor.visit(part)
                flat.append(visitor.out)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([f"{f.text}{END}\n" for f in flat], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in f.loss] for f in flat], span),
                 pa.array([f.attachments for f in flat], held), pa.array([sum(a["tokens"] for a in f.attachments) for f in flat], pa.int64())],
                names=schema.names)

    return slim.mapInArrow(released(run), schema)


def in_order(formatted: DataFrame) -> DataFrame:
    """Pieces of a conversation together and in order; conversations are spread by hash."""
    return formatted.repartition("conv").sortWithinPartitions("conv", "turn", "role", "piece")


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn, unescaped; placeholders leave no text."""
    if not piece.startswith(START) or not piece.endswith(f"{END}\n"):
        raise ValueError("not a formatted turn")
    role, _, body = piece[len(START):-len(END) - 1].partition("\n")
    return unescape_role(role), "".join(map(unescape, _PLACEHOLDER.split(body)))


class _Conversation:
    """Running digests of the conversation being read; its size does not matter."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.said, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, loss: list[dict]) -> None:
        role, text = read_piece(piece)
        self.turns += 1
        self.chars += len(piece)
        self.said.update(f"{role}\n{text}\n".encode())
        for span in loss:
            learnt = unescape(piece[span["start"]:span["end"]])
            self.loss_chars += len(learnt)
            self.learnt.update(learnt.encode())

    def row(self) -> dict:
        return {"conv": self.conv, "n_turns": self.turns, "turns_sha256": self.said.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.learnt.hexdigest(), "formatted_chars": self.chars}


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, read from its formatted pieces.

    A digest over a conversation is sequential, so its pieces meet in one task,
    but they stream through it: memory holds one batch and two hash states.
    """
    ordered = in_order(formatted.select("conv", "turn", "role", "piece", "loss")).select("conv", "piece", "loss")
    kinds = {"n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}
    schema = T.StructType([ordered.schema["conv"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        kind = None
        batch_of = lambda rows: pa.RecordBatch.from_pylist(rows, pa.schema([("conv", kind), *kinds.items()]))
        for batch in batches:
            kind, done = batch.column(0).type, []
            for conv, piece, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv)
                now.add(piece, loss)
            yield batch_of(done)
        if now is not None:
            yield batch_of([now.row()])

    return ordered.mapInArrow(released(run), schema)
