"""Audit of how document filters interact, over counts of a byte transducer.

A table-driven transducer reads each text once as UTF-8 bytes. A table gives the class
of a byte, a second one the next state (between words, inside a word), a third one
what the step emits: a word begins, a capital, a symbol, a code point. The spans of the
words go to a hash table with open addressing; a slot counts as the same word only after
all of its bytes were compared. Tables are applied to whole pieces of text as arrays.

What the filters do in any order then follows from how many documents fail which
of them: documents are counted once by set of failed filters, and every order is
read off these counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.llm.common import col, released, stage

#: The symbols that are counted.
SYMBOLS = b"#$%&*|"
SPACE, CAPITAL, SYMBOL, INNER, OTHER = range(5)
BETWEEN, INSIDE = range(2)
#: What a step emits.
BEGIN, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8
#: Bytes read at once, and bytes of short texts whose words share a hash table.
PIECE = 1 << 20
COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def _classes() -> np.ndarray:
    found = np.full(256, OTHER, np.uint8)
    found[[0x20, *range(0x09, 0x0E)]] = SPACE
    found[ord("A"):ord("Z") + 1] = CAPITAL
    found[list(SYMBOLS)] = SYMBOL
    found[0x80:0xC0] = INNER  # goes on with a code point
    return found


def _emits() -> np.ndarray:
    """By state and class."""
    out = np.zeros((2, 5), np.uint8)
    out[BETWEEN, [CAPITAL, SYMBOL, INNER, OTHER]] |= BEGIN
    out[:, CAPITAL] |= IS_CAPITAL
    out[:, SYMBOL] |= IS_SYMBOL
    out[:, [SPACE, CAPITAL, SYMBOL, OTHER]] |= IS_POINT
    return out


CLASS = _classes()
#: The next state by class; it is the same from either state, so states of a piece are one look-up.
NEXT = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
EMIT = _emits()
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """Hash table of word spans of one buffer, by owner.

    Slots hold the number of a span; probing is linear. Spans that meet in a slot are
    the same word if owner, length and all bytes agree, whatever their hashes.
    """

    def __init__(self, data: np.ndarray):
        """``data`` ends with eight bytes more than any span."""
        self.eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))

    def _eight(self, starts: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k+7 of spans that are longer than 8k."""
        return self.eights[starts + 8 * k] & _MASKS[np.minimum(lengths - 8 * k, 8)]

    def hashes(self, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
        found, k, at = (owners.astype(np.uint64) * _MIX) ^ lengths.astype(np.uint64), 0, np.arange(len(starts))
        while len(at):
            mixed = (found[at] ^ self._eight(starts[at], lengths[at], k)) * _MIX
            found[at] = mixed ^ (mixed >> np.uint64(32))
            k += 1
            at = at[lengths[at] > 8 * k]
        return found

    def same(self, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans ``a`` and ``b`` of equal lengths hold the same bytes."""
        out, k, at = np.ones(len(a), bool), 0, np.arange(len(a))
        while len(at):
            x, y = a[at], b[at]
            equal = self._eight(starts[x], lengths[x], k) == self._eight(starts[y], lengths[y], k)
            out[at[~equal]] = False
            k += 1
            at = at[equal & (lengths[x] > 8 * k)]
        return out

    def distinct(self, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """Mark of the spans that got a slot of their own: one of each word of an owner."""
        n = len(starts)
        room = 1 << max(4, (2 * n).bit_length())
        slots, fresh = np.full(room, -1, np.int64), np.zeros(n, bool)
        at = (self.hashes(starts, lengths, owners) & np.uint64(room - 1)).astype(np.int64)
        pending = np.arange(n)
        while len(pending):
            place = at[pending]
            empty = slots[place] < 0
            slots[place[empty]] = pending[empty]  # of several, one gets the slot
            holder = slots[place]
            own = holder == pending
            fresh[pending[own]] = True
            alike = ~own & (owners[holder] == owners[pending]) & (lengths[holder] == lengths[pending])
            check = np.flatnonzero(alike)
            alike[check] = self.same(starts, lengths, holder[check], pending[check])
            pending = pending[~own & ~alike]
            at[pending] = (at[pending] + 1) & (room - 1)
        return fresh


def _transduce(data: np.ndarray, edges: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Capitals, code points and symbols of each text, starts and ends of words.

    Text i is ``data[edges[i]:edges[i + 1]]``; the state is carried over pieces and set back at each text.
    """
    totals = [np.zeros(len(edges) - 1, np.int64) for _ in range(3)]
    begins, stops = [], []
    state, first, last = BETWEEN, int(edges[0]), int(edges[-1])
    while first < last:
        until = min(first + PIECE, last)
        classes = CLASS[data[first:until]]
        states = NEXT[classes]
        before = np.concatenate((np.array([state], np.uint8), states[:-1]))
        inner = edges[(edges >= first) & (edges < until)] - first
        before[inner] = BETWEEN
        emitted = EMIT.ravel()[before * np.uint8(5) + classes]
        begins.append(np.flatnonzero(emitted & BEGIN) + first)
        ended = np.concatenate(([state == INSIDE], states[:-1] == INSIDE)) & ((states == BETWEEN) | (emitted & BEGIN > 0))
        stops.append(np.flatnonzero(ended) + first)
        for total, flag in zip(totals, (IS_CAPITAL, IS_POINT, IS_SYMBOL)):
            sums = np.concatenate(([0], np.cumsum(emitted & flag > 0)))
            within = np.clip(edges, first, until) - first
            total += sums[within[1:]] - sums[within[:-1]]
        state, first = int(states[-1]), until
    if state == INSIDE:
        stops.append(np.array([last]))
    none = np.zeros(0, np.int64)
    return totals, np.concatenate([none, *begins]), np.concatenate([none, *stops])


def text_counts(texts: pa.Array) -> list[np.ndarray]:
    """The ``COUNTS`` of each text; a null text is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    out = [np.zeros(len(texts), np.int64) for _ in COUNTS]
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + PIECE, side="right")) - 1)
        base, end = int(edges[first]), int(edges[last])
        data = np.concatenate((raw[base:end], np.zeros(8, np.uint8)))
        own = edges[first:last + 1] - base
        totals, starts, stops = _transduce(data, own)
        owners = np.searchsorted(own, starts, side="right") - 1
        fresh = Words(data).distinct(starts, stops - starts, owners)
        size = last - first
        for column, found in zip(out, (np.bincount(owners, minlength=size), np.bincount(owners[fresh], minlength=size), *totals)):
            column[first:last] = found
        first = last
    return out


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id``, ``part`` (null: empty string), ``COUNTS`` and ``digest`` (SHA-256 of the text; null: empty) of every row."""
    slim = docs.select(col(id_col).alias("id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"), col(text_col).alias("text"))
    fields = [*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("digest", T.BinaryType())]
    schema = T.StructType([*slim.schema.fields[:2], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            raw = pc.fill_null(texts, "").cast(pa.large_binary())
            digest = pa.array([hashlib.sha256(v.as_buffer()).digest() for v in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, text_counts(texts)), digest], names=schema.names)

    return slim.mapInArrow(released(run), schema)


def with_earlier_copy(rows: DataFrame, key: str = "digest", id_col: str = "id") -> DataFrame:
    """``rows`` with ``copied``: whether a row with a smaller id has the same key.

    Rows without an id never are copies, nor make copies. Only keys of two rows or more
    are joined, so a hot key is counted by partial aggregation and meets its rows in a join that Spark can split.
    """
    shared = rows.groupBy(key).agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(key, "least")
    return rows.join(shared, key, "left").withColumn("copied", F.coalesce(col(id_col) > F.col("least"), F.lit(False))).drop("least")


def failures(profile: DataFrame) -> dict[str, Column]:
    """The five filters by letter; each is the condition of failure, over profiles with ``copied``."""
    c = F.col
    return {
        "A": c("n_words") < 100,
        "B": 100 * c("n_distinct") < 80 * c("n_words"),
        "C": 100 * c("n_capitals") > 10 * c("n_points"),
        "D": c("n_symbols") > 0,
        "E": c("copied"),
    }


def interactions(rows: DataFrame, filters: dict[str, Column], part: str = "part", quality: str = "good", toxic: str = "toxic") -> DataFrame:
    """One row for each ``part``, ``filter_order`` (all orders of the filters) and ``step``,
    with the counts of that step.

    ``kept`` pass all filters so far; ``removed`` fall here; ``redundant`` fail here but
    fell before; ``unique_fails`` fail this filter only; ``good_lost`` and ``toxic_lost`` are
    removed rows with these marks; ``shapley`` is ``removed`` by this filter, over all
    orders. A row that fails k filters falls to each of them in a k-th of the orders.

    Rows are counted once by part and set of failed filters, so orders cost nothing by row.
    The number of orders is the factorial of that of the filters: for a handful.
    """
    letters, orders = list(filters), factorial(len(filters))
    bits = {letter: 1 << k for k, letter in enumerate(letters)}
    failed = sum((F.when(condition, bits[letter]).otherwise(0) for letter, condition in filters.items()), F.lit(0))
    marked = lambda c: F.sum(F.when(F.col(c), 1).otherwise(0))
    sets = (rows.select(F.col(part).alias("part"), failed.alias("failed"), F.col(quality).alias("good"), F.col(toxic).alias("toxic"))
            .groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n"), marked("good").alias("good"), marked("toxic").alias("toxic")))
    steps = [F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bits[letter]).alias("bit"),
                      F.lit(sum(bits[x] for x in order[:k])).alias("before"))
             for order in permutations(letters) for k, letter in enumerate(order)]
    each = sets.withColumn("at", F.explode(F.array(*steps))).select("part", "failed", "n", "good", "toxic", "at.*")
    fails = F.col("failed").bitwiseAND(F.col("bit")) > 0
    fell = F.col("failed").bitwiseAND(F.col("before")) > 0
    counted = lambda condition, of="n": F.coalesce(F.sum(F.when(condition, F.col(of))), F.lit(0)).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        counted(~fails & ~fell).alias("kept"), counted(fails & ~fell).alias("removed"), counted(fails & fell).alias("redundant"),
        counted(F.col("failed") == F.col("bit")).alias("unique_fails"), counted(fails & ~fell, "good").alias("good_lost"),
        counted(fails & ~fell, "toxic").alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.col("n") * F.expr(f"{orders} div bit_count(failed)"))), F.lit(0)).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          wanted: Sequence[str] | None = None) -> DataFrame:
    """:func:`interactions` of the five filters (or the letters ``wanted``) over ``docs``.

    Null text: empty. Null part: the empty string. A null id is no copy and has no label. Repeated
    rows count each; none is a copy of another with its own id. Repeated labels of an id are one: any
    mark holds. Empty table: no parts, so no rows. Other columns are ignored.
    """
    known = (labels.filter("quality = 1 or toxic = 1").groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    rows = with_earlier_copy(stage(profiles(docs, id_col, text_col, part_col))).join(known, "id", "left")
    every = failures(rows)
    return interactions(rows, {k: v for k, v in every.items() if wanted is None or k in wanted})
