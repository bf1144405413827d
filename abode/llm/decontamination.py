"""Benchmark decontamination by Wu-Manber search over words.

Windows of ten benchmark words are the test strings. The shift table says by
how many words the search may skip after seeing a block of two words; only
where a test string may end does the bucket of that suffix block list
candidates, which are narrowed by their first block and then compared word by word.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.llm.common import as_bytes, col, map_texts, unpack

WINDOW = 10
#: Benchmark words in one block of test strings; a block's tables are broadcast.
BLOCK_WORDS = 500_000
#: Blocks whose tables a Python worker keeps; of more, the oldest are built again.
KEPT_BLOCKS = 4
#: A-Z in lower case; every ASCII byte that is no letter or digit as a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


#: Id as text, which may be null, and text.
Item = tuple[str | None, bytes]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WuManber:
    """Search tables for test strings that all have ``length`` words."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.skip: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], dict[tuple[bytes, ...], set[str | None]]]] = {}

    def add(self, string: tuple[bytes, ...], item: str | None) -> None:
        for end in range(self.block, self.length + 1):
            block = string[end - self.block:end]
            self.skip[block] = min(self.skip.get(block, self.length), self.length - end)
        bucket = self.buckets.setdefault(string[-self.block:], {})
        bucket.setdefault(string[:self.block], {}).setdefault(string, set()).add(item)

    def find(self, words: list[bytes]):
        """Start and items of each occurrence."""
        length, block, skip, far = self.length, self.block, self.skip, self.length - self.block + 1
        end, n = length, len(words)
        while end <= n:
            suffix = tuple(words[end - block:end])
            step = skip.get(suffix, far)
            if step:
                end += step
                continue
            start = end - length
            candidates = self.buckets[suffix].get(tuple(words[start:start + block]))
            if candidates:
                items = candidates.get(tuple(words[start:end]))
                if items:
                    yield start, items
            end += 1


def search_tables(items: list[Item], window: int = WINDOW) -> list[WuManber]:
    """One searcher for each length of test string; only short items are below ``window``."""
    tables: dict[int, WuManber] = {}
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        for start in range(len(words) - length + 1 if length else 0):
            tables.setdefault(length, WuManber(length)).add(tuple(words[start:start + length]), item)
    return list(tables.values())


_kept: dict[tuple[str, int], list[WuManber]] = {}


def kept_tables(name: tuple[str, int], items: list[Item], window: int) -> list[WuManber]:
    """The tables of a block, built once by a worker, which outlives its tasks and keeps ``KEPT_BLOCKS`` of them."""
    if name not in _kept:
        while len(_kept) >= KEPT_BLOCKS:
            _kept.pop(next(iter(_kept)))
        _kept[name] = search_tables(items, window)
    return _kept[name]


def search(words: list[bytes], tables: list[WuManber]) -> tuple[np.ndarray, set[str | None]]:
    """Mask of words inside an occurrence, and the items that occur."""
    edge, found = np.zeros(len(words) + 1, np.int64), set()
    for table in tables:
        for start, items in table.find(words):
            edge[start] += 1
            edge[start + table.length] -= 1
            found |= items
    return np.cumsum(edge[:-1]) > 0, found


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[Item]]:
    """The benchmark in blocks of at most ``block_words`` words, or one item.

    The benchmark is the stated query set of this operator. It passes through the
    driver item by item, and one block at a time is held there to be broadcast.
    """
    block: list[Item] = []
    room = block_words
    rows = benchmark.select(col(id_col).cast("string").alias("item"), col(text_col).cast("binary").alias("text")).filter("text is not null")
    for row in rows.toLocalIterator():
        size = len(words_of(bytes(row["text"])))
        if block and size > room:
            yield block
            block, room = [], block_words
        block.append((row["item"], bytes(row["text"])))
        room -= size
    if block:
        yield block


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Struct column ``row`` (the document) with ``n_words``, ``n_hit``, ``spans`` (first and
    last hit word of each run), ``items`` (ids that occur, sorted as strings) and ``contaminated``.

    A null text has no words, and an item without words no windows. An item without id
    is searched for like any other: its words are hit, only ``items`` can't name it. An
    item shorter than ``window`` is one window. Items may share windows and may
    repeat. Every document is searched for every block of the benchmark.
    """
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(block) for block in item_blocks(benchmark, item_col, item_text_col, block_words)]
    run = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("spans", T.ArrayType(run)),
              T.StructField("items", T.ArrayType(T.StringType())), T.StructField("contaminated", T.BooleanType())]
    name = uuid.uuid4().hex

    def hits(texts: pa.Array) -> list[pa.Array]:
        raw = as_bytes(texts)
        masks: list[np.ndarray | None] = [None] * len(raw)
        lengths, items = [0] * len(raw), defaultdict(set)
        for k in range(max(1, len(blocks))):
            tests = kept_tables((name, k), blocks[k].value, window) if blocks else []
            for i, text in enumerate(raw):
                words = words_of(text)
                lengths[i] = len(words)
                mask, found = search(words, tests)
                if found:
                    masks[i] = mask if masks[i] is None else masks[i] | mask
                    items[i] |= found
        spans = []
        for mask in masks:
            step = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))) if mask is not None else np.zeros(0, int)
            spans.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(step[::2], step[1::2])])
        n_hit = [0 if m is None else int(m.sum()) for m in masks]
        return [pa.array(lengths, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                pa.array([sorted(x for x in items.get(i, ()) if x is not None) for i in range(len(raw))], pa.list_(pa.string())), pa.array([n > 0 for n in n_hit])]

    return map_texts(docs, hits, fields, text_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    return find_benchmark(docs, benchmark, **options).filter("not contaminated").select("row.*")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with the columns of :func:`find_benchmark`; a result replaces an input column of its name."""
    return unpack(find_benchmark(docs, benchmark, **options))


