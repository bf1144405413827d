"""SimHash near-duplicates by pivot distance tables.

Pivots are seeded reference fingerprints. The Hamming distance to a pivot moves by no
more than two fingerprints differ, over all bits as over any lane of them. Two
fingerprints that differ in three bits or fewer agree on one of four lanes at least, so
there their distances to all pivots are equal: fingerprints meet in the buckets of their
lane distances. In a bucket, pairs whose distances to any pivot differ by more
than three are discarded, and the others are verified bit by bit.

A bucket that is too large is dealt again by four lanes of the bits that its
members need not agree on, up to ``LEVELS`` times. After these at most twelve bits are
free, so no bucket holds more than 4096 fingerprints, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.llm.common import as_bytes, col, released, stage
from abode.llm.components import components

BITS, SEED = 64, 42
#: More pivots than a lane has bits, so that their distances tell all values of a lane apart.
PIVOTS = np.random.default_rng(SEED).integers(0, 2**64, 24, dtype=np.uint64)
_WEIGHTS = np.random.default_rng(SEED + 1).integers(0, 2**63, 25, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Fingerprints in a bucket above which it is dealt again, and how often.
LARGE_BUCKET, LEVELS = 1024, 6
#: Shingles hashed at once.
CHUNK = 65_536
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, size: int = 3) -> int:
    """A bit is 1 if it is set in over half of the XXH64 of the word shingles, repeats included.

    A text of fewer than ``size`` words is one shingle; without words the fingerprint is zero.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(size, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, counts, digest = len(words) - size + 1, np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for first in range(0, n, CHUNK):
        last = min(first + CHUNK, n)
        spans = zip(starts[first:last].tolist(), ends[first + size - 1:last + size - 1].tolist())
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, last - first)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp`` (64 bits as a long) of every row; a null text has no words."""
    slim = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, size) for t in as_bytes(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return slim.mapInArrow(released(run), slim.select("id", F.lit(0).cast("long").alias("fp")).schema)


def lanes(free: int, parts: int) -> list[int]:
    """The bits of ``free`` cut into ``parts`` masks of nearly equal size."""
    places = [b for b in range(BITS) if free >> b & 1]
    return [sum(1 << int(b) for b in cut) for cut in np.array_split(places, parts)]


def distances(prints: np.ndarray, lane: int = 2**64 - 1) -> np.ndarray:
    """The pivot distance table: a row for each fingerprint, a column for each pivot, over the bits of ``lane``."""
    return np.bitwise_count((prints[:, None] ^ PIVOTS) & np.uint64(lane))


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Every row (``key``, ``fp``, ``free``) once for each lane of its free bits, with the
    key that names the lane and its pivot distances, and the free bits left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, prints, free = (c.to_numpy().view(np.uint64) for c in batch.columns)
            for mask in np.unique(free):
                own = free == mask
                for lane in lanes(int(mask), parts):
                    named = (distances(prints[own], lane).astype(np.uint64) * _WEIGHTS[:-1]).sum(axis=1, dtype=np.uint64)
                    named ^= (key[own] + np.uint64(xxhash.xxh64_intdigest(lane.to_bytes(8, "little")))) * _WEIGHTS[-1]
                    named = (named ^ (named >> np.uint64(29))) * _WEIGHTS[-1]
                    left = np.full(len(named), mask & ~np.uint64(lane))
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)) for a in (named, prints[own], left)], names=["key", "fp", "free"])

    return rows.mapInArrow(released(run), "key long, fp long, free long")


def bucket_links(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect all fingerprints of a bucket that are within ``most`` bits, as a spanning forest."""
    table = distances(prints).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[order], table[order]
    parent, out = list(range(len(prints))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for step in range(1, len(prints)):
        a = np.flatnonzero(table[step:, 0] - table[:-step, 0] <= most)  # sorted, so later steps differ by more
        if not len(a):
            break
        a = a[np.abs(table[a + step] - table[a]).max(axis=1) <= most]
        a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= most]
        for i in a.tolist():
            x, y = root(i), root(i + step)
            if x != y:
                parent[x] = y
                out.append((int(prints[i]), int(prints[i + step])))
    return out


def _linked(buckets: DataFrame, most: int) -> DataFrame:
    """Links of all buckets; a bucket's fingerprints are gathered, which are ``LARGE_BUCKET`` or 4096 at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            flat = column.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(column.value_lengths().to_numpy())
            links = [x for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()) for x in bucket_links(flat[a:b], most)]
            pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    gathered = buckets.groupBy("key").agg(F.collect_list("fp").alias("prints")).filter(F.size("prints") > 1)
    return gathered.select("prints").mapInArrow(released(run), "a long, b long")


def links(prints: DataFrame, most: int = 3) -> DataFrame:
    """``a`` and ``b``: links that connect all distinct fingerprints (``fp``) that differ in ``most`` bits or fewer.

    Exact at any size. The driver holds counts only; large buckets are found by
    partial aggregation and dealt again.
    """
    rows = prints.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(-1).cast("long").alias("free"))
    found: DataFrame | None = None
    for level in range(1, LEVELS + 1):
        rows = stage(_dealt(rows, most + 1))
        large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LARGE_BUCKET).select("key")
        large = stage(large)
        last = level == LEVELS or large.isEmpty()
        some = stage(_linked(rows if last else rows.join(large, "key", "left_anti"), most).distinct())
        found = some if found is None else found.union(some)
        if last:
            break
        rows = rows.join(large, "key", "left_semi").select("key", "fp", "free")
    return found


def near_duplicates(docs: DataFrame, size: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id, ``fp`` and ``component_id``, the least id
    reachable by links of ``most`` differing bits or fewer, itself included.

    Words are split at ASCII white space with A-Z in lower case. Null, empty and blank
    texts have fingerprint zero, linked like any other. Repeated rows and
    copies share a component. A null id is never the least of a component that has
    another; a component of null ids has none. Empty table: no rows. Other columns are
    ignored. Equal fingerprints collapse before they are compared, so exact copies cost a count.
    """
    every = stage(fingerprints(docs, size, id_col, text_col))
    distinct = stage(every.groupBy("fp").agg(F.min("id").alias("least")))
    rooted = components(links(distinct.select("fp"), most))
    found = distinct.join(rooted.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.join(least, "root").select("fp", "component_id")
    return every.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def digits(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
