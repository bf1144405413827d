"""N-gram Jaccard join with rare-first prefix, length, positional and suffix filters.

Texts with the same words form a class, and classes are joined. The shingles
of a class are ordered from rare to frequent. Two sets that are similar enough
share a shingle in their prefixes, so classes meet in the buckets of their
prefix shingles, which move packed by range of the shingle. In small buckets pairs
are formed, filtered and verified once
per pair. In large buckets the same filters run over blocks of set sizes and
cell counts, without texts; classes that pass them with each other, directly or
by way of others, form families. A family is cut into blocks, and a pair of
blocks is joined inside one task, which leaves out pairs that are connected
already. So a group of near copies costs links, not pairs, and classes that only
share a common passage don't meet at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.llm.common import by_range, col, packed, partitions, released, rows_by_bucket, split_by_range, stage
from abode.llm.components import components
from abode.llm.shingles import MIX, sequence_digest, shingle_sets

#: Most frequent shingles that a task knows, as a broadcast of 12 bytes each.
FREQUENT = 1_048_576
#: Up to so many classes in a bucket, its pairs are formed one by one.
SMALL_BUCKET = 16
#: Classes in a block of a large bucket or a family, and shingles in a block of a family.
BLOCK_CLASSES, BLOCK_SHINGLES = 2048, 2_000_000
#: Classes whose texts are fetched by a broadcast of 24 bytes each; beyond, by a shuffle.
BROADCAST_CLASSES = 500_000
CELLS = 32
#: Sets of more shingles also have fine cells, of 4 to 8 shingles each.
FINE_FROM = 512
RANGES_PER_PARTITION = 2


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``size`` words; similar if ``percent`` of the union is common. All bounds in whole numbers."""

    size: int
    percent: int

    def similar(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)

    def prefix(self, n: int) -> int:
        return n - -(-n * self.percent // 100) + 1

    def least_common(self, a, b):
        return -(-(a + b) * self.percent // (100 + self.percent))


#: Listed shingles, sorted, and their counts.
Listed = tuple[np.ndarray, np.ndarray]


def rare_first(found: np.ndarray, listed: Listed) -> np.ndarray:
    """``found`` (sorted, distinct) from rare to frequent: unlisted ones by hash, then
    listed ones by count and hash."""
    shingles, counts = listed
    if not len(shingles):
        return found
    at = np.minimum(np.searchsorted(shingles, found), len(shingles) - 1)
    known = shingles[at] == found
    if not known.any():
        return found
    tail = found[known]
    return np.concatenate((found[~known], tail[np.argsort(counts[at[known]], kind="stable")]))


def fine_cells(found: np.ndarray) -> bytes | None:
    """Counts of a large set by fine ranges of the hash, a power of two of them, a byte each."""
    if len(found) <= FINE_FROM:
        return None
    level = (len(found) // 4).bit_length() - 1
    counts = np.bincount((found >> np.uint64(64 - level)).astype(np.int64), minlength=1 << level)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _coarser(cells: np.ndarray, width: int) -> np.ndarray:
    return cells.reshape(width, -1).sum(axis=1, dtype=np.int64)


def least_apart(a: bytes | None, b: bytes | None) -> int:
    """So many shingles at least are in one of two sets only, by their fine cells; 0 where a set has none."""
    if a is None or b is None:
        return 0
    width = min(len(a), len(b))
    x, y = (_coarser(np.frombuffer(c, np.uint8), width) for c in (a, b))
    return int(np.abs(x - y).sum())


def described(docs: DataFrame, rule: Similarity, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts; staged.

    Every row gets ``id``, ``row_hash`` (of id and text), ``digest`` of the text, ``cls`` (name of the word
    sequence), ``n`` (set size), ``cells`` (set size by range of the hash) and ``fine`` (fine cells). Every
    batch adds a row with ``n`` -1 and a tally: the shingles that two of its
    classes or more have, and how many have them.
    """
    slim = docs.select(*row_key(id_col, text_col), col(text_col).alias("text"))
    fields = [T.StructField("cls", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("cells", T.ArrayType(T.IntegerType())),
              T.StructField("fine", T.BinaryType()), T.StructField("tally", T.BinaryType()), T.StructField("times", T.BinaryType())]
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in slim.schema.fields[:3]), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, cells, fine, once = [], [], [], [], {}
            for words, found in shingle_sets(batch.column(3), rule.size):
                names.append(sequence_digest(words) if len(words) else None)
                sizes.append(len(found))
                cells.append(np.bincount((found >> np.uint64(59)).astype(np.int64), minlength=CELLS).astype(np.int32))
                fine.append(fine_cells(found))
                once[names[-1]] = found
            shingles = np.sort(np.concatenate([*once.values(), np.zeros(0, np.uint64)]))
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(shingles)), bool), shingles[1:] != shingles[:-1])))
            times = np.diff(np.append(first, len(shingles)))
            tally = shingles[first][times > 1].tobytes(), times[times > 1].astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(pa.concat_arrays([c, pa.nulls(1, c.type)]) for c in batch.columns[:3]), pa.array([*names, None], pa.binary()),
                 pa.array([*sizes, -1], pa.int32()), pa.array([*cells, None], pa.list_(pa.int32())), pa.array([*fine, None], pa.binary()),
                 pa.array([None] * len(names) + [tally[0]], pa.binary()), pa.array([None] * len(names) + [tally[1]], pa.binary())], names=schema.names)

    return stage(slim.mapInArrow(released(run), schema))


def row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(col(id_col), col(text_col))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """What says which row it is: ``row_hash`` deals rows out; ``id`` and ``digest`` (128
    bits of the SHA-256 of the text; null: none) decide, so no two rows meet by a chance of the hash."""
    digest = F.substring(F.unhex(F.sha2(col(text_col), 256)), 1, 16)
    return [col(id_col).alias("id"), row_hash(id_col, text_col).alias("row_hash"), digest.alias("digest")]


def _same_row(other: str) -> Column:
    """Whether a row is the one in the struct column ``other``."""
    parts = [F.col("id").eqNullSafe(F.col(f"{other}.id")), F.col("digest").eqNullSafe(F.col(f"{other}.digest"))]
    return (F.col("row_hash") == F.col(f"{other}.row_hash")) & parts[0] & parts[1]


def frequent_shingles(tallies: DataFrame, limit: int) -> Listed:
    """The most frequent shingles, by counts summed over all documents.

    A shingle counts in the batches in which two classes or more have it, which
    finds all that are common. At most ``limit`` reach the driver. Which shingles
    are listed only shifts work; any order gives the same links.
    """
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tally, times in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(tally, np.int64)), pa.array(np.frombuffer(times, np.int32))], names=["shingle", "n"])

    counts = stage(tallies.mapInArrow(released(spread), "shingle long, n int").groupBy("shingle").agg(F.sum("n").alias("n")).filter("n > 3"))
    step = F.floor(F.log2("n") * 8).cast("int")
    room, least = limit, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    listed = counts.filter(step >= least).toArrow()
    shingles = listed["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], listed["n"].to_numpy()[order].astype(np.int32)


def _prefix_rows(rule: Similarity, order: Broadcast, ranges: int):
    """Prefix shingles of a batch, packed by range: shingles, names of their classes, and set sizes and places; once per class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once = {sequence_digest(words): found for words, found in shingle_sets(batch.column(0), rule.size) if len(words)}
            tokens, sizes = [], []
            for found in once.values():
                sizes.append(len(found))
                tokens.append(rare_first(found, order.value)[:rule.prefix(len(found))])
            out = []
            if once:
                lengths = np.array([len(t) for t in tokens])
                of, flat = np.repeat(np.arange(len(tokens)), lengths), np.concatenate(tokens)
                pos = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                names, n = np.frombuffer(b"".join(once), "V16")[of], np.array(sizes)[of]
                for bucket, part in split_by_range(flat * MIX, ranges):  # prefixes lie low among the hashes
                    numbers = packed(n[part], np.int32) + packed(pos[part], np.int32)
                    out.append((bucket, packed(flat[part], np.uint64), names[part].tobytes(), pa.compress(numbers, "zstd", asbytes=True)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                             names=["bucket", "tokens", "names", "numbers"])

    return run


def _as_binary(names: np.ndarray) -> pa.Array:
    """Names of 16 bytes each, held as two numbers that sort like them."""
    offsets = np.arange(0, 16 * len(names) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed(names, ">u8"))])


#: Pairs that go out at once.
PAIRS = 200_000
_MET = (("token", pa.int64()), ("cls", pa.binary()), ("n", pa.int32()), ("pos", pa.int32()), ("m", pa.int32()), ("a", pa.binary()), ("b", pa.binary()))


def _met(**columns: pa.Array) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(rows, kind)) for name, kind in _MET], names=[name for name, _ in _MET])


def _meetings(rule: Similarity):
    """Who meets in the buckets of a range: pairs ``a`` < ``b`` from small buckets that pass the
    length and positional filters, and members of large buckets (``token``, ``cls``, ``n``, ``pos``, bucket size ``m``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in rows_by_bucket(batches):
            token, name = (np.concatenate([np.frombuffer(r[k], kind) for r in rows]) for k, kind in ((1, np.uint64), (2, ">u8")))
            n, pos = np.concatenate([np.frombuffer(pa.decompress(r[3], len(r[1]), "zstd", asbytes=True), np.int32).reshape(2, -1) for r in rows], axis=1)
            name = name.reshape(-1, 2)
            order = np.lexsort((name[:, 1], name[:, 0], token))
            token, name = token[order], name[order]
            new = np.ones(len(token), bool)  # a class once a bucket
            new[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1]).any(axis=1)
            token, name, n, pos = token[new], name[new], n[order][new].astype(np.int64), pos[order][new].astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            m = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token))))
            large = np.flatnonzero(m > SMALL_BUCKET)
            for part in np.split(large, range(PAIRS, len(large), PAIRS)):
                if len(part):
                    yield _met(token=pa.array(token[part].view(np.int64)), cls=_as_binary(name[part]), n=pa.array(n[part].astype(np.int32)),
                               pos=pa.array(pos[part].astype(np.int32)), m=pa.array(m[part].astype(np.int32)))
            small = np.flatnonzero((m > 1) & (m <= SMALL_BUCKET))
            for step in range(1, SMALL_BUCKET):
                i = small[:-step] if step < len(small) else small[:0]
                j = small[step:] if step < len(small) else small[:0]
                met = (token[i] == token[j]) & (100 * np.minimum(n[i], n[j]) >= rule.percent * np.maximum(n[i], n[j]))
                met &= np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j]) >= rule.least_common(n[i], n[j])
                met = np.flatnonzero(met)
                for part in np.split(met, range(PAIRS, len(met), PAIRS)):
                    if len(part):
                        yield _met(a=_as_binary(name[i[part]]), b=_as_binary(name[j[part]]))

    return run


def meetings(docs: DataFrame, rule: Similarity, order: Broadcast, text_col: str) -> DataFrame:
    """Pairs and members of large buckets (see ``_meetings``); staged."""
    ranges = RANGES_PER_PARTITION * partitions(docs)
    rows = docs.select(col(text_col).alias("text")).mapInArrow(released(_prefix_rows(rule, order, ranges)), "bucket int, tokens binary, names binary, numbers binary")
    return stage(by_range(rows, ranges).mapInArrow(released(_meetings(rule)), "token long, cls binary, n int, pos int, m int, a binary, b binary"))


def _candidates(pairs: DataFrame, classes: DataFrame, rule: Similarity) -> DataFrame:
    """Pairs of classes that pass the suffix filter."""
    need = F.expr(f"((n_a + n_b) * {rule.percent} + {99 + rule.percent}) div {100 + rule.percent}")
    cells = classes.select("cls", "n", "cells")
    for s in "ab":
        pairs = pairs.join(cells.select(*[F.col(c).alias(f"{c}_{s}") for c in cells.columns]), f"cls_{s}")
    # Shingles that only one side has number at least the differences of the cells.
    apart = F.aggregate(F.zip_with("cells_a", "cells_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return pairs.filter(apart <= F.expr("n_a + n_b") - 2 * need).select("cls_a", "cls_b")


def _finely(pairs: DataFrame, classes: DataFrame, rule: Similarity) -> DataFrame:
    """Pairs that also pass the suffix filter by fine cells, which long texts need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            room = n - 2 * rule.least_common(n, 0)
            keep = [least_apart(a, b) <= most for a, b, most in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), room.tolist())]
            yield batch.select(["cls_a", "cls_b"]).filter(pa.array(keep, pa.bool_()))

    sets = classes.select("cls", F.col("n").cast("long").alias("n"), "fine")
    for s in "ab":
        pairs = pairs.join(sets.select(*[F.col(c).alias(f"{c}_{s}") for c in sets.columns]), f"cls_{s}")
    return pairs.select("cls_a", "cls_b", "n_a", "n_b", "fine_a", "fine_b").mapInArrow(released(run), "cls_a binary, cls_b binary")


def _verify_pairs(pairs: DataFrame, rule: Similarity) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for (_, x), (_, y) in zip(*(shingle_sets(c, rule.size) for c in batch.columns[2:])):
                keep.append(rule.similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("cls_a", "cls_b", "text_a", "text_b").mapInArrow(released(verify), "a binary, b binary")


def _dealt(rows: DataFrame, blocks: Column) -> DataFrame:
    """Rows with ``block`` (of ``blocks``, by class), once for each block pair ``i``, ``j`` that theirs is in."""
    return (rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "other"))


class Groups:
    """What is connected inside a task: labels of the members, of which the smaller group takes the other's."""

    def __init__(self, size: int):
        self.label = np.arange(size)
        self.members: dict[int, list[int]] = {}

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        return self.label[others] != self.label[i]

    def join(self, i: int, j: int) -> bool:
        """Whether two groups became one; a member changes its label a logarithm of times at most."""
        a, b = int(self.label[i]), int(self.label[j])
        if a == b:
            return False
        one, two = self.members.pop(a, [a]), self.members.pop(b, [b])
        if len(one) < len(two):
            a, one, two = b, two, one
        self.label[two] = a
        one.extend(two)
        self.members[a] = one
        return True


class Fine:
    """Fine cells of the members of a task, by width; sets that may be similar differ by a factor of two in width at most."""

    def __init__(self, cells: list[bytes | None]):
        self.width = np.array([len(c) if c is not None else 0 for c in cells])
        self.cells = [np.frombuffer(c or b"", np.uint8) for c in cells]
        self.at, self.rows = {}, {}
        for width in np.unique(self.width[self.width > 0]).tolist():
            held = np.flatnonzero((self.width == width) | (self.width == 2 * width))
            place = np.full(len(cells), -1)
            place[held] = np.arange(len(held))
            self.at[width], self.rows[width] = place, np.stack([_coarser(self.cells[k], width) for k in held.tolist()]).astype(np.int16)

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """``least_apart`` of a set and each of others; 0 where widths differ by more."""
        out = np.zeros(len(others), np.int64)
        for width in {int(self.width[i]), int(self.width[i]) // 2} & self.at.keys():
            place = self.at[width][others]
            met = np.flatnonzero((place >= 0) & (np.minimum(self.width[others], self.width[i]) == width))
            if len(met):
                out[met] = np.abs(self.rows[width][place[met]] - _coarser(self.cells[i], width).astype(np.int16)).sum(axis=1, dtype=np.int64)
        return out


def _plausible(rule: Similarity):
    """Pairs between two blocks of a bucket that pass the length, positional and suffix
    filters, as a spanning forest."""
    def pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        left, right = key[1:]
        names, block = rows["cls"].tolist(), rows["block"].to_numpy()
        n, pos = rows["n"].to_numpy().astype(np.int64), rows["pos"].to_numpy()
        cells = np.stack(rows["cells"].to_list()).astype(np.int32)
        fine, groups, out = Fine(rows["fine"].to_list()), Groups(len(names)), []
        for i in np.flatnonzero(block == left).tolist():
            need = rule.least_common(n, n[i])
            other = (block == right) & (100 * np.minimum(n, n[i]) >= rule.percent * np.maximum(n, n[i]))
            other &= np.minimum(pos, pos[i]) + 1 + np.minimum(n - pos, n[i] - pos[i]) - 1 >= need
            if left == right:
                other[:i + 1] = False
            at = np.flatnonzero(other)
            at = at[groups.apart(i, at)]
            at = at[np.abs(cells[at] - cells[i]).sum(axis=1) <= n[at] + n[i] - 2 * need[at]]
            at = at[fine.apart(i, at) <= n[at] + n[i] - 2 * need[at]]
            out += [(names[i], names[j]) for j in at.tolist() if groups.join(i, j)]
        return pd.DataFrame(out, columns=["a", "b"])

    return pairs


def _join_blocks(rule: Similarity, order: Broadcast):
    """Links between two blocks of a family, or inside one, as a spanning forest."""
    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        left, right = key[1:]
        rows = rows.drop_duplicates("cls").sort_values("cls")
        names, block = rows["cls"].tolist(), rows["block"].to_numpy()
        sets = [rare_first(s, order.value) for _, s in shingle_sets(pa.array(rows["text"].tolist(), pa.large_string()), rule.size)]
        n = np.array([len(s) for s in sets])
        flat, ids = np.unique(np.concatenate(sets), return_inverse=True)
        ids = np.split(ids, np.cumsum(n)[:-1])
        own = np.concatenate([i[:rule.prefix(len(i))] for i in ids])
        who = np.repeat(np.arange(len(ids)), [rule.prefix(k) for k in n])
        pos = np.concatenate([np.arange(rule.prefix(k)) for k in n])
        by_token = np.argsort(own, kind="stable")
        until = np.searchsorted(own[by_token], np.arange(len(flat) + 1))
        groups, mark, out = Groups(len(names)), np.zeros(len(flat), bool), []
        for i in np.flatnonzero(block == left).tolist():
            need = rule.least_common(n, n[i])
            other = (block == right) & (100 * np.minimum(n, n[i]) >= rule.percent * np.maximum(n, n[i]))
            if left == right:
                other[:i + 1] = False
            met, rest = np.zeros(len(names), bool), []
            for k, token in enumerate(ids[i][:rule.prefix(n[i])].tolist()):
                at = by_token[until[token]:until[token + 1]]
                at = at[other[who[at]] & ~met[who[at]]]  # first met here, so nothing before is common
                j = who[at]
                met[j] = True
                j = j[1 + np.minimum(n[i] - k, n[j] - pos[at]) - 1 >= need[j]]
                rest.append(j[groups.apart(i, j)])
            rest = np.concatenate(rest)
            if not len(rest):
                continue
            mark[ids[i]] = True
            starts = np.concatenate(([0], np.cumsum(n[rest])[:-1]))
            common = np.add.reduceat(mark[np.concatenate([ids[j] for j in rest])].astype(np.int64), starts)
            mark[ids[i]] = False
            out += [(names[i], names[j]) for j in rest[rule.similar(common, n[i], n[rest])].tolist() if groups.join(i, j)]
        return pd.DataFrame(out, columns=["a", "b"])

    return links


def similar_components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id, ``row_hash`` (of id and text), ``digest`` (of the text), ``n_shingles``,
    ``component_id``, the least id reachable by links of similarity ``percent`` or more, and
    ``component``, a key of the component that is null only without words.

    Words are split at ASCII white space with A-Z in lower case. A text of
    fewer than ``size`` words is one shingle; null and empty texts have none,
    and form components by themselves. Repeated rows and copies share a
    component. A null id never is the least of a component that has another.
    Empty table: no rows. Other columns are ignored.

    Memory: a task holds a batch of texts, or two blocks of a bucket. The driver
    holds the list of frequent shingles, of ``FREQUENT`` at most.
    """
    rule = Similarity(size, percent)
    seen = described(docs, rule, id_col, text_col)
    classes = seen.filter("n >= 0").drop("tally", "times")
    order = docs.sparkSession.sparkContext.broadcast(frequent_shingles(seen.filter("n < 0").select("tally", "times"), FREQUENT))
    named = classes.filter("cls is not null").groupBy("cls").agg(F.min(F.struct("id", "row_hash", "digest")).alias("first"), F.min("id").alias("least"),
                                                               F.first("n").alias("n"), F.first("cells").alias("cells"),
                                                               F.first("fine").alias("fine"))
    links = components(stage(_links(docs, named, rule, order, text_col, id_col)))
    rooted = named.select("cls", "least").join(links, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(least, "root").select("cls", "component_id", F.col("root").alias("component"))
    return (classes.join(found, "cls", "left")
            .select(F.col("id").alias(id_col), "row_hash", "digest", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "component"))


def _links(docs: DataFrame, named: DataFrame, rule: Similarity, order: Broadcast, text_col: str, id_col: str) -> DataFrame:
    """Links between classes that connect all that are similar."""
    met = meetings(docs, rule, order, text_col)
    large = met.filter("token is not null").select("token", "cls", "n", "pos", "m").join(named.select("cls", "cells", "fine"), "cls")
    near = (_dealt(large, F.ceil(F.col("m") / BLOCK_CLASSES).cast("int")).groupBy("token", "i", "j")
            .applyInPandas(_plausible(rule), "a binary, b binary").distinct())
    family = components(near)
    family = stage(family.union(family.select("root", "root")).distinct().toDF("cls", "family"))
    pairs = _candidates(met.filter("token is null").select(F.col("a").alias("cls_a"), F.col("b").alias("cls_b")).distinct(), named, rule)
    for s in "ab":
        pairs = pairs.join(family.toDF(f"cls_{s}", f"family_{s}"), f"cls_{s}", "left")
    pairs = pairs.filter("not (family_a <=> family_b) or family_a is null").select("cls_a", "cls_b")
    pairs = stage(_finely(pairs, named, rule))

    wanted = pairs.select(F.col("cls_a").alias("cls")).union(pairs.select("cls_b")).union(family.select("cls")).distinct()
    firsts = stage(wanted.join(named, "cls").select("cls", "first"))
    if firsts.count() <= BROADCAST_CLASSES:
        firsts = F.broadcast(firsts)
    texts = (docs.select(*row_key(id_col, text_col), col(text_col).alias("text"))
             .join(firsts, _same_row("first")).groupBy("cls").agg(F.first("text").alias("text")))  # equal texts

    both = pairs
    for s in "ab":
        both = both.join(texts.select(F.col("cls").alias(f"cls_{s}"), F.col("text").alias(f"text_{s}")), f"cls_{s}")
    sized = family.join(named.select("cls", "n"), "cls")
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    cut = sized.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).select("family", blocks.alias("blocks"))
    dealt = _dealt(family.join(cut, "family").join(texts, "cls"), F.col("blocks")).select("family", "i", "j", "cls", "block", "text")
    inside = dealt.groupBy("family", "i", "j").applyInPandas(_join_blocks(rule, order), "a binary, b binary")
    return _verify_pairs(both, rule).union(inside)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the least id, then row hash.
    A null id comes after all others.

    Rows without words are all kept. Of rows that agree in id and text, one stays: the
    first by its columns as JSON, so a task that runs again keeps the same one. Rows
    are told apart by id and digest beside the hash.
    """
    found = stage(similar_components(docs, size, percent, id_col, text_col).withColumnRenamed(id_col, "id"))
    in_words = found.filter("n_shingles > 0")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_hash", "digest")).alias("best")
    key = F.struct("row_hash", "id", "digest")
    grouped = in_words.join(in_words.groupBy("component").agg(first, F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "component")
    gone = stage(grouped.filter(~_same_row("best")).select(key.alias("gone")).distinct())
    twins = stage(grouped.filter(_same_row("best")).groupBy(key.alias("twin")).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("twin"))
    few = lambda df: F.broadcast(df) if df.count() <= BROADCAST_CLASSES else df
    names = docs.columns
    rows = docs.select(F.struct(*[col(c) for c in names]).alias("row"), *row_key(id_col, text_col))
    kept = rows.join(few(gone), _same_row("gone"), "left_anti")
    if twins.isEmpty():
        return kept.select("row.*")
    twins = few(twins)
    single = kept.join(twins, _same_row("twin"), "left_anti")
    merged = kept.join(twins, _same_row("twin"), "left_semi").groupBy(key.alias("key")).agg(F.min_by("row", F.to_json("row")).alias("row"))
    return single.select("row.*").union(merged.select("row.*"))
