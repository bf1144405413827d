"""Suffix dedup: bytes covered by a long string that also starts earlier.

Strings of ``LENGTH`` bytes are compared through anchors. An anchor is the start
of the 32-byte gram with the least hash among those of a string, so equal
strings have an anchor at the same place inside. The suffix at an anchor, with
the bytes before it, shows all strings that have the anchor.

1. Hashes of all grams are dealt by range, and a filter of those that occur twice
   is made. Anchors whose gram occurs once are dropped; no string there repeats.
2. Tasks sort the suffixes of the others into runs, fold equal ones, and
   exchange the runs front-coded and packed, dealt by range of the gram's hash.
3. A loser tree merges the runs of a range. It knows the common prefix of each
   head with the last output and never compares inside it. Suffixes with one gram
   come out together; those that match an earlier one on both sides of the
   anchor over ``LENGTH`` bytes or more are covered.
4. Covered stretches are united by document and joined back to their documents.

Steps 2 and 3 run for a slice of the ranges at a time, so that runs on disk stay
in proportion to the texts however much of them repeats; a slice's shuffle files
go before the next one starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.llm.common import as_bytes, by_range, col, packed, partitions, released, rows_by_bucket, split_by_range, stage

LENGTH = 100
GRAM = 32
#: Grams in a string, less one: the farthest an anchor can lie from the start.
BACK = LENGTH - GRAM
#: A suffix with its bytes before, and the lengths of both.
WIDTH = LENGTH + BACK + 2
#: Bytes whose anchors are looked for at once, and suffixes in a run.
CHUNK, RUN = 1 << 18, 50_000
#: Bytes of texts laid out at once; one longer text goes alone.
GROUP = 4 << 20
RANGES_PER_PARTITION = 2
#: Anchors in a slice, as a share of all, and bytes of its filter, which is broadcast.
SLICE, FILTERS = 0.5, 32 << 20
#: Bits of the filter for each gram; low bits of a hash that are not looked at when grams are counted (40 are).
BITS, CUT = 10, np.uint64(24)
_FACTORS = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Random values of bytes, powers of an odd number and of its inverse, for hashes of strings at any offset.
_BYTES = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS = np.array([pow(int(_MIX), k, 2**64) for k in range(LENGTH + BACK)], np.uint64)
_INVERSE = np.array([pow(int(_MIX), -k, 2**64) for k in range(BACK + 1)], np.uint64)
#: Offsets whose hashes are held at once, keys of a run that are decoded at once, and stretches that are held before they are sent on.
OFFSETS, DECODED, FLUSH = 8, 1024, 10_000
#: Places of a suffix that go out one by one; more go as arrays.
SOME = 16


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from every place, by doubling."""
    h = (text.astype(np.uint64) + np.uint64(1)) * _MIX
    step = 1
    while step < GRAM:
        h = (h[:-step] ^ (h[:-step] >> np.uint64(31))) * _MIX + h[step:]
        step *= 2
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        values = best(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return best(values[:-rest], values[rest:]) if rest else values


def anchors(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors in texts that lie one after another and end at ``ends``.

    Works through ``CHUNK`` starts of strings at a time; only strings inside one text count.
    """
    places, hashes = [], []
    for first in range(0, max(0, len(text) - LENGTH + 1), CHUNK):
        h = _gram_hashes(text[first:first + CHUNK + LENGTH - 1])
        least = _sliding(h, BACK + 1, np.minimum)
        last = first + len(least)
        inner = ends[np.searchsorted(ends, first, side="right"):np.searchsorted(ends, last + LENGTH, side="left")]
        for end in inner.tolist():  # strings that would run over the end of a text
            least[max(0, end - LENGTH + 1 - first):max(0, end - first)] = 0
        # A gram is an anchor if it is the least of any string that it lies in.
        pad = np.zeros(BACK, np.uint64)
        chosen = (_sliding(np.concatenate((pad, least, pad)), BACK + 1, np.maximum) == h) & (h > 0)
        at = np.flatnonzero(chosen)
        places.append(at + first)
        hashes.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, index = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[index]


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends


def _groups(texts: list[bytes]) -> Iterator[slice]:
    """Neighbouring texts of ``GROUP`` bytes together, or one."""
    first, room = 0, GROUP
    for k, text in enumerate(texts):
        if len(text) > room and k > first:
            yield slice(first, k)
            first, room = k, GROUP
        room -= len(text)
    if texts:
        yield slice(first, len(texts))


def _batch_anchors(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place inside, and hash of the anchors of a batch, in order; mixed once more, as anchors have low hashes and ranges are to be even."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for part in _groups(raw):
        text, ends = _laid_out(raw[part])
        places, hashes = anchors(text, ends)
        doc = np.searchsorted(ends, places, side="right")
        found.append((doc + part.start, places - np.concatenate(([0], ends[:-1]))[doc], hashes))
    doc, inside, hashes = (np.concatenate(c) for c in zip(*found))
    return doc, inside, hashes * _MIX


def _gram_rows(ranges: int):
    """Grams at the anchors of a batch by range, five bytes of the hash each: those that occur once, those that occur more often, and the number of anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, hashes = _batch_anchors(as_bytes(batch.column(0)))
            grams, times = np.unique(hashes >> CUT, return_counts=True)
            out = []
            for bucket, part in split_by_range(grams << CUT, ranges):
                once, high = times[part] == 1, grams[part].view(np.uint8).reshape(-1, 8)[:, :5]
                out.append((bucket, high[once].tobytes(), high[~once].tobytes(), int(times[part].sum())))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, (_, kind) in enumerate(_GRAMS)], names=[n for n, _ in _GRAMS])

    return run


_GRAMS = (("bucket", pa.int32()), ("once", pa.binary()), ("more", pa.binary()), ("anchors", pa.int64()))


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range a filter of the grams that occur twice or more, and the number of their anchors and of all."""
    def whole(parts: list[bytes]) -> np.ndarray:
        high = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 5)
        out = np.zeros((len(high), 8), np.uint8)
        out[:, :5] = high
        return out.view(np.uint64).ravel()

    for bucket, rows in rows_by_bucket(batches):
        once, more = whole([r[1] for r in rows]), whole([r[2] for r in rows])
        grams, times = np.unique(np.concatenate((once, more, more)), return_counts=True)
        grams = grams[times > 1]
        every = sum(r[3] for r in rows)
        again = every - len(once) + int(np.isin(once, grams).sum())
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([GramFilter.piece(grams)], pa.binary()), pa.array([again], pa.int64()), pa.array([every], pa.int64())],
                                         names=["bucket", "filter", "again", "anchors"])


class GramFilter:
    """A Bloom filter of grams that occur twice, in a piece for each range; ranges without a piece have none."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits, self.starts = sizes, bits, np.cumsum(sizes) - sizes

    @staticmethod
    def whole(ranges: int, pieces: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """What a task needs, as arrays: workers read broadcasts without this module."""
        sizes = np.zeros(ranges, np.uint64)
        for bucket, piece in pieces.items():
            sizes[bucket] = 8 * len(piece)
        return sizes, np.frombuffer(b"".join(pieces[k] for k in sorted(pieces)), np.uint8)

    @staticmethod
    def _places(grams: np.ndarray, sizes) -> Iterator[np.ndarray]:
        for factor in _FACTORS:
            yield ((grams * factor) >> np.uint64(32)) * sizes >> np.uint64(32)

    @classmethod
    def piece(cls, grams: np.ndarray) -> bytes:
        flags = np.zeros(-(-BITS * len(grams) // 64) * 64, bool)
        for at in cls._places(grams, np.uint64(len(flags))):
            flags[at] = True
        return np.packbits(flags).tobytes()

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        of = ((hashes >> np.uint64(32)) * np.uint64(len(self.sizes)) >> np.uint64(32)).astype(np.int64)
        hit = np.flatnonzero(self.sizes[of] > 0)
        out, has = np.zeros(len(hashes), bool), np.ones(len(hit), bool)
        for place in self._places(hashes[hit] >> CUT, self.sizes[of[hit]]):
            at = place + self.starts[of[hit]]
            has &= (self.bits[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0
        out[hit[has]] = True
        return out


def slices(ranges: list[tuple[int, int, int, int]]) -> list[list[int]]:
    """Buckets in slices, of rows (bucket, bytes of filter, anchors that repeat, anchors): a slice
    has ``SLICE`` of all anchors at most and filters of ``FILTERS`` bytes at most, or one bucket."""
    out, size, held, every = [], 0, 0, sum(r[3] for r in ranges)
    for bucket, filter_bytes, again, _ in sorted(ranges):
        if not again:
            continue
        size, held = size + filter_bytes, held + again
        if not out or size > FILTERS or held > SLICE * every:
            out.append([])
            size, held = filter_bytes, again
        out[-1].append(bucket)
    return out


def _suffixes(text: np.ndarray, places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each anchor: the suffix, the bytes before it backwards, and how long they are."""
    out = np.zeros((len(places), WIDTH), np.uint8)
    for first in range(0, len(places), 4_000):
        part = slice(first, first + 4_000)
        p = places[part, None]
        after = p + np.arange(LENGTH)
        right = after < ends[part, None]
        out[part, :LENGTH] = np.where(right, text[np.minimum(after, len(text) - 1)], 0)
        before = p - 1 - np.arange(BACK)
        left = before >= starts[part, None]
        out[part, LENGTH:LENGTH + BACK] = np.where(left, text[np.maximum(before, 0)], 0)
        out[part, -2], out[part, -1] = left.sum(axis=1), right.sum(axis=1)
    return out


def front_coded(sorted_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of the prefix that each row has in common with the one before, and the rest of all rows."""
    common = np.zeros(len(sorted_rows), np.uint8)
    differ = sorted_rows[1:] != sorted_rows[:-1]
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), sorted_rows.shape[1])
    return common, sorted_rows[np.arange(sorted_rows.shape[1]) >= common[:, None]]


def from_front_coded(common: np.ndarray, rest: np.ndarray, width: int = WIDTH) -> np.ndarray:
    own = np.arange(width) >= common[:, None]
    rows = np.zeros((len(common), width), np.uint8)
    rows[own] = rest
    given = np.maximum.accumulate(np.where(own, np.arange(len(common))[:, None], 0), axis=0)
    return rows[given, np.arange(width)]


_RUN = (("bucket", pa.int32()), ("common", pa.binary()), ("rest", pa.binary()), ("folded", pa.binary()), ("ids", pa.binary()), ("marks", pa.binary()), ("places", pa.binary()))


def _sorted_runs(ranges: int, repeated: Broadcast):
    """Runs of suffixes at anchors whose gram may repeat, by range; equal suffixes folded with their places in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = GramFilter(*repeated.value)
        for batch in batches:
            ids, marks = (batch.column(c).to_numpy() for c in (0, 1))
            raw = as_bytes(batch.column(2))
            doc, inside, hashes = _batch_anchors(raw)
            again = wanted.may_have(hashes)
            doc, inside, hashes = doc[again], inside[again], hashes[again]
            for first in range(0, len(doc), RUN):
                d, x, gram = doc[first:first + RUN], inside[first:first + RUN], hashes[first:first + RUN]
                held = slice(d[0], d[-1] + 1)
                text, ends = _laid_out(raw[held])
                starts, at = np.concatenate(([0], ends[:-1])), d - d[0]
                keys = _suffixes(text, x + starts[at], starts[at], ends[at])
                order = np.lexsort((x, marks[d], ids[d]))
                order = order[np.argsort(keys[order].view(f"S{WIDTH}").ravel(), kind="stable")]
                out = []
                for bucket, part in split_by_range(gram[order], ranges):
                    rows = order[part]
                    new = np.concatenate(([True], (keys[rows[1:]] != keys[rows[:-1]]).any(axis=1)))
                    common, rest = front_coded(keys[rows[new]])
                    folded = np.diff(np.append(np.flatnonzero(new), len(rows)))
                    out.append((bucket, common.tobytes(), pa.compress(rest.tobytes(), "zstd", asbytes=True), packed(folded, np.int32), packed(ids[d[rows]], np.int64),
                                packed(marks[d[rows]], np.int64), packed(x[rows], np.int32)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*out), _RUN)], names=[n for n, _ in _RUN])

    return run


def _common_from(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = known
    while n < WIDTH and a[n:n + 16] == b[n:n + 16]:
        n += 16
    if n >= WIDTH:
        return WIDTH
    while a[n] == b[n]:
        n += 1
    return n


class Run:
    """A sorted run as it came, front-coded; ``DECODED`` of its keys are decoded at once."""

    def __init__(self, common: bytes, rest: bytes):
        self.common, self.rest = common, np.frombuffer(rest, np.uint8)
        self.first = self.used = 0
        self.last, self.keys = np.zeros((1, WIDTH), np.uint8), b""

    def key(self, k: int) -> bytes | None:
        """Key ``k``; keys are asked for in order."""
        if k >= len(self.common):
            return None
        if k >= self.first + len(self.keys) // WIDTH:
            common = np.frombuffer(self.common[k:k + DECODED], np.uint8)
            until = self.used + int((WIDTH - common.astype(np.int64)).sum())
            rows = from_front_coded(np.append(np.uint8(0), common), np.concatenate((self.last[0], self.rest[self.used:until])))
            self.first, self.used, self.last, self.keys = k, until, rows[-1:].copy(), rows[1:].tobytes()
        at = (k - self.first) * WIDTH
        return self.keys[at:at + WIDTH]


def merge_runs(runs: list[Run]) -> Iterator[tuple[bytes, int, int, int]]:
    """Merge sorted front-coded runs.

    Yields key, common prefix with the key that came out before, run, and place in the
    run. A loser remembers its common prefix with the winner it lost to, which is the
    last key out; of two heads the one that shares more with it comes first, and only
    heads that share equally much are compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [run.key(0) for run in runs] + [None] * (size - len(runs))
    shared, at, losers = [0] * size, [0] * size, [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        n = _common_from(x, y, shared[a])
        if n == WIDTH or x[n] < y[n]:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    winners = list(range(size))
    level = size
    while level > 1:
        level //= 2
        for k in range(level):
            winners[k], losers[level + k] = play(winners[2 * k], winners[2 * k + 1])
    best = winners[0]
    while heads[best] is not None:
        yield heads[best], shared[best], best, at[best]
        run = runs[best]
        at[best] += 1
        heads[best] = run.key(at[best])
        if heads[best] is not None:
            shared[best] = run.common[at[best]]
        node = (best + size) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


Place = tuple[int, int, int]


def _covered(group: list[tuple[bytes, Place]]) -> Iterator[tuple[Place, int, int]]:
    """How far before and after the anchor earlier different suffixes of the gram cover a place.

    ``group`` has the distinct suffixes of one gram with their first places. All
    stretches of a place hold the gram, so their union is one stretch.
    """
    group.sort(key=lambda g: g[1])
    keys = np.frombuffer(b"".join(k for k, _ in group), np.uint8).reshape(-1, WIDTH)
    right, left = keys[:, :LENGTH], keys[:, LENGTH:LENGTH + BACK]
    n_left, n_right = keys[:, -2].astype(np.int64), keys[:, -1].astype(np.int64)
    if len(group) <= 64:
        for i in range(1, len(group)):
            after = np.minimum(_run_length(right[:i] == right[i]), np.minimum(n_right[:i], n_right[i]))
            before = np.minimum(_run_length(left[:i] == left[i]), np.minimum(n_left[:i], n_left[i]))
            long = after + before >= LENGTH
            if long.any():
                yield group[i][1], int(before[long].max()), int(after[long].max())
        return
    # Many suffixes: for each offset of the anchor, all but the first of equal strings.
    line = np.concatenate((left[:, ::-1], right), axis=1)
    most, least = np.full(len(group), -1), np.full(len(group), LENGTH)
    for block in range(0, BACK + 1, OFFSETS):
        backs = range(block, min(block + OFFSETS, BACK + 1))
        for back, hashes in zip(backs, _window_hashes(line, backs)):
            able = np.flatnonzero((n_left >= back) & (n_right >= LENGTH - back))
            again = able[_not_first(line[:, BACK - back:BACK - back + LENGTH], hashes, able)]
            most[again] = back
            least[again] = np.minimum(least[again], back)
    for i in np.flatnonzero(most >= 0).tolist():
        yield group[i][1], int(most[i]), int(LENGTH - least[i])


def _window_hashes(line: np.ndarray, backs: range) -> np.ndarray:
    """For each offset a hash of the string of each row: differences of running sums, so no string is read twice."""
    out = np.empty((len(backs), len(line)), np.uint64)
    for first in range(0, len(line), 8192):
        part = slice(first, first + 8192)
        sums = np.zeros((len(line[part]), line.shape[1] + 1), np.uint64)
        np.cumsum(_BYTES[line[part]] * _POWERS, axis=1, out=sums[:, 1:])
        for k, back in enumerate(backs):
            at = BACK - back
            h = (sums[:, at + LENGTH] - sums[:, at]) * _INVERSE[at]
            out[k, part] = (h ^ (h >> np.uint64(31))) * _MIX
    return out


def _not_first(strings: np.ndarray, hashes: np.ndarray, able: np.ndarray) -> np.ndarray:
    """Of the rows ``able``, which have a string that an earlier one of them has. Hashes
    propose, bytes decide: if any two strings share a hash only, the strings themselves are sorted."""
    _, first, which = np.unique(hashes[able], return_index=True, return_inverse=True)
    earlier = first[which]
    later = np.flatnonzero(earlier != np.arange(len(able)))
    for part in np.split(later, range(8192, len(later), 8192)):
        if (strings[able[part]] != strings[able[earlier[part]]]).any():
            whole = np.ascontiguousarray(strings[able]).view(f"V{LENGTH}").ravel()
            _, first, which = np.unique(whole, return_index=True, return_inverse=True)
            return first[which] != np.arange(len(able))
    return earlier != np.arange(len(able))


def _run_length(equal: np.ndarray) -> np.ndarray:
    """How many columns from the first on are all true, for every row."""
    return np.where(equal.all(axis=1), equal.shape[1], equal.argmin(axis=1))


class Stretches:
    """Covered stretches (id, mark, first byte and last byte + 1) on their way out: single ones, and many at once."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, int]] = []
        self.parts: list[np.ndarray] = []
        self.many = 0

    def add(self, place: Place, before: int, after: int) -> None:
        self.rows.append((place[0], place[1], place[2] - before, place[2] + after))

    def add_many(self, ids: np.ndarray, marks: np.ndarray, places: np.ndarray, before: int, after: int) -> None:
        places = places.astype(np.int64)
        self.parts.append(np.array([ids, marks, places - before, places + after], np.int64))
        self.many += len(ids)

    def __len__(self) -> int:
        return len(self.rows) + self.many

    def batch(self) -> pa.RecordBatch:
        ids, marks, firsts, lasts = np.concatenate([np.array(self.rows, np.int64).reshape(-1, 4).T, *self.parts], axis=1)
        self.__init__()
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(marks), pa.array(firsts.astype(np.int32)), pa.array(lasts.astype(np.int32))],
                                          names=["id", "mark", "first", "last"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered stretches (id, mark, first byte and last byte + 1) of the suffixes of each range.

    Of the places of one suffix only the first so far is kept; all others are covered
    and go out at once, so a gram of any number of places needs memory for its different suffixes only.
    """
    for _, rows in rows_by_bucket(batches):
        runs, places = [], []
        while rows:
            _, common, rest, folded, ids, marks, inside = rows.pop()
            size = int((WIDTH - np.frombuffer(common, np.uint8).astype(np.int64)).sum())
            runs.append(Run(common, pa.decompress(rest, size, "zstd", asbytes=True)))
            places.append((np.concatenate(([0], np.cumsum(np.frombuffer(folded, np.int32)))).tolist(), np.frombuffer(ids, np.int64),
                           np.frombuffer(marks, np.int64), np.frombuffer(inside, np.int32)))
        found = Stretches()

        def close(group: list[tuple[bytes, Place]]) -> None:
            if len(group) > 1:
                for place, before, after in _covered(group):
                    found.add(place, before, after)

        group: list[tuple[bytes, Place]] = []  # the different suffixes of one gram with their first places
        for key, common, run, k in merge_runs(runs):
            if common < GRAM and group:
                close(group)
                group = []
            ends, ids, marks, inside = places[run]
            at, end = ends[k], ends[k + 1]
            first: Place = (ids.item(at), marks.item(at), inside.item(at))  # places of a run are in order
            if end - at > SOME:
                found.add_many(ids[at + 1:end], marks[at + 1:end], inside[at + 1:end], key[-2], key[-1])
            else:
                for j in range(at + 1, end):
                    found.add((ids.item(j), marks.item(j), inside.item(j)), key[-2], key[-1])
            if group and common == WIDTH:
                first, later = sorted((first, group[-1][1]))
                found.add(later, key[-2], key[-1])
                group[-1] = (key, first)
            else:
                group.append((key, first))
            if len(found) > FLUSH:
                yield found.batch()
        close(group)
        if len(found):
            yield found.batch()


def merged_stretches(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of stretches as maximal ones, in order."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate(([True], first[1:] > reach[:-1])) if len(first) else np.zeros(0, bool)
    return first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)] if len(first) else reach


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id and the united stretches of each mark, of rows with an id and stretches."""
    for batch in batches:
        flat = batch.column(1).flatten()
        mark, first, last = (flat.field(c).to_numpy().astype(np.int64) for c in ("mark", "first", "last"))
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(1)).to_numpy())
        order = np.lexsort((mark, row))
        row, mark, first, last = row[order], mark[order], first[order], last[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (mark[1:] != mark[:-1])
        text = (np.cumsum(new) - 1) << 32  # one line for all texts, far apart
        first, last = merged_stretches(first + text, last + text)
        of = first >> 32
        fields = [pa.array(mark[new][of]), pa.array((first - (of << 32)).astype(np.int32)), pa.array((last - (of << 32)).astype(np.int32))]
        ends = np.searchsorted(row[new][of], np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["mark", "first", "last"]))], names=["id", "stretches"])


def _document_key(id_col: str) -> Column:
    """Ids as long values; a null id comes before all others."""
    return F.coalesce(col(id_col).cast("long"), F.lit(-(2**63)))


_STRETCHES = "id long, stretches array<struct<mark:long,first:int,last:int>>"


def repeated_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``mark`` (hash of the text), ``text`` (bytes) and ``stretches`` (first byte, last byte + 1)
    of every row of ``docs``; stretches may overlap. Null where nothing repeats.

    A byte is in a stretch if a string of 100 bytes that covers it also starts
    earlier: in a document with a smaller id, or before it in the same one.
    Documents with one id follow the hash of their texts; rows that agree in id
    and text are one document. Null text: no bytes. Null id: before all others.
    Texts below 100 bytes repeat nothing. Empty table: no rows.

    Memory: a task holds a batch of texts, a run of ``RUN`` suffixes, or one range
    of runs. Disk: the grams' hashes, then the runs of a slice, then the texts once.
    Stretches are staged.
    """
    ranges = RANGES_PER_PARTITION * partitions(docs)
    raw = F.coalesce(col(text_col).cast("binary"), F.lit(b""))
    texts = docs.select(_document_key(id_col).alias("id"), F.xxhash64(raw).alias("mark"), raw.alias("text"))
    spark = docs.sparkSession
    grams = texts.select("text").mapInArrow(released(_gram_rows(ranges)), "bucket int, once binary, more binary, anchors long")
    filters = stage(by_range(grams, ranges).mapInArrow(released(_filters), "bucket int, filter binary, again long, anchors long"))
    found = spark.createDataFrame([], _STRETCHES)
    for part in slices([tuple(r) for r in filters.select("bucket", F.length("filter"), "again", "anchors").collect()]):
        pieces = filters.filter(F.col("bucket").between(part[0], part[-1])).select("bucket", "filter").collect()
        repeated = spark.sparkContext.broadcast(GramFilter.whole(ranges, {r["bucket"]: bytes(r["filter"]) for r in pieces}))
        runs = texts.mapInArrow(released(_sorted_runs(ranges, repeated)), "bucket int, common binary, rest binary, folded binary, ids binary, marks binary, places binary")
        merged = (by_range(runs, len(part)).mapInArrow(released(_merged), "id long, mark long, first int, last int")
                  .groupBy("id").agg(F.collect_list(F.struct("mark", "first", "last")).alias("stretches")))
        found = found.union(stage(merged.mapInArrow(released(_united), _STRETCHES)))
    stretches = found.groupBy("id").agg(F.flatten(F.collect_list("stretches")).alias("stretches"))
    return texts.join(stretches, "id", "left").select("id", "mark", "text", F.filter("stretches", lambda s: s["mark"] == F.col("mark")).alias("stretches"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (maximal removed stretches of bytes),
    ``kept_sha256`` and, if wanted, ``kept`` (the bytes left; a cut may split a character)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            listed = batch.column(2)
            flat = listed.flatten()
            firsts, lasts = (flat.field(c).to_numpy().astype(np.int64) for c in ("first", "last"))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(listed), 0).to_numpy())
            for text, start, end in zip(as_bytes(batch.column(1)), np.concatenate(([0], ends[:-1])), ends):
                first, last = merged_stretches(firsts[start:end], lasts[start:end])
                sizes.append(len(text))
                removed.append(int((last - first).sum()))
                spans.append([{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist())])
                kept.append(b"".join(text[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(text)])) if len(first) else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, pair),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept if keep_text else [None] * len(kept), pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"])

    schema = "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<first:int,last:int>>, kept_sha256 string, kept binary"
    out = repeated_stretches(docs, id_col, text_col).select("id", "text", "stretches").mapInArrow(released(run), schema)
    return out.withColumn("id", F.when(F.col("id") > -(2**63), F.col("id"))).withColumnRenamed("id", id_col)
