"""Word shingles of whole texts as sets of 64-bit hashes, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash

from abode.llm.common import as_bytes

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at once; the arrays then stay in the cache.
_CHUNK = 1 << 17


def _byte_values() -> np.ndarray:
    """A random 64-bit value for each byte; A-Z as a-z, white space as nothing."""
    values = np.array([xxhash.xxh3_64_intdigest(bytes([b + 32 if 65 <= b <= 90 else b])) for b in range(256)], np.uint64)
    values[[0x20, *range(0x09, 0x0E)]] = 0
    return values


_VALUES = _byte_values()
_SPACE = _VALUES == 0


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word in ``data``: byte values times powers of an odd number, summed and mixed."""
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(data)))
    powers = np.cumprod(np.full(int(lengths.max()), MIX))
    place = np.arange(starts[0], len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    sums = _VALUES[data[starts[0]:]]
    sums *= powers[place]
    sums = np.add.reduceat(sums, starts - starts[0])
    sums ^= sums >> np.uint64(32)
    sums *= MIX
    return starts, sums ^ (sums >> np.uint64(29))


def _words(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after another, and where each text's end."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    found, at, first = [], [], 0
    while first < len(data):
        last = min(first + _CHUNK, len(data))
        while last < len(data) and not _SPACE[data[last]]:  # cut between words
            gap = np.flatnonzero(_SPACE[data[last:last + _CHUNK]])
            last = last + int(gap[0]) if len(gap) else min(last + _CHUNK, len(data))
        starts, hashes = _hash_words(data[first:last])
        found.append(hashes)
        at.append(starts + first)
        first = last
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.concatenate(found), np.searchsorted(np.concatenate(at), ends)


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of the words of each text, A-Z in lower case, split at ASCII white space.

    Equal words have equal hashes; a null text has no words.
    """
    hashes, ends = _words(as_bytes(texts))
    return np.split(hashes, ends[:-1]) if len(ends) else []


def sequence_digest(words: np.ndarray) -> bytes:
    """128-bit name of a word sequence."""
    return xxhash.xxh3_128_digest(np.ascontiguousarray(words).tobytes())


def _mixed(words: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        out ^= out >> np.uint64(29)
        out *= MIX
        out += words[k:k + len(out)]
    out ^= out >> np.uint64(32)
    out *= MIX
    out ^= out >> np.uint64(29)
    return out


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of each text and its sorted distinct shingles.

    A text of fewer than ``size`` words is one shingle, one without words has none.
    """
    hashes, ends = _words(as_bytes(texts))
    mixed, start = _mixed(hashes, size), 0
    for end in ends.tolist():
        words = hashes[start:end]
        if end - start >= size:
            found = np.sort(mixed[start:end - size + 1])
            found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        else:
            found = np.array([xxhash.xxh3_64_intdigest(b"whole" + words.tobytes())] if end > start else [], np.uint64)
        yield words, found
        start = end
