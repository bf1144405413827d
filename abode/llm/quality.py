"""Quality rules: document statistics judged by gradient-boosted trees.

A bounded sample of labelled documents trains the trees; every document is
then scored. The trees of the model are flattened into arrays of nodes, so a
batch of documents walks all trees at once in numpy. Monotonic constraints
keep the model from rewarding more symbols, shouting or repetition.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.llm.common import as_bytes, col, map_texts, unpack

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Feature and the direction in which quality may go as it grows: -1 down only, 0 either.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "upper_share": -1, "shout_share": -1, "digit_share": 0,
    "other_share": 0, "dup_line_share": -1, "repeat_share": -1, "top_word_share": -1, "distinct_share": 0,
    "words_per_line": 0, "stop_share": 0, "non_ascii_share": 0,
}

_SPACE = np.array([0x20, *range(0x09, 0x0E)])
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n].astype(np.uint64)
    order = np.sort(mixed)
    if not (order[1:] == order[:-1]).any():
        return 0  # equal windows have equal hashes
    # Exact: number the windows of 2, 4, ... words by the pairs they consist of.
    code, length = ids.astype(np.int64), 1
    while length < window:
        step = min(length, window - length)
        left, right = code[:len(code) - step], code[step:]
        _, code = np.unique(left * (int(code.max()) + 1) + right, return_inverse=True)
        length += step
    seen = np.bincount(code)
    at = np.flatnonzero(seen[code] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (``COUNTS``) and features (``FEATURES``) of every text, one row each."""
    counts = np.zeros((len(texts), len(COUNTS)), np.int64)
    x = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        words = text.split()  # bytes split at exactly 0x20 and 0x09 to 0x0D
        if not words:
            continue
        n = len(words)
        numbers: dict[bytes, int] = {}
        ids = np.fromiter(map(numbers.setdefault, words, count()), np.int64, n)
        held = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        chars = int(held.sum() - held[0x80:0xC0].sum() - held[_SPACE].sum())
        lines = [line for line in text.split(b"\n") if line and not line.isspace()]
        symbols, dup_lines, repeats = int(held[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(ids)
        counts[i] = n, chars, symbols, dup_lines, repeats
        wide = held[0xC0:].sum()
        often = np.sort(np.bincount(ids))[::-1]
        x[i] = (np.log(n), chars / n, symbols / chars, held[_UPPER].sum() / chars, held[33] / chars, held[_DIGIT].sum() / chars,
                1 - (held[_UPPER].sum() + held[_LOWER].sum() + held[_DIGIT].sum() + wide) / chars, dup_lines / len(lines),
                repeats / n, often[0] / n, len(numbers) / n, n / len(lines), often[:10].sum() / n, wide / chars)
    return counts, x


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeats = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


@dataclass
class Forest:
    """All trees in flat node arrays. A leaf has itself as both children."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality, for all rows and trees at once."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit_forest(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2,
               bins: int = 64, penalty: float = 1.0, least: int = 5) -> Forest:
    """Second-order boosting on quantile histograms with logistic loss.

    A constrained feature only splits in its direction, and the values of the
    two sides stay on their side of the middle all the way down, so the whole
    model is monotonic in it. A model that can't split answers the base rate.
    """
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    nodes: list[list[float]] = []  # feature, limit, left, right, value
    roots = []
    total = np.full(len(x), start)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        me, value = len(nodes), float(np.clip(-sum_g / (sum_h + penalty), low, high))
        nodes.append([0, 0.0, me, me, rate * value])
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            for f, way in enumerate(directions):
                if not len(edges[f]):
                    continue
                b, size = binned[rows, f], len(edges[f]) + 1
                gl = np.cumsum(np.bincount(b, g[rows], size))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], size))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                vl = np.clip(-gl / (hl + penalty), low, high)
                vr = np.clip(-(sum_g - gl) / (sum_h - hl + penalty), low, high)
                gain = -(gl * vl + 0.5 * (hl + penalty) * vl**2) - ((sum_g - gl) * vr + 0.5 * (sum_h - hl + penalty) * vr**2) \
                    + (sum_g * value + 0.5 * (sum_h + penalty) * value**2)
                gain[(nl < least) | (len(rows) - nl < least) | (way * (vr - vl) < 0)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, vl[k], vr[k]))
        if best[1] is None:
            total[rows] += rate * value
            return me
        f, k, vl, vr = best[1]
        middle, way = (vl + vr) / 2, directions[f]
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[way]
        side = binned[rows, f] <= k
        left = grow(rows[side], g, h, level + 1, *bounds[0])
        right = grow(rows[~side], g, h, level + 1, *bounds[1])
        nodes[me] = [f, float(edges[f][k]), left, right, 0.0]
        return me

    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(x)), p - y, p * (1 - p), 0, -4.0, 4.0))
    flat = np.array(nodes or [[0, 0.0, 0, 0, 0.0]])
    return Forest(np.array(roots, np.int64), flat[:, 0].astype(np.int64), flat[:, 1], flat[:, 2].astype(np.int64),
                  flat[:, 3].astype(np.int64), flat[:, 4], depth, start)


def training_sample(docs: DataFrame, labels: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the ``limit`` labelled documents that come first in hash order.

    The ids of the sample are bounded by ``limit`` and so may be broadcast; at most
    ``limit`` rows of features reach the driver.
    """
    chosen = (labels.filter(F.col("quality").isin(0, 1) & col(id_col).isNotNull())
              .groupBy(col(id_col).alias("sample_id")).agg(F.min("quality").alias("good"))
              .orderBy(F.xxhash64("sample_id"), "sample_id").limit(limit))
    wanted = (docs.select(col(id_col).alias("sample_id"), col(text_col).alias("text"))
              .join(F.broadcast(chosen), "sample_id"))
    fields = [T.StructField("features", T.ArrayType(T.DoubleType()))]
    rows = (map_texts(wanted, lambda texts: [pa.array(list(statistics(as_bytes(texts))[1]), pa.list_(pa.float64()))], fields)
            .select(F.col("row.sample_id").alias("id"), F.col("row.good").alias("good"), "features")
            .orderBy("id", F.xxhash64("features")).limit(limit).collect())
    x = np.array([r["features"] for r in rows]).reshape(len(rows), len(FEATURES))
    return x, np.array([float(r["good"]) for r in rows])


def train(docs: DataFrame, labels: DataFrame, limit: int = 20_000) -> Forest:
    x, y = training_sample(docs, labels, limit)
    if not len(y):  # nothing to learn from: every document passes the trees
        return Forest(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), 0, 20.0)
    return fit_forest(x, y, list(FEATURES.values()))


def judge(docs: DataFrame, forest: Forest, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """Struct column ``row`` (the document) with counts, ``base_failed``, ``quality`` and ``kept``.

    A document is kept if the base rules pass and its quality reaches ``least``.
    Null and empty texts have no words and fail the base. Repeated rows are
    judged alike; an empty table gives no rows.
    """
    kinds = [*((c, T.LongType()) for c in COUNTS), ("base_failed", T.BooleanType()), ("quality", T.DoubleType()), ("kept", T.BooleanType())]

    def verdicts(texts: pa.Array) -> list[pa.Array]:
        counts, x = statistics(as_bytes(texts))
        failed, quality = base_failed(counts), forest.score(x)
        return [*(pa.array(c) for c in counts.T), pa.array(failed), pa.array(quality), pa.array(~failed & (quality >= least))]

    return map_texts(docs, verdicts, [T.StructField(*k) for k in kinds], text_col)


def quality_rules(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = 20_000) -> DataFrame:
    """``docs`` with the columns of :func:`judge`; a result replaces an input column of its name.

    ``sample`` bounds the labelled documents that train the trees. Labels that
    are null or not 0 or 1 don't count; of several labels the lowest does.
    Without labels, or with one kind only, the base rules decide.
    """
    return unpack(judge(docs, train(docs, labels, sample), least))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = 20_000) -> DataFrame:
    """The kept documents, with the columns of ``docs``."""
    return judge(docs, train(docs, labels, sample), least).filter("kept").select("row.*")


