"""Operator 8: document quality by histogram gradient-boosted trees over document statistics.

Statistics of all documents are made in one pass over the whole texts. The trees are fitted on a bounded sample of labelled
rows, flattened into arrays, and walked level by level for a whole batch at once.

Defined results: NULL and empty texts have statistics of zero and are scored by them; without labels, or with labels of one
kind only, every score is their mean (0.5 without any); of several labels of a document the largest counts; repeated rows are
scored alike; an empty table gives no rows; other columns are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestar.llm.common import IS_SPACE, LOWER, bytes_of, mix, prefix_hash, range_hash, staged, text_or_empty, word_bounds

# Labelled rows that the trees are fitted on at most: those with the least hashes of their ids.
FIT_ROWS = 40_000
TREES, LEVELS, BINS, RATE, LEAST_WEIGHT, RIDGE = 80, 4, 64, 0.15, 4.0, 1.0

_MARKS = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", dtype=np.uint8)
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
N_STATISTICS = 22 + len(_MARKS)


def statistics(data: np.ndarray) -> np.ndarray:
    """Statistics of a text's bytes: shares of kinds of characters, lengths, and how much repeats."""
    out = np.zeros(N_STATISTICS, dtype=np.float32)
    start, end = word_bounds(data)
    if not len(start):
        return out
    n, words = len(data), len(start)
    kinds = np.bincount(data, minlength=256)
    length = end - start
    hashes = range_hash(prefix_hash(LOWER[data]), start, end)
    _, counts = np.unique(hashes, return_counts=True)
    pairs = mix(hashes[1:] * np.uint64(3) + hashes[:-1])
    lines = np.flatnonzero(data == 10)
    line_start, line_end = np.append(0, lines + 1), np.append(lines, n)
    filled = line_end > line_start
    line_start, line_end = line_start[filled], line_end[filled]
    line_hash = range_hash(prefix_hash(data), line_start, line_end)
    first, last = data[start], data[end - 1]
    letter = np.zeros(256, dtype=bool)
    letter[_UPPER] = letter[_LOWER] = True
    letter[128:] = True
    capital = np.zeros(256, dtype=bool)
    capital[_UPPER] = True
    out[:22] = (
        np.log1p(n), np.log1p(words), length.mean(), length.std(), kinds[_UPPER].sum() / n, kinds[_DIGIT].sum() / n, kinds[128:].sum() / n,
        kinds[IS_SPACE].sum() / n, len(counts) / words, counts.max() / words, (counts * (counts - 1)).sum() / max(1, words * (words - 1)),
        len(np.unique(pairs)) / max(1, len(pairs)), (hashes[1:] == hashes[:-1]).mean() if words > 1 else 0, capital[first].mean(),
        (~letter[last]).mean(), (~letter[first]).mean(), len(line_start), len(np.unique(line_hash)) / max(1, len(line_start)),
        words / max(1, len(line_start)), (length == 1).mean(), (length > 15).mean(), kinds[_MARKS].sum() / n,
    )
    out[22:] = kinds[_MARKS] / n
    return out


def document_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every row; the statistics are 32-bit floats, one behind the other."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(bytes_of(batch.column(1), i)).tobytes() for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "statistics"])

    return text_or_empty(documents).mapInArrow(make, "doc_id long, statistics binary")


@dataclass(frozen=True)
class Forest:
    """All trees as arrays: complete binary trees of ``LEVELS`` levels; an inner node compares one statistic with a bound."""

    base: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(LEVELS):
                node = 2 * node + 1 + (x[row, feature[node]] > bound[node])
            total += leaf[node - (2**LEVELS - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for the log-odds of y = 1, grown level by level on histograms of gradients."""
    inner = 2**LEVELS - 1
    none = np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1))
    if not len(y):
        return Forest(0.0, *none)
    mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return Forest(base, *none)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)])
    total, trees = np.full(n, base), ([], [], [])
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node, offset = np.zeros(n, dtype=np.int64), 0
        feature, bound = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(LEVELS):
            here = 2**level
            local = node - offset
            best = np.zeros(here)
            cut = np.full(here, BINS)
            for j in range(width):
                if not len(edges[j]):
                    continue
                cell = local * BINS + binned[j]
                g = np.bincount(cell, gradient, here * BINS).reshape(here, BINS).cumsum(axis=1)
                h = np.bincount(cell, weight, here * BINS).reshape(here, BINS).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = 0
                gain[:, len(edges[j]) :] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(here), at] > best
                best[better], cut[better] = gain[np.arange(here), at][better], at[better]
                feature[offset : offset + here][better] = j
                bound[offset : offset + here][better] = edges[j][at[better]]
            node = 2 * node + 1 + (binned[feature[node], np.arange(n)] > cut[local])
            offset = 2 * offset + 1
        slot = node - inner
        value = RATE * np.bincount(slot, gradient, inner + 1) / (np.bincount(slot, weight, inner + 1) + RIDGE)
        total += value[slot]
        for part, new in zip(trees, (feature, bound, value), strict=True):
            part.append(new)
    return Forest(base, *(np.stack(part) for part in trees))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float32).reshape(len(column), N_STATISTICS)


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of ``documents``; ``labels`` (doc_id, label) are the rows to learn from."""
    known = staged(document_statistics(documents), "statistics")
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = staged(labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS), "labels")
    sample = known.join(F.broadcast(chosen), "doc_id").select("statistics", "label").limit(FIT_ROWS).toPandas()
    forest = fit(_matrix(sample["statistics"]) if len(sample) else np.zeros((0, N_STATISTICS)), sample["label"].to_numpy(dtype=float))

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": forest.score(_matrix(batch["statistics"])) if len(batch) else []})

    return known.mapInPandas(score, "doc_id long, score double")
