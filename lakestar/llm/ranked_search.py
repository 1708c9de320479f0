"""Operator 12: ranked lexical search on K2-treaps over the grid of terms and documents.

Documents are dealt in blocks. The grid of a block has a row for each term that some item asks for and a column for each
document; a point holds the term's impact on the document's score. The grid is stored as a quadtree: a node is a cell, its
mask says which of its four quarters hold points, and each cell keeps the largest impact inside it, as the difference
to that of the cell around it. A search goes down the paths of all rows of an item at once over ranges of documents: the
sum of the maxima of the rows' cells is an upper bound of every score in the range, the ranges with the highest bounds are
halved first, and a range of one document has its exact score. The search of a block ends when no bound reaches the
lowest of the best k scores so far; a bound equal to it is followed, as ties go to the smaller doc_id.

Blocks are searched in rounds, each of eight times as many as the one before and all with the k-th best scores of the
rounds before as thresholds, so what the tasks hand on doesn't grow with the number of blocks. Rankings are exact.

Defined results: a NULL text has no terms and is no result; every row of ``documents`` is a document, also where ids or
texts repeat or ids are NULL (NULL comes first among ties); items that are equal in id and text are one item; an item
without terms, or that shares none with a document, has no results; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakestar.llm.common import bytes_of, staged
from lakestar.session import scratch_path

# Documents and points of a block at most (one document more is always taken whole).
BLOCK, POINTS = 1 << 11, 1 << 19
# Items and bytes of item texts that one pass over the documents serves; more items take more passes.
ITEMS, ITEM_BYTES = 4_096, 1 << 25
# Blocks of the first round, growth from round to round, and ranges that one step of a search halves.
FIRST, GROWTH, STEP = 64, 8, 256

# The bytes that make up terms (digits, letters, all of multi-byte characters), A-Z to a-z, all others to blank.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ONES = np.array([bin(m).count("1") for m in range(16)], dtype=np.int64)


def terms(data: bytes) -> list[bytes]:
    return data.translate(_TERM).split()


@dataclass(frozen=True)
class Item:
    item_id: int | None
    rows: np.ndarray


def _ask(texts: list[tuple[int | None, str | None]]) -> tuple[dict[bytes, int], list[Item]]:
    """Row numbers of all terms asked for (those of one item next to each other), and each item's rows."""
    vocabulary: dict[bytes, int] = {}
    items = []
    for item_id, text in texts:
        asked = dict.fromkeys(terms((text or "").encode()))
        items.append(Item(item_id, np.array([vocabulary.setdefault(t, len(vocabulary)) for t in asked], dtype=np.int64)))
    return vocabulary, items


def _postings(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, rows, tfs) of all documents with terms: their number of terms, and how often each asked one occurs."""
    known = documents.sparkSession.sparkContext.broadcast(vocabulary)
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("rows", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of = known.value.get
        for batch in batches:
            found = []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                words = terms(bytes_of(batch.column(1), i).tobytes())
                if words:
                    counts = Counter(map(row_of, words))
                    counts.pop(None, None)
                    found.append((doc_id, len(words), list(counts), list(counts.values())))
            columns = zip(*found, strict=True) if found else [[]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(scan, "doc_id long, n long, rows array<int>, tfs array<int>")


def _document_counts(postings: DataFrame, n_terms: int) -> np.ndarray:
    """Number of documents that hold each asked term, counted per task before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        rows = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(held[rows], pa.int64())], names=["row", "df"])

    counted = postings.select("rows").mapInArrow(count, "row long, df long").groupBy("row").agg(F.sum("df").alias("df"))
    found = np.zeros(n_terms, dtype=np.int64)
    for r in counted.toLocalIterator():
        found[r["row"]] = r["df"]
    return found


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits of each number on its even bit places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """A grid of impacts as a quadtree: cells level by level from the root, with the mask of their quarters and their maxima."""

    def __init__(self, height: int, masks: np.ndarray, lower: np.ndarray) -> None:
        """``lower`` is how much the maximum of each cell lies below that of the cell around it; the root's is its maximum, negated."""
        self.height, self.masks, self.lower = height, masks, lower
        children = _ONES[masks]
        self.first = 1 + np.cumsum(children) - children
        self.largest = np.empty(len(lower), dtype=np.int64)
        self.largest[0] = -int(lower[0])
        begin, end = 0, 1
        for _ in range(height):
            size = int(children[begin:end].sum())
            around = np.repeat(self.largest[begin:end], children[begin:end])
            self.largest[end : end + size] = around - lower[end : end + size]
            begin, end = end, end + size

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> Treap:
        height = max(int(rows.max()).bit_length(), int(columns.max()).bit_length(), 1)
        code = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(code, kind="stable")
        code, largest = code[order], impacts[order].astype(np.int64)
        levels, masks = [], []
        for _ in range(height):
            around = code >> np.uint64(2)
            begin = np.flatnonzero(np.append(True, around[1:] != around[:-1]))
            quarter = np.left_shift(1, (code & np.uint64(3)).astype(np.int64)).astype(np.uint8)
            above = np.maximum.reduceat(largest, begin)
            levels.append(np.repeat(above, np.diff(np.append(begin, len(code)))) - largest)
            masks.append(np.bitwise_or.reduceat(quarter, begin))
            code, largest = around[begin], above
        return cls(height, np.concatenate(masks[::-1]), np.concatenate([-largest, *levels[::-1]]))

    def search(self, rows: np.ndarray, least: int, k: int, doc_ids: np.ndarray, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, doc_ids) of ``best`` and this block for the item with these rows, highest first; scores below
        ``least`` are left out."""
        least = max(least, int(best[0][-1]) if len(best[0]) == k else 1)
        if not len(rows):
            return best
        # Open ranges: upper bound, level, column, and where their rows' cells lie in the pools.
        bound, level, column = np.array([len(rows) * self.largest[0]]), np.array([self.height]), np.array([0])
        start, size = np.array([0]), np.array([len(rows)])
        cells, of_row = np.zeros(len(rows), dtype=np.int64), rows
        while len(bound):
            some = np.argpartition(-bound, STEP)[:STEP] if len(bound) > STEP else np.arange(len(bound))
            rest = np.ones(len(bound), dtype=bool)
            rest[some] = False
            # The cells of the chosen ranges, one after another.
            n = size[some]
            at = np.repeat(start[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            cell, row, state = cells[at], of_row[at], np.repeat(np.arange(len(some)), n)
            below = level[some] - 1
            mask, first, down = self.masks[cell].astype(np.int64), self.first[cell], (row >> below[state]) & 1
            new = []
            for side in (0, 1):
                quarter = 2 * down + side
                there = (mask >> quarter) & 1 == 1
                child = (first + _ONES[mask & ((1 << quarter) - 1)])[there]
                of = state[there]
                sums = np.bincount(of, weights=self.largest[child], minlength=len(some)).astype(np.int64)
                new.append((child, row[there], of, sums, 2 * column[some] + side))
            for child, _, of, sums, columns in new:
                done = (below == 0) & (sums >= least)
                if done.any():
                    best = _best(np.append(best[0], sums[done]), np.append(best[1], doc_ids[columns[done]]), k)
                    least = max(least, int(best[0][-1]) if len(best[0]) == k else 1)
            parts = [(bound[rest], level[rest], column[rest], start[rest], size[rest])]
            pools, end = [(cells, of_row)], len(cells)
            for child, row_of, of, sums, columns in new:
                open_ = (below > 0) & (sums >= least)
                kept = open_[of]
                count = np.bincount(of[kept], minlength=len(some))[open_]
                parts.append((sums[open_], below[open_], columns[open_], end + np.cumsum(count) - count, count))
                pools.append((child[kept], row_of[kept]))
                end += int(kept.sum())
            bound, level, column, start, size = (np.concatenate(p) for p in zip(*parts, strict=True))
            cells, of_row = (np.concatenate(p) for p in zip(*pools, strict=True))
            alive = bound >= least
            if not alive.all():
                bound, level, column, start, size = (x[alive] for x in (bound, level, column, start, size))
            if len(cells) > 4 * size.sum() + 65_536:
                at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
                cells, of_row, start = cells[at], of_row[at], np.cumsum(size) - size
        return best


def _best(scores: np.ndarray, doc_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((doc_ids, -scores))[:k]
    return scores[order], doc_ids[order]


# NULL ids inside numpy; before all others among ties.
_NO_ID = np.iinfo(np.int64).min
_INDEX = "block string, round int, doc_ids binary, height int, masks binary, width int, lower binary"


def _rounds(blocks: int) -> list[float]:
    """Up to which share of the blocks each round goes."""
    shares = [min(1.0, FIRST / max(blocks, 1))]
    while shares[-1] < 1:
        shares.append(min(1.0, shares[-1] * GROWTH))
    return shares


def _index(postings: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> tuple[DataFrame, int]:
    """One row per block with its documents and its tree, dealt to rounds by the hash of its name, and the number of rounds."""
    # The number of blocks is about known beforehand; it only decides how many rounds there are.
    shares = _rounds(-(-n_docs // BLOCK))
    known = postings.sparkSession.sparkContext.broadcast(weights)
    names = [part.split()[0] for part in _INDEX.split(", ")]

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        weight, number, waiting, points = known.value, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids, n, rows, tfs = zip(*waiting, strict=True)
            sizes = np.array([len(r) for r in rows])
            row, tf = np.concatenate(rows).astype(np.int64), np.concatenate(tfs).astype(np.int64)
            length = 100 - 50 + (50 * np.array(n, dtype=np.int64) * n_docs) // n_terms
            impact = weight[row] * ((1_000_000_000 * tf) // (1_000 * tf + 20 * np.repeat(length, sizes)))
            # Documents with the same rarest term stand together, so that the maxima of rare terms hold for few ranges.
            begin = np.cumsum(sizes) - sizes
            heaviest = np.maximum.reduceat(weight[row] * len(weight) + row, begin)
            place = np.empty(len(sizes), dtype=np.int64)
            order = np.argsort(heaviest, kind="stable")
            place[order] = np.arange(len(sizes))
            tree = Treap.of(row, np.repeat(place, sizes), impact)
            name = f"{TaskContext.get().partitionId()}-{number}"
            share = (int.from_bytes(name.encode().ljust(16), "little") * 0x9E3779B97F4A7C15 >> 64) % (1 << 20) / (1 << 20)
            lower = tree.lower.copy()
            width = np.dtype(np.min_scalar_type(int(lower[1:].max(initial=0)))).itemsize
            doc_ids = np.array([_NO_ID if i is None else i for i in ids], dtype=np.int64)[order]
            body = lower[0].tobytes() + lower[1:].astype(f"u{width}").tobytes()
            values = [name, int(np.searchsorted(shares, share, side="right")), doc_ids.tobytes(), tree.height, tree.masks.tobytes(), width, body]
            number += 1
            waiting.clear()
            return pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))], schema=schema)

        for batch in batches:
            ids, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, row in enumerate(batch.column(2)):
                rows = row.values.to_numpy()
                if not len(rows):
                    continue
                waiting.append((ids[i], n[i], rows, batch.column(3)[i].values.to_numpy()))
                points += len(rows)
                if len(waiting) >= BLOCK or points >= POINTS:
                    yield flush()
                    points = 0
        if waiting:
            yield flush()

    types = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(part.split()[0], types[part.split()[1]]) for part in _INDEX.split(", ")])
    built = postings.mapInArrow(build, _INDEX)
    path = scratch_path(postings.sparkSession, "grid")
    built.write.partitionBy("round").option("compression", "zstd").parquet(path)
    return postings.sparkSession.read.schema(_INDEX).parquet(path), len(shares)


def _search(index: DataFrame, items: list[Item], least: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of each task for each item, none below ``least``."""
    asked = index.sparkSession.sparkContext.broadcast((items, least))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = asked.value
        none = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        best = [none] * len(items)
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, height, masks, width, lower = (batch.column(c)[i].as_py() for c in range(5))
                steps = np.concatenate([np.frombuffer(lower[:8], dtype=np.int64), np.frombuffer(lower[8:], dtype=f"u{width}").astype(np.int64)])
                tree = Treap(height, np.frombuffer(masks, dtype=np.uint8), steps)
                ids = np.frombuffer(doc_ids, dtype=np.int64)
                for j, item in enumerate(items):
                    rows = item.rows[item.rows < 1 << height]
                    best[j] = tree.search(rows, int(least[j]), k, ids, best[j])
        for j, (scores, ids) in enumerate(best):
            if len(scores):
                number = pa.array(np.full(len(scores), j), pa.int64())
                yield pa.RecordBatch.from_arrays([number, pa.array(ids, mask=ids == _NO_ID), pa.array(scores)], names=["item", "doc_id", "score"])

    return index.select("doc_ids", "height", "masks", "width", "lower").mapInArrow(run, "item long, doc_id long, score long")


def _rank_pass(spark: SparkSession, documents: DataFrame, texts: list[tuple[int | None, str | None]], k: int) -> DataFrame:
    """Rankings of some items: (item_id, rank, doc_id, score)."""
    vocabulary, items = _ask(texts)
    schema = "item_id long, rank int, doc_id long, score long"
    if not vocabulary:
        return spark.createDataFrame([], schema)
    postings = staged(_postings(documents, vocabulary), "postings")
    size = postings.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not size["docs"]:
        return spark.createDataFrame([], schema)
    df = _document_counts(postings, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * size["docs"] + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    index, rounds = _index(postings, weights, size["docs"], size["terms"])
    least, found = np.ones(len(items), dtype=np.int64), None
    top = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    for r in range(rounds):
        more = _search(index.where(F.col("round") == r), items, least, k)
        more = more if found is None else found.unionByName(more)
        found = staged(more.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).drop("rank"), "best")
        if r + 1 < rounds:
            for row in found.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).toLocalIterator():
                least[row["item"]] = row["least"]
    names = spark.createDataFrame([(j, item.item_id) for j, item in enumerate(items)], "item long, item_id long")
    ranked = found.withColumn("rank", F.row_number().over(top)).join(F.broadcast(names), "item")
    return ranked.select("item_id", "rank", "doc_id", "score")


def rank_documents(documents: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item, ranks from 1.

    A term's weight falls with the number of documents that hold it, its share of a score rises with its frequency in
    the document and falls with the document's length against the mean. All but the logarithm is whole numbers.
    """
    spark = documents.sparkSession
    asked = staged(items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct(), "items")
    size = asked.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    passes = max(1, -(-size["items"] // ITEMS), -(-size["bytes"] // ITEM_BYTES))
    ranked = None
    for p in range(passes):
        some = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).orderBy("item_id", "text")
        texts = [(r["item_id"], r["text"]) for r in some.toLocalIterator()]
        more = _rank_pass(spark, documents, texts, k)
        ranked = more if ranked is None else ranked.unionByName(more)
    return ranked
