"""Operator 10: approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample and indexes every row. A query walks it with a priority queue over nodes, nearest centre
first, so that its leaves come best bin first. How many leaves a query visits is calibrated: for a sample of the queries, exact
neighbours among all rows are found in blocks, and visits widen until the wanted share of them is in visited leaves.

Leaves are searched as blocks of at most ``BLOCK`` vectors by at most ``BLOCK`` queries, so that neither a leaf with very many equal
vectors nor a leaf that all queries visit ends in one task. A query's leaves are searched in ``ROUNDS`` rounds, best bins first: the
``k``-th score so far is a bound below which the blocks of the next round return nothing. Rounds end at the powers 1/3, 2/3 and 1 of
the visits, so that a query's rows grow with their cube root. The bound loses no result, as ``k`` better ones are known.

Defined results: vectors that are NULL, empty or zero, or hold NULL or non-finite components, or have another length than most, take
no part; a query with no candidates has no rows; a query's own id is never its neighbour, on repeated rows either; repeated
candidates with one id and score count once; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestar.llm.common import staged

# The tree is fitted on so many rows at most, those with the least hashes of their ids.
FIT_ROWS = 20_000
BRANCHES, LEVELS, LEAST_SPLIT, ITERATIONS = 12, 3, 60, 8
# Queries for calibration at most, and the share of their exact neighbours that visited leaves must hold.
CALIBRATION_QUERIES, WANTED_RECALL = 256, 0.97
BLOCK = 2_048
ROUNDS = 3


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays: centres, and the children of each node (none for a leaf)."""

    centres: np.ndarray
    children: list[list[int]]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: at every level the child with the nearest centre."""
        node = np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if not self.children[at] or not len(rows):
                node[rows] = at
                continue
            best = _nearest(x[rows], self.centres[self.children[at]])
            todo += [(child, rows[best == i]) for i, child in enumerate(self.children[at])]
        return node

    def best_bins(self, query: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves for a query, by a priority queue on the inner product with the centres."""
        scores = self.centres @ query
        queue, found = [(-np.inf, 0)], []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(node)
            for child in self.children[node]:
                heapq.heappush(queue, (-scores[child], child))
        return found

    @property
    def n_leaves(self) -> int:
        return sum(not c for c in self.children)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def fit_tree(x: np.ndarray) -> Tree:
    """Split the sample by k-means, level by level, as long as a node has enough rows."""
    rng = np.random.default_rng(10)
    centres, children, todo = [x.mean(axis=0)], [[]], [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, level = todo.pop()
        if level == LEVELS or len(rows) < LEAST_SPLIT:
            continue
        here = x[rows]
        means = here[rng.choice(len(here), min(BRANCHES, len(here) // 10), replace=False)]
        for _ in range(ITERATIONS):
            own = _nearest(here, means)
            means = np.stack([here[own == i].mean(axis=0) if (own == i).any() else means[i] for i in range(len(means))])
        own = _nearest(here, means)
        kept = [i for i in range(len(means)) if (own == i).any()]
        if len(kept) < 2:
            continue
        for i in kept:
            children[node].append(len(centres))
            todo.append((len(centres), rows[own == i], level + 1))
            centres.append(means[i])
            children.append([])
    return Tree(np.array(centres), children)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector): the rows that take part, as doubles, each once."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vector, lambda v: v != 0)
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(F.coalesce(sound, F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    # Repeats are merged before the shuffle.
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0)).distinct()


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, summed in one fixed order whatever the shape: equal vectors get equal scores."""
    out = np.zeros((len(queries), len(rows)))
    for i in range(queries.shape[1]):
        out += queries[:, i : i + 1] * rows[:, i]
    return out


def _top(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the ``k`` best of one query, ties to the smaller id. Of an id that repeats with one score one place counts."""
    scores = np.where(ids == own, -np.inf, scores)
    wanted = k + 1
    while True:
        whole = len(scores) <= 4 * wanted
        near = np.arange(len(scores)) if whole else np.flatnonzero(scores >= np.partition(scores, -wanted)[-wanted])
        near = near[np.lexsort((ids[near], -scores[near]))]
        again = (ids[near][1:] == ids[near][:-1]) & (scores[near][1:] == scores[near][:-1])
        near = near[np.append(True, ~again)] if len(near) else near
        near = near[scores[near] > -np.inf]
        if whole or len(near) >= k:
            return near[:k]
        # Repeats have taken the room of others.
        wanted *= 4


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _least(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the least hashes of their ids. The hashes alone are sorted, vectors are fetched for those."""
    rank = F.xxhash64("vec_id")
    last = rows.select(rank.alias("rank")).orderBy("rank").limit(n).agg(F.max("rank").alias("last")).first()["last"]
    return rows.where(rank <= (0 if last is None else last)).limit(n)


def calibrate(tree: Tree, indexed: DataFrame, queries: DataFrame, k: int) -> int:
    """Leaves to visit so that ``WANTED_RECALL`` of the exact neighbours of a sample of the queries are in them."""
    sample = _least(queries, CALIBRATION_QUERIES).select("vec_id", "vector").toPandas()
    if not len(sample):
        return 1
    own, x = sample["vec_id"].to_numpy(), _stack(sample["vector"])

    def search(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids, leaf = batch["vec_id"].to_numpy(), batch["leaf"].to_numpy()
            scores = x @ _stack(batch["vector"]).T
            for q in range(len(x)):
                near = _top(ids, scores[q], own[q], k)
                yield pd.DataFrame({"q": q, "vec_id": ids[near], "leaf": leaf[near], "score": scores[q][near]})

    best = indexed.mapInPandas(search, "q int, vec_id long, leaf long, score double")
    best = best.groupBy("q", "vec_id", "score").agg(F.collect_set("leaf").alias("leaves"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    # k rows for each of the bounded number of queries.
    true = best.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "leaves").toPandas()
    order = {q: {leaf: i for i, leaf in enumerate(tree.best_bins(x[q], tree.n_leaves))} for q in true["q"].unique()}
    depth = np.sort([min(order[q][leaf] for leaf in leaves) for q, leaves in zip(true["q"], true["leaves"], strict=True)])
    return int(depth[min(len(depth) - 1, int(np.ceil(WANTED_RECALL * len(depth))))]) + 1 if len(depth) else 1


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k)


def _search_leaves(indexed: DataFrame, visiting: DataFrame, sizes: dict[int, int], k: int) -> DataFrame:
    """(query_id, vec_id, score): in each leaf the ``k`` best of each query of ``visiting`` (query_id, vector, bound, leaf) that
    reach its bound. ``sizes`` has the number of blocks of each leaf; the queries of a leaf are counted here."""
    wide = {r["leaf"]: -(-r["n"] // BLOCK) for r in visiting.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    both = [(leaf, n, wide[leaf]) for leaf, n in sizes.items() if leaf in wide] or [(-1, 1, 1)]
    blocks = F.broadcast(indexed.sparkSession.createDataFrame(both, "leaf long, n int, m int"))

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Each row in one of its own blocks, together with every block of the other side."""
        many = df.join(blocks, "leaf").withColumn("own", F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
        return many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("n", "m")

    left = dealt(indexed, "vec_id", "n", "m").withColumnsRenamed({"own": "i", "other": "j"})
    right = dealt(visiting, "query_id", "m", "n").withColumnsRenamed({"own": "j", "other": "i"})

    def nearest(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
        if len(held) and len(asked):
            ids, own = held["vec_id"].to_numpy(), asked["query_id"].to_numpy()
            scores = _exact(_stack(asked["vector"]), _stack(held["vector"]))
            reached = scores >= asked["bound"].to_numpy()[:, None]
            for q in np.flatnonzero(reached.any(axis=1)):
                at = np.flatnonzero(reached[q])
                best = at[_top(ids[at], scores[q, at], own[q], k)]
                out.append((np.full(len(best), own[q]), ids[best], scores[q, best]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))

    return left.groupBy("leaf", "i", "j").cogroup(right.groupBy("leaf", "i", "j")).applyInPandas(nearest, "query_id long, vec_id long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row of ``vectors`` (vec_id, embedding) for which
    ``is_query`` holds, among all other rows, by inner product."""
    spark = vectors.sparkSession
    rows = staged(usable(vectors), "vectors")
    sample = _least(rows, FIT_ROWS).select("vector").toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(_stack(sample["vector"]))

    def assign(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["leaf"] = tree.leaves(_stack(batch["vector"])) if len(batch) else []
            yield batch

    indexed = staged(rows.mapInPandas(assign, "vec_id long, vector array<double>, leaf long"), "indexed")
    queries = indexed.where(is_query)
    visits = calibrate(tree, indexed, queries, k)

    def visit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins = [tree.best_bins(np.asarray(v), visits) for v in batch["vector"]]
            yield pd.DataFrame({"query_id": batch["vec_id"], "vector": batch["vector"], "bins": bins})

    visiting = staged(queries.select("vec_id", "vector").mapInPandas(visit, "query_id long, vector array<double>, bins array<long>"), "visiting")
    # Blocks of a leaf by its number of rows: one small row per leaf, and the tree is bounded.
    sizes = {r["leaf"]: -(-r["n"] // BLOCK) for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    found, done = None, 0
    for end in [int(np.ceil(visits ** (i / ROUNDS))) for i in range(1, ROUNDS)] + [visits]:
        part = visiting.withColumn("leaf", F.explode(F.slice("bins", done + 1, end - done)))
        if found is None:
            part = part.withColumn("bound", F.lit(-np.inf))
        else:
            bounds = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
            part = part.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(-np.inf)))
        here = _search_leaves(indexed, part.select("query_id", "vector", "bound", "leaf"), sizes, k)
        found = staged(_ranked(found.drop("rank").unionByName(here) if found is not None else here, k), "near")
        done = end
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
