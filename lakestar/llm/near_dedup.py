"""Operator 6: near-duplicate documents by an LSH forest of MinHash signatures, confirmed on whole shingle sets.

1. Every document becomes its set of distinct shingles, a 128-bit key of that set, and a MinHash signature. Documents with
   one key have equal sets; from here on one class stands for all of them, however many.
2. Each tree of the forest orders the classes by a part of their signature. In that order the predecessor is the class with
   the longest common prefix, so the depth that is compared adapts to how dense a region is. Predecessor and
   first class of the region (equal in ``DEPTH`` values) are the candidates; the likely ones by signature are confirmed on
   whole sets.
3. Where the classes of a region still lie in different components, the remaining pairs of the region are compared in blocks: by
   signature, and the likely ones on whole sets at once. A pair belongs to the first tree that has it in one region, and is passed over
   where links found so far connect it, so that a block returns fewer links than it has classes. No pair that shares a
   region in any tree is lost. A pair at the similarity bound shares no region
   with probability (1 - 0.8 ** 3) ** 32, about 1e-10.

Defined results: NULL and empty texts and texts without words have an empty set and are linked with nothing; repeated
rows are linked as copies; a NULL doc_id gets the component of its text; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakestar.llm.common import BASE, bytes_of, mix, shingle_hashes, staged, text_or_empty, word_hashes
from lakestar.llm.components import components

TREES, DEPTH = 32, 3
HASHES = TREES * DEPTH
# Signatures of sets at the bound agree in 77 of 96 places, with a deviation of 3.9; fewer than this has a chance of 1e-8.
LEAST_EQUAL = 54
# Classes of a region compared in one task, in the second pass.
BLOCK = 512

_rng = np.random.default_rng(6)
_FACTOR = (_rng.integers(0, 2**31, (HASHES, 1), dtype=np.uint32) * np.uint32(2)) + np.uint32(1)
_SHIFT = _rng.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)


def shingle_set(data: np.ndarray, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(data), words))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of each of the hash functions over the set."""
    x, out = (shingles >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(x), 2_048):
        np.minimum(out, (x[i : i + 2_048] * _FACTOR + _SHIFT).min(axis=1), out=out)
    return out


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def document_sets(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, cls, sig, content): cls and sig are NULL for an empty set; content is the MD5 of the text."""
    out = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.binary()), ("sig", pa.binary()), ("content", pa.binary())])

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, n, cls, sig = batch.column(1), [], [], []
            for i in range(len(text)):
                found = shingle_set(bytes_of(text, i), words)
                n.append(len(found))
                cls.append(_key(found) if len(found) else None)
                sig.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary()), batch.column(2)], schema=out)

    texts = text_or_empty(documents).withColumn("content", content_of(F.col("text")))
    return texts.mapInArrow(sets, "doc_id long, n_shingles long, cls binary, sig binary, content binary")


def content_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _region_ids(value: np.ndarray) -> np.ndarray:
    """Region of each signature (a column of ``value``) in each tree."""
    region = np.zeros((TREES, value.shape[1]), dtype=np.uint64) + np.arange(1, TREES + 1, dtype=np.uint64)[:, None]
    for i in range(DEPTH):
        region = mix(region * BASE + value[i::DEPTH])
    return region


def _entries(classes: DataFrame) -> DataFrame:
    """(region, deeper, cls): one row per class and tree. ``region`` stands for the tree and the first ``DEPTH`` values of
    the signature in that tree's order, ``deeper`` for the values after them."""

    def trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            value = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(len(batch), HASHES)
            value = value.T.astype(np.uint64)
            region = _region_ids(value)
            after = [np.roll(value[i::DEPTH], -1, axis=0) for i in range(2)]
            deeper = (after[0] << np.uint64(32)) | after[1]
            cls = batch.column(0).take(pa.array(np.tile(np.arange(len(batch)), TREES)))
            columns = [pa.array(region.ravel().view(np.int64)), pa.array(deeper.ravel().view(np.int64)), cls]
            yield pa.RecordBatch.from_arrays(columns, ["region", "deeper", "cls"])

    return classes.select("cls", "sig").mapInArrow(trees, "region long, deeper long, cls binary")


def _members(classes: DataFrame) -> DataFrame:
    """(region, deeper, cls, n): the classes of all regions that hold two or more."""
    shared = staged(_entries(classes).groupBy("region").agg(F.count("*").alias("n")).where("n > 1"), "regions")
    return staged(_entries(classes).join(shared, "region"), "members")


def _neighbours(members: DataFrame) -> DataFrame:
    """Candidates (a, b): each member with the one before it in the tree's order.

    The order is dealt by ranges, so a region of any size is spread; the first member of each task has no
    predecessor there, which the comparison with the region's first class and the second pass make up for.
    """

    def before(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, bytes] | None = None
        for batch in batches:
            if not len(batch):
                continue
            region, cls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if last:
                region, cls = [last[0], *region], [last[1], *cls]
            same = [i for i in range(1, len(region)) if region[i] == region[i - 1]]
            last = region[-1], cls[-1]
            yield pa.RecordBatch.from_arrays([pa.array([cls[i] for i in same], pa.binary()), pa.array([cls[i - 1] for i in same], pa.binary())], ["a", "b"])

    order = members.select("region", "cls", "deeper").repartitionByRange("region", "deeper").sortWithinPartitions("region", "deeper", "cls")
    return order.select("region", "cls").mapInArrow(before, "a binary, b binary")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _whole_sets(documents: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(cls, items): sets of the documents with these ids, made again from their texts; each class once."""
    # A class of documents without id is found by a NULL id.
    wanted = staged(ids.distinct(), "wanted")
    texts = text_or_empty(documents).alias("d").join(wanted.alias("w"), F.expr("d.doc_id <=> w.doc_id"), "left_semi")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(bytes_of(batch.column(1), i), words) for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([pa.array([_key(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], ["cls", "items"])

    return staged(texts.mapInArrow(sets, "cls binary, items binary").dropDuplicates(["cls"]), "sets")


def _confirmed(pairs: DataFrame, classes: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of classes whose whole sets reach the bound. Sets are made again from the texts of the classes in
    question only; their documents are found by id."""
    sized = classes.select("cls", "n_shingles", "doc_id", "sig")
    size = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    described = (
        pairs.join(sized.select(F.col("cls").alias("a"), F.col("n_shingles").alias("n_a"), F.col("doc_id").alias("doc_a"), F.col("sig").alias("sig_a")), "a")
        .join(sized.select(F.col("cls").alias("b"), F.col("n_shingles").alias("n_b"), F.col("doc_id").alias("doc_b"), F.col("sig").alias("sig_b")), "b")
        .where(size)
        .select("a", "b", "doc_a", "doc_b", "sig_a", "sig_b")
    )

    def likely(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint32).reshape(-1, HASHES) for c in batch.columns[4:])
            yield batch.filter(pa.array((x == y).sum(axis=1) >= LEAST_EQUAL)).select(["a", "b", "doc_a", "doc_b"])

    # Most candidates are told apart by their signatures; whole sets are fetched for the others alone.
    pairs = staged(described.mapInArrow(likely, "a binary, b binary, doc_a long, doc_b long"), "pairs")
    whole = _whole_sets(documents, pairs.select(F.col("doc_a").alias("doc_id")).union(pairs.select("doc_b")), words)

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select(["a", "b"])

    full = (
        pairs.select("a", "b")
        .join(whole.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a")
        .join(whole.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    return staged(full.mapInArrow(confirm, "a binary, b binary"), "confirmed")


def _rest(members: DataFrame, roots: DataFrame, classes: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) among the members of a region that lie in different components.

    Regions of one component, or of two members, have nothing left. The rest are cut into blocks of about ``BLOCK``
    classes, and every two blocks of a region meet in one task.
    """
    known = members.where("n > 2").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = known.groupBy("region").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("region")
    known = staged(known.join(staged(mixed, "mixed"), "region").select("region", "cls", "n", "root"), "rest")
    described = classes.join(known.select("cls").distinct(), "cls", "left_semi")
    whole = _whole_sets(documents, described.select("doc_id"), words)
    described = staged(described.select("cls", "sig").join(whole, "cls"), "described")
    rows = (
        known.join(described, "cls")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("region", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "root", "sig", "items")
    )

    def links(group: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(group["sig"]), dtype=np.uint32).reshape(len(group), HASHES)
        values = sig.reshape(len(group), TREES, DEPTH)
        tree = int(np.flatnonzero(_region_ids(sig[:1].T.astype(np.uint64))[:, 0].view(np.int64) == group["region"].iloc[0])[0])
        cls, own = group["cls"].to_numpy(), group["own"].to_numpy()
        items = [np.frombuffer(x, dtype=np.uint64) for x in group["items"]]
        n = np.array([len(x) for x in items])
        label = pd.factorize(group["root"])[0]
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        a, b = [], []
        for x in np.flatnonzero(own == i):
            others = np.flatnonzero(own == j)
            others = others[(others > x) | (i != j)]
            others = others[label[others] != label[x]]
            others = others[100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x])]
            agree = (sig[others] == sig[x]).sum(axis=1)
            others, agree = others[agree >= LEAST_EQUAL], agree[agree >= LEAST_EQUAL]
            # Pairs that an earlier tree has in one region are looked at there.
            earlier = (values[others, :tree] == values[x, :tree]).all(axis=2).any(axis=1)
            others = others[~earlier][np.argsort(-agree[~earlier], kind="stable")]
            for y in others:
                if label[x] == label[y]:
                    continue
                both = len(np.intersect1d(items[x], items[y], assume_unique=True))
                if 100 * both >= percent * (n[x] + n[y] - both):
                    a.append(cls[x])
                    b.append(cls[y])
                    label[label == label[y]] = label[x]
        return pd.DataFrame({"a": a, "b": b})

    return staged(rows.groupBy("region", "i", "j").applyInPandas(links, "a binary, b binary"), "links")


def _labelled(documents: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows, and (cls, root): the component of each class."""
    docs = staged(document_sets(documents, words), "sets")
    there = docs.where("cls is not null")
    classes = staged(there.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "classes")
    members = _members(classes)
    first = members.groupBy("region").agg(F.min("cls").alias("b"))
    starts = members.join(first, "region").select(F.col("cls").alias("a"), "b")
    links = _confirmed(_ordered(starts.union(_neighbours(members))), classes, documents, words, percent)
    roots = staged(components(links), "roots")
    links = links.union(_rest(members, roots, classes, documents, words, percent))
    roots = staged(components(links), "roots")
    return docs, classes.select("cls", "doc_id").join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: documents whose sets of ``words``-word shingles share at least
    ``percent`` of their union are linked; component_id is the least doc_id that links reach."""
    docs, labelled = _labelled(documents, words, percent)
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    label = staged(labelled.select("cls", "root").join(least, "root").select("cls", "component_id"), "labels")
    return docs.join(label, "cls", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``documents`` for each group, with all columns: that with the least doc_id (NULL last) and of its texts the
    one with the least MD5; of rows that repeat a doc_id and text one stays. Rows go by id and text, so other texts under the
    same id stay. Documents without words are kept as they are."""
    docs, labelled = _labelled(documents, words, percent)
    label = staged(labelled.select("cls", "root"), "labels")
    order = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "content")
    rows = staged(docs.where("cls is not null").join(label, "cls").select("root", order.alias("row")).distinct(), "rows")
    kept = staged(rows.groupBy("root").agg(F.min("row").alias("kept")), "kept")
    gone = rows.join(kept, "root").where(~F.col("row").eqNullSafe(F.col("kept")))
    gone = staged(gone.select(F.col("row.doc_id").alias("_gone_id"), F.col("row.content").alias("_gone")), "gone")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_gone_id")) & (content_of(F.col("text")) == F.col("_gone"))
    return documents.join(gone, same, "left_anti").dropDuplicates(["doc_id", "text"])
