"""Operator 9: removal of long byte strings that occur more than once, by sorting suffix buckets with a cover sample.

A full suffix array holds at least eight bytes for each byte of text. Here, as in difference-cover construction, only a sample
of the suffixes is ranked globally, and the rest follow from the sample, one bucket of suffixes at a time:

* Cover sample. Two equal strings of ``LENGTH`` bytes must hold a sampled suffix at the same offset, the property of a difference
  cover. The cover is content-defined: the sample of a string is the place in it whose next ``GRAM`` bytes have the least
  hash. It takes one position in 170, where an arithmetic cover with this reach takes one in 13.
* Buckets. The rank of a sampled suffix is the hash of its first bytes; a bucket is all suffixes that have a sample of one rank.
  Suffixes that follow each other and share a sample form a run. A bucket with one run holds no repeats and is done.
* Long ties. Runs that are equal as a whole (from the first byte of the first suffix to the last byte of the last) have equal
  ranks of that whole, so that none of their suffixes has to be compared.
* A bucket's differing runs, one of each kind, are split into blocks of ``PART`` suffixes, which fall into smaller buckets by the
  bytes that all their suffixes share. Only what differs there as well is ranked suffix by suffix.

All ranks are counted by partial aggregation; no bucket is gathered in a task, however many suffixes it has.

Defined results: NULL is an empty text; texts under ``LENGTH`` bytes lose nothing; copies of a document, and repeated rows,
remove each other, so all of their bytes go; overlapping repeats inside one text count; a NULL doc_id is allowed; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestar.llm.common import bytes_of, mix, prefix_hash, range_hash, release, staged, text_or_empty

LENGTH, GRAM = 400, 64
# Suffixes of one text that are looked at together; longer texts take several steps.
STEP = 1 << 20
# Suffixes of a block.
PART = 16


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row, by running minima within blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of the suffixes of a text: first and last start, their sample, its rank, rank of the whole run."""
    for at in range(0, len(data) - length + 1, STEP):
        # A step has the runs that start in it, as a whole: it sees one suffix before them and the longest run beyond them.
        before = min(at, 1)
        part = data[at - before : at + STEP + 2 * length]
        prefix = prefix_hash(part)
        place = np.arange(len(part) - gram + 1)
        rank = range_hash(prefix, place, place + gram)
        # Of equal hashes the leftmost is the sample: the low half of the sort key is the place.
        least = least_in_window((rank & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64), length - gram + 1)
        sample = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(sample, prepend=-1))
        last = np.append(first[1:] - 1, len(sample) - 1)
        own = (first >= before) & (first < before + STEP)
        first, last = first[own], last[own]
        # The offset of the sample belongs to the whole: equal bytes around another sample are another run.
        whole = range_hash(prefix, first, last + length) + (sample[first] - first).astype(np.uint64)
        offset = at - before
        yield first + offset, last + offset, sample[first] + offset, rank[sample[first]], whole


def _texts(documents: DataFrame) -> DataFrame:
    """(doc_id, content, text): ``content`` is the MD5 of the text and stands for all of its copies."""
    docs = text_or_empty(documents)
    return docs.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("content"), "text")


# A piece is a range of suffix starts in a text. Pieces of one bucket whose wholes are equal hold the same strings. ``lone`` pieces
# are yet to be judged, the others only stand for strings that are known to repeat.
_NAMES = ("content", "first", "last", "sample", "bucket", "whole", "lone")
_TYPES = pa.schema(list(zip(_NAMES, (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()), strict=True)))
_PIECES = "content binary, first int, last int, sample int, bucket long, whole long, lone boolean"


def _batch(content: pa.Array, rows: np.ndarray, first, last, sample, bucket, whole, lone) -> pa.RecordBatch:  # noqa: ANN001
    whole, bucket = whole.view(np.int64), bucket.view(np.int64)
    places = [pa.array(x.astype(np.int32)) for x in (first, last, sample)]
    return pa.RecordBatch.from_arrays([content.take(pa.array(rows)), *places, pa.array(bucket), pa.array(whole), pa.array(lone)], schema=_TYPES)


def _runs(texts: DataFrame) -> DataFrame:
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = [], []
            for i in range(len(batch)):
                for part in runs(bytes_of(batch.column(1), i)):
                    row.append(np.full(len(part[0]), i))
                    found.append(part)
            if found:
                rows = np.concatenate(row)
                yield _batch(batch.column(0), rows, *(np.concatenate(c) for c in zip(*found, strict=True)), np.full(len(rows), True))

    return texts.where(F.octet_length("text") >= LENGTH).select("content", "text").mapInArrow(find, _PIECES)


def _split(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges (content, first, last) that repeat as a whole, and one piece of each kind from buckets of several kinds."""
    buckets = pieces.groupBy("bucket").agg(F.count("*").alias("n"), F.min("whole").alias("w1"), F.max("whole").alias("w2"))
    buckets = staged(buckets.where("n > 1").select("bucket", (F.col("w1") != F.col("w2")).alias("mixed")), "buckets")
    shared = staged(pieces.join(buckets, "bucket"), "shared")
    release(buckets, pieces)
    mixed = shared.where("mixed")
    kinds = mixed.groupBy("bucket", "whole").agg(F.count("*").alias("n"), F.min(F.struct("content", "first", "last", "sample", "lone")).alias("r"))
    kinds = staged(kinds.select("r.content", "r.first", "r.last", "r.sample", "bucket", "whole", (F.col("r.lone") & (F.col("n") == 1)).alias("lone"), (F.col("n") > 1).alias("tied")), "kinds")
    ties = mixed.where("lone").join(kinds.where("tied").select("bucket", "whole"), ["bucket", "whole"], "left_semi")
    repeated = staged(shared.where("not mixed and lone").select("content", "first", "last").union(ties.select("content", "first", "last")).distinct(), "repeated")
    release(shared)
    return repeated, kinds.drop("tied")


def _one_of_each(texts: DataFrame, pieces: DataFrame) -> DataFrame:
    """(content, text) of the texts that have pieces; of copies only one."""
    keys = pieces.select(F.col("content").alias("key")).distinct()
    # Copies are told apart by id, so that many copies of a text don't meet in one task.
    least = texts.groupBy("content").agg(F.min("doc_id").alias("least"))
    keys = staged(least.join(keys, F.col("content") == F.col("key"), "left_semi").withColumnRenamed("content", "key"), "keys")
    one = texts.join(keys, (F.col("content") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
    return staged(one.groupBy("content").agg(F.first("text").alias("text")), "needed")


def _with_pieces(texts: DataFrame, pieces: DataFrame) -> DataFrame:
    """(content, text, pieces) for each text that has pieces."""
    held = pieces.groupBy(F.col("content").alias("key")).agg(F.collect_list(F.struct("first", "last", "sample", "bucket", "lone")).alias("pieces"))
    return texts.join(held, F.col("content") == F.col("key")).select("content", "text", "pieces")


def _columns(row: pa.StructScalar) -> list[np.ndarray]:
    values = row.values
    return [values.field(c).to_numpy(zero_copy_only=False) for c in ("first", "last", "sample", "bucket", "lone")]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts n0, n1, ..: each index as often as it counts, and the number within it."""
    index = np.repeat(np.arange(len(counts)), counts)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)


def _blocks(held: DataFrame) -> DataFrame:
    """The pieces cut into blocks by distance to their sample; a block's bucket is the bytes that all its suffixes share."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                data = bytes_of(batch.column(1), i)
                first, last, sample, bucket, lone = _columns(batch.column(2)[i])
                low, high = (sample - last) // PART, (sample - first) // PART
                run, k = _spread(high - low + 1)
                block, at, prefix = low[run] + k, sample[run].astype(np.int64), prefix_hash(data)
                near, far = at - PART * block, at - PART * block - PART + 1
                start, end = np.maximum(far, 0), np.minimum(near + LENGTH, len(data))
                core = range_hash(prefix, near, far + LENGTH)
                whole = mix(range_hash(prefix, start, end) + (at - start).astype(np.uint64))
                inner = mix(core + mix(bucket[run].view(np.uint64) + block.astype(np.uint64)))
                begin, stop = np.maximum(first[run], far), np.minimum(last[run], near)
                yield _batch(batch.column(0), np.full(len(run), i), begin, stop, at, inner, whole, lone[run])

    return held.mapInArrow(cut, _PIECES)


def _suffixes(held: DataFrame) -> DataFrame:
    """The pieces' suffixes one by one, each with the rank of its ``LENGTH`` bytes as its whole."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                first, last, sample, bucket, lone = _columns(batch.column(2)[i])
                run, k = _spread(last - first + 1)
                start, prefix = first[run].astype(np.int64) + k, prefix_hash(bytes_of(batch.column(1), i))
                rank = range_hash(prefix, start, start + LENGTH)
                yield _batch(batch.column(0), np.full(len(run), i), start, start, sample[run], bucket[run], rank, lone[run])

    return held.mapInArrow(cut, _PIECES)


def repeated_starts(documents: DataFrame) -> DataFrame:
    """(content, first, last): ranges of starts of ``LENGTH``-byte strings that also start elsewhere, for each different
    text (``content`` is its MD5)."""
    texts = _texts(documents)
    runs_equal, kinds = _split(staged(_runs(texts), "runs"))
    needed = _one_of_each(texts, kinds)
    blocks_equal, kinds = _split(staged(_blocks(_with_pieces(needed, kinds)), "blocks"))
    suffixes = staged(_suffixes(_with_pieces(needed, kinds)), "suffixes")
    release(needed)
    twice = suffixes.groupBy("bucket", "whole").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    single = suffixes.where("lone").join(staged(twice, "twice"), ["bucket", "whole"], "left_semi").select("content", "first", "last")
    return runs_equal.union(blocks_equal).union(single).distinct()


def remove_repeats(documents: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept_bytes if asked for) for every row."""
    starts = repeated_starts(documents)
    per_text = staged(starts.groupBy(F.col("content").alias("key")).agg(F.collect_list(F.struct("first", "last")).alias("starts")), "starts")
    joined = _texts(documents).join(per_text, F.col("content") == F.col("key"), "left").select("doc_id", "text", "starts")
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    out = pa.schema(fields + [("kept_bytes", pa.binary())] * with_text)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                data = bytes_of(batch.column(1), i)
                removed = spans = 0
                kept = data
                ranges = batch.column(2)[i]
                if ranges.is_valid:
                    edges = np.zeros(len(data) + 1, dtype=np.int32)
                    values = ranges.values
                    np.add.at(edges, values.field("first").to_numpy(), 1)
                    np.add.at(edges, values.field("last").to_numpy() + LENGTH, -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    kept, removed = data[~gone], int(gone.sum())
                    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
                left = kept.tobytes()
                rows.append((doc_id, len(data), removed, spans, hashlib.sha256(left).hexdigest(), *[left] * with_text))
            columns = zip(*rows, strict=True) if rows else [[]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text
    return joined.mapInArrow(cut, schema)
