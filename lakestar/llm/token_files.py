"""Operator 1: token ids as files, each document compressed on its own with one shared zstandard dictionary.

Layout below ``path``: ``dictionary/`` holds one row (hash, bytes); ``blocks/`` holds one row per block of documents, in
ascending doc_id order:

* part, block: place of the block; ``before``: ids of all documents before it in its part
* first_id, last_id: smallest and largest doc_id, so that a reader skips other blocks by the files' own statistics
* dictionary: hash of the dictionary that every frame of the block needs ("" for none)
* doc_ids, ends, counts: the offset index: id, end of its frame in ``frames``, number of ids, for each document
* frames: the documents' frames, one behind the other

A frame is the document's ids, little-endian, two bytes each if the vocabulary allows and four otherwise, with the end
id last. The container is Parquet, so the files are written by Spark's commit protocol to any store and a lost executor
leaves no half-written part.

Defined results: NULL text is an empty document (its end id alone); equal doc_ids are ordered by text; a NULL doc_id
comes first; an empty table gives no blocks and no rows; no column but doc_id and text is read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestar.llm.common import text_or_empty
from lakestar.llm.tokens import encoder

# The dictionary is trained on at most so many documents, those with the least hashes, of at most so many characters.
SAMPLE_DOCS, SAMPLE_CHARS = 1_000, 20_000
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
# A block is closed at so many frame bytes or documents.
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 4_096

BLOCKS = (
    "part int, block int, first_id long, last_id long, before long, n_tokens long, dictionary string, width int, "
    "doc_ids array<long>, ends array<int>, counts array<int>, frames binary"
)


def _width(path: str) -> int:
    return 2 if encoder(path).vocabulary_size() <= 1 << 16 else 4


def train_dictionary(documents: DataFrame, tokenizer: str) -> bytes:
    """Dictionary for id arrays, trained on a bounded sample; empty if there is too little to train on."""
    docs = text_or_empty(documents)
    rank = F.xxhash64("doc_id")
    # The ranks alone are sorted; texts are fetched for the least of them.
    least = [r["rank"] for r in docs.select(rank.alias("rank")).orderBy("rank").limit(SAMPLE_DOCS).collect()]
    sample = docs.where((rank <= max(least, default=0)) & F.length("text").between(1, SAMPLE_CHARS)).limit(SAMPLE_DOCS).select("text").collect()
    kind = f"<u{_width(tokenizer)}"
    texts = pa.array([x.text for x in sample], pa.string())
    frames = [x.astype(kind).tobytes() for x in encoder(tokenizer).documents(texts)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, frames).as_bytes()
    except zstandard.ZstdError:  # raised for samples that are too few or too small
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_tokens(documents: DataFrame, path: str, tokenizer: str) -> None:
    """Encode all documents and write them in ascending doc_id order."""
    spark = documents.sparkSession
    data = train_dictionary(documents, tokenizer)
    name = hashlib.sha256(data).hexdigest() if data else ""
    spark.createDataFrame([(name, data)], "hash string, bytes binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, width = encoder(tokenizer), _width(tokenizer)
        shared = _dictionary(data)
        pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **({"dict_data": shared} if shared else {}))
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            there = [i for i in ids if i is not None]
            row = (part, block, min(there, default=None), max(there, default=None), before, sum(counts), name, width)
            ends = np.cumsum([len(f) for f in frames], dtype=np.int32)
            values = [[x] for x in (*row, ids, ends.tolist(), counts, b"".join(frames))]
            return pa.RecordBatch.from_pydict(dict(zip(_BLOCK_TYPES.names, values, strict=True)), schema=_BLOCK_TYPES)

        for batch in batches:
            for doc_id, tokens in zip(batch.column(0).to_pylist(), known.documents(batch.column(1)), strict=True):
                frame = pack.compress(tokens.astype(f"<u{width}").tobytes())
                if ids and (held + len(frame) > BLOCK_BYTES or len(ids) >= BLOCK_DOCS):
                    yield close()
                    before, block, held, ids, frames, counts = before + sum(counts), block + 1, 0, [], [], []
                ids.append(doc_id)
                frames.append(frame)
                counts.append(len(tokens))
                held += len(frame)
        if ids:
            yield close()

    docs = text_or_empty(documents)
    # The hash of the text only breaks ties: a doc_id that many rows share is then split as well.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    sorted_docs = docs.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    sorted_docs.mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


_BLOCK_TYPES = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("before", pa.int64()),
        ("n_tokens", pa.int64()), ("dictionary", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("frames", pa.binary()),
    ]
)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks")


def read_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return row["hash"], bytes(row["bytes"])


def decode(spark: SparkSession, path: str, blocks: DataFrame, digest: bool = False, ids: set[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) of the documents in ``blocks``; ``digest`` gives ids_crc32 instead of tokens.

    ``start`` counts the ids of all documents before. With ``ids`` only frames of those documents are opened.
    """
    name, data = read_dictionary(spark, path)
    # One number per part of the sort, that is per writing task.
    sums = {r["part"]: r["n"] for r in read_blocks(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    starts, total = {}, 0
    for part in sorted(sums):
        starts[part], total = total, total + sums[part]
    last = ("ids_crc32", pa.int64()) if digest else ("tokens", pa.list_(pa.int64()))
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = _dictionary(data)
        unpack = zstandard.ZstdDecompressor(**({"dict_data": shared} if shared else {}))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError(f"block {row['part']}/{row['block']} needs dictionary {row['dictionary']}, not {name}")
                at, begin, found = starts[row["part"]] + row["before"], 0, []
                for doc_id, end, count in zip(row["doc_ids"], row["ends"], row["counts"], strict=True):
                    if ids is None or doc_id in ids:
                        raw = np.frombuffer(unpack.decompress(row["frames"][begin:end]), dtype=f"<u{row['width']}")
                        if len(raw) != count:
                            raise ValueError(f"document {doc_id} has {len(raw)} ids, its index says {count}")
                        found.append((doc_id, at, count, zlib.crc32(raw.astype("<u4").tobytes()) if digest else raw.tolist()))
                    at, begin = at + count, end
                columns = zip(*found, strict=True) if found else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    kind = "ids_crc32 long" if digest else "tokens array<long>"
    return blocks.mapInArrow(documents, f"doc_id long, start long, n_tokens long, {kind}")


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """All documents of the files."""
    return decode(spark, path, read_blocks(spark, path), digest)


def read_documents(spark: SparkSession, path: str, ids: Iterable[int]) -> DataFrame:
    """A few documents by id: opens only the blocks whose range holds one of them, and only their frames."""
    wanted = sorted(set(ids))
    hit = F.lit(False)
    for i in wanted:
        hit = hit | F.lit(i).between(F.col("first_id"), F.col("last_id"))
    return decode(spark, path, read_blocks(spark, path).where(hit), ids=set(wanted))
