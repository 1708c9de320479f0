"""Operator 4: best-fit packing of token pieces into sequences, by bin completion with branch and bound.

Pieces of one length are interchangeable, so the search works on the number of pieces of each length, at most ``capacity``
numbers whatever the size of the corpus. It yields patterns (a multiset of lengths that shares a sequence) with the number of
sequences that use them; the pieces then find their place by their rank among those of their length. Ranks are counted
per bucket and length, so no length, however frequent, is numbered by one task.

Defined results: NULL text is an empty document, one piece that holds the end id; equal doc_ids are packed as
separate documents; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakestar.llm.common import staged, text_or_empty
from lakestar.llm.tokens import encoder

CAPACITY = 1024
# Rows of one length and bucket that one task numbers.
BUCKET_ROWS = 1_000_000
# Fillings looked at per sequence, fillings kept as branches, and nodes of the whole search.
LOOKED_AT, BRANCHES, NODES = 4_000, 6, 3_000

Filling = tuple[int, ...]
Pattern = tuple[Filling, int]


def fillings(room: int, counts: dict[int, int], lengths: list[int]) -> list[Filling]:
    """Undominated fillings of ``room``, least waste first and of equal waste the one with the larger pieces.

    A filling is dominated if one more piece fits, or if one of its pieces can give way to a longer one; either
    leaves the rest an easier problem. ``lengths`` are the lengths at hand, longest first.
    """
    found: list[Filling] = []
    looked = 0

    def extend(chosen: list[int], left: int, at: int) -> bool:
        """Depth first, longest pieces first; False once nothing better can come."""
        nonlocal looked
        looked += 1
        grew = False
        for i in range(at, len(lengths)):
            length = lengths[i]
            if length > left or chosen.count(length) >= counts[length]:
                continue
            grew = True
            if not extend([*chosen, length], left - length, i):
                return False
            if looked >= LOOKED_AT:
                return False
        if not grew and not _dominated(chosen, left):
            found.append(tuple(chosen))
            if left == 0 and len(found) >= BRANCHES:
                return False
        return True

    def _dominated(chosen: list[int], left: int) -> bool:
        if not left:
            return False
        for length in lengths:
            spare = counts[length] - chosen.count(length)
            if spare > 0 and (length <= left or any(0 < length - x <= left for x in chosen)):
                return True
        return False

    extend([], room, 0)
    found.sort(key=lambda f: (room - sum(f), [-x for x in f]))
    return found[:BRANCHES] or [_best_fit(room, counts, lengths)]


def _best_fit(room: int, counts: dict[int, int], lengths: list[int]) -> Filling:
    """Again and again the longest piece that still fits."""
    chosen: list[int] = []
    for length in lengths:
        take = min(room // length, counts[length])
        chosen += [length] * take
        room -= take * length
    return tuple(chosen)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that no packing can do without: by volume, and with each half-or-longer piece in one of its own."""
    best = 0
    for small in sorted({0, *(x for x in counts if 2 * x <= capacity)}):
        wide = sum(n for x, n in counts.items() if x > capacity - small)
        middle = [(x, n) for x, n in counts.items() if capacity - small >= x and 2 * x > capacity]
        rest = sum(x * n for x, n in counts.items() if 2 * x <= capacity and x >= small)
        room = sum((capacity - x) * n for x, n in middle)
        best = max(best, wide + sum(n for _, n in middle) + max(0, -(-(rest - room) // capacity)))
    return best


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns and how many sequences use each, so that all pieces of ``counts`` (length to number) are used.

    Each node takes the longest piece left and branches over the undominated fillings around it; a filling is used
    as often as the numbers allow. The first branch is always the best fit, so the first leaf is the best-fit packing,
    the incumbent; a node is pruned when its waste exceeds what a packing with one sequence less could waste. The search
    ends at the lower bound or after ``NODES`` nodes.
    """
    counts = {x: n for x, n in counts.items() if n > 0}
    if not counts:
        return []
    volume, bound = sum(x * n for x, n in counts.items()), lower_bound(counts, capacity)
    best: list[Pattern] = []
    fewest, nodes = None, 0
    # A node is the rest of the counts, the patterns so far, the sequences so far.
    open_nodes: list[tuple[dict[int, int], list[Pattern], int]] = [(counts, [], 0)]
    while open_nodes and (fewest is None or (fewest > bound and nodes < NODES)):
        rest, patterns, used = open_nodes.pop()
        nodes += 1
        if not rest:
            if fewest is None or used < fewest:
                best, fewest = patterns, used
            continue
        packed = volume - sum(x * n for x, n in rest.items())
        if fewest is not None and used * capacity - packed > (fewest - 1) * capacity - volume:
            continue
        lengths = sorted(rest, reverse=True)
        longest = lengths[0]
        left = {**rest, longest: rest[longest] - 1}
        branches = []
        for filling in fillings(capacity - longest, left, [x for x in lengths if left[x]]):
            pattern = (longest, *filling)
            times = min(rest[x] // pattern.count(x) for x in set(pattern))
            after = {x: n - times * pattern.count(x) for x, n in rest.items()}
            branches.append(({x: n for x, n in after.items() if n}, [*patterns, (pattern, times)], used + times))
        open_nodes += reversed(branches if len(open_nodes) < NODES else branches[:1])
    return best


def cut(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token pieces (doc_id, piece, start, length, ids_crc32, nth, and ids if asked for) of all documents.

    Only documents of more than ``capacity`` tokens are cut; the first piece takes what doesn't fill a whole one. ``nth`` is the
    row's number in its task, which tells apart rows that are equal in all else.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("nth", pa.int64())]
    out = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, nth = encoder(tokenizer), count()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), known.documents(batch.column(1)), strict=True):
                first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                ends = [first, *range(first + capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip([0, *ends], ends)):
                    part = ids[a:b]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(part.tobytes()), next(nth), *[part.tolist()] * with_ids))
            columns = zip(*rows, strict=True) if rows else [[]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, nth long" + ", ids array<long>" * with_ids
    return text_or_empty(documents).mapInArrow(pieces, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length from 1 to ``capacity``, and any other columns) with sequence_id and offset.

    ``pieces`` is read twice and must be a written table. Pieces of one length are numbered bucket by bucket; a column ``nth``
    spreads rows that share the rest, so that a repeated or missing doc_id fills no bucket alone.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places, base, taken = [], 0, dict.fromkeys(counts, 0)
    for pattern, times in complete_bins(counts, capacity):
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            places.append((length, taken[length], taken[length] + times * each, base, each, offset))
            taken[length] += times * each
            offset += each * length
        base += times
    # At most ``capacity`` patterns (each uses up a length) of few lengths each: small whatever the corpus.
    names = "_length long, _from long, _to long, _base long, _each long, _offset long"
    table = F.broadcast(spark.createDataFrame(places, names))

    total = sum(counts.values())
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ROWS))
    keys = [c for c in ("doc_id", "piece", "start", "ids_crc32", "nth") if c in pieces.columns]
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    before = (
        spread.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n"))
        .drop("_n")
    )
    place = Window.partitionBy("length", "_bucket").orderBy(*keys)
    ranked = (
        spread.withColumn("_place", F.row_number().over(place) - 1)
        .join(before, ["length", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.col("_place"))
    )
    found = ranked.join(
        table, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    )
    step = F.col("_rank") - F.col("_from")
    return found.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        (F.col("_base") + F.floor(step / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + step % F.col("_each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Cut all documents and pack the pieces."""
    return pack(staged(cut(documents, tokenizer, capacity, with_ids), "pieces"), capacity).drop("nth")
