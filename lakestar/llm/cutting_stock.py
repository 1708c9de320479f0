"""Operator 13: packing by cutting stock: column generation on the histogram of lengths.

Only the number of pieces of each length enters the search, at most ``capacity`` numbers whatever the size of the corpus. Its
linear program has a column for each pattern (a multiset of lengths that share a sequence) and asks for the fewest
sequences that use up all pieces. It starts from patterns that each use up one length, and new columns come from a
knapsack whose values are the dual prices; it ends when the solution meets a bound that these prices give, or that of the
pieces' volume.

The numbers of uses are rounded down. What that leaves over is put into full sequences as far as it goes. Pieces left then,
and those of patterns that don't fill a sequence, are laid end to end and cut at every ``capacity`` ids, so that each such
sequence costs one cut document and no padding; the end of that line is cut into powers of two, which need none either.
Pieces find their place by their rank among those of their length.

Defined results: NULL text is an empty document, one piece that holds the end id; documents of more than ``capacity`` ids are
cut into whole sequences and one shorter piece, the last; equal doc_ids and repeated rows are documents of their own; an
empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakestar.llm.common import staged, text_or_empty
from lakestar.llm.tokens import encoder
from lakestar.operators.joins import broadcast_if_small

CAPACITY, END_ID = 1024, 0
# Rows of one length and bucket that one task numbers.
BUCKET_ROWS = 1_000_000
# The program counts as solved once its solution is within this share of a bound that the dual prices give. A packing is whole
# in any case; what the program leaves only adds cuts on the line.
GAP = 5e-4
# Columns that enter per round of prices and in all per length of the histogram, and columns between fresh inverses.
COLUMNS, PIVOTS_PER_LENGTH, REFRESH = 16, 3, 128
_EPS = 1e-9

Pattern = tuple[int, ...]


def _fill(room: int, lengths: np.ndarray, spare: dict[int, float]) -> Pattern:
    """Lengths for a room, longest first: where one or two of them fill what is left, those, else the longest that fits."""
    chosen: list[int] = []
    taken: dict[int, int] = {}

    def there(x: int) -> bool:
        return x > 0 and spare.get(x, 0) >= taken.get(x, 0) + 1

    while room > 0:
        picked: tuple[int, ...] = ()
        if there(room):
            picked = (room,)
        else:
            fits = lengths[lengths <= room]
            for x in fits.tolist():
                if there(x) and there(room - x) and (x != room - x or spare[x] >= taken.get(x, 0) + 2):
                    picked = (x, room - x)
                    break
            else:
                picked = next(((x,) for x in fits.tolist() if there(x)), ())
        if not picked:
            break
        for x in picked:
            taken[x] = taken.get(x, 0) + 1
            room -= x
        chosen += picked
    return tuple(sorted(chosen, reverse=True))


def _start(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """A pattern for each length, so that some multiples of them use up all pieces: each pattern is used until one of its
    lengths runs out, which the later ones then do without."""
    rest, patterns = {x: float(n) for x, n in counts.items()}, []
    while rest:
        lengths = np.array(sorted(rest, reverse=True))
        longest = int(lengths[0])
        endless = dict.fromkeys(rest, np.inf)
        pattern = (longest, *_fill(capacity - longest, lengths, endless))
        use = {x: pattern.count(x) for x in set(pattern)}
        times = min(rest[x] / k for x, k in use.items())
        out = [x for x, k in use.items() if rest[x] - times * k <= _EPS * counts[x]]
        for x, k in use.items():
            rest[x] -= times * k
        for i, x in enumerate(out):
            # Lengths that run out together get patterns of their own, used zero times.
            patterns.append(pattern if i == 0 else (x,) * (capacity // x))
            del rest[x]
    return patterns


class _Knapsack:
    """Best value of lengths in every room up to the capacity, each length as often as it fits."""

    def __init__(self, lengths: np.ndarray, capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity

    def patterns(self, prices: np.ndarray) -> tuple[list[Pattern], float]:
        """For each length the pattern of the highest value that holds it, if that is more than 1, best first; and the
        highest value."""
        worth = prices > _EPS
        lengths, prices = self.lengths[worth], prices[worth]
        if not len(lengths):
            return [], 0.0
        order = np.argsort(lengths)
        lengths, prices = lengths[order], prices[order]
        best, pick = np.zeros(self.capacity + 1), np.full(self.capacity + 1, -1)
        fit = np.searchsorted(lengths, np.arange(self.capacity + 1), side="right")
        for room in range(int(lengths[0]), self.capacity + 1):
            values = best[room - lengths[: fit[room]]] + prices[: fit[room]]
            i = int(values.argmax())
            # A room no better used than the one below takes its filling.
            if values[i] > best[room - 1] + _EPS:
                best[room], pick[room] = values[i], i
            else:
                best[room] = best[room - 1]
        found = []
        total = prices + best[self.capacity - lengths]
        for i in np.argsort(-total):
            if total[i] <= 1 + 1e-7:
                break
            chosen, room = [int(lengths[i])], int(self.capacity - lengths[i])
            while room > 0:
                if pick[room] < 0:
                    room -= 1
                else:
                    chosen.append(int(lengths[pick[room]]))
                    room -= chosen[-1]
            found.append(tuple(sorted(chosen, reverse=True)))
            if len(found) == COLUMNS:
                break
        return list(dict.fromkeys(found)), float(total.max())


def solve(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, float]]:
    """Patterns and how often each is used, in fractions, so that the fewest sequences use up all pieces."""
    lengths = np.array(sorted(counts))
    at = {int(x): i for i, x in enumerate(lengths)}
    wanted = np.array([counts[int(x)] for x in lengths], dtype=float)
    volume = float((wanted * lengths).sum()) / capacity

    def column(pattern: Pattern) -> np.ndarray:
        return np.bincount([at[x] for x in pattern], minlength=len(lengths)).astype(float)

    patterns = _start(counts, capacity)
    matrix = np.stack([column(p) for p in patterns], axis=1)
    inverse = np.linalg.inv(matrix)
    # Tiny unequal extras keep equal ratios apart, so that no step goes in a circle.
    nudged = wanted + 1e-6 * np.random.default_rng(1).random(len(lengths))
    uses, best = np.maximum(inverse @ nudged, 0), (list(patterns), np.maximum(inverse @ wanted, 0))
    knapsack, pivots, made_anew = _Knapsack(lengths, capacity), 0, 0
    while pivots < PIVOTS_PER_LENGTH * len(lengths):
        prices = inverse.sum(axis=0)
        found, most = knapsack.patterns(prices)
        # Prices divided by the value of the best pattern are a bound that no program's solution is below.
        bound = max(volume, uses.sum() / max(most, 1.0))
        if uses.sum() <= bound * (1 + GAP) or not found:
            break
        for pattern in found:
            new = column(pattern)
            gain = prices @ new - 1
            step = inverse @ new
            usable = step > 1e-6
            if gain <= 1e-7 or not usable.any():
                continue
            ratios = np.where(usable, uses / np.where(usable, step, 1), np.inf)
            out = int(ratios.argmin())
            inverse[out] /= step[out]
            prices = prices - gain * inverse[out]
            step[out] = 0
            inverse -= np.outer(step, inverse[out])
            uses = np.maximum(uses - step * ratios[out], 0)
            uses[out] = ratios[out]
            patterns[out], matrix[:, out] = pattern, new
            pivots += 1
        if pivots - made_anew >= REFRESH:
            # Before rounding errors add up the inverse is made anew, and what it gives is kept if it uses all pieces.
            try:
                inverse, made_anew = np.linalg.inv(matrix), pivots
            except np.linalg.LinAlgError:
                break
            uses = np.maximum(inverse @ nudged, 0)
            best = _better(best, patterns, matrix, inverse @ wanted, wanted)
    try:
        best = _better(best, patterns, matrix, np.linalg.inv(matrix) @ wanted, wanted)
    except np.linalg.LinAlgError:
        pass
    return list(zip(best[0], best[1].tolist(), strict=True))


def _better(
    best: tuple[list[Pattern], np.ndarray], patterns: list[Pattern], matrix: np.ndarray, uses: np.ndarray, wanted: np.ndarray
) -> tuple[list[Pattern], np.ndarray]:
    """The later solution if it uses all pieces and takes no more sequences."""
    uses = np.maximum(uses, 0)
    whole = np.allclose(matrix @ uses, wanted, rtol=1e-6, atol=1e-3)
    return (list(patterns), uses) if whole and uses.sum() <= best[1].sum() else best


@dataclass(frozen=True)
class Plan:
    """Patterns that fill their sequences with their uses; the pieces of each length laid end to end come after them."""

    full: list[tuple[Pattern, int]]
    line: dict[int, int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Round the program's solution for ``counts`` (length to number of pieces)."""
    rest = {x: n for x, n in counts.items() if n > 0}
    full: list[tuple[Pattern, int]] = []

    def use(pattern: Pattern, times: int) -> None:
        times = min([times, *(rest.get(x, 0) // pattern.count(x) for x in set(pattern))])
        if times > 0 and sum(pattern) == capacity:
            full.append((pattern, times))
            for x in set(pattern):
                rest[x] -= times * pattern.count(x)

    if rest:
        for pattern, times in solve(rest, capacity):
            use(pattern, int(times + 1e-6))
    line: dict[int, int] = {}
    rest = {x: n for x, n in rest.items() if n}
    while rest:
        longest = max(rest)
        spare = {**rest, longest: rest[longest] - 1}
        pattern = (longest, *_fill(capacity - longest, np.array(sorted(rest, reverse=True)), spare))
        if sum(pattern) == capacity:
            use(pattern, max(rest.values()))
        else:
            # Nothing fills the room beside this length: all of it goes on the line.
            line[longest] = rest[longest]
            rest[longest] = 0
        rest = {x: n for x, n in rest.items() if n}
    return Plan(full, line)


def _pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(row, doc_id, doc_tokens, start, length, ids_crc32, ids): documents in pieces of ``capacity`` ids, the last one shorter."""
    names = ["row", "doc_id", "doc_tokens", "start", "length", "ids_crc32"]
    out = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.binary())])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        for batch in batches:
            found = []
            for row, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), known.documents(batch.column(2), end_id), strict=True):
                for a in range(0, len(ids), capacity):
                    data = ids[a : a + capacity].tobytes()
                    found.append((row, doc_id, len(ids), a, len(data) // 4, zlib.crc32(data), data))
            columns = zip(*found, strict=True) if found else [[]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    rows = text_or_empty(documents).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(encode, ", ".join(f"{n} long" for n in names) + ", ids binary")


def _ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Number the pieces of each length from 0, over as many tasks as it takes."""
    buckets = max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ROWS))
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64("row", "start"), F.lit(buckets)).cast("int"))
    sizes = spread.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select("length", "_bucket", (F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("row", "start")) - 1
    ranked = spread.withColumn("_place", place).join(before, ["length", "_bucket"])
    return ranked.withColumn("_rank", F.col("_before") + F.col("_place")).drop("_bucket", "_place", "_before")


def _in_full(ranked: DataFrame, found: Plan) -> tuple[DataFrame, int]:
    """Pieces of patterns with sequence_id and offset, and the number of sequences."""
    places, base, taken = [], 0, {}
    for pattern, times in found.full:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each, start = pattern.count(length), taken.get(length, 0)
            places.append((length, start, start + times * each, base, each, offset))
            taken[length] = start + times * each
            offset += each * length
        base += times
    # At most a few thousand patterns (one per length, and those of the rest) of 44 different lengths each at 1,024 ids.
    names = "_length long, _from long, _to long, _base long, _each long, _offset long"
    table = F.broadcast(ranked.sparkSession.createDataFrame(places, names))
    met = ranked.join(table, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    step = F.col("_rank") - F.col("_from")
    return met.select(
        "row", "doc_id", "doc_tokens", "start", "length", "ids_crc32", F.col("start").alias("piece"),
        (F.col("_base") + F.floor(step / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + step % F.col("_each") * F.col("length")).cast("long").alias("offset"),
    ), base


def _on_line(ranked: DataFrame, counts: dict[int, int], found: Plan, base: int, capacity: int) -> DataFrame:
    """Pieces on the line, cut at its borders; those that are cut have no ids_crc32 yet."""
    places, at = [], 0
    for length, n in sorted(found.line.items(), reverse=True):
        places.append((length, counts[length] - n, at))
        at += n * length
    # The line's end is cut into powers of two, the largest first.
    main = at // capacity * capacity
    sizes = [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if (at - main) >> b & 1]
    ends = np.append(main, main + np.cumsum(sizes, dtype=np.int64)).tolist()
    table = F.broadcast(ranked.sparkSession.createDataFrame(places, "_length long, _from long, _at long"))
    met = ranked.join(table, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")))
    begin = F.col("_at") + (F.col("_rank") - F.col("_from")) * F.col("length")
    rows = met.withColumn("_begin", begin).withColumn("_end", F.col("_begin") + F.col("length"))
    # A piece is no longer than a sequence, so one border of the main part at most lies in it.
    border = (F.floor(F.col("_begin") / capacity) + 1) * capacity
    last = F.array(*[F.lit(e).cast("long") for e in ends])
    borders = F.array_union(F.array(F.when(border <= main, border)), last)
    inside = F.filter(borders, lambda b: (b > F.col("_begin")) & (b < F.col("_end")))
    cuts = F.array_sort(F.concat(F.array("_begin"), inside))
    parts = rows.withColumn("_cuts", cuts).select("*", F.posexplode("_cuts").alias("_i", "_a"))
    parts = parts.withColumn("_b", F.coalesce(F.try_element_at("_cuts", F.col("_i") + 2), F.col("_end")))
    ended = F.size(F.filter(last, lambda e: e <= F.col("_a")))
    in_main = F.col("_a") < main
    sequence = F.when(in_main, base + F.floor(F.col("_a") / capacity)).otherwise(base + main // capacity + ended - 1)
    offset = F.when(in_main, F.col("_a") % capacity).otherwise(F.col("_a") - F.element_at(last, F.greatest(ended, F.lit(1))))
    return parts.select(
        "row", "doc_id", "doc_tokens", (F.col("start") + F.col("_a") - F.col("_begin")).alias("start"), (F.col("_b") - F.col("_a")).alias("length"),
        F.when(F.size("_cuts") == 1, F.col("ids_crc32")).alias("ids_crc32"), F.col("start").alias("piece"),
        sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"),
    )


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids if asked for) per piece; ``capacity`` is a power
    of two."""
    pieces = staged(_pieces(documents, tokenizer, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = plan(counts, capacity)
    ranked = staged(_ranked(pieces.drop("ids"), sum(counts.values())), "ranked")
    full, base = _in_full(ranked, found)
    line = _on_line(ranked, counts, found, base, capacity)
    bytes_ = F.substring("ids", (4 * (F.col("start") - F.col("piece")) + 1).cast("int"), (4 * F.col("length")).cast("int"))
    ids = pieces.select("row", F.col("start").alias("piece"), "ids")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        whole = full.unionByName(line).join(ids, ["row", "piece"]).withColumn("ids", bytes_)
        return whole.withColumn("ids_crc32", F.crc32("ids")).select(*names, "ids")
    line = staged(line, "line")
    cut = broadcast_if_small(line.where("ids_crc32 IS NULL"))
    digested = ids.join(cut, ["row", "piece"]).withColumn("ids_crc32", F.crc32(bytes_))
    whole = full.unionByName(line.where("ids_crc32 IS NOT NULL"))
    return whole.select(*names).unionByName(digested.select(*names))
