"""Operator 3: benchmark decontamination by templates, so that re-parameterised questions are caught as well.

1. Words are made canonical: numbers, names (capitalised words inside a sentence) and units behind numbers become typed placeholders,
   and the rest loses case and outer punctuation. ``WINDOW`` such words in a row are a template window.
2. Windows of the benchmark and of the documents are hash-joined. Only windows with ``LITERALS`` words that are no placeholders
   count, as a row of placeholders says nothing. An item's rarest windows are joined first; all of them only where one is met.
   A capitalised word that opens a sentence is both a literal and a name: each of its windows comes in both forms.
3. Along one alignment of an item with a document, names and units must be filled consistently: one value of the item answers to
   one value of the document in most of its places, and the other way round. Windows with other fillings don't count; numbers
   are free. A document is contaminated by an item if the windows left make up ``SHARE`` of the item's windows.

Defined results: NULL and empty texts, and items without words, are clean and match nothing; items with no window that counts
(fewer than ``WINDOW`` words, or too many placeholders) are found by the hash of all their words, with share 1; items of equal text are one
item with the least item_id, which may be NULL; different texts of one item_id are different items; rows of one text are judged alike and stay repeated; empty tables are
allowed; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakestar.llm.common import BASE, LOWER, bytes_of, mix, powers, prefix_hash, range_hash, staged, word_bounds

WINDOW, LITERALS, SHARE = 5, 3, 0.8
# Hashes of benchmark windows that a task looks up at once (8 bytes each); a larger benchmark takes several passes.
LOOKUP = 4_000_000

# Units that become placeholders behind a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml cl l gal s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years metre metres meter meters kilometre kilometres kilometer kilometers mile miles foot feet inch inches gram grams "
    "kilogram kilograms pound pounds litre litres liter liters degree degrees percent dollar dollars euro euros cent cents km/h mph kmh"
).split()

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_WORDY = _DIGIT | _UPPER
_WORDY[97:123] = True
_WORDY[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[np.frombuffer(b".!?:", dtype=np.uint8)] = True
_NUMBER, _NAME, _UNIT = np.uint64(1), np.uint64(2), np.uint64(3)
_WHOLE = np.uint64(0xD6E8FEB86659FD93)


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return range_hash(prefix_hash(data), *word_bounds(data))


_UNIT_HASHES = np.sort(_hash_words(UNITS))


def _within(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def canonical(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template and value of each word: equal for a literal, a small number and the word's hash for a placeholder; and whether
    a literal opens a sentence like a name. Words without letters or digits are left out."""
    start, end = word_bounds(data)
    wordy = _WORDY[data]
    count = np.concatenate([[0], np.cumsum(wordy)])
    some = count[end] > count[start]
    ends_sentence = _STOP[data[end - 1]] if len(end) else np.zeros(0, dtype=bool)
    opens = np.ones(len(start), dtype=bool)
    opens[1:] = ends_sentence[:-1] | (data[np.maximum(start[1:] - 1, 0)] == 10)
    start, end, opens = start[some], end[some], opens[some]
    if not len(start):
        none = np.empty(0, dtype=np.uint64)
        return none, none, none.astype(bool)
    place = np.flatnonzero(wordy)
    start, end = place[count[start]], place[count[end] - 1] + 1
    value = range_hash(prefix_hash(LOWER[data]), start, end)
    template = value.copy()
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    number = digits[end] - digits[start] == count[end] - count[start]
    template[_UPPER[data[start]] & ~opens] = _NAME
    after_number = np.concatenate([[False], number[:-1]])
    template[after_number & _within(_UNIT_HASHES, value)] = _UNIT
    template[number] = _NUMBER
    return template, value, _UPPER[data[start]] & opens & (template > _UNIT)


def windows(template: np.ndarray, opener: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and form of each window that counts. A form's bits tell which openers are read as names."""
    n = len(template) - WINDOW + 1
    if n < 1:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    literal = np.concatenate([[0], np.cumsum(template > _UNIT)])
    place = np.flatnonzero(literal[WINDOW:] - literal[:-WINDOW] >= LITERALS)
    openers = np.zeros(len(place), dtype=np.int64)
    for i in range(WINDOW):
        openers |= opener[place + i].astype(np.int64) << i
    out = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        out = out * BASE + template[i : i + n]
    found = [(place, out[place], np.zeros(len(place), dtype=np.int64))]
    some = openers > 0
    at, masks = place[some], openers[some]
    for form in sorted({f for m in np.unique(masks).tolist() for f in range(1, m + 1) if m & f == f}):
        here = at[(masks & form) == form]
        other = out[here]
        for i in range(WINDOW):
            if form >> i & 1:
                other = other + (_NAME - template[here + i]) * powers(WINDOW)[0][WINDOW - 1 - i]
        found.append((here, other, np.full(len(here), form)))
    place, hashes, form = (np.concatenate(c) for c in zip(*found, strict=True)) if len(found) > 1 else found[0]
    return place, mix(hashes), form


def whole(prefix: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words at each place where so many are left; apart from hashes of windows."""
    place = np.arange(max(len(prefix) - n, 0))
    return range_hash(prefix, place, place + n) ^ _WHOLE


def _prefix(value: np.ndarray) -> np.ndarray:
    """Hash of the first i words for every i."""
    out = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(mix(value) * powers(len(value))[0][: len(value)], out=out[1:])
    return out


def agreeing(found: list[tuple[int, list, list]]) -> set[int]:
    """Places of the windows (place, slots of the item, slots of the document) of one alignment that are filled as most others."""
    filled = {(place + i, a, b) for place, own, other in found for i, (a, b) in enumerate(zip(own, other, strict=True)) if a is not None}
    both, left, right = (Counter(key) for key in zip(*(((a, b), a, b) for _, a, b in filled), strict=True)) if filled else (Counter(), Counter(), Counter())

    def agrees(a: int, b: int) -> bool:
        return 2 * both[a, b] > max(left[a], right[b])

    return {place for place, own, other in found if all(agrees(a, b) for a, b in zip(own, other, strict=True) if a is not None)}



def _windows_of(texts: DataFrame, wanted: np.ndarray | None, lengths: list[int]) -> DataFrame:
    """(id, content, hash, place, n, slots): windows of each text (id, content, text); slots hold the value at each place that is
    a name or a unit, else NULL. With ``wanted`` (sorted) only those windows, and runs of ``lengths`` words; without, all words of
    the texts that have no windows, with ``n`` words."""
    columns = [("id", pa.int64()), ("content", pa.binary()), ("hash", pa.int64()), ("place", pa.int32()), ("n", pa.int32()), ("slots", pa.list_(pa.int64()))]
    out = pa.schema(columns)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i in range(len(batch)):
                template, value, opener = canonical(bytes_of(batch.column(2), i))
                place, hashes, form = windows(template, opener)
                if wanted is not None:
                    hit = _within(wanted, hashes)
                    place, hashes, form = place[hit], hashes[hit], form[hit]
                doc_id, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                ns = lengths if wanted is not None else [len(value)] * (len(value) > 0 and not len(place))
                prefix = _prefix(value) if ns else None
                for n in ns:
                    runs = whole(prefix, n)
                    at = np.arange(len(runs)) if wanted is None else np.flatnonzero(_within(wanted, runs))
                    # One place is enough.
                    first = np.sort(np.unique(runs[at], return_index=True)[1])
                    rows += [(doc_id, content, h, p, n, []) for p, h in zip(at[first].tolist(), runs[at[first]].view(np.int64).tolist(), strict=True)]
                for p, h, f in zip(place.tolist(), hashes.view(np.int64).tolist(), form.tolist(), strict=True):
                    t, v = template[p : p + WINDOW].tolist(), value[p : p + WINDOW].view(np.int64).tolist()
                    rows.append((doc_id, content, h, p, 0, [v[k] if t[k] in (_NAME, _UNIT) or f >> k & 1 else None for k in range(WINDOW)]))
            if rows:
                arrays = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return texts.mapInArrow(make, "id long, content binary, hash long, place int, n int, slots array<long>")


def _covered(alignments: DataFrame) -> DataFrame:
    """(content, item, place): places of items that the consistent windows of an alignment cover."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place = [], []
            for i, found in enumerate(batch.column(2).to_pylist()):
                held = agreeing([(w["item_place"], w["item_slots"], w["slots"]) for w in found])
                row += [i] * len(held)
                place += held
            kept = [batch.column(c).take(pa.array(row, pa.int64())) for c in range(2)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(place, pa.int32())], ["content", "item", "place"])

    return alignments.select("content", "item", "windows").mapInArrow(pick, "content binary, item binary, place int")


def _keyed(table: DataFrame, key: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return table.select(F.col(key).cast("long").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("content"), text.alias("text"))


def _candidates(found: DataFrame, asked: DataFrame) -> DataFrame:
    """(content, item): texts that hold one of an item's rarest windows.

    A contaminated text lacks at most a share of 1 - ``SHARE`` of an item's places, so it holds at least one of that many and one
    more. Where these are the places whose windows the texts hold least often, a window that many texts and many items share
    pairs only those that share everything else too.
    """
    met = found.groupBy("hash", "n").agg(F.count("*").alias("times"))
    places = asked.select(F.col("content").alias("item"), "hash", "n", "place").join(met, ["hash", "n"], "left")
    places = places.groupBy("item", "place").agg(F.sum(F.coalesce("times", F.lit(0))).alias("times"), F.collect_set(F.struct("hash", "n")).alias("forms"))
    total = F.count("*").over(Window.partitionBy("item"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("times", "place"))
    # A little is added before rounding down: one place too many costs nothing, one too few would lose a text.
    few = places.withColumn("few", F.floor(total * (1 - SHARE) + 1e-6) + 1).withColumn("rank", rank).where("rank <= few and times > 0")
    rare = staged(few.select("item", F.explode("forms").alias("form")).select("item", "form.*").distinct(), "rare")
    return staged(found.select("content", "hash", "n").join(rare, ["hash", "n"]).select("content", "item").distinct(), "candidates")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(content, item_id, share): items that contaminate texts, and the share of their windows found, for each different text.
    ``content`` is the MD5 of the text."""
    # Items of equal text are one item; the id is only its name.
    items = _keyed(benchmark, "item_id").groupBy("content").agg(F.min("id").alias("id"), F.first("text").alias("text"))
    asked = staged(_windows_of(items.select("id", "content", "text"), None, []), "asked")
    distinct = asked.select("hash").distinct()
    passes = max(1, -(-distinct.count() // LOOKUP))
    # Different numbers of words of the items without windows: small numbers, however many items.
    lengths = sorted(r["n"] for r in asked.where("n > 0").select("n").distinct().collect())
    found = None
    texts = _keyed(documents, "doc_id")
    for i in range(passes):
        # At most about LOOKUP hashes go to the tasks in each pass, and together all of them do.
        wanted = distinct.where(F.pmod(F.xxhash64("hash"), F.lit(passes)) == i) if passes > 1 else distinct
        lookup = np.sort(wanted.toPandas()["hash"].to_numpy(dtype=np.int64).view(np.uint64))
        more = _windows_of(texts, lookup, lengths)
        found = more if found is None else found.union(more)
    # Copies of a text hold the same windows, however many there are and whatever their ids.
    found = staged(found.drop("id").distinct(), "found")
    item = asked.select(F.col("content").alias("item"), "hash", "n", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    sought = _candidates(found, asked).join(item, "item")
    met = found.join(sought, ["content", "hash", "n"]).withColumn("shift", F.col("place") - F.col("item_place"))
    per_alignment = met.groupBy("content", "item", "shift").agg(F.collect_set(F.struct("item_place", "item_slots", "slots")).alias("windows"))
    covered = _covered(per_alignment).distinct()
    total = asked.groupBy(F.col("content").alias("item")).agg(F.min("id").alias("item_id"), F.countDistinct("place").alias("total"))
    shares = covered.groupBy("content", "item").agg(F.count("*").alias("n")).join(total, "item")
    shares = shares.select("content", "item_id", (F.col("n") / F.col("total")).alias("share"))
    return shares.where(F.col("share") >= SHARE)


def judge(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_id, share) of every row: how many items contaminate it, and the one with the largest
    share (of equal ones the least id)."""
    best = leaks(documents, benchmark).groupBy("content").agg(
        F.count("*").alias("n_items"), F.max(F.struct("share", (-F.col("item_id")).alias("item"))).alias("best")
    )
    # A table that is read, not a grouping on the join's key, so that a text with very many copies can be split.
    best = staged(best.withColumnRenamed("content", "_content"), "best")
    docs = _keyed(documents, "doc_id").select(F.col("id").alias("doc_id"), "content")
    return docs.join(best, F.col("content") == F.col("_content"), "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        (-F.col("best.item")).alias("item_id"),
        F.col("best.share").alias("share"),
    )


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that no item contaminates, with all their columns."""
    found = staged(leaks(documents, benchmark).select(F.col("content").alias("_leak")).distinct(), "leaks")
    content = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return documents.join(found, content == F.col("_leak"), "left_anti")
