"""Operator 7: personal data by fixed formats, and by contexts that are learned from what the formats find.

1. One pass finds e-mail addresses, IP addresses, card and phone numbers by their formats (the seeds), and other tokens that look
   like identifiers (the unknown), each with the two words before it as its lexical pattern.
2. Patterns and instances form a graph. A pattern's confidence is the mean belief in its instances, counted over all different
   values with one doubtful value added; belief is 1 for a seed, and for an unknown the confidence of the best accepted
   pattern that it occurs in. ``ROUNDS`` rounds of joins and sums over the graph let accepted patterns vouch for values, which
   support further patterns. Only patterns with ``LEAST_VALUES`` believed values and ``LEAST_CONFIDENCE`` count.
3. Unknown tokens in accepted patterns are added as spans of kind ``id``. The formats' spans always stay.

Defined results: NULL is an empty text and has no spans; a pattern at the start of a text is never learned; rows of one doc_id and
text are judged alike and stay repeated; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestar.llm.common import staged

ROUNDS, LEAST_VALUES, LEAST_CONFIDENCE = 3, 5, 0.8
# Kinds in the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone", "id")

# The formats. A number never starts inside a run of digits, since the run's start is further left.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")

# Tokens that look like identifiers hold at least this many digits. A match starts at a token's start alone, so that a long
# run without digits is looked at once.
_TOKEN = re.compile(r"(?<!\S)\S*[0-9]\S*")
_LEAST_DIGITS = 4
_EDGE = ".,;:!?()[]{}<>\"'`"
# Characters before a token that are looked at first for the words before it; more where these hold too few.
_BEFORE = 80

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the fixed formats, by start and kind; each kind leftmost and without overlaps."""
    if not _ANY.search(text):
        return []
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() >= 12 else ""
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return ordered(found)


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _pattern(text: str, start: int) -> str | None:
    """The two words before a place, numbers made alike; None if there are none."""
    reach = _BEFORE
    while len(words := text[max(0, start - reach) : start].lower().split()) < 3 and reach < start:
        reach *= 2
    words = words[-2:]
    return re.sub(r"[0-9]+", "#", " ".join(words)) if len(words) == 2 else None


def instances(text: str, spans: list[Span]) -> list[tuple[str, str, bool, int, int]]:
    """(pattern, value, whether a seed, start, end) of the seeds and of tokens that look like identifiers."""
    out, covered = [], sorted((s, e) for _, s, e in spans)
    for start, end in covered:
        pattern = _pattern(text, start)
        if pattern:
            out.append((pattern, text[start:end], True, start, end))
    k = 0
    for m in _TOKEN.finditer(text):
        value = m[0].lstrip(_EDGE)
        start = m.end() - len(value)
        end = start + len(value.rstrip(_EDGE))
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if k < len(covered) and covered[k][0] < end:
            continue
        if sum("0" <= c <= "9" for c in text[start:end]) >= _LEAST_DIGITS:
            pattern = _pattern(text, start)
            if pattern:
                out.append((pattern, text[start:end], False, start, end))
    return out


_INSTANCE = pa.struct([("pattern", pa.string()), ("value", pa.string()), ("seed", pa.bool_()), ("first", pa.int64()), ("last", pa.int64())])
_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("content", pa.binary()), *((f"n_{k}", pa.int64()) for k in KINDS[:4]), ("base", pa.string()), ("instances", pa.list_(_INSTANCE))]
)


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("content"), text.alias("text"))


def find_base(documents: DataFrame) -> DataFrame:
    """One row per document: counts and spans of the formats, and the instances for the graph."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(2):
                text = value.as_py()
                spans = base_spans(text)
                counts = [sum(s[0] == k for s in spans) for k in KINDS[:4]]
                found = instances(text, spans) if _ANY.search(text) else []
                rows.append((*counts, listed(spans), [dict(zip(("pattern", "value", "seed", "first", "last"), x, strict=True)) for x in found]))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, list(_FOUND)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], schema=_FOUND)

    counts = ", ".join(f"n_{k} long" for k in KINDS[:4])
    instance = "struct<pattern: string, value: string, seed: boolean, first: bigint, last: bigint>"
    return _keyed(documents).mapInArrow(find, f"doc_id long, content binary, {counts}, base string, instances array<{instance}>")


def accepted_patterns(edges: DataFrame) -> DataFrame:
    """(pattern, confidence) after ``ROUNDS`` rounds over ``edges`` (pattern, value, seed), each edge once."""
    edges = staged(edges, "edges")
    beliefs = edges.groupBy("value").agg(F.max("seed").cast("double").alias("seeded"))
    accepted = None
    for _ in range(ROUNDS):
        belief = F.col("seeded")
        believed = beliefs
        if accepted is not None:
            vouched = edges.join(accepted, "pattern").groupBy("value").agg(F.max("confidence").alias("vouched"))
            believed = beliefs.join(vouched, "value", "left")
            belief = F.greatest("seeded", F.coalesce("vouched", F.lit(0.0)))
        believed = believed.select("value", belief.alias("belief")).where("belief > 0")
        scored = (
            edges.select("pattern", "value").join(believed, "value", "left").groupBy("pattern")
            .agg(F.sum("belief").alias("sum"), F.count("belief").alias("believed"), F.count("*").alias("n"))
            .where(F.col("believed") >= LEAST_VALUES)
            .select("pattern", (F.col("sum") / (F.col("n") + 1)).alias("confidence"))
            .where(F.col("confidence") >= LEAST_CONFIDENCE)
        )
        accepted = staged(scored, "patterns")
    return accepted


def learned_spans(found: DataFrame) -> DataFrame:
    """(doc_id, content, added): spans (first, last) that only accepted patterns show, one row per text that has any."""
    each = found.select("doc_id", "content", F.explode("instances").alias("i")).select("doc_id", "content", "i.*")
    # Values come in as hashes: the graph needs only to tell them apart.
    edges = each.groupBy("pattern", F.xxhash64("value").alias("value")).agg(F.max("seed").alias("seed"))
    accepted = accepted_patterns(edges)
    new = each.where("not seed").join(accepted, "pattern").select("doc_id", "content", "first", "last").distinct()
    return new.groupBy("doc_id", "content").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("added"))


def find_personal_data(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row; base and spans list kind:start:end."""
    found = staged(find_base(documents), "found")
    # A table that is read, not a grouping on the join's keys, so that a text with very many copies can be split.
    added = staged(learned_spans(found).withColumnsRenamed({"doc_id": "_id", "content": "_content"}), "added")
    plain = found.drop("instances")
    joined = plain.join(added, plain["doc_id"].eqNullSafe(F.col("_id")) & (plain["content"] == F.col("_content")), "left")
    base = F.when(F.col("base") == "", F.expr("array()").cast("array<string>")).otherwise(F.split("base", ","))
    # Sort keys: start, kind, end.
    parts = F.transform(base, lambda x: F.struct(
        F.split_part(x, F.lit(":"), F.lit(2)).cast("long").alias("a"), F.array_position(F.lit(list(KINDS)), F.split_part(x, F.lit(":"), F.lit(1))).alias("k"),
        F.split_part(x, F.lit(":"), F.lit(3)).cast("long").alias("b"), x.alias("s"),
    ))
    more = F.transform(F.coalesce("added", F.expr("array()").cast("array<struct<first: bigint, last: bigint>>")), lambda x: F.struct(
        x["first"].alias("a"), F.lit(len(KINDS)).cast("long").alias("k"), x["last"].alias("b"), F.concat(F.lit("id:"), x["first"], F.lit(":"), x["last"]).alias("s"),
    ))
    spans = F.array_join(F.transform(F.sort_array(F.concat(parts, more)), lambda x: x["s"]), ",")
    return joined.select("doc_id", *[f"n_{k}" for k in KINDS[:4]], "base", spans.alias("spans"))


def redact(text: str, spans: Iterable[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, of the kind that starts first."""
    out, end, at = [], 0, 0
    for kind, start, stop in ordered(spans):
        if start >= end:
            out += [text[at:start], f"<{kind.upper()}>"]
        end = max(end, stop)
        at = end
    return "".join([*out, text[at:]])


def redact_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with all found spans replaced in ``text`` (NULL stays NULL); columns and rows stay."""
    added = learned_spans(staged(find_base(documents), "found"))
    added = staged(added.withColumnsRenamed({"doc_id": "_id", "content": "_content", "added": "_added"}), "added")
    content = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    joined = documents.join(added, documents["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (content == F.col("_content")), "left").drop("_id", "_content")
    text, names = documents.columns.index("text"), [*documents.columns]

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, added in zip(batch.column(text), batch.column(len(names)), strict=True):
                new = value.as_py()
                if new is not None:
                    more = [("id", x["first"], x["last"]) for x in added.as_py() or []]
                    new = redact(new, [*base_spans(new), *more])
                out.append(new)
            columns = [batch.column(i) for i in range(len(names))]
            columns[text] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(replace, documents.schema)
