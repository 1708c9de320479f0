"""Operators 2, 3, 4, 7 and 8 against plain versions: every alignment, every path of a lattice, every round of a graph, every tree."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import cache
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from lakestar.llm import decontaminate, packing, pii, quality, toxicity
from lakestar.llm.common import as_bytes
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


# Operator 3


def _words(text):
    """(template, value, whether it opens a sentence as a name would) of each word with a letter or digit."""
    out, opens, number = [], True, False
    for m in re.finditer(r"[^ \t-\r]+", text):
        raw, line = m[0], m.start() > 0 and text[m.start() - 1] == "\n"
        wordy = [i for i, c in enumerate(raw) if c.isascii() and c.isalnum() or ord(c) >= 128]
        first = opens or line
        opens = raw[-1] in ".!?:"
        if not wordy:
            continue
        word = raw[wordy[0] : wordy[-1] + 1]
        value = re.sub("[A-Z]", lambda x: x[0].lower(), word)
        upper = "A" <= word[0] <= "Z"
        kind = "NAME" if upper and not first else None
        if number and value in decontaminate.UNITS:
            kind = "UNIT"
        number = all(word[i - wordy[0]] in "0123456789" for i in wordy)
        if number:
            kind = "NUMBER"
        out.append((kind, value, upper and first and kind is None))
    return out


@cache
def _windows(text):
    """(place, template, slots) of each form of each window that counts."""
    words, out = _words(text), []
    for p in range(len(words) - decontaminate.WINDOW + 1):
        part = words[p : p + decontaminate.WINDOW]
        if sum(kind is None for kind, _, _ in part) < decontaminate.LITERALS:
            continue
        for names in product(*[(False, True) if opener else (False,) for _, _, opener in part]):
            kinds = ["NAME" if name else kind for (kind, _, _), name in zip(part, names, strict=True)]
            template = tuple((k, v if k is None else "") for k, (_, v, _) in zip(kinds, part, strict=True))
            out.append((p, template, tuple(v if k in ("NAME", "UNIT") else None for k, (_, v, _) in zip(kinds, part, strict=True))))
    return out


@cache
def _held(text):
    out = defaultdict(list)
    for p, template, slots in _windows(text):
        out[template].append((p, slots))
    return out


def _share(item, text):
    own, held = _windows(item), _held(text)
    if not own:
        a, b = ([v for _, v, _ in _words(x)] for x in (item, text))
        return float(bool(a) and any(b[i : i + len(a)] == a for i in range(len(b))))
    alignments = defaultdict(set)
    for q, template, own_slots in own:
        for p, slots in held.get(template, []):
            alignments[p - q].add((q, own_slots, slots))
    places = set()
    for found in alignments.values():
        filled = {(q + i, a, b) for q, x, y in found for i, (a, b) in enumerate(zip(x, y, strict=True)) if a is not None}
        both, left, right = Counter((a, b) for _, a, b in filled), Counter(a for _, a, _ in filled), Counter(b for _, _, b in filled)
        for q, x, y in found:
            if all(2 * both[a, b] > left[a] and 2 * both[a, b] > right[b] for a, b in zip(x, y, strict=True) if a is not None):
                places.add(q)
    return len(places) / len({p for p, _, _ in own})


def test_leaks_are_those_of_every_alignment(spark):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(60).collect()]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    for k, (_, text) in enumerate(bench[:40]):
        words = text.split()
        # Other numbers, a word changed at the k-th place, cut at the end, and behind other words.
        docs.append((10_000 + k, "Before it. " + re.sub(r"[0-9]+", "77", text) + " and after"))
        docs.append((20_000 + k, " ".join([*words[: k % len(words)], "changed", *words[k % len(words) + 1 :]])))
        docs.append((30_000 + k, " ".join(words[: max(1, len(words) * (70 + k) // 100)])))
    docs += [(None, bench[0][1]), (None, bench[0][1]), (1, bench[0][1]), (2, None), (3, ""), (4, "word " * 5_000 + bench[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = sorted(((r["doc_id"], r["contaminated"], r["n_items"]) for r in decontaminate.judge(df, items).collect()), key=repr)
    different = {text for _, text in bench}
    counts = [(i, sum(_share(x, text or "") >= decontaminate.SHARE for x in different)) for i, text in docs]
    assert found == sorted(((i, n > 0, n) for i, n in counts), key=repr)
    assert 40 < sum(n > 0 for _, n in counts) < len(docs)


def test_a_shared_window_pairs_no_strangers(spark, monkeypatch):
    opening = "which of the following answers to this question is the right one"
    number = ["zero one two three four five six seven eight nine".split()[i % 10] + "abcdefghij"[i // 10] for i in range(60)]
    bench = [(i, f"{opening} {' '.join(f'{number[i]}{w}' for w in 'kilo lima mike nova oslo papa quiz rome'.split())}") for i in range(60)]
    docs = [(i, f"{opening} {' '.join(f'doc{number[i]}{w}' for w in 'alfa beta gama delt'.split())}") for i in range(55)] + bench[55:]
    pairs, made = [], decontaminate._candidates

    def counted(found, asked):
        out = made(found, asked)
        pairs.append((out.count(), found.join(asked.select("hash", "n"), ["hash", "n"]).count()))
        return out

    monkeypatch.setattr(decontaminate, "_candidates", counted)
    found = decontaminate.judge(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r["doc_id"]: r["item_id"] for r in found.where("contaminated").collect()} == {i: i for i in range(55, 60)}
    # Nearly 30,000 pairs of windows meet, five pairs of texts and items are looked at.
    assert pairs[0][0] == 5 and pairs[0][1] > 55 * 60 * 8


# Operator 4


def test_equal_rows_without_id_are_dealt_to_many_buckets(spark):
    df = spark.createDataFrame([(None, "the same text again")] * 400, "doc_id long, text string").repartition(4)
    cut = packing.cut(df, PATH)
    assert cut.select(F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", "nth"), F.lit(8)).alias("b")).distinct().count() == 8
    found = packing.pack_documents(df, PATH).collect()
    length = found[0]["length"]
    places = sorted((r["sequence_id"], r["offset"]) for r in found)
    full = packing.CAPACITY // length
    assert len(set(places)) == 400 and len({s for s, _ in places}) == -(-400 // full)
    assert {o for _, o in places} == {length * i for i in range(full)}


# Operator 7


def _learned(texts):
    """Spans that accepted patterns add, by rounds over the whole graph in plain Python."""
    each = [(i, *x) for i, text in texts for x in pii.instances(text, pii.base_spans(text))]
    values, seeded = defaultdict(set), defaultdict(float)
    for _, pattern, value, seed, _, _ in each:
        values[pattern].add(value)
        seeded[value] = max(seeded[value], float(seed))
    confidence = {}
    for _ in range(pii.ROUNDS):
        belief = dict(seeded)
        for pattern, c in confidence.items():
            for value in values[pattern]:
                belief[value] = max(belief[value], c)
        confidence = {}
        for pattern, held in values.items():
            believed = [belief[v] for v in held if belief[v] > 0]
            if len(believed) >= pii.LEAST_VALUES and sum(believed) / (len(held) + 1) >= pii.LEAST_CONFIDENCE:
                confidence[pattern] = sum(believed) / (len(held) + 1)
    spans = defaultdict(list)
    for i, pattern, _, seed, start, end in each:
        if not seed and pattern in confidence:
            spans[i].append(f"id:{start}:{end}")
    return {i: sorted(s, key=lambda x: int(x.split(":")[1])) for i, s in spans.items()}, confidence


def test_accepted_patterns_add_spans(spark):
    texts = [f"case {i}: write to member u{i}@example.com today" for i in range(60)]
    # Unknown values behind an accepted pattern, and with them a pattern that no format ever follows.
    texts += [f"again write to member MB-{i:05d}-X today" for i in range(4)] + [f"paid by holder MB-{i % 4:05d}-X and holder K{i % 4}" for i in range(8)]
    texts += [f"the badge number HX{i:06d} was lost" for i in range(30)] + ["to member", "MB-12345", "", f"{'x' * 500}9999 to member Z{'1' * 200}"]
    rows = list(enumerate(texts))
    expected, confidence = _learned(rows)
    assert confidence.get("to member", 0) >= pii.LEAST_CONFIDENCE and all(60 + i in expected for i in range(4)) and 105 in expected
    df = spark.createDataFrame([*rows, (7, None), (None, texts[60]), (60, texts[60])], "doc_id long, text string")
    found = [(r["doc_id"], [s for s in r["spans"].split(",") if s.startswith("id:")], r["base"]) for r in pii.find_personal_data(df).collect()]
    assert sorted(((i, s) for i, s, _ in found if s), key=repr) == sorted([*expected.items(), (None, expected[60]), (60, expected[60])], key=repr)
    redacted = {r["text"] for r in pii.redact_documents(df).where("doc_id = 60").collect()}
    assert redacted == {"again write to member <ID> today"}


def test_patterns_over_many_rounds_and_values(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        k = int(rng.integers(0, 6))
        value = f"a{rng.integers(0, 40)}@b.org" if rng.random() < 0.2 + 0.15 * k else f"Q{rng.integers(1000, 1012)}"
        rows.append((i, f"see file kind{'abcdef'[k]} tag {value} end"))
    rows += [(1_000 + i, f"see file kind{'abcdef'[i % 6]} tagged Q{1000 + i} end") for i in range(12)]
    expected, _ = _learned(rows)
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith("id:")] for r in found if "id:" in r["spans"]} == expected
    assert 0 < len(expected) < 612


# Operator 8


def _walk(forest, x):
    total = forest.base
    for feature, bound, leaf in zip(forest.feature, forest.bound, forest.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if x[feature[node]] > bound[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_arrays_score_as_a_walk_through_each_tree():
    rng = np.random.default_rng(3)
    texts = ["", " ", "a", "é\n" * 30, "same same same same", "one. two, three! " * 400]
    texts += [" ".join("abcdefghij"[j] * (1 + int(rng.integers(9))) for j in rng.integers(0, 10, int(n))) for n in rng.integers(1, 300, 300)]
    x = np.stack([quality.statistics(as_bytes(t)) for t in texts])
    forest = quality.fit(x, (x[:, 0] + rng.normal(0, 0.5, len(x)) > np.median(x[:, 0])).astype(float))
    assert np.allclose(forest.score(x), [_walk(forest, row) for row in x], rtol=0, atol=1e-12)
    assert len(np.unique(forest.score(x))) > 20


# Operator 2


def _best_path(decoder, model, text, borders):
    """The likeliest reading among all paths, one after the other."""
    choices = []
    for i in range(len(text)):
        readings = decoder._readings(text, i)
        choices.append(readings + [(f" {o}", c + toxicity._BORDER) for o, c in readings if o.isalpha()] * (borders and i > 0))
    best = (-np.inf, "")
    for path in product(*choices):
        read = "".join(o for o, _ in path)
        s = [toxicity._REST] * 3 + [toxicity._symbol(c) for c in read] + [toxicity._REST]
        score = sum(c for _, c in path) + sum(model[tuple(s[k : k + 4])] for k in range(len(s) - 3))
        best = max(best, (score, read))
    return best[1]


@pytest.mark.parametrize("borders", [False, True])
def test_decoding_finds_the_best_of_all_paths(borders):
    rng = np.random.default_rng(8)
    model = np.log(rng.dirichlet(np.full(toxicity.SYMBOLS, 0.3), (toxicity.SYMBOLS,) * 3) + 1e-9).astype(np.float32)
    decoder = toxicity.Decoder(model)
    signs = "aelost013457$!@*é"
    texts = ["", "a", "$", "$$", "aaa", "1l1", "m0r0n", "$$$"] + ["".join(signs[k] for k in rng.integers(0, len(signs), 1 + i % 6)) for i in range(120)]
    assert [decoder._likeliest(t, borders) for t in texts] == [_best_path(decoder, model, t, borders) for t in texts]
