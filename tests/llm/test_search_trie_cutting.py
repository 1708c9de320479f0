"""Ranked search, prefix trie and cutting stock against brute force, also with limits so small that every path is taken."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from lakestar.llm import cutting_stock, prefix_trie, ranked_search
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"

# Ranked search ---------------------------------------------------------------------------------------------------------

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return _TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranking(documents, items, k=50):
    held = [(i, Counter(_terms(t))) for i, t in documents]
    held = [(i, c) for i, c in held if c]
    docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item_id, text in set(items):
        scored = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * docs) // total
            score = 0
            for t in set(_terms(text)) & set(c):
                score += math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        found += [(item_id, r, i, -s) for r, (s, _, _, i) in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


EDGES = [
    (1, "The fox. THE fox jumps é日本"), (2, None), (3, ""), (4, " .,-\n"), (5, "fox " * 5000 + "jumps"), (6, "the the dog"), (6, "the the dog"),
    (None, "the dog"), (7, "Ünder the fox's den"), (8, "nothing shared"), (9, "the fox"), (10, "fox the"),
]
ASKED = [(1, "The FOX"), (2, None), (3, "!!"), (4, "dog é日本 den"), (4, "dog é日本 den"), (None, "unknown fox"), (5, "zzz"), (6, "ünder Ünder")]


@pytest.mark.parametrize(("block", "first"), [(2048, 64), (3, 1)])
def test_ranking_on_edge_rows(spark, monkeypatch, block, first):
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    monkeypatch.setattr(ranked_search, "FIRST", first)
    documents = spark.createDataFrame([(i, t, "x") for i, t in EDGES], "doc_id long, text string, score string").repartition(2)
    items = spark.createDataFrame(ASKED, "item_id long, text string")
    for k in (2, 50):
        found = ranked_search.rank_documents(documents, items, k).collect()
        assert sorted(map(tuple, found), key=repr) == _ranking(EDGES, ASKED, k)


def test_ranking_in_rounds_and_passes(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK", 16)
    monkeypatch.setattr(ranked_search, "FIRST", 1)
    monkeypatch.setattr(ranked_search, "ITEMS", 15)
    documents, items = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "benchmark"))
    found = ranked_search.rank_documents(documents, items, 5).collect()
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, found), key=repr) == _ranking(rows, [tuple(r) for r in items.select("item_id", "text").collect()], 5)


@pytest.mark.parametrize("empty", ["documents", "items"])
def test_ranking_of_empty_tables(spark, empty):
    documents = spark.createDataFrame([] if empty == "documents" else EDGES, "doc_id long, text string")
    items = spark.createDataFrame([] if empty == "items" else ASKED, "item_id long, text string")
    assert ranked_search.rank_documents(documents, items).collect() == []


def test_cells_keep_the_largest_impact_inside():
    rng = np.random.default_rng(3)
    cells = {(int(r), int(c)) for r, c in rng.integers(0, 40, (300, 2))}
    rows, columns = (np.array(x) for x in zip(*cells, strict=True))
    impacts = rng.integers(1, 10**10, len(rows))
    tree = ranked_search.Treap.of(rows, columns, impacts)
    assert tree.largest[0] == impacts.max()
    again = ranked_search.Treap(tree.height, tree.masks, tree.lower)
    assert (again.largest[-len(rows) :] == tree.largest[-len(rows) :]).all() and sorted(again.largest[-len(rows) :]) == sorted(impacts)


# Prefix trie -----------------------------------------------------------------------------------------------------------


def _trie(whole):
    """Nodes of {conv_id: [(role, text), ...]} by plain recursion."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def words(text):
        return len(re.findall(r"[^\x20\x09-\x0D]+", text))

    totals = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * words(p[-1][1]) if p else 0
        leaves = sum(totals[k][0] for k in children[p]) or 1
        totals[p] = (leaves, own + sum(totals[k][1] for k in children[p]))
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *totals[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def _ordered(rows):
    digest = lambda s: hashlib.md5((s or "").encode()).hexdigest()
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, digest(r[2]), digest(r[3]))):
        own[c].append((role or "", text or ""))
    return own


def _rebuilt(rows):
    own, whole = _ordered(rows), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    return whole


def _conversations():
    rng = np.random.default_rng(5)
    rows = [(int(c), int(t), ["user", "bot"][t % 2], f"say {rng.integers(0, 3)} again") for c in range(-25, 90) for t in range(int(rng.integers(1, 7)))]
    rows += [(200, t, "user", f"long {t // 2}") for t in range(300)] + [(201, t, "user", f"long {t // 2}") for t in range(150)]
    rows += [(300, None, None, None), (300, 0, "", "x"), (300, 0, "", "x"), (300, 0, "user", "tie"), (301, 1, "user", " \t\n"), (None, 0, "user", "lost")]
    return rows + [(400 + i, 0, "user", "the same") for i in range(60)]


SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize(("block", "last"), [(1 << 15, 1 << 14), (5, 8)])
def test_trie_of_rebuilt_conversations(spark, monkeypatch, block, last):
    monkeypatch.setattr(prefix_trie, "LISTED", 7 if block == 5 else 4096)
    rows = _conversations()
    table = spark.createDataFrame([(*r, 1) for r in rows], f"{SCHEMA}, node int").repartition(5, F.rand(1))
    steps = prefix_trie.staged(prefix_trie.numbered(prefix_trie.turns(table)), "steps")
    found = prefix_trie.build_trie(*prefix_trie.rebuild(steps), block, last)
    expected = _trie(_rebuilt(rows))
    assert sorted(map(tuple, found.select(*NAMES).collect())) == expected
    # Enter and exit places are those of one walk: nested or apart, and all different.
    spans = found.select("enter_at", "exit_at").collect()
    assert sorted(x for s in spans for x in s) == list(range(2 * len(spans)))
    opened = []
    for enter, exit_ in sorted(map(tuple, spans)):
        while opened and opened[-1] < enter:
            opened.pop()
        assert not opened or exit_ < opened[-1]
        opened.append(exit_)


def test_trie_of_conversations_as_they_are(spark):
    rows = _conversations()
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).select(*NAMES)
    assert sorted(map(tuple, found.collect())) == _trie(_ordered(rows))


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_empty_trie(spark, rows):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_trie_of_one_turnless_conversation(spark):
    # Its first turn goes and conversation 0, which should give one, is absent: nothing is left of it.
    assert zlib.crc32(b"7") % 4 >= 1
    (row,) = prefix_trie.rebuilt_trie(spark.createDataFrame([(7, 0, "user", "x")], SCHEMA)).select(*NAMES).collect()
    assert tuple(row) == (7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())


def test_ranks_of_a_shuffled_list(spark):
    order = np.random.default_rng(2).permutation(500)
    rows = [(int(a), int(b), 1, int(a) % 3, int(a)) for a, b in zip(order, [*order[1:], -1], strict=True)]
    elements = prefix_trie.staged(spark.createDataFrame(rows, "id long, next long, arcs long, leaves long, saved long"), "list")
    found = {r["id"]: (r["arcs"], r["leaves"], r["saved"]) for r in prefix_trie.rank_list(elements, 10).collect()}
    sums = np.cumsum([(0, 0, 0), *[r[2:] for r in rows]], axis=0)
    assert found == {r[0]: tuple(s) for r, s in zip(rows, sums.tolist(), strict=False)}


# Cutting stock ---------------------------------------------------------------------------------------------------------

DOCUMENTS = [
    (1, "short text"), (2, None), (3, ""), (4, "word " * 3000), (5, "a b c " * 300), (6, "same"), (6, "same"), (6, "other"), (None, "no id"),
    (None, "no id"), (7, " ".join(f"w{i}" for i in range(700))),
]


def _check_packing(documents, rows, capacity):
    known = Tokenizer.from_file(PATH)
    ids = [(i, [*known.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in documents]
    assert sum(r["length"] for r in rows) == sum(len(x) for _, x in ids)
    sequences = defaultdict(list)
    for r in rows:
        parts = [np.array(x[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes() for i, x in ids if i == r["doc_id"] and len(x) == r["doc_tokens"]]
        assert r["ids_crc32"] in {zlib.crc32(p) for p in parts if len(p) == 4 * r["length"]}
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    covered = Counter()
    for r in rows:
        covered.update((r["doc_id"], r["doc_tokens"], j) for j in range(r["start"], r["start"] + r["length"]))
    assert covered == Counter((i, len(x), j) for i, x in ids for j in range(len(x)))


@pytest.mark.parametrize("capacity", [8, 64, 1024])
def test_every_id_lies_in_one_piece_and_nothing_is_padded(spark, capacity):
    documents = spark.createDataFrame([(i, t, 1) for i, t in DOCUMENTS], "doc_id long, text string, length int").repartition(3)
    rows = cutting_stock.pack_documents(documents, PATH, capacity).collect()
    _check_packing(DOCUMENTS, rows, capacity)
    whole = cutting_stock.pack_documents(documents, PATH, capacity, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in whole)


def test_packing_of_given_and_empty_tables(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = cutting_stock.pack_documents(documents, PATH).collect()
    _check_packing([tuple(r) for r in documents.select("doc_id", "text").collect()], rows, 1024)
    assert cutting_stock.pack_documents(documents.limit(0), PATH).collect() == []


def _fewest(counts, capacity):
    """Bound of the fractional program from below: prices 1 / (how many fit) are no bound, so every pattern is listed and the
    dual prices of ``solve`` are checked on all of them instead."""
    lengths = sorted(counts)
    most = capacity // lengths[0]
    return [p for n in range(1, most + 1) for p in combinations_with_replacement(lengths, n) if sum(p) <= capacity]


@pytest.mark.parametrize("counts", [{3: 7, 5: 4, 7: 9}, {6: 10, 4: 3, 5: 8, 9: 2}, {16: 3}, {9: 5, 8: 1}, {1: 3, 2: 5, 15: 2, 11: 4}])
def test_program_is_solved(counts):
    capacity = 16
    solution = [(p, n) for p, n in cutting_stock.solve(counts, capacity) if n > 1e-9]
    for x, n in counts.items():
        assert sum(p.count(x) * k for p, k in solution) == pytest.approx(n)
    # No mixture of other patterns does with less: price each pattern of the solution at 1 and let no pattern cost more.
    lengths = sorted(counts)
    matrix = np.array([[p.count(x) for x in lengths] for p, _ in cutting_stock.solve(counts, capacity)], dtype=float)
    prices = np.linalg.solve(matrix, np.ones(len(matrix)))
    used = sum(n for _, n in solution)
    volume = sum(x * n for x, n in counts.items()) / capacity
    dearest = max(sum(prices[lengths.index(x)] for x in p) for p in _fewest(counts, capacity))
    assert dearest <= 1 + 1e-6 or used <= volume * (1 + cutting_stock.GAP)


def test_plan_uses_all_pieces():
    rng = np.random.default_rng(1)
    for capacity, most in ((16, 30), (64, 200), (256, 5)):
        counts = {int(x): int(n) for x, n in zip(range(1, capacity + 1), rng.integers(0, most, capacity), strict=True)}
        found = cutting_stock.plan(counts, capacity)
        used = Counter(found.line)
        for pattern, times in found.full:
            assert sum(pattern) == capacity and times > 0
            for x in pattern:
                used[x] += times
        assert used == Counter({x: n for x, n in counts.items() if n})
