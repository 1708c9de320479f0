"""Every operator against brute force on a small fixture, and on edge rows: NULLs, empty and long texts, repeated rows,
empty tables, and extra columns whose names the operators use themselves."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from lakestar.llm import decontaminate, near_dedup, neighbours, packing, pii, quality, repeats, token_files, toxicity, url_filter
from lakestar.llm.queries import RULES
from lakestar.session import scratch_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, content string, score double, id long"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(6_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 12, "x", 1.0, 1),
    (2, None, None, None, None),
    (3, "", "y", 2.0, 2),
    (4, " \n\t ", "y", 2.0, 2),
    (5, LONG, "z", 3.0, 3),
    (6, LONG, "z", 3.0, 3),
    (6, LONG, "z", 3.0, 3),
    (7, LONG + " tail é ü 日本", "z", 3.0, 3),
    (None, "no id here, mail a.b@example.com or +1 (555) 010-9999", None, None, None),
    (8, "one two", "w", 0.0, 4),
]


def _tables(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit("c").alias("content"), F.lit(0.5).alias("score"), F.lit(1).alias("id"))
    return [spark.createDataFrame(ROWS, SCHEMA), given, spark.createDataFrame([], SCHEMA)]


@pytest.fixture(scope="module", params=[0, 1, 2], ids=["edges", "given", "empty"])
def docs(spark, request):
    return _tables(spark)[request.param]


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")


def _collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_token_files_give_back_the_ids(spark, docs, rows, tokenizer):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, PATH)
    expected, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = _ids(tokenizer, text)
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert _collected(token_files.read_tokens(spark, path, digest=True)) == sorted(expected, key=repr)
    some = [r[0] for r in rows if r[0] is not None][:2]
    if some:
        found = {r["doc_id"]: r["tokens"] for r in token_files.read_documents(spark, path, some).collect()}
        assert found == {i: _ids(tokenizer, t).tolist() for i, t in rows if i in some}


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "\na", "a\n", " \n a", "a  b", "a\tb c", "it's don't", "x² Ⅷ a٣", "<|endoftext|>", "l'été. été!!", "a.\nB", "x <|endoftext|> y<|endoftext|>", "a\n\nb", "a\n\n\nb\n\n", "\n\nb c,. !! .x", "Ａ b x٣ é.", "\xa0a\u3000b", "\x1c! !\x1c!", "日本語 テキスト。", "\U0001f600 hi"])
def test_encoder_agrees_with_the_library(tokenizer, text):
    from lakestar.llm.tokens import encoder

    assert encoder(PATH).document(text).tolist() == _ids(tokenizer, text).tolist()


def test_packing_uses_every_token_once(docs, rows, tokenizer):
    found = packing.pack_documents(docs, PATH).collect()
    whole = {}
    for doc_id, text in rows:
        whole.setdefault(doc_id, []).append(_ids(tokenizer, text))
    assert sum(r["length"] for r in found) == sum(len(x) for v in whole.values() for x in v)
    sequences = {}
    for r in found:
        part = whole[r["doc_id"]][0][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(sequences) >= -(-sum(r["length"] for r in found) // packing.CAPACITY)


@pytest.mark.parametrize("counts, fewest", [({6: 2, 4: 2}, 2), ({5: 2, 4: 1, 3: 2}, 2), ({10: 3}, 3), ({7: 1, 6: 1, 4: 1, 3: 1}, 2), ({}, 0)])
def test_bin_completion_is_optimal_on_small_cases(counts, fewest):
    patterns = packing.complete_bins(counts, 10)
    assert sum(n for _, n in patterns) == fewest
    used = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= 10
        used.update({x: n * c for x, c in Counter(pattern).items()})
    assert used == Counter(counts)


def _shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def _components(rows, n):
    sets = [_shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            old, new = root[i], root[j]
            root = [new if r == old else r for r in root]
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(i, len(s), least.get(r, i)) for (i, _), s, r in zip(rows, sets, root, strict=True)]


def test_near_duplicates(docs, rows):
    found = near_dedup.near_duplicates(docs, words=4).select("doc_id", "n_shingles", "component_id")
    assert _collected(found) == sorted(_components(rows, 4), key=repr)


def test_repeats(docs, rows):
    length, data = repeats.LENGTH, [t.encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    expected = []
    for (doc_id, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert _collected(repeats.remove_repeats(docs)) == sorted(expected, key=repr)


def test_runs_do_not_end_at_steps(spark, monkeypatch):
    text = np.random.default_rng(9).integers(97, 123, repeats.STEP + 3_000, dtype=np.uint8).tobytes().decode()
    data = np.frombuffer(text[:5_000].encode(), dtype=np.uint8)
    whole = [np.concatenate(c) for c in zip(*repeats.runs(data), strict=True)]
    for step in (1, 7, 399, 1_000, 4_601):
        monkeypatch.setattr(repeats, "STEP", step)
        assert all((a == b).all() for a, b in zip(whole, (np.concatenate(c) for c in zip(*repeats.runs(data), strict=True)), strict=True))
    monkeypatch.undo()
    # Nothing repeats but the passage that crosses the border of a step.
    at = repeats.STEP - 500
    df = spark.createDataFrame([(1, text), (2, "0" + text[at : at + 1_000] + "1"), (3, text[::-1])], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in repeats.remove_repeats(df).collect()}
    assert found == {1: (1_000, 1), 2: (1_000, 1), 3: (0, 0)}


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _formats(text):
    kinds = list(FORMATS)
    found = [(m.start(), kinds.index(k), m.end(), k) for k in kinds for m in re.finditer(FORMATS[k], text) if _valid(k, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


@pytest.mark.parametrize("text", ["a@b.c@d.e", "x@@y.zz a@b", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4", "4111 1111-1111 1111 and 4111111111111112", "+1 (555) 010-9999+44 20 7946 0958", "1" * 5_000])
def test_formats(text):
    assert pii.listed(pii.base_spans(text)) == _formats(text)


def test_personal_data_keeps_the_formats(docs, rows):
    found = [(r["doc_id"], r["base"]) for r in pii.find_personal_data(docs).collect()]
    assert sorted(found, key=repr) == sorted([(i, _formats(t)) for i, t in rows], key=repr)


def test_contexts_find_unseen_identifiers(spark):
    texts = [f"note {i}: please contact staff card 411111111111{i:04d} now" for i in range(400)]
    hidden = "note x: please contact staff card AB-77412-Q now"
    df = spark.createDataFrame(list(enumerate([*texts, hidden, "nothing of that kind 12345 here"])), "doc_id long, text string")
    seeds = sum(bool(_formats(t)) for t in texts)
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(df.where("text rlike '(AB-|nothing)' or doc_id < 400")).collect()}
    assert seeds >= pii.LEAST_VALUES and found[401] == ""
    redacted = {r["doc_id"]: r["text"] for r in pii.redact_documents(df).collect()}
    assert redacted[401].endswith("12345 here")


def test_toxicity_restores_and_scores(spark):
    clean = [(i, f"the weather on day {i % 7} is mild and calm near the station", 0) for i in range(200)]
    toxic = [(1000 + i, f"you are a worthless moron on day {i % 7} near the station", 1) for i in range(60)]
    asked = [(2000, "what a w0rthl3ss m0ron", None), (2001, "m o r o n", None), (2002, None, None), (2003, "calm weather", None)]
    df = spark.createDataFrame([(i, t) for i, t, _ in [*clean, *toxic, *asked]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in [*clean, *toxic]], "doc_id long, label int")
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(df, labels).collect()}
    assert min(score[2000], score[2001], score[1000]) > 0.7 > 0.3 > max(score[2002], score[2003], score[0])


def _toxic_scores(spark, asked):
    clean = [f"the weather on day {i % 7} is mild and calm near the station" for i in range(200)]
    toxic = [f"you are a worthless moron on day {i % 7} near the station" for i in range(60)]
    df = spark.createDataFrame(list(enumerate([*clean, *toxic, *asked])), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(260)], "doc_id long, label int")
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(df, labels).collect()}
    return {text: score[260 + i] for i, text in enumerate(asked)}


def test_long_spellings_are_decoded(spark):
    long = ["m" + "o" * 50 + "ron", "a w" + "0" + "rthl" + "e" * 200_000 + "ss day", "-".join(["st4tion"] * 8 + ["m0ron"])]
    found = _toxic_scores(spark, [*long, "c" + "a" * 50 + "lm"])
    assert [found[x] > 0.7 for x in found] == [True, True, True, False]


def test_disguises_alone_and_combined(spark):
    asked = [
        "m 0 r o n", "m.o.r.o.n", "m/o/r/o/n", "m  o  r  o  n", "m_0_r_0_n", "w o r t h l e $ $", "such,m0ron", "calm:m0ron", "non-m0ron", "day/m0r0n", "w0rthles5",
        "m o r o n / d a y", "w o r t h l e s s m o r o n", "w.0.r.t.h.l.e.s.5.m.0.r.0.n", "calmw0rthl3ssm0r0n", "mooor0n", "m o o o o r 0 n", "is m 0 r o n calm",
    ]
    plain = ["the weather is mild!", "d a y", "st4tion", "c a l m", "m.i.l.d", "day 1 2 3 4 5", "near the w3ather/station2"]
    found = _toxic_scores(spark, [*asked, *plain])
    assert [x for x in asked if found[x] <= 0.7] == [] == [x for x in plain if found[x] >= 0.7]


def test_scores_cover_edge_rows(spark, docs, rows):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (8, None)], "doc_id long, label int")
    for scored in (toxicity.score_toxicity(docs, labels), quality.score_quality(docs, labels), quality.score_quality(docs, labels.limit(0))):
        found = scored.collect()
        assert sorted((r["doc_id"] for r in found), key=repr) == sorted((i for i, _ in rows), key=repr)
        assert all(0 <= r["score"] <= 1 for r in found)


def test_trees_learn_a_bound():
    x = np.random.default_rng(1).random((4_000, 5)).astype(np.float32)
    y = ((x[:, 2] > 0.6) & (x[:, 4] < 0.5)).astype(float)
    forest = quality.fit(x[:3_000], y[:3_000])
    assert ((forest.score(x[3_000:]) > 0.5) == y[3_000:]).mean() > 0.98


def test_templates_catch_other_numbers(spark):
    item = "If Maria buys 12 apples at the market for 3 dollars each then how much does Maria pay in total today"
    other = item.replace("Maria", "Jonas").replace("12", "45").replace(" 3 ", " 8 ")
    broken = item.replace("buys 12", "buys 99").replace("does Maria pay", "does Peter pay")
    df = spark.createDataFrame([(1, f"Some words first. {item}. And more."), (2, other), (3, "nothing to see here at all"), (4, None), (5, broken)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (9, item), (8, None), (10, "too short")], "item_id long, text string")
    found = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in decontaminate.judge(df, bench).collect()}
    assert found == {1: (True, 7), 2: (True, 7), 3: (False, None), 4: (False, None), 5: (False, None)}
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(df, bench).collect()) == [3, 4, 5]
    assert decontaminate.judge(df, bench.limit(0)).where("contaminated").count() == 0


def _contaminated(spark, items, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontaminate.judge(df, spark.createDataFrame(items, "item_id long, text string")).orderBy("doc_id").collect()
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(df, spark.createDataFrame(items, "item_id long, text string")).collect()) == [r["doc_id"] for r in found if not r["contaminated"]]
    return [(r["contaminated"], r["item_id"]) for r in found]


def test_slots_split_merge_and_open_sentences(spark):
    items = [(1, "a basket holds 2 apples and 2 pears so how many fruits does it hold"), (2, "from 4 red and 7 blue marbles one is drawn so what is the chance of red"), (3, "Tom has many old coins in a box. Tom gives 3 of them away. How many are left?")]
    texts = [items[0][1].replace("2 a", "3 a").replace("2 p", "5 p"), items[1][1].replace("4", "6").replace("7", "6"), items[2][1].replace("Tom", "Anna"), "so " + items[2][1].replace("How", "how")]
    assert _contaminated(spark, items, texts) == [(True, 1), (True, 2), (True, 3), (True, 3)]


def test_items_without_windows_ids_or_with_shared_ids(spark):
    two = ("the first of two long texts under one id", "another quite different text that shares its id with it")
    items = [(1, "What is 12 + 30?"), (2, "Did Marie Curie meet Albert Einstein?"), (None, "an item that has no id at all but words"), (4, two[0]), (4, two[1]), (5, " "), (None, None)]
    texts = ["He asked: What is 12 + 30? Then", "Did Marie Curie meet Albert Einstein?", f"Here {items[2][1]} follow", f"x {two[0]} y", two[1], "What is 12 + 31?", "", None]
    assert _contaminated(spark, items, texts) == [(True, 1), (True, 2), (True, None), (True, 4), (True, 4), (False, None), (False, None), (False, None)]


def _url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_url_rules(spark):
    urls = ["http://WWW.Example.com/en/x?y", "https://a.example.com/en/", "http://b.net/es/1#t", "http://b.net/es", "ftp://net/fr/a/b", "x.com/en/", None, "", "http://com", "http://a..com/", "http://example.com/de/://x", "http://notexample.com/en/", "http://b.net/es/1#t"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, urls[0]])] + [(0, urls[0], "h")], "page_id long, url string, host string")
    expected = []
    for i, u in [*enumerate([*urls, urls[0]]), (0, urls[0])]:
        host, path = _url(u)
        fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        expected.append((i, host, path, best[1], best[2]))
    found = url_filter.judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert _collected(found) == sorted(expected, key=repr)
    none = url_filter.judge(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert none.where("rule is null and verdict = 'allow'").count() == len(expected)


def test_urls_that_differ_in_scheme_query_or_fragment_all_stay(spark):
    urls = [(1, "http://b.net/es/x?1"), (1, "http://b.net/es/x?2"), (1, "ftp://B.net/es/x#3"), (None, "http://b.net/es/x"), (None, "http://b.net/es/x?1"), (None, None), (None, ""), (2, "http://b.net/es/x")]
    found = url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), spark.createDataFrame(RULES, "host string, path string, verdict string"))
    fits = [(i, "b.net", "/es/x", "net/es/", "block") for i in (1, 1, 1, None, None, 2)]
    assert _collected(found) == sorted([*fits, *[(None, "", "", None, "allow")] * 2], key=repr)


def test_neighbours_reach_their_recall(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", F.lit(1).alias("leaf"))
    odd = [(-1, None), (-2, [0.0] * 64), (-3, [float("nan")] * 64), (-4, [1.0] * 63), (-5, [None] * 64), (-6, [])]
    df = given.union(spark.createDataFrame([(i, v, 1) for i, v in odd], "vec_id long, embedding array<float>, leaf int"))
    found = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    rows = given.toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = np.where(ids == ids[q], -np.inf, x @ x[q])
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        got = sorted(found[ids[q]])
        assert [g[0] for g in got] == list(range(1, 21))
        assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
        hits, total = hits + len(best & {g[1] for g in got}), total + 20
    assert hits / total >= 0.9
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_equal_vectors_tie_to_the_smaller_id(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "vec_id long, embedding array<float>")
    found = [r["vec_id"] for r in neighbours.search(df, F.col("vec_id") == 0, k=5).orderBy("rank").collect()]
    assert found == [1, 2, 3, 4, 5]


def test_repeated_vectors_push_none_out(spark):
    x = np.random.default_rng(7).standard_normal((400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = neighbours.search(spark.createDataFrame(rows * 3, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert len({(r["query_id"], r["vec_id"]) for r in found}) == len(found) == 20 * 20
    hits = 0
    for q in range(0, 400, 20):
        scores = np.where(np.arange(400) == q, -np.inf, x @ x[q])
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {r["vec_id"] for r in found if r["query_id"] == q})
    assert hits >= 0.9 * len(found)
    # Other vectors of one id with equal scores are repeats as well.
    ids, scores = np.repeat(np.arange(100), 30), np.repeat(np.arange(100.0), 30)
    assert ids[neighbours._top(ids, scores, -1, 20)].tolist() == list(range(99, 79, -1))


def test_pipeline_stages(spark, tokenizer):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.select("doc_id", "text").collect()
        docs = stage(spark, docs, SF)
        path = scratch_path(spark, f"test-{name}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in before]
            keep = sorted(i for i, n, c in _components(rows, 5) if i == c)
            assert sorted(r["doc_id"] for r in docs.collect()) == keep
        if name == "personal_data":
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before}
            assert not any(_formats(r["text"]) for r in docs.collect())
    expected = sum(len(_ids(tokenizer, r["text"])) for r in before)
    assert docs.agg(F.sum("length")).first()[0] == expected
