"""Near-duplicate removal by rows: ids that repeat or are missing."""

from __future__ import annotations

from lakestar.llm import near_dedup

A = "one two three four five six seven eight nine ten eleven twelve"
B = "quite another text that shares no words with those above at all today"


def test_other_texts_under_a_removed_id_stay(spark):
    rows = [(1, A, "x"), (2, A, "y"), (2, B, "z"), (None, A, "n"), (None, B + " " + B, "m"), (2, B, "z"), (3, None, "e"), (4, "", "e"), (3, None, "f")]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, content string"))
    assert kept.columns == ["doc_id", "text", "content"]
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert found == sorted([(1, A), (2, B), (None, B + " " + B), (3, None), (4, "")], key=repr)


def test_of_two_near_texts_under_one_id_one_stays(spark):
    near = A + " thirteen"
    kept = near_dedup.keep_one(spark.createDataFrame([(7, A), (7, near), (5, B)], "doc_id long, text string"), words=3).collect()
    assert len(kept) == 2 and {r["doc_id"] for r in kept} == {5, 7}
