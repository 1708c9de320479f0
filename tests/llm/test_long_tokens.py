"""Personal data in texts of one long token, and tokens and contexts of any length."""

from __future__ import annotations

import time

from lakestar.llm import pii


def test_a_megabyte_without_blanks_is_looked_at_once():
    for text in ("x" * 1_000_000, "x" * 1_000_000 + "1234", "a" * 500_000 + " ref id " + "b" * 500_000 + "12345"):
        start = time.perf_counter()
        pii.instances(text, pii.base_spans(text))
        assert time.perf_counter() - start < 2


def test_long_tokens_and_far_words_count():
    token = "k" * 100 + "12345"
    assert [m[0] for m in pii._TOKEN.finditer(f"say {token} now a1b")] == [token, "a1b"]
    far = "first " + "w" * 200 + " " + " " * 90
    assert pii._pattern(f"{far}{token}", len(far)) == pii._pattern(f"zero first {'w' * 200} {token}", 12 + 200)
