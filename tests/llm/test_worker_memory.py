"""The memory that a worker takes to encode a batch of texts stays bounded whatever the size of the batch."""

from __future__ import annotations

import subprocess
import sys
import textwrap
from pathlib import Path

PROBE = textwrap.dedent(
    """
    import random
    import pyarrow as pa
    from lakestar.llm.queries import TOKENIZER
    from lakestar.llm.tokens import encoder

    def peak():
        return int(open("/proc/self/status").read().split("VmHWM:")[1].split()[0]) // 1024

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(30_000)]
    texts = pa.array([" ".join(rng.choices(words, k=600)) + ", 12 and.\\n" for _ in range(8_000)], pa.string())
    known = encoder(TOKENIZER)
    known.document("warm up")
    before = peak()
    assert sum(len(ids) for ids in known.documents(texts)) > 4_000_000
    print(peak() - before)
    """
)


def test_a_batch_of_40_megabytes_is_encoded_in_bounded_memory():
    run = subprocess.run([sys.executable, "-c", PROBE], capture_output=True, text=True, check=True, timeout=300, cwd=Path(__file__).resolve().parents[2])
    assert int(run.stdout.split()[-1]) < 120, run.stdout
