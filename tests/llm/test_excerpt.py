"""The driver's excerpts of long texts."""

from __future__ import annotations

import time

from larkspan.llm.langid import LETTERS, PIECE, WORDS, excerpt


def plain(text):
    words = text.strip().split()
    words = [w[: 10 * LETTERS if len(words) <= WORDS // 10 else LETTERS] for w in words]
    n = WORDS // PIECE
    return " ".join(words if len(words) <= WORDS else [w for i in range(n) for w in words[(len(words) - PIECE) * i // (n - 1) :][:PIECE]])


def test_excerpts_of_long_texts_take_no_time_by_the_square(spark):
    texts = ["", " one ", "x" * 5000, "a b " * 30, " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(401)), *[" ".join(f"word{i}" for i in range(n)) for n in (1000, 20_000)] * 4]
    begun = time.time()
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "text string").select(excerpt("text")).collect()]
    assert got == [plain(t) for t in texts]
    assert time.time() - begun < 30
