"""Small document tables with the awkward cases every operator has to take."""

from __future__ import annotations

import random

from tabready.llm.common import ship

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


def awkward_texts() -> list[str | None]:
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "un", "ar", "ir")]
    long = sentence(rng, 12_000, words)
    near = sentence(rng, 120, words)
    return [None, "", "   \n\t ", "one", "one", long, long + " end", near, near, near + " tail", sentence(rng, 80, words),
            "héllo wörld — 中文 😀 " * 12, "a" * 3000, "x\ny\nx\nx\n\n\n" * 9]


def table(spark, texts, first_id=10, **extra):
    """Documents with ids from ``first_id``, one null id, a repeated row, and a column that clashes."""
    ship(spark)
    rows = [(first_id + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    if rows:
        rows += [rows[-1], (None, texts[-1], None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("kept", "n_words", "text_", "key", "n", "rid", "spans", "score", "lang_pred", "row"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df
