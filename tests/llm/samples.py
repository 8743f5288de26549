"""Small tables with nulls, empty and long texts, ties, repeated rows and extra columns of clashing names."""

from __future__ import annotations

import random

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, words string, block long, "
    "uid long, n long, key string, rank int"
)
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(seed: int, words: int) -> str:
    """Invented prose: sentences of some ten words."""
    rng = random.Random(seed)
    out = []
    for k in range(words):
        out.append("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) + ("." if k % 10 == 9 else ""))
    return " ".join(out)


def odd_texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    return [
        (1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (7, "one two"), (None, prose(2, 60)),
        (None, None), (8, prose(3, 30_000)), (9, base.replace("an", "an", 1) + " tail"), (10, "é" * 3000), (11, "a b ☃ \U0001f600"),
        (12, base.upper()), (13, "IDIOT idiot. you idiot! " * 3 + prose(4, 40)),
    ]


def docs_of(spark, rows):
    """(doc_id, text) pairs as documents with extra columns."""
    return spark.createDataFrame(
        [(i, t, None if k % 3 == 0 else "en", "src0", len(t or ""), 1.0, "w", 1, 2, 3, "k", 4) for k, (i, t) in enumerate(rows)], DOCS
    )
