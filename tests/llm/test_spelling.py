import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quotewell.llm import spelling
from tests.llm.samples import docs_of, odd_texts, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least=5, times=5):
    """All pairs by the patterns they share; its own reading of runs and typos."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    near = {w: set() for w in words}
    patterns = {}
    for w in words:
        for k in range(len(w)):
            patterns.setdefault((w[:k], w[k + 1 :]), set()).add(w)
            if (shorter := w[:k] + w[k + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in patterns.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= times * n else None
    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def misspelt():
    """Chains of forms, doubled letters, insertions at both ends, ties, long runs, and letters beyond A to Z."""
    rng = random.Random(3)
    rows = [(None, "banana " * 900 + "bananas " * 170 + "bananass " * 30 + "xbananass " * 6), (1, "Zürich " * 60 + "zurich " * 12 + "züricH " * 3)]
    rows += [(2, "letter leter lletter lettér LETTER " * 6 + "leters " * 5 + "abcdef abcdeg " * 20 + "abcdeh " * 5 + "Ábcdef " * 20)]
    rows += [(3, f"{'é' * 400} " * 30 + f"{'é' * 401} " * 6 + f"{'é' * 200}x{'é' * 199} " * 6 + "short abcde " * 9 + "×÷abcd " * 7)]
    base = [prose(k, 1).strip(".") + "words" for k in range(60)]
    for k in range(4, 300):
        some = []
        for w in rng.choices(base, k=80):
            if rng.random() < 0.2:
                p = rng.randrange(len(w))
                w = w[:p] + rng.choice(["", "q", w[p] * 2]) + w[p + 1 :]
            some.append(w)
        rows.append((k, " ".join(some)))
    return rows + odd_texts() * 6


def test_equals_brute_force(spark):
    rows = misspelt()
    out = spelling.variants(docs_of(spark, rows))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = sorted(map(tuple, out.collect()))
    expected = brute_force(rows)
    assert found == expected
    by_word = {r[0]: r for r in found}
    assert by_word["xbananass"][1:3] == ("bananass", "banana") and by_word["zurich"][1] == "zürich"
    assert by_word["abcdeh"][4] == 2 and sum(r[1] is not None for r in found) > 20


def test_filters_never_miss(spark):
    words = [prose(k, 1).strip(".") + "é" * (k % 70) for k in range(500)]
    filters = spelling.bloom_filters(spark.createDataFrame([(w,) for w in set(words)], "word string"))
    assert max(filters) == spelling.LAST
    for _, points in spelling.by_length(words):
        n = points.shape[1]
        hashes = (spelling.code_hashes(points) * spelling.powers(n)).sum(1, dtype=np.uint64)
        assert filters[spelling.shard_of(n)].has(hashes).all()
    strange = np.arange(100_000, dtype=np.uint64)
    assert filters[spelling.LAST].has(spelling.mixed(strange)).mean() < 0.02


@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_a_chunk_of_any_size_gives_the_same(spark, chunk, monkeypatch):
    words = [("abcdefgh", 1), ("abcdefg", 9), ("abcdefgx", 7), ("bcdefgh", 2)]
    table = spark.createDataFrame(words, "word string, n long")
    filters = spelling.bloom_filters(table)
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    probe = spelling.Probe(type("Held", (), {"value": filters})())
    found = set()
    for _, points in spelling.by_length([w for w, _ in words]):
        for who, edits, _ in probe.edits(points, filters):
            found |= {(spelling.text(points[r]), e) for r, e in zip(who, edits)}
    expected = {("abcdefgh", "abcdefg"), ("abcdefgh", "bcdefgh"), ("abcdefgh", "abcdefgx"), ("abcdefgx", "abcdefgh"), ("abcdefgx", "abcdefg")}
    assert expected <= found


def test_empty(spark):
    assert spelling.variants(docs_of(spark, [])).count() == 0
    assert spelling.variants(docs_of(spark, [(1, None), (2, ""), (3, "unique words")])).count() == 0
