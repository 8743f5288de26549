import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from quotewell.llm import lattice
from quotewell.llm.shingles import blank_words
from tests.llm.samples import docs_of, odd_texts, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(word, model):
    """Probability by listing every way to cut the word."""
    total = 0.0
    n = len(word)
    for cuts in itertools.product((0, 1), repeat=max(0, n - 1)):
        edges = [0, *[k + 1 for k, c in enumerate(cuts) if c], n]
        parts = [word[a:b] for a, b in zip(edges, edges[1:])]
        inner = lambda ps: [model.inner.get(p, sum(model.byte[b] for b in p.encode()) if len(p) == 1 else None) for p in ps]
        for head, rest in ((model.begin.get(parts[0]), parts[1:]), (model.begin[""], parts)):
            scores = inner(rest)
            if head is not None and None not in scores:
                total += math.exp(head + sum(scores) + model.stop)
    return total


def test_forward_recursion_sums_all_segmentations():
    pieces = ["▁", "▁th", "▁a", "th", "e", "the", "h", "t", "er", "r", "<0x41>"]
    model = lattice.Lattice.of(pieces, {"▁th": 5, "e": 7, "the": 2, "er": 3}, 9)
    for word in ("the", "thether", "a", "xe", "hé", "aaa"):
        assert math.isclose(math.exp(model.log_probability(word)), all_segmentations(word, model), rel_tol=1e-9)
    assert math.isfinite(model.log_probability("thx" * 2000))


def test_spellings_add_up_to_at_most_one():
    model = lattice.Lattice.of(["▁", "▁a", "a", "b", "ab"], {"▁a": 2, "a": 1, "ab": 3, "b": 1}, 3)
    words = ["".join(w) for n in range(1, 11) for w in itertools.product("ab", repeat=n)]
    total = sum(math.exp(model.log_probability(w)) for w in words)
    assert 0.5 < total <= 1.0


def base_of(rows):
    trained = [(i, blank_words(t or "")) for i, t in rows if i is None or i % 5 != 1]
    counts = Counter(w for _, ws in trained for w in ws)
    ends = len(trained)
    tokens, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    log = lambda c: math.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1)))
    return {(i, t or ""): (sum(log(counts[w]) for w in blank_words(t or "")) + log(ends), sum(counts[w] > 0 for w in blank_words(t or "")) + 1, tokens) for i, t in rows}


def test_counts_and_base_by_brute_force(spark):
    rows = odd_texts() + [(100 + k, prose(k % 7, 80)) for k in range(40)] + [(160, "spam " * 9000)]
    out = lattice.score(docs_of(spark, rows), PATH, "doc_id % 5 = 1", "lang").collect()
    want = base_of(rows)
    assert len(out) == len(rows)
    by_base = sorted(round(v[0], 6) for v in (want[(i, t or "")] for i, t in rows))
    assert np.allclose(sorted(r["base_score"] for r in out), by_base)
    assert sorted(r["n_known"] for r in out) == sorted(want[(i, t or "")][1] for i, t in rows)
    assert {r["train_tokens"] for r in out} == {next(iter(want.values()))[2]}
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    spam = next(r for r in out if r["doc_id"] == 160)
    assert spam["score"] > spam["base_score"]  # a word that keeps coming is no surprise


def test_urn_adds_up_to_one():
    draws = lattice.CONCENTRATION
    p = {"a": 0.7, "b": 0.3}
    total = 0.0
    for words in itertools.product("ab", repeat=4):
        value = -float(lattice.rising(np.array([draws]), np.array([4.0]))[0])
        for word, n in Counter(words).items():
            value += float(lattice.rising(np.array([draws * p[word]]), np.array([float(n)]))[0])
        total += math.exp(value)
    assert total == pytest.approx(1.0, rel=1e-6)
    assert lattice.log_gamma(np.array([0.001, 0.5, 3.0, 5000.0])) == pytest.approx([math.lgamma(x) for x in (0.001, 0.5, 3.0, 5000.0)], abs=1e-8)


def test_without_training_rows_and_without_rows(spark):
    out = lattice.score(docs_of(spark, [(1, "one two"), (6, None)]), PATH, "doc_id % 5 = 1").collect()
    assert len(out) == 2 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)
    assert lattice.score(docs_of(spark, []), PATH, "doc_id % 5 = 1").count() == 0
