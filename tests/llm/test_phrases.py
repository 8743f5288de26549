import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from quotewell.llm import phrases
from quotewell.llm.bits import bit_words, has_bit
from quotewell.llm.double_array import DoubleArray
from quotewell.llm.oracle import ORACLE_SQL
from tests.llm.samples import docs_of, odd_texts


@pytest.mark.parametrize("words, rows, width", [(1, 1, 2), (5, 30, 2), (300, 3000, 3), (70_000, 90_000, 2), (40, 900, 4)])
def test_trie_counts_its_rows(words, rows, width):
    rng = np.random.default_rng(words)
    known = rng.integers(1, 1 << 63, words).astype(np.uint64)
    text = known[rng.integers(0, words, 4 * rows)]
    windows = np.lib.stride_tricks.sliding_window_view(text, width)
    some = windows[rng.permutation(np.unique(windows, axis=0, return_index=True)[1])[:rows]]
    trie = DoubleArray.from_bytes(DoubleArray.build(some, np.arange(len(some)) + 7).to_bytes())
    text[::13] = 0  # in no row
    expected = Counter(map(bytes, np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, width))))
    assert [expected[some[i - 7].tobytes()] for i in trie.ids] == trie.counts(trie.encoded(text)).tolist()
    assert trie.counts(trie.encoded(text[: width - 1])).sum() == 0


def test_bit_words(spark):
    words = bit_words(spark.createDataFrame([(0,), (63,), (64,), (127,), (63,)], "p long"), 4)
    assert np.flatnonzero(has_bit(words, np.arange(256, dtype=np.uint64))).tolist() == [0, 63, 64, 127]
    assert not bit_words(spark.createDataFrame([], "p long"), 4).any()


def test_tokens():
    words = lambda text: [t.decode() if t != phrases.BREAK else "|" for t in phrases.tokens_of(text.encode())]
    assert words("A b.C\td É,;e\n\nF") == ["a", "b", "|", "c", "d É", "|", "|", "e", "|", "|", "f"]
    assert words("") == words(" \t") == []


def sql_rows(docs):
    frame = docs.select("lang", "text").toPandas()
    con = duckdb.connect()
    con.register("documents", frame)
    return sorted(con.sql(ORACLE_SQL["op12_phrase_collocations"]).fetchall())


def corpus(spark):
    rng = random.Random(5)
    phrase = ["new york city hall", "in spite of", "of the", "é à", "x"]
    rows = [(k, " ".join(rng.choice(phrase + ["The", "a", "b."]) + rng.choice(["", "", ",", "\n", "\t"]) for _ in range(40))) for k in range(120)]
    return docs_of(spark, rows + odd_texts() * 3)  # every third lang is null


@pytest.mark.parametrize("trie_rows, bits", [(400_000, None), (4, None), (400_000, 6)])
def test_equals_sql(spark, trie_rows, bits, monkeypatch):
    """Also with several tries, and with bit maps so small that every bucket is shared."""
    if bits:
        monkeypatch.setattr(phrases, "sketch_bits", lambda words: bits)
    docs = corpus(spark)
    out = phrases.collocations(docs, trie_rows=trie_rows)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = sorted(map(tuple, out.collect()))
    assert found == sql_rows(docs) and {r[0] for r in found} == {"en", "und"}
    assert any(r[2].count(" ") == 3 for r in found)


@pytest.mark.parametrize("rate", [10**9])
def test_runs_that_no_block_named_are_found_in_the_second_round(spark, rate):
    table, _ = phrases.frequent_phrases(corpus(spark), 30, rate=rate)
    found = {(r["lang"], r["phrase"]): r["n"] for r in table.collect()}
    assert found == {(r["lang"], r["phrase"]): r["n"] for r in phrases.frequent_phrases(corpus(spark), 30)[0].collect()}
    assert len(found) == table.count() and max(len(p.split(" ")) for _, p in found) == 4


def test_top_and_empty(spark):
    rows = phrases.collocations(corpus(spark), top=3).collect()
    assert sorted((r["lang"], r["rank"]) for r in rows) == [(lang, k) for lang in ("en", "und") for k in (1, 2, 3)]
    assert phrases.collocations(docs_of(spark, [])).count() == 0
    assert phrases.collocations(docs_of(spark, [(1, "few words"), (2, None), (3, "")])).count() == 0


def test_exact_beyond_64_bits(spark):
    score = "(cast(2000000 AS decimal(7, 0)) * cast(a AS decimal(19, 0))) div (cast(l AS decimal(19, 0)) + r)"
    a, l, r = 9_000_000_000_000_000, 9_000_000_000_000_001, 9_100_000_000_000_000
    assert spark.range(1).selectExpr(f"{a}L AS a", f"{l}L AS l", f"{r}L AS r").selectExpr(score).first()[0] == 2_000_000 * a // (l + r)
