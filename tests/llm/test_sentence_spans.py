import random

import pytest

from quotewell.llm import sentence_spans
from tests.llm.samples import docs_of, odd_texts, prose


def brute(rows):
    """Removed sentences of each (doc_id, hash) by comparing runs as text."""
    first, removed = {}, {}
    keyed = sorted({(i is not None, i or 0, h, t) for i, h, t in rows})
    for has_id, i, h, t in keyed:
        found = sentence_spans.sentences(t)
        gone = set()
        for k, end in enumerate(sentence_spans.run_ends(found)):
            if end:
                run = tuple(s for _, s, _ in found[k:end])
                if first.setdefault(run, (has_id, i, h, k)) != (has_id, i, h, k):
                    gone |= set(range(k, end))
        removed[(i if has_id else None, t)] = len(gone)
    return removed


@pytest.mark.parametrize("bits", [27, 6])
def test_like_brute_force(spark, bits, monkeypatch):
    """Also with a map so small that it lets every run through."""
    monkeypatch.setattr(sentence_spans, "MAP_BITS", bits)
    passage = prose(50, 60)
    rows = odd_texts() + [(20, prose(21, 30) + "\n" + passage + "\n" + prose(22, 30)), (21, passage), (22, prose(23, 45) + "\n" + passage)]
    docs = docs_of(spark, rows)
    from pyspark.sql import functions as F

    hashes = {r[0]: r[1] for r in docs.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    want = brute([(i, hashes[t or ""], t or "") for i, t in rows])
    out = sentence_spans.without_repeats(docs).collect()
    assert len(out) == len(rows)
    gone = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"], r["n_sentences"]) for r in out)
    expected = sorted((i is None, i or 0, want[(i, t or "")], len(sentence_spans.sentences(t or ""))) for i, t in rows)
    assert gone == expected
    texts = {r["doc_id"]: r["text"] for r in out}
    assert texts[20] == dict(rows)[20]  # the first stays
    assert texts[21] == "" and passage not in texts[22] and texts[22].startswith(prose(23, 45)[:60])


def test_sentences_cover_the_text():
    for text in ("A b. C d?! e.f 3.4\n\n x *** y.\n", "", "  lead", prose(3, 500).replace(".", ""), "..!? . \n."):
        found = sentence_spans.sentences(text)
        assert sum(n for _, _, n in found) == len(text.split())
        assert all(n <= sentence_spans.MIN_WORDS for _, _, n in found)


def test_empty_table(spark):
    assert sentence_spans.without_repeats(docs_of(spark, [])).count() == 0


def test_unpunctuated_passages_at_any_offset(spark):
    """Copies without marks, after any number of words, go but for their edges; what isn't repeated as words stays."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [words(rng.randrange(50, 90)) for _ in range(60)]
    rows = [(k, " ".join(words(rng.randrange(0, 50)) + passages[k % 60] + words(rng.randrange(0, 50)))) for k in range(240)]
    out = {r["doc_id"]: r["text"].split() for r in sentence_spans.without_repeats(docs_of(spark, rows)).collect()}
    edge = 2 * sentence_spans.NEIGHBOURS
    for k, text in rows:
        passage, left = passages[k % 60], set(out[k])
        if k < 60:
            assert out[k] == text.split()  # the first stays
            continue
        assert [w for w in text.split() if w not in passage] == [w for w in out[k] if w not in passage]
        assert left.isdisjoint(passage[edge : len(passage) - edge - sentence_spans.NEIGHBOURS])


def test_cuts_have_a_largest_gap():
    rng = random.Random(12)
    for kinds in (1, 2, 5, 10**6):
        for n in range(21, 80):
            places = sentence_spans.cuts([str(rng.randrange(kinds)) for _ in range(n)])
            assert all(0 < b - a <= sentence_spans.NEIGHBOURS for a, b in zip([0, *places], [*places, n]))
