import gc
import itertools
import random
import weakref

import public_tokenizers
import pyarrow as pa
import pytest

from quotewell.llm import jaccard, packing, toxicity
from quotewell.llm.graph import components, local_components
from quotewell.llm.shingles import WordHashes, blank_words
from tests.llm.samples import docs_of, odd_texts, prose


def shingle_set(text, size):
    w = blank_words(text or "")
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent):
    """Number of shingles and smallest reachable id of each row, by comparing all pairs."""
    sets = [shingle_set(t, size) for _, t in rows]
    links = [
        (a, b)
        for a, b in itertools.combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    import numpy as np

    labels = local_components(len(rows), np.array([a for a, _ in links], int), np.array([b for _, b in links], int))
    least = {}
    for (i, _), c in zip(rows, labels):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    return sorted((i is None, i or 0, len(s), least[c] is None, least[c] or 0) for (i, _), s, c in zip(rows, sets, labels))


def edited(text, edits, seed):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_like_brute_force(spark, size, percent):
    """A large family of near copies, passages that many documents share, and odd rows."""
    base, passage = prose(70, 150), prose(71, 60)
    rows = odd_texts()
    rows += [(100 + k, edited(base, k % 7, k)) for k in range(60)]
    rows += [(200 + k, passage + " " + prose(300 + k, 20 + k)) for k in range(40)]
    rows += [(300 + k, passage + " x" * (k % 3)) for k in range(20)]
    rows += [(400 + k, " ".join(prose(k, 40).split()[: 3 + k % 5])) for k in range(30)]
    out = jaccard.similarity_components(docs_of(spark, rows), size, percent, cost=4).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] is None, r["component_id"] or 0) for r in out)
    assert got == brute(rows, size, percent)


def spied(monkeypatch, name):
    """Counts the rows of the first argument of each call of ``jaccard.<name>``."""
    counts, real = [], getattr(jaccard, name)

    def spy(rows, *rest):
        counts.append(rows.where(rest[0]).count() if name == "counted" else rows.count())
        return real(rows, *rest)

    monkeypatch.setattr(jaccard, name, spy)
    return counts


def test_passage_of_unlinked_documents_is_no_square(spark, monkeypatch):
    """2,000 documents that are mostly one passage, with no link: pairs met and verified are few."""
    passage = prose(80, 93)
    rows = [(k, passage + " " + " ".join(f"own{k}x{j}" for j in range(13))) for k in range(2000)]
    met, verified = spied(monkeypatch, "counted"), spied(monkeypatch, "verified")
    out = jaccard.similarity_components(docs_of(spark, rows), 4, 85).collect()
    assert [r["component_id"] for r in sorted(out)] == list(range(2000))
    assert sum(met) <= 4000 and sum(verified) <= 8000


def test_families_without_their_original(spark, monkeypatch):
    """Near copies with one to four edits, whose original isn't there, like brute force; pairs are far fewer than all."""
    base = prose(81, 150)
    rows = [(k, edited(base, 1 + k % 4, 900 + k)) for k in range(400)]
    verified = spied(monkeypatch, "verified")
    out = jaccard.similarity_components(docs_of(spark, rows), 4, 85, cost=8).collect()
    got = sorted((False, r["doc_id"], r["n_shingles"], False, r["component_id"]) for r in out)
    assert got == brute(rows, 4, 85)
    assert sum(verified) < 400 * 399 // 2 // 8


def test_differences_say_the_same_as_sets():
    """Two sets link exactly if their common differences from a third make up for both excesses; else both link with it."""
    import numpy as np

    rng = random.Random(6)
    rule = jaccard.Rule(4, 85)
    for _ in range(2000):
        p = set(range(rng.randint(1, 90)))
        a, b = ({x for x in p if rng.random() > 0.06} | set(rng.sample(range(100, 112), rng.randint(0, 5))) for _ in range(2))
        if not a or not b:
            continue
        excess = [185 * len(s ^ p) - 15 * len(s) for s in (a, b)]
        linked = rule.linked(len(a & b), len(a), len(b))
        assert linked == (2 * 185 * len((a ^ p) & (b ^ p)) >= sum(excess))
        if sum(excess) <= 0:
            assert all(rule.linked(len(s & p), len(s), len(p)) for s in (a, b))
        assert np.all([(e <= 15 * len(p)) == rule.linked(len(s & p), len(s), len(p)) for e, s in zip(excess, (a, b))])


def test_keys_of_linked_sets_always_meet():
    """At every level two sets that link share one of the rarest keys, whatever the frequencies."""
    import numpy as np

    rule, rng = jaccard.Rule(4, 85), random.Random(3)
    for trial in range(300):
        n = rng.randint(1, 120)
        a = set(rng.sample(range(10**6), n))
        b = set(a)
        for _ in range(rng.randint(0, max(1, n // 8))):
            if rng.random() < 0.5 and len(b) > 1:
                b.discard(rng.choice(sorted(b)))
            else:
                b.add(rng.randrange(10**6))
        if not rule.linked(len(a & b), len(a), len(b)):
            continue
        frequency = {x: rng.choice([2, 2, 3, 50]) if x in a & b else 1 for x in a | b}
        for part in (0.0, jaccard.START, *(part for part, _ in jaccard.LEVELS)):
            keys = []
            for s in (a, b):
                prefix = sorted(s)[: rule.prefix(len(s), part)]
                keys.append(set(sorted(prefix, key=lambda x: (frequency[x], x))[: rule.keys(len(s), part)]))
            assert keys[0] & keys[1], (trial, part)
    assert jaccard.START > 0
    assert len(rule.distinct(["a", "b"], WordHashes())) == 1 and len(rule.distinct([], WordHashes())) == 0
    assert np.array_equal(rule.distinct(["a"] * 9, WordHashes()), rule.distinct(["a"] * 4, WordHashes()))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)] + [(2000, k) for k in range(2001, 2100)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    import numpy as np

    ids = sorted({x for e in edges for x in e})
    at = {x: k for k, x in enumerate(ids)}
    labels = local_components(len(ids), np.array([at[a] for a, _ in edges]), np.array([at[b] for _, b in edges]))
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert out == {x: ids[labels[at[x]]] for x in ids if x not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    assert jaccard.similarity_components(docs_of(spark, [])).count() == 0


def test_columns_say_the_same_as_numbers(spark):
    from pyspark.sql import functions as F

    rule = jaccard.Rule(4, 85)
    for part in (0.0, jaccard.START, 0.2, 1.0):
        n = F.col("id")
        for r in spark.range(1, 300).select("id", rule.prefix_of(n, part).alias("p"), rule.keys_of(n, part).alias("k")).collect():
            assert (r["p"], r["k"]) == (rule.prefix(r["id"], part), rule.keys(r["id"], part))


def test_arrow_batches_are_bounded_by_bytes(spark, monkeypatch):
    """Pairs with whole sets travel in small batches, and the session is left as it was."""
    from quotewell.llm.common import BATCH_SIZE, batches_of

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    wide = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 5000) AS t")
    with batches_of(spark, 1 << 20):
        assert max(r["n"] for r in wide.mapInArrow(sizes, "n long").collect()) < 1.1 * (1 << 20)
    seen, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda *given: seen.append(spark.conf.get(BATCH_SIZE, None)) or verified(*given))
    jaccard.similarity_components(docs_of(spark, [(1, "a b c d e f"), (2, "a b c d e f g")])).collect()
    assert set(seen) == {str(jaccard.BATCH)} and spark.conf.get(BATCH_SIZE, None) is None
    spark.conf.set(BATCH_SIZE, "12345")
    try:
        with batches_of(spark, 1 << 20):
            assert spark.conf.get(BATCH_SIZE) == "12345"
    finally:
        spark.conf.unset(BATCH_SIZE)


@pytest.mark.parametrize(
    "work, row",
    [
        (jaccard.Prefixes(jaccard.Rule(5, 80)), {"doc_id": [1], "doc_hash": [2], "text": ["a b c"]}),
        (jaccard.Sets(jaccard.Rule(5, 80), b"\xff" * (1 << (jaccard.MAP_BITS - 3))), {"doc_id": [1], "doc_hash": [2], "text": ["a b c"]}),
        (toxicity.word_sets, {"doc_id": [1], "text": ["a b c"], "text_hash": [2]}),
    ],
)
def test_what_packing_keeps_in_a_worker_goes_when_it_does_other_work(work, row):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = weakref.ref(packing.encoder(path))
    assert packing.encoder(path) is encoder()  # kept between tasks
    assert sum(b.num_rows for b in work(iter([pa.RecordBatch.from_pydict(row)]))) == 1
    gc.collect()
    assert encoder() is None
