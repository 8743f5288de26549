import random
import re
from collections import Counter

from quotewell.llm import decontamination
from tests.llm.samples import docs_of, odd_texts, prose


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def bag(words):
    size = min(5, len(words))
    return Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if words else Counter()


def brute(docs, items):
    """(doc, item) pairs with a window of the item's size that is similar enough."""
    found = set()
    for i, text in docs:
        words = words_of(text)
        for item, other in items:
            theirs = words_of(other)
            if not theirs or not words:
                continue
            size = min(len(theirs), len(words))
            for start in range(len(words) - size + 1):
                a, b = bag(words[start : start + size]), bag(theirs)
                both = sum((a & b).values())
                if both >= 0.8 * (sum(a.values()) + sum(b.values()) - both):
                    found.add((i, item))
                    break
    return found


def test_like_brute_force(spark):
    rng = random.Random(6)
    items = [(k, prose(500 + k, 12 + 4 * k)) for k in range(12)] + [(50, "only two"), (51, None), (52, ""), (53, prose(503, 24)), (53, prose(999, 30))]
    docs = [(i, t) for i, t in odd_texts() if t is None or len(t) < 20_000]
    for k in range(60):
        words = items[k % 12][1].split()
        if k % 4 == 1:
            words[rng.randrange(len(words))] = "changed"
        elif k % 4 == 2:
            words = words[rng.randrange(4) :]
        elif k % 4 == 3:
            words = [w.upper() + "," for w in words]
        docs.append((100 + k, f"{prose(k, 15)} {' '.join(words)} {prose(1000 + k, 10)}" if k % 5 else " ".join(words)))
    docs.append((300, "it was Only, two!"))
    table = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in items], "item_id long, text string, words int, fingerprint long, other string")
    out = decontamination.leaks(docs_of(spark, docs), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == brute(docs, items)
    text = {i: t for i, t in docs}
    for r in out:
        if r["similarity"] == 1.0:
            assert words_of(text[r["doc_id"]][r["begin"] : r["finish"]]) in [words_of(t) for i, t in items if i == r["item_id"]]
    kept = decontamination.without_leaks(docs_of(spark, docs), table)
    leaked = {r["doc_id"] for r in out}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in leaked)
    assert kept.columns == docs_of(spark, []).columns


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontamination.leaks(docs_of(spark, []), items).count() == 0
    assert decontamination.leaks(docs_of(spark, [(1, "a b c d e f")]), items.where("false")).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    flipped = [base ^ sum(1 << b for b in rng.sample(range(64), n)) for n in range(decontamination.RADIUS + 1) for _ in range(8)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    schema = "name int, fingerprint long"
    left = decontamination.blocks(spark.createDataFrame([(0, signed(base))], schema))
    right = decontamination.blocks(spark.createDataFrame([(k, signed(x)) for k, x in enumerate(flipped)], schema))
    met = left.join(right.withColumnRenamed("name", "other"), ["block", "value"]).select("other").distinct()
    assert met.count() == len(flipped)
