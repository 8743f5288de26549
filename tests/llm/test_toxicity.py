from pyspark.sql import functions as F

from quotewell.llm import toxicity
from quotewell.llm.common import texts
from tests.llm.samples import docs_of, odd_texts, prose


def corpus(spark):
    rows = [(k, prose(k, 60) + (" you moron and fool." if k % 4 == 0 else " all is well.") * 2) for k in range(120)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0), 1) for k in range(100)] + [(None, 1, 1), (5, None, 1)], "doc_id long, toxic int, words int")
    return docs_of(spark, rows), labels


def test_learns_terms_and_scores_unseen_documents(spark):
    docs, labels = corpus(spark)
    model = toxicity.learn(docs, labels)
    assert {"moron", "fool"} <= set(model.grammar.words)
    out = {r["doc_id"]: r["score"] for r in toxicity.score(texts(docs), model).collect()}
    assert all((out[k] >= 0.5) == (k % 4 == 0) for k in range(120))


def test_grammar_scores_clauses_not_words():
    grammar = toxicity.Grammar({"moron": 2.0}, {"foo": 1.0}, (3,))
    weight = lambda text: grammar.document(text, {})[0]
    plain = weight("a moron here")
    assert weight("you are a moron") > plain > weight("he said: well. not a moron") > 0
    assert weight("she wrote that it was a moron") < weight("it was a moron")
    assert weight("never mind. a moron") == plain  # the negation is in another clause
    assert weight("foolish") == 1.0 and weight("foo") == 0.0
    assert weight("we will kill you") > weight("we will kill") > 0
    assert weight("") == weight("nothing to see") == 0.0


def test_odd_rows(spark):
    docs, labels = corpus(spark)
    model = toxicity.learn(docs, labels)
    rows = odd_texts()
    out = toxicity.score(docs_of(spark, rows), model, name="#score").collect()
    assert len(out) == len(rows) and all(0 <= r["#score"] <= 1 for r in out)
    assert out[1]["#score"] == out[2]["#score"]
    assert toxicity.score(docs_of(spark, []), model, name="s").count() == 0


def test_every_term_counts_and_copies_count_once(spark):
    """The lexicon has no largest size, and words of one text are no terms however many copies it has."""
    letters = lambda k: "".join("abcdefghij"[int(c)] for c in str(k))
    many = " ".join(f"zz{letters(k)}" for k in range(21_000))
    rows = [(k, f"{many} only {letters(k)}") for k in range(6)] + [(10 + k, "a copied wuzzle") for k in range(50)] + [(60, "a copied wuzzle")] * 9
    rows += [(100 + k, f"all is well {letters(k)}") for k in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100), 1) for i in {i for i, _ in rows}], "doc_id long, toxic int, words int")
    words = toxicity.learn(docs_of(spark, rows), labels).grammar.words
    assert {f"zz{letters(k)}" for k in range(21_000)} <= set(words)
    assert "wuzzle" not in words


def test_one_label_or_none(spark):
    docs, labels = corpus(spark)
    for condition, expected in (("toxic = 0", 0.02), ("toxic = 1", 0.98), ("toxic = 7", 0.5)):
        model = toxicity.learn(docs, labels.where(condition))
        assert abs(toxicity.score(texts(docs), model).agg(F.max("score")).first()[0] - expected) < 0.01
