"""Cleaning and sentiment."""

import html
import random
import re
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from quotewell.fixed_values import BOOST_PHRASES, LEXICON
from quotewell.functions import text
from quotewell.operators import news

SAMPLES = [
    "a &amp; b", "&amp;lt;", "&#39;x&#x27;", "&#8217;", "&ampfoo", "&notit;", "&notin;", "&", "&&", "&;", "&#;", "&#x;",
    "&#xD800;", "&#1114112;", "&#99999999999999;", "&#0;", "&#128;", "&#x81;", "&#1;", "&#13;a", "&#65534;", "&#x1F600;",
    "&hellip;&mdash", "&fjlig;", "x&copy2024", "&#x26;lt;", "& amp;", "&AMP;", "&am", "", "&#00000000000000000065;z",
]


def test_entities_equal_standard_library(spark):
    rng = random.Random(1)
    noise = ["".join(rng.choice("&#;xXaAmplt<> \n19Fgcoy") for _ in range(30)) for _ in range(500)]
    cases = SAMPLES + noise + [f"&{name}z" for name in html5]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    for row in df.select("t", text.clean_text(F.col("t")).alias("u")).collect():
        assert row.u == re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", html.unescape(row.t))).strip(" "), row.t


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("<div>Harbour <i>line</i> opens</div>", "Harbour line opens"),
        ("  Grain \n\n prices\t ease ", "Grain prices ease"),
        ("AT&amp;T &lt;b&gt;up&lt;/b&gt;", "AT&T up"),
        ("a&nbsp; b　", "a b"),
        ("5 < 6", "5 < 6"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_text(spark, raw, clean):
    assert spark.createDataFrame([(raw,)], "t string").select(text.clean_text(F.col("t"))).first()[0] == clean


def test_clean_text_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in pages.select("html", text.clean_text(F.col("html")).alias("clean")).collect():
        expected = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", html.unescape(row.html))).strip()
        assert row.clean == expected


@pytest.mark.parametrize(
    "value, boost",
    [
        ("Mill BEATS earnings", 0.15),
        ("Maker recalls kettles", -0.3),  # "recalls" holds "recall" too
        ("record revenue, record profits, all-time high, strong buy", 0.5),
        ("fraud, bankruptcy and crashes", -0.5),
        ("nothing here", 0.0),
        (None, 0.0),
    ],
)
def test_keyword_boost(spark, value, boost):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(text.keyword_boost(F.col("t"))).first()[0] == pytest.approx(boost)


def test_every_phrase_counts_once(spark):
    for phrase, weight in BOOST_PHRASES.items():
        inside = sum(w for p, w in BOOST_PHRASES.items() if p in phrase)
        df = spark.createDataFrame([(f"{phrase} and {phrase}",)], "t string")
        assert df.select(text.keyword_boost(F.col("t"))).first()[0] == pytest.approx(inside), (phrase, weight)


def test_dampening_matches_inside_words(spark):
    df = spark.createDataFrame([("Fed sees inflation cool",), ("Fed sees prices cool",)], "t string")
    assert [r[0] for r in df.select(text.is_dampened(F.col("t"))).collect()] == [True, False]


def score(spark, headlines, **options):
    df = spark.createDataFrame([(h, "") for h in headlines], "headline string, summary string")
    return news.score_articles(df, **options).collect()


POSITIVE = [
    "Harbour operator beats forecast, orders surge in spring",
    "Grain trader at all-time high after strong harvest",
    "Shipyard books record profits, great outlook",
    "Brokers agree on strong buy for the rail group",
]
NEGATIVE = [
    "Bicycle maker recalls its whole winter range over brakes",
    "Airline warns of deep loss as bookings plunge",
    "Lender under investigation for fraud at two branches",
    "House cuts glass maker to sell, sees weak demand",
]
FLAT = [
    "Central bank publishes minutes on Thursday",
    "Grocer names date of general meeting",
    "Exchange closed on Monday",
]


@pytest.mark.parametrize("weights", [None, (0.6, 0.4)])
def test_headlines_have_expected_signs(spark, weights):
    rows = score(spark, POSITIVE + NEGATIVE + FLAT, weights=weights)
    assert [r.sentiment_label for r in rows[:4]] == ["positive"] * 4
    assert [r.sentiment_label for r in rows[4:8]] == ["negative"] * 4
    assert all(abs(r.sentiment_score) <= 0.3 for r in rows[8:])
    assert all(-1 <= r.sentiment_score <= 1 and 0 <= r.confidence <= 1 for r in rows)


@pytest.mark.parametrize("weights", [None, (0.6, 0.4)])
def test_empty_articles_are_neutral(spark, weights):
    df = spark.createDataFrame([("", None), (None, None), (" \n\t", "<p></p>")], "headline string, summary string")
    for row in news.score_articles(df, weights=weights).collect():
        assert (row.sentiment_score, row.sentiment_label, row.confidence) == (0.0, "neutral", 1.0)


def test_summary_counts(spark):
    head = "Ferry line holds meeting"
    body = "Passengers at an all-time high, record profits, great gains ahead."
    df = spark.createDataFrame([(head, ""), (head, body)], "headline string, summary string")
    without, with_summary = [r.sentiment_score for r in news.score_articles(df).collect()]
    assert with_summary > without


def test_weights_against_formula(spark):
    df = spark.createDataFrame([("great gains", "bad losses")], "headline string, summary string")
    row = news.score_articles(df, weights=(0.6, 0.4)).first()

    def models(words):
        valence, tone = (sum(LEXICON[w][i] for w in words) for i in (0, 1))
        return valence / (valence**2 + 15) ** 0.5, tone / len(words)

    (a1, b1), (a2, b2) = models(["great", "gains"]), models(["bad", "losses"])
    a, b = 0.6 * a1 + 0.4 * a2, 0.6 * b1 + 0.4 * b2
    assert row.sentiment_score == pytest.approx(0.6 * a + 0.4 * b, abs=1e-4)
    assert row.confidence == pytest.approx(1 - abs(a - b), abs=1e-4)


def test_long_text(spark):
    (row,) = score(spark, ["Revenue increased with strong gains. " * 20_000])
    assert row.sentiment_label == "positive" and row.sentiment_score <= 1


def test_lexicon_table_equals_literal(spark):
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate(POSITIVE + NEGATIVE + FLAT + ["", "good Good GOOD bad"])], "doc_id int, text string"
    )
    table = spark.createDataFrame([(w, *v) for w, v in LEXICON.items()], "word string, valence double, tone double")

    def rounded(df):
        return [(r.doc_id, round(r.model_a, 9), round(r.model_b, 9)) for r in df.orderBy("doc_id").collect()]

    assert rounded(news.polarity(docs)) == rounded(news.polarity_by_table(docs, table))


def test_phrase_table_finds_whole_words_anywhere(spark):
    docs = spark.createDataFrame(
        [(1, "Shares rally, and rally on. Guidance cut!"), (2, "No guidance: cutters only"), (3, None), (4, ""), (5, "rally " * 50), (6, "and on")],
        "doc_id int, text string",
    )
    rows = [("Guidance  cut", -0.2), ("guidance cut", -0.05), ("rally and", 0.1), ("RALLY", 0.02), ("shares on", 9.0), ("", 1.0), (None, 1.0), ("absent rally", 1.0)]
    phrases = spark.createDataFrame(rows, "phrase string, weight double")
    found = {(r.doc_id, r.phrase) for r in news.phrases_found(docs, phrases).collect()}
    assert found == {(1, "guidance cut"), (1, "rally and"), (1, "rally"), (5, "rally")}
    boosts = {r.doc_id: (round(r.boost, 9), r.phrases) for r in news.boost_by_table(docs, phrases).collect()}
    assert boosts == {1: (-0.13, 3), 2: (0.0, 0), 3: (0.0, 0), 4: (0.0, 0), 5: (0.02, 1), 6: (0.0, 0)}
    scored = docs.withColumn("score", F.lit(1.0))
    damped = {r.doc_id: r.score for r in news.dampen_by_table(scored, phrases.where("weight < 0"), factor=0.5).collect()}
    assert damped == {1: 0.5, 2: 1.0, 3: 1.0, 4: 1.0, 5: 1.0, 6: 1.0}


def test_phrase_table_equals_a_plain_search(spark):
    rng = random.Random(6)
    some = "a b c d e f gg hh".split()
    texts = [(k, " ".join(rng.choices(some, k=rng.randint(0, 30)))) for k in range(80)]
    listed = sorted({" ".join(rng.choices(some, k=rng.randint(1, 4))) for _ in range(300)})
    found = news.phrases_found(spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame([(p,) for p in listed], "phrase string"))
    assert sorted(map(tuple, found.collect())) == sorted((k, p) for k, t in texts for p in listed if f" {p} " in f" {t} ")


def test_phrases_of_common_words_meet_only_texts_that_hold_them(spark):
    """No step has rows for each text and each phrase it has a word of."""
    some = [f"w{chr(97 + k // 20)}{chr(97 + k % 20)}" for k in range(60)]
    docs = spark.createDataFrame([(k, " ".join(some[k % 7 :] + some[: k % 7])) for k in range(100)], "doc_id int, text string")
    phrases = spark.createDataFrame([(f"{a} {b}",) for a in some for b in some], "phrase string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = news.phrases_found(docs, phrases)
        assert len(found.collect()) == 100 * 59
        nodes, rows = [found._jdf.queryExecution().executedPlan()], []
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(k) for k in range(node.children().size())]
            count = node.metrics().get("numOutputRows")
            rows.append(count.get().value() if count.isDefined() else 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert 100 * 59 <= max(rows) <= 2 * 100 * 60
