"""Sentiment of articles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.fixed_values import BOOST_PHRASES, DAMPENING_PHRASES, LEXICON
from quotewell.functions.signals import sentiment_label
from quotewell.functions.text import (
    DAMPED,
    MOST_BOOST,
    article_stats,
    clamp,
    lexicon_stats,
    tone_score,
    valence_score,
    words,
)
from quotewell.operators.silver import ARTICLE_RULES, valid

Lexicon = Mapping[str, tuple[float, float]]


def _models(stats: str) -> tuple[Column, Column]:
    return (
        valence_score(F.col(f"{stats}.valence")),
        tone_score(F.col(f"{stats}.tone"), F.col(f"{stats}.hits")),
    )


def polarity(
    docs: DataFrame, lexicon: Lexicon = LEXICON, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Both model scores per text, computed inside the row."""
    model_a, model_b = _models("_stats")
    return docs.withColumn("_stats", lexicon_stats(F.coalesce(text, F.lit("")), lexicon)).select(
        *keep, model_a.alias("model_a"), model_b.alias("model_b")
    )


def polarity_by_table(
    docs: DataFrame, lexicon: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The same scores for a lexicon kept in a table (``word, valence, tone``) of any size.

    Words are counted per text before they meet the lexicon, so a word common to
    all texts costs one row per text; how to join is left to Spark, which knows
    the sizes when it comes to it.
    """
    found = docs.select(key, F.explode(words(F.col(text))).alias("word"))
    hits = found.groupBy(key, "word").agg(F.count("*").alias("_times")).join(lexicon, "word")
    stats = hits.groupBy(key).agg(
        F.sum("_times").alias("hits"),
        F.sum(F.col("_times") * F.col("valence")).alias("valence"),
        F.sum(F.col("_times") * F.col("tone")).alias("tone"),
    )
    return (
        docs.select(key)
        .join(stats, key, "left")
        .select(
            key,
            F.coalesce(valence_score(F.col("valence")), F.lit(0.0)).alias("model_a"),
            F.coalesce(F.col("tone") / F.col("hits"), F.lit(0.0)).alias("model_b"),
        )
    )


def _as_words(text: Column) -> Column:
    """The words of a text with one space between them and at both ends, for finding whole words."""
    return F.concat(F.lit(" "), F.array_join(F.filter(words(text), lambda w: w != ""), " "), F.lit(" "))


def phrases_found(docs: DataFrame, phrases: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, phrase) for each phrase of a table (``phrase``) of any size that occurs in a text as a run of whole words.

    No text is compared with every phrase, nor with those it has a word of: its
    distinct runs of as many words as some phrase has meet the phrases by
    equality, so what is shuffled or kept follows the words, whatever words the
    phrases share.  Every length of phrase is one more pass over a text.  Case and
    what stands between words don't count; phrases that are equal in that sense
    are one.  ``key`` must tell texts apart.  Null and empty texts and phrases
    match nothing.
    """
    listed = phrases.select(F.trim(_as_words(F.col("phrase"))).alias("phrase")).where("phrase <> ''").distinct()
    sizes = F.size(F.split("phrase", " "))
    lengths = sorted(r["n"] for r in listed.select(sizes.alias("n")).distinct().collect())  # at most as many as the longest phrase has words
    last = F.size("_words") - F.col("_n") + 1
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice("_words", i, F.col("_n")), " "))
    held = (
        docs.where(F.col(key).isNotNull())
        .select(key, F.filter(words(F.col(text)), lambda w: w != "").alias("_words"))
        .select(key, "_words", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")).alias("_n"))
        .where(last >= 1)
        .select(key, F.explode(F.array_distinct(runs)).alias("phrase"))
    )
    return held.join(listed, "phrase").select(key, "phrase")


def boost_by_table(
    docs: DataFrame, phrases: DataFrame, text: str = "text", key: str = "doc_id", limit: float = MOST_BOOST
) -> DataFrame:
    """(key, boost, phrases): the weights of the phrases of a table (``phrase, weight``) found in each text, within ``limit``, and their number.

    The weights of phrases that differ only in case or in what stands between
    their words add up.  Texts without a phrase have 0.
    """
    weights = (
        phrases.select(F.trim(_as_words(F.col("phrase"))).alias("phrase"), "weight").groupBy("phrase").agg(F.sum("weight").alias("weight"))
    )
    found = phrases_found(docs, phrases, text, key).join(weights, "phrase")
    sums = found.groupBy(key).agg(F.sum("weight").alias("_boost"), F.count("*").alias("_phrases"))
    return (
        docs.select(key)
        .join(sums, key, "left")
        .select(
            key,
            clamp(F.coalesce("_boost", F.lit(0.0)), -limit, limit).alias("boost"),
            F.coalesce("_phrases", F.lit(0)).cast("long").alias("phrases"),
        )
    )


def dampen_by_table(
    scored: DataFrame, phrases: DataFrame, score: str = "score", text: str = "text", key: str = "doc_id", factor: float = DAMPED
) -> DataFrame:
    """(key, score), scaled down where the text holds any phrase of a table (``phrase``) as a run of whole words."""
    found = phrases_found(scored, phrases, text, key).select(key).distinct().withColumn("_held", F.lit(True))
    scaled = F.when(F.col("_held"), F.col(score) * factor).otherwise(F.col(score))
    return scored.select(key, score).join(found, key, "left").select(key, scaled.alias(score))


def score_articles(
    articles: DataFrame,
    lexicon: Lexicon = LEXICON,
    boosts: Mapping[str, float] = BOOST_PHRASES,
    dampeners: Sequence[str] = tuple(DAMPENING_PHRASES),
    weights: tuple[float, float] | None = None,
) -> DataFrame:
    """Add ``sentiment_score``, ``sentiment_label`` and ``confidence``.

    Without ``weights`` headline and summary are scored as one text.  With
    weights, e.g. (0.6, 0.4), each is scored alone and the model scores are
    averaged; an article with only one of them counts that one.
    """
    part = lambda name: F.col(f"_stats.{name}")
    measured = articles.withColumn(
        "_stats", article_stats(F.col("headline"), F.col("summary"), lexicon, boosts, dampeners)
    )
    empty = part("head_empty") & part("body_empty")
    hits, valence, tone = ((part(f"head_{f}"), part(f"body_{f}")) for f in ("hits", "valence", "tone"))
    if weights is None:
        model_a, model_b = valence_score(valence[0] + valence[1]), tone_score(tone[0] + tone[1], hits[0] + hits[1])
    else:
        on_head, on_body = weights
        model_a, model_b = (
            F.when(part("body_empty"), h).when(part("head_empty"), b).otherwise(h * on_head + b * on_body)
            for h, b in (
                [valence_score(v) for v in valence],
                [tone_score(t, n) for t, n in zip(tone, hits)],
            )
        )
    raw = F.col("_a") * 0.6 + F.col("_b") * 0.4 + clamp(part("boost"), -MOST_BOOST, MOST_BOOST)
    dampened = F.when(part("dampened"), raw * DAMPED).otherwise(raw)
    modelled = measured.withColumns({"_a": model_a, "_b": model_b}).withColumn("_score", clamp(dampened, -1.0, 1.0))
    score = F.when(empty, 0.0).otherwise(F.col("_score"))
    agreement = clamp(1 - F.abs(F.col("_a") - F.col("_b")), 0.0, 1.0)
    return modelled.select(
        *articles.columns,
        F.round(score, 4).alias("sentiment_score"),
        sentiment_label(score).alias("sentiment_label"),
        F.when(empty, 1.0).otherwise(F.round(agreement, 4)).alias("confidence"),
    )


def news_silver(
    bronze: DataFrame,
    lexicon: Lexicon = LEXICON,
    boosts: Mapping[str, float] = BOOST_PHRASES,
    dampeners: Sequence[str] = tuple(DAMPENING_PHRASES),
) -> DataFrame:
    """Valid articles with their weighted sentiment; invalid ones are dropped before scoring."""
    return score_articles(valid(bronze, ARTICLE_RULES), lexicon, boosts, dampeners, weights=(0.6, 0.4))
