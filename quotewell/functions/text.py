"""Text cleaning and lexicon sentiment as column expressions.

Everything here works inside one row and needs no shuffle.  Decoding of
character references and the search for lexicon words run in Arrow batches in
Python, where they are many times faster than as interpreted expressions; the
rest are built-in functions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quotewell.fixed_values import BOOST_PHRASES, DAMPENING_PHRASES, LEXICON, VALENCE_DAMPING

# --- Fixed values: patterns that decide what counts as a tag and as white space
TAG = re.compile(r"<[^>]+>")
WHITE_SPACE = re.compile(r"\s+")

# The most that phrases add or take, and what a dampening phrase leaves of a score.
MOST_BOOST, DAMPED = 0.5, 0.3

# Whatever separates two words, and what stands between.
WORD_BREAK = r"[^\p{L}']+"
WORD = regex.compile(r"[\p{L}']+")


def cleaned(text: str | None) -> str:
    """Decode references, then strip tags, then collapse white space; nothing becomes empty."""
    if not text:
        return ""
    return WHITE_SPACE.sub(" ", TAG.sub("", html.unescape(text))).strip(" ")


@F.pandas_udf(StringType())
def _clean(texts: pd.Series) -> pd.Series:
    return texts.map(cleaned)


def clean_text(text: Column) -> Column:
    """Decode entities, then strip tags, then collapse white space; NULL becomes empty."""
    return _clean(text)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def keyword_boost(text: Column, phrases: Mapping[str, float] = BOOST_PHRASES, limit: float = MOST_BOOST) -> Column:
    """Sum of the weights of all phrases found anywhere in the text, within ``limit``.

    Phrases are substrings: "recalls" also counts as "recall".
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    found = [F.when(F.contains(lowered, F.lit(p)), w).otherwise(0.0) for p, w in phrases.items()]
    return clamp(reduce(lambda a, b: a + b, found, F.lit(0.0)), -limit, limit)


def is_dampened(text: Column, phrases: Sequence[str] = tuple(DAMPENING_PHRASES)) -> Column:
    """Whether any of the phrases occurs anywhere in the text."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(p)) for p in phrases], F.lit(False))


def dampen(score: Column, text: Column, phrases: Sequence[str] = tuple(DAMPENING_PHRASES), factor: float = DAMPED) -> Column:
    """The score, scaled down if the text holds a dampening phrase."""
    return F.when(is_dampened(text, phrases), score * factor).otherwise(score)


def words(text: Column) -> Column:
    """Lower-cased words of a text."""
    return F.split(F.lower(text), WORD_BREAK)


STATS = "hits int, valence double, tone double"


def found_words(text: str, lexicon: Mapping[str, tuple[float, float]]) -> tuple[int, float, float]:
    """Number of lexicon words in a text and the sums of their two weights."""
    weights = [lexicon[w] for w in WORD.findall(text.lower()) if w in lexicon]
    return len(weights), sum(v for v, _ in weights), sum(t for _, t in weights)


def lexicon_stats(text: Column, lexicon: Mapping[str, tuple[float, float]] = LEXICON) -> Column:
    """Number of lexicon words in the text and the sums of their two weights, as a struct."""
    lexicon = dict(lexicon)

    @F.pandas_udf(STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([found_words(t or "", lexicon) for t in texts], columns=["hits", "valence", "tone"])

    return stats(text)


def article_stats(
    headline: Column,
    summary: Column,
    lexicon: Mapping[str, tuple[float, float]] = LEXICON,
    boosts: Mapping[str, float] = BOOST_PHRASES,
    dampeners: Sequence[str] = tuple(DAMPENING_PHRASES),
) -> Column:
    """All that scoring needs of an article, from one pass over its cleaned headline and summary.

    Lexicon words of either part, whether either is empty, the sum of the boosts
    and whether a dampening phrase occurs in both parts taken as one text.
    """
    lexicon, boosts, dampeners = dict(lexicon), dict(boosts), list(dampeners)
    parts = [f"{part}_{field}" for part in ("head", "body") for field in STATS.split(", ")]

    @F.pandas_udf(", ".join([*parts, "head_empty boolean, body_empty boolean, boost double, dampened boolean"]))
    def stats(headlines: pd.Series, summaries: pd.Series) -> pd.DataFrame:
        rows = []
        for head, body in zip(map(cleaned, headlines), map(cleaned, summaries)):
            text = f"{head}. {body}".strip(". ").lower()
            boost = sum(weight for phrase, weight in boosts.items() if phrase in text)
            dampened = any(phrase in text for phrase in dampeners)
            rows.append((*found_words(head, lexicon), *found_words(body, lexicon), head == "", body == "", boost, dampened))
        names = [p.split()[0] for p in parts] + ["head_empty", "body_empty", "boost", "dampened"]
        return pd.DataFrame(rows, columns=names).astype({"boost": float, "head_valence": float, "body_valence": float, "head_tone": float, "body_tone": float})

    return stats(headline, summary)


def valence_score(total: Column, damping: float = VALENCE_DAMPING) -> Column:
    """Model A: the valence sum, normalised to (-1, 1)."""
    return total / F.sqrt(total * total + damping)


def tone_score(total: Column, hits: Column) -> Column:
    """Model B: mean polarity of the lexicon words found."""
    return F.when(hits > 0, total / hits).otherwise(0.0)
