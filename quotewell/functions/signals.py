"""Classifications: volume category, trading signal, sentiment label, mood."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotewell.fixed_values import VOLUME_LEVELS


def volume_category(volume: Column, levels: Mapping[str, int] = VOLUME_LEVELS) -> Column:
    """Name of the highest level the volume reaches, else ``low`` (NULL is low)."""
    reached = [F.when(volume >= least, name) for name, least in levels.items()]
    return F.coalesce(*reached, F.lit("low"))


def classify_signal(rsi: Column, histogram: Column, price: Column, upper: Column, lower: Column) -> Column:
    """strong_buy / buy / hold / sell / strong_sell; hold if any input is NULL."""
    momentum = (
        F.when(rsi < 30, 2).when(rsi < 45, 1).when(rsi > 70, -2).when(rsi > 55, -1).otherwise(0)
    )
    trend = F.signum(histogram).cast("int")
    width = upper - lower
    # Position inside the band; NULL, hence no vote, when the band has no width.
    position = (price - lower) / F.when(width > 0, width)
    reversal = F.when(position < 0.15, 1).when(position > 0.85, -1).otherwise(0)
    complete = (
        rsi.isNotNull() & histogram.isNotNull() & price.isNotNull() & upper.isNotNull() & lower.isNotNull()
    )
    score = F.when(complete, momentum + trend + reversal)
    return (
        F.when(score >= 3, "strong_buy")
        .when(score >= 1, "buy")
        .when(score <= -3, "strong_sell")
        .when(score <= -1, "sell")
        .otherwise("hold")
    )


def _three_way(score: Column, threshold: float, above: str, below: str) -> Column:
    return F.when(score > threshold, above).when(score < -threshold, below).otherwise("neutral")


def sentiment_label(score: Column, threshold: float = 0.05) -> Column:
    """positive / negative / neutral."""
    return _three_way(score, threshold, "positive", "negative")


def market_tone(score: Column, threshold: float) -> Column:
    """bullish / bearish / neutral."""
    return _three_way(score, threshold, "bullish", "bearish")
