"""Schemas, as DDL text, of the raw feeds and of the tables built from them."""

from __future__ import annotations

PRICE_TICK = (
    "symbol STRING NOT NULL, price DOUBLE, open DOUBLE, high DOUBLE, low DOUBLE, "
    "prev_close DOUBLE, volume BIGINT, market_cap BIGINT, timestamp STRING"
)

NEWS_ARTICLE = (
    "headline STRING, summary STRING, source STRING, url STRING, symbols ARRAY<STRING>, published_at STRING"
)

# The article as the news feed delivers it, before flattening.
NESTED_ARTICLE = (
    "id STRING, content STRUCT<id: STRING, contentType: STRING, title: STRING, summary: STRING, "
    "pubDate: STRING, provider: STRUCT<displayName: STRING, sourceId: STRING>, "
    "canonicalUrl: STRUCT<url: STRING>>"
)

SCORED_ARTICLE = (
    "headline STRING, summary STRING, source STRING, url STRING, symbols ARRAY<STRING>, "
    "published_at STRING, sentiment_score DOUBLE, sentiment_label STRING, confidence DOUBLE"
)

DAILY_BAR = (
    "symbol STRING NOT NULL, date DATE, sector STRING, day_open DOUBLE, day_high DOUBLE, day_low DOUBLE, "
    "day_close DOUBLE, total_volume BIGINT, trade_count BIGINT, avg_change_pct DOUBLE"
)

CANDLE = (
    "symbol STRING, candle_start TIMESTAMP, candle_end TIMESTAMP, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume BIGINT, trade_count BIGINT"
)

SECTOR_DAY = (
    "sector STRING, date DATE, avg_change_pct DOUBLE, total_volume BIGINT, stock_count BIGINT"
)

SYMBOL_SENTIMENT = (
    "symbol STRING NOT NULL, avg_sentiment DOUBLE, article_count BIGINT, max_sentiment DOUBLE, "
    "min_sentiment DOUBLE, most_positive STRING, most_negative STRING"
)

MARKET_MOOD = (
    "mood STRING, avg_score DOUBLE, article_count BIGINT, positive_count BIGINT, "
    "negative_count BIGINT, neutral_count BIGINT"
)

TECHNICAL_INDICATORS = (
    "symbol STRING NOT NULL, sector STRING, latest_date DATE, latest_close DOUBLE, rsi DOUBLE, "
    "macd_line DOUBLE, macd_signal DOUBLE, macd_histogram DOUBLE, bb_upper DOUBLE, bb_middle DOUBLE, "
    "bb_lower DOUBLE"
)

MARKET_SIGNALS = TECHNICAL_INDICATORS + ", signal STRING"

MOVING_AVERAGES = (
    "symbol STRING NOT NULL, sector STRING, date DATE, day_close DOUBLE, total_volume BIGINT, "
    "sma_5 DOUBLE, sma_20 DOUBLE, sma_50 DOUBLE, vwap_20 DOUBLE"
)

SECTOR_RANKINGS = (
    "symbol STRING NOT NULL, sector STRING, date DATE, avg_change_pct DOUBLE, sector_rank INT, "
    "sector_size INT, percentile DOUBLE"
)

VOLUME_SPIKES = (
    "symbol STRING NOT NULL, sector STRING, date DATE, total_volume BIGINT, avg_volume_20d BIGINT, "
    "volume_ratio DOUBLE, is_spike BOOLEAN"
)

QUERY_LOG = (
    "query STRING, latency_seconds DOUBLE, tool_calls INT, iterations INT, answer_length INT"
)
