"""Raw landing: keep every column, add the load time and the parsed event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell import schemas


def bronze_prices(raw: DataFrame) -> DataFrame:
    """Raw ticks plus ``ingest_time`` and ``trade_time`` (NULL when unreadable)."""
    return raw.withColumns(
        {"ingest_time": F.current_timestamp(), "trade_time": F.try_to_timestamp("timestamp")}
    )


def bronze_news(raw: DataFrame) -> DataFrame:
    """Raw articles plus ``ingest_time`` and ``pub_time`` (NULL when unreadable)."""
    return raw.withColumns(
        {"ingest_time": F.current_timestamp(), "pub_time": F.try_to_timestamp("published_at")}
    )


def priced_only(quotes: DataFrame) -> DataFrame:
    """Drop polled quotes that carry no price, and stamp the rest with one poll time."""
    return quotes.where(F.col("price").isNotNull()).withColumn(
        "timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )


def normalize_news(feed: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten nested article JSON into the article schema.

    ``feed`` has a ``symbol`` column (the symbol the article was fetched for) and
    the JSON text.  Articles without content or title are dropped.
    """
    article = F.from_json(payload, schemas.NESTED_ARTICLE)

    def present(path: str, default: str) -> Column:
        return F.coalesce(F.col(path), F.lit(default))

    return (
        feed.withColumn("_content", article["content"])
        .where(F.col("_content.title").isNotNull())
        .select(
            F.col("_content.title").alias("headline"),
            present("_content.summary", "").alias("summary"),
            present("_content.provider.displayName", "Unknown").alias("source"),
            present("_content.canonicalUrl.url", "").alias("url"),
            F.array("symbol").alias("symbols"),
            present("_content.pubDate", "").alias("published_at"),
            *keep,
        )
    )


def dedupe_news(articles: DataFrame, order: tuple[str, ...], key: str = "headline") -> DataFrame:
    """The first article per headline, first by the ``order`` columns.

    A minimum per headline, not a window: copies of one headline fold together
    before the shuffle, so a headline with a third of all rows stays cheap.
    """
    rest = [c for c in articles.columns if c != key]
    return (
        articles.groupBy(key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
        .select(key, "_first.*")
        .select(*articles.columns)
    )
