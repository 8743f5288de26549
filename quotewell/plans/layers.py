"""From landed files to the stored tables, layer by layer.

Each function advances one family of tables below a root folder and returns
the tables by name.  Streams continue from their own progress,
so a call handles what has arrived since the one before, and a first call on an
empty folder makes empty tables.  Aggregates by date are recomputed for the
dates that new rows belong to: only those partitions of the validated ticks are
read, and only those of the results replaced.  Sentiment has no dates; sums,
counts and extremes are kept per symbol, and new articles are folded in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quotewell.fixed_values import SYMBOL_SECTORS
from quotewell.operators import bronze, gold, indicators, news, silver, windows
from quotewell.sources import landing, readers
from quotewell.streaming import jobs


def of_dates(ticks: DataFrame, dates: Sequence[date | None]) -> DataFrame:
    """The ticks of some dates, of a table partitioned by ``date``: literals, so that other partitions are not even listed."""
    wanted = F.col("date").isin([d for d in dates if d is not None])
    return ticks.where(wanted | F.col("date").isNull() if None in dates else wanted)


def _good(spark: SparkSession, checked: str, schema: StructType) -> DataFrame:
    """The valid ticks with their date."""
    return readers.table_so_far(spark, checked, schema).where("quality = 'silver'").drop("quality", "quarantine_reason")


def price_layers(
    spark: SparkSession,
    landed: str,
    root: str,
    sectors: DataFrame | Mapping[str, str] = SYMBOL_SECTORS,
    files_per_trigger: int | None = 1,
) -> dict[str, DataFrame]:
    """Landed ticks to bronze, silver, quarantine, candles, daily bars, sector measures and counts per rule."""

    def state(name: str) -> str:
        return f"{root}/_progress/{name}"

    daily, by_sector = f"{root}/stock_daily_summary", f"{root}/sector_performance"
    raw = bronze.bronze_prices(readers.price_stream(spark, landed, files_per_trigger))
    ticks = jobs.run_to_parquet(raw, f"{root}/stock_prices_bronze", state("bronze"))
    enriched = silver.enrich(readers.table_stream(spark, ticks, raw.schema), sectors)
    dated = enriched.withColumn("date", F.to_date("trade_time"))
    checked = jobs.run_quality(dated, f"{root}/stock_prices_checked", state("checked"), partition_by=["date"])
    schema = silver.quality_split(dated).schema
    checked_stream = readers.table_stream(spark, checked, schema)
    good_stream = checked_stream.where("quality = 'silver'")
    candles = jobs.run_candles(good_stream.drop("date"), f"{root}/stock_candles_1m", state("candles"))

    def renew(batch: DataFrame, number: int) -> None:
        """Aggregates of the dates that the batch has rows of; a repeated batch replaces the same partitions."""
        dates = [r["date"] for r in batch.select("date").distinct().collect()]  # calendar dates: some hundreds a year
        touched = of_dates(_good(batch.sparkSession, checked, schema), dates)
        landing.write_partitioned(gold.daily_ohlcv(touched), daily, whole=False)
        landing.write_partitioned(gold.sector_daily(touched), by_sector, cluster="sector", whole=False)

    jobs.run_each(good_stream, renew, state("gold"))
    rules = jobs.run_quality_counts(checked_stream, f"{root}/quality_counts", state("rules"))
    split = readers.table_so_far(spark, checked, schema)
    good = _good(spark, checked, schema)
    return {
        "stock_prices_bronze": readers.table_so_far(spark, ticks, raw.schema),
        "stock_prices_silver": good.drop("date"),
        "stock_prices_quarantine": split.where("quality = 'quarantine'").drop("quality", "date"),
        "stock_candles_1m": readers.table_so_far(spark, candles, gold.candles(good).schema),
        "stock_daily_summary": readers.table_so_far(spark, daily, gold.daily_ohlcv(good).schema),
        "sector_performance": readers.table_so_far(spark, by_sector, gold.sector_daily(good).schema),
        "quality_counts": rules,
    }


def news_layers(spark: SparkSession, landed: str, root: str, **scoring) -> dict[str, DataFrame]:
    """Landed articles to bronze, scored articles, sentiment per symbol and market mood."""

    def state(name: str) -> str:
        return f"{root}/_progress/{name}"

    raw = bronze.bronze_news(readers.news_stream(spark, landed))
    articles = jobs.run_to_parquet(raw, f"{root}/stock_news_bronze", state("bronze"))
    to_score = news.news_silver(readers.table_stream(spark, articles, raw.schema), **scoring)
    scored = jobs.run_to_parquet(to_score, f"{root}/news_sentiment_silver", state("scored"))
    new = readers.table_stream(spark, scored, to_score.schema)
    table = readers.table_so_far(spark, scored, to_score.schema)

    def add_sentiment(before: DataFrame, batch: DataFrame) -> DataFrame:
        return gold.merged_sentiment(before.unionByName(gold.sentiment_state(batch)))

    def add_mood(before: DataFrame, batch: DataFrame) -> DataFrame:
        return gold.merged_mood(before.unionByName(gold.mood_state(batch)))

    none = table.where(F.lit(False))
    symbols = jobs.run_fold(new, add_sentiment, gold.sentiment_state(none), f"{root}/_sentiment_state", state("sentiment"))
    market = jobs.run_fold(new, add_mood, gold.mood_state(none), f"{root}/_mood_state", state("mood"))
    per_symbol = landing.write_overwrite(gold.sentiment_of(symbols), f"{root}/symbol_sentiment_agg")
    mood = landing.write_overwrite(gold.mood_of(gold.merged_mood(market)), f"{root}/market_mood")
    return {
        "stock_news_bronze": readers.table_so_far(spark, articles, raw.schema),
        "news_sentiment_silver": table,
        "symbol_sentiment_agg": readers.read_table(spark, per_symbol),
        "market_mood": readers.read_table(spark, mood),
    }


def analytics_layers(spark: SparkSession, bars: DataFrame, root: str) -> dict[str, DataFrame]:
    """Stored daily bars to indicators, signals, averages, rankings and spikes."""
    computed = landing.write_overwrite(indicators.technical_indicators(bars), f"{root}/technical_indicators")
    signals = indicators.with_signal(readers.read_table(spark, computed))
    paths = {
        "technical_indicators": computed,
        "market_signals": landing.write_overwrite(signals, f"{root}/market_signals"),
    }
    for name, table in (
        ("moving_averages", windows.moving_averages(bars)),
        ("sector_rankings", windows.sector_rankings(bars)),
        ("volume_spikes", windows.volume_spikes(bars)),
    ):
        paths[name] = landing.write_partitioned(table, f"{root}/{name}")
    return {name: readers.read_table(spark, path) for name, path in paths.items()}
