"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.functions import text
from quotewell.functions.signals import volume_category
from quotewell.operators import bronze, gold, indicators, news, pieces, serving, silver, windows
from quotewell.plans import layers
from quotewell.plans.parameters import BOOSTS, DAMPENERS, FIRST_SYMBOL, LEXICON, SECOND_SYMBOL
from quotewell.session import scratch_dir
from quotewell.sources import driver_tables as src
from quotewell.sources import landing, readers
from quotewell.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name; timestamps are read as UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder once, for queries that read it several times."""
    return readers.read_table(spark, landing.write_overwrite(df, scratch_dir(spark, label)))


def rounded(df: DataFrame, *columns: str, digits: int = 12) -> DataFrame:
    """Means rounded beyond what the order of adding up decides."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- Tables the queries start from ------------------------------------------


def bronze_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_prices(src.raw_ticks(spark, sf_dir)).drop("ingest_time")


def enriched_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich(bronze_of(spark, sf_dir), src.sectors(spark, sf_dir))


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.valid(enriched_of(spark, sf_dir))


def spread_over(spark: SparkSession) -> int:
    """Into how many pieces queries deal the text tables, which come as files that cannot be cut."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scored_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.news_silver(src.raw_news(spark, sf_dir, spread_over(spark)), LEXICON, BOOSTS, DAMPENERS)


def articles_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.normalize_news(src.news_feed(spark, sf_dir), keep=("doc_id",))


def latest_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, serving.latest_slice(src.bars(spark, sf_dir)), "latest-bars")


# --- Sources and sinks ------------------------------------------------------


@query
def src_price_stream(spark, sf_dir):
    landed = landing.write_ndjson(src.raw_ticks(spark, sf_dir), scratch_dir(spark, "landed-prices"))
    stream = bronze.bronze_prices(readers.price_stream(spark, landed, files_per_trigger=None)).drop("ingest_time")
    out = jobs.run_to_parquet(stream, scratch_dir(spark, "bronze-prices"), scratch_dir(spark, "bronze-prices-state"))
    return readers.read_table(spark, out)


@query
def src_news_stream(spark, sf_dir):
    landed = landing.write_overwrite(src.raw_news(spark, sf_dir), scratch_dir(spark, "landed-news"))
    stream = bronze.bronze_news(readers.news_stream(spark, landed))
    out = jobs.run_to_parquet(stream, scratch_dir(spark, "bronze-news"), scratch_dir(spark, "bronze-news-state"))
    return readers.read_table(spark, out).select("headline", "summary", "source", "url", "published_at", "pub_time")


@query
def sink_ndjson(spark, sf_dir):
    path = landing.write_ndjson(src.raw_ticks(spark, sf_dir), scratch_dir(spark, "ndjson"))
    return spark.read.schema(src.raw_ticks(spark, sf_dir).schema).json(path)


@query
def src_json_inferred(spark, sf_dir):
    path = landing.write_ndjson(src.raw_ticks(spark, sf_dir), scratch_dir(spark, "ndjson"))
    return readers.read_json_inferred(spark, path).select(*src.raw_ticks(spark, sf_dir).columns)


@query
def staging_append(spark, sf_dir):
    """Articles appended to a landing table, which is then read as files."""
    path = scratch_dir(spark, "staging")
    table = path.rpartition("/")[2].replace("-", "_")
    landing.create_news_staging(spark, table, path)
    landing.append_to_staging(articles_of(spark, sf_dir), table)
    spark.sql(f"DROP TABLE {table}")  # the catalogue's entry; the files stay
    return readers.read_table(spark, path)


@query
def sink_partitioned(spark, sf_dir):
    daily = gold.daily_ohlcv(silver_of(spark, sf_dir))
    path = landing.write_partitioned(daily, scratch_dir(spark, "by-date"))
    return rounded(readers.read_table(spark, path), "avg_change_pct")


@query
def layout_by_symbol(spark, sf_dir):
    path = landing.write_clustered(windows.volume_spikes(src.bars(spark, sf_dir)), scratch_dir(spark, "by-symbol"))
    return readers.read_table(spark, path)


@query
def history_profile(spark, sf_dir):
    return landing.history_profile(src.bars(spark, sf_dir))


@query
def table_profile(spark, sf_dir):
    """Row counts of the stored tables."""
    bars = stored(spark, src.bars(spark, sf_dir), "profiled-bars")
    return landing.table_profile(
        {
            "stock_prices_silver": silver_of(spark, sf_dir),
            "stock_daily_summary": bars,
            "moving_averages": windows.moving_averages(bars),
            "volume_spikes": windows.volume_spikes(bars),
        }
    )


# --- Bronze and silver ------------------------------------------------------


@query
def bronze_prices(spark, sf_dir):
    return bronze_of(spark, sf_dir)


@query
def priced_only(spark, sf_dir):
    return bronze.priced_only(src.raw_ticks(spark, sf_dir)).drop("timestamp")


@query
def bronze_news(spark, sf_dir):
    raw = src.raw_news(spark, sf_dir).drop("symbols")
    return bronze.bronze_news(raw).drop("ingest_time")


@query
def news_normalize(spark, sf_dir):
    return articles_of(spark, sf_dir).withColumn("symbol", F.col("symbols")[0]).drop("symbols")


@query
def news_dedupe(spark, sf_dir):
    articles = articles_of(spark, sf_dir).withColumn("symbol", F.col("symbols")[0]).drop("symbols")
    return bronze.dedupe_news(articles, order=("symbol", "doc_id"))


@query
def silver_enrich(spark, sf_dir):
    return enriched_of(spark, sf_dir)


@query
def volume_bucket(spark, sf_dir):
    volumes = src.given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return volumes.withColumn(
        "volume_category", volume_category(F.col("l_quantity"), {"very_high": 40, "high": 25, "medium": 10})
    )


@query
def silver_valid(spark, sf_dir):
    return silver_of(spark, sf_dir)


@query
def silver_quarantine(spark, sf_dir):
    return silver.quarantine(enriched_of(spark, sf_dir))


@query
def quarantine_detail(spark, sf_dir):
    """Rejected rows with the value that a rule rejects."""
    return silver.quarantine(enriched_of(spark, sf_dir), detail=True)


@query
def quality_split(spark, sf_dir):
    return (
        silver.quality_split(enriched_of(spark, sf_dir))
        .groupBy("quality", "quarantine_reason", "sector")
        .agg(F.count("*").alias("row_count"), F.sum("volume").alias("total_volume"))
    )


@query
def quality_report(spark, sf_dir):
    return silver.quality_report(bronze_of(spark, sf_dir))


@query
def news_valid(spark, sf_dir):
    return silver.valid(src.raw_news(spark, sf_dir), silver.ARTICLE_RULES).drop("symbols")


# --- Aggregates -------------------------------------------------------------


@query
def daily_ohlcv(spark, sf_dir):
    daily = gold.daily_ohlcv(silver_of(spark, sf_dir))
    return rounded(daily, "avg_change_pct")


@query
def daily_bars(spark, sf_dir):
    """Bars of trades that share one time, ordered by tie keys."""
    return src.bars(spark, sf_dir)


@query
def candles_1m(spark, sf_dir):
    return gold.candles(silver_of(spark, sf_dir))


@query
def sector_daily(spark, sf_dir):
    return rounded(gold.sector_daily(silver_of(spark, sf_dir)), "avg_change_pct")


@query
def sector_extremes(spark, sf_dir):
    return rounded(gold.sector_extremes(silver_of(spark, sf_dir)), "avg_change_pct")


@query
def symbol_sentiment(spark, sf_dir):
    scored = scored_news(spark, sf_dir)
    return rounded(gold.symbol_sentiment(scored, order=("published_at", "doc_id")), "avg_sentiment")


@query
def market_mood(spark, sf_dir):
    return rounded(gold.market_mood(scored_news(spark, sf_dir), threshold=0.02), "avg_score")


@query
def market_mood_default(spark, sf_dir):
    return rounded(gold.market_mood(scored_news(spark, sf_dir)), "avg_score")


@query
def signal_distribution(spark, sf_dir):
    return gold.signal_distribution(indicators.market_signals(src.bars(spark, sf_dir)))


# --- Windows ----------------------------------------------------------------


@query
def moving_averages(spark, sf_dir):
    return windows.moving_averages(src.bars(spark, sf_dir))


@query
def sector_rankings(spark, sf_dir):
    return windows.sector_rankings(src.bars(spark, sf_dir))


@query
def volume_spikes(spark, sf_dir):
    return windows.volume_spikes(src.bars(spark, sf_dir))


@query
def daily_change(spark, sf_dir):
    return windows.daily_change(src.bars(spark, sf_dir).select("symbol", "date", "day_close"))


# --- Indicators -------------------------------------------------------------


@query
def rsi(spark, sf_dir):
    return indicators.rsi(src.bars(spark, sf_dir))


@query
def ema(spark, sf_dir):
    return rounded(indicators.ema(src.bars(spark, sf_dir), 12), "ema_12", digits=4)


@query
def macd(spark, sf_dir):
    return indicators.macd(src.bars(spark, sf_dir))


@query
def bollinger(spark, sf_dir):
    return indicators.bollinger(src.bars(spark, sf_dir))


@query
def classify_signal(spark, sf_dir):
    return indicators.market_signals(src.bars(spark, sf_dir)).select("symbol", "signal")


@query
def technical_indicators(spark, sf_dir):
    return indicators.technical_indicators(src.bars(spark, sf_dir))


@query
def market_signals(spark, sf_dir):
    return indicators.market_signals(src.bars(spark, sf_dir))


@query
def market_signals_short(spark, sf_dir):
    """Signals of symbols whose history is too short for some indicators."""
    return indicators.market_signals(src.part_bars(spark, sf_dir))


# --- Series without a daily bound -------------------------------------------

#: Candles are cut into stretches of so many days.
_WEEK = 7


def _candle_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.candle_bars(gold.candles(silver_of(spark, sf_dir)))


@query
def candle_averages(spark, sf_dir):
    """Moving averages over one-minute candles; 49 rows before each are needed."""
    averages = pieces.over_blocks(_candle_bars(spark, sf_dir), windows.moving_averages, halo=49, width=_WEEK)
    return averages.drop("sector")


@query
def candle_spikes(spark, sf_dir):
    """Volume of one-minute candles against the twenty before."""
    return pieces.over_blocks(_candle_bars(spark, sf_dir), windows.volume_spikes, halo=20, width=_WEEK).drop("sector")


@query
def candle_change(spark, sf_dir):
    """Change from candle to candle."""
    bars = _candle_bars(spark, sf_dir).select("symbol", "date", "day_close")
    return pieces.over_blocks(bars, windows.daily_change, halo=1, width=_WEEK)


@query
def candle_ema(spark, sf_dir):
    return rounded(indicators.ema(_candle_bars(spark, sf_dir), 12, width=_WEEK), "ema_12", digits=4)


@query
def candle_signals(spark, sf_dir):
    """Indicators and signal per symbol from its one-minute candles."""
    return indicators.market_signals(_candle_bars(spark, sf_dir), width=_WEEK).drop("sector")


# --- Text -------------------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    return src.given(spark, sf_dir, "pages", spread_over(spark)).select("page_id", text.clean_text(F.col("html")).alias("clean"))


@query
def keyword_boost(spark, sf_dir):
    boost = text.keyword_boost(F.col("text"), BOOSTS)
    return src.given(spark, sf_dir, "documents").select("doc_id", F.round(boost, 4).alias("boost"))


@query
def dampen(spark, sf_dir):
    score = text.dampen(F.col("n_chars") / 1000.0, F.col("text"), DAMPENERS)
    return src.given(spark, sf_dir, "documents").select("doc_id", F.round(score, 6).alias("score"))


@query
def polarity(spark, sf_dir):
    return rounded(news.polarity(src.given(spark, sf_dir, "documents", spread_over(spark)), LEXICON), "model_a", "model_b")


@query
def polarity_by_table(spark, sf_dir):
    """The same with the lexicon as a table: every word of a benchmark item, weighted by its length."""
    items = src.given(spark, sf_dir, "benchmark").select(F.explode(text.words(F.col("text"))).alias("word"))
    lexicon = (
        items.where("length(word) > 3")
        .distinct()
        .select(
            "word",
            (F.length("word") % 9 - 4).cast("double").alias("valence"),
            ((F.length("word") % 9 - 4) / 4.0).alias("tone"),
        )
    )
    return rounded(news.polarity_by_table(src.given(spark, sf_dir, "documents", spread_over(spark)), lexicon), "model_a", "model_b")


def _benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of two and three words of the benchmark's items, thousands, weighted by their length."""
    items = src.given(spark, sf_dir, "benchmark").select(F.filter(text.words(F.col("text")), lambda w: w != "").alias("w"))

    def runs(n: int) -> DataFrame:
        begins = F.sequence(F.lit(1), F.size("w") - (n - 1))
        return items.where(F.size("w") >= n).select(F.explode(F.transform(begins, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("phrase"))

    return runs(2).unionAll(runs(3)).distinct().withColumn("weight", (F.length("phrase") % 7 - 3) / 100.0)


@query
def boost_by_table(spark, sf_dir):
    """Boosts for a table of thousands of phrases, each looked for among the runs of as many words."""
    docs = src.given(spark, sf_dir, "documents", spread_over(spark))
    return rounded(news.boost_by_table(docs, _benchmark_phrases(spark, sf_dir)), "boost", digits=6)


@query
def dampen_by_table(spark, sf_dir):
    """Scores scaled down where a text holds one of the longer phrases of the table."""
    docs = src.given(spark, sf_dir, "documents", spread_over(spark)).withColumn("score", F.col("n_chars") / 1000.0)
    return rounded(news.dampen_by_table(docs, _benchmark_phrases(spark, sf_dir).where("length(phrase) > 20")), "score", digits=6)


@query
def score_article(spark, sf_dir):
    scored = news.score_articles(src.raw_news(spark, sf_dir, spread_over(spark)), LEXICON, BOOSTS, DAMPENERS)
    return scored.select("doc_id", "sentiment_score", "sentiment_label", "confidence")


@query
def score_article_shipped(spark, sf_dir):
    """With the lexicon and the phrases that the library comes with."""
    scored = news.score_articles(src.raw_news(spark, sf_dir, spread_over(spark)))
    return scored.select("doc_id", "sentiment_score", "sentiment_label", "confidence")


@query
def score_article_weighted(spark, sf_dir):
    scored = news.score_articles(src.raw_news(spark, sf_dir, spread_over(spark)), LEXICON, BOOSTS, DAMPENERS, weights=(0.6, 0.4))
    return scored.select("doc_id", "sentiment_score", "sentiment_label", "confidence")


@query
def news_silver(spark, sf_dir):
    return scored_news(spark, sf_dir).drop("symbols", "summary")


# --- Serving ----------------------------------------------------------------


@query
def latest_slice(spark, sf_dir):
    return serving.latest_slice(src.bars(spark, sf_dir))


@query
def latest_quote(spark, sf_dir):
    return serving.latest_quote(src.bars(spark, sf_dir))


@query
def sector_board(spark, sf_dir):
    latest = latest_bars(spark, sf_dir)
    return serving.sector_board(latest, windows.sector_rankings(latest))


@query
def sentiment_lookup(spark, sf_dir):
    sentiment = gold.symbol_sentiment(scored_news(spark, sf_dir), order=("published_at", "doc_id"))
    return serving.sentiment_lookup(rounded(sentiment, "avg_sentiment"))


@query
def mood_lookup(spark, sf_dir):
    return serving.mood_lookup(rounded(gold.market_mood(scored_news(spark, sf_dir), threshold=0.02), "avg_score"))


@query
def technical_snapshot(spark, sf_dir):
    return serving.technical_snapshot(indicators.market_signals(src.bars(spark, sf_dir))).select(
        "symbol",
        "sector",
        "date",
        "price",
        "rsi",
        *[F.col(f"macd.{c}").alias(f"macd_{c}") for c in ("line", "signal", "histogram")],
        *[F.col(f"bollinger.{c}").alias(f"bollinger_{c}") for c in ("upper", "middle", "lower")],
        "signal",
    )


@query
def compare_symbols(spark, sf_dir):
    bars = stored(spark, src.bars(spark, sf_dir), "compared-bars")
    return serving.compare_symbols(
        indicators.market_signals(bars), windows.moving_averages(bars), FIRST_SYMBOL, SECOND_SYMBOL
    )


@query
def top_movers(spark, sf_dir):
    return serving.top_movers(latest_bars(spark, sf_dir))


@query
def market_summary(spark, sf_dir):
    bars = stored(spark, src.bars(spark, sf_dir), "summed-bars")
    latest = stored(spark, serving.latest_slice(bars), "latest-bars")
    today = F.col("date") == latest.agg(F.max("date")).scalar()
    return serving.market_summary(
        latest, indicators.market_signals(bars), windows.volume_spikes(bars).where(today)
    )


@query
def dashboard_metrics(spark, sf_dir):
    bars = stored(spark, src.bars(spark, sf_dir), "shown-bars")
    return serving.dashboard_metrics(serving.latest_slice(bars), indicators.market_signals(bars))


@query
def signal_board(spark, sf_dir):
    return serving.signal_board(stored(spark, indicators.market_signals(src.bars(spark, sf_dir)), "board-signals"))


@query
def performance_board(spark, sf_dir):
    return serving.performance_board(latest_bars(spark, sf_dir))


@query
def query_log_stats(spark, sf_dir):
    return serving.query_log_stats(src.query_log(spark, sf_dir))


# --- Whole layers -----------------------------------------------------------


def _price_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    landed = landing.write_ndjson(src.raw_ticks(spark, sf_dir), scratch_dir(spark, "landed-prices"))
    root = scratch_dir(spark, "price-layers")
    return layers.price_layers(spark, landed, root, src.sectors(spark, sf_dir), files_per_trigger=None)


@query
def price_layers(spark, sf_dir):
    """Rows per table after running all price layers on landed ticks."""
    tables = _price_tables(spark, sf_dir)
    return landing.table_profile({name: table for name, table in tables.items() if name != "quality_counts"})


@query
def price_layers_daily(spark, sf_dir):
    """The daily bars that the price layers store."""
    return rounded(_price_tables(spark, sf_dir)["stock_daily_summary"], "avg_change_pct")


@query
def price_layers_sectors(spark, sf_dir):
    """The sector measures that the price layers store."""
    return rounded(_price_tables(spark, sf_dir)["sector_performance"], "avg_change_pct")


@query
def price_layers_rules(spark, sf_dir):
    """The counts per rule that the price layers keep of all ticks so far."""
    return _price_tables(spark, sf_dir)["quality_counts"]


def _news_tables(spark: SparkSession, sf_dir: str, deliveries: tuple[str, ...]) -> dict[str, DataFrame]:
    """The news layers, run after each delivery of articles, which the conditions divide."""
    landed, root = scratch_dir(spark, "landed-news"), scratch_dir(spark, "news-layers")
    for condition in deliveries:
        src.raw_news(spark, sf_dir).where(condition).write.mode("append").parquet(landed)
        tables = layers.news_layers(spark, landed, root, lexicon=LEXICON, boosts=BOOSTS, dampeners=DAMPENERS)
    return tables


@query
def news_layers(spark, sf_dir):
    """Rows per table after running all news layers on landed articles."""
    return landing.table_profile(_news_tables(spark, sf_dir, ("true",)))


#: An article of one source may come late; together these are all articles.
_IN_TURN = ("source IN ('src1', 'src2', 'src3')", "source IS NULL OR source NOT IN ('src1', 'src2', 'src3')")


@query
def news_layers_sentiment(spark, sf_dir):
    """Sentiment per symbol after two deliveries, the second folded into what the first left."""
    return rounded(_news_tables(spark, sf_dir, _IN_TURN)["symbol_sentiment_agg"], "avg_sentiment")


@query
def news_layers_mood(spark, sf_dir):
    """Market mood after two deliveries."""
    return rounded(_news_tables(spark, sf_dir, _IN_TURN)["market_mood"], "avg_score")


@query
def analytics_layers(spark, sf_dir):
    """Rows per table after running the analytics on the daily bars of the ticks."""
    daily = gold.daily_ohlcv(silver_of(spark, sf_dir))
    bars = landing.write_partitioned(daily, scratch_dir(spark, "daily-summary"))
    tables = layers.analytics_layers(spark, readers.read_table(spark, bars), scratch_dir(spark, "analytics-layers"))
    return landing.table_profile(tables)


# --- Streams ----------------------------------------------------------------


def _stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, one file or a folder of them, as a stream."""
    schema = src.given(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def _tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_prices(src.ticks_of(_stream_of(spark, sf_dir, "events"))).drop("ingest_time")


@query
def stream_candles(spark, sf_dir):
    ticks = silver.valid(_tick_stream(spark, sf_dir))
    out = jobs.run_candles(ticks, scratch_dir(spark, "candles"), scratch_dir(spark, "candles-state"))
    return readers.read_table(spark, out)


@query
def stream_quality(spark, sf_dir):
    ticks = silver.enrich(_tick_stream(spark, sf_dir), src.sectors(spark, sf_dir))
    out = jobs.run_quality(ticks, scratch_dir(spark, "quality"), scratch_dir(spark, "quality-state"))
    return readers.read_table(spark, out)


@query
def stream_quality_counts(spark, sf_dir):
    """Rows passed and failed per rule of a running stream, added up batch by batch."""
    return jobs.run_quality_counts(
        _tick_stream(spark, sf_dir), scratch_dir(spark, "rule-counts"), scratch_dir(spark, "rule-counts-state")
    )


@query
def stream_signals(spark, sf_dir):
    """Indicators and signals that follow a stream of daily bars, delivered in three parts."""
    bars = src.bars(spark, sf_dir).select("symbol", "date", "sector", "day_close")
    landed, out, state = (scratch_dir(spark, f"followed-{part}") for part in ("bars", "signals", "state"))
    for delivery in ("date < '1994-01-01'", "date >= '1994-01-01' AND date < '1997-01-01'", "date >= '1997-01-01'"):
        bars.where(delivery).write.mode("append").parquet(landed)
        signals = jobs.run_signals(readers.table_stream(spark, landed, bars.schema), out, state)
    return signals


@query
def stream_news(spark, sf_dir):
    landed = landing.write_overwrite(src.raw_news(spark, sf_dir), scratch_dir(spark, "landed-news"))
    schema = src.raw_news(spark, sf_dir).schema
    out = jobs.run_news(
        readers.news_stream(spark, landed, schema),
        scratch_dir(spark, "scored-news"),
        scratch_dir(spark, "scored-news-state"),
        lexicon=LEXICON,
        boosts=BOOSTS,
        dampeners=DAMPENERS,
    )
    return readers.read_table(spark, out).drop("symbols", "summary", "ingest_time", "pub_time")


@query
def stream_dedupe(spark, sf_dir):
    landed = landing.write_overwrite(articles_of(spark, sf_dir), scratch_dir(spark, "landed-articles"))
    stream = bronze.bronze_news(readers.news_stream(spark, landed))
    out = jobs.run_dedupe(stream, scratch_dir(spark, "first-seen"), scratch_dir(spark, "first-seen-state"))
    return readers.read_table(spark, out).select("headline")
