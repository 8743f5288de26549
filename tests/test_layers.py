"""Layer jobs: repeated runs pick up what is new; tables equal the batch operators."""

import datetime
import glob
import os
import re

from pyspark.sql import functions as F

from quotewell.operators import bronze, gold, indicators, silver, windows
from quotewell.plans import layers
from quotewell.plans.queries import silver_of
from quotewell.sources import driver_tables as src
from quotewell.sources import landing
from quotewell.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(columns), b.select(columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def rounded(df, name="avg_change_pct"):
    return df.withColumn(name, F.round(name, 9))


def test_price_layers_continue_with_new_files(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "tables")
    raw = src.raw_ticks(spark, SF_DIR)
    early = F.coalesce(F.col("timestamp"), F.lit("")) < "2024-01-15"
    landing.write_ndjson(raw.where(early), landed)
    first = layers.price_layers(spark, landed, root, src.sectors(spark, SF_DIR), None)
    before = first["stock_prices_bronze"].count()
    landing.write_ndjson(raw.where(~early), landed)
    tables = layers.price_layers(spark, landed, root, src.sectors(spark, SF_DIR), None)
    assert 0 < before < raw.count() == tables["stock_prices_bronze"].count()

    good = silver_of(spark, SF_DIR)
    assert same(tables["stock_prices_silver"].drop("ingest_time"), good)
    rejected = silver.quarantine(silver.enrich(bronze.bronze_prices(raw), src.sectors(spark, SF_DIR)))
    assert same(tables["stock_prices_quarantine"].drop("ingest_time"), rejected.drop("ingest_time"))
    assert same(rounded(tables["stock_daily_summary"]), rounded(gold.daily_ohlcv(good)))
    assert same(rounded(tables["sector_performance"]), rounded(gold.sector_daily(good)))
    candles = tables["stock_candles_1m"]
    assert candles.exceptAll(gold.candles(good)).count() == 0
    assert candles.count() == candles.select("symbol", "candle_start").distinct().count()


def test_a_late_tick_renews_its_date_alone(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "tables")
    raw = src.raw_ticks(spark, SF_DIR).where("timestamp < '2024-01-20'")
    late = raw.where("symbol IS NOT NULL AND price > 0 AND volume >= 0 AND prev_close > 0").orderBy("timestamp").limit(1)
    late = late.withColumn("price", F.lit(1e9)).withColumn("high", F.lit(1e9))
    landing.write_ndjson(raw, landed)
    layers.price_layers(spark, landed, root, src.sectors(spark, SF_DIR), None)

    def files():
        by_date = {}
        for f in glob.glob(f"{root}/stock_daily_summary/date=*/*.parquet"):
            by_date.setdefault(f.split("date=")[1][:10], set()).add(f)
        return by_date

    before = files()
    landing.write_ndjson(late, landed)
    tables = layers.price_layers(spark, landed, root, src.sectors(spark, SF_DIR), None)
    after = files()
    assert [d for d in after if after[d] != before.get(d)] == [late.first()["timestamp"][:10]]
    good = tables["stock_prices_silver"]
    assert same(rounded(tables["stock_daily_summary"]), rounded(gold.daily_ohlcv(good)))
    assert same(rounded(tables["sector_performance"]), rounded(gold.sector_daily(good)))


def test_analytics_layers_equal_operators(spark, tmp_path):
    bars = gold.daily_ohlcv(silver_of(spark, SF_DIR))
    landing.write_overwrite(bars, str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    tables = layers.analytics_layers(spark, stored, str(tmp_path / "tables"))
    assert same(tables["market_signals"], indicators.market_signals(stored))
    assert same(tables["moving_averages"], windows.moving_averages(stored))
    assert same(tables["sector_rankings"], windows.sector_rankings(stored))
    assert same(tables["volume_spikes"], windows.volume_spikes(stored))


def test_news_layers(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "tables")
    landing.write_overwrite(src.raw_news(spark, SF_DIR), landed)
    tables = layers.news_layers(spark, landed, root)
    mood = tables["market_mood"].first()
    scored = tables["news_sentiment_silver"]
    assert mood.article_count == scored.count() == mood.positive_count + mood.negative_count + mood.neutral_count
    mentions = tables["symbol_sentiment_agg"].agg(F.sum("article_count")).first()[0]
    assert mentions == scored.agg(F.sum(F.size("symbols"))).first()[0]


def test_news_layers_fold_in_what_is_new(spark, tmp_path, monkeypatch):
    """A second run reads the new rows alone, and ends where one run over everything ends."""
    landed, root = str(tmp_path / "landed"), str(tmp_path / "tables")
    raw = src.raw_news(spark, SF_DIR)
    batches = []
    plain = gold.sentiment_state
    monkeypatch.setattr(gold, "sentiment_state", lambda df: batches.append(df.count()) or plain(df))
    for condition in ("doc_id % 3 = 0", "doc_id % 3 <> 0"):
        raw.where(condition).write.mode("append").parquet(landed)
        tables = layers.news_layers(spark, landed, root)
    monkeypatch.undo()
    scored = tables["news_sentiment_silver"]
    assert len([n for n in batches if n]) == 2 and sum(batches) == scored.count()
    assert same(rounded(tables["symbol_sentiment_agg"], "avg_sentiment"), rounded(gold.symbol_sentiment(scored), "avg_sentiment"))
    assert same(rounded(tables["market_mood"], "avg_score"), rounded(gold.market_mood(scored), "avg_score"))
    mood = tables["market_mood"].collect()
    again = layers.news_layers(spark, landed, root)  # nothing new
    assert len([n for n in batches if n]) == 2 and again["market_mood"].collect() == mood


def test_a_repeated_batch_counts_once(spark, tmp_path):
    """The batch of a run that failed after writing its state comes again and replaces it."""
    path, checkpoint, source = (str(tmp_path / n) for n in ("state", "checkpoint", "source"))
    spark.range(5).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    empty = spark.createDataFrame([], "n long")

    def add(before, batch):
        return before.unionByName(batch.select(F.lit(1).cast("long").alias("n"))).agg(F.sum("n").alias("n"))

    assert jobs.run_fold(stream, add, empty, path, checkpoint).first()["n"] == 5
    for name in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{name}")  # as if the driver was lost before the commit
    assert jobs.run_fold(stream, add, empty, path, checkpoint).first()["n"] == 5
    spark.range(2).write.mode("append").parquet(source)
    assert jobs.run_fold(stream, add, empty, path, checkpoint).first()["n"] == 7


def test_first_runs_on_empty_folders_make_empty_tables(spark, tmp_path):
    """And the next run, with files, gives what it gives without the empty one before."""
    prices, articles = tmp_path / "prices", tmp_path / "articles"
    prices.mkdir(), articles.mkdir()
    tables = layers.price_layers(spark, str(prices), str(tmp_path / "p"), src.sectors(spark, SF_DIR), None)
    assert {name: table.count() for name, table in tables.items()} == dict.fromkeys(tables, 0)
    news = layers.news_layers(spark, str(articles), str(tmp_path / "n"))
    assert news["symbol_sentiment_agg"].count() == news["stock_news_bronze"].count() == news["news_sentiment_silver"].count() == 0
    assert tuple(news["market_mood"].first()) == ("neutral", 0.0, 0, 0, 0, 0)

    raw = src.raw_ticks(spark, SF_DIR).where("timestamp < '2024-01-10'")
    landing.write_ndjson(raw, str(prices))
    filled = layers.price_layers(spark, str(prices), str(tmp_path / "p"), src.sectors(spark, SF_DIR), None)
    assert filled["stock_prices_bronze"].count() == raw.count() > 0
    assert same(rounded(filled["stock_daily_summary"]), rounded(gold.daily_ohlcv(filled["stock_prices_silver"])))
    assert all(filled[name].columns == tables[name].columns for name in ("stock_prices_silver", "stock_prices_quarantine", "quality_counts"))
    assert sorted(map(tuple, filled["quality_counts"].collect())) == sorted(map(tuple, silver.quality_report(raw).collect()))
    landing.write_overwrite(src.raw_news(spark, SF_DIR), str(tmp_path / "more"))
    for f in glob.glob(str(tmp_path / "more" / "*.parquet")):
        os.link(f, articles / os.path.basename(f))
    assert layers.news_layers(spark, str(articles), str(tmp_path / "n"))["market_mood"].first()["article_count"] > 0


def test_only_touched_dates_are_read(spark, tmp_path):
    ticks = silver_of(spark, SF_DIR).withColumn("date", F.to_date("trade_time"))
    ticks.write.partitionBy("date").parquet(str(tmp_path / "ticks"))
    stored = spark.read.parquet(str(tmp_path / "ticks"))
    day = stored.agg(F.max("date")).first()[0]
    touched = gold.daily_ohlcv(layers.of_dates(stored, [day]))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ = \d+", plan)
    assert touched.select("date").distinct().collect() == [(day,)]
    assert layers.of_dates(stored, []).count() == 0
    both = spark.createDataFrame([(1, day), (2, None), (3, day - datetime.timedelta(1))], "id int, date date")
    assert {r.id for r in layers.of_dates(both, [None, day]).collect()} == {1, 2}
