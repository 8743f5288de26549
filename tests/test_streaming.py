"""Sources, sinks and streams."""

import glob

import pytest
from pyspark.sql import functions as F

from quotewell import schemas
from quotewell.operators import bronze, gold, silver
from quotewell.plans.parameters import BOOSTS, DAMPENERS, LEXICON
from quotewell.plans.queries import QUERIES, scored_news, silver_of
from quotewell.session import scratch_dir
from quotewell.sources import driver_tables as src
from quotewell.sources import landing, readers
from quotewell.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def paths(tmp_path):
    return lambda name: str(tmp_path / name)


def test_ndjson_round_trip(spark, paths):
    raw = src.raw_ticks(spark, SF_DIR)
    landing.write_ndjson(raw.limit(2), paths("ticks"))
    lines = [line for f in glob.glob(paths("ticks/*.json")) for line in open(f, encoding="utf-8")]
    assert len(lines) == 2
    back = spark.read.schema(raw.schema).json(paths("ticks"))
    assert back.exceptAll(raw).count() == 0
    news = spark.createDataFrame([("Börse: 株価", "s")], "headline string, summary string")
    landing.write_ndjson(news, paths("news"))
    assert "Börse: 株価" in "".join(open(f, encoding="utf-8").read() for f in glob.glob(paths("news/*.json")))
    assert readers.read_json_inferred(spark, paths("news")).count() == 1
    landing.write_ndjson(raw.where("false"), paths("empty"))
    assert spark.read.schema(raw.schema).json(paths("empty")).count() == 0


def test_price_stream_reads_one_file_at_a_time_and_continues(spark, paths):
    raw = src.raw_ticks(spark, SF_DIR).repartition(3, "market_cap")
    landing.write_ndjson(raw, paths("in"))
    stream = bronze.bronze_prices(readers.price_stream(spark, paths("in")))
    jobs.run_to_parquet(stream, paths("out"), paths("state"))
    assert spark.read.parquet(paths("out")).count() == raw.count()
    assert len(glob.glob(paths("state/commits/[0-9]*"))) == 3
    landing.write_ndjson(raw.limit(7), paths("in"))
    jobs.run_to_parquet(stream, paths("out"), paths("state"))
    assert spark.read.parquet(paths("out")).count() == raw.count() + 7


def test_stream_candles_are_the_closed_batch_candles(spark, paths):
    ticks = silver_of(spark, SF_DIR).drop("trade_time")
    landing.write_ndjson(ticks.coalesce(1), paths("in"))
    stream = bronze.bronze_prices(readers.json_stream(spark, paths("in"), ticks.schema, None))
    jobs.run_candles(stream, paths("out"), paths("state"))
    batch = gold.candles(silver_of(spark, SF_DIR))
    last = silver_of(spark, SF_DIR).agg(F.max("trade_time") - F.expr("INTERVAL 2 MINUTES")).first()[0]
    closed = batch.where(F.col("candle_end") <= F.lit(last))
    streamed = spark.read.parquet(paths("out"))
    assert streamed.exceptAll(closed).count() == 0 and closed.exceptAll(streamed).count() == 0
    assert 0 < batch.count() - closed.count()


def test_stream_quality_equals_batch(spark, paths):
    raw = src.raw_ticks(spark, SF_DIR)
    landing.write_ndjson(raw, paths("in"))
    enriched = silver.enrich(bronze.bronze_prices(readers.price_stream(spark, paths("in"), None)).drop("ingest_time"))
    jobs.run_quality(enriched, paths("out"), paths("state"))
    out = spark.read.parquet(paths("out"))
    batch = silver.enrich(bronze.bronze_prices(raw).drop("ingest_time"))
    good = out.where("quality = 'silver'").drop("quality", "quarantine_reason")
    bad = out.where("quality = 'quarantine'").drop("quality")
    assert good.exceptAll(silver.valid(batch)).count() == 0 and good.count() == silver.valid(batch).count()
    assert bad.exceptAll(silver.quarantine(batch)).count() == 0 and bad.count() == silver.quarantine(batch).count()


def test_stream_news_equals_batch(spark, paths):
    raw = src.raw_news(spark, SF_DIR)
    landing.write_overwrite(raw, paths("in"))
    stream = readers.news_stream(spark, paths("in"), raw.schema)
    jobs.run_news(stream, paths("out"), paths("state"), lexicon=LEXICON, boosts=BOOSTS, dampeners=DAMPENERS)
    columns = ["doc_id", "sentiment_score", "sentiment_label", "confidence"]
    streamed, batch = spark.read.parquet(paths("out")).select(columns), scored_news(spark, SF_DIR).select(columns)
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == batch.count() > 0


@pytest.mark.parametrize("lanes", [1, 8])
def test_stream_dedupe(spark, paths, lanes):
    """A headline with most of the rows, spread over many files, comes out once."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id").cast("string"))).alias("headline"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).alias("ingest_time"),
    )
    rows.repartition(6).write.parquet(paths("in"))
    stream = spark.readStream.schema(rows.schema).parquet(paths("in"))
    jobs.run_to_parquet(jobs.first_seen(stream, lanes=lanes), paths("out"), paths("state"))
    headlines = [r[0] for r in spark.read.parquet(paths("out")).select("headline").collect()]
    assert len(headlines) == len(set(headlines)) == 1001


def test_dedupe_keeps_undated_and_late_articles(spark, paths):
    schema = "headline string, published_at string"

    def batch(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(paths("in"))
        stream = bronze.bronze_news(spark.readStream.schema(schema).parquet(paths("in")))
        jobs.run_dedupe(stream, paths("out"), paths("state"))
        return sorted(r[0] for r in spark.read.parquet(paths("out")).select("headline").collect())

    assert batch(("a", "2024-03-10T00:00:00Z"), ("b", "")) == ["a", "b"]
    assert batch(("a", "2024-03-11T00:00:00Z"), ("late", "2024-03-01T00:00:00Z")) == ["a", "b", "late"]


def test_stream_of_one_file_or_a_folder(spark, paths):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(3).write.parquet(paths("tables/events.parquet"))
    spark.read.parquet(f"{SF_DIR}/customer.parquet").write.parquet(paths("tables/customer.parquet"))
    both = [sorted(map(str, QUERIES["stream_quality"](spark, d).collect())) for d in (SF_DIR, paths("tables"))]
    assert both[0] == both[1] and both[0]


def test_partitioned_and_clustered_layout(spark, paths):
    bars = src.bars(spark, SF_DIR).where("date < '1995-03-01'")
    landing.write_partitioned(bars, paths("by-date"))
    assert len(glob.glob(paths("by-date/date=*"))) == bars.select("date").distinct().count()
    one_day = bars.where("date = '1995-01-02'").withColumn("total_volume", F.lit(-1).cast("bigint"))
    landing.write_partitioned(one_day, paths("by-date"), whole=False)
    back = readers.read_table(spark, paths("by-date"))
    assert back.count() == bars.count()
    assert {str(r.date) for r in back.where("total_volume = -1").collect()} == {"1995-01-02"}
    landing.write_partitioned(one_day, paths("by-date"))
    assert readers.read_table(spark, paths("by-date")).count() == one_day.count()

    landing.write_clustered(bars, paths("by-symbol"))
    ranges = (
        readers.read_table(spark, paths("by-symbol"))
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("symbol").alias("lo"), F.max("symbol").alias("hi"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


def test_news_staging_table(spark, paths):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS staging_test LOCATION '{paths('db')}'")
    try:
        landing.create_news_staging(spark, "staging_test.raw_news")
        landing.create_news_staging(spark, "staging_test.raw_news")
        article = spark.createDataFrame([("h", "s", "src", "u", ["NVDA"], "2026-03-24T13:00:00Z")], schemas.NEWS_ARTICLE)
        landing.append_to_staging(article, "staging_test.raw_news")
        landing.append_to_staging(article, "staging_test.raw_news")
        assert spark.table("staging_test.raw_news").count() == 2
        stream = bronze.bronze_news(readers.news_table_stream(spark, "staging_test.raw_news"))
        jobs.run_to_parquet(stream, paths("out"), paths("state"))
        (first, second) = spark.read.parquet(paths("out")).collect()
        assert first.symbols == ["NVDA"] and str(second.pub_time) == "2026-03-24 13:00:00"
    finally:
        spark.sql("DROP DATABASE staging_test CASCADE")


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_dir(spark, "x").startswith(shared.rstrip("/") + "/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_bars_have_the_declared_columns(spark):
    declared = [c.split()[0] for c in schemas.DAILY_BAR.split(", ")]
    assert set(src.bars(spark, SF_DIR).columns) == set(declared)
