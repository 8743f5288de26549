"""Price ticks, daily bars, articles and a question log out of the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.operators.gold import daily_ohlcv, numeric_order
from quotewell.operators.windows import daily_change
from quotewell.sources.readers import spread


# Columns that tell rows of the text tables apart.
_KEYS = {"documents": "doc_id", "pages": "page_id"}


def given(spark: SparkSession, sf_dir: str, name: str, pieces: int | None = None) -> DataFrame:
    """A given table; ``pieces`` deals a text table out that comes as one uncuttable file."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(table, pieces, _KEYS[name]) if pieces else table


def _k() -> Column:
    """The counter 0..99 that every event carries; decides what is wrong with a tick."""
    return F.regexp_extract("props", r'"k": (\d+)', 1).cast("int")


def ticks_of(events: DataFrame) -> DataFrame:
    """Events as raw price ticks, of which some lack or spoil a field."""
    k = F.col("_k")
    price = F.when(k < 5, F.lit(None)).when(k < 10, -F.col("value")).otherwise(F.col("value"))
    previous = F.when(k.between(30, 32), F.lit(None)).when(k.between(33, 35), 0.0).otherwise(
        F.col("value") * (1 + (k - 50) / 1000.0)
    )
    return (
        events.withColumn("_k", _k())
        .select(
            F.when(~k.between(8, 13), F.col("user_id").cast("string")).alias("symbol"),
            price.alias("price"),
            (F.col("value") * 0.99).alias("open"),
            (F.col("value") * 1.02).alias("high"),
            (F.col("value") * 0.98).alias("low"),
            previous.alias("prev_close"),
            F.when(k.between(12, 15), F.lit(None)).when(k.between(16, 18), -1).otherwise(k * 1_000_000)
            .cast("bigint").alias("volume"),
            (k.cast("bigint") * 1_000_000_000).alias("market_cap"),
            F.when(~k.between(18, 21), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .alias("timestamp"),
        )
    )


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(given(spark, sf_dir, "events"))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit with their market segment, as the sector dimension of the ticks; others have none."""
    in_credit = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return given(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("symbol"), in_credit.alias("sector")
    )


def trades(spark: SparkSession, sf_dir: str, symbol: str) -> DataFrame:
    """Line items as trades of a supplier or a part."""
    price = F.try_divide("l_extendedprice", "l_quantity")
    return given(spark, sf_dir, "lineitem").select(
        F.col(symbol).cast("string").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("trade_time"),
        *[price.alias(name) for name in ("price", "open", "high", "low")],
        F.col("l_quantity").cast("bigint").alias("volume"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def _daily(traded: DataFrame, by: Sequence[str] = ("symbol", "date")) -> DataFrame:
    # Trades of one day carry the same time; order, line and part say which came first, then the price in cents.
    day, cents = F.unix_date(F.to_date("trade_time")), F.least(F.round(F.col("price") * 100), F.lit(999_999))
    order = numeric_order((day, 5), ("l_orderkey", 13), ("l_linenumber", 1), ("l_partkey", 11), (cents, 6))
    return daily_ohlcv(traded, by=by, ties=order)


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
    return (
        given(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").cast("string").alias("symbol"), F.col("r_name").alias("sector"))
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per supplier, with the supplier's region as sector.

    The sector is joined after the trades are folded to bars, when there is
    less to join, and by hash among the bars shuffled by symbol: the change needs
    that shuffle anyway, and nothing is sorted or broadcast however many suppliers
    there are.
    """
    daily = _daily(trades(spark, sf_dir, "l_suppkey"))
    return daily_change(daily.join(supplier_regions(spark, sf_dir).hint("shuffle_hash"), "symbol", "left"))


def part_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per part: many symbols with a short history."""
    daily = _daily(trades(spark, sf_dir, "l_partkey")).withColumn("sector", F.lit("Unknown"))
    return daily_change(daily)


def _headline() -> Column:
    return F.substring_index("text", "\n", 1)


def _body() -> Column:
    return F.substr("text", F.length(_headline()) + 2)


def _published() -> Column:
    moment = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 60)
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def raw_news(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Documents as articles: first line as headline, the rest as summary.

    Short documents lack a headline or a date; Spanish ones name no symbol.
    """
    n = F.col("n_chars")
    return given(spark, sf_dir, "documents", pieces).select(
        "doc_id",
        F.when(~n.between(100, 199), F.concat(F.lit("<b>"), _headline(), F.lit("</b>"))).alias("headline"),
        F.concat(F.lit("<p>&ldquo;"), _body(), F.lit("&#8221;&nbsp;</p>")).alias("summary"),
        "source",
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("lang") == "es", F.array().cast("array<string>")).otherwise(F.array("source", "lang")).alias("symbols"),
        F.when(n < 300, "").when(~n.between(300, 399), _published()).alias("published_at"),
    )


def news_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as nested article JSON fetched for a source; some lack parts."""
    n, lang = F.col("n_chars"), F.col("lang")
    content = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("STORY").alias("contentType"),
        F.when(~n.between(100, 199), _headline()).alias("title"),
        F.when(lang != "de", _body()).alias("summary"),
        F.when(lang != "es", _published()).alias("pubDate"),
        F.when(lang != "fr", F.struct(F.col("source").alias("displayName"), F.lit("s").alias("sourceId"))).alias("provider"),
        F.when(lang != "de", F.struct(F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url")))
        .alias("canonicalUrl"),
    )
    article = F.struct(
        F.col("doc_id").cast("string").alias("id"), F.when(~n.between(200, 249), content).alias("content")
    )
    return given(spark, sf_dir, "documents").select(
        F.col("source").alias("symbol"), "doc_id", F.to_json(article).alias("payload")
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as answered questions: a user turn and the assistant turn after it."""
    said = given(spark, sf_dir, "conversations")
    asked = said.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("query"))
    answered = said.where("role = 'assistant'").select("conv_id", "turn", F.length("text").alias("answer_length"))
    return asked.join(answered, ["conv_id", "turn"]).select(
        "query",
        (F.col("answer_length") / 100.0).alias("latency_seconds"),
        (F.length("query") % 5).alias("tool_calls"),
        (F.length("query") % 5 + 1).alias("iterations"),
        "answer_length",
    )
