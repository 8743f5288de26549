"""Look-ups, comparisons and summaries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotewell import schemas
from quotewell.operators import serving

DAY = dt.date(2026, 3, 26)
BAR = schemas.DAILY_BAR.replace(" NOT NULL", "")


def bar(symbol, sector, close, volume, change, day=DAY):
    return (symbol, day, sector, close - 1, close + 2, close - 2, close, volume, 5, change)


@pytest.fixture(scope="module")
def bars(spark):
    rows = [
        bar("NVDA", "Technology", 171.24, 182_162_282, -2.05),
        bar("NVDA", "Technology", 178.68, 162_602_100, 1.98, dt.date(2026, 3, 25)),
        bar("AAPL", "Technology", 252.89, 45_230_100, 0.06),
        bar("GOOGL", "Technology", 280.74, 40_000_000, -3.44),
        bar("JPM", "Finance", 291.66, 9_800_000, 0.86),
        bar("XOM", "Energy", 165.43, 20_000_000, 2.64),
        bar("OLD", "Energy", 1.0, 1, 99.0, dt.date(2026, 3, 24)),
    ]
    return spark.createDataFrame(rows, BAR).repartition(3).cache()


@pytest.fixture(scope="module")
def latest(bars):
    return serving.latest_slice(bars)


SIGNAL = schemas.MARKET_SIGNALS.replace(" NOT NULL", "")


@pytest.fixture(scope="module")
def signals(spark):
    def row(symbol, sector, close, rsi, histogram, signal):
        return (symbol, sector, DAY, close, rsi, -2.8289, -2.0379, histogram, 187.72, 179.91, 172.1, signal)

    rows = [
        row("AAPL", "Technology", 252.89, 42.71, 0.0, "hold"),
        row("NVDA", "Technology", 171.24, 38.76, -0.791, "buy"),
        row("GOOGL", "Technology", 280.74, 35.0, -1.0, "buy"),
        row("JPM", "Finance", 291.66, 44.0, 0.5, "buy"),
        row("XOM", "Energy", 165.43, 71.2, 0.55, "sell"),
        row("NEW", "Energy", 10.0, None, None, "hold"),
    ]
    return spark.createDataFrame(rows, SIGNAL)


def test_latest_slice(latest):
    assert {r.symbol for r in latest.collect()} == {"NVDA", "AAPL", "GOOGL", "JPM", "XOM"}


def test_latest_quote(bars):
    assert serving.latest_quote(bars).count() == 6
    (row,) = serving.latest_quote(bars, " nvda ").collect()
    assert (row.symbol, row.date, row.price, row.change_pct, row.volume) == ("NVDA", DAY, 171.24, -2.05, 182_162_282)
    assert serving.latest_quote(bars, "ZZZ").count() == 0


def test_sector_board(latest, spark):
    rankings = spark.createDataFrame(
        [("AAPL", DAY, 1, 100.0), ("NVDA", DAY, 2, 66.7), ("AAPL", dt.date(2026, 3, 25), 3, 1.0)],
        "symbol string, date date, sector_rank int, percentile double",
    )
    rows = serving.sector_board(latest, rankings, " technology ").orderBy(F.asc_nulls_last("rank")).collect()
    assert [r.symbol for r in rows] == ["AAPL", "NVDA", "GOOGL"]
    assert {(r.stock_count, r.top_gainer, r.top_loser) for r in rows} == {(3, "AAPL", "GOOGL")}
    assert rows[2]["rank"] is None and rows[0].percentile == 100.0
    assert serving.sector_board(latest, rankings, "Nowhere").count() == 0
    assert serving.sector_board(latest, rankings).count() == 5


@pytest.mark.parametrize("score, label", [(0.42, "bullish"), (-0.18, "bearish"), (0.02, "neutral"), (0.05, "neutral")])
def test_sentiment_lookup(spark, score, label):
    df = spark.createDataFrame(
        [("NVDA", score, 3, "up", "down")],
        "symbol string, avg_sentiment double, article_count long, most_positive string, most_negative string",
    )
    assert serving.sentiment_lookup(df, "nvda").first().label == label
    assert serving.sentiment_lookup(df, "AAPL").count() == 0


def test_mood_lookup(spark):
    df = spark.createDataFrame([("bullish", 0.34567, 10, 6, 2, 2)], schemas.MARKET_MOOD)
    assert serving.mood_lookup(df).first().avg_score == 0.346


def test_technical_snapshot_keeps_zero_and_null(signals):
    found = {r.symbol: r for r in serving.technical_snapshot(signals).collect()}
    assert found["AAPL"].macd.histogram == 0.0 and found["NEW"].rsi is None and found["NEW"].macd.histogram is None
    assert found["NVDA"].bollinger.upper == 187.72 and found["NVDA"].signal == "buy"
    assert serving.technical_snapshot(signals, "zzz").count() == 0


def test_compare_symbols(signals, spark):
    averages = spark.createDataFrame(
        [("AAPL", DAY, 250.101, 256.149, 255.5), ("AAPL", dt.date(2026, 3, 25), 1.0, 1.0, 1.0)],
        "symbol string, date date, sma_5 double, sma_20 double, vwap_20 double",
    )
    found = {r.symbol: r for r in serving.compare_symbols(signals, averages, "aapl", " GOOGL").collect()}
    aapl = found["AAPL"]
    assert (aapl.price, aapl.rsi, aapl.signal, aapl.sma_5, aapl.sma_20, aapl.vwap_20) == (252.89, 42.71, "hold", 250.1, 256.15, 255.5)
    assert found["GOOGL"].sma_5 is None
    assert serving.compare_symbols(signals, averages, "AAPL", "ZZZ").count() == 0
    assert serving.compare_symbols(signals, averages, "AAPL", "AAPL").count() == 1


def names(df, kind, column="kind"):
    name = "symbol" if column == "kind" else "label"
    return [r[name] for r in df.where(F.col(column) == kind).orderBy("position").collect()]


def test_top_movers(latest):
    movers = serving.top_movers(latest)
    assert names(movers, "top_gainer") == ["XOM", "JPM", "AAPL"]
    assert names(movers, "top_loser") == ["GOOGL", "NVDA", "AAPL"]
    assert names(movers, "most_active") == ["NVDA", "AAPL", "GOOGL"]


def test_equal_changes_are_ordered_by_symbol(spark):
    rows = [bar(s, "S", 10.0, 7, 1.0) for s in "DBCA"]
    movers = serving.top_movers(spark.createDataFrame(rows, BAR).repartition(4))
    assert names(movers, "top_gainer") == ["A", "B", "C"] and names(movers, "top_loser") == ["D", "C", "B"]


@pytest.fixture(scope="module")
def spikes(spark):
    return spark.createDataFrame([("NVDA", 2.5, True), ("AAPL", 1.0, False)], "symbol string, volume_ratio double, is_spike boolean")


def test_market_summary(latest, signals, spikes):
    known = signals.where("symbol <> 'NEW'")
    summary = serving.market_summary(latest, known, spikes)
    (overview,) = summary.where("section = 'overview'").collect()
    assert (overview.label, overview.value) == ("2026-03-26", 5.0)
    assert names(summary, "top_gainer", "section")[0] == "XOM" and names(summary, "top_loser", "section")[0] == "GOOGL"
    assert {r.label: r.value for r in summary.where("section = 'signal'").collect()} == {"buy": 3, "sell": 1, "hold": 1}
    assert [(r.label, r.value) for r in summary.where("section = 'volume_spike'").collect()] == [("NVDA", 2.5)]
    assert serving.market_summary(latest.where("false"), known, spikes).count() == 0


def test_dashboard_metrics(latest, signals):
    board = serving.dashboard_metrics(latest, signals.where("symbol <> 'NEW'"))
    assert names(board, "top_loser", "section") == ["AAPL", "NVDA", "GOOGL"]
    assert board.where("section = 'total'").first().value == 5
    assert board.where("section = 'signal'").agg(F.sum("value")).first()[0] == 5
    empty = serving.dashboard_metrics(latest.where("false"), signals).collect()
    assert [(r.section, r.value) for r in empty] == [("total", 0.0)]


def test_boards(latest, signals):
    rows = serving.signal_board(signals).collect()
    assert [r.symbol for r in rows] == ["AAPL", "GOOGL", "JPM", "NEW", "NVDA", "XOM"]
    new, nvda = rows[3], rows[4]
    assert (new.price, new.rsi, new.macd_histogram, new.signal, new.color) == ("$10.00", "—", "—", "HOLD", "yellow")
    assert (nvda.price, nvda.rsi, nvda.macd_histogram, nvda.color) == ("$171.24", "38.8", "-0.7910", "green")
    best = serving.performance_board(latest).collect()
    assert [(r.symbol, r.label, r.color) for r in best][::4] == [("XOM", "+2.64%", "green"), ("GOOGL", "-3.44%", "red")]
    worst = serving.performance_board(latest, descending=False).collect()
    assert [r.symbol for r in worst] == [r.symbol for r in best][::-1]


def test_query_log_stats(spark):
    # Latencies and tool calls of six answered questions.
    rows = [("q", s, c, 1, 100) for s, c in zip((1.74, 2.57, 2.41, 3.11, 8.23, 2.68), (1, 1, 1, 1, 4, 1))]
    row = serving.query_log_stats(spark.createDataFrame(rows, schemas.QUERY_LOG)).first()
    assert tuple(row) == (6, 9, 3.46, 1.5)


def test_members_without_a_sector_have_a_board(spark):
    bars = "symbol string, sector string, date int, day_close double, avg_change_pct double, total_volume long"
    latest = spark.createDataFrame([("A", None, 1, 1.0, 2.0, 1), ("B", "S", 1, 1.0, 1.0, 1), ("C", None, 1, 1.0, 3.0, 1)], bars)
    from quotewell.operators import windows

    board = {r.symbol: (r.sector, r.stock_count, r.top_gainer, r["rank"]) for r in serving.sector_board(latest, windows.sector_rankings(latest)).collect()}
    assert board == {"A": (None, 2, "C", 2), "B": ("S", 1, "B", 1), "C": (None, 2, "C", 1)}


def test_a_missing_change_has_a_dash(spark):
    df = spark.createDataFrame([("A", "S", None)], "symbol string, sector string, avg_change_pct double")
    assert serving.performance_board(df).first()["label"] == "—"
