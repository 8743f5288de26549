"""Series cut by time, against the same measures over whole series and plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quotewell.operators import gold, indicators, windows
from quotewell.operators.pieces import located, over_blocks
from tests.test_series import LENGTHS, arrays, loop_ema, loop_rsi, walk

BAR = "symbol string, sector string, date date, day_close double, total_volume long, `a.b` int"


@pytest.fixture(scope="module")
def walks(spark):
    series = {f"s{n}": walk(n, n) for n in LENGTHS}
    return series, arrays(spark, **series).repartition(4).cache()


@pytest.fixture(scope="module")
def bars(spark):
    """Series of very different length with gaps of time, missing prices, and one without a name."""
    rng = random.Random(11)
    rows = []
    for symbol, n in (("a", 900), ("b", 61), ("c", 1), (None, 130), ("", 75)):
        day = 0
        for _ in range(n):
            day += rng.choice([1, 1, 1, 2, 40])
            rows.append((symbol, "S", day, rng.choice([None, *[50 + rng.random()] * 9]), rng.choice([0, 100, None, 900]), 1))
    df = spark.createDataFrame(rows, BAR.replace("date date", "day int"))
    return df.withColumn("date", F.date_add(F.lit("2020-01-01"), F.col("day"))).drop("day").repartition(5).cache()


def same(a, b):
    """Equal rows, doubles to twelve digits."""

    def rows(df):
        doubles = {c: F.round(F.col(f"`{c}`"), 12) for c, kind in df.dtypes if kind == "double"}
        return sorted(map(str, df.select(*[doubles.get(c, F.col(f"`{c}`")).alias(c) for c in a.columns]).collect()))

    assert rows(a) == rows(b)


@pytest.mark.parametrize("width", [1, 30, 100_000])
def test_indicators_equal_those_of_whole_series(bars, width):
    same(indicators.technical_indicators(bars, width), indicators.technical_indicators(bars))
    same(indicators.rsi(bars, 5, width), indicators.rsi(bars, 5))
    same(indicators.macd(bars, 5, 10, 3, width), indicators.macd(bars, 5, 10, 3))
    same(indicators.bollinger(bars, 7, width=width), indicators.bollinger(bars, 7))
    same(indicators.market_signals(bars.where("symbol = 'none'"), width), indicators.market_signals(bars.where("symbol = 'none'")))


@pytest.mark.parametrize("width", [1, 17, 400])
def test_recurrences_equal_loops(walks, width):
    series, df = walks
    for row in indicators.rsi(df, width=width).collect():
        expected = loop_rsi(series[row.symbol])
        assert row.rsi == (None if expected is None else pytest.approx(expected, abs=1.01e-4))
    found = indicators.ema(df, 12, width=width).toPandas().sort_values(["symbol", "date"])
    for symbol, prices in series.items():
        assert found[found.symbol == symbol]["ema_12"].tolist() == pytest.approx(loop_ema(prices, 12), rel=1e-9)


@pytest.mark.parametrize("period", [1, 2, 50])
def test_ema_of_other_periods(walks, period):
    _, df = walks
    same(indicators.ema(df, period, width=25), indicators.ema(df, period))


@pytest.mark.parametrize("width, block", [(1, 49), (30, 64), (500, 100_000)])
def test_rolling_windows_equal_those_over_whole_series(bars, width, block):
    for measure, halo in ((windows.moving_averages, 49), (windows.volume_spikes, 20), (windows.daily_change, 1)):
        same(over_blocks(bars, measure, halo, width, block=block), measure(bars))


def test_a_halo_wider_than_a_block_is_refused(bars):
    with pytest.raises(ValueError):
        over_blocks(bars, windows.moving_averages, 49, 30, block=48)


def test_places_and_values_before(spark):
    rows = [("x", 1, 5.0), ("x", 2, None), ("x", 9, 7.0), ("x", None, 3.0), (None, 4, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date int, v double")
    got = {(r.symbol, r.date): (r._pos, r._len, r._before) for r in located(df, 3, "v").collect()}
    assert got == {("x", None): (0, 3, None), ("x", 1): (1, 3, 3.0), ("x", 2): (None, 3, 5.0), ("x", 9): (2, 3, 5.0), (None, 4): (0, 1, None)}
    assert located(df.where("false"), 3, "v").count() == 0


def test_no_window_holds_a_whole_series(spark):
    """Nearly all rows are of one symbol: whatever holds its rows is keyed by stretch or block, too."""
    df = spark.range(200_000).selectExpr(
        "if(id % 1000 = 0, 'cold', 'hot') AS symbol", "'S' AS sector", "timestamp_seconds(id * 60) AS date", "id % 97 + 1.0 AS day_close", "id AS total_volume"
    )
    placed = located(df, 7)
    assert placed.groupBy("_of", "_piece").count().agg(F.max("count")).first()[0] <= 7 * 1440
    plan = indicators.rsi(df, width=7)._jdf.queryExecution().executedPlan().toString()
    windows_by = {re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Window \[.*\], \[([^\[\]]*)\], \[[^\[\]]*\]$", plan, re.M)}
    assert windows_by == {"_of, _piece", "_of"}  # the second over one row per stretch
    assert re.search(r"HashAggregate\(keys=\[symbol#\d+\], functions=\[partial_sum", plan)


def test_candles_as_bars(spark):
    candle = spark.sql("SELECT 'x' AS symbol, timestamp'2024-01-01 00:00:00' AS candle_start, 2.0D AS close, 5L AS volume")
    assert gold.candle_bars(candle).columns == ["symbol", "sector", "date", "day_close", "total_volume"]
