"""Windows, ranking and indicators, against plain loops."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotewell.functions.signals import classify_signal
from quotewell.operators import indicators, windows
from quotewell.operators.ranking import rank_within


def arrays(spark, **series):
    df = spark.createDataFrame(list(series.items()), "symbol string, prices array<double>")
    return indicators.series_from_arrays(df)


def loop_ema(values, period):
    out = [sum(values[:period]) / period] if len(values) >= period else []
    for v in values[period:]:
        out.append(out[-1] + (v - out[-1]) * 2 / (period + 1))
    return out


def loop_rsi(prices, period=14):
    moves = [b - a for a, b in zip(prices, prices[1:])]
    if len(moves) < period:
        return None
    up = statistics.fmean(max(m, 0) for m in moves[:period])
    down = statistics.fmean(max(-m, 0) for m in moves[:period])
    for m in moves[period:]:
        up += (max(m, 0) - up) / period
        down += (max(-m, 0) - down) / period
    if down == 0:
        return 50.0 if up == 0 else 100.0
    return 100 - 100 / (1 + up / down)


def walk(seed, n):
    rng = random.Random(seed)
    price, out = 100.0, []
    for _ in range(n):
        price = max(1.0, price + rng.gauss(0, 2))
        out.append(round(price, 2))
    return out


LENGTHS = (1, 14, 15, 19, 20, 25, 26, 33, 34, 35, 60, 500, 3000)


@pytest.fixture(scope="module")
def walks(spark):
    series = {f"s{n}": walk(n, n) for n in LENGTHS}
    return series, arrays(spark, **series).repartition(4).cache()


def test_rsi_equals_loop(walks):
    series, df = walks
    for row in indicators.rsi(df).collect():
        expected = loop_rsi(series[row.symbol])
        assert row.rsi == (None if expected is None else pytest.approx(expected, abs=1.01e-4))


@pytest.mark.parametrize("periods", [(12, 26, 9), (5, 10, 3), (9, 26, 9), (3, 9, 9)])
def test_macd_equals_loop(walks, periods):
    series, df = walks
    fast, slow, signal = periods
    for row in indicators.macd(df, *periods).collect():
        prices = series[row.symbol]
        if len(prices) < slow:
            assert row.macd_line is None and row.macd_signal is None and row.macd_histogram is None
            continue
        slow_line = loop_ema(prices, slow)
        line = [f - s for f, s in zip(loop_ema(prices, fast)[slow - fast :], slow_line)]
        smooth = loop_ema(line, signal)
        assert row.macd_line == pytest.approx(line[-1], abs=1.01e-4)
        assert row.macd_signal == pytest.approx(smooth[-1] if smooth else line[-1], abs=1.01e-4)
        assert row.macd_histogram == pytest.approx(row.macd_line - row.macd_signal, abs=1e-9)


def test_bollinger_equals_loop(walks):
    series, df = walks
    for row in indicators.bollinger(df).collect():
        last = series[row.symbol][-20:]
        if len(last) < 20:
            assert row.bb_upper is None and row.bb_middle is None
            continue
        mean, reach = statistics.fmean(last), 2 * statistics.pstdev(last)
        assert (row.bb_upper, row.bb_middle, row.bb_lower) == pytest.approx((mean + reach, mean, mean - reach), abs=1.01e-4)


@pytest.mark.parametrize("period", [1, 2, 12, 50])
def test_ema_equals_loop_at_every_bar(walks, period):
    series, df = walks
    found = indicators.ema(df, period).toPandas().sort_values(["symbol", "date"])
    for symbol, prices in series.items():
        got = found[found.symbol == symbol][f"ema_{period}"].tolist()
        assert got == pytest.approx(loop_ema(prices, period), rel=1e-9)


def test_flat_rising_falling(spark):
    df = arrays(
        spark, flat=[100.0] * 40, up=[100.0 + i for i in range(40)], down=[200.0 - i for i in range(40)], short=[1.0, 2.0, 3.0], none=[]
    )
    rsi = {r.symbol: r.rsi for r in indicators.rsi(df).collect()}
    assert rsi["flat"] == 50.0 and rsi["up"] > 95 and rsi["down"] < 5 and rsi["short"] is None and rsi["none"] is None
    macd = {r.symbol: r for r in indicators.macd(df).collect()}
    assert macd["flat"].macd_line == 0 and macd["up"].macd_line > 0 > macd["down"].macd_line
    bands = {r.symbol: r for r in indicators.bollinger(df).collect()}
    assert bands["flat"].bb_upper == bands["flat"].bb_middle == bands["flat"].bb_lower == 100.0


# A well-known 15-price example whose RSI lies between 72 and 74.
FIFTEEN = [44.0, 44.34, 44.09, 43.61, 44.33, 44.83, 45.10, 45.42, 45.84, 46.08, 45.89, 46.03, 45.61, 46.28, 46.28]


def test_known_rsi(spark):
    value = indicators.rsi(arrays(spark, x=FIFTEEN)).first().rsi
    assert value == pytest.approx(loop_rsi(FIFTEEN), abs=1e-4) and 72 < value < 74


@pytest.mark.parametrize(
    "values, signal",
    [
        ((22.0, 0.5, 95.5, 110.0, 95.0), "strong_buy"),
        ((82.0, -0.5, 109.5, 110.0, 90.0), "strong_sell"),
        ((38.0, 0.3, 100.0, 110.0, 90.0), "buy"),
        ((62.0, -0.3, 100.0, 110.0, 90.0), "sell"),
        ((50.0, 0.0, 100.0, 105.0, 95.0), "hold"),
        ((22.0, 0.5, 100.0, 100.0, 100.0), "strong_buy"),
        ((None, 0.5, 95.5, 110.0, 95.0), "hold"),
        ((22.0, None, 95.5, 110.0, 95.0), "hold"),
        ((22.0, 0.5, None, 110.0, 95.0), "hold"),
        ((22.0, 0.5, 95.5, None, 95.0), "hold"),
        ((22.0, 0.5, 95.5, 110.0, None), "hold"),
    ],
)
def test_classify_signal(spark, values, signal):
    df = spark.createDataFrame([values], "a double, b double, c double, d double, e double")
    assert df.select(classify_signal(*[F.col(c) for c in "abcde"])).first()[0] == signal


BAR = "symbol string, sector string, date date, day_close double, total_volume long, avg_change_pct double"


@pytest.fixture(scope="module")
def bars(spark):
    rng = random.Random(3)
    rows = [
        (s, "S", i, 100 + rng.random() * 10, rng.choice([0, 100, 100, 900]), None)
        for s in "AB"
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, BAR.replace("date date", "day int"))
    return df.withColumn("date", F.date_add(F.lit("2026-01-01"), F.col("day"))).drop("day").repartition(5).cache()


def by_symbol(df, symbol):
    return df.where(F.col("symbol") == symbol).orderBy("date").collect()


def test_moving_averages(bars):
    source = by_symbol(bars, "A")
    for i, row in enumerate(by_symbol(windows.moving_averages(bars), "A")):
        for n in (5, 20, 50):
            expected = statistics.fmean(r.day_close for r in source[i - n + 1 : i + 1]) if i >= n - 1 else None
            assert row[f"sma_{n}"] == (expected and pytest.approx(expected, abs=1.01e-4))
        if i >= 19:
            last = source[i - 19 : i + 1]
            volume = sum(r.total_volume for r in last)
            expected = sum(r.day_close * r.total_volume for r in last) / volume
            assert row.vwap_20 == pytest.approx(expected, abs=1.01e-4)


def test_vwap_without_volume_is_null(bars):
    assert windows.moving_averages(bars.withColumn("total_volume", F.lit(0))).where("vwap_20 IS NOT NULL").count() == 0


def test_volume_spikes(bars):
    source, found = by_symbol(bars, "B"), by_symbol(windows.volume_spikes(bars), "B")
    assert len(found) == len(source) - 1
    for i, row in enumerate(found, start=1):
        mean = statistics.fmean(r.total_volume for r in source[max(0, i - 20) : i])
        if mean == 0:
            assert row.volume_ratio is None and row.is_spike is None
        else:
            assert row.is_spike == (source[i].total_volume / mean > 2.0)
            assert row.volume_ratio == pytest.approx(source[i].total_volume / mean, abs=0.0051)
    assert len(by_symbol(windows.volume_spikes(bars, min_periods=20), "B")) == len(source) - 20


def test_daily_change(bars):
    source, found = by_symbol(bars, "A"), by_symbol(windows.daily_change(bars), "A")
    assert found[0].avg_change_pct == 0.0
    for before, now, row in zip(source, source[1:], found[1:]):
        assert row.avg_change_pct == pytest.approx((now.day_close / before.day_close - 1) * 100)


def ranked(df):
    return sorted(map(str, df.collect()))


def plain_ranks(df):
    """What a window over whole groups gives."""
    group = Window.partitionBy("sector", "date")
    return df.withColumns({"rank": F.rank().over(group.orderBy(F.desc_nulls_last("v"))).cast("bigint"), "size": F.count("*").over(group)})


@pytest.mark.parametrize("largest", [10**6, 500, 0])
def test_ranking_equals_window(spark, largest):
    """With no group cut, some, or all.  Half the rows tie, values span many magnitudes or lie within 1 %, some are missing or special, one group is hot."""
    rng = random.Random(5)
    special = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]

    def value(close):
        kind = rng.random()
        if kind < 0.1:
            return rng.choice(special)
        if close:
            return 100 + rng.random()
        return 0.0 if kind < 0.3 else 10.0 if kind < 0.5 else rng.gauss(0, 1) * 10 ** rng.randint(-6, 6)

    rows = [(str(i), rng.choice(["a", "a", "a", "b", None]), i % 2, value(i % 2)) for i in range(4000)]
    df = spark.createDataFrame(rows, "symbol string, sector string, date int, v double").repartition(7)
    plain = plain_ranks(df)
    assert ranked(rank_within(df, ("sector", "date"), "v", largest).select(*plain.columns)) == ranked(plain)


def test_ranking_spreads_a_hot_group_and_a_hot_value(spark):
    """A third of the rows of one group tie: they go to many lanes, and no piece holds much of the rest."""
    df = spark.range(30_000).selectExpr("'a' AS sector", "1 AS date", "if(id % 3 = 0, 5.0, id * 0.001) AS v", "id AS `x.y`", "map('k', id) AS m")
    found = rank_within(df, ("sector", "date"), "v", largest=1000)
    assert found.columns == [*df.columns, "rank", "size"]
    rows = found.select("v", "rank", "size").collect()
    above = sum(r["v"] > 5.0 for r in rows)
    assert {r["rank"] for r in rows if r["v"] == 5.0} == {above + 1} and {r["size"] for r in rows} == {30_000}
    assert sorted(r["rank"] for r in rows if r["v"] > 5.0) == list(range(1, above + 1))


def test_ranking_needs_no_job_to_be_planned(spark):
    df = spark.createDataFrame([("a", 1.0)], "sector string, v double")
    broken = df.withColumn("v", F.when(F.raise_error(F.lit("evaluated")).isNull(), 1.0))
    rank_within(broken, ("sector",), "v")


def test_percentile_of_ties(spark):
    rows = [("A", "S", 1, 3.0), ("B", "S", 1, 2.0), ("C", "S", 1, 2.0), ("D", "S", 1, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, sector string, date int, avg_change_pct double")
    got = {r.symbol: (r.sector_rank, r.sector_size, r.percentile) for r in windows.sector_rankings(df).collect()}
    assert got == {"A": (1, 4, 100.0), "B": (2, 4, 75.0), "C": (2, 4, 75.0), "D": (4, 4, 25.0)}


def test_bars_without_a_close_count_for_nothing(spark):
    closes = [100.0 + (i * 7) % 11 for i in range(40)]
    gaps = closes[:20] + [None] + closes[20:] + [None]
    whole, holed = (
        indicators.market_signals(bars.withColumn("sector", F.lit("S"))).drop("latest_date").collect()[0]
        for bars in (arrays(spark, a=closes), arrays(spark, a=gaps))
    )
    assert whole == holed and whole.latest_close == closes[-1]


def test_ema_needs_no_lists(spark):
    plan = indicators.ema(arrays(spark, a=[1.0] * 5), 3)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
