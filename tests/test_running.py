"""Indicators that follow a stream, against the same over the whole series."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from quotewell.operators import indicators
from quotewell.sources import readers
from quotewell.streaming import jobs
from quotewell.streaming.running import Running
from tests.test_series import loop_ema, loop_rsi, walk

BAR = "symbol string, sector string, date date, day_close double, extra int"


def day(i):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=i)


@pytest.fixture
def follow(spark, tmp_path):
    """Delivers bars and returns the signals after them, every time with a stream started anew."""
    landed, out, state = (str(tmp_path / part) for part in ("bars", "out", "state"))

    def deliver(rows, order="date", schema=BAR):
        df = spark.createDataFrame(rows, schema)
        df.repartition(3).write.mode("append").parquet(landed)
        return jobs.run_signals(readers.table_stream(spark, landed, df.schema), out, state, order)

    return deliver


def rows_of(df):
    doubles = {c: F.round(F.col(c), 3) for c, kind in df.dtypes if kind == "double"}
    return sorted(map(str, df.select(*[doubles.get(c, F.col(c)).alias(c) for c in df.columns]).collect()))


def test_state_equals_loops():
    prices, running = walk(7, 200), Running()
    for i, price in enumerate(prices, start=1):
        running = Running(running.stored())
        running.add(i, price)
        gain, loss, line, signal, mean, _ = running.parts()
        expected = loop_rsi(prices[:i])
        assert (gain is None) == (expected is None)
        if expected is not None and loss:
            assert 100 - 100 / (1 + gain / loss) == pytest.approx(expected)
        if i >= 26:
            lines = [f - s for f, s in zip(loop_ema(prices[:i], 12)[14:], loop_ema(prices[:i], 26))]
            assert line == pytest.approx(lines[-1]) and (signal is None) == (i < 34)
            assert signal is None or signal == pytest.approx(loop_ema(lines, 9)[-1])
        assert mean is None if i < 20 else mean == pytest.approx(sum(prices[i - 20 : i]) / 20)
    assert len(running.closes) == 20


def test_a_stream_gives_what_the_whole_series_gives(spark, follow):
    rng, rows = random.Random(2), []
    for symbol, n in (("a", 120), ("b", 40), ("c", 33), ("d", 14), ("e", 1), ("flat", 50)):
        closes = [5.0] * n if symbol == "flat" else walk(n, n)
        rows += [(symbol, f"S{i % 3}", day(i), None if rng.random() < 0.05 and i else c, 1) for i, c in enumerate(closes)]
    rows += [("gone", "S", day(1), None, 1)]
    for last in (0, 13, 14, 30, 31, 90, 119):
        sent = [r for r in rows if r[2] <= day(last)]
        found = follow([r for r in sent if r[2] > day(max((x for x in (0, 13, 14, 30, 31, 90) if x < last), default=-1))])
        whole = indicators.market_signals(spark.createDataFrame(sent, BAR).where("symbol <> 'gone'"))
        assert rows_of(found.select(whole.columns)) == rows_of(whole)


def test_late_undated_and_nameless_bars_count_for_nothing(follow):
    series = [("a", "S", day(i), c, 1) for i, c in enumerate(walk(1, 60))]
    whole = follow(series[:50]).collect()
    odd = [("a", "S", day(10), 1e6, 1), ("a", "S", None, 1e6, 1), (None, "S", day(99), 1.0, 1), ("a", "S", day(99), None, 1)]
    assert follow(odd).collect() == whole
    (after,) = follow(series[50:]).collect()
    assert after.latest_date == day(59) and after.latest_close == series[-1][3]


def test_no_bars_yet_and_bars_by_time(follow):
    schema = "symbol string, sector string, date timestamp, day_close double"
    empty = follow([], schema=schema)
    assert empty.count() == 0 and "seen" not in empty.columns
    moment = datetime.datetime(2024, 1, 1, 9, 30)
    (row,) = follow([("a", None, moment + datetime.timedelta(minutes=i), 10.0 + i) for i in range(40)], schema=schema).collect()
    assert row.latest_date == moment + datetime.timedelta(minutes=39) and row.rsi == 100.0 and row.sector is None
