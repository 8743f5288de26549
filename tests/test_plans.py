"""What the plans look like: pushdown, pruning, shuffles, no Python and no all-pairs joins."""

import re

import pytest

from quotewell.operators import gold, indicators, serving, silver, windows
from quotewell.plans.queries import QUERIES, bronze_of
from quotewell.sources import driver_tables as src
from quotewell.sources import landing, readers

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "bars")
    landing.write_overwrite(src.bars(spark, SF_DIR), path)
    return readers.read_table(spark, path)


#: Queries over cleaned or scored texts, which run in Arrow batches.
TEXT = ("clean_text", "polarity", "score_article", "news_silver", "sentiment", "mood")


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_but_for_text_and_no_all_pairs(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    python = () if any(part in name for part in TEXT) else ("EvalPython", "InPandas", "InArrow")
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", *python):
        assert unwanted not in text


def test_windows_and_indicators_shuffle_once(stored):
    assert shuffles(windows.moving_averages(stored)) == 1
    assert shuffles(windows.volume_spikes(stored)) == 1
    assert shuffles(windows.daily_change(stored)) == 1
    assert shuffles(indicators.ema(stored, 12)) <= 4  # and the join of block ends
    assert shuffles(indicators.market_signals(stored)) == 1


def test_no_shuffle_on_bucketed_bars(spark, stored, tmp_path):
    landing.write_bucketed(stored, "bucketed_bars", str(tmp_path / "bucketed"), 4)
    try:
        bars = spark.table("bucketed_bars")
        assert shuffles(windows.moving_averages(bars)) == 0
        assert shuffles(indicators.market_signals(bars)) == 0
        same = windows.moving_averages(bars).exceptAll(windows.moving_averages(stored))
        assert same.count() == 0
    finally:
        spark.sql("DROP TABLE bucketed_bars")


def test_ranking_shuffles_its_rows_once(spark, stored):
    """Beside the count per group; nothing of what large groups need is left where there are none."""
    ranked = windows.sector_rankings(stored)
    ranked.collect()
    final = plan(ranked).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange (?:hash|range)partitioning", final)) == 1 and "Join" not in final


def test_ranking_makes_its_bars_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(windows.sector_rankings(src.bars(spark, SF_DIR)))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"FileScan parquet \[[^]]*l_shipdate", text)) == 1


def test_ranking_folds_and_sorts_its_bars_once(spark):
    """Counting and ranking share the bars shuffled by symbol, and one window has both rank and size."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(windows.sector_rankings(src.bars(spark, SF_DIR)))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"HashAggregate\(keys=\[symbol[^]]*\], functions=\[max_by\(", text)) == 1
    assert "SortMergeJoin" not in text and len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, \d+\), ENSURE[^\n]*\n[^\n]*HashAggregate", text)) == 1
    assert len(re.findall(r"Window \[rank\([^\n]*count\(1\)", text)) == 1


def test_scans_read_only_what_is_needed(stored):
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(indicators.rsi(stored))))
    assert {c.split(":")[0] for c in schema.split(",")} == {"symbol", "date", "day_close"}


def test_lookup_is_pushed_to_the_scan(stored):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(symbol,7\)", plan(serving.latest_quote(stored, " 7 ")))


def test_latest_slice_reads_one_partition(spark, stored, tmp_path):
    landing.write_partitioned(stored.where("date >= '2001-09-01'"), str(tmp_path / "by-date"))
    table = readers.read_table(spark, str(tmp_path / "by-date"))
    latest = serving.latest_slice(table)
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ = Subquery", plan(latest))
    assert latest.select("date").distinct().count() == 1


def test_aggregates_fold_before_the_shuffle(spark):
    ticks = silver.valid(silver.enrich(bronze_of(spark, SF_DIR)))
    for df in (gold.daily_ohlcv(ticks), gold.candles(ticks), gold.sector_daily(ticks), gold.sector_extremes(ticks)):
        assert "partial_" in plan(df) and shuffles(df) == 1
    for df in (gold.daily_ohlcv(ticks), gold.candles(ticks), gold.sector_daily(ticks), src.bars(spark, SF_DIR)):
        assert "SortAggregate" not in plan(df)


def test_sector_lookup_is_not_shuffled_when_small(spark):
    enriched = silver.enrich(bronze_of(spark, SF_DIR), src.sectors(spark, SF_DIR))
    assert "BroadcastHashJoin" in plan(enriched) and shuffles(enriched) == 0
    assert "Join" not in plan(silver.enrich(bronze_of(spark, SF_DIR)))
