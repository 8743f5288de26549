"""Look-ups, comparisons and summaries over the stored tables.

A look-up of something unknown gives no rows.  Lists that have no fixed length
come as rows, never as one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.signals import market_tone


def _key(symbol: str) -> Column:
    return F.upper(F.trim(F.lit(symbol)))


def _only(df: DataFrame, symbol: str | None) -> DataFrame:
    return df if symbol is None else df.where(F.col("symbol") == _key(symbol))


def latest_slice(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows at the latest date of the whole table.

    The latest date is a scalar subquery, so on a table partitioned by date only
    that partition is read.
    """
    return df.where(F.col(date) == df.agg(F.max(date)).scalar())


def latest_quote(bars: DataFrame, symbol: str | None = None) -> DataFrame:
    """Latest bar per symbol, or of one symbol, rounded for display."""
    picked = ("sector", "day_open", "day_high", "day_low", "day_close", "total_volume", "avg_change_pct")
    last = _only(bars, symbol).groupBy("symbol").agg(
        F.max("date").alias("date"), F.max_by(F.struct(*picked), "date").alias("_bar")
    )

    def price(name: str) -> Column:
        return F.round(F.col(f"_bar.{name}"), 2)

    return last.select(
        "symbol",
        "date",
        price("day_close").alias("price"),
        price("day_open").alias("open"),
        price("day_high").alias("high"),
        price("day_low").alias("low"),
        F.col("_bar.total_volume").alias("volume"),
        price("avg_change_pct").alias("change_pct"),
        F.col("_bar.sector").alias("sector"),
    )


def sector_board(latest: DataFrame, rankings: DataFrame, sector: str | None = None) -> DataFrame:
    """Members of each sector with their rank, the number of members, and the best and worst.

    ``latest`` is a latest slice.  Members without a rank come last.
    """
    members = latest
    if sector is not None:
        members = latest.where(F.col("sector") == F.initcap(F.trim(F.lit(sector))))
    board = members.join(
        rankings.select("symbol", "date", "sector_rank", "percentile"), ["symbol", "date"], "left"
    )
    place = F.struct(F.col("sector_rank").isNull(), "sector_rank", "symbol")
    totals = board.groupBy(F.col("sector").alias("_sector")).agg(
        F.count("*").alias("stock_count"),
        F.min_by("symbol", place).alias("top_gainer"),
        F.max_by("symbol", place).alias("top_loser"),
    )
    # members without a sector are a group of their own
    return board.join(totals, F.col("sector").eqNullSafe(F.col("_sector"))).select(
        "sector",
        "date",
        "stock_count",
        "top_gainer",
        "top_loser",
        "symbol",
        F.round("day_close", 2).alias("price"),
        F.round("avg_change_pct", 2).alias("change_pct"),
        F.col("sector_rank").alias("rank"),
        "percentile",
    )


def sentiment_lookup(sentiment: DataFrame, symbol: str | None = None) -> DataFrame:
    """Sentiment of one or all symbols with its tone."""
    return _only(sentiment, symbol).select(
        "symbol",
        F.round("avg_sentiment", 3).alias("avg_sentiment"),
        market_tone(F.col("avg_sentiment"), 0.05).alias("label"),
        "article_count",
        "most_positive",
        "most_negative",
    )


def mood_lookup(mood: DataFrame) -> DataFrame:
    """The market mood, rounded for display."""
    return mood.withColumn("avg_score", F.round("avg_score", 3))


def technical_snapshot(signals: DataFrame, symbol: str | None = None) -> DataFrame:
    """Indicators of one or all symbols, rounded, with MACD and bands as structs."""

    def rounded(columns: dict[str, str], digits: int) -> Column:
        return F.struct(*[F.round(c, digits).alias(name) for name, c in columns.items()])

    return _only(signals, symbol).select(
        "symbol",
        "sector",
        F.col("latest_date").alias("date"),
        F.round("latest_close", 2).alias("price"),
        F.round("rsi", 2).alias("rsi"),
        rounded({"line": "macd_line", "signal": "macd_signal", "histogram": "macd_histogram"}, 4).alias("macd"),
        rounded({"upper": "bb_upper", "middle": "bb_middle", "lower": "bb_lower"}, 2).alias("bollinger"),
        "signal",
    )


def compare_symbols(signals: DataFrame, averages: DataFrame, first: str, second: str) -> DataFrame:
    """Signals and latest averages of two symbols side by side; no rows unless both exist."""
    wanted = F.col("symbol").isin(_key(first), _key(second))
    known = signals.where(wanted)
    asked = F.when(_key(first) == _key(second), 1).otherwise(2)
    latest = (
        averages.where(wanted)
        .groupBy("symbol")
        .agg(F.max_by(F.struct("sma_5", "sma_20", "vwap_20"), "date").alias("_avg"))
    )
    found = known.agg(F.count_distinct("symbol")).scalar()
    return (
        known.where(found == asked)
        .join(latest, "symbol", "left")
        .select(
            "symbol",
            "sector",
            F.round("latest_close", 2).alias("price"),
            F.round("rsi", 2).alias("rsi"),
            F.round("macd_histogram", 4).alias("macd_histogram"),
            "signal",
            F.round("_avg.sma_5", 2).alias("sma_5"),
            F.round("_avg.sma_20", 2).alias("sma_20"),
            F.round("_avg.vwap_20", 2).alias("vwap_20"),
        )
    )


def _ranked(
    latest: DataFrame, kind: str, key: Column, value: Column, n: int, last: bool = False, from_end: bool = False
) -> DataFrame:
    """The first or last ``n`` rows by key, numbered from the start or the end of the key order.

    Only these ``n`` rows are ever brought together.
    """
    row = latest.select(F.struct(key.alias("key"), "symbol", value.cast("double").alias("value")).alias("_r"))
    kept = row.orderBy(F.desc("_r") if last else F.asc("_r")).limit(n)
    in_order = F.sort_array(F.collect_list("_r"), asc=not from_end)
    return (
        kept.agg(in_order.alias("_l"))
        .select(F.posexplode("_l").alias("_i", "_r"))
        .select(F.lit(kind).alias("kind"), (F.col("_i") + 1).alias("position"), "_r.symbol", "_r.value")
    )


def _falling(column: str) -> Column:
    """Sort key for a falling order with missing values at the end."""
    return F.struct(F.col(column).isNull(), -F.col(column))


def _gainers(latest: DataFrame, n: int) -> DataFrame:
    return _ranked(latest, "top_gainer", _falling("avg_change_pct"), F.round("avg_change_pct", 2), n)


def _losers(latest: DataFrame, n: int, best_first: bool) -> DataFrame:
    """The far end of the gainers' order, so among equal changes the last symbol is worst."""
    changed = latest.where(F.col("avg_change_pct").isNotNull())
    return _ranked(
        changed,
        "top_loser",
        _falling("avg_change_pct"),
        F.round("avg_change_pct", 2),
        n,
        last=True,
        from_end=not best_first,
    )


def _most_active(latest: DataFrame, n: int) -> DataFrame:
    return _ranked(latest, "most_active", _falling("total_volume"), F.col("total_volume"), n)


def top_movers(latest: DataFrame, n: int = 3) -> DataFrame:
    """Largest gains, largest losses (worst first) and largest volumes, as ranked rows."""
    return (
        _gainers(latest, n)
        .unionByName(_losers(latest, n, best_first=False))
        .unionByName(_most_active(latest, n))
    )


def _signal_rows(signals: DataFrame) -> DataFrame:
    return signals.groupBy(F.col("signal").alias("label")).agg(F.count("*").cast("double").alias("value")).select(
        F.lit("signal").alias("section"), F.lit(None).cast("int").alias("position"), "label", "value"
    )


def _as_section(ranked: DataFrame) -> DataFrame:
    return ranked.select(F.col("kind").alias("section"), "position", F.col("symbol").alias("label"), "value")


def market_summary(latest: DataFrame, signals: DataFrame, spikes: DataFrame, n: int = 3) -> DataFrame:
    """The market on one day as rows of (section, position, label, value).

    Sections: overview (label is the date, value the number of symbols), the top
    movers, signal (count per signal) and volume_spike (ratio of each spike).
    No rows at all if there are no bars.
    """
    overview = latest.agg(F.max("date").cast("string").alias("label"), F.count("*").cast("double").alias("value"))
    any_bar = latest.limit(1).agg(F.count("*")).scalar() > 0
    spiking = spikes.where("is_spike").select(
        F.lit("volume_spike").alias("section"),
        F.lit(None).cast("int").alias("position"),
        F.col("symbol").alias("label"),
        F.round("volume_ratio", 2).alias("value"),
    )
    return (
        overview.where("value > 0")
        .select(F.lit("overview").alias("section"), F.lit(None).cast("int").alias("position"), "label", "value")
        .unionByName(_as_section(top_movers(latest, n)))
        .unionByName(_signal_rows(signals).where(any_bar))
        .unionByName(spiking.where(any_bar))
    )


def dashboard_metrics(latest: DataFrame, signals: DataFrame, n: int = 3) -> DataFrame:
    """Number of symbols, top and bottom movers (both best first), signal counts, as rows."""
    total = latest.agg(F.count("*").cast("double").alias("value")).select(
        F.lit("total").alias("section"),
        F.lit(None).cast("int").alias("position"),
        F.lit("symbols").alias("label"),
        "value",
    )
    any_bar = latest.limit(1).agg(F.count("*")).scalar() > 0
    return (
        total.unionByName(_as_section(_gainers(latest, n)))
        .unionByName(_as_section(_losers(latest, n, best_first=True)))
        .unionByName(_signal_rows(signals).where(any_bar))
    )


def signal_board(signals: DataFrame) -> DataFrame:
    """Display strings per symbol, in symbol order; a dash stands for a missing value."""

    def shown(pattern: str, column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.format_string(pattern, column)).otherwise("—")

    signal = F.upper("signal")
    return signals.orderBy("symbol").select(
        "symbol",
        "sector",
        shown("$%.2f", "latest_close").alias("price"),
        shown("%.1f", "rsi").alias("rsi"),
        shown("%.4f", "macd_histogram").alias("macd_histogram"),
        signal.alias("signal"),
        F.when(signal == "BUY", "green").when(signal == "SELL", "red").otherwise("yellow").alias("color"),
    )


def performance_board(latest: DataFrame, descending: bool = True) -> DataFrame:
    """Symbols by change with a signed label and a colour."""
    change = F.col("avg_change_pct")
    order = [F.desc(change), F.asc("symbol")] if descending else [F.asc(change), F.desc("symbol")]
    return latest.orderBy(*order).select(
        "symbol",
        "sector",
        change.alias("change_pct"),
        F.when(change >= 0, "green").otherwise("red").alias("color"),
        F.when(change.isNotNull(), F.format_string("%+.2f%%", change)).otherwise("—").alias("label"),
    )


def query_log_stats(log: DataFrame) -> DataFrame:
    """Totals and means over a log of answered questions."""
    return log.agg(
        F.count("*").alias("total_queries"),
        F.coalesce(F.sum("tool_calls"), F.lit(0)).alias("total_tool_calls"),
        F.round(F.avg("latency_seconds"), 2).alias("avg_latency"),
        F.round(F.avg("tool_calls"), 1).alias("avg_tools"),
    )
