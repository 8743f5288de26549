"""Rolling measures over each symbol's daily bars.

A symbol has at most one bar per calendar date, so a window over one symbol holds
a few hundred rows per year however many ticks stand behind them.  All windows
here share one shuffle and one sort on (symbol, date).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quotewell.operators.ranking import rank_within


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def _trailing(rows: int) -> WindowSpec:
    return by_symbol().rowsBetween(1 - rows, Window.currentRow)


def _when_full(rows: int, value: Column) -> Column:
    """NULL until the trailing window holds that many rows."""
    return F.when(F.row_number().over(by_symbol()) >= rows, value)


def moving_averages(bars: DataFrame, spans: Sequence[int] = (5, 20, 50), vwap: int = 20) -> DataFrame:
    """Simple moving averages of the close and the rolling volume-weighted price."""
    averages = [
        F.round(_when_full(n, F.avg("day_close").over(_trailing(n))), 4).alias(f"sma_{n}") for n in spans
    ]
    traded = F.sum(F.col("day_close") * F.col("total_volume")).over(_trailing(vwap))
    volume = F.sum("total_volume").over(_trailing(vwap))
    return bars.select(
        "symbol",
        "sector",
        "date",
        "day_close",
        "total_volume",
        *averages,
        F.round(_when_full(vwap, F.try_divide(traded, volume)), 4).alias(f"vwap_{vwap}"),
    )


def volume_spikes(
    bars: DataFrame, lookback: int = 20, factor: float = 2.0, min_periods: int = 1
) -> DataFrame:
    """Volume against the mean of the preceding bars; days without enough of them are left out."""
    before = by_symbol().rowsBetween(-lookback, -1)
    mean = F.avg("total_volume").over(before)
    seen = F.count("total_volume").over(before)
    ratio = F.col("total_volume") / F.when(F.col("_mean") > 0, F.col("_mean"))
    return (
        bars.select("symbol", "sector", "date", "total_volume", mean.alias("_mean"), seen.alias("_seen"))
        .where(F.col("_seen") >= min_periods)
        .select(
            "symbol",
            "sector",
            "date",
            "total_volume",
            F.round("_mean", 0).cast("long").alias(f"avg_volume_{lookback}d"),
            F.round(ratio, 2).alias("volume_ratio"),
            (ratio > factor).alias("is_spike"),
        )
    )


def daily_change(bars: DataFrame, value: str = "day_close", name: str = "avg_change_pct") -> DataFrame:
    """Day-over-day change in percent; 0 on the first day and after a price that is not positive."""
    previous = F.lag(value).over(by_symbol())
    change = (F.col(value) - previous) / F.when(previous > 0, previous) * 100
    return bars.withColumn(name, F.coalesce(change, F.lit(0.0)))


def sector_rankings(bars: DataFrame) -> DataFrame:
    """Rank, group size and percentile (best is 100) by change within sector and date."""
    # Counting and ranking need the same columns of the bars, which are made and shuffled once; what the change is made of does for counting.
    own = ["symbol", "sector", "date", *[c for c in ("day_close",) if c in bars.columns]]
    counted = own if "day_close" in own else None
    # The date comes first, since sorting tells most rows apart by the first column alone.
    ranked = rank_within(bars.select(*own, "avg_change_pct"), ("date", "sector"), "avg_change_pct", counted=counted)
    share = 1 - (F.col("rank") - 1) / F.col("size")
    return ranked.select(
        "symbol",
        "sector",
        "date",
        "avg_change_pct",
        F.col("rank").cast("int").alias("sector_rank"),
        F.col("size").cast("int").alias("sector_size"),
        F.round(share * 100, 1).alias("percentile"),
    )
