"""Run time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the cores.  Each query
is built and fully evaluated; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

HEADLINE = (
    "silver_enrich",
    "quality_report",
    "daily_ohlcv",
    "candles_1m",
    "sector_daily",
    "daily_bars",
    "moving_averages",
    "sector_rankings",
    "volume_spikes",
    "ema",
    "technical_indicators",
    "market_signals",
    "news_dedupe",
    "clean_text",
    "polarity",
    "score_article",
    "score_article_shipped",
    "news_silver",
    "symbol_sentiment",
    "market_mood",
    "latest_quote",
    "sector_board",
    "top_movers",
    "market_summary",
    "stream_candles",
    "stream_quality",
    "price_layers",
    "news_layers",
    "analytics_layers",
)


def main() -> None:
    from quotewell.plans.queries import QUERIES
    from quotewell.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=8, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds("market_signals")  # start-up and compilation are not the queries' cost
    times = {name: round(min(seconds(name), seconds(name)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
