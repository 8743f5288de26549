"""Streams from source to stored table.

Each job processes what is waiting and stops (``availableNow``).  Output and
progress live in shared folders, so a job that lost its executors, or its
driver, continues where it was; the file sink commits each micro-batch once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from quotewell.operators import bronze, gold, news, silver
from quotewell.operators.silver import TICK_RULES, Rule
from quotewell.sources import readers
from quotewell.streaming import running


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str, partition_by: Sequence[str] = ()) -> str:
    """Run a stream over all waiting input into an append-only parquet folder."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()
    return out


def run_each(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch of waiting input to ``handle`` with its number.

    A batch whose handling failed comes again with the same number and rows, so
    ``handle`` must overwrite what it writes.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start().awaitTermination()


def run_fold(
    stream: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame], empty: DataFrame, path: str, checkpoint: str
) -> DataFrame:
    """Fold every micro-batch into a small table kept at ``path``, and return its newest state.

    ``fold`` gets the state before, in a first batch ``empty``, and the new rows.
    Batch n reads the state that batch n - 1 wrote and writes its own beside it,
    so a batch that is repeated after a failure is still counted once.
    """

    def step(batch: DataFrame, number: int) -> None:
        before = batch.sparkSession.read.schema(empty.schema).parquet(f"{path}/batch={number - 1}") if number else empty
        fold(before, batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_each(stream, step, checkpoint)
    return newest_state(stream.sparkSession, path, empty.schema)


def newest_state(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The state that the last batch wrote; no rows before the first."""
    states = readers.table_so_far(spark, path, StructType([*schema.fields]).add("batch", IntegerType()))
    return states.where(F.col("batch") == states.agg(F.max("batch")).scalar()).drop("batch")


def run_candles(stream: DataFrame, out: str, checkpoint: str, width: str = "1 minute", watermark: str = "2 minutes") -> str:
    """Candles of a tick stream with ``trade_time``; only closed windows are written."""
    return run_to_parquet(gold.candles(stream, width, watermark), out, checkpoint)


def run_quality(
    stream: DataFrame, out: str, checkpoint: str, rules: Sequence[Rule] = TICK_RULES, partition_by: Sequence[str] = ()
) -> str:
    """Split a stream into good and rejected rows in one pass.

    The output folder has the partitions ``quality=silver`` and
    ``quality=quarantine``, cut further by ``partition_by``; both come from the
    same commit.
    """
    return run_to_parquet(silver.quality_split(stream, rules), out, checkpoint, ["quality", *partition_by])


def run_quality_counts(stream: DataFrame, path: str, checkpoint: str, rules: Sequence[Rule] = TICK_RULES) -> DataFrame:
    """Rows passed and failed per rule over all that a stream has delivered: each batch's counts are added to those kept at ``path``."""
    spark = stream.sparkSession
    empty = spark.createDataFrame([], "rule STRING, passed BIGINT, failed BIGINT")

    def fold(before: DataFrame, batch: DataFrame) -> DataFrame:
        both = before.unionByName(silver.quality_report(batch, rules))
        return both.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))

    return run_fold(stream, fold, empty, path, checkpoint)


def run_news(stream: DataFrame, out: str, checkpoint: str, **scoring) -> str:
    """Score a stream of raw articles; needs no state."""
    return run_to_parquet(news.news_silver(bronze.bronze_news(stream), **scoring), out, checkpoint)


def run_signals(bars: DataFrame, out: str, checkpoint: str, order: str = "date") -> DataFrame:
    """Follow a stream of bars; returns the indicators and signals at each symbol's newest bar."""
    rows = running.follow(bars, order)
    run_to_parquet(rows, out, checkpoint)
    return running.newest(readers.table_so_far(bars.sparkSession, out, rows.schema))


def first_seen(
    stream: DataFrame, key: str = "headline", time: str = "ingest_time", within: str = "1 day", lanes: int = 8
) -> DataFrame:
    """Articles whose headline has not come in during the last ``within``; state is bounded by it.

    The time is that of arrival, so undated articles and those published long ago are kept.

    Copies of one headline are first thinned out in ``lanes`` by input task, so
    that a headline with very many copies never goes to a single task whole.
    """
    timed = stream.withWatermark(time, within)
    if lanes > 1:
        lane = F.spark_partition_id() % lanes
        timed = timed.withColumn("_lane", lane).dropDuplicatesWithinWatermark([key, "_lane"]).drop("_lane")
    return timed.dropDuplicatesWithinWatermark([key])


def run_dedupe(stream: DataFrame, out: str, checkpoint: str, within: str = "1 day") -> str:
    """Drop repeated headlines of an article stream with ``ingest_time``."""
    return run_to_parquet(first_seen(stream, within=within), out, checkpoint)
