"""Sinks and file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_ndjson(df: DataFrame, path: str) -> str:
    """Append rows as newline-delimited UTF-8 JSON; an empty batch only makes the folder."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)
    return path


def write_overwrite(df: DataFrame, path: str) -> str:
    """Replace an unpartitioned table, schema included."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: str = "date", cluster: str = "symbol", whole: bool = True) -> str:
    """Replace a table partitioned by ``by``, or only the partitions present in ``df``.

    Rebalancing gathers each partition value into few files and cuts a value
    that holds too much into several; inside a file rows are sorted, so that
    look-ups by ``cluster`` skip row groups.
    """
    (
        df.hint("rebalance", F.col(by))
        .sortWithinPartitions(by, cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    return path


def write_clustered(df: DataFrame, path: str, cluster: str = "symbol", then: str = "date") -> str:
    """Replace a table laid out for look-ups by ``cluster``.

    Range partitioning on both columns gives files narrow key ranges, and cuts
    a key with very many rows by ``then``.
    """
    (
        df.repartitionByRange(cluster, then)
        .sortWithinPartitions(cluster, then)
        .write.mode("overwrite")
        .parquet(path)
    )
    return path


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, by: str = "symbol", then: str = "date") -> str:
    """Replace a catalogued table bucketed by ``by`` and sorted for windows over it.

    Every rolling measure and indicator on such a table runs without a shuffle.
    Meant for bars, of which a symbol has one per date at most.
    """
    (
        df.repartition(buckets, by)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, by)
        .sortBy(by, then)
        .saveAsTable(table)
    )
    return table


def create_news_staging(spark: SparkSession, table: str, location: str | None = None) -> None:
    """The landing table for articles, if it is not there yet; at ``location`` or in the warehouse."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ("
        "headline STRING, summary STRING, source STRING, url STRING, symbols ARRAY<STRING>, published_at STRING"
        f") USING parquet{at}"
    )


def append_to_staging(df: DataFrame, table: str) -> None:
    """Append articles to the landing table, which streams read; it is never overwritten."""
    df.select("headline", "summary", "source", "url", "symbols", "published_at").write.mode("append").insertInto(table)


def history_profile(bars: DataFrame) -> DataFrame:
    """Bars per symbol with first and last date."""
    return bars.groupBy("symbol").agg(
        F.count("*").alias("days"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [t.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result
