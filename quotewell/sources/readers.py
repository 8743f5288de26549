"""Batch and stream sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quotewell import schemas


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table, in full or for a stream's output folder."""
    return spark.read.parquet(path)


def table_so_far(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table of known schema; without rows as long as nothing has been written to it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that a stream writes, as a stream; the folder may still be empty."""
    return spark.readStream.schema(schema).parquet(path)


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON with its schema inferred; for looking at a folder, not for jobs."""
    return spark.read.json(path)


def json_stream(
    spark: SparkSession, path: str, schema: str | StructType, files_per_trigger: int | None = 1
) -> DataFrame:
    """Newline-delimited JSON files as a stream; ``None`` takes all waiting files at once."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def price_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 1) -> DataFrame:
    """Price ticks landed as newline-delimited JSON."""
    return json_stream(spark, path, schemas.PRICE_TICK, files_per_trigger)


def news_stream(spark: SparkSession, path: str, schema: str | StructType = schemas.NEWS_ARTICLE) -> DataFrame:
    """News articles appended to a landing folder of parquet files."""
    return spark.readStream.schema(schema).parquet(path)


def news_table_stream(spark: SparkSession, table: str) -> DataFrame:
    """News articles appended to a catalogued staging table."""
    return spark.readStream.table(table)


def spread(df: DataFrame, pieces: int | None, *keys: str) -> DataFrame:
    """``df`` dealt out to so many pieces by ``keys``; as it is without a number.

    For a table whose files cannot be cut, such as one with a single row group.
    """
    return df.repartition(pieces, *keys) if pieces else df
