"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.session import scratch_dir

BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"
#: What a worker process keeps between tasks: one thing at a time.
KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What this worker process keeps between tasks as ``name``, made if it isn't there; anything else kept goes."""
    if name not in KEPT:
        KEPT.clear()
        KEPT[name] = make()
    return KEPT[name]


def release() -> None:
    """Frees what an earlier operator has left in this worker process, which Spark uses again for other work."""
    KEPT.clear()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of about ``size`` bytes for what is planned inside, unless the session sets a size of its own.

    Spark cuts batches by rows alone, and holds each several times: outside of
    the heap while it is written, and in the Python worker.
    """
    if spark.conf.get(BATCH_SIZE, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SIZE, str(size))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SIZE)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) only, null texts as empty ones; whatever else the table has, under any name, is left behind."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def fold(id_column: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text, whose crc is 0."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a task holds the derived data of few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def bit_map(places: DataFrame, bits: int) -> bytes:
    """A map of 2 ** ``bits`` bits, little-endian, with those set that the rows (p) name; its size is fixed."""
    word = F.floor(F.col("p") / 64).cast("int")
    mask = F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in places.groupBy(word.alias("word")).agg(mask.alias("mask")).collect():  # at most as many as the map has words
        out[r["word"]] = r["mask"]
    return out.tobytes()
