"""Series of any length, cut by time so that no task holds a whole one.

Daily bars of one symbol fit into a task; its one-minute candles, or a symbol
with a third of all rows, need not.  Rows are therefore shuffled by symbol and
stretch of time.  A short table with one row per symbol and stretch (how many
values it has, and the last of them) says where in the whole series each stretch
begins and what went before it.  Positions, lengths and changes follow, and with
them all that is a weighted sum over the series.

Rolling windows need the rows before, too: once positions are known, rows are
cut into blocks of equally many, and the last few rows of each block are copied
to the next one.

A symbol that is missing is a symbol of its own; rows without a time come first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

# Stands before all times; what rows without a time are put at.
NO_TIME = -(2**62)
MICROS_PER_DAY = 86_400_000_000


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def moment(rows: DataFrame, order: str, width: float) -> tuple[Column, int]:
    """The order column as a whole number, and the width of a piece in its unit."""
    kind = rows.schema[order].dataType
    if isinstance(kind, DateType):
        at, unit = F.unix_date(order), 1
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        at, unit = F.unix_micros(F.col(order).cast("timestamp")), MICROS_PER_DAY
    else:
        at, unit = F.col(order).cast("long"), 1
    return F.coalesce(at.cast("long"), F.lit(NO_TIME)), max(1, int(width * unit))


def located(rows: DataFrame, width: float, value: str | None = None, order: str = "date") -> DataFrame:
    """Rows with their place in the series of their symbol.

    ``width`` is the length of a stretch, in days for dates and timestamps, else
    in units of the order column; choose it so that a stretch of the densest
    series fits into a task (a week of one-minute candles is 10,080 rows).

    Adds ``_of`` and ``_piece`` (what the rows are shuffled by), ``_pos``, the
    zero-based position among the rows that have ``value`` (NULL for others),
    ``_len``, the number of these, and ``_before``, the last value before the row.
    Without ``value`` every row counts, and ``_before`` is NULL.  The rows are
    shuffled once; symbols meet in one task only with one row per stretch.
    """
    at, unit = moment(rows, order, width)
    key = F.coalesce(F.concat(F.lit("="), F.col("symbol").cast("string")), F.lit(""))
    counted = F.lit(1) if value is None else F.col(value)
    shown = F.lit(None).cast("double") if value is None else F.col(value)
    cut = rows.withColumns({"_of": key, "_at": at}).withColumn("_piece", F.floor(F.col("_at") / unit).cast("long"))

    ends = cut.groupBy("_of", "_piece").agg(
        F.count(counted).alias("_n"), F.max_by(shown, F.when(shown.isNotNull(), F.col("_at"))).alias("_last")
    )
    pieces = Window.partitionBy("_of").orderBy("_piece")
    earlier = pieces.rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        "_of",
        "_piece",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_n").over(pieces.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_len"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
    )

    inside = Window.partitionBy("_of", "_piece").orderBy("_at")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumns({"_inside": F.count(counted).over(so_far), "_previous": F.last(shown, ignorenulls=True).over(before)})
        .join(starts, ["_of", "_piece"])
        .withColumns(
            {
                "_pos": F.when(counted.isNotNull(), F.col("_start") + F.col("_inside") - 1),
                "_before": F.coalesce("_previous", "_carried"),
            }
        )
        .drop("_at", "_inside", "_previous", "_start", "_carried")
    )


def over_blocks(
    rows: DataFrame,
    measure: Callable[[DataFrame], DataFrame],
    halo: int,
    width: float,
    order: str = "date",
    block: int = 100_000,
) -> DataFrame:
    """``measure``, whose windows go over (symbol, ``order``), with every series cut into blocks.

    ``halo`` is the number of rows before a row that ``measure`` looks at, at
    most ``block``.  For ``measure`` a symbol is the pair of symbol and block, and
    the order begins with the position, so any function of rolling windows will do
    that hands on both columns.  A block holds ``block`` + ``halo`` rows at most.
    """
    if not 0 <= halo <= block:
        raise ValueError(f"a halo of {halo} rows reaches beyond a block of {block}")
    own = F.floor(F.col("_pos") / block).cast("long")
    copies = F.when(F.col("_pos") % block >= block - halo, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = located(rows, width, order=order).withColumn("_own", own).withColumn("_block", F.explode(copies))
    keyed = dealt.select(
        *[_quoted(c) for c in rows.columns if c not in ("symbol", order)],
        F.struct(F.col("symbol").alias("of"), F.col("_block").alias("block")).alias("symbol"),
        F.struct(F.col("_pos").alias("pos"), F.col(order).alias("at"), (F.col("_own") == F.col("_block")).alias("own")).alias(order),
    )
    measured = measure(keyed)
    return measured.where(F.col(f"{order}.own")).withColumns({"symbol": F.col("symbol.of"), order: F.col(f"{order}.at")})
