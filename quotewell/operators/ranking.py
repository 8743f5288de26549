"""Ranking inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group with more rows is cut into ranges of its values, up to so many.
LARGEST, STEPS = 2_000_000, 256
# Rows that share one rank need no sorting; they are dealt to so many tasks.
LANES = 64


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which missing keys match each other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def _piece(value: Column, cuts: Column) -> Column:
    """Number of the value's range, odd for the cuts themselves; NULL below all, NaN above all."""
    below = F.size(F.filter(cuts, lambda cut: cut < value))
    return (
        F.when(cuts.isNull(), 0)
        .when(value.isNull(), -1)
        .when(F.isnan(value), 2 * STEPS + 1)
        .otherwise(2 * below + F.array_contains(cuts, value).cast("int"))
    )


def rank_within(df: DataFrame, groups: Sequence[str], value: str, largest: int = LARGEST, counted: Sequence[str] | None = None) -> DataFrame:
    """Adds ``rank`` (falling value, ties share a rank, NaN first, NULL last) and ``size`` of the group.

    A window ranks every range of every group alone, and the rows of the ranges
    above are added.  Groups of up to ``largest`` rows are one range, so that all
    that is shuffled beside the rows is a count per group.  Larger groups are cut
    at their own approximate quantiles, whatever their distribution; a value with
    very many rows is a cut, whose rows share one rank and are dealt to many
    tasks.  There are at most as many large groups as rows / ``largest``, with
    STEPS cuts each at most, which is what is broadcast.  ``counted`` names the columns
    that counting may share with ranking, if a value made of them by a window is not
    to be made for the count as well; all by default.
    """
    groups = list(groups)
    rows = df.withColumn("_value", F.col(value).cast("double") + 0.0)  # -0.0 equals 0.0
    number = F.col("_value")
    # A hash of the columns keeps every use of ``rows`` alike, so that what was shuffled for one serves the others.
    alike = F.max(F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and (counted is None or c in counted)])).alias("_alike")
    large = rows.groupBy(*groups).agg(F.count("*").alias("_size"), alike).where((F.col("_size") > largest) & F.col("_alike").isNotNull())
    large = large.drop("_alike")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    shares = [k / STEPS for k in range(1, STEPS)]
    cuts = (
        _match(rows.select(*groups, "_value"), F.broadcast(large), groups)
        .groupBy(*groups)
        .agg(F.max("_size").alias("_size"), F.percentile_approx(finite, shares, 20 * STEPS).alias("_cuts"))
        .withColumn("_cuts", F.coalesce(F.array_distinct("_cuts"), F.array().cast("array<double>")))
    )
    pieced = _match(rows, F.broadcast(cuts), groups, "left").withColumn("_piece", _piece(number, F.col("_cuts")))
    above = Window.partitionBy(*groups).orderBy(F.desc("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        pieced.where("_cuts IS NOT NULL")
        .groupBy(*groups, "_piece")
        .agg(F.count("*").alias("_rows"))
        .select(*groups, "_piece", F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_above"))
    )
    shared = F.col("_cuts").isNotNull() & (F.col("_piece") % 2 != 0)
    laned = pieced.withColumn("_lane", F.when(shared, F.pmod(F.monotonically_increasing_id(), F.lit(LANES))).otherwise(0))
    inside = Window.partitionBy(*groups, "_piece", "_lane").orderBy(F.desc_nulls_last("_value"))
    ranked = laned.withColumns(
        {
            "_before": F.when(shared, 0).otherwise(F.rank().over(inside) - 1),
            # in the order of the ranks, so that one window has both
            "_together": F.count("*").over(inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    return (
        _match(ranked, F.broadcast(pieces), [*groups, "_piece"], "left")
        .withColumns(
            {
                "rank": (F.coalesce("_above", F.lit(0)) + F.col("_before") + 1).cast("long"),
                "size": F.coalesce("_size", "_together"),
            }
        )
        .select(*[F.col(f"`{c}`") for c in df.columns], "rank", "size")
    )
