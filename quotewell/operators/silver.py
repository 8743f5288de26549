"""Validation, quarantine and enrichment of ticks and articles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quotewell.fixed_values import SYMBOL_SECTORS, VOLUME_LEVELS
from quotewell.functions.signals import volume_category


class Rule(NamedTuple):
    """A named condition every good row meets, and why a row failing it is rejected."""

    name: str
    condition: str
    reason: str


# In order of precedence: a row failing several rules reports the first.
TICK_RULES = (
    Rule("valid_price", "price > 0", "Invalid price"),
    Rule("valid_symbol", "symbol IS NOT NULL", "Invalid symbol"),
    Rule("valid_volume", "volume >= 0", "Invalid volume"),
    Rule("valid_timestamp", "timestamp IS NOT NULL", "Invalid timestamp"),
)

ARTICLE_RULES = (
    Rule("valid_headline", "headline IS NOT NULL", "Invalid headline"),
    Rule("valid_published", "published_at IS NOT NULL", "Invalid published_at"),
)


def _holds(rule: Rule) -> Column:
    """The rule as a plain boolean: a condition that is NULL does not hold."""
    return F.coalesce(F.expr(rule.condition), F.lit(False))


def _all_hold(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [_holds(r) for r in rules])


def _first_reason(rules: Sequence[Rule]) -> Column:
    return F.coalesce(*[F.when(~_holds(r), F.lit(r.reason)) for r in rules])


def enrich(
    ticks: DataFrame,
    sectors: DataFrame | Mapping[str, str] = SYMBOL_SECTORS,
    levels: Mapping[str, int] = VOLUME_LEVELS,
) -> DataFrame:
    """Add price change, percentage change, sector and volume category.

    The percentage is NULL unless the previous close is positive.
    ``sectors`` is a small mapping (inlined, no join) or a table with ``symbol``
    and ``sector`` of any size; for a table Spark picks the join from the size
    it sees, and a hot symbol is on the left where AQE can split it.
    """
    change = F.col("price") - F.col("prev_close")
    if isinstance(sectors, DataFrame):
        found = ticks.join(sectors.select("symbol", "sector"), "symbol", "left")
        sector = F.col("sector")
    else:
        found = ticks
        pairs = [F.lit(v) for item in sectors.items() for v in item]
        sector = F.create_map(*pairs)[F.col("symbol")]
    return found.select(
        *ticks.columns,
        change.alias("price_change"),
        F.when(F.col("prev_close") > 0, change / F.col("prev_close") * 100).alias("price_change_pct"),
        F.coalesce(sector, F.lit("Unknown")).alias("sector"),
        volume_category(F.col("volume"), levels).alias("volume_category"),
    )


def valid(df: DataFrame, rules: Sequence[Rule] = TICK_RULES) -> DataFrame:
    """Rows meeting every rule."""
    return df.where(_all_hold(rules))


def quarantine(df: DataFrame, rules: Sequence[Rule] = TICK_RULES, detail: bool = False) -> DataFrame:
    """Rows failing a rule, with the reason of the first rule they fail.

    ``detail`` adds the offending value, e.g. ``price=-5.0``.
    """
    failed = df.where(~_all_hold(rules)).withColumn("quarantine_reason", _first_reason(rules))
    if not detail:
        return failed
    column_of = {r.name: r.condition.split()[0] for r in rules}
    shown = [
        F.when(
            ~_holds(r),
            F.concat(F.lit(column_of[r.name] + "="), F.coalesce(F.col(column_of[r.name]).cast("string"), F.lit("null"))),
        )
        for r in rules
    ]
    return failed.withColumn("quarantine_detail", F.coalesce(*shown))


def quality_split(df: DataFrame, rules: Sequence[Rule] = TICK_RULES) -> DataFrame:
    """All rows, marked ``silver`` or ``quarantine``, with the reason where rejected.

    One pass: written out partitioned by ``quality``, it is both tables.
    """
    return df.withColumns(
        {
            "quality": F.when(_all_hold(rules), "silver").otherwise("quarantine"),
            "quarantine_reason": _first_reason(rules),
        }
    )


def _rule_counts(rules: Sequence[Rule]) -> list[Column]:
    return [F.count_if(_holds(r)).alias(r.name) for r in rules]


def quality_report(df: DataFrame, rules: Sequence[Rule] = TICK_RULES) -> DataFrame:
    """Rows passed and failed per rule."""
    totals = df.agg(F.count("*").alias("_rows"), *_rule_counts(rules))
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.col(r.name).alias("passed"),
                (F.col("_rows") - F.col(r.name)).alias("failed"),
            )
            for r in rules
        ]
    )
    return totals.select(F.explode(per_rule).alias("_r")).select("_r.*")


def observe_quality(df: DataFrame, name: str | Observation, rules: Sequence[Rule] = TICK_RULES) -> DataFrame:
    """The same rows; their per-rule counts are reported as an observation.

    Works on streams too, where each micro-batch reports its own counts.
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *_rule_counts(rules))
