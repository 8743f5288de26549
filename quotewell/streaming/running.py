"""Indicators that follow a stream of bars, one small state per symbol.

A state holds the recurrences' last values and as many closes as the bands need,
so a new bar costs the same however long the series before it is, and nothing
already seen is read again.  The state lives in the state store and is committed
with the output, so a stream that is started anew goes on where it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quotewell.operators import indicators
from quotewell.operators.pieces import MICROS_PER_DAY, moment

RSI, FAST, SLOW, SIGNAL, BAND = 14, 12, 26, 9, 20

STATE = (
    "seen BIGINT, at BIGINT, close DOUBLE, fast DOUBLE, slow DOUBLE, signal DOUBLE, gain DOUBLE, loss DOUBLE, closes ARRAY<DOUBLE>"
)
PARTS = (
    "symbol STRING, seen BIGINT, at BIGINT, sector STRING, latest_close DOUBLE, _gain DOUBLE, _loss DOUBLE, "
    "_line DOUBLE, _signal DOUBLE, _mean DOUBLE, _spread DOUBLE"
)


def averaged(before: float, value: float, count: int, period: int, rate: float) -> float:
    """The average after its ``count``-th value: the plain mean of the first ``period``, then smoothed."""
    if count <= period:
        return before + (value - before) / count
    return before + (value - before) * rate


class Running:
    """The state of one symbol."""

    def __init__(self, stored: tuple | None = None):
        self.seen, self.at, self.close, self.fast, self.slow, self.signal, self.gain, self.loss, closes = stored or (0, None, *[0.0] * 6, [])
        self.closes = list(closes)

    def stored(self) -> tuple:
        return (self.seen, self.at, self.close, self.fast, self.slow, self.signal, self.gain, self.loss, self.closes)

    def add(self, at: int, close: float) -> None:
        if self.seen:
            change = close - self.close
            self.gain = averaged(self.gain, max(change, 0.0), self.seen, RSI, 1 / RSI)
            self.loss = averaged(self.loss, max(-change, 0.0), self.seen, RSI, 1 / RSI)
        self.seen, self.at, self.close = self.seen + 1, at, close
        self.fast = averaged(self.fast, close, self.seen, FAST, 2 / (FAST + 1))
        self.slow = averaged(self.slow, close, self.seen, SLOW, 2 / (SLOW + 1))
        if self.seen >= SLOW:
            self.signal = averaged(self.signal, self.fast - self.slow, self.seen - SLOW + 1, SIGNAL, 2 / (SIGNAL + 1))
        self.closes = [*self.closes[1 - BAND :], close]

    def parts(self) -> tuple:
        """What the indicators are made of, NULL where there are too few bars."""
        moves, line = self.seen > RSI, self.seen >= SLOW
        band = np.array(self.closes) if self.seen >= BAND else None
        return (
            self.gain if moves else None,
            self.loss if moves else None,
            self.fast - self.slow if line else None,
            self.signal if self.seen >= SLOW + SIGNAL - 1 else None,
            None if band is None else float(band.mean()),
            None if band is None else float(band.std()),
        )


def _advance(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Moves a symbol's state on by the bars of a micro-batch and emits where it stands then."""
    new = pd.concat(list(rows)).sort_values("at", kind="stable")
    running = Running(state.get if state.exists else None)
    sector, before = None, running.seen
    for at, close, of in zip(new["at"], new["close"], new["sector"]):
        if running.at is None or at > running.at:
            running.add(int(at), float(close))
            sector = of
    if running.seen > before:
        state.update(running.stored())
        columns = [c.split()[0] for c in PARTS.split(", ")]
        yield pd.DataFrame([(key[0], running.seen, running.at, sector, running.close, *running.parts())], columns=columns)


def follow(bars: DataFrame, order: str = "date") -> DataFrame:
    """A stream of bars as a stream of indicators and signals: a row per symbol and micro-batch with new bars of it.

    ``order`` is a date or a timestamp.  ``seen`` counts the symbol's bars so far,
    so the row with the largest is the newest.  Bars without symbol, time or close count for
    nothing, and so do bars no later than those that earlier batches had: a
    recurrence cannot take them in afterwards.  Of bars at the same time in a batch one
    counts.  A batch's bars of a symbol are sorted in one task; the source's
    limit per trigger bounds them.
    """
    at, unit = moment(bars, order, 1)
    kept = bars.where(F.col("symbol").isNotNull() & F.col(order).isNotNull() & F.col("day_close").isNotNull())
    narrow = kept.select("symbol", "sector", at.alias("at"), F.col("day_close").cast("double").alias("close"))
    parts = narrow.groupBy("symbol").applyInPandasWithState(_advance, PARTS, STATE, "append", GroupStateTimeout.NoTimeout)
    latest = F.timestamp_micros("at") if unit == MICROS_PER_DAY else F.date_from_unix_date(F.col("at").cast("int"))
    return indicators.with_signal(indicators.of_parts(parts.withColumn("latest_date", latest), "seen"))


def newest(rows: DataFrame) -> DataFrame:
    """The last row of each symbol out of all that ``follow`` has written."""
    whole = F.struct(*[c for c in rows.columns if c not in ("symbol", "seen")])
    return rows.groupBy("symbol").agg(F.max_by(whole, "seen").alias("_row")).select("symbol", "_row.*")
