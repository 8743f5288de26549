"""Exponential smoothing written as weighted sums.

A smoothed value is linear in the prices: each price contributes with a weight
that depends only on its position and on the length of the series.  The latest
value of a recurrence is therefore an ordinary ``sum(weight * price)``, which
Spark aggregates partially and in any order; no series is gathered into an array
and nothing loops over rows.

``pos`` is the zero-based position in the series and ``n`` its length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def span_rate(period: int) -> float:
    """Smoothing rate of an EMA over ``period`` values."""
    return 2.0 / (period + 1)


def _power(base: float, exponent: Column) -> Column:
    return F.pow(F.lit(base), exponent)


def smoothing_weight(pos: Column, n: Column, period: int, rate: float) -> Column:
    """Weight of a value in the smoothed series' last value.

    The series starts with the plain mean of the first ``period`` values and goes
    on with ``s = rate * x + (1 - rate) * s``.  Needs ``n >= period``.
    """
    keep = 1.0 - rate
    seed = _power(keep, n - period) / period
    later = rate * _power(keep, n - 1 - pos)
    return F.when(pos < period, seed).otherwise(later)


def _seed_states(fast: int, slow: int, signal: int) -> tuple[list[float], list[float], list[float]]:
    """Weights of the first values in the states (fast, slow, signal) once all three run.

    A few dozen numbers fixed by the three periods alone.
    """
    length = slow + signal - 1

    def running(period: int, t: int) -> list[float]:
        """Weights of the EMA at time t on the values 0..length-1."""
        rate = span_rate(period)
        keep = 1.0 - rate
        seed = keep ** (t - period + 1) / period
        return [
            0.0 if j > t else seed if j < period else rate * keep ** (t - j) for j in range(length)
        ]

    at_fast = running(fast, length - 1)
    at_slow = running(slow, length - 1)
    at_signal = [0.0] * length
    for t in range(slow - 1, length):
        for j, (f, s) in enumerate(zip(running(fast, t), running(slow, t))):
            at_signal[j] += (f - s) / signal
    return at_fast, at_slow, at_signal


def signal_weight(pos: Column, n: Column, fast: int, slow: int, signal: int) -> Column:
    """Weight of a price in the last value of the MACD signal line.

    The signal line smooths fast EMA minus slow EMA.  Up to the point where all
    three averages run, the weights are constants; after it, the response of two
    smoothers in a row has the closed form below.  Needs ``n >= slow + signal - 1``.
    """
    started = slow + signal - 1
    rate = span_rate(signal)
    keep = 1.0 - rate

    def through(other: float, steps: Column) -> Column:
        """sum over t = 1..steps of rate * keep^(steps - t) * other^(t - 1)."""
        if math.isclose(other, keep):
            return rate * steps * _power(keep, F.greatest(steps - 1, F.lit(0)))
        return (_power(other, steps) - _power(keep, steps)) * (rate / (other - keep))

    fast_rate, slow_rate = span_rate(fast), span_rate(slow)
    fast_keep, slow_keep = 1.0 - fast_rate, 1.0 - slow_rate

    steps = n - started
    at_fast, at_slow, at_signal = (
        F.get(F.array(*[F.lit(w) for w in ws]), pos) for ws in _seed_states(fast, slow, signal)
    )
    early = (
        at_signal * _power(keep, steps)
        + at_fast * fast_keep * through(fast_keep, steps)
        - at_slow * slow_keep * through(slow_keep, steps)
    )
    left = n - pos
    late = fast_rate * through(fast_keep, left) - slow_rate * through(slow_keep, left)
    return F.when(pos < started, early).otherwise(late)


def stable_block(rate: float) -> int:
    """How many values may share one scale factor without losing precision."""
    keep = 1.0 - rate
    if keep <= 0.0:
        return 1
    return max(1, int(math.log(1e12) / -math.log(keep)))
