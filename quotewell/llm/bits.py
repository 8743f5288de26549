"""Bit maps of a fixed size, gathered from Spark and read with numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bit_words(places: DataFrame, words: int) -> np.ndarray:
    """``words`` 64-bit words with those bits set that the rows name by their place p; the driver gets at most that many rows."""
    masks = places.groupBy(F.expr("shiftright(p, 6)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("mask"))
    found = masks.toArrow()
    out = np.zeros(words, np.uint64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def has_bit(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the bit at each place is set."""
    return (words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) != 0
