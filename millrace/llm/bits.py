"""Bit filters of a fixed size: which hashes a table holds, with false positives and no false negatives.

The size is a parameter, not a function of the data, so what is collected and broadcast is bounded. A filter that
fills up lets more through; callers use filters only where a false positive costs work and never a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: Log of the number of bits: 64 million bits, 8 MB.
SIZE = 26


def bit_filter(df: DataFrame, column: str, size: int = SIZE) -> np.ndarray:
    """The filter over a column of long hashes, as words of 64 bits; at most ``2 ** size / 64`` rows are collected."""
    place = F.col(column).bitwiseAND(F.lit((1 << size) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    rows = df.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    words = np.zeros(1 << (size - 6), dtype=np.uint64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return words


def held(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (signed or unsigned 64-bit) the filter may hold."""
    place = hashes.view(np.uint64) & np.uint64(len(words) * 64 - 1)
    return (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
