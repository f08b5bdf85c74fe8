"""A bounded map of wanted 64-bit names, sent to tasks to drop most others.

One bit a hash value, ``max_bits`` at most, so its size is bounded whatever the
table; false hits are removed by the join that follows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 26


class Bitmap:
    def __init__(self, names: DataFrame, column: str, max_bits: int = MAX_BITS):
        """names: a table with a bigint column of well-mixed names."""
        count, bits = names.count(), 1 << 16
        while bits < max_bits and bits < 16 * count:
            bits *= 2
        self.mask = bits - 1
        at = F.col(column).bitwiseAND(F.lit(self.mask))
        marks = names.groupBy(F.shiftrightunsigned(at, 6).alias("i")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("w")).toArrow()
        self.words = np.zeros(bits // 64, dtype=np.uint64)
        self.words[marks["i"].to_numpy()] = marks["w"].to_numpy().view(np.uint64)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        """Which of the int64 values may be wanted."""
        low = values.view(np.uint64) & np.uint64(self.mask)
        bit = self.words[low >> np.uint64(6)] >> (low & np.uint64(63))
        return (bit & np.uint64(1)).astype(bool)
