"""A set of numbers as a bitmap of bounded size: a filter that may let strangers pass, but never stops a member."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHUNK = 1 << 15  # bits that Spark's bitmap aggregate puts into one value


class Bitmap:
    """Bits of the members' lowest digits."""

    def __init__(self, bits: bytes):
        self.bits = bits
        self.mask = 8 * len(bits) - 1

    def __contains__(self, number: int) -> bool:
        at = number & self.mask
        return self.bits[at >> 3] >> (at & 7) & 1 == 1

    def holds(self, numbers: np.ndarray) -> np.ndarray:
        at = (numbers & np.uint64(self.mask)).astype(np.int64)
        return (np.frombuffer(self.bits, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bitmap_of(members: DataFrame, column: str, most_bits: int = 1 << 27) -> Bitmap:
    """Of a column of integers, which is read twice.

    Sixteen bits a member, `most_bits` (16 MB) at most: what goes to the driver and to all tasks is bounded by that. A fuller
    bitmap lets more pass; whoever uses it stays right and has more to compare.
    """
    count = members.count()
    bits = min(most_bits, 1 << max(15, math.ceil(math.log2(16 * count + 1))))
    slot = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1  # counted from 1
    chunks = members.select(F.bitmap_bucket_number(slot).alias("chunk"), F.bitmap_bit_position(slot).alias("at")).groupBy(
        "chunk").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for row in chunks:
        start = (row["chunk"] - 1) * _CHUNK // 8
        out[start:start + _CHUNK // 8] = np.frombuffer(row["bits"], np.uint8)
    return Bitmap(out.tobytes())
