"""A bit filter over 64-bit keys, of bounded size, for pruning in front of an exact step."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter at most: 32 MB as a broadcast, whatever the number of keys.
MOST_BITS = 1 << 28
LEAST_BITS = 1 << 16
#: Bits a key, while that stays below MOST_BITS: one key in sixteen that is not in the table passes.
PER_KEY = 16
#: Bits of one row of Spark's bitmap functions.
ROW_BITS = 1 << 15


class Filter:
    """Which keys may be in a table: never a wrong no, sometimes a wrong yes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.shift = np.uint64(64 - (8 * len(bits)).bit_length() + 1)

    def __contains__(self, keys: np.ndarray) -> bool:
        return bool(self.has(keys).any())

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.bits[(at >> np.uint64(3)).view(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def filter_of(keys: DataFrame, key: str = "key", most_bits: int = MOST_BITS) -> Filter:
    """The filter of a table's long column ``key``, whose top bits must be as good as random.

    It is put together by Spark in rows of 4 kB and only then brought to the driver: at most
    ``most_bits`` bits. With more keys than that allows the filter lets more through, and the exact step
    behind it has more to do.
    """
    return filters_of(keys.withColumn("level", F.lit(0)), 1, key, most_bits)[0]


def filters_of(keys: DataFrame, levels: int, key: str = "key", most_bits: int = MOST_BITS) -> list[Filter]:
    """A filter for each value from 0 to ``levels`` - 1 of the column ``level``, all of one size and as ``filter_of``."""
    most = max((r.n for r in keys.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()), default=0)
    size = min(max(1 << max(int(most) * PER_KEY - 1, 1).bit_length(), LEAST_BITS), most_bits)
    # Spark's bitmap rows count from one; position 1 is bit 0 of row 1.
    placed = keys.select("level", (F.shiftrightunsigned(F.col(key), 65 - size.bit_length()) + 1).alias("bit"))
    rows = placed.groupBy("level", F.bitmap_bucket_number("bit").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    bits = [np.zeros(size // 8, dtype=np.uint8) for _ in range(levels)]
    for row in rows.collect() if most else ():
        at = (row.row - 1) * (ROW_BITS // 8)
        bits[row.level][at:at + ROW_BITS // 8] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return [Filter(b) for b in bits]
