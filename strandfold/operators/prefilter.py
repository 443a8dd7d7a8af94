"""A bitmap of the keys of a join's smaller side, to drop rows of the larger one before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the bitmap at most: 64 MB to broadcast, whatever the table.
MAX_BITS = 1 << 29
MIN_BITS = 1 << 15
# Bits per key; one key in about eight that is not in the table passes.
BITS_PER_KEY = 8
# Longs of one row of the bitmap; each is looked up among those that are set, so the work grows with the square.
ROW_WORDS = 64
WORD_BITS = 64


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(bits - 1))


def key_bitmap(keyed: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(_row, _words): which hashes of the keys occur, as rows of 512 bytes; at most ``bits`` / 8 bytes in all.

    Each task sets its bits first, so the shuffle carries longs and not keys.
    """
    row_bits = ROW_WORDS * WORD_BITS
    place = F.col("_place")
    words = keyed.select(_place(keys, bits).alias("_place")).groupBy(
        F.floor(place / row_bits).cast("bigint").alias("_row"),
        F.floor(place % row_bits / WORD_BITS).cast("int").alias("_word"),
    ).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % WORD_BITS).cast("int"))).alias("_bits"))
    rows = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_set"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(ROW_WORDS - 1)), lambda i: F.coalesce(F.col("_set")[i], F.lit(0).cast("bigint")))
    return rows.select("_row", dense.alias("_words"))


def bits_for(keys: int) -> int:
    """Bits of a bitmap for so many keys, or 0 if that would be too large to broadcast."""
    wanted = max(1 << max(keys * BITS_PER_KEY - 1, 1).bit_length(), MIN_BITS)
    return wanted if wanted <= MAX_BITS else 0


def may_match(df: DataFrame, keyed: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Rows of ``df`` whose key may occur in ``keyed``, which has ``rows`` rows.

    Never drops a row that has a partner; rows with a null key go, as in any equi-join. The
    bitmap is broadcast, bounded by MAX_BITS. A side of too many rows for that is no small
    side: ``df`` then stays as it is and the join shuffles it whole.
    """
    bits = bits_for(rows)
    if not bits:
        return df
    row_bits = ROW_WORDS * WORD_BITS
    present = df.filter(F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda x: x))
    placed = present.withColumn("_place", _place(keys, bits)).withColumn("_row", F.floor(F.col("_place") / row_bits).cast("bigint"))
    met = placed.join(F.broadcast(key_bitmap(keyed, keys, bits)), "_row")
    word = F.get("_words", F.floor(F.col("_place") % row_bits / WORD_BITS).cast("int"))
    bit = F.call_function("shiftrightunsigned", word, (F.col("_place") % WORD_BITS).cast("int")).bitwiseAND(F.lit(1).cast("bigint"))
    return met.filter(bit == 1).select(*df.columns)
