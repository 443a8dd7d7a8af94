"""Sets of positions as bitmaps per stretch of a chromosome, to look rows up in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Positions of a stretch, as a power of two, and longs of its bitmap.
STRETCH_POWER = 10
WORD_POWER = 6
WORDS = 1 << (STRETCH_POWER - WORD_POWER)
PLACE = ("sample_id", "chr")


def _place(position: str) -> tuple[Column, Column, Column]:
    """Stretch of a position, word in the stretch's bitmap, and the bit in that."""
    pos = F.col(position).cast("bigint")
    word = F.shiftright(pos, WORD_POWER).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    return F.shiftright(pos, STRETCH_POWER), word, pos.bitwiseAND(F.lit((1 << WORD_POWER) - 1)).cast("int")


def site_bits(sites: DataFrame, by: Sequence[str] = PLACE) -> DataFrame:
    """(*by, _stretch, _words): the positions ``pos`` of each stretch, in one aggregate of at most 128 bytes a row."""
    stretch, word, bit = _place("pos")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = [F.bit_or(F.when(word == i, mask)).alias(f"_w{i}") for i in range(WORDS)]
    found = sites.filter(F.col("pos").isNotNull()).groupBy(*by, stretch.alias("_stretch")).agg(*words)
    dense = F.array(*[F.coalesce(F.col(f"_w{i}"), F.lit(0).cast("bigint")) for i in range(WORDS)])
    return found.select(*by, "_stretch", dense.alias("_words"))


def _looked_up(df: DataFrame, bits: DataFrame, how: str, by: Sequence[str] = PLACE) -> tuple[DataFrame, Column]:
    stretch, word, bit = _place("pos")
    met = df.withColumn("_stretch", stretch).join(bits, [*by, "_stretch"], how)
    found = F.call_function("shiftrightunsigned", F.get("_words", word), bit).bitwiseAND(F.lit(1).cast("bigint"))
    return met, F.coalesce(found, F.lit(0).cast("bigint")) == 1


def at_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows at one of the sites, as by a semi join.

    Rows are shuffled by stretch, where those of a read stay side by side and compress well, and looked up
    without a sort, so nothing spills.
    """
    met, found = _looked_up(df, site_bits(sites).hint("shuffle_hash"), "inner")
    return met.filter(found).select(*df.columns)


def distinct_at_sites(df: DataFrame, sites: DataFrame, by: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Distinct rows at one of the sites that agree in ``by``, with the sites' ``extra`` columns.

    As by an inner join on ``by`` and ``pos``. The stretch is a function of the position: with it among their columns, the
    distinct rows are found where the lookup left them.
    """
    met, found = _looked_up(df, site_bits(sites, [*by, *extra]).hint("shuffle_hash"), "inner", by)
    return distinct(met.filter(found).select(*df.columns, *extra, "_stretch"), first="read_id").drop("_stretch")


def distinct(df: DataFrame, first: str) -> DataFrame:
    """``dropDuplicates``, whose order, if it has to sort, keeps rows of one ``first`` value side by side."""
    columns = [first, *[c for c in df.columns if c != first]]
    return df.groupBy(*columns).agg(F.lit(True).alias("_one")).select(*df.columns)


def off_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows at none of the sites, as by an anti join; the bitmaps are a fraction of the sites' rows if these are broadcast."""
    met, found = _looked_up(df, site_bits(sites), "left")
    return met.filter(~found).select(*df.columns)
