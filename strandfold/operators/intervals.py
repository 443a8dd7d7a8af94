"""Join of intervals with the points they contain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandfold.operators.skew import HotKeys, split_join

BIN_WIDTH = 256
_GROWTH = 16
_LEVELS = 7


def _bin(position: Column, level: Column, base: int) -> Column:
    # Bins of the last level are wider than any interval.
    widths = [base * _GROWTH**i for i in range(_LEVELS - 1)] + [1 << 62]
    width = F.get(F.array(*[F.lit(w).cast("bigint") for w in widths]), level)
    return F.floor(position / width).cast("bigint")


def point_interval_join(intervals: DataFrame, points: DataFrame, on: Sequence[str],
                        start: str, end: str, point: str,
                        base_width: int = BIN_WIDTH, hot: HotKeys | None = None) -> DataFrame:
    """Inner join on ``on`` where ``start <= point <= end``, both ends closed.

    An interval is given one bin only: that of its start, on the lowest level
    whose bins are at least as wide as the interval (widths grow 16-fold from
    ``base_width``). It can then only reach into that bin and the next, so a
    point is offered to its own bin and the one before on each of the seven levels.
    The interval side, usually wide and large, is never repeated nor read ahead, and each
    pair meets once. Bins with very many intervals are left to the adaptive skew join unless ``hot`` names them.
    The offered points are up to fourteen times the points, which the optimizer's size estimate leaves out, so the
    join is asked to shuffle: else the driver would gather them all for a broadcast.
    """
    width = F.col(end) - F.col(start) + 1
    level = F.lit(_LEVELS - 1)
    for i in range(_LEVELS - 2, -1, -1):
        level = F.when(width <= base_width * _GROWTH**i, i).otherwise(level)
    binned = (
        intervals.filter(width > 0)
        .withColumn("_level", level)
        .withColumn("_bin", _bin(F.col(start), F.col("_level"), base_width))
    )
    keys = [*on, "_level", "_bin"]

    home = _bin(F.col(point), F.col("_level"), base_width)
    offered = (
        points.filter(F.col(point).isNotNull())
        .withColumn("_level", F.explode(F.array(*[F.lit(i) for i in range(_LEVELS)])))
        .withColumn("_bin", F.explode(F.array(home, home - 1)))
    )
    return (
        split_join(binned, offered, keys, "inner", hot or HotKeys(), "shuffle_hash")
        .filter((F.col(point) >= F.col(start)) & (F.col(point) <= F.col(end)))
        .drop("_level", "_bin")
    )
