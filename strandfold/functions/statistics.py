"""Test statistics as column expressions; only ``rank_sum_tails`` runs Python in the plan."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables at most this much more likely than the observed one still count as
# equally extreme (fixed value).
FISHER_TOLERANCE = 1e-7

# Half-width factor of the summed support: by Hoeffding's inequality the mass
# beyond mean +- sqrt(m * ln(1e18) / 2) is below 2e-18.
_HALF_WIDTH = math.sqrt(math.log(1e18) / 2)

# Beyond it the tail is below 3e-12.
_Z_LIMIT = 7.0

# Waves taken at a time by the inversion of the rank sum's transform.
_WAVES = 1 << 14


def round_array(value: Column, digits: int) -> Column:
    """Rounding of numeric arrays: scale, nearest even integer, scale back.

    P-values are rounded so; shares and effects by SQL's ``round``. The two
    part ways only at ties.
    """
    scale = 10.0**digits
    return F.rint(value * scale) / scale


def with_fisher_pvalue(tables: DataFrame, pvalue: str) -> DataFrame:
    """Two-sided Fisher exact p-value of methylated counts on two alleles.

    Reads ``ref_meth``, ``ref_cov``, ``alt_meth`` and ``alt_cov``. Weights of
    the possible tables are walked outward from the observed one (weight 1) by
    the ratio of neighbouring hypergeometric terms, once up and once down. The
    p-value is the weight of tables no likelier than the observed one over the
    weight of all. Only the part of the support that can carry mass is walked,
    so the work grows with the square root of the coverage; an observed table
    outside it has p = 0 to far more than the five digits kept.
    """
    draws, marked, rest = F.col("_draws"), F.col("_marked"), F.col("_rest")
    low, high, at = F.col("_low"), F.col("_high"), F.col("ref_meth").cast("bigint")
    total = F.col("_total")
    mean = draws * marked / total
    spread = F.ceil(
        _HALF_WIDTH * F.sqrt(F.least(draws, marked, total - draws, total - marked)) + 1
    )
    # Named once per row; a lambda would work them out again at every step.
    named = (
        tables.withColumns({
            "_draws": F.col("ref_cov").cast("double"),
            "_marked": (F.col("ref_meth") + F.col("alt_meth")).cast("double"),
            "_total": (F.col("ref_cov") + F.col("alt_cov")).cast("double"),
        })
        .withColumn("_rest", total - marked - draws)
        .withColumns({
            "_low": F.greatest(F.lit(0.0), -rest, F.floor(mean) - spread).cast("bigint"),
            "_high": F.least(draws, marked, F.ceil(mean) + spread).cast("bigint"),
        })
    )

    def count(mass: Column, weight: Column) -> Column:
        return mass + F.when(weight <= 1 + FISHER_TOLERANCE, weight).otherwise(0.0)

    def walk(steps: Column, ratio) -> Column:
        start = F.struct(
            F.lit(1.0).alias("weight"), F.lit(0.0).alias("extreme"), F.lit(0.0).alias("all")
        )
        return F.aggregate(
            steps,
            start,
            lambda acc, x: F.struct(
                (acc.weight * ratio(x)).alias("weight"),
                count(acc.extreme, acc.weight).alias("extreme"),
                (acc["all"] + acc.weight).alias("all"),
            ),
            lambda acc: F.struct(
                count(acc.extreme, acc.weight).alias("extreme"),
                (acc["all"] + acc.weight).alias("all"),
            ),
        )

    nothing = F.array().cast("array<bigint>")
    walked = named.withColumns({
        "_up": walk(
            F.when(high > at, F.sequence(at + 1, high)).otherwise(nothing),
            lambda x: (marked - x + 1) * (draws - x + 1) / (x * (rest + x)),
        ),
        "_down": walk(
            F.when(low < at, F.sequence(at - 1, low, F.lit(-1).cast("bigint"))).otherwise(nothing),
            lambda x: (x + 1) * (rest + x + 1) / ((marked - x) * (draws - x)),
        ),
    })
    # Both walks count the observed table once.
    share = (F.col("_up.extreme") + F.col("_down.extreme") - 1) / (
        F.col("_up.all") + F.col("_down.all") - 1
    )
    return walked.select(
        *tables.columns,
        F.when((at < low) | (at > high), F.lit(0.0))
        .otherwise(F.least(F.lit(1.0), share)).alias(pvalue),
    )


def two_sided_normal(z: Column) -> Column:
    """P(|Z| >= z) from the all-positive series of the error function.

    ``z`` should be a plain column: the series reads it at every term. After
    x^2 + 9x + 25 terms (x = z / sqrt 2) the rest is below double precision.
    """
    x = z / math.sqrt(2)
    terms = F.aggregate(
        F.sequence(F.lit(1), F.ceil(x * x + 9 * x + 25).cast("int")),
        F.struct(x.alias("term"), x.alias("sum")),
        lambda acc, k: F.struct(
            (acc.term * z * z / (2 * k + 1)).alias("term"),
            (acc["sum"] + acc.term * z * z / (2 * k + 1)).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    tail = 1 - F.lit(2 / math.sqrt(math.pi)) * F.exp(-x * x) * terms
    return F.when(z >= _Z_LIMIT, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), tail))


def rank_sum_score(n_ref: Column, n_alt: Column, twice_rank_sum: Column,
                   tie_sum: Column) -> Column:
    """Mann-Whitney |z|, tie- and continuity-corrected; null if all values agree.

    ``twice_rank_sum`` is 2 * R(ref) and ``tie_sum`` the sum of t^3 - t over
    tied values.
    """
    n1, n2 = n_ref.cast("double"), n_alt.cast("double")
    n = n1 + n2
    u1 = n1 * n2 + n1 * (n1 + 1) / 2 - twice_rank_sum.cast("double") / 2
    u = F.greatest(u1, n1 * n2 - u1)
    ties = 1 - F.try_divide(tie_sum, n * n * n - n)
    deviation = F.sqrt(ties * n1 * n2 * (n + 1) / 12)
    return F.abs(F.try_divide(u - n1 * n2 / 2 - 0.5, deviation))


def rank_sum_ways(smaller: Column, larger: Column) -> Column:
    """In how many ways two samples without ties give each Mann-Whitney U from 0 to half of the largest.

    These are the coefficients of a Gaussian binomial, the product over i of (1 - q^(larger + i)) / (1 - q^i) up to
    ``smaller``, as power series cut off in the middle, for they read the same from both ends. One factor at a
    time, in decimals, so that the counts are exact. The sizes should be plain columns.
    """
    kind = "array<decimal(38,0)>"
    zero = F.lit(0).cast("decimal(38,0)")
    start = F.transform(F.sequence(F.lit(0), F.floor(smaller * larger / 2).cast("int")), lambda u: F.when(u == 0, 1).otherwise(0)).cast(kind)

    def times(ways: Column, power: Column) -> Column:
        return F.transform(ways, lambda x, u: x - F.when(u >= power, F.get(ways, u - power)).otherwise(zero))

    def divided(ways: Column, power: Column) -> Column:
        return F.transform(ways, lambda x, u: F.aggregate(
            F.sequence(F.lit(0), F.floor(u / power).cast("int")), zero,
            lambda total, k: (total + F.get(ways, u - k * power)).cast("decimal(38,0)")))

    def factor(ways: Column, step: Column) -> Column:
        i = F.floor((step + 1) / 2).cast("int")
        return F.when(step % 2 == 1, times(ways, larger + i)).otherwise(divided(ways, i)).cast(kind)

    return F.aggregate(F.sequence(F.lit(1), 2 * smaller), start, factor)


def ways_in_all(smaller: Column, larger: Column) -> Column:
    """The number of ways to pick the smaller sample's ranks."""
    return F.aggregate(F.sequence(F.lit(1), smaller), F.lit(1.0), lambda total, i: total * (larger + i) / i)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def rank_sum_tails(smaller: pd.Series, larger: pd.Series, us: pd.Series) -> pd.Series:
    """P(U <= u) for each Mann-Whitney U of a list, for two samples without ties of any sizes."""
    return pd.Series([_tails(int(n), int(m), np.asarray(u, dtype=np.int64)) for n, m, u in zip(smaller, larger, us)], dtype=object)


def _tails(smaller: int, larger: int, us: np.ndarray) -> np.ndarray:
    """As numbers of ways while all of them fit 63 bits, which is exact; else by Fourier inversion, which is so to 12 digits or more."""
    total = math.comb(smaller + larger, smaller)
    if total >> 63:
        return _tails_by_waves(smaller, larger, us)
    return np.cumsum(_counted_ways(smaller, larger, int(us.max()) + 1))[us] / total


def _counted_ways(smaller: int, larger: int, size: int) -> np.ndarray:
    """The first counts of ``rank_sum_ways``. Sums on the way may run over, which cancels out, for the counts do not."""
    ways = np.zeros(size, dtype=np.int64)
    ways[0] = 1
    for i in range(1, smaller + 1):
        if larger + i < size:
            ways[larger + i:] -= ways[:-larger - i].copy()
        if i < size:  # a running sum over every i-th count
            rows = np.pad(ways, (0, -size % i)).reshape(-1, i)
            ways = np.cumsum(rows, axis=0).reshape(-1)[:size]
    return ways


def _tails_by_waves(smaller: int, larger: int, us: np.ndarray) -> np.ndarray:
    """The sum over all waves of a period that holds every U, of the distribution's transform times that of the tail.

    The transform is the product over j of j sin((larger + j) t) / ((larger + j) sin(j t)), no partial product of which
    is over one. With a prime period no sine is zero, and angles are reduced as whole numbers. Memory
    is that of a block of waves; the work grows with the square of the smaller size times the larger one.
    """
    last = smaller * larger
    period = next(p for p in itertools.count(last + 1 | 1, 2) if all(p % d for d in range(3, math.isqrt(p) + 1, 2)))

    def sine(times: int, wave: np.ndarray, shift: float = 0.0) -> np.ndarray:
        return np.sin(np.pi * (times * wave % (2 * period)) / period + shift)

    found = (us + 1.0) / period
    for begin in range(1, period // 2 + 1, _WAVES):
        wave = np.arange(begin, min(begin + _WAVES, period // 2 + 1), dtype=np.int64)
        height = np.ones(len(wave))
        for j in range(1, smaller + 1):
            height *= sine(larger + j, wave) * j / (sine(j, wave) * (larger + j))
        height /= sine(1, wave)
        for n, u in enumerate(us.tolist()):
            found[n] += 2 * np.sum(height * sine(u + 1, wave) * sine(last - u, wave, np.pi / 2)) / period
    return found.clip(0.0, 1.0)
