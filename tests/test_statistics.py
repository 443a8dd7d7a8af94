"""Fisher, rank test and correction against plain loops, and their properties."""

import itertools
import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandfold.functions import statistics
from strandfold.functions.statistics import rank_sum_ways, two_sided_normal, ways_in_all
from strandfold.operators.cpg import fisher_exact
from strandfold.operators.region import FRACTION_SCALE
from strandfold.operators.significance import benjamini_hochberg, mann_whitney, region_tests
from strandfold.operators.skew import HotKeys

COUNT_DDL = ("sample_id string, chr string, pos bigint, snp_id string, snp_pos bigint, "
             "ref_cov bigint, ref_meth bigint, alt_cov bigint, alt_meth bigint")


def fisher_by_loop(ref_cov, ref_meth, alt_cov, alt_meth):
    total, marked = ref_cov + alt_cov, ref_meth + alt_meth
    ways = [math.comb(marked, x) * math.comb(total - marked, ref_cov - x)
            if 0 <= ref_cov - x <= total - marked else 0 for x in range(marked + 1)]
    seen = ways[ref_meth]
    # Integer arithmetic: at most 1e-7 likelier than the observed table.
    return sum(w for w in ways if w * 10**7 <= seen * (10**7 + 1)) / sum(ways)


def fisher_in_spark(spark, tables):
    rows = [("s", "c", i, "rs", 1, *t) for i, t in enumerate(tables)]
    out = fisher_exact(spark.createDataFrame(rows, COUNT_DDL), HotKeys()).collect()
    assert len(out) == len(tables)
    return {r.pos: r.fisher_pvalue for r in out}


def test_fisher_matches_exact_sums(spark):
    tables = [(n, a, m, b) for n, m in product((5, 6, 11), (5, 9)) for a in range(n + 1)
              for b in range(m + 1)]
    rng = random.Random(1)
    for _ in range(150):
        n, m = rng.randint(5, 900), rng.randint(5, 900)
        tables.append((n, rng.randint(0, n), m, rng.randint(0, m)))
    got = fisher_in_spark(spark, tables)
    for i, t in enumerate(tables):
        assert got[i] == pytest.approx(fisher_by_loop(*t), abs=6e-6), t


def test_fisher_edges_and_symmetry(spark):
    tables = [(5, 5, 7, 7), (5, 0, 7, 0), (10, 5, 10, 5), (5, 5, 5, 0), (12, 3, 9, 8), (9, 8, 12, 3),
              (40_000_000, 20_000_000, 40_000_000, 20_000_000), (3_000_000, 0, 3_000_000, 3_000_000)]
    got = fisher_in_spark(spark, tables)
    assert [got[i] for i in range(3)] == [1.0, 1.0, 1.0]
    assert got[3] == pytest.approx(0.00794)
    assert got[4] == got[5]
    assert got[6] == 1.0 and got[7] == 0.0


def test_normal_tail(spark):
    z = [i / 20 for i in range(0, 160)]
    out = spark.createDataFrame([(v,) for v in z], "z double").select(
        "z", two_sided_normal(F.col("z")).alias("p")).collect()
    for r in out:
        assert r.p == pytest.approx(math.erfc(r.z / math.sqrt(2)), abs=5e-12)


def rank_test_by_loop(ref, alt):
    both = sorted(ref + alt)
    rank = {v: (both.index(v) + 1 + both.index(v) + both.count(v)) / 2 for v in set(both)}
    n1, n2, n = len(ref), len(alt), len(both)
    u = n1 * n2 + n1 * (n1 + 1) / 2 - sum(rank[v] for v in ref)
    ties = 1 - sum(both.count(v) ** 3 - both.count(v) for v in set(both)) / (n**3 - n)
    if ties == 0:
        return 1.0
    z = abs((max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / math.sqrt(ties * n1 * n2 * (n + 1) / 12))
    return math.erfc(z / math.sqrt(2))


def fraction_counts(spark, groups):
    rows = []
    for (sample, snp), (ref, alt) in groups.items():
        for v in set(ref + alt):
            rows.append((sample, snp, round(v * FRACTION_SCALE), ref.count(v), alt.count(v)))
    return spark.createDataFrame(
        rows, "sample_id string, snp_id string, fraction bigint, n_ref bigint, n_alt bigint")


def test_rank_test_matches_loop(spark):
    rng = random.Random(2)
    values = [0.0, 0.25, 0.33333, 0.5, 1.0]
    groups = {
        ("s1", "same"): ([0.5] * 4, [0.5] * 3),
        ("s1", "mean"): ([0.0, 1.0], [0.0, 1.0]),
        ("s1", "one"): ([0.0], [1.0]),
        ("s2", "same"): ([0.0] * 9, [1.0] * 9),
    }
    for i in range(40):
        groups[("s1", f"r{i}")] = (
            [rng.choice(values) for _ in range(rng.randint(1, 25))],
            [rng.choice(values) for _ in range(rng.randint(1, 25))],
        )
    groups[("s1", "no_alt")] = ([0.5, 1.0], [])
    out = {(r.sample_id, r.snp_id): r for r in region_tests(fraction_counts(spark, groups)).collect()}
    assert ("s1", "no_alt") not in out
    for key, (ref, alt) in groups.items():
        if not alt:
            continue
        assert out[key].wilcoxon_pvalue == pytest.approx(rank_test_by_loop(ref, alt), abs=6e-6), key
        effect = sum(alt) / len(alt) - sum(ref) / len(ref)
        assert out[key].asm_region_effect == pytest.approx(effect, abs=6e-4)
        assert (out[key].ref_reads, out[key].alt_reads) == (len(ref), len(alt))
    assert out[("s1", "same")].wilcoxon_pvalue == 1.0
    assert out[("s1", "mean")].wilcoxon_pvalue < 1.0


def exact_by_enumeration(ref, alt):
    """Two-sided p over all ways to pick the ranks of one sample."""
    both = sorted(ref + alt)
    n1, n2 = len(ref), len(alt)
    u = sum(both.index(v) + 1 for v in ref) - n1 * (n1 + 1) // 2
    u = min(u, n1 * n2 - u)
    all_u = [sum(c) + n1 - n1 * (n1 + 1) // 2 for c in itertools.combinations(range(n1 + n2), n1)]
    return min(1.0, 2 * sum(x <= u for x in all_u) / len(all_u))


def test_exact_rank_test_equals_enumeration(spark):
    rng, groups = random.Random(6), {}
    for n1 in range(1, 9):
        for n2 in range(1, 9):
            values = rng.sample(range(100_001), n1 + n2)
            groups[("s", f"{n1}x{n2}")] = ([v / FRACTION_SCALE for v in values[:n1]], [v / FRACTION_SCALE for v in values[n1:]])
    groups[("s", "apart")] = ([i / 100 for i in range(8)], [0.5 + i / 100 for i in range(8)])
    groups[("s", "tied")] = ([0.1, 0.2], [0.2, 0.3])
    counts = fraction_counts(spark, groups)
    for method in ("exact", "auto"):
        out = {r.snp_id: r.wilcoxon_pvalue for r in region_tests(counts, method).collect()}
        for (_, snp), (ref, alt) in groups.items():
            want = rank_test_by_loop(ref, alt) if snp == "tied" else exact_by_enumeration(ref, alt)
            assert out[snp] == pytest.approx(want, abs=6e-6), (method, snp)
    default = {r.snp_id: r.wilcoxon_pvalue for r in region_tests(counts).collect()}
    assert default["8x8"] == pytest.approx(rank_test_by_loop(*groups["s", "8x8"]), abs=6e-6)


def test_exact_rank_test_of_larger_samples(spark):
    """Sizes beyond "auto" and beyond the exact limit; counted ways add up to all ways."""
    rng = random.Random(7)
    groups = {}
    for n1, n2 in ((9, 20), (40, 51), (60, 60)):
        values = rng.sample(range(100_001), n1 + n2)
        groups["s", f"{n1}x{n2}"] = ([v / FRACTION_SCALE for v in values[:n1]], [v / FRACTION_SCALE for v in values[n1:]])
    counts = fraction_counts(spark, groups)
    plain, auto, exact = ({r.snp_id: r.wilcoxon_pvalue for r in region_tests(counts, m).collect()} for m in ("asymptotic", "auto", "exact"))
    assert plain == auto and plain["60x60"] == exact["60x60"] and plain["9x20"] != exact["9x20"]
    assert all(abs(plain[k] - exact[k]) < 0.02 for k in plain)
    sizes = spark.createDataFrame([(n1, n2) for n1 in range(1, 13) for n2 in (n1, n1 + 1, 30)] + [(45, 45), (1, 2048)], "a int, b int")
    for r in sizes.select("a", "b", rank_sum_ways(F.col("a"), F.col("b")).alias("ways"), ways_in_all(F.col("a"), F.col("b")).alias("all")).collect():
        middle = r.ways[-1] if r.a * r.b % 2 == 0 else 0  # counted from both ends
        assert 2 * sum(r.ways) - middle == math.comb(r.a + r.b, r.a) and r["all"] == pytest.approx(math.comb(r.a + r.b, r.a))


def exact_by_counting(n1, n2, u):
    """Two-sided p by whole numbers: ways to pick n1 of the first ranks, by their sum, a rank at a time."""
    ways = [{0: 1}] + [{} for _ in range(n1)]
    for rank in range(1, n1 + n2 + 1):
        for c in range(min(rank, n1), 0, -1):
            for s, n in ways[c - 1].items():
                ways[c][s + rank] = ways[c].get(s + rank, 0) + n
    least, u = n1 * (n1 + 1) // 2, min(u, n1 * n2 - u)
    return min(1.0, 2 * sum(n for s, n in ways[n1].items() if s - least <= u) / math.comb(n1 + n2, n1))


def test_exact_rank_test_of_any_size(spark):
    """No size is left to the approximation."""
    rng, groups, want = random.Random(8), {}, {}
    for n1, n2, shift in ((45, 46, 0), (60, 60, 0), (60, 60, 12), (3, 900, 0), (70, 75, 20)):
        values = sorted(rng.sample(range(100_001), n1 + n2))
        low = set(rng.sample(range(n1 + n2 - shift), n1))
        ref, alt = [v for i, v in enumerate(values) if i in low], [v for i, v in enumerate(values) if i not in low]
        groups["s", f"{n1}x{n2}+{shift}"] = ([v / FRACTION_SCALE for v in ref], [v / FRACTION_SCALE for v in alt])
        want[f"{n1}x{n2}+{shift}"] = exact_by_counting(n1, n2, sum(low) + n1 - n1 * (n1 + 1) // 2)
    out = {r.snp_id: r.wilcoxon_pvalue for r in mann_whitney(fraction_counts(spark, groups), "exact").collect()}
    assert out == {k: pytest.approx(p, abs=5.1e-6) for k, p in want.items()}
    auto = {r.snp_id: r.wilcoxon_pvalue for r in mann_whitney(fraction_counts(spark, groups), "auto").collect()}
    plain = {r.snp_id: r.wilcoxon_pvalue for r in mann_whitney(fraction_counts(spark, groups)).collect()}
    assert auto == plain | {"3x900+0": out["3x900+0"]}


def test_rank_sum_tails_of_large_samples_are_exact():
    """By waves as by whole numbers, and for more ways than a double holds near the normal law."""
    for n1, n2 in ((33, 34), (60, 61), (4, 300)):
        last = n1 * n2 // 2
        ways = [1] + [0] * last
        for i in range(1, n1 + 1):
            for u in range(last, n2 + i - 1, -1):
                ways[u] -= ways[u - n2 - i]
            for u in range(i, last + 1):
                ways[u] += ways[u - i]
        want = [n / math.comb(n1 + n2, n1) for n in itertools.accumulate(ways)]
        assert statistics._tails(n1, n2, np.arange(last + 1)) == pytest.approx(want, abs=1e-12)
        assert statistics._tails_by_waves(n1, n2, np.arange(last + 1)) == pytest.approx(want, abs=1e-12)
    far = statistics._tails(500, 560, np.array([130_000, 139_999]))
    deviation = math.sqrt(500 * 560 * 1061 / 12)
    assert far == pytest.approx([math.erfc((140_000 - u - 0.5) / deviation / math.sqrt(2)) / 2 for u in (130_000, 139_999)], abs=1e-4)


def test_rank_test_is_symmetric(spark):
    ref, alt = [0.0, 0.2, 0.2, 0.9], [0.2, 0.5, 1.0]
    out = {r.snp_id: r for r in region_tests(fraction_counts(
        spark, {("s", "a"): (ref, alt), ("s", "b"): (alt, ref)})).collect()}
    assert out["a"].wilcoxon_pvalue == out["b"].wilcoxon_pvalue
    assert out["a"].asm_region_effect == -out["b"].asm_region_effect


def test_correction_matches_sorting(spark):
    rng = random.Random(3)
    rows = [(s, f"rs{i}", round(rng.random() ** 2, 2 if s == "s1" else 5))
            for s in ("s1", "s2") for i in range(200 if s == "s1" else 37)]
    df = spark.createDataFrame(rows, "sample_id string, snp_id string, wilcoxon_pvalue double")
    got = {(r.sample_id, r.snp_id): r.wilcoxon_corr_pvalue for r in benjamini_hochberg(df).collect()}
    assert len(got) == len(rows)
    for sample in ("s1", "s2"):
        mine = sorted((r for r in rows if r[0] == sample), key=lambda r: r[2])
        best = 1.0
        for rank in range(len(mine), 0, -1):
            _, snp, p = mine[rank - 1]
            best = min(best, p / (rank / len(mine)))
            assert got[(sample, snp)] == pytest.approx(best, abs=1.1e-5)
            assert got[(sample, snp)] >= p
