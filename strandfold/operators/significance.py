"""Region-level tests and their correction over all SNPs of a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandfold.functions.statistics import rank_sum_score, rank_sum_tails, round_array, two_sided_normal
from strandfold.operators.region import FRACTION_SCALE, SNP
from strandfold.operators.skew import HotKeys, split_join
from strandfold.params import AsmParams

P_SCALE = 100_000
# Product of the two sizes up to which a caller of region_tests has exact p-values unless it asks for others, and the
# smaller size up to which "auto" takes them.
EXACT_PAIRS = 2048
AUTO_READS = 8


def region_tests(counts: DataFrame, method: str = "asymptotic", most_pairs: int | None = EXACT_PAIRS) -> DataFrame:
    """Reads per allele, effect and two-sided rank test per SNP, in one pass.

    ``method`` "asymptotic" is the published test. "exact" takes the exact distribution for SNPs without tied
    fractions, "auto" only if one allele has at most ``AUTO_READS`` reads, as newer versions of the called
    library do; SNPs with ties have the approximation. ``most_pairs`` leaves the approximation to SNPs whose sizes'
    product is larger as well; None, which ``mann_whitney`` and the chain take, counts out every size.

    Works on the counts per read fraction, for SNPs with reads on both
    alleles. The effect is the difference of the alleles' mean fractions; its
    sums are integers, so row order does not matter. Reads of equal fraction
    share a mid-rank, so the running count over one SNP's fractions (at most
    100,001) gives the rank sum and the tie term.
    """
    ordered = Window.partitionBy(*SNP).orderBy("fraction").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = counts.withColumn("_t", F.col("n_ref") + F.col("n_alt")).withColumn(
        "_upto", F.sum("_t").over(ordered)
    )
    t = F.col("_t").cast("double")
    sums = ranked.groupBy(*SNP).agg(
        F.sum("n_ref").alias("ref_reads"), F.sum("n_alt").alias("alt_reads"),
        F.sum(F.col("fraction") * F.col("n_ref")).alias("_ref"),
        F.sum(F.col("fraction") * F.col("n_alt")).alias("_alt"),
        F.sum(F.col("n_ref") * (2 * F.col("_upto") - F.col("_t") + 1)).alias("_ranks"),
        F.sum(t * t * t - t).alias("_ties"),
    ).filter("ref_reads > 0 and alt_reads > 0")
    z = rank_sum_score(*[F.col(c) for c in ("ref_reads", "alt_reads", "_ranks", "_ties")])
    p = F.when(F.col("_z").isNull(), F.lit(1.0)).otherwise(two_sided_normal(F.col("_z")))
    tested = sums.withColumn("_z", z).withColumn("_p", p)
    if method != "asymptotic":
        tested = _with_exact_pvalue(tested, {"exact": None, "auto": AUTO_READS}[method], most_pairs)
    return tested.select(
        *SNP, "ref_reads", "alt_reads",
        F.round(
            F.col("_alt") / F.col("alt_reads") / FRACTION_SCALE
            - F.col("_ref") / F.col("ref_reads") / FRACTION_SCALE, 3
        ).alias("asm_region_effect"),
        round_array(F.col("_p"), 5).alias("wilcoxon_pvalue"),
    )


def _with_exact_pvalue(sums: DataFrame, most_reads: int | None, most_pairs: int | None) -> DataFrame:
    """``_p`` replaced by the exact p-value of the SNPs without ties, within the limits if there are any.

    The distribution is worked out once per distinct pair of sizes, up to the largest rank sum that occurs with it;
    a SNP finds its own tail.
    """
    pairs = F.col("ref_reads") * F.col("alt_reads")
    keys = ["_few", "_many", "_u"]
    sized = sums.withColumns({
        "_few": F.least("ref_reads", "alt_reads"), "_many": F.greatest("ref_reads", "alt_reads"),
        "_u": ((F.col("_ranks") - F.col("ref_reads") * (F.col("ref_reads") + 1)) / 2).cast("bigint"),
    }).withColumn("_u", F.least(F.col("_u"), pairs - F.col("_u")))
    counted = F.col("_ties") == 0
    if most_reads is not None:
        counted &= F.col("_few") <= most_reads
    if most_pairs is not None:
        counted &= pairs <= most_pairs
    sized = sized.withColumns({c: F.when(counted, F.col(c)) for c in keys})
    asked = sized.filter("_few is not null").groupBy("_few", "_many").agg(F.collect_set("_u").alias("_us"))
    tails = asked.withColumn("_tails", rank_sum_tails("_few", "_many", "_us"))
    tables = tails.select("_few", "_many", F.inline(F.arrays_zip(F.col("_us").alias("_u"), F.col("_tails").alias("_tail"))))
    exact = F.least(F.lit(1.0), 2 * F.col("_tail"))
    return split_join(sized, tables, keys, "left", HotKeys()).withColumn("_p", F.when(F.col("_tail").isNull(), F.col("_p")).otherwise(exact))


def region_effect(counts: DataFrame) -> DataFrame:
    return region_tests(counts).drop("wilcoxon_pvalue")


def mann_whitney(counts: DataFrame, method: str = "asymptotic") -> DataFrame:
    return region_tests(counts, method, None).select(*SNP, "wilcoxon_pvalue")


def benjamini_hochberg(tests: DataFrame, p: str = "wilcoxon_pvalue",
                       corrected: str = "wilcoxon_corr_pvalue",
                       by: tuple[str, ...] = ("sample_id",),
                       hot: HotKeys | None = None) -> DataFrame:
    """False-discovery-rate correction of p-values rounded to 5 digits.

    Equal p-values are corrected alike, so the ordered steps run over the
    distinct values, at most 100,001 per sample, and are joined back.
    """
    keys = [*by, "_p"]
    coded = tests.withColumn("_p", F.round(F.col(p) * P_SCALE).cast("bigint"))
    tally = coded.filter("_p is not null").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = group.orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = (
        tally.withColumn("_rank", F.sum("_n").over(upto))
        .withColumn("_total", F.sum("_n").over(group))
        .withColumn("_raw", (F.col("_p") / P_SCALE) / (F.col("_rank") / F.col("_total")))
        .withColumn(corrected, round_array(F.least(F.lit(1.0), F.min("_raw").over(onward)), 5))
        .select(*keys, corrected)
    )
    # Bounded, and p-values are skewed: a broadcast keeps the SNPs of one p-value apart.
    return split_join(coded, table, keys, "left", hot or HotKeys(), strategy=None).select(*tests.columns, corrected)


def asm_decision(regions: DataFrame, params: AsmParams) -> DataFrame:
    """The final table: does the SNP show allele-specific methylation."""

    def passes(side: str, effect_ok: Column) -> Column:
        return (
            (F.col(f"{side}_sig_cpg") >= params.cpg_same_direction_asm)
            & (F.col(f"nb_consec_{side}_sig_asm") >= params.consecutive_cpg)
            & effect_ok
        )

    effect = F.col("asm_region_effect")
    called = (F.col("wilcoxon_corr_pvalue") < params.p_value) & (
        passes("pos", effect > params.asm_region_effect)
        | passes("neg", effect < -params.asm_region_effect)
    )
    return regions.select(
        "sample_id", "chr", "snp_id", "snp_pos",
        F.coalesce(called, F.lit(False)).alias("asm_snp"),
        "asm_region_inf", "asm_region_sup",
        F.col("ref_reads").alias("nb_ref_reads"), F.col("alt_reads").alias("nb_alt_reads"),
        "asm_region_effect", "wilcoxon_corr_pvalue", "nb_cpg", "nb_sig_cpg",
        F.col("pos_sig_cpg").alias("nb_pos_sig_cpg"), F.col("neg_sig_cpg").alias("nb_neg_sig_cpg"),
        "nb_consec_pos_sig_asm", "nb_consec_neg_sig_asm",
    )
