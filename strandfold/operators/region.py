"""SNP regions: CpG summaries, read fractions, effect size and streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandfold.operators.cpg import CPG_SNP
from strandfold.operators.sites import distinct_at_sites
from strandfold.operators.skew import HotKeys, split_join

SNP = ["sample_id", "snp_id"]
CALL = ["sample_id", "chr", "pos", "meth", "cov", "snp_id", "allele", "read_id"]
SNP_PLACE = ("sample_id", "chr", "snp_id")
# A SNP's CpGs are folded in stretches of this many positions, so that no
# task gathers more than one stretch and, per SNP, one summary per stretch.
STRETCH = 4096
# Read fractions are kept to 5 digits; as integers their sums are exact.
FRACTION_SCALE = 100_000


def with_effect(cpg_asm: DataFrame) -> DataFrame:
    """ALT minus REF methylation of each CpG."""
    return cpg_asm.withColumn(
        "effect",
        F.round(F.col("alt_meth") / F.col("alt_cov") - F.col("ref_meth") / F.col("ref_cov"), 3),
    )


def _run_summary(flags: Column, sign: int) -> Column:
    """Length, leading, trailing and longest run of one sign in an ordered array."""
    zero = F.lit(0).cast("bigint")

    def step(acc: Column, flag: Column) -> Column:
        tail = F.when(flag == sign, acc.tail + 1).otherwise(0)
        return F.struct(
            (acc.n + 1).alias("n"),
            F.when(tail > acc.n, tail).otherwise(acc.head).alias("head"),
            tail.alias("tail"),
            F.greatest(acc.best, tail).alias("best"),
        )

    return F.aggregate(
        flags,
        F.struct(zero.alias("n"), zero.alias("head"), zero.alias("tail"), zero.alias("best")),
        step,
    )


def _longest_run(stretches: Column) -> Column:
    """Longest run over the summaries of consecutive stretches; 1 counts as 0."""
    zero = F.lit(0).cast("bigint")
    best = F.aggregate(
        stretches,
        F.struct(zero.alias("tail"), zero.alias("best")),
        lambda acc, s: F.struct(
            F.when(s["tail"] == s["n"], acc["tail"] + s["n"]).otherwise(s["tail"]).alias("tail"),
            F.greatest(acc["best"], s["best"], acc["tail"] + s["head"]).alias("best"),
        ),
        lambda acc: acc["best"],
    )
    return F.when(best > 1, best).otherwise(0)


def snp_summary(cpg_asm: DataFrame, p_value: float) -> DataFrame:
    """One row per SNP: CpG counts, bounds and longest significant streaks.

    Counts and bounds are plain aggregates. Streaks follow the order of the
    positions: runs are summarised per stretch of the genome and the
    summaries joined up per SNP, so even an id spread over whole chromosomes
    is never gathered in one place.
    """
    flagged = with_effect(cpg_asm).select(
        *SNP, "chr", "pos", "snp_pos",
        F.coalesce(F.col("fisher_pvalue") < p_value, F.lit(False)).alias("sig"),
        F.sign("effect").cast("int").alias("sign"),
    )
    significant = F.col("sig")
    flag = F.when(significant, F.col("sign")).otherwise(0)
    stretches = (
        flagged.groupBy(*SNP, F.floor(F.col("pos") / STRETCH).alias("stretch"))
        .agg(
            F.min("snp_pos").alias("snp_pos"),
            F.min("chr").alias("chr"),
            F.count(F.lit(1)).alias("nb_cpg"),
            F.count_if(significant).alias("nb_sig_cpg"),
            F.count_if(flag == 1).alias("pos_sig_cpg"),
            F.count_if(flag == -1).alias("neg_sig_cpg"),
            F.min(F.when(significant, F.col("pos"))).alias("asm_region_inf"),
            F.max(F.when(significant, F.col("pos"))).alias("asm_region_sup"),
            F.min("pos").alias("min_cpg"),
            F.max("pos").alias("max_cpg"),
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", "chr", flag.alias("flag")))),
                lambda c: c.flag,
            ).alias("flags"),
        )
        .withColumns({"up": _run_summary(F.col("flags"), 1),
                      "down": _run_summary(F.col("flags"), -1)})
    )
    ordered = F.array_sort(F.collect_list(F.struct("stretch", "up", "down")))
    return (
        stretches.groupBy(*SNP)
        .agg(
            *[F.min(c).alias(c) for c in ("snp_pos", "chr", "asm_region_inf", "min_cpg")],
            *[F.max(c).alias(c) for c in ("asm_region_sup", "max_cpg")],
            *[F.sum(c).alias(c) for c in ("nb_cpg", "nb_sig_cpg", "pos_sig_cpg", "neg_sig_cpg")],
            ordered.alias("runs"),
        )
        .select(
            *SNP, "snp_pos", "chr", "nb_cpg", "nb_sig_cpg", "pos_sig_cpg", "neg_sig_cpg",
            "asm_region_inf", "asm_region_sup", "min_cpg", "max_cpg",
            _longest_run(F.transform("runs", lambda r: r.up)).alias("nb_consec_pos_sig_asm"),
            _longest_run(F.transform("runs", lambda r: r.down)).alias("nb_consec_neg_sig_asm"),
        )
    )


def min_cpg_filter(summary: DataFrame, min_cpg: int) -> DataFrame:
    return summary.filter(F.col("nb_cpg") >= min_cpg)


def snp_cpg_array(cpg_asm: DataFrame) -> DataFrame:
    """The CpGs of each SNP as an array ordered by position.

    For nested output. The statistics never build it: a row that holds every
    CpG of an id is only as large as the id is local.
    """
    cpg = F.struct("pos", "effect", "fisher_pvalue", "ref_cov", "alt_cov")
    stretches = with_effect(cpg_asm).groupBy(
        *SNP, F.floor(F.col("pos") / STRETCH).alias("stretch")
    ).agg(
        F.min("snp_pos").alias("snp_pos"), F.min("chr").alias("chr"),
        F.array_sort(F.collect_list(cpg)).alias("cpg"),
    )
    return stretches.groupBy(*SNP).agg(
        F.min("snp_pos").alias("snp_pos"), F.min("chr").alias("chr"),
        F.flatten(F.transform(
            F.array_sort(F.collect_list(F.struct("stretch", "cpg"))), lambda s: s.cpg
        )).alias("cpg"),
    )


def well_covered_cpg_reads(reads: DataFrame, cpg_asm: DataFrame,
                           hot: HotKeys | None = None) -> DataFrame:
    """Read calls at CpGs that were tested for the same SNP."""
    if not hot:
        return distinct_at_sites(reads.select(*CALL), cpg_asm, SNP_PLACE)
    return split_join(
        reads, cpg_asm.select(*CPG_SNP).dropDuplicates(), CPG_SNP, "left_semi", hot
    ).select(*CALL).dropDuplicates()


def region_cpgs(sites: DataFrame, summary: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The tested CpGs inside each SNP's region.

    The region runs between the outermost significant CpGs, or over all CpGs
    when none is significant.
    """
    keys = ["sample_id", "snp_id", "chr"]
    bounds = summary.select(
        *keys, "snp_pos",
        F.coalesce("asm_region_inf", "min_cpg").alias("_from"),
        F.coalesce("asm_region_sup", "max_cpg").alias("_to"),
    )
    return (
        split_join(sites.select(*CPG_SNP), bounds, keys, "inner", hot or HotKeys())
        .filter(F.col("pos").between(F.col("_from"), F.col("_to")))
        .select(*CPG_SNP, "snp_pos")
        .dropDuplicates()
    )


def region_reads(reads: DataFrame, cpgs: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Read calls at the CpGs of each SNP's region.

    The bounds were applied to the CpGs, far fewer than the calls, so one
    lookup does what would be two joins and a range filter. Calls are shuffled by stretch, where those of
    a read stay side by side; frequent keys are split by position instead.
    """
    calls = reads.select(*CALL)
    if not hot:
        return distinct_at_sites(calls, cpgs, SNP_PLACE, ["snp_pos"])
    return split_join(calls, cpgs, CPG_SNP, "inner", hot).dropDuplicates()


def read_methylation(region: DataFrame) -> DataFrame:
    """Share of methylated calls per read inside each region."""
    return region.groupBy(*SNP, "snp_pos", "chr", "read_id", "allele").agg(
        F.round(F.try_divide(F.sum("meth"), F.sum("cov")), 5).alias("methyl_perc")
    )


def read_fraction_counts(read_fractions: DataFrame) -> DataFrame:
    """How many REF and ALT reads show each fraction, per SNP.

    At most 100,001 rows per SNP however many reads it has; counted before
    the shuffle.
    """
    return (
        read_fractions.filter("methyl_perc is not null")
        .groupBy(*SNP, F.round(F.col("methyl_perc") * FRACTION_SCALE).cast("bigint").alias("fraction"))
        .agg(
            F.count_if(F.col("allele") == "REF").alias("n_ref"),
            F.count_if(F.col("allele") == "ALT").alias("n_alt"),
        )
    )


def read_fraction_arrays(counts: DataFrame) -> DataFrame:
    """REF and ALT read fractions as ordered arrays, for nested output.

    Collected as counts per fraction, which is bounded, and spelled out one
    entry per read afterwards.
    """

    def spelled(n: str) -> Column:
        return F.flatten(F.transform(
            F.filter("_counts", lambda c: c[n] > 0),
            lambda c: F.array_repeat(
                F.struct((c.fraction / FRACTION_SCALE).alias("methyl_perc")), c[n].cast("int")
            ),
        ))

    return (
        counts.groupBy(*SNP)
        .agg(F.array_sort(F.collect_list(F.struct("fraction", "n_ref", "n_alt"))).alias("_counts"))
        .select(*SNP, spelled("n_ref").alias("ref"), spelled("n_alt").alias("alt"))
        .filter((F.size("ref") > 0) & (F.size("alt") > 0))
    )
