"""CpGs near SNPs, counted per allele."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandfold.functions.statistics import round_array, with_fisher_pvalue
from strandfold.operators.context import SITE
from strandfold.operators.sites import distinct, off_sites
from strandfold.operators.skew import HotKeys, split_join

READ_KEYS = ["sample_id", "read_id"]
CPG_SNP = ["sample_id", "chr", "pos", "snp_id"]
READ_COLUMNS = ["sample_id", "chr", "pos", "meth", "cov", "snp_id", "snp_pos", "allele", "read_id"]
COUNTS = ["ref_cov", "ref_meth", "alt_cov", "alt_meth"]


def destroyed_sites(exclusion: DataFrame) -> DataFrame:
    """CpG positions whose C or G an exclusion SNP hits."""
    return exclusion.select(
        "sample_id", F.col("chr_snp").alias("chr"),
        F.explode(F.array(F.col("pos_snp"), F.col("pos_snp") - 1)).alias("pos"),
    ).dropDuplicates()


def except_distinct(sites: DataFrame, exclusion: DataFrame) -> DataFrame:
    """Distinct CpG positions left once the destroyed ones are subtracted.

    One aggregate over both, with partial results before the shuffle: no call meets the destroyed sites in a join.
    """
    gone = destroyed_sites(exclusion).withColumn("_gone", F.lit(True))
    both = sites.select(*SITE, F.lit(False).alias("_gone")).unionByName(gone)
    return both.groupBy(*SITE).agg(F.bool_or("_gone").alias("_gone")).filter(~F.col("_gone")).select(*SITE)


def exclude_snp_cpgs(context: DataFrame, exclusion: DataFrame,
                     hot: HotKeys | None = None) -> DataFrame:
    """Calls at CpGs no exclusion SNP hits, on C or on G.

    One anti join against both kinds of hit; calls without a position never
    match a CpG and go as well.
    """
    placed = context.filter(F.col("chr").isNotNull() & F.col("pos").isNotNull())
    gone = destroyed_sites(exclusion)
    kept = split_join(placed, gone, SITE, "left_anti", hot) if hot else off_sites(placed, gone)
    return kept.select("sample_id", "chr", "pos", "meth", "cov", "read_id")


def link_alleles(context: DataFrame, genotype: DataFrame,
                 hot: HotKeys | None = None, strategy: str = "merge") -> DataFrame:
    """A read's calls with the alleles it carries, repeated calls kept.

    The alleles are dealt out by read before repeats of them are dropped, so they are shuffled once.
    """
    alleles = genotype.select(
        "sample_id", "read_id", "snp_id", F.col("pos").alias("snp_pos"), "allele"
    ).repartition(*READ_KEYS).dropDuplicates()
    return split_join(
        context.select("sample_id", "read_id", "chr", "pos", "meth", "cov"),
        alleles, READ_KEYS, "inner", hot or HotKeys(), strategy,
    ).select(*READ_COLUMNS)


def cpg_read_genotype(context: DataFrame, genotype: DataFrame,
                      hot: HotKeys | None = None, strategy: str = "merge") -> DataFrame:
    """Distinct combinations of a read's calls with the alleles it carries.

    Without a hot read the join leaves each read in one place, so the
    distinct needs no shuffle of its own.
    """
    return distinct(link_alleles(context, genotype, hot, strategy), first="read_id")


def cpg_genotype(reads: DataFrame) -> DataFrame:
    """Coverage and methylated calls per CpG, SNP and allele.

    Rows are keyed by the REF reads' SNP position; ALT counts are pooled over
    the id's positions. Only CpGs seen on both alleles stay.
    """

    def on(allele: str, column: str):
        return F.sum(F.when(F.col("allele") == allele, F.col(column)))

    per_position = reads.groupBy(*CPG_SNP, "snp_pos").agg(
        on("REF", "cov").alias("ref_cov"), on("REF", "meth").alias("ref_meth"),
        on("ALT", "cov").alias("alt_cov"), on("ALT", "meth").alias("alt_meth"),
    )
    pooled = Window.partitionBy(*CPG_SNP)
    return (
        per_position.withColumn("alt_cov", F.sum("alt_cov").over(pooled))
        .withColumn("alt_meth", F.sum("alt_meth").over(pooled))
        .filter("ref_cov is not null and alt_cov is not null")
        .select("sample_id", "chr", "pos", "snp_id", "snp_pos", *COUNTS)
    )


def allele_coverage_filter(counts: DataFrame, min_cov: int) -> DataFrame:
    return counts.filter((F.col("ref_cov") >= min_cov) & (F.col("alt_cov") >= min_cov))


def fisher_exact(counts: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Fisher p-value per row, worked out once per distinct table of counts."""
    tables = with_fisher_pvalue(counts.select(*COUNTS).distinct(), "_p").select(
        *COUNTS, round_array(F.col("_p"), 5).alias("fisher_pvalue")
    )
    return split_join(counts, tables, COUNTS, "inner", hot or HotKeys()).select(
        *counts.columns, "fisher_pvalue"
    )
