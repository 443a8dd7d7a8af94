"""SNPs to genotype and SNPs that destroy CpGs."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandfold.functions import genome
from strandfold.params import AsmParams

# The forms of a frequency and of a chromosome suffix.
FREQUENCY = r"[0-9]*\.?[0-9]+"
CHR_PREFIX = "chr"
CHR_SUFFIX = r"_([a-zA-Z0-9\s]+)"


def clean_vcf(vcf: DataFrame) -> DataFrame:
    """Distinct single-base rs SNPs with the strands they can be read on."""
    ct, ga = genome.informative_strands(F.col("ref"), F.col("alt"))
    return (
        vcf.filter(genome.is_single_base_snp(F.col("snp_id"), F.col("ref"), F.col("alt")))
        .select("sample_id", "snp_id", "chr",
                genome.try_bigint(F.col("pos")).alias("pos"), "ref", "alt")
        .dropDuplicates()
        .withColumns({"CT_strand": ct, "GA_strand": ga})
    )


def common_snp_exclusion(dump: DataFrame, snp_freq: float) -> DataFrame:
    """Common SNPs whose major allele is rarer than ``1 - snp_freq``.

    The largest frequency is picked as text, as published; that equals the
    numeric maximum while all frequencies share one format.
    """
    bare = F.regexp_replace(F.regexp_replace("chr", CHR_PREFIX, ""), CHR_SUFFIX, "")
    largest = F.array_max(F.regexp_extract_all("alleleFreqs", F.lit(FREQUENCY), F.lit(0)))
    return (
        dump.filter(F.col("snp_id").like(genome.RS_ID))
        .select(
            "sample_id", bare.alias("chr_snp"), F.col("pos").alias("pos_snp"), "snp_id",
            largest.try_cast("double").alias("max"),
        )
        .filter(F.col("max") < 1 - snp_freq)
    )


def vcf_exclusion(vcf: DataFrame) -> DataFrame:
    """Single-base rs SNPs of a variant call file as the exclusion set."""
    return vcf.filter(
        genome.is_single_base_snp(F.col("snp_id"), F.col("ref"), F.col("alt"))
    ).select(
        "sample_id", F.col("chr").alias("chr_snp"),
        genome.try_bigint(F.col("pos")).alias("pos_snp"), "snp_id", "ref", "alt",
    )


def chromosome_filter(df: DataFrame, *names: str) -> DataFrame:
    """Rows of the named chromosomes, written with or without a ``chr`` prefix.

    A plain membership test, so it prunes partitions and reaches the scan.
    """
    bare = [n.removeprefix("chr") for n in names]
    return df.filter(F.col("chr").isin(*bare, *[f"chr{n}" for n in bare]))


def chromosome_overlap(left: DataFrame, right: DataFrame, left_chr: str = "chr",
                       right_chr: str = "chr_snp") -> DataFrame:
    """Chromosome names both tables use; empty when their naming differs."""
    return (
        left.select(F.col(left_chr).alias("chr")).distinct()
        .join(right.select(F.col(right_chr).alias("chr")).distinct(), "chr", "left_semi")
    )


def multi_locus_ids(snps: DataFrame) -> DataFrame:
    """Ids that stand at more than one place, with how many and the first and last.

    Genotypes and regions are keyed by the id alone, so the reads of such an id's places are blended. Rows without a
    chromosome or position are no place.
    """
    place = F.struct("chr", "pos")
    known = snps.filter(F.col("chr").isNotNull() & F.col("pos").isNotNull())
    return known.select("sample_id", "snp_id", "chr", "pos").dropDuplicates().groupBy("sample_id", "snp_id").agg(
        F.count(F.lit(1)).alias("places"), F.min(place).alias("_first"), F.max(place).alias("_last")
    ).filter("places > 1").select(
        "sample_id", "snp_id", "places", F.col("_first.chr").alias("first_chr"), F.col("_first.pos").alias("first_pos"),
        F.col("_last.chr").alias("last_chr"), F.col("_last.pos").alias("last_pos"),
    )


def exclusion_set(params: AsmParams, common: DataFrame | None = None, raw: DataFrame | None = None,
                  filtered: DataFrame | None = None) -> DataFrame:
    """The SNPs that destroy CpGs, from the source that ``params.snps_for_cpg`` names.

    ``common_snp`` takes the common-variant dump, ``raw.vcf`` and ``filtered.vcf`` the sample's own calls.
    """
    given = {"common_snp": common, "raw.vcf": raw, "filtered.vcf": filtered}
    if params.snps_for_cpg not in given:
        raise ValueError(f"snps_for_cpg is one of {', '.join(given)}, not {params.snps_for_cpg}")
    source = given[params.snps_for_cpg]
    if source is None:
        raise ValueError(f"snps_for_cpg is {params.snps_for_cpg}, but that table is not given")
    return common_snp_exclusion(source, params.snp_freq) if params.snps_for_cpg == "common_snp" else vcf_exclusion(source)


def warn_of_apart_names(sites: DataFrame, exclusion: DataFrame) -> bool:
    """Whether no chromosome name of the exclusion set occurs among the CpGs, so that nothing is excluded; warns then."""
    apart = chromosome_overlap(sites, exclusion).isEmpty() and not exclusion.isEmpty() and not sites.isEmpty()
    if apart:
        warnings.warn("the exclusion SNPs and the CpGs have no chromosome name in common: no CpG is excluded", stacklevel=2)
    return apart
