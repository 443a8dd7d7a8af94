"""The whole chain from per-read tables to one scored row per SNP."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandfold.operators import context as ctx
from strandfold.operators import alignment, cpg, genotype, reads, region, significance, variants
from strandfold.operators.prefilter import may_match
from strandfold.operators.sites import at_sites
from strandfold.operators.skew import HotKeys, split_join
from strandfold.params import AsmParams
from strandfold.session import configured
from strandfold.sources.writers import SampleStages, Stages, inputs_key


def genotype_reads(sam: DataFrame, vcf: DataFrame, params: AsmParams) -> DataFrame:
    """The allele each read carries at each SNP it covers, one row per (SNP, read)."""
    aligned, snps = reads.clean_sam(sam, params.cigar_mode), variants.clean_vcf(vcf)
    if params.variants == "raw.vcf":
        snps = alignment.variant_depth_cap(aligned, snps, params.max_snp_depth)
    bases = genotype.snp_base_at_read(genotype.reads_overlap_snp(aligned, snps), params.cigar_mode)
    if params.require_informative_strand:
        bases = genotype.informative_reads_only(bases)
    return genotype.distinct_genotypes(
        genotype.tag_allele(genotype.snp_score_filter(bases, params.snp_score))
    )


def usable_cpgs(context: DataFrame, exclusion: DataFrame, min_cov: int) -> DataFrame:
    """CpG positions with enough pooled coverage that no exclusion SNP hits."""
    covered = ctx.coverage_filter(ctx.cpg_coverage(context), min_cov)
    sites = covered.select("sample_id", "chr", covered.pos_start.alias("pos"))
    return split_join(sites, cpg.destroyed_sites(exclusion), ctx.SITE, "left_anti", HotKeys())


def allele_calls(context: DataFrame, genotypes: DataFrame, usable: DataFrame,
                 by_read: HotKeys | None = None, by_site: HotKeys | None = None) -> DataFrame:
    """Calls of genotyped reads at usable CpGs.

    Nine tenths of all calls lie on reads without a SNP. A bitmap of the genotyped reads keeps most of those
    out of the shuffle by read; the CpG filters act on what is left. Filters and
    join commute, so the rows are those of the step-by-step order. The join leaves each read in
    one place, where repeated calls are dropped without another shuffle; the CpGs are looked up by stretch, so that the calls of
    a read stay side by side, in the shuffle and behind it. A semi join would be moved below the join by the
    optimizer and scatter all calls by position. ``genotypes`` is counted first and should be a table, not a plan.
    """
    likely = may_match(context, genotypes, ["sample_id", "read_id"], genotypes.count())
    linked = cpg.cpg_read_genotype(likely, genotypes, by_read, "shuffle_hash")
    if by_site:
        return split_join(linked, usable, ctx.SITE, "left_semi", by_site).select(*cpg.READ_COLUMNS)
    return at_sites(linked, usable).select(*cpg.READ_COLUMNS)


def region_table(calls: DataFrame, summary: DataFrame, cpgs: DataFrame,
                 by_cpg: HotKeys | None = None, rank_test: str = "asymptotic") -> DataFrame:
    """Per SNP: reads per allele, effect, rank test and CpG summary."""
    inside = region.region_reads(calls, region.region_cpgs(cpgs, summary), by_cpg)
    counts = region.read_fraction_counts(region.read_methylation(inside))
    return split_join(significance.region_tests(counts, rank_test, None), summary, region.SNP, "inner", HotKeys())


def call_asm(context_ob: DataFrame, context_ot: DataFrame, sam: DataFrame, vcf: DataFrame,
             exclusion: DataFrame, params: AsmParams | None = None,
             stages: Stages | None = None) -> DataFrame:
    """One row per tested SNP and sample, with its methylation call.

    ``exclusion`` comes from ``variants.exclusion_set``; a warning tells if its chromosome names meet none of the calls'.
    Tables used twice are written to the run's stage folder in between; a run that
    takes up earlier stages does so only for the same parameters, inputs and ways these are made.
    """
    params = params or AsmParams()
    with configured(context_ob.sparkSession) as spark:
        return _call_asm(context_ob, context_ot, sam, vcf, exclusion, params, stages or Stages(spark))


def _call_asm(context_ob: DataFrame, context_ot: DataFrame, sam: DataFrame, vcf: DataFrame,
              exclusion: DataFrame, params: AsmParams, stages: Stages) -> DataFrame:
    stages.key = stages.key or inputs_key(params, context_ob, context_ot, sam, vcf, exclusion)
    context = ctx.normalise_context(context_ob, context_ot)

    # The pass that counts coverage also finds the frequent keys of the next one over the same calls.
    usable = stages.write("usable_cpgs", lambda: usable_cpgs(
        stages.watch("usable_cpgs", context, by_read=cpg.READ_KEYS, by_site=ctx.SITE), exclusion, params.pooled_cov))
    variants.warn_of_apart_names(usable, exclusion)
    genotypes = stages.write("genotypes", lambda: genotype_reads(sam, vcf, params))
    calls = stages.write("cpg_read_genotype", lambda: allele_calls(
        context, genotypes, usable, stages.hot_keys("usable_cpgs", "by_read"), stages.hot_keys("usable_cpgs", "by_site")),
        watch={"by_cpg": cpg.CPG_SNP})
    cpgs = stages.write(
        "cpg_genotype",
        lambda: cpg.allele_coverage_filter(cpg.cpg_genotype(calls), params.cpg_cov),
        watch={"by_counts": cpg.COUNTS},
    )
    summary = stages.write(
        "snp_summary",
        lambda: region.min_cpg_filter(
            region.snp_summary(cpg.fisher_exact(cpgs, stages.hot_keys("cpg_genotype", "by_counts")), params.p_value),
            params.cpg_per_asm_region,
        ),
    )
    regions = stages.write("asm_region", lambda: region_table(
        calls, summary, cpgs, stages.hot_keys("cpg_read_genotype", "by_cpg"), params.rank_test))
    return significance.asm_decision(significance.benjamini_hochberg(regions), params)


def call_samples(samples: Sequence[str], context_ob: DataFrame, context_ot: DataFrame, sam: DataFrame,
                 vcf: DataFrame, exclusion: DataFrame, name: str, params: AsmParams | None = None) -> DataFrame:
    """``call_asm`` for a growing set of samples under one run ``name``.

    A sample finished before with the same parameters and inputs is taken up, so a further sample costs its own
    work only; samples that are new are built together. The tables hold at least the samples named, each from a scan
    of its own or a ``sample_id=`` folder; a file that holds several samples ties these together.
    """
    params = params or AsmParams()
    inputs = (context_ob, context_ot, sam, vcf, exclusion)
    keys = {s: inputs_key(params, *inputs, sample=s) for s in samples}
    named = [df.filter(F.col("sample_id").isin(list(samples))) for df in inputs]
    with configured(context_ob.sparkSession) as spark:
        return _call_asm(*named, params, SampleStages(spark, name, keys))
