"""Every operator as a query over the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandfold import schemas
from strandfold.operators import alignment, cpg, genotype, reads, region, significance, variants
from strandfold.operators import context as ctx
from strandfold.operators.skew import HotKeys, split_join
from strandfold.params import AsmParams
from strandfold.plans import asm, derived
from strandfold.session import shuffles_dropped
from strandfold.sources import readers, writers

PARAMS = AsmParams()
SAMPLES = ("s1", "s2")
# Thresholds at which the derived tables fall on both sides.
STRICT_SCORE = 35
SHALLOW_DEPTH = 115
# Text for the readers is kept as published data are.
GZIP = {"compression": "gzip"}


class Tables:
    """Derived inputs and stage tables of one data folder, written on first use."""

    _known: dict[tuple[str, str], Tables] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Tables:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.stages = writers.Stages(spark)

    def raw(self, name: str) -> DataFrame:
        if not self.stages.finished(name):
            return self.stages.write(name, lambda: derived.spark_table(self.spark, self.sf_dir, name))
        return self.stages.read(name)

    def once(self, name: str) -> DataFrame:
        """A derived input for a query that goes over it once: as a plan, unless another query has written it."""
        if self.stages.finished(name):
            return self.stages.read(name)
        return derived.spark_table(self.spark, self.sf_dir, name)

    def strand(self, which: str, source: DataFrame | None = None) -> DataFrame:
        rows = self.raw("context_raw") if source is None else source
        return rows.filter(F.col("strand") == which).drop("strand")

    @cached_property
    def context(self) -> DataFrame:
        return ctx.normalise_context(self.strand("OB"), self.strand("OT"))

    @property
    def context_once(self) -> DataFrame:
        if "context" in self.__dict__:
            return self.context
        calls = self.once("context_raw")
        return ctx.normalise_context(self.strand("OB", calls), self.strand("OT", calls))

    def columns_once(self, name: str, *columns: str) -> DataFrame:
        """Columns of a derived input for a query that goes over it once, or twice by the same shuffle.

        Exploding keeps the steps from working out the derived columns for each of their uses.
        """
        rows = self.once(name).select(*columns)
        return rows if self.stages.finished(name) else rows.select(F.inline(F.array(F.struct("*"))))

    @property
    def sam_once(self) -> DataFrame:
        return self.columns_once("sam_raw", *reads.SAM_COLUMNS)

    @property
    def reads_once(self) -> DataFrame:
        return reads.clean_sam(self.sam_once)

    @property
    def coverage(self) -> DataFrame:
        return ctx.cpg_coverage(self.context_once)

    @property
    def covered(self) -> DataFrame:
        return ctx.coverage_filter(self.coverage, PARAMS.pooled_cov)

    @cached_property
    def reads(self) -> DataFrame:
        return reads.clean_sam(self.raw("sam_raw"))

    @cached_property
    def snps(self) -> DataFrame:
        return variants.clean_vcf(self.raw("vcf_raw"))

    @cached_property
    def exclusion(self) -> DataFrame:
        return variants.vcf_exclusion(self.raw("excluded_raw"))

    def _written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A step's table if it was written before, else its plan, for a query that goes over it once."""
        return self.__dict__[name] if name in self.__dict__ else build()

    @cached_property
    def pairs(self) -> DataFrame:
        return self.stages.write("pairs", lambda: genotype.reads_overlap_snp(self.reads_once, self.snps))

    @property
    def pairs_once(self) -> DataFrame:
        return self._written("pairs", lambda: genotype.reads_overlap_snp(self.reads_once, self.snps))

    @property
    def bases(self) -> DataFrame:
        return genotype.snp_base_at_read(self.pairs_once)

    @cached_property
    def tagged(self) -> DataFrame:
        return self.stages.write("tagged", lambda: self.tagged_once)

    @property
    def tagged_once(self) -> DataFrame:
        return self._written("tagged", lambda: genotype.tag_allele(
            genotype.snp_score_filter(self.bases, PARAMS.snp_score)))

    @cached_property
    def calls(self) -> DataFrame:
        return self.stages.write("calls", lambda: self.calls_once)

    @property
    def calls_once(self) -> DataFrame:
        return self._written("calls", lambda: asm.allele_calls(self.context_once, self.genotypes, self.usable))

    @cached_property
    def genotypes(self) -> DataFrame:
        return self.stages.write("genotypes", lambda: genotype.distinct_genotypes(self.tagged_once))

    @cached_property
    def usable(self) -> DataFrame:
        return self.stages.write("usable", lambda: asm.usable_cpgs(self.context_once, self.exclusion, PARAMS.pooled_cov))

    @cached_property
    def counts(self) -> DataFrame:
        return self.stages.write("counts", lambda: cpg.cpg_genotype(self.calls_once))

    @cached_property
    def cpg_asm(self) -> DataFrame:
        return self.stages.write("cpg_asm", lambda: cpg.fisher_exact(
            cpg.allele_coverage_filter(self.counts, PARAMS.cpg_cov)))

    @cached_property
    def summary(self) -> DataFrame:
        return self.stages.write("summary", lambda: region.snp_summary(self.cpg_asm, PARAMS.p_value))

    @property
    def in_region(self) -> DataFrame:
        calls = self.calls  # written before the counts, which go over it as well
        kept = region.min_cpg_filter(self.summary, PARAMS.cpg_per_asm_region)
        return region.region_reads(calls, region.region_cpgs(self.cpg_asm, kept))

    @property
    def fractions(self) -> DataFrame:
        return region.read_methylation(self.in_region)

    @cached_property
    def fraction_counts(self) -> DataFrame:
        return self.stages.write(
            "fraction_counts", lambda: region.read_fraction_counts(self.fractions))

    @cached_property
    def regions(self) -> DataFrame:
        calls = self.calls
        kept = region.min_cpg_filter(self.summary, PARAMS.cpg_per_asm_region)
        return self.stages.write("regions", lambda: asm.region_table(calls, kept, self.cpg_asm))

    # --- files -----------------------------------------------------------

    def lines(self, name: str, df: DataFrame, extra: DataFrame | None = None) -> str:
        """Rows as tab-separated text per sample; returns the folder."""
        path = self.stages.path(f"text_{name}")
        text = df.select("sample_id", F.concat_ws(
            "\t", *[F.col(c).cast("string") for c in df.columns if c != "sample_id"]).alias("value"))
        if extra is not None:
            text = text.unionByName(extra)
        with shuffles_dropped(self.spark):
            text.write.mode("overwrite").partitionBy("sample_id").text(path, **GZIP)
        return path

    def per_sample(self, path: str, scan: Callable[..., DataFrame]) -> DataFrame:
        return readers.append_chromosomes(
            *[scan(self.spark, f"{path}/sample_id={s}", s) for s in SAMPLES]
        )

    def headers(self, *lines: str) -> DataFrame:
        """Header lines for each sample that occurs."""
        return self.raw("vcf_raw").select("sample_id").distinct().withColumn(
            "value", F.explode(F.array(*[F.lit(x) for x in lines])))


def _scan_context(t: Tables) -> DataFrame:
    path = t.stages.path("text_context")
    t.raw("context_raw").select(
        "sample_id", "strand", *schemas.CPG_CONTEXT
    ).write.mode("overwrite").partitionBy("sample_id", "strand").csv(path, sep="\t", header=True, **GZIP)
    scans = [
        readers.scan_cpg_context(t.spark, f"{path}/sample_id={s}/strand={k}", s)
        .withColumn("strand", F.lit(k)) for s in SAMPLES for k in ("OB", "OT")
    ]
    return readers.append_chromosomes(*scans)


def _scan_sam(t: Tables) -> DataFrame:
    # Variant lines have too few fields and must be left out.
    junk = t.raw("vcf_raw").select("sample_id", F.concat_ws("\t", "snp_id", "chr", "pos").alias("value"))
    return t.per_sample(t.lines("sam", t.once("sam_raw"), junk), readers.scan_sam)


def _rejected(t: Tables) -> DataFrame:
    """Lines that no reader takes, among good ones, counted by layout."""
    nested = _nested_regions(t)  # the whole chain: its shuffles are gone before the texts are written
    odd = t.raw("vcf_raw")
    short = odd.select("sample_id", F.concat_ws("\t", "snp_id", "chr", "pos").alias("value"))
    text = {"sam": "sam_raw", "vcf": "vcf_raw", "common_snps": "common_raw"}
    paths = {layout: t.lines(f"odd_{layout}", t.once(name), short) for layout, name in text.items()}

    def as_text(df: DataFrame, names) -> DataFrame:
        return df.select("sample_id", *[F.col(c).cast("string").alias(c) for c in names])

    for layout, df, names, options in (
        ("cpg_context", t.once("context_raw"), schemas.CPG_CONTEXT, {"sep": "\t", "header": True}),
        ("cpg_asm", t.cpg_asm, schemas.CPG_ASM, {"header": False}),
    ):
        junk = odd.select("sample_id", *[F.lit("oops" if c in ("pos", "ref_cov") else "1").alias(c) for c in names])
        paths[layout] = t.stages.path(f"text_odd_{layout}")
        with shuffles_dropped(t.spark):
            as_text(df, names).unionByName(junk).write.mode("overwrite").partitionBy("sample_id").csv(paths[layout], **options, **GZIP)
    paths["region_pvalue"] = t.stages.path("text_odd_region_pvalue")
    lines = nested.select("sample_id", F.to_json(F.struct(*schemas.REGION_PVALUE)).alias("value"))
    with shuffles_dropped(t.spark):
        lines.unionByName(odd.select("sample_id", F.concat(F.lit("{"), "snp_id").alias("value"))).write.mode(
            "overwrite").partitionBy("sample_id").text(paths["region_pvalue"], **GZIP)
    counts = [
        readers.rejected_lines(t.spark, [f"{path}/sample_id={s}" for s in SAMPLES], layout)
        .groupBy(F.lit(layout).alias("layout")).agg(F.count(F.lit(1)).alias("rejected"))
        for layout, path in paths.items()
    ]
    return readers.append_chromosomes(*counts)


def _line_counts(t: Tables) -> DataFrame:
    """Lines read and rejected per sample, counted by the pass that stores the good ones."""
    odd = t.raw("vcf_raw")
    short = odd.select("sample_id", F.concat_ws("\t", "snp_id", "chr", "pos").alias("value"))
    junk = odd.select("sample_id", *[F.lit("oops" if c == "pos" else "1").alias(c) for c in schemas.CPG_CONTEXT])
    calls = t.stages.path("text_counted_context")
    rows = t.once("context_raw").select("sample_id", *[F.col(c).cast("string").alias(c) for c in schemas.CPG_CONTEXT]).unionByName(junk)
    with shuffles_dropped(t.spark):
        rows.write.mode("overwrite").partitionBy("sample_id").csv(calls, sep="\t", header=True, **GZIP)
    counted = []
    for layout, path, scan in (("sam", t.lines("counted_sam", t.once("sam_raw"), short), readers.scan_sam),
                               ("cpg_context", calls, readers.scan_cpg_context)):
        for sample in SAMPLES:
            count = readers.LineCount()
            good = t.stages.write(f"good_{layout}_{sample}", lambda: scan(
                t.spark, f"{path}/sample_id={sample}", sample, strict=False, count=count))
            counted.append(good.agg(F.count(F.lit(1)).alias("kept")).select(
                F.lit(layout).alias("layout"), F.lit(sample).alias("sample_id"), "kept",
                F.lit(count.lines).alias("lines"), F.lit(count.rejected).alias("rejected")))
    return readers.append_chromosomes(*counted)


def _scan_vcf(t: Tables, name: str) -> DataFrame:
    head = t.headers("##fileformat=VCFv4.1", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tx")
    return t.per_sample(t.lines(name, t.raw(name), head), readers.scan_vcf)


def _scan_cpg_asm(t: Tables) -> DataFrame:
    path = t.stages.path("csv_cpg_asm")
    t.cpg_asm.select("sample_id", *schemas.CPG_ASM).write.mode(
        "overwrite").partitionBy("sample_id").csv(path, header=False, **GZIP)
    return t.per_sample(path, readers.scan_cpg_asm)


def _nested_regions(t: Tables) -> DataFrame:
    """Region rows with their arrays, as handed to other programs."""
    joined = significance.benjamini_hochberg(t.regions)
    for arrays in (region.read_fraction_arrays(t.fraction_counts), region.snp_cpg_array(t.cpg_asm).select(*region.SNP, "cpg")):
        joined = split_join(joined, arrays, region.SNP, "inner", HotKeys())
    return joined.select("sample_id", *schemas.REGION_PVALUE)


def _flat_regions(df: DataFrame) -> DataFrame:
    scaled = lambda x: F.round(x * region.FRACTION_SCALE).cast("bigint")
    return df.select(
        "sample_id", "snp_id", "snp_pos", "chr", "asm_region_inf", "asm_region_sup",
        "asm_region_effect", "ref_reads", "alt_reads", "nb_cpg", "nb_sig_cpg", "wilcoxon_pvalue",
        "wilcoxon_corr_pvalue", "nb_consec_pos_sig_asm", "nb_consec_neg_sig_asm",
        F.array_join(F.transform("ref", lambda r: scaled(r.methyl_perc).cast("string")), ",").alias("ref"),
        F.array_join(F.transform("alt", lambda r: scaled(r.methyl_perc).cast("string")), ",").alias("alt"),
        F.size("cpg").cast("bigint").alias("n_in_array"),
    )


def _scan_region(t: Tables) -> DataFrame:
    path = t.stages.path("json_region")
    _nested_regions(t).write.mode("overwrite").partitionBy("sample_id").json(path, **GZIP)
    return _flat_regions(t.per_sample(path, readers.scan_region_pvalue))


def _bedgraph(t: Tables) -> DataFrame:
    covered = t.stages.write("covered", lambda: t.covered)  # two tracks, one aggregate
    meth, cov = writers.write_bedgraph(covered, t.stages.path("bedgraph"))
    key = "sample_id string, chr string, pos_start bigint, pos_end bigint"
    read = lambda p, c: t.spark.read.schema(
        key.replace("sample_id string, ", "") + f", {c}, sample_id string").csv(p, sep="\t")
    return read(meth, "meth_perc double").join(
        read(cov, "cov bigint"), ["sample_id", "chr", "pos_start", "pos_end"])


def _write_csv(t: Tables, header: bool) -> DataFrame:
    df = t.counts if header else t.cpg_asm
    path = writers.write_csv(df, t.stages.path(f"csv_out_{header}"), header=header)
    return t.spark.read.schema(df.schema).csv(path, header=header)


def _write_ndjson(t: Tables) -> DataFrame:
    nested = _nested_regions(t)
    path = writers.write_ndjson(nested, t.stages.path("ndjson"))
    return _flat_regions(t.spark.read.schema(nested.schema).json(path))


def _stage_checkpoint(t: Tables) -> DataFrame:
    stages = writers.Stages(t.spark, name=t.stages.root.rsplit("/", 1)[1] + "_restart", reuse=True)
    for _ in range(2):  # the second call takes up the finished stage
        stage = stages.write("coverage", lambda: t.coverage)
    return stage


def _append(t: Tables) -> DataFrame:
    snps = t.stages.write("snps", lambda: t.snps)  # cleaned once, not per chromosome
    chromosomes = [variants.chromosome_filter(snps, c) for c in ("1", "2", "3")]
    path = t.stages.path("snps_by_chr")
    writers.write_partitioned(readers.append_chromosomes(*chromosomes), path)
    return t.spark.read.parquet(path).select(*t.snps.columns)


def _layout(t: Tables) -> DataFrame:
    path = t.stages.path("sam_by_chr")
    writers.write_partitioned(alignment.layout_by_chromosome(t.raw("sam_raw")), path)
    return t.spark.read.parquet(path).select(
        "sample_id", "chr", "read_id", "flag", "read_start", "cigar")


_CPG_FIELDS = ["pos", "effect", "fisher_pvalue", "ref_cov", "alt_cov"]
_BOUNDS = ["asm_region_inf", "asm_region_sup", "min_cpg", "max_cpg"]


def _asm_snp(t: Tables) -> DataFrame:
    calls = t.once("context_raw")
    return asm.call_asm(t.strand("OB", calls), t.strand("OT", calls), t.sam_once, t.raw("vcf_raw"),
                        t.exclusion, PARAMS)


def _overlap_rejoin(t: Tables) -> DataFrame:
    # The shuffles of the overlap go before the wide columns are joined back.
    pairs = t.stages.write("overlap_pairs", lambda: genotype.overlap_pairs(t.reads_once, t.snps))
    return genotype.overlap_rejoin(t.reads_once, pairs)


def _remove_duplicates(t: Tables) -> DataFrame:
    columns = ["sample_id", "chr", "read_id", "flag", "read_start", "mate_read_start", "cigar"]
    aligned = t.columns_once("aligned_raw", *columns, "rnext", "genome_strand", "score_before_recal")
    # The shuffles that compare fragments go before the reads of those that stay are picked.
    best = t.stages.write("best_fragments", lambda: alignment.best_fragments(aligned, "score_before_recal"))
    return alignment.remove_duplicates(aligned, "score_before_recal", best=best).select(*columns)


def _untied(counts: DataFrame) -> DataFrame:
    """Each fraction once, as that of the allele that shows it more often."""
    ref = (F.col("n_ref") >= F.col("n_alt")).cast("bigint")
    return counts.select(*region.SNP, "fraction", ref.alias("n_ref"), (1 - ref).alias("n_alt"))


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # sources
    "scan_cpg_context": _scan_context,
    "scan_sam": _scan_sam,
    "scan_vcf": lambda t: _scan_vcf(t, "vcf_raw"),
    "scan_exclusion_vcf": lambda t: _scan_vcf(t, "excluded_raw"),
    "scan_common_snps": lambda t: t.per_sample(
        t.lines("common", t.raw("common_raw")), readers.scan_common_snps),
    "scan_cpg_asm": _scan_cpg_asm,
    "scan_region_pvalue": _scan_region,
    "append_chromosomes": _append,
    "rejected_lines": _rejected,
    "line_counts": _line_counts,
    # sinks
    "write_bedgraph": _bedgraph,
    "write_csv": lambda t: _write_csv(t, True),
    "write_csv_noheader": lambda t: _write_csv(t, False),
    "write_ndjson": _write_ndjson,
    "stage_checkpoint": _stage_checkpoint,
    # projections and filters
    "context_normalise": lambda t: t.context_once,
    "clean_sam": lambda t: t.reads_once,
    "clean_vcf": lambda t: t.snps,
    "common_snp_exclusion": lambda t: variants.common_snp_exclusion(
        t.raw("common_raw"), PARAMS.snp_freq),
    "vcf_exclusion": lambda t: t.exclusion,
    "cigar_split": lambda t: genotype.cigar_split(t.pairs_once).select(
        "sample_id", "snp_id", "read_id", "read_start", "cigar", "length_cig", "snp_pos_in_read",
        F.array_join("a_cig_letters", "").alias("letters"),
        F.array_join("a_cig_num", " ").alias("numbers")),
    "cigar_segments": lambda t: genotype.cigar_segments(genotype.cigar_split(t.pairs_once)).select(
        "sample_id", "snp_id", "read_id", "read_start", "cigar", "first_m", "second_m", "third_m"),
    "snp_base_at_read": lambda t: t.bases,
    "snp_score_filter": lambda t: genotype.snp_score_filter(t.bases, STRICT_SCORE),
    "tag_allele": lambda t: genotype.tag_allele(
        genotype.snp_score_filter(t.bases, PARAMS.snp_score)),
    "coverage_filter": lambda t: t.covered,
    "allele_coverage_filter": lambda t: cpg.allele_coverage_filter(t.counts, PARAMS.cpg_cov),
    "min_cpg_filter": lambda t: region.min_cpg_filter(t.summary, PARAMS.cpg_per_asm_region).select(
        "sample_id", "snp_id", "snp_pos", "chr", "nb_cpg"),
    "chromosome_filter": lambda t: variants.chromosome_filter(t.reads_once, "2").select(
        "sample_id", "chr", "read_id", "r_strand", "read_start", "read_end"),
    # joins
    "covered_context": lambda t: ctx.covered_context(t.context_once, t.covered),
    "reads_overlap_snp": lambda t: genotype.reads_overlap_snp(t.reads_once, t.snps),
    "overlap_rejoin": _overlap_rejoin,
    "exclude_snp_cpgs": lambda t: cpg.exclude_snp_cpgs(t.context_once, t.exclusion),
    "cpg_read_genotype": lambda t: t.calls_once,
    "pair_alleles": lambda t: cpg.cpg_genotype(t.calls_once),
    "drop_conflicting_reads": lambda t: genotype.drop_conflicting_reads(t.tagged),
    "well_covered_cpg_reads": lambda t: region.well_covered_cpg_reads(t.calls, t.cpg_asm),
    "region_reads": lambda t: region.region_reads(t.calls, region.region_cpgs(
        t.cpg_asm, region.min_cpg_filter(t.summary, PARAMS.cpg_per_asm_region))),
    "ref_alt_arrays": lambda t: region.read_fraction_arrays(t.fraction_counts).select(
        *region.SNP, *[F.array_join(F.transform(a, lambda r: F.round(
            r.methyl_perc * region.FRACTION_SCALE).cast("bigint").cast("string")), ",").alias(a)
            for a in ("ref", "alt")]),
    "attach_region_effect": lambda t: split_join(
        significance.region_effect(t.fraction_counts), t.summary, region.SNP, "inner", HotKeys()).select(
            *region.SNP, "snp_pos", "chr", "asm_region_inf", "asm_region_sup", "asm_region_effect",
            "ref_reads", "alt_reads", "nb_cpg", "nb_sig_cpg", "pos_sig_cpg", "neg_sig_cpg"),
    # aggregates
    "cpg_coverage": lambda t: t.coverage,
    "cpg_genotype": lambda t: cpg.allele_coverage_filter(cpg.cpg_genotype(t.calls_once), PARAMS.cpg_cov),
    "count_alleles": lambda t: genotype.count_alleles(t.tagged_once),
    "snp_cpg_array": lambda t: region.snp_cpg_array(t.cpg_asm).select(
        *region.SNP, "snp_pos", "chr", F.posexplode("cpg").alias("i", "c")).select(
            *region.SNP, "snp_pos", "chr", "i", *[F.col(f"c.{f}").alias(f) for f in _CPG_FIELDS]),
    "any_value": lambda t: t.cpg_asm.groupBy(*region.SNP).agg(
        F.min("snp_pos").alias("snp_pos"), F.min("chr").alias("chr")),
    "read_methylation": lambda t: region.read_methylation(t.in_region),
    "collect_read_fractions": lambda t: region.read_fraction_counts(t.fractions),
    "region_effect": lambda t: significance.region_effect(t.fraction_counts),
    "snp_cpg_counts": lambda t: region.snp_summary(t.cpg_asm, PARAMS.p_value).select(
        *region.SNP, "snp_pos", "chr", "nb_cpg", "nb_sig_cpg", "pos_sig_cpg", "neg_sig_cpg", *_BOUNDS),
    # set operations and order
    "union_all": lambda t: t.strand("OB", t.once("context_raw")).unionByName(t.strand("OT", t.once("context_raw"))),
    "except_distinct": lambda t: cpg.except_distinct(t.context_once, t.exclusion),
    "distinct": lambda t: t.context_once.select(*ctx.SITE).dropDuplicates(),
    "order_in_array": lambda t: region.snp_cpg_array(t.cpg_asm).select(
        *region.SNP, F.array_join(F.transform("cpg", lambda c: c.pos.cast("string")), ",").alias("positions")),
    "sort_by_chr": lambda t: t.regions.select(
        "sample_id", "chr", "snp_id", "snp_pos").orderBy(F.desc("chr")),
    # statistics
    "fisher_exact": lambda t: cpg.fisher_exact(
        cpg.allele_coverage_filter(t.counts, PARAMS.cpg_cov)),
    "mann_whitney": lambda t: significance.mann_whitney(t.fraction_counts),
    "benjamini_hochberg": lambda t: significance.benjamini_hochberg(t.regions).select(
        *region.SNP, "wilcoxon_pvalue", "wilcoxon_corr_pvalue"),
    "cpg_streaks": lambda t: region.snp_summary(t.cpg_asm, PARAMS.p_value).select(
        *region.SNP, "nb_consec_pos_sig_asm", "nb_consec_neg_sig_asm"),
    "asm_decision": lambda t: significance.asm_decision(
        significance.benjamini_hochberg(t.regions), PARAMS),
    "asm_snp_table": _asm_snp,
    "exact_rank_test": lambda t: significance.mann_whitney(_untied(t.fraction_counts), "exact"),
    "multi_locus_ids": lambda t: variants.multi_locus_ids(t.snps),
    "informative_reads": lambda t: genotype.tag_allele(genotype.informative_reads_only(
        genotype.snp_score_filter(t.bases, PARAMS.snp_score))),
    # reads before calling
    "extract_methylation": lambda t: alignment.extract_methylation(t.columns_once("sam_raw", *alignment.SAM_COLUMNS), PARAMS),
    "remove_duplicates": _remove_duplicates,
    "layout_by_chromosome": _layout,
    "variant_depth_cap": lambda t: alignment.variant_depth_cap(t.reads_once, t.snps, SHALLOW_DEPTH),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Tables], DataFrame]):
        return lambda spark, sf_dir: build(Tables.of(spark, sf_dir.rstrip("/")))

    return {name: bind(build) for name, build in _QUERIES.items()}
