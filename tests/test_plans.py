"""The whole chain, its stages, and the shape of the plans."""

import re
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strandfold import schemas
from strandfold.operators import context as ctx
from strandfold.operators import cpg, genotype, prefilter, region, significance
from strandfold.operators.skew import HotKeys, find_hot_keys
from strandfold.params import AsmParams
from strandfold.plans import asm, catalog, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return catalog.Tables.of(spark, SF)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_every_query_has_check_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_final_table(tables):
    out = catalog.queries()["asm_snp_table"](tables.spark, SF)
    assert out.columns == ["sample_id", *schemas.ASM_SNP_COLUMNS]
    rows = out.collect()
    assert len({(r.sample_id, r.snp_id) for r in rows}) == len(rows) == 100
    assert {r.asm_snp for r in rows} == {True, False}


def test_fused_order_equals_step_by_step(tables):
    """Reads first and sites last gives the rows of the step-by-step chain."""
    none = HotKeys()
    context = ctx.covered_context(tables.context, tables.covered, none)
    context = cpg.exclude_snp_cpgs(context, tables.exclusion, none)
    kept = genotype.drop_conflicting_reads(tables.tagged, none)
    steps = cpg.cpg_read_genotype(context, kept, none)
    fused = asm.allele_calls(tables.context, tables.genotypes, tables.usable)
    assert steps.count() == fused.count() == steps.select(*fused.columns).intersect(fused).count()


def test_hot_keys_leave_the_calls_unchanged(tables):
    (hot,) = find_hot_keys(tables.context, ["sample_id", "read_id"], rows_per_split=2)
    assert hot
    plain = cpg.cpg_read_genotype(tables.context, tables.tagged, HotKeys())
    split = cpg.cpg_read_genotype(tables.context, tables.tagged, hot)
    assert plain.count() == split.count() == plain.intersect(split).count()


def test_plans_stay_in_the_jvm_and_join_on_keys(tables):
    none = HotKeys()
    plans = [
        genotype.reads_overlap_snp(tables.reads, tables.snps, none),
        asm.allele_calls(tables.context, tables.genotypes, tables.usable),
        cpg.fisher_exact(tables.counts, none),
        region.snp_summary(tables.cpg_asm, 0.05),
        asm.region_table(tables.calls, tables.summary, tables.cpg_asm),
        significance.benjamini_hochberg(tables.regions),
    ]
    for df in plans:
        text = plan_of(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert bad not in text


def test_coverage_reads_two_columns(tables):
    text = plan_of(ctx.cpg_coverage(tables.context).select("cov"))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert "read_id" not in schema


def test_join_by_read_needs_no_shuffle_for_the_distinct(tables):
    spark = tables.spark
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(cpg.cpg_read_genotype(
            tables.context, genotype.distinct_genotypes(tables.tagged), HotKeys()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    top = text[: text.index("SortMergeJoin")]
    assert "Exchange" not in top


def test_distinct_genotypes_take_one_shuffle(tables):
    text = plan_of(genotype.distinct_genotypes(tables.tagged))
    assert len(re.findall(r"\+- (?:\* )?Exchange", text)) == 1


def jobs_of(spark, act):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        result = act()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_joins_start_no_job_of_their_own(tables):
    """No pass over a table looks for frequent keys before a join."""
    made = [
        lambda: ctx.covered_context(tables.context, tables.covered),
        lambda: genotype.reads_overlap_snp(tables.reads, tables.snps),
        lambda: genotype.overlap_rejoin(tables.reads, genotype.overlap_pairs(tables.reads, tables.snps)),
        lambda: cpg.fisher_exact(tables.counts),
        lambda: region.region_reads(tables.calls, tables.cpg_asm),
        lambda: significance.benjamini_hochberg(tables.regions),
    ]
    _ = tables.pairs, tables.counts, tables.calls, tables.cpg_asm, tables.regions
    for make in made:
        assert jobs_of(tables.spark, make)[1] == 0


def test_few_calls_are_shuffled_by_read(tables):
    """The bitmap keeps the calls of reads without a genotype out of the shuffle, and the rows are the same."""
    some = tables.genotypes.filter("abs(hash(read_id)) % 10 = 0")
    kept = prefilter.may_match(tables.context, some, cpg.READ_KEYS, some.count())
    linked = tables.context.join(some, cpg.READ_KEYS, "left_semi").count()
    assert linked <= kept.count() <= linked + 0.2 * tables.context.count()
    with_bitmap, without = cpg.link_alleles(kept, some), cpg.link_alleles(tables.context, some)
    assert with_bitmap.exceptAll(without).isEmpty() and without.exceptAll(with_bitmap).isEmpty()


def test_settings_of_the_session_come_back(tables):
    spark, name = tables.spark, "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        asm.call_asm(tables.strand("OB"), tables.strand("OT"), tables.raw("sam_raw"), tables.raw("vcf_raw"), tables.exclusion)
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)


def test_one_more_sample_gives_the_rows_of_a_full_run(tables, tmp_path):
    name = f"samples-asm-{tmp_path.parent.name}"
    inputs = (tables.strand("OB"), tables.strand("OT"), tables.raw("sam_raw"), tables.raw("vcf_raw"), tables.exclusion)
    first = asm.call_samples(["s1"], *inputs, name=name).collect()
    both, jobs = jobs_of(tables.spark, lambda: asm.call_samples(["s1", "s2"], *inputs, name=name))
    again, fewer = jobs_of(tables.spark, lambda: asm.call_samples(["s1", "s2"], *inputs, name=name))
    full = asm.call_asm(*inputs)
    assert {r.sample_id for r in first} == {"s1"}
    for run in (both, again):
        assert sorted(map(str, run.collect())) == sorted(map(str, full.collect()))
    assert fewer < jobs


def test_raw_variants_are_capped_in_the_chain(tables):
    params = AsmParams(variants="raw.vcf", max_snp_depth=catalog.SHALLOW_DEPTH)
    capped = asm.genotype_reads(tables.raw("sam_raw"), tables.raw("vcf_raw"), params).select("sample_id", "snp_id", "pos").distinct()
    shallow = catalog.queries()["variant_depth_cap"](tables.spark, SF)
    every = asm.genotype_reads(tables.raw("sam_raw"), tables.raw("vcf_raw"), AsmParams()).select("sample_id", "snp_id", "pos").distinct()
    assert capped.join(shallow, ["sample_id", "snp_id", "pos"], "left_anti").isEmpty()
    assert capped.count() == every.join(shallow, ["sample_id", "snp_id", "pos"], "left_semi").count()


def small_calls(spark):
    """Calls of twelve reads of one SNP at four CpGs, as a table whose size the optimizer knows to be tiny."""
    rows = ", ".join(
        f"('s1', 'c1', {pos}L, {int(allele == 'ALT') if i % 3 else 1}, 1, 'rs1', 100L, '{allele}', '{allele}{i}')"
        for pos in (80, 90, 110, 120) for allele in ("REF", "ALT") for i in range(6))
    names = "sample_id, chr, pos, meth, cov, snp_id, snp_pos, allele, read_id"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})")


def test_usable_cpgs_are_not_met_by_a_broadcast(spark):
    exclusion = spark.sql("SELECT 's1' AS sample_id, 'c1' AS chr_snp, 91L AS pos_snp")
    usable = asm.usable_cpgs(small_calls(spark), exclusion, 12)
    assert "Broadcast" not in plan_of(usable)
    assert sorted(r.pos for r in usable.collect()) == [80, 110, 120]


def test_allele_calls_broadcast_the_bitmap_only(spark):
    calls = small_calls(spark)
    genotypes = calls.select("sample_id", "snp_id", F.col("snp_pos").alias("pos"), "allele", "read_id").distinct()
    usable = calls.select(*ctx.SITE).distinct().filter("pos < 120")
    found = asm.allele_calls(calls.select("sample_id", "read_id", "chr", "pos", "meth", "cov"), genotypes, usable)
    assert len(re.findall(r"\+- (?:\* )?BroadcastExchange", plan_of(found))) == 1
    assert found.count() == 36


def test_statistics_of_snps_broadcast_nothing(spark):
    """Counts, summaries and effects grow with the SNPs; only tables of distinct p-values are bounded."""
    calls = small_calls(spark)
    cpgs = cpg.fisher_exact(cpg.cpg_genotype(calls))
    summary = region.snp_summary(cpgs, 0.05)
    counts = region.read_fraction_counts(region.read_methylation(calls))
    tables = SimpleNamespace(fraction_counts=counts, summary=summary)
    tagged = calls.select("sample_id", "snp_id", F.col("snp_pos").alias("pos"), "allele", "read_id")
    made = {
        "fisher": (cpgs, 4),
        "region": (asm.region_table(calls, summary, cpgs), 1),
        "effect": (catalog._QUERIES["attach_region_effect"](tables), 1),
        "exact": (significance.mann_whitney(counts, "exact"), 1),
        "agreed": (genotype.drop_conflicting_reads(tagged), 48),
        "covered": (region.well_covered_cpg_reads(calls, cpgs), 48),
    }
    for name, (df, rows) in made.items():
        assert "Broadcast" not in plan_of(df), name
        assert df.count() == rows, name


def test_reads_are_joined_back_without_a_broadcast(spark):
    reads = spark.sql("""SELECT 's1' AS sample_id, 'c1' AS chr, concat('r', id) AS read_id, 'R1' AS r_strand, id AS read_start,
        id + 9 AS read_end, '10M' AS cigar, 'A' AS seq, 'F' AS score_before_recal, true AS CT_strand, false AS GA_strand FROM range(20)""")
    snps = spark.sql("""SELECT 's1' AS sample_id, 'c1' AS chr, 'rs1' AS snp_id, 15L AS pos, 'A' AS ref, 'C' AS alt,
        true AS CT_strand, true AS GA_strand""")
    joined = genotype.overlap_rejoin(reads, genotype.overlap_pairs(reads, snps))
    assert "Broadcast" not in plan_of(joined)
    assert joined.count() == 10
