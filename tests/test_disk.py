"""What queries leave on disk: shuffle files, stage tables, and rows that are shuffled scattered."""

import random
import re
import time
from pathlib import Path

import pytest

from strandfold.operators import alignment, cpg, region, sites
from strandfold.operators.skew import HotKeys, split_join
from strandfold.plans import asm, catalog
from strandfold.sources import readers, writers

CALLS = "sample_id string, chr string, pos bigint, meth int, cov int, snp_id string, snp_pos bigint, allele string, read_id string"


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffled_by(df):
    return re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan_of(df))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if "/shuffle_" in f}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of its own: 1,500 fragments over 20 suppliers' SNPs."""
    at = tmp_path_factory.mktemp("tables")
    spark.sql("""SELECT id % 400 AS l_orderkey, cast(1 + id % 7 AS int) AS l_linenumber, id * 13 % 200 AS l_partkey,
        id * 7 % 20 AS l_suppkey FROM range(1500)""").write.parquet(f"{at}/lineitem.parquet")
    spark.sql("SELECT id AS s_suppkey FROM range(20)").write.parquet(f"{at}/supplier.parquet")
    spark.sql("SELECT id AS p_partkey, cast(id % 50 AS int) AS p_size FROM range(200)").write.parquet(f"{at}/part.parquet")
    return str(at)


def test_shuffles_of_a_stage_go_when_it_is_written(spark):
    before, stages = shuffle_files(spark), writers.Stages(spark)
    table = stages.write("counted", lambda: spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    left = shuffle_files(spark) - before
    for _ in range(50):  # the files go in the background
        if not left:
            break
        time.sleep(0.2)
        left = shuffle_files(spark) - before
    assert not left and table.count() == 7
    stages.delete()


def written(folder, tables):
    root = Path(tables.stages.root.removeprefix("file://").removeprefix("file:"))
    return {p.name for p in root.iterdir() if p.is_dir()} if root.exists() else set()


@pytest.mark.parametrize("name, kept", [
    ("cpg_genotype", {"genotypes", "usable"}),
    ("fisher_exact", {"genotypes", "usable", "counts"}),
    ("mann_whitney", {"genotypes", "usable", "calls", "counts", "cpg_asm", "summary", "fraction_counts"}),
    ("region_reads", {"genotypes", "usable", "calls", "counts", "cpg_asm", "summary"}),
    ("covered_context", set()), ("overlap_rejoin", {"overlap_pairs"}), ("remove_duplicates", {"best_fragments"}),
    ("drop_conflicting_reads", {"tagged"}), ("scan_sam", set()), ("extract_methylation", set()),
    ("line_counts", {f"good_{layout}_{s}" for layout in ("sam", "cpg_context") for s in ("s1", "s2")}),
    ("rejected_lines", {"genotypes", "usable", "calls", "counts", "cpg_asm", "summary", "fraction_counts", "regions"}),
])
def test_steps_gone_over_once_are_not_written(spark, folder, monkeypatch, name, kept):
    monkeypatch.setattr(catalog.Tables, "_known", {})
    catalog.queries()[name](spark, folder)
    (tables,) = catalog.Tables._known.values()
    assert {s for s in written(folder, tables) if not s.startswith("text_")} - {"vcf_raw", "excluded_raw", "common_raw"} == kept


def test_a_line_is_split_once(spark, tmp_path):
    """Not again for each field that the reader looks at before it takes the line."""
    (tmp_path / "some.sam").write_text("a\tb\n")
    for df in (readers.scan_sam(spark, str(tmp_path), "s1"), readers.rejected_lines(spark, str(tmp_path), "sam")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert readers.scan_sam(spark, str(tmp_path), "s1").isEmpty() and readers.rejected_lines(spark, str(tmp_path), "sam").count() == 1


def test_duplicates_found_before_are_those_found_within(spark, folder):
    tables = catalog.Tables(spark, folder)
    aligned = tables.raw("aligned_raw")
    best = alignment.best_fragments(aligned, "score_before_recal")
    plain = alignment.remove_duplicates(aligned, "score_before_recal")
    assert 0 < best.count() < aligned.select(*alignment.READ).distinct().count()
    assert same(plain, alignment.remove_duplicates(aligned, "score_before_recal", best=best))
    assert same(plain.select(*alignment.READ).distinct(), best)


def calls(spark, seed=3):
    """Calls that repeat, lack a chromosome, position or SNP, or lie left of zero."""
    rng = random.Random(seed)
    some = lambda *values: rng.choice(values)
    rows = [(some("s1", "s2", None), some("c1", "c1", "c2", None), some(-1030, -3, 0, 63, 64, 1023, 1024, 5000, None), some(0, 1), 1,
             some("rs1", "rs2", None), some(10, 20), some("REF", "ALT"), f"r{rng.randrange(30)}") for _ in range(3000)]
    return spark.createDataFrame(rows, CALLS)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_calls_at_cpgs_of_a_snp_equal_the_join(spark):
    """Looked up in bitmaps by stretch and SNP, as joined by position, also where a CpG has two SNP positions."""
    reads = calls(spark)
    cpgs = calls(spark, 4).filter("pos % 2 = 1 or pos = 64 or pos is null").select(*cpg.CPG_SNP, "snp_pos").limit(60)
    joined = split_join(reads.drop("snp_pos"), cpgs, cpg.CPG_SNP, "inner", HotKeys()).dropDuplicates()
    found = region.region_reads(reads, cpgs)
    assert joined.count() > 50 and same(found, joined)
    covered = split_join(reads.drop("snp_pos"), cpgs, cpg.CPG_SNP, "left_semi", HotKeys()).dropDuplicates()
    assert same(region.well_covered_cpg_reads(reads, cpgs), covered)
    for df in (found, region.well_covered_cpg_reads(reads, cpgs)):
        assert not any("pos#" in keys for keys in shuffled_by(df) if "_stretch" not in keys)
    assert same(sites.distinct(reads, first="read_id"), reads.dropDuplicates())


def test_allele_calls_are_shuffled_by_read_and_by_stretch(spark):
    """Not by position, where the calls of a read part; the alleles are shuffled once."""
    table = calls(spark)
    context = table.select("sample_id", "read_id", "chr", "pos", "meth", "cov")
    genotypes = table.selectExpr("sample_id", "snp_id", "snp_pos AS pos", "allele", "read_id").distinct()
    usable = table.select("sample_id", "chr", "pos").distinct().filter("pos < 1024")
    found = asm.allele_calls(context, genotypes, usable)
    want = context.join(genotypes.withColumnRenamed("pos", "snp_pos"), ["sample_id", "read_id"]).join(
        usable, ["sample_id", "chr", "pos"], "left_semi").select(*cpg.READ_COLUMNS).distinct()
    assert want.count() > 1000 and same(found, want)
    keys = shuffled_by(asm.allele_calls(context, spark.createDataFrame(genotypes.collect(), genotypes.schema), spark.createDataFrame(usable.collect(), usable.schema)))
    assert not any(re.search(r"\bpos#", k) for k in keys), keys
    assert len([k for k in keys if "read_id" in k]) == 2, keys
