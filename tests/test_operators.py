"""Operators on hand-written edge rows."""

import json

import pytest
from pyspark.sql import functions as F

from strandfold.operators import alignment, cpg, genotype, reads, region, significance, skew, variants
from strandfold.operators import context as ctx
from strandfold.operators.skew import HotKeys
from strandfold.params import AsmParams
from strandfold.sources import readers, writers

NONE = HotKeys()


def test_context_strands_pool_into_one_cpg(spark):
    ddl = "sample_id string, read_id string, meth_state string, chr string, pos bigint, meth_call string"
    ob = spark.createDataFrame([("s", f"b{i}", "+", "1", 101, "Z") for i in range(4)], ddl)
    ot = spark.createDataFrame(
        [("s", f"t{i}", "-", "1", 100, "z") for i in range(5)] + [("s", "x", "+", "1", 100, None)]
        + [("s", f"n{i}", "+", "1", 300, "Z") for i in range(9)] + [("t", "t0", "+", "1", 100, "Z")], ddl)
    coverage = ctx.cpg_coverage(ctx.normalise_context(ob, ot))
    got = {(r.sample_id, r.pos_start): (r["cov"], r.meth_perc) for r in coverage.collect()}
    assert got == {("s", 100): (10, 0.4), ("s", 300): (9, 1.0), ("t", 100): (1, 1.0)}
    kept = ctx.coverage_filter(coverage, AsmParams().pooled_cov)
    assert [(r.sample_id, r.pos_start) for r in kept.collect()] == [("s", 100)]
    context = ctx.normalise_context(ob, ot)
    assert ctx.covered_context(context, kept, NONE).count() == 10


def test_snp_strands_for_all_pairs(spark):
    pairs = [(a, b) for a in "ACGT" for b in "ACGT" if a != b]
    rows = [("s", "1", "5", f"rs{a}{b}", a, b) for a, b in pairs] + [
        ("s", "1", "5", "rsAC", "A", "C"), ("s", "1", "5", "rs1", "AT", "C"), ("s", "1", "5", ".", "A", "C"),
        ("s", "1", "5", "ss9", "A", "C"), ("s", "1", "x", "rsbad", "A", "C")]
    out = variants.clean_vcf(spark.createDataFrame(
        rows, "sample_id string, chr string, pos string, snp_id string, ref string, alt string")).collect()
    assert len(out) == 13
    assert [r.pos for r in out if r.snp_id == "rsbad"] == [None]
    for r in out:
        if r.snp_id != "rsbad":
            assert r.CT_strand == ({r.ref, r.alt} != {"C", "T"})
            assert r.GA_strand == ({r.ref, r.alt} != {"G", "A"})


def test_common_snps(spark):
    rows = [("s", "chr1", 9, "rs1", "0.95,0.05,"), ("s", "chr6_cox_hap2", 9, "rs2", "0.949,0.051,"),
            ("s", "chr1", 9, "rs3", ""), ("s", "chr1", 9, "x4", "0.5,0.5,"), ("s", "chr1", 9, "rs5", None)]
    out = variants.common_snp_exclusion(spark.createDataFrame(
        rows, "sample_id string, chr string, pos bigint, snp_id string, alleleFreqs string"), 0.05).collect()
    assert [(r.chr_snp, r.snp_id, r.max) for r in out] == [("6", "rs2", 0.949)]


def pair(cigar, offset, base="A", score="I", ref="A", alt="C", length=100, ct=True):
    return ("s", "1", "rs1", 1000 + offset - 1, ref, alt, True, True, ct, not ct, 1000, 1000 + length - 1,
            cigar, "r1")


PAIR_DDL = ("sample_id string, chr string, snp_id string, pos bigint, ref string, alt string, "
            "CT_strand boolean, GA_strand boolean, seq_CT_strand boolean, seq_GA_strand boolean, "
            "read_start bigint, read_end bigint, cigar string, read_id string")

# The index a base is taken from is read off a sequence of distinct characters.
ALPHABET = "".join(chr(0x4E00 + i) for i in range(100))


@pytest.mark.parametrize("cigar,offset,reference,exact", [
    ("100M", 1, 1, 1), ("100M", 100, 100, 100), ("100M", 101, None, None),
    ("20M1I79M", 20, 20, 20), ("20M1I79M", 21, 22, 22), ("20M1I79M", 98, 99, 99), ("20M1I79M", 99, None, 100),
    ("20M2D80M", 20, 20, 20), ("20M2D80M", 21, 19, None), ("20M2D80M", 23, 21, 21), ("20M2D80M", 102, 100, 100),
    ("30M1I30M1D39M", 59, 60, 60), ("30M1I30M1D39M", 60, 60, 61), ("30M1I30M1D39M", 99, 99, 99),
    ("20M1D30M1D50M", 40, 39, 39), ("20M1D30M1D50M", 60, 58, 58), ("20M1D30M1D50M", 99, None, 97),
    ("20M1I30M1I48M", 50, 52, 51), ("20M1I30M1I48M", 98, 100, 100),
    ("30M1D30M1I39M", 70, 70, 70), ("10M1I10M1I10M1I67M", 40, None, 43), ("5M", 6, None, None),
])
def test_base_lookup(spark, cigar, offset, reference, exact):
    df = spark.createDataFrame([pair(cigar, offset)], PAIR_DDL).withColumns({
        "seq": F.lit(ALPHABET), "score_before_recal": F.lit("OQ:Z:" + ALPHABET)})
    for mode, want in (("reference", reference), ("exact", exact)):
        out = genotype.snp_base_at_read(df, mode).collect()
        got = [ALPHABET.index(r.snp_in_read) + 1 for r in out if r.snp_in_read]
        assert got == ([] if want is None else [want]), mode
        for r in out:
            assert r.snp_score == r.snp_in_read


def test_score_threshold_and_missing_base(spark):
    df = spark.createDataFrame([("A", "!"), ("A", '"'), ("", "I"), ("A", "")], "snp_in_read string, snp_score string")
    assert [r.snp_score for r in genotype.snp_score_filter(df, 33).collect()] == ["!", '"']
    assert [r.snp_score for r in genotype.snp_score_filter(df, 34).collect()] == ['"']


@pytest.mark.parametrize("ref,alt,base,ct_read,want", [
    ("A", "C", "A", True, "REF"), ("A", "C", "C", True, "ALT"), ("A", "C", "T", True, "ALT"),
    ("A", "C", "T", False, None), ("C", "G", "T", True, "REF"), ("C", "G", "A", False, "ALT"),
    ("C", "G", "A", True, None), ("C", "T", "T", True, "ALT"), ("C", "T", "T", False, "ALT"),
    ("G", "A", "A", False, "ALT"), ("A", "C", "N", True, None),
])
def test_alleles(spark, ref, alt, base, ct_read, want):
    snp = spark.createDataFrame([("s", "1", "7", "rs1", ref, alt)],
                                "sample_id string, chr string, pos string, snp_id string, ref string, alt string")
    df = variants.clean_vcf(snp).withColumns({
        "snp_in_read": F.lit(base), "read_id": F.lit("r"),
        "seq_CT_strand": F.lit(ct_read), "seq_GA_strand": F.lit(not ct_read)})
    assert [r.allele for r in genotype.tag_allele(df).collect()] == ([want] if want else [])


def test_conflicting_mates_are_dropped_per_sample(spark):
    rows = [("s", "rs1", "1", 5, "r1", "REF"), ("s", "rs1", "1", 5, "r1", "ALT"),
            ("s", "rs1", "1", 5, "r2", "REF"), ("s", "rs1", "1", 5, "r2", "REF"),
            ("t", "rs1", "1", 5, "r1", "ALT")]
    df = spark.createDataFrame(
        rows, "sample_id string, snp_id string, chr string, pos bigint, read_id string, allele string")
    kept = sorted((r.sample_id, r.read_id) for r in genotype.drop_conflicting_reads(df, NONE).collect())
    assert kept == [("s", "r2"), ("s", "r2"), ("t", "r1")]
    once = sorted((r.sample_id, r.read_id) for r in genotype.distinct_genotypes(df).collect())
    assert once == [("s", "r2"), ("t", "r1")]


def test_cpg_exclusion(spark):
    context = spark.createDataFrame(
        [("s", "r", "1", p, 1, 1) for p in (10, 20, 30)] + [("t", "r", "1", 10, 1, 1), ("s", "r", None, 10, 1, 1)],
        "sample_id string, read_id string, chr string, pos bigint, meth int, cov int")
    snps = spark.createDataFrame([("s", "1", 10), ("s", "1", 21), ("s", "1", 29), ("s", "chr1", 30), ("s", "1", None)],
                                 "sample_id string, chr_snp string, pos_snp bigint")
    kept = sorted((r.sample_id, r.pos) for r in cpg.exclude_snp_cpgs(context, snps, NONE).collect())
    assert kept == [("s", 30), ("t", 10)]
    sites = context.filter("chr is not null")
    assert sorted((r.sample_id, r.pos) for r in cpg.except_distinct(sites, snps).collect()) == kept
    assert variants.chromosome_overlap(sites, snps.filter("chr_snp = 'chr1'")).count() == 0


def test_alt_counts_are_pooled_over_positions_of_an_id(spark):
    rows = [("s", "1", 10, 1, 1, "rs1", 5, "REF", "a"), ("s", "1", 10, 0, 1, "rs1", 6, "REF", "b"),
            ("s", "1", 10, 1, 1, "rs1", 7, "ALT", "c"), ("s", "1", 10, 1, 1, "rs1", 5, "ALT", "d"),
            ("s", "1", 20, 1, 1, "rs1", 5, "REF", "a")]
    out = cpg.cpg_genotype(spark.createDataFrame(
        rows, "sample_id string, chr string, pos bigint, meth int, cov int, snp_id string, snp_pos bigint, "
              "allele string, read_id string")).collect()
    assert sorted((r.pos, r.snp_pos, r.ref_cov, r.ref_meth, r.alt_cov, r.alt_meth) for r in out) == [
        (10, 5, 1, 1, 2, 2), (10, 6, 1, 0, 2, 2)]


def cpg_row(snp, pos, effect, p, sample="s"):
    return (sample, "1", pos, snp, 50, 10, 5, 10, 5 + effect, p)  # effect in tenths


def test_streaks_and_counts(spark):
    stretch = region.STRETCH
    cases = {
        "none": [(100, 3, 0.5), (200, 3, 0.6)],
        "single": [(100, 3, 0.01), (200, 3, 0.6)],
        "alternate": [(1, 3, 0.01), (2, -3, 0.01), (3, 3, 0.01), (4, -3, 0.01)],
        "broken": [(1, 3, 0.01), (2, 3, 0.01), (3, 3, 0.05), (4, 3, 0.01)],
        "zero": [(1, 0, 0.01), (2, 0, 0.01), (3, 3, 0.01)],
        "across": [(stretch - 2, -1, 0.5), (stretch - 1, -3, 0.01), (stretch, -3, 0.01), (stretch + 9, -3, 0.01),
                   (2 * stretch + 1, -3, 0.01), (2 * stretch + 2, 1, 0.01)],
        "later": [(1, 3, 0.01), (2, 3, 0.01), (3, -3, 0.01), (5, -3, 0.01), (9, -3, 0.01)],
    }
    rows = [cpg_row(k, *c) for k, cs in cases.items() for c in cs] + [cpg_row("none", 100, 3, 0.01, "t")]
    df = spark.createDataFrame(
        rows, "sample_id string, chr string, pos bigint, snp_id string, snp_pos bigint, ref_cov bigint, "
              "ref_meth bigint, alt_cov bigint, alt_meth bigint, fisher_pvalue double")
    out = {(r.sample_id, r.snp_id): r for r in region.snp_summary(df, 0.05).collect()}
    streak = {k[1]: (r.nb_consec_pos_sig_asm, r.nb_consec_neg_sig_asm) for k, r in out.items() if k[0] == "s"}
    assert streak == {"none": (0, 0), "single": (0, 0), "alternate": (0, 0), "broken": (2, 0),
                      "zero": (0, 0), "across": (0, 4), "later": (2, 3)}
    r = out[("s", "none")]
    assert (r.nb_cpg, r.nb_sig_cpg, r.asm_region_inf, r.min_cpg, r.max_cpg) == (2, 0, None, 100, 200)
    r = out[("s", "zero")]
    assert (r.nb_sig_cpg, r.pos_sig_cpg, r.neg_sig_cpg, r.asm_region_inf, r.asm_region_sup) == (3, 1, 0, 1, 3)
    assert out[("t", "none")].nb_sig_cpg == 1
    arrays = {(r.sample_id, r.snp_id): [c.pos for c in r.cpg] for r in region.snp_cpg_array(df).collect()}
    assert arrays[("s", "across")] == [c[0] for c in cases["across"]]
    # Moving every position leaves the streaks alone.
    moved = region.snp_summary(df.withColumn("pos", F.col("pos") * 37 + 5), 0.05)
    assert {r.snp_id: (r.nb_consec_pos_sig_asm, r.nb_consec_neg_sig_asm)
            for r in moved.collect() if r.sample_id == "s"} == streak


def test_decision_thresholds(spark):
    base = dict(sample_id="s", chr="1", snp_id="x", snp_pos=1, asm_region_inf=1, asm_region_sup=2, ref_reads=15,
                alt_reads=15, asm_region_effect=-0.494, wilcoxon_corr_pvalue=0.00322, nb_cpg=5, nb_sig_cpg=4,
                pos_sig_cpg=1, neg_sig_cpg=3, nb_consec_pos_sig_asm=0, nb_consec_neg_sig_asm=2)
    cases = {
        "published1": ({}, True),
        "published2": (dict(asm_region_effect=-0.297, wilcoxon_corr_pvalue=0.03277, neg_sig_cpg=3), True),
        "published3": (dict(asm_region_effect=-0.426, wilcoxon_corr_pvalue=0.00275, neg_sig_cpg=8,
                            nb_consec_neg_sig_asm=6), True),
        "p at": (dict(wilcoxon_corr_pvalue=0.05), False),
        "effect at": (dict(asm_region_effect=-0.2), False),
        "effect past": (dict(asm_region_effect=-0.201), True),
        "other sign": (dict(asm_region_effect=0.494), False),
        "few": (dict(neg_sig_cpg=2), False),
        "short": (dict(nb_consec_neg_sig_asm=1), False),
        "null p": (dict(wilcoxon_corr_pvalue=None), False),
        "up": (dict(asm_region_effect=0.3, pos_sig_cpg=3, nb_consec_pos_sig_asm=2), True),
    }
    ddl = ("sample_id string, chr string, snp_id string, snp_pos bigint, asm_region_inf bigint, "
           "asm_region_sup bigint, ref_reads bigint, alt_reads bigint, asm_region_effect double, "
           "wilcoxon_corr_pvalue double, nb_cpg bigint, nb_sig_cpg bigint, pos_sig_cpg bigint, "
           "neg_sig_cpg bigint, nb_consec_pos_sig_asm bigint, nb_consec_neg_sig_asm bigint")
    rows = [tuple({**base, **change, "snp_id": name}.values()) for name, (change, _) in cases.items()]
    out = significance.asm_decision(spark.createDataFrame(rows, ddl), AsmParams()).collect()
    assert {r.snp_id: r.asm_snp for r in out} == {name: want for name, (_, want) in cases.items()}


def test_text_scans(spark, tmp_path):
    quality = '"' + "I" * 99
    good = ["r1", "99", "1", "100", "60", "100M", "=", "150", "150", "A" * 100, quality, "b", "p", "g",
            "XG:Z:CT", "n", "m", "OQ:Z:" + "I" * 100, "XR:Z:GA"]
    lines = ["\t".join(good), "\t".join(good[:-1]), "\t".join([*good[:3], "oops", *good[4:]])]
    (tmp_path / "a.sam").write_text("\n".join(lines) + "\n")
    out = readers.scan_sam(spark, str(tmp_path / "a.sam"), "s").collect()
    assert [(r.read_id, r.score, r.read_start) for r in out] == [("r1", quality, 100)]
    assert readers.rejected_lines(spark, str(tmp_path / "a.sam"), "sam").count() == 2
    cleaned = reads.clean_sam(readers.scan_sam(spark, str(tmp_path / "a.sam"), "s")).collect()[0]
    assert (cleaned.read_end, cleaned.CT_strand, cleaned.GA_strand, cleaned.r_strand) == (199, True, False, "R2")
    for i in (1, 2):
        (tmp_path / f"c{i}.txt").write_text(f"header line\nr{i}\t+\t1\t10\tZ\n")
    out = readers.scan_cpg_context(spark, [str(tmp_path / "c1.txt"), str(tmp_path / "c2.txt")], "s").collect()
    assert sorted(r.read_id for r in out) == ["r1", "r2"]


def test_strict_readers_name_the_file(spark, tmp_path):
    vcf = "chr1\t5\trs1\tA\tC\t.\tPASS\tx\tGT\t0/1"
    (tmp_path / "two.vcf").write_text(f"#head\n{vcf}\t1/1\n")
    assert [r.snp_id for r in readers.scan_vcf(spark, str(tmp_path / "two.vcf"), "s").collect()] == ["rs1"]
    (tmp_path / "short.vcf").write_text(f"{vcf}\nchr1\t5\trs1\n")
    with pytest.raises(Exception, match="short.vcf"):
        readers.scan_vcf(spark, str(tmp_path / "short.vcf"), "s").collect()
    assert readers.scan_vcf(spark, str(tmp_path / "short.vcf"), "s", strict=False).count() == 1
    bad = readers.rejected_lines(spark, str(tmp_path / "short.vcf"), "vcf").collect()
    assert [r.value for r in bad] == ["chr1\t5\trs1"] and bad[0].file.endswith("short.vcf")
    (tmp_path / "c.txt").write_text("head\nr1\t+\t1\t10\tZ\nr2\t+\t1\toops\tZ\n")
    with pytest.raises(Exception, match="c.txt"):
        readers.scan_cpg_context(spark, str(tmp_path / "c.txt"), "s").collect()
    assert [r.read_id for r in readers.scan_cpg_context(spark, str(tmp_path / "c.txt"), "s", strict=False).collect()] == ["r1"]
    assert readers.rejected_lines(spark, str(tmp_path / "c.txt"), "cpg_context").count() == 1


def test_lines_are_counted_by_the_pass_that_reads_them(spark, tmp_path):
    good = "\t".join(["r1", "99", "chr1", "10", "30", "4M", "=", "20", "5", "ACGT", 'II"I', *"abcdefgh"])
    (tmp_path / "s.sam").write_text("\n".join([good, "too\tfew", good, good.replace("\t99\t", "\tx\t")]) + "\n")
    (tmp_path / "c.txt").write_text("head\nr1\t+\t1\t5\tZ\nr2\t+\t1\tfive\tZ\nr3\t+\t1\t6\tz\n")
    (tmp_path / "v.vcf").write_text("#CHROM\nchr1\t5\trs1\tA\tC\t3\tPASS\ti\tf\td\nshort\n")
    (tmp_path / "r.json").write_text('{"snp_id": "rs1"}\n{broken\n')
    for scan, name, kept, rejected, lines in (
        (readers.scan_sam, "s.sam", 2, 2, 4), (readers.scan_cpg_context, "c.txt", 2, 1, 3),
        (readers.scan_vcf, "v.vcf", 1, 1, 3), (readers.scan_region_pvalue, "r.json", 1, 1, 2),
    ):
        count = readers.LineCount()
        table = scan(spark, str(tmp_path / name), "s", strict=False, count=count)
        table.write.parquet(str(tmp_path / f"{name}.out"))
        assert (count.rejected, count.lines) == (rejected, lines), name
        assert spark.read.parquet(str(tmp_path / f"{name}.out")).count() == kept
        assert table.columns == scan(spark, str(tmp_path / name), "s", strict=False).columns
    count = readers.LineCount()
    readers.scan_vcf(spark, str(tmp_path / "v.vcf"), "s", strict=False, count=count).select("snp_id").collect()
    assert count.rejected == 1


def test_exclusion_set_by_parameter(spark):
    vcf = spark.createDataFrame([("s", "chr1", "7", "rs1", "A", "C"), ("s", "chr1", "9", "rs2", "AT", "C")],
                                "sample_id string, chr string, pos string, snp_id string, ref string, alt string")
    common = spark.createDataFrame([("s", "chr1", 7, "rs1", "0.5,0.5,"), ("s", "chr2", 8, "rs3", "0.99,0.01,")],
                                   "sample_id string, chr string, pos bigint, snp_id string, alleleFreqs string")
    ids = lambda df: [r.snp_id for r in df.collect()]
    assert ids(variants.exclusion_set(AsmParams(), common=common, raw=vcf)) == ["rs1"]
    assert ids(variants.exclusion_set(AsmParams(snp_freq=0.0), common=common)) == ["rs1", "rs3"]
    for source in ("raw", "filtered"):
        assert ids(variants.exclusion_set(AsmParams(snps_for_cpg=f"{source}.vcf"), **{source: vcf})) == ["rs1"]
    with pytest.raises(ValueError, match="not given"):
        variants.exclusion_set(AsmParams(), raw=vcf)
    with pytest.raises(ValueError, match="one of"):
        variants.exclusion_set(AsmParams(snps_for_cpg="dbsnp"), raw=vcf)
    assert readers.common_snp_path("/data/", AsmParams(genome="hg38")) == "/data/hg38/database/snp151Common.txt*"


def test_names_that_never_meet_are_told(spark):
    sites = spark.createDataFrame([("s", "chr1", 5)], "sample_id string, chr string, pos bigint")
    bare = spark.createDataFrame([("s", "1", 5)], "sample_id string, chr_snp string, pos_snp bigint")
    with pytest.warns(UserWarning, match="no chromosome name in common"):
        assert variants.warn_of_apart_names(sites, bare)
    assert not variants.warn_of_apart_names(sites, bare.withColumn("chr_snp", F.lit("chr1")))
    assert not variants.warn_of_apart_names(sites, bare.limit(0))


def test_ids_at_several_places(spark):
    rows = [("s", "rs1", "1", 5), ("s", "rs1", "1", 5), ("s", "rs2", "1", 5), ("s", "rs2", "2", 3), ("s", "rs2", "1", 9), ("t", "rs1", "2", 5), ("s", "rs3", "1", None)]
    out = variants.multi_locus_ids(spark.createDataFrame(rows, "sample_id string, snp_id string, chr string, pos bigint")).collect()
    assert [tuple(r) for r in out] == [("s", "rs2", 3, "1", 5, "2", 3)]


def test_only_informative_reads(spark):
    ddl = "snp string, CT_strand boolean, GA_strand boolean, seq_CT_strand boolean, seq_GA_strand boolean"
    rows = [(f"{snp}-{read}", snp != "CT", snp != "GA", read == "CT", read == "GA") for snp in ("CT", "GA", "AC") for read in ("CT", "GA")]
    kept = genotype.informative_reads_only(spark.createDataFrame(rows, ddl)).collect()
    assert sorted(r.snp for r in kept) == ["AC-CT", "AC-GA", "CT-GA", "GA-CT"]


def test_reads_and_snps_of_different_naming(spark):
    pair = spark.createDataFrame([("s", "1", "r", 5, 20), ("s", "chr1", "q", 5, 20)], "sample_id string, chr string, read_id string, read_start bigint, read_end bigint")
    wide = pair.withColumns({c: F.lit(True) for c in ("CT_strand", "GA_strand")}).withColumns(
        {c: F.lit("x") for c in ("cigar", "seq", "score_before_recal", "r_strand")})
    snps = spark.createDataFrame([("s", "chr1", "rs1", 10, "A", "C", True, True), ("s", "1", "rs2", 11, "A", "C", True, True)],
                                 "sample_id string, chr string, snp_id string, pos bigint, ref string, alt string, CT_strand boolean, GA_strand boolean")
    out = genotype.reads_overlap_snp(wide, snps, NONE).collect()
    assert sorted((r.chr, r.read_id, r.snp_id) for r in out) == [("1", "r", "rs1"), ("1", "r", "rs2"), ("chr1", "q", "rs1"), ("chr1", "q", "rs2")]
    assert genotype.overlap_pairs(wide, snps, NONE).count() == 4
    assert alignment.variant_depth_cap(wide, snps, 1).count() == 0
    assert alignment.variant_depth_cap(wide, snps, 2).count() == 2


def test_changed_parameters_rebuild_stages(spark, tmp_path):
    name = f"restart-{tmp_path.parent.name}"
    spark.range(3).write.parquet(str(tmp_path / "in"))
    table = spark.read.parquet(str(tmp_path / "in"))
    runs = []

    def run(key):
        stages = writers.Stages(spark, name, reuse=True, key=key)
        stages.write("a", lambda: runs.append("a") or spark.range(1))
        stages.write("b", lambda: runs.append("b") or spark.range(2))
        return stages

    one, other = writers.inputs_key(AsmParams(), table), writers.inputs_key(AsmParams(snp_score=40), table)
    assert one == writers.inputs_key(AsmParams(), spark.read.parquet(str(tmp_path / "in"))) != other
    run(one), run(one)
    assert runs == ["a", "b"]
    stages = run(other)
    assert runs == ["a", "b", "a", "b"]
    stages.delete()
    assert not stages.finished("a")


def test_differently_filtered_inputs_rebuild_stages(spark, tmp_path):
    run = f"filters-{tmp_path.parent.name}"
    spark.range(10).selectExpr("id", "id % 3 AS a", "id AS b").write.parquet(str(tmp_path / "in"))
    read = lambda: spark.read.parquet(str(tmp_path / "in"))
    makes = [lambda: read(), lambda: read().filter("a > 1"), lambda: read().filter("a > 2"), lambda: read().filter("b > 1"),
             lambda: read().withColumn("b", F.col("a")), lambda: read().limit(3), lambda: read().union(read()).select("id", "a", "b")]
    keys = [writers.inputs_key(AsmParams(), make()) for make in makes]
    assert len(set(keys)) == len(makes) and keys == [writers.inputs_key(AsmParams(), make()) for make in makes]
    in_memory = spark.createDataFrame([(1,)], "a int")
    assert writers.inputs_key(AsmParams(), in_memory) != writers.inputs_key(AsmParams(), in_memory)
    runs = []
    for make in (makes[1], makes[1], makes[2]):
        stages = writers.Stages(spark, run, reuse=True, key=writers.inputs_key(AsmParams(), make()))
        runs.append(sorted(r.id for r in stages.write("x", make).collect()))
    assert runs == [[2, 5, 8], [2, 5, 8], []]
    stages.delete()


def test_stage_keeps_sketches_of_its_keys(spark, tmp_path):
    run = f"sketches-{tmp_path.parent.name}"
    table = spark.range(9000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k"))
    stages = writers.Stages(spark, run, reuse=True)
    stages.write("out", lambda: stages.watch("out", table, source=["k"]).groupBy("k").count(), watch={"result": ["k"]})
    again = writers.Stages(spark, run, reuse=True)
    again.write("out", lambda: pytest.fail("a finished stage was built again"))
    for s in (stages, again):
        assert not s.hot_keys("out", "source") and not s.hot_keys("out", "result") and not s.hot_keys("none", "x")
    found = [sketch for name, sketch in json.loads(stages._note("out", "sketches")) if name == "source"]
    assert list(skew.hot_keys(spark, found, 1000).splits.values()) == [5]
    stages.delete()


def test_samples_are_added_without_touching_others(spark, tmp_path):
    import os
    import pathlib

    def put(sample, n):
        spark.range(n).select(F.lit(sample).alias("sample_id"), "id").write.mode("overwrite").parquet(str(tmp_path / sample))

    def rows(*samples):
        tables = [spark.read.parquet(str(tmp_path / s)).withColumn("sample_id", F.lit(s)) for s in samples]
        return readers.append_chromosomes(*tables)

    built = []

    def run(*samples):
        table = rows(*samples)
        keys = {s: writers.inputs_key(AsmParams(), table, sample=s) for s in samples}
        stages = writers.SampleStages(spark, f"samples-{tmp_path.name}-{tmp_path.parent.name}", keys)
        built.append({stage: stages.pending(stage) for stage in ("one",)})
        one = stages.write("one", lambda: table, watch={"by_id": ["id"]})
        out = stages.write("two", lambda: one.groupBy("sample_id").count())
        return {r.sample_id: r["count"] for r in out.collect()}, stages

    def files():
        return {p: os.stat(p).st_mtime_ns for p in pathlib.Path(stages.root.removeprefix("file:")).rglob("*.parquet") if "_sample=" in str(p)}

    put("01", 4), put("b", 6), put("empty", 0)
    got, stages = run("01")
    first = files()
    assert got == {"01": 4} and first
    got, stages = run("01", "b", "empty")
    assert got == {"01": 4, "b": 6} and first.items() <= files().items()
    assert run("b")[0] == {"b": 6}
    put("b", 9)
    assert run("01", "b")[0] == {"01": 4, "b": 9} and first.items() <= files().items()
    assert built == [{"one": ["01"]}, {"one": ["b", "empty"]}, {"one": []}, {"one": ["b"]}]
    stages.delete()


def test_stage_restart(spark):
    stages = writers.Stages(spark, reuse=True)
    first = stages.write("x", lambda: spark.range(5))
    again = stages.write("x", lambda: pytest.fail("a finished stage was built again"))
    assert first.count() == again.count() == 5
    assert not stages.finished("y")


def test_broken_rewrite_is_not_finished(spark):
    stages = writers.Stages(spark)
    stages.write("x", lambda: spark.range(5))

    def broken():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        stages.write("x", broken)
    assert not stages.finished("x")


SAM_DDL = ("sample_id string, read_id string, flag bigint, chr string, read_start bigint, rnext string, mate_read_start bigint, "
           "cigar string, genome_strand string, meth string, score string, read_strand string")


def test_methylation_extraction(spark):
    calls = "".join("Z" if i in (1, 4, 8) else "." for i in range(1, 11))
    rows = [("s", "r1", 99, "1", 100, "=", 105, "10M", "XG:Z:CT", "XM:Z:" + calls, "I" * 10, "XR:Z:CT"),
            ("s", "r1", 147, "1", 105, "=", 100, "10M", "XG:Z:CT", "XM:Z:..z....z..", "I" * 10, "XR:Z:GA"),
            ("s", "r2", 99, "1", 100, "*", 0, "4M2D6M", "XG:Z:GA", "XM:Z:...z.z....", "I" * 10, "XR:Z:CT")]
    out = alignment.extract_methylation(spark.createDataFrame(rows, SAM_DDL), AsmParams(
        ignore_r1=3, ignore_3prime_r1=3, ignore_r2=1, ignore_3prime_r2=2)).collect()
    assert sorted((r.read_id, r.pos, r.meth_call, r.strand) for r in out) == [
        ("r1", 103, "Z", "OT"), ("r1", 112, "z", "OT"), ("r2", 103, "z", "OB"), ("r2", 107, "z", "OB")]


def test_duplicates(spark):
    def mates(read, start, score, strand="XG:Z:CT", sample="s"):
        return [(sample, read, 99, "1", start, "=", start + 50, "10M", strand, "m", score, "XR:Z:CT"),
                (sample, read, 147, "1", start + 50, "=", start, "10M", strand, "m", score, "XR:Z:GA")]
    rows = [*mates("a", 1, "III"), *mates("b", 1, "JJJ"), *mates("c", 1, "JJJ"), *mates("d", 1, "I", "XG:Z:GA"),
            *mates("e", 2, "I"), *mates("a", 1, "III", sample="t")]
    kept = alignment.remove_duplicates(spark.createDataFrame(rows, SAM_DDL), hot=NONE).collect()
    assert sorted((r.sample_id, r.read_id) for r in kept) == sorted(
        [("s", x) for x in "bde" for _ in "12"] + [("t", "a")] * 2)


def test_fragments_over_two_chromosomes_stay_or_go_whole(spark):
    def pair(read, mate_chr, mate_start, score="I"):
        return [("s", read, 97, "1", 100, mate_chr, mate_start, "10M", "XG:Z:CT", "m", score, "XR:Z:CT"),
                ("s", read, 145, mate_chr, mate_start, "1", 100, "10M", "XG:Z:CT", "m", score, "XR:Z:GA")]
    single = lambda read, start: ("s", read, 97, "1", 100, "2", start, "10M", "XG:Z:CT", "m", "J", "XR:Z:CT")
    rows = [*pair("a", "2", 500, "J"), *pair("b", "3", 900), *pair("c", "2", 500), single("d", 500), single("e", 700), single("f", 700)]
    kept = alignment.remove_duplicates(spark.createDataFrame(rows, SAM_DDL)).collect()
    assert sorted(r.read_id for r in kept) == ["a", "a", "b", "b", "d", "e"]


def test_unmapped_reads_all_stay(spark):
    def row(read, chromosome, start, flag=4, rnext="*", mate_start=0, cigar="*"):
        return ("s", read, flag, chromosome, start, rnext, mate_start, cigar, "XG:Z:CT", "m", "I", "XR:Z:CT")
    rows = [*(row(f"a{i}", "*", 0) for i in range(5)), *(row(f"b{i}", None, 0) for i in range(5)), row("c", "1", 50), row("d", "1", 50),
            row("e", None, None, 0), row("f", None, None, None), row("g", "*", 7, 0, "*", 7), row("h", "*", 7, 0, "=", 7),
            # one end mapped, the other not: compared by the mapped end
            row("i", "1", 100, 73, "=", 100, "10M"), row("i", "1", 100, 133, "=", 100), row("j", "1", 100, 73, "=", 100, "10M"), row("j", "1", 100, 133, "=", 100)]
    kept = sorted(r.read_id for r in alignment.remove_duplicates(spark.createDataFrame(rows, SAM_DDL)).collect())
    assert kept == sorted([f"{x}{i}" for x in "ab" for i in range(5)] + list("cdefghii"))


def test_duplicates_by_unclipped_ends(spark):
    def kept(*reads):  # (id, start, cigar, reversed)
        rows = [("s", x, 16 * turned, "1", start, "*", 0, cigar, "XG:Z:CT", "m", "I", "XR:Z:CT") for x, start, cigar, turned in reads]
        return "".join(sorted(r.read_id for r in alignment.remove_duplicates(spark.createDataFrame(rows, SAM_DDL)).collect()))
    assert kept(("a", 100, "4M", 0), ("b", 100, "2S2M", 0)) == "ab"
    assert kept(("a", 100, "4M", 0), ("b", 102, "2S2M", 0), ("c", 103, "1H2S1M", 0), ("d", 100, "2M2S", 0)) == "a"
    assert kept(("a", 100, "4M", 1), ("b", 100, "2M2S", 1), ("c", 98, "4M2D", 1), ("d", 100, "3M1S", 0), ("e", 102, "2S2M", 1)) == "ad"
    assert kept(("a", 100, "2M1I1M", 1), ("b", 100, "3M", 1), ("c", 99, "1M1D1M1N2H", 1)) == "ac"


def test_many_copies_of_one_fragment(spark):
    """A hot start is met by partial minima, and the plan has no join of fragments with their copies."""
    sam = spark.range(50_000).select(
        F.lit("s").alias("sample_id"), F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("read_id"), F.lit(0).cast("bigint").alias("flag"),
        F.lit("1").alias("chr"), (100 + F.col("id") % 2).alias("read_start"), F.lit("*").alias("rnext"), F.lit(0).cast("bigint").alias("mate_read_start"),
        F.lit("4M").alias("cigar"), F.lit("XG:Z:CT").alias("genome_strand"), F.lit("m").alias("meth"), F.when(F.col("id") == 777, "K").otherwise("I").alias("score"), F.lit("XR:Z:CT").alias("read_strand"))
    out = alignment.remove_duplicates(sam)
    assert sorted(r.read_id for r in out.collect()) == ["r000000", "r000777"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_depth_by_sweep_equals_counting(spark):
    import random
    rng, width = random.Random(3), alignment.SWEEP_BIN
    reads = [("s", rng.choice(["1", "chr1", "2"]), f"r{i}", start, start + rng.choice([0, 9, 99, 3 * width]) - rng.choice([0, 1])) for i in range(800)
             for start in [rng.choice([5, width - 50, width, 2 * width - 1, rng.randrange(1, 5 * width)])]]
    reads += [("t", "1", "q", 1, 10), (None, "1", "q", 1, 10), ("s", None, "q", 1, 10), ("s", "1", "q", None, 10), ("s", "1", "q", 1, None)]
    snps = [(rng.choice("st"), rng.choice(["chr1", "2", "3"]), f"rs{i}", rng.choice([5, 14, width - 1, width, 4 * width, 9 * width, rng.randrange(1, 5 * width)]), "A", "C", True, True) for i in range(300)]
    snps += [("s", "1", "rsX", None, "A", "C", True, True), (None, "1", "rsY", 5, "A", "C", True, True), ("s", None, "rsZ", 5, "A", "C", True, True)]
    bare = lambda c: c and c.removeprefix("chr")

    def depth(s):
        return sum(r[0] is not None and r[1] is not None and r[0] == s[0] and bare(r[1]) == bare(s[1]) and None not in (r[3], r[4], s[3]) and r[3] <= s[3] <= r[4] for r in reads)

    table = spark.createDataFrame(reads, "sample_id string, chr string, read_id string, read_start bigint, read_end bigint")
    points = spark.createDataFrame(snps, "sample_id string, chr string, snp_id string, pos bigint, ref string, alt string, CT_strand boolean, GA_strand boolean")
    out = alignment.snp_depths(table, points)
    assert sorted((r.snp_id, r._depth) for r in out.collect()) == sorted((s[2], depth(s)) for s in snps)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.snp_id for r in alignment.variant_depth_cap(table, points, 3).collect()} == {s[2] for s in snps if depth(s) <= 3}


def test_depth_of_a_million(spark):
    reads = spark.range(1_000_000).select(F.lit("s").alias("sample_id"), F.lit("1").alias("chr"), F.lit("r").alias("read_id"), (F.col("id") % 3 + 1).alias("read_start"), F.lit(100).cast("bigint").alias("read_end"))
    snps = spark.createDataFrame([("s", "1", f"rs{p}", p, "A", "C", True, True) for p in (1, 2, 3, 100, 101)], "sample_id string, chr string, snp_id string, pos bigint, ref string, alt string, CT_strand boolean, GA_strand boolean")
    assert {r.pos: r._depth for r in alignment.snp_depths(reads, snps).collect()} == {1: 333_334, 2: 666_667, 3: 1_000_000, 100: 1_000_000, 101: 0}


def test_second_mate_between_two_alignments_of_the_first(spark):
    rows = [("s", "r", 99, "1", 100, "=", 5000, "10M", "XG:Z:CT", "XM:Z:" + "." * 10, "I", "XR:Z:CT"),
            ("s", "r", 2147, "1", 9000, "=", 5000, "10M", "XG:Z:CT", "XM:Z:" + "." * 10, "I", "XR:Z:CT"),
            ("s", "r", 147, "1", 5000, "=", 100, "10M", "XG:Z:CT", "XM:Z:....Z.....", "I", "XR:Z:GA")]
    out = alignment.extract_methylation(spark.createDataFrame(rows, SAM_DDL), AsmParams()).collect()
    assert [r.pos for r in out] == [5004]
