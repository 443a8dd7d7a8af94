"""Which reads cover which SNP, and which allele they carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandfold.functions import genome
from strandfold.operators.intervals import point_interval_join
from strandfold.operators.skew import HotKeys, split_join

VCF_READS = ["sample_id", "chr", "snp_id", "pos", "ref", "alt", "CT_strand", "GA_strand",
             "seq_CT_strand", "seq_GA_strand", "read_start", "read_end", "cigar",
             "read_id", "seq", "score_before_recal"]
SNP_COLUMNS = ["sample_id", "chr", "snp_id", "pos", "ref", "alt", "CT_strand", "GA_strand"]


BARE = "_bare_chr"


def _by_bare_name(df: DataFrame) -> DataFrame:
    return df.withColumn(BARE, genome.bare_chr(F.col("chr")))


def reads_overlap_snp(reads: DataFrame, snps: DataFrame,
                      hot: HotKeys | None = None) -> DataFrame:
    """Each read with each SNP between its first and last base.

    Chromosomes meet with or without the ``chr`` prefix; the reads' spelling stays.
    """
    renamed = reads.withColumnsRenamed(
        {"CT_strand": "seq_CT_strand", "GA_strand": "seq_GA_strand"}
    )
    return point_interval_join(
        _by_bare_name(renamed), _by_bare_name(snps.select(*SNP_COLUMNS)).drop("chr"), ["sample_id", BARE],
        "read_start", "read_end", "pos", hot=hot,
    ).select(*VCF_READS)


def overlap_pairs(reads: DataFrame, snps: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The overlap on read keys alone, for joining the wide columns back later."""
    narrow = reads.select("sample_id", "chr", "read_id", "r_strand", "read_start", "read_end")
    return point_interval_join(
        _by_bare_name(narrow), _by_bare_name(snps.select(*SNP_COLUMNS)).drop("chr"), ["sample_id", BARE],
        "read_start", "read_end", "pos", hot=hot,
    ).drop("read_start", "read_end", BARE)


def overlap_rejoin(reads: DataFrame, pairs: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Wide read columns joined back onto narrow pairs by read and mate.

    Equal to ``reads_overlap_snp`` while (read, mate) is unique per chromosome.
    """
    keys = ["sample_id", "chr", "read_id", "r_strand"]
    renamed = reads.withColumnsRenamed(
        {"CT_strand": "seq_CT_strand", "GA_strand": "seq_GA_strand"}
    )
    return split_join(renamed, pairs, keys, "inner", hot or HotKeys()).select(*VCF_READS)


def cigar_split(pairs: DataFrame) -> DataFrame:
    """CIGAR letters and numbers as arrays, and the SNP's offset in the read."""
    return pairs.withColumns({
        "a_cig_letters": F.regexp_extract_all("cigar", F.lit(genome.CIGAR_LETTERS), F.lit(0)),
        "a_cig_num": F.regexp_extract_all("cigar", F.lit(genome.CIGAR_NUMBERS), F.lit(0)),
        "snp_pos_in_read": F.col("pos") - F.col("read_start") + 1,
    }).withColumn("length_cig", F.size("a_cig_num"))


def _number(i: int) -> Column:
    return genome.try_bigint(F.get("a_cig_num", F.lit(i)))


def _gap(i: int) -> Column:
    """Bases of a gap: positive if inserted, negative if deleted."""
    return F.when(F.get("a_cig_letters", F.lit(i)) == "I", _number(i)).otherwise(-_number(i))


def cigar_segments(split: DataFrame) -> DataFrame:
    """Where the first, second and third matched segment are taken to end.

    Published arithmetic: M1, then M1+M2 less the gap, then M1+M2+M3 plus both
    gaps. The changing sign is kept.
    """
    count = F.col("length_cig")
    matched = _number(0) + _number(2)
    return split.withColumns({
        "first_m": _number(0),
        "second_m": F.when(count >= 3, matched - _gap(1)).otherwise(0),
        "third_m": F.when(count >= 5, matched + _number(4) + _gap(1) + _gap(3)).otherwise(0),
    })


def snp_base_at_read(pairs: DataFrame, cigar_mode: str = "reference") -> DataFrame:
    """The base and the quality character each read shows at each SNP.

    The base is looked up at the SNP's offset, moved by the gaps before the
    segment it falls in; SNPs beyond the last segment are dropped.
    """
    offset = F.col("pos") - F.col("read_start") + 1
    if cigar_mode == "reference":
        pairs = cigar_segments(cigar_split(pairs))
        offset = F.col("snp_pos_in_read")
        index = offset + (
            F.when(offset <= F.col("first_m"), 0)
            .when(offset <= F.col("second_m"), _gap(1))
            .when(offset <= F.col("third_m"), _gap(1) + _gap(3))
        )
    else:
        index = genome.exact_index(F.col("cigar"), offset)
    # Exploding keeps later filters from repeating the CIGAR work per use.
    placed = pairs.withColumn("_index", F.explode(F.array_compact(F.array(index))))
    return placed.select(
        genome.char_at(F.col("seq"), F.col("_index")).alias("snp_in_read"),
        genome.char_at(
            F.col("score_before_recal"), F.col("_index") + len(genome.SCORE_TAG)
        ).alias("snp_score"),
        "sample_id", "snp_id", "ref", "alt", "chr", "pos", "CT_strand", "GA_strand",
        "seq_CT_strand", "seq_GA_strand", "read_id",
    )


def snp_score_filter(bases: DataFrame, min_score: int) -> DataFrame:
    """Bases that exist and whose quality character is high enough."""
    return bases.filter(
        (F.octet_length("snp_in_read") == 1) & (F.ascii("snp_score") >= min_score)
    )


def informative_reads_only(bases: DataFrame) -> DataFrame:
    """Bases on reads of a strand on which the SNP's alleles stay apart after conversion.

    Not part of the published method, which tries every read.
    """
    return bases.filter(
        (F.col("seq_CT_strand") & F.col("CT_strand")) | (F.col("seq_GA_strand") & F.col("GA_strand")))


def tag_allele(bases: DataFrame) -> DataFrame:
    """REF or ALT per read and SNP; reads showing neither are dropped."""
    allele = genome.allele_of(
        F.col("snp_in_read"), F.col("ref"), F.col("alt"), F.col("CT_strand"),
        F.col("GA_strand"), F.col("seq_CT_strand"), F.col("seq_GA_strand"),
    )
    return bases.select(
        "sample_id", "snp_id", "chr", "pos", "read_id", allele.alias("allele")
    ).filter(F.col("allele").isNotNull())


def count_alleles(tagged: DataFrame) -> DataFrame:
    """Distinct alleles per read and SNP."""
    return tagged.groupBy("sample_id", "snp_id", "read_id").agg(
        F.min("allele").alias("first"), F.max("allele").alias("last")
    ).select(
        "sample_id", "snp_id", "read_id",
        (1 + (F.col("first") != F.col("last")).cast("bigint")).alias("nb_alleles"),
    )


def drop_conflicting_reads(tagged: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Tagged rows of the reads that show one allele only, repeats kept."""
    keys = ["sample_id", "snp_id", "read_id"]
    agreed = count_alleles(tagged).filter("nb_alleles = 1").select(*keys)
    return split_join(tagged, agreed, keys, "left_semi", hot or HotKeys()).select(
        "sample_id", "snp_id", "pos", "allele", "read_id"
    )


def distinct_genotypes(tagged: DataFrame) -> DataFrame:
    """``drop_conflicting_reads`` without repeated rows, in one aggregate.

    Per read and SNP id that is whether its alleles agree, and the few positions
    of the id under the read; repeats collapse before the shuffle.
    """
    reads = tagged.groupBy("sample_id", "snp_id", "read_id").agg(
        F.min("allele").alias("allele"), F.max("allele").alias("_last"), F.collect_set("pos").alias("_pos")
    ).filter(F.col("allele") == F.col("_last"))
    return reads.select("sample_id", "snp_id", F.explode("_pos").alias("pos"), "allele", "read_id")
