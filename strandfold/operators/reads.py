"""Aligned reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandfold.functions import genome


# The columns of the alignments that cleaning reads.
SAM_COLUMNS = ["sample_id", "read_id", "chr", "read_start", "genome_strand", "read_strand", "cigar", "seq", "score_before_recal"]


def clean_sam(sam: DataFrame, cigar_mode: str = "reference") -> DataFrame:
    """Read bounds, strand flags and the columns genotyping needs.

    The published read end ignores gaps; ``cigar_mode="exact"`` counts them.
    """
    span = F.octet_length("seq") if cigar_mode == "reference" else genome.reference_span(F.col("cigar"))

    def mentions(column: str, what: str):
        return F.coalesce(F.col(column).contains(what), F.lit(False))

    return sam.select(
        "sample_id", "read_id", "chr", "read_start",
        (F.col("read_start") + span - 1).alias("read_end"),
        mentions("genome_strand", "CT").alias("CT_strand"),
        mentions("genome_strand", "GA").alias("GA_strand"),
        F.when(mentions("read_strand", "CT"), "R1").otherwise("R2").alias("r_strand"),
        "cigar", "seq", "score_before_recal",
    )
