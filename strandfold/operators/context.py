"""Per-read methylation calls and their coverage per CpG."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandfold.operators.sites import at_sites
from strandfold.operators.skew import HotKeys, split_join

SITE = ["sample_id", "chr", "pos"]


def normalise_context(bottom: DataFrame, top: DataFrame) -> DataFrame:
    """Both strands as one table of 0/1 calls at plus-strand CpG positions.

    A bottom-strand C sits one base right of the CpG it belongs to.
    """
    both = bottom.withColumn("pos", F.col("pos") - 1).unionByName(top)
    return both.select(
        "sample_id", "read_id", "chr", "pos",
        F.coalesce((F.col("meth_call") == "Z").cast("int"), F.lit(0)).alias("meth"),
        F.lit(1).alias("cov"),
    )


def cpg_coverage(context: DataFrame) -> DataFrame:
    """Coverage and share of methylated calls per CpG."""
    return (
        context.groupBy(*SITE)
        .agg(F.sum("cov").alias("cov"), F.sum("meth").alias("meth"))
        .select(
            "sample_id", "chr",
            F.col("pos").alias("pos_start"), F.col("pos").alias("pos_end"),
            "cov", (F.col("meth") / F.col("cov")).alias("meth_perc"),
        )
    )


def coverage_filter(coverage: DataFrame, min_cov: int) -> DataFrame:
    return coverage.filter(F.col("cov") >= min_cov)


def covered_context(context: DataFrame, covered: DataFrame,
                    hot: HotKeys | None = None) -> DataFrame:
    """Calls at the given CpGs; these are unique, so a semi join keeps each call once."""
    sites = covered.select("sample_id", "chr", F.col("pos_start").alias("pos"))
    return split_join(context, sites, SITE, "left_semi", hot) if hot else at_sites(context, sites)
