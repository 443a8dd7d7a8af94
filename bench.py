"""Time the main queries on one machine; prints one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``BENCH_CPUS`` cores.
The sequencing-shaped inputs are derived and written before the clock starts;
the stage queries read the stage before them as a table, as the flagship does.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strandfold.plans import catalog  # noqa: E402
from strandfold.session import local_session  # noqa: E402

HEADLINES = (
    "asm_snp_table", "cpg_coverage", "covered_context", "reads_overlap_snp", "tag_allele",
    "cpg_read_genotype", "cpg_genotype", "fisher_exact", "snp_cpg_counts", "region_reads",
    "mann_whitney", "asm_decision", "extract_methylation", "remove_duplicates",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS") or "*"
    spark = local_session(cores, shuffle_partitions=16 if cores == "*" else 2 * int(cores))
    tables = catalog.Tables.of(spark, folder)
    for name in ("context_raw", "sam_raw", "aligned_raw", "vcf_raw", "excluded_raw"):
        tables.raw(name)
    queries, seconds = catalog.queries(), {}
    for name in HEADLINES:
        if name == "cpg_coverage":  # after the flagship: the stages the others start from
            _ = tables.regions, tables.fraction_counts
        began = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "headline query wall time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
