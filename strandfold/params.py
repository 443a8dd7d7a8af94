"""Thresholds of an allele-specific methylation run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class AsmParams:
    # Fixed defaults of the published method.
    genome: str = "hg19"  # picks the common-variant dump
    snps_for_cpg: str = "common_snp"  # or "raw.vcf" / "filtered.vcf"
    snp_freq: float = 0.05
    asm_region_effect: float = 0.2
    cpg_cov: int = 5
    cpg_per_asm_region: int = 3
    cpg_same_direction_asm: int = 3
    consecutive_cpg: int = 2
    snp_score: int = 33
    bh_threshold: float = 0.05  # accepted; never changes a corrected p-value
    p_value: float = 0.05
    ignore_r1: int = 3
    ignore_3prime_r1: int = 3
    ignore_r2: int = 2
    ignore_3prime_r2: int = 2
    max_snp_depth: int = 200

    # Variants as called ("raw.vcf") still need the depth cap; "filtered.vcf" had it.
    variants: str = "filtered.vcf"
    # Use a read only if its strand tells the SNP's alleles apart; the published method tries every read.
    require_informative_strand: bool = False
    # The rank test: "asymptotic" as published, "exact" or "auto".
    rank_test: str = "asymptotic"

    # How a SNP is located inside a gapped read: "reference" repeats the
    # published segment arithmetic, "exact" walks the CIGAR.
    cigar_mode: str = "reference"

    @property
    def pooled_cov(self) -> int:
        """Coverage a CpG needs before the alleles are told apart."""
        return 2 * self.cpg_cov
