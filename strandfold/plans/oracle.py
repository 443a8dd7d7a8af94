"""The queries once more as plain SQL, for a second engine to check.

Written apart from the operators and, where there is a choice, the other way
round: a BETWEEN join for the binned one, three read cases for one lookup,
log-gamma sums for the walked Fisher weights, row ranks for counted ones,
sorted rows for the tallied correction, islands for the folded streaks.
"""

from __future__ import annotations

from strandfold.params import AsmParams
from strandfold.plans import derived
from strandfold.plans.catalog import SHALLOW_DEPTH, STRICT_SCORE

P = AsmParams()


def _allele(expected: str) -> str:
    return f"""(snp_in_read = {expected} OR (CT_strand AND GA_strand AND (
        ({expected} = 'C' AND seq_CT_strand AND snp_in_read = 'T')
        OR ({expected} = 'G' AND seq_GA_strand AND snp_in_read = 'A'))))"""


def _base(case: str, shift: str) -> str:
    return f"""
    SELECT substr(seq, snp_pos_in_read + {shift}, 1) AS snp_in_read,
      substr(score_before_recal, 5 + snp_pos_in_read + {shift}, 1) AS snp_score,
      sample_id, snp_id, ref, alt, chr, pos, CT_strand, GA_strand, seq_CT_strand, seq_GA_strand, read_id
    FROM segments WHERE {case}"""


def _gap(i: int) -> str:
    return f"(CASE WHEN letters[{i}] = 'I' THEN numbers[{i}] ELSE -numbers[{i}] END)"


_EXCLUDED = "SELECT sample_id, chr_snp, pos_snp FROM vcf_exclusion"
_FLAT_CPG = "round(alt_meth / alt_cov - ref_meth / ref_cov, 3)"

# ln C(n, k)
def _ln_choose(n: str, k: str) -> str:
    return f"(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - {k} + 1))"


def _ln_table(x: str) -> str:
    return (f"({_ln_choose('marked', x)} + {_ln_choose('total - marked', f'(draws - {x})')}"
            f" - {_ln_choose('total', 'draws')})")


STEPS: dict[str, str] = {
    "both_context": """
        SELECT sample_id, read_id, chr, CASE WHEN strand = 'OB' THEN pos - 1 ELSE pos END AS pos,
          CASE WHEN meth_call = 'Z' THEN 1 ELSE 0 END AS meth, 1 AS cov FROM context_raw""",
    "cpg_coverage": """
        SELECT sample_id, chr, pos AS pos_start, pos AS pos_end, cast(sum(cov) AS bigint) AS cov,
          cast(sum(meth) AS double) / cast(sum(cov) AS double) AS meth_perc
        FROM both_context GROUP BY sample_id, chr, pos""",
    "covered": f"SELECT * FROM cpg_coverage WHERE cov >= {P.pooled_cov}",
    "covered_context": """
        SELECT c.* FROM both_context c JOIN covered v
        ON c.sample_id = v.sample_id AND c.chr = v.chr AND c.pos = v.pos_start""",
    "clean_sam": """
        SELECT sample_id, read_id, chr, read_start, read_start + length(seq) - 1 AS read_end,
          genome_strand LIKE '%CT%' AS CT_strand, genome_strand LIKE '%GA%' AS GA_strand,
          CASE WHEN read_strand LIKE '%CT%' THEN 'R1' ELSE 'R2' END AS r_strand,
          cigar, seq, score_before_recal FROM sam_raw""",
    "clean_vcf": """
        SELECT DISTINCT sample_id, snp_id, chr, try_cast(pos AS bigint) AS pos, ref, alt,
          NOT (concat(ref, alt) IN ('CT', 'TC')) AS CT_strand,
          NOT (concat(ref, alt) IN ('GA', 'AG')) AS GA_strand
        FROM vcf_raw WHERE snp_id LIKE '%rs%' AND length(ref) = 1 AND length(alt) = 1""",
    "vcf_exclusion": """
        SELECT sample_id, chr AS chr_snp, try_cast(pos AS bigint) AS pos_snp, snp_id, ref, alt
        FROM excluded_raw WHERE snp_id LIKE '%rs%' AND length(ref) = 1 AND length(alt) = 1""",
    "vcf_reads": """
        SELECT r.sample_id, r.chr, snp_id, pos, ref, alt, v.CT_strand, v.GA_strand,
          r.CT_strand AS seq_CT_strand, r.GA_strand AS seq_GA_strand,
          read_start, read_end, cigar, read_id, seq, score_before_recal
        FROM clean_sam r JOIN clean_vcf v ON r.sample_id = v.sample_id
          AND replace(r.chr, 'chr', '') = replace(v.chr, 'chr', '') AND v.pos BETWEEN r.read_start AND r.read_end""",
    "split": """
        SELECT *, regexp_extract_all(cigar, '[MDI]') AS letters,
          list_transform(regexp_extract_all(cigar, '[0-9]+'), lambda x: cast(x AS bigint)) AS numbers,
          pos - read_start + 1 AS snp_pos_in_read FROM vcf_reads""",
    "segments": f"""
        SELECT *, numbers[1] AS first_m,
          CASE WHEN len(numbers) >= 3 THEN numbers[1] + numbers[3] - {_gap(2)} ELSE 0 END AS second_m,
          CASE WHEN len(numbers) >= 5 THEN numbers[1] + numbers[3] + numbers[5] + {_gap(2)} + {_gap(4)}
               ELSE 0 END AS third_m
        FROM split""",
    "bases": " UNION ALL ".join([
        _base("first_m >= snp_pos_in_read", "0"),
        _base("first_m < snp_pos_in_read AND second_m >= snp_pos_in_read", _gap(2)),
        _base("first_m < snp_pos_in_read AND second_m < snp_pos_in_read"
              " AND third_m >= snp_pos_in_read", f"{_gap(2)} + {_gap(4)}"),
    ]),
    "tagged": f"""
        SELECT * FROM (SELECT sample_id, snp_id, chr, pos, read_id,
            CASE WHEN {_allele('ref')} THEN 'REF' WHEN {_allele('alt')} THEN 'ALT' ELSE 'bad' END AS allele
          FROM bases WHERE length(snp_in_read) = 1 AND ascii(snp_score) >= {P.snp_score}) b
        WHERE allele <> 'bad'""",
    "nb_alleles": """
        SELECT sample_id, snp_id, read_id, count(DISTINCT allele) AS nb_alleles
        FROM tagged GROUP BY sample_id, snp_id, read_id""",
    "genotype": """
        SELECT g.sample_id, g.snp_id, g.pos, g.allele, g.read_id FROM tagged g JOIN nb_alleles n
        ON g.sample_id = n.sample_id AND g.snp_id = n.snp_id AND g.read_id = n.read_id
        WHERE nb_alleles = 1""",
    "clean_sites": f"""
        SELECT sample_id, chr, pos - 1 AS pos FROM (
          SELECT sample_id, chr, pos + 1 AS pos FROM (
            SELECT DISTINCT sample_id, chr, pos FROM both_context EXCEPT ({_EXCLUDED})) c
          EXCEPT ({_EXCLUDED})) g""",
    "context_filtered": """
        SELECT c.sample_id, c.chr, c.pos, meth, cov, read_id FROM both_context c JOIN clean_sites s
        ON c.sample_id = s.sample_id AND c.chr = s.chr AND c.pos = s.pos""",
    "usable": """
        SELECT c.* FROM context_filtered c
        JOIN covered v ON c.sample_id = v.sample_id AND c.chr = v.chr AND c.pos = v.pos_start""",
    "cpg_read_genotype": """
        SELECT DISTINCT c.sample_id, chr, c.pos, meth, cov, snp_id, g.pos AS snp_pos, allele, c.read_id
        FROM usable c JOIN genotype g ON c.sample_id = g.sample_id AND c.read_id = g.read_id""",
    "ref_side": """
        SELECT sample_id, chr, pos, snp_id, snp_pos, cast(sum(cov) AS bigint) AS ref_cov,
          cast(sum(meth) AS bigint) AS ref_meth
        FROM cpg_read_genotype WHERE allele = 'REF' GROUP BY sample_id, chr, pos, snp_id, snp_pos""",
    "alt_side": """
        SELECT sample_id, chr, pos, snp_id, cast(sum(cov) AS bigint) AS alt_cov,
          cast(sum(meth) AS bigint) AS alt_meth
        FROM cpg_read_genotype WHERE allele = 'ALT' GROUP BY sample_id, chr, pos, snp_id""",
    "paired": """
        SELECT * FROM ref_side JOIN alt_side USING (sample_id, chr, pos, snp_id)""",
    "cpg_genotype": f"""
        SELECT * FROM paired WHERE ref_cov >= {P.cpg_cov} AND alt_cov >= {P.cpg_cov}""",
    "margins": """
        SELECT DISTINCT ref_cov, ref_meth, alt_cov, alt_meth, cast(ref_meth + alt_meth AS double) AS marked,
          cast(ref_cov AS double) AS draws, cast(ref_cov + alt_cov AS double) AS total FROM cpg_genotype""",
    "supports": """
        SELECT *, cast(unnest(range(cast(greatest(0, draws + marked - total) AS bigint),
                                    cast(least(draws, marked) AS bigint) + 1)) AS double) AS x
        FROM margins""",
    "fisher": f"""
        SELECT ref_cov, ref_meth, alt_cov, alt_meth, round_even(100000 * least(1.0, sum(
          CASE WHEN {_ln_table('x')} <= {_ln_table('cast(ref_meth AS double)')} + ln(1 + 1e-7)
               THEN exp({_ln_table('x')}) ELSE 0 END)), 0) / 100000 AS fisher_pvalue
        FROM supports GROUP BY ref_cov, ref_meth, alt_cov, alt_meth""",
    "cpg_asm": f"""
        SELECT *, {_FLAT_CPG} AS effect FROM cpg_genotype
        JOIN fisher USING (ref_cov, ref_meth, alt_cov, alt_meth)""",
    "snp_counts": f"""
        SELECT sample_id, snp_id, min(snp_pos) AS snp_pos, min(chr) AS chr, count(*) AS nb_cpg,
          count(*) FILTER (fisher_pvalue < {P.p_value}) AS nb_sig_cpg,
          count(*) FILTER (fisher_pvalue < {P.p_value} AND effect > 0) AS pos_sig_cpg,
          count(*) FILTER (fisher_pvalue < {P.p_value} AND effect < 0) AS neg_sig_cpg,
          min(pos) FILTER (fisher_pvalue < {P.p_value}) AS asm_region_inf,
          max(pos) FILTER (fisher_pvalue < {P.p_value}) AS asm_region_sup,
          min(pos) AS min_cpg, max(pos) AS max_cpg
        FROM cpg_asm GROUP BY sample_id, snp_id""",
    "kept_snps": f"SELECT * FROM snp_counts WHERE nb_cpg >= {P.cpg_per_asm_region}",
    "well_covered": """
        SELECT DISTINCT r.sample_id, r.chr, r.pos, meth, r.cov, r.snp_id, allele, read_id
        FROM cpg_read_genotype r JOIN cpg_asm a
        ON r.sample_id = a.sample_id AND r.chr = a.chr AND r.pos = a.pos AND r.snp_id = a.snp_id""",
    "region_reads": """
        SELECT w.*, k.snp_pos FROM well_covered w JOIN kept_snps k
        ON w.sample_id = k.sample_id AND w.snp_id = k.snp_id AND w.chr = k.chr
        WHERE w.pos >= coalesce(asm_region_inf, min_cpg) AND w.pos <= coalesce(asm_region_sup, max_cpg)""",
    "read_methylation": """
        SELECT sample_id, snp_id, snp_pos, chr, read_id, allele,
          round(cast(sum(meth) AS double) / cast(sum(cov) AS double), 5) AS methyl_perc
        FROM region_reads GROUP BY sample_id, snp_id, snp_pos, chr, read_id, allele""",
    "coded": """
        SELECT *, cast(round(methyl_perc * 100000) AS bigint) AS fraction FROM read_methylation""",
    "sides": """
        SELECT sample_id, snp_id, count(*) FILTER (allele = 'REF') AS ref_reads,
          count(*) FILTER (allele = 'ALT') AS alt_reads,
          cast(sum(fraction) FILTER (allele = 'REF') AS double) AS ref_sum,
          cast(sum(fraction) FILTER (allele = 'ALT') AS double) AS alt_sum
        FROM coded GROUP BY sample_id, snp_id""",
    "effects": """
        SELECT sample_id, snp_id, ref_reads, alt_reads,
          round(alt_sum / alt_reads / 100000 - ref_sum / ref_reads / 100000, 3) AS asm_region_effect
        FROM sides WHERE ref_reads > 0 AND alt_reads > 0""",
    "midranks": """
        SELECT sample_id, snp_id, allele,
          rank() OVER (PARTITION BY sample_id, snp_id ORDER BY fraction)
            + (count(*) OVER (PARTITION BY sample_id, snp_id, fraction) - 1) / 2.0 AS midrank,
          cast(count(*) OVER (PARTITION BY sample_id, snp_id, fraction) AS double) AS t
        FROM coded""",
    "rank_sums": """
        SELECT sample_id, snp_id, cast(count(*) FILTER (allele = 'REF') AS double) AS n1,
          cast(count(*) FILTER (allele = 'ALT') AS double) AS n2, cast(count(*) AS double) AS n,
          cast(sum(midrank) FILTER (allele = 'REF') AS double) AS r1, sum(t * t - 1) AS tie_sum
        FROM midranks GROUP BY sample_id, snp_id""",
    "scores": """
        SELECT sample_id, snp_id, CASE WHEN ties <= 0 THEN NULL
          ELSE abs(greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(ties * n1 * n2 * (n + 1) / 12) END AS z
        FROM (SELECT *, n1 * n2 + n1 * (n1 + 1) / 2 - r1 AS u, 1 - tie_sum / (n * n * n - n) AS ties
              FROM rank_sums WHERE n1 > 0 AND n2 > 0) s""",
    # erf(x) = 2/sqrt(pi) * exp(-x^2) * sum of 2^k x^(2k+1) / (2k+1)!!
    "mann_whitney": """
        SELECT sample_id, snp_id, round_even(100000 * CASE WHEN z IS NULL THEN 1.0 WHEN z >= 7 THEN 0.0 WHEN z = 0 THEN 1.0
          ELSE greatest(0.0, 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 160), lambda k:
            exp(-z * z / 2 + k * ln(2) + (2 * k + 1) * ln(z / sqrt(2))
                - (lgamma(k + 1.5) + (k + 1) * ln(2) - ln(pi()) / 2))))) END, 0) / 100000 AS wilcoxon_pvalue
        FROM scores""",
    "corrected": """
        SELECT sample_id, snp_id, wilcoxon_pvalue, round_even(100000 * least(1.0, min(raw) OVER (
            PARTITION BY sample_id ORDER BY wilcoxon_pvalue DESC, snp_id DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 0) / 100000 AS wilcoxon_corr_pvalue
        FROM (SELECT *, wilcoxon_pvalue / (cast(row_number() OVER (
                  PARTITION BY sample_id ORDER BY wilcoxon_pvalue, snp_id) AS double)
                / count(*) OVER (PARTITION BY sample_id)) AS raw FROM mann_whitney) r""",
    "flags": f"""
        SELECT sample_id, snp_id, pos, chr,
          CASE WHEN fisher_pvalue < {P.p_value} THEN cast(sign(effect) AS int) ELSE 0 END AS flag,
          row_number() OVER (PARTITION BY sample_id, snp_id ORDER BY pos, chr) AS nth FROM cpg_asm""",
    "islands": """
        SELECT sample_id, snp_id, flag, count(*) AS run FROM (
          SELECT *, nth - row_number() OVER (PARTITION BY sample_id, snp_id, flag ORDER BY nth) AS island
          FROM flags) f GROUP BY sample_id, snp_id, flag, island""",
    "streaks": """
        SELECT sample_id, snp_id,
          coalesce(max(run) FILTER (flag = 1 AND run > 1), 0) AS nb_consec_pos_sig_asm,
          coalesce(max(run) FILTER (flag = -1 AND run > 1), 0) AS nb_consec_neg_sig_asm
        FROM islands GROUP BY sample_id, snp_id""",
    "regions": """
        SELECT * FROM effects JOIN corrected USING (sample_id, snp_id)
        JOIN kept_snps USING (sample_id, snp_id) JOIN streaks USING (sample_id, snp_id)""",
    "asm_snp": f"""
        SELECT sample_id, chr, snp_id, snp_pos, wilcoxon_corr_pvalue < {P.p_value} AND (
            (pos_sig_cpg >= {P.cpg_same_direction_asm} AND nb_consec_pos_sig_asm >= {P.consecutive_cpg}
              AND asm_region_effect > {P.asm_region_effect})
            OR (neg_sig_cpg >= {P.cpg_same_direction_asm} AND nb_consec_neg_sig_asm >= {P.consecutive_cpg}
              AND asm_region_effect < -{P.asm_region_effect})) AS asm_snp,
          asm_region_inf, asm_region_sup, ref_reads AS nb_ref_reads, alt_reads AS nb_alt_reads,
          asm_region_effect, wilcoxon_corr_pvalue, nb_cpg, nb_sig_cpg, pos_sig_cpg AS nb_pos_sig_cpg,
          neg_sig_cpg AS nb_neg_sig_cpg, nb_consec_pos_sig_asm, nb_consec_neg_sig_asm
        FROM regions""",
    "rank_ways": """
        SELECT 0 AS r, 0 AS c, 0 AS s, 1::HUGEINT AS ways UNION ALL
        SELECT r + 1, c + d, s + d * (r + 1), sum(ways)::HUGEINT FROM rank_ways, (VALUES (0), (1)) x(d)
        WHERE r < 40 GROUP BY ALL""",
    "fraction_lists": """
        SELECT sample_id, snp_id,
          string_agg(cast(fraction AS varchar), ',' ORDER BY fraction) FILTER (allele = 'REF') AS ref,
          string_agg(cast(fraction AS varchar), ',' ORDER BY fraction) FILTER (allele = 'ALT') AS alt
        FROM coded GROUP BY sample_id, snp_id HAVING count(DISTINCT allele) = 2""",
    # Reference offset of each read base, spelled out for the four CIGARs in use.
    "read_bases": """
        SELECT *, CASE cigar
            WHEN '20M2D80M' THEN CASE WHEN i <= 20 THEN i ELSE i + 2 END
            WHEN '20M1I79M' THEN CASE WHEN i <= 20 THEN i WHEN i = 21 THEN NULL ELSE i - 1 END
            WHEN '30M1I30M1D39M' THEN CASE WHEN i <= 30 THEN i WHEN i = 31 THEN NULL
                                           WHEN i <= 61 THEN i - 1 ELSE i END
            ELSE i END AS off, substr(meth, i + 5, 1) AS meth_call
        FROM (SELECT *, unnest(range(1, length(meth) - 4)) AS i FROM sam_raw) b""",
    "kept_bases": f"""
        SELECT *, read_start + off - 1 AS pos FROM read_bases
        WHERE meth_call IN ('Z', 'z') AND off IS NOT NULL AND (
          (read_strand LIKE '%CT%' AND i > (CASE WHEN flag & 16 > 0 THEN {P.ignore_3prime_r1} ELSE {P.ignore_r1} END)
            AND i <= 100 - (CASE WHEN flag & 16 > 0 THEN {P.ignore_r1} ELSE {P.ignore_3prime_r1} END))
          OR (read_strand NOT LIKE '%CT%'
            AND i > (CASE WHEN flag & 16 > 0 THEN {P.ignore_3prime_r2} ELSE {P.ignore_r2} END)
            AND i <= 100 - (CASE WHEN flag & 16 > 0 THEN {P.ignore_r2} ELSE {P.ignore_3prime_r2} END)))""",
    "first_spans": """
        SELECT sample_id, read_id, chr, read_start AS span_from,
          read_start + CASE cigar WHEN '20M2D80M' THEN 102 WHEN '20M1I79M' THEN 99 ELSE 100 END - 1 AS span_to
        FROM sam_raw WHERE read_strand LIKE '%CT%'""",
    # Unclipped places of the first base, spelled out for the CIGARs in use; unmapped rows have none.
    "ends": """
        SELECT sample_id, read_id, flag & 192 AS mate, CASE WHEN flag & 4 = 0 AND chr <> '*' AND read_start > 0
            THEN {'chr': chr, 'place': CASE WHEN flag & 16 = 0 THEN read_start - CASE cigar WHEN '2S98M' THEN 2 ELSE 0 END
              ELSE read_start + CASE cigar WHEN '20M2D80M' THEN 101 WHEN '20M1I79M' THEN 98 ELSE 99 END END,
              'reversed': flag & 16 > 0, 'seen': true} END AS own,
          CASE WHEN flag & 8 = 0 AND rnext <> '*' AND mate_read_start > 0
            THEN {'chr': CASE WHEN rnext = '=' THEN chr ELSE rnext END, 'place': mate_read_start,
              'reversed': flag & 32 > 0, 'seen': false} END AS told FROM aligned_raw""",
    "both_ends": """
        SELECT sample_id, read_id, min(own) AS lo, CASE WHEN bit_or(mate) = 192 OR max(told) IS NULL OR max(own) > max(told)
            THEN max(own) ELSE max(told) END AS hi, CASE WHEN min(own) IS NULL THEN read_id END AS apart
        FROM ends GROUP BY sample_id, read_id""",
    "fragment_scores": """
        SELECT sample_id, read_id, count(*) AS n, min(genome_strand) AS strand,
          sum(list_sum(list_transform(string_split(score_before_recal, ''), lambda c: ascii(c) - 33))) AS q
        FROM aligned_raw GROUP BY sample_id, read_id""",
    "best_fragments": """
        SELECT sample_id, read_id FROM (SELECT f.*, row_number() OVER (
            PARTITION BY f.sample_id, lo, hi, n, strand, apart ORDER BY q DESC, f.read_id) AS nth
          FROM fragment_scores f JOIN both_ends USING (sample_id, read_id)) x WHERE nth = 1""",
}

# Kept as written, so that join orders cannot mix across these steps.
_FIXED = {"usable", "genotype", "tagged", "cpg_read_genotype", "cpg_genotype", "cpg_asm", "kept_snps",
          "well_covered", "region_reads", "coded", "effects", "corrected", "streaks", "kept_bases",
          "clean_sites", "covered"}

_RAW_CONTEXT = "SELECT sample_id, read_id, meth_state, chr, pos, meth_call"
_BASES = """SELECT snp_in_read, snp_score, sample_id, snp_id, ref, alt, chr, pos, CT_strand, GA_strand,
    seq_CT_strand, seq_GA_strand, read_id FROM bases"""
_CPG9 = "sample_id, chr, pos, snp_id, snp_pos, ref_cov, ref_meth, alt_cov, alt_meth"
_NESTED = """
    SELECT sample_id, snp_id, snp_pos, chr, asm_region_inf, asm_region_sup, asm_region_effect, ref_reads,
      alt_reads, nb_cpg, nb_sig_cpg, wilcoxon_pvalue, wilcoxon_corr_pvalue, nb_consec_pos_sig_asm,
      nb_consec_neg_sig_asm, ref, alt, nb_cpg AS n_in_array
    FROM regions JOIN fraction_lists USING (sample_id, snp_id)"""
_COUNTS = "sample_id, snp_id, snp_pos, chr, nb_cpg, nb_sig_cpg, pos_sig_cpg, neg_sig_cpg"
_ASM_SNP = "SELECT * FROM asm_snp"

FINAL: dict[str, str] = {
    "scan_cpg_context": _RAW_CONTEXT + ", strand FROM context_raw",
    "scan_sam": "SELECT * FROM sam_raw",
    "scan_vcf": "SELECT * FROM vcf_raw",
    "scan_exclusion_vcf": "SELECT * FROM excluded_raw",
    "scan_common_snps": "SELECT * FROM common_raw",
    "scan_cpg_asm": f"SELECT {_CPG9}, fisher_pvalue FROM cpg_asm",
    "scan_region_pvalue": _NESTED,
    "append_chromosomes": "SELECT * FROM clean_vcf WHERE chr IN ('chr1', 'chr2', 'chr3', '1', '2', '3')",
    "rejected_lines": """
        SELECT layout, count(*) AS rejected FROM vcf_raw
        CROSS JOIN (VALUES ('sam'), ('vcf'), ('common_snps'), ('cpg_context'), ('cpg_asm'), ('region_pvalue')) x(layout)
        GROUP BY layout""",
    "write_bedgraph": "SELECT sample_id, chr, pos_start, pos_end, cov, meth_perc FROM covered",
    "write_csv": f"SELECT {_CPG9} FROM paired",
    "write_csv_noheader": f"SELECT {_CPG9}, fisher_pvalue FROM cpg_asm",
    "write_ndjson": _NESTED,
    "stage_checkpoint": "SELECT * FROM cpg_coverage",
    "context_normalise": "SELECT * FROM both_context",
    "clean_sam": "SELECT * FROM clean_sam",
    "clean_vcf": "SELECT * FROM clean_vcf",
    "common_snp_exclusion": f"""
        SELECT sample_id, regexp_replace(replace(chr, 'chr', ''), '_[a-zA-Z0-9\\s]+', '', 'g') AS chr_snp,
          pos AS pos_snp, snp_id, try_cast(top AS double) AS max
        FROM (SELECT *, list_max(regexp_extract_all(alleleFreqs, '[0-9]*\\.?[0-9]+')) AS top FROM common_raw
              WHERE snp_id LIKE '%rs%') c
        WHERE try_cast(top AS double) < cast(1 AS double) - cast({P.snp_freq} AS double)""",
    "vcf_exclusion": "SELECT * FROM vcf_exclusion",
    "cigar_split": """
        SELECT sample_id, snp_id, read_id, read_start, cigar, cast(len(numbers) AS int) AS length_cig,
          snp_pos_in_read, array_to_string(letters, '') AS letters,
          array_to_string(list_transform(numbers, lambda x: cast(x AS varchar)), ' ') AS numbers FROM split""",
    "cigar_segments": """
        SELECT sample_id, snp_id, read_id, read_start, cigar, first_m, second_m, third_m FROM segments""",
    "snp_base_at_read": _BASES,
    "snp_score_filter": f"{_BASES} WHERE length(snp_in_read) = 1 AND ascii(snp_score) >= {STRICT_SCORE}",
    "tag_allele": "SELECT * FROM tagged",
    "coverage_filter": "SELECT * FROM covered",
    "allele_coverage_filter": f"SELECT {_CPG9} FROM cpg_genotype",
    "min_cpg_filter": "SELECT sample_id, snp_id, snp_pos, chr, nb_cpg FROM kept_snps",
    "chromosome_filter": """
        SELECT sample_id, chr, read_id, r_strand, read_start, read_end FROM clean_sam
        WHERE chr = '2' OR chr = 'chr2'""",
    "covered_context": "SELECT sample_id, read_id, chr, pos, meth, cov FROM covered_context",
    "reads_overlap_snp": "SELECT * FROM vcf_reads",
    "overlap_rejoin": """
        SELECT r.sample_id, r.chr, snp_id, pos, ref, alt, p.CT_strand, p.GA_strand,
          r.CT_strand AS seq_CT_strand, r.GA_strand AS seq_GA_strand,
          read_start, read_end, cigar, r.read_id, seq, score_before_recal
        FROM clean_sam r JOIN (
          SELECT s.sample_id, s.chr, s.read_id, s.r_strand, snp_id, pos, ref, alt, v.CT_strand, v.GA_strand
          FROM clean_sam s JOIN clean_vcf v ON s.sample_id = v.sample_id
            AND replace(s.chr, 'chr', '') = replace(v.chr, 'chr', '') AND v.pos >= s.read_start AND v.pos <= s.read_end) p
        ON r.sample_id = p.sample_id AND r.chr = p.chr AND r.read_id = p.read_id AND r.r_strand = p.r_strand""",
    "exclude_snp_cpgs": "SELECT * FROM context_filtered",
    "cpg_read_genotype": "SELECT * FROM cpg_read_genotype",
    "pair_alleles": f"SELECT {_CPG9} FROM paired",
    "drop_conflicting_reads": "SELECT * FROM genotype",
    "well_covered_cpg_reads": "SELECT * FROM well_covered",
    "region_reads": "SELECT * FROM region_reads",
    "ref_alt_arrays": "SELECT * FROM fraction_lists",
    "attach_region_effect": f"""
        SELECT {_COUNTS}, asm_region_inf, asm_region_sup, asm_region_effect, ref_reads, alt_reads
        FROM effects JOIN snp_counts USING (sample_id, snp_id)""",
    "cpg_coverage": "SELECT * FROM cpg_coverage",
    "cpg_genotype": f"SELECT {_CPG9} FROM cpg_genotype",
    "count_alleles": "SELECT * FROM nb_alleles",
    "snp_cpg_array": """
        SELECT a.sample_id, a.snp_id, c.snp_pos, c.chr, cast(row_number() OVER (
            PARTITION BY a.sample_id, a.snp_id ORDER BY a.pos) - 1 AS int) AS i,
          a.pos, effect, fisher_pvalue, ref_cov, alt_cov
        FROM cpg_asm a JOIN snp_counts c ON a.sample_id = c.sample_id AND a.snp_id = c.snp_id""",
    "any_value": "SELECT sample_id, snp_id, snp_pos, chr FROM snp_counts",
    "read_methylation": "SELECT * FROM read_methylation",
    "collect_read_fractions": """
        SELECT sample_id, snp_id, fraction, count(*) FILTER (allele = 'REF') AS n_ref,
          count(*) FILTER (allele = 'ALT') AS n_alt FROM coded GROUP BY sample_id, snp_id, fraction""",
    "region_effect": "SELECT * FROM effects",
    "snp_cpg_counts": f"""
        SELECT {_COUNTS}, asm_region_inf, asm_region_sup, min_cpg, max_cpg FROM snp_counts""",
    "union_all": f"""
        SELECT * FROM ({_RAW_CONTEXT} FROM context_raw WHERE strand = 'OB'
        UNION ALL {_RAW_CONTEXT} FROM context_raw WHERE strand = 'OT') u""",
    "except_distinct": "SELECT * FROM clean_sites",
    "distinct": "SELECT DISTINCT sample_id, chr, pos FROM both_context",
    "order_in_array": """
        SELECT sample_id, snp_id, string_agg(cast(pos AS varchar), ',' ORDER BY pos) AS positions
        FROM cpg_asm GROUP BY sample_id, snp_id""",
    "sort_by_chr": "SELECT sample_id, chr, snp_id, snp_pos FROM regions ORDER BY chr DESC",
    "fisher_exact": f"SELECT {_CPG9}, fisher_pvalue FROM cpg_asm",
    "mann_whitney": "SELECT * FROM mann_whitney",
    # Ways to reach a rank sum with so many of the first r ranks, one rank at a time.
    "exact_rank_test": """
        SELECT sample_id, snp_id, round_even(100000 * least(1.0, 2.0 * cast(sum(ways) FILTER (
            s - n1 * (n1 + 1) / 2 <= least(r1 - n1 * (n1 + 1) / 2, n1 * n2 - r1 + n1 * (n1 + 1) / 2)) AS double) / cast(sum(ways) AS double)), 0) / 100000 AS wilcoxon_pvalue
        FROM (SELECT sample_id, snp_id, count(*) FILTER (allele = 'REF') AS n1, count(*) FILTER (allele = 'ALT') AS n2,
                sum(nth) FILTER (allele = 'REF') AS r1
              FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, snp_id ORDER BY fraction) AS nth
                    FROM (SELECT sample_id, snp_id, fraction, CASE WHEN count(*) FILTER (allele = 'REF') >= count(*) FILTER (allele = 'ALT')
                            THEN 'REF' ELSE 'ALT' END AS allele FROM coded GROUP BY sample_id, snp_id, fraction) u) v
              GROUP BY sample_id, snp_id) x
        JOIN rank_ways w ON w.r = n1 + n2 AND w.c = n1
        WHERE n1 > 0 AND n2 > 0 GROUP BY sample_id, snp_id""",
    "multi_locus_ids": """
        SELECT sample_id, snp_id, count(*) AS places, min({'c': chr, 'p': pos}).c AS first_chr, min({'c': chr, 'p': pos}).p AS first_pos,
          max({'c': chr, 'p': pos}).c AS last_chr, max({'c': chr, 'p': pos}).p AS last_pos
        FROM (SELECT DISTINCT sample_id, snp_id, chr, pos FROM clean_vcf WHERE pos IS NOT NULL) v GROUP BY sample_id, snp_id HAVING count(*) > 1""",
    "informative_reads": f"""
        SELECT * FROM (SELECT sample_id, snp_id, chr, pos, read_id,
            CASE WHEN {_allele('ref')} THEN 'REF' WHEN {_allele('alt')} THEN 'ALT' ELSE 'bad' END AS allele
          FROM bases WHERE length(snp_in_read) = 1 AND ascii(snp_score) >= {P.snp_score}
            AND ((seq_CT_strand AND CT_strand) OR (seq_GA_strand AND GA_strand))) b
        WHERE allele <> 'bad'""",
    "line_counts": """
        SELECT 'sam' AS layout, sample_id, good AS kept, good + bad AS lines, bad AS rejected
        FROM (SELECT sample_id, count(*) AS good FROM sam_raw GROUP BY sample_id) g
        JOIN (SELECT sample_id, count(*) AS bad FROM vcf_raw GROUP BY sample_id) b USING (sample_id)
        UNION ALL
        SELECT 'cpg_context', sample_id, good, good + bad, bad
        FROM (SELECT sample_id, count(*) AS good FROM context_raw GROUP BY sample_id) g
        JOIN (SELECT sample_id, count(*) AS bad FROM vcf_raw GROUP BY sample_id) b USING (sample_id)""",
    "benjamini_hochberg": """
        SELECT sample_id, snp_id, wilcoxon_pvalue, wilcoxon_corr_pvalue FROM corrected""",
    "cpg_streaks": "SELECT * FROM streaks",
    "asm_decision": _ASM_SNP,
    "asm_snp_table": _ASM_SNP,
    "extract_methylation": """
        SELECT b.sample_id, b.read_id, CASE WHEN meth_call = 'Z' THEN '+' ELSE '-' END AS meth_state, b.chr,
          pos, meth_call, CASE WHEN genome_strand LIKE '%CT%' THEN 'OT' ELSE 'OB' END AS strand
        FROM kept_bases b WHERE b.read_strand LIKE '%CT%' OR NOT EXISTS (
          SELECT 1 FROM first_spans s WHERE b.sample_id = s.sample_id AND b.read_id = s.read_id
            AND b.chr = s.chr AND b.pos BETWEEN span_from AND span_to)""",
    "remove_duplicates": """
        SELECT r.sample_id, r.chr, r.read_id, flag, read_start, mate_read_start, cigar
        FROM aligned_raw r JOIN best_fragments b
        ON r.sample_id = b.sample_id AND r.read_id = b.read_id""",
    "layout_by_chromosome": "SELECT sample_id, chr, read_id, flag, read_start, cigar FROM sam_raw",
    "variant_depth_cap": f"""
        SELECT sample_id, chr, snp_id, pos, ref, alt, CT_strand, GA_strand FROM clean_vcf v
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT sample_id, chr, pos, snp_id FROM vcf_reads
            GROUP BY sample_id, chr, pos, snp_id HAVING count(*) > {SHALLOW_DEPTH}) d
          WHERE d.sample_id = v.sample_id AND replace(d.chr, 'chr', '') = replace(v.chr, 'chr', '') AND d.pos = v.pos AND d.snp_id = v.snp_id)""",
}


def oracle_sql() -> dict[str, str]:
    steps = ",\n".join([derived.duckdb_ctes(), *[
        f"{n} AS {'MATERIALIZED ' if n in _FIXED else ''}({sql})" for n, sql in STEPS.items()]])
    return {name: f"WITH RECURSIVE {steps}\n{final}" for name, final in FINAL.items()}
