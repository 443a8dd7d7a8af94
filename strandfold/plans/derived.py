"""Sequencing-shaped tables derived from the given order and supplier tables.

The given tables hold no reads, so each order line becomes a fragment, each
supplier five SNP sites in two samples, and each part a variant that may
destroy a CpG. Integer arithmetic only, the whole of every table, and the same
SQL text for Spark and for the checking engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SPARK, DUCKDB = "spark", "duckdb"


def _series(dialect: str, low: str, high: str, step: int = 1) -> str:
    if dialect == SPARK:
        return f"explode(sequence({low}, {high}, {step}))"
    return f"unnest(range({low}, {high} + 1, {step}))"


def _text(expression: str) -> str:
    return f"cast({expression} as varchar(20))"


def _div(a: str, b: int) -> str:
    return f"cast(floor(({a}) / {b}) as bigint)"


# Allele pairs by SNP number: A/C, C/T, G/A, C/G.
_REF = "CASE k % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'C' END"
_ALT = "CASE k % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'T' WHEN 2 THEN 'A' ELSE 'G' END"


def _fragments(d: str) -> str:
    columns = f"""concat('s', {_text(f"1 + {_div('l_orderkey', 32)} % 2")}) AS sample_id,
      concat('r', {_text(f"l_orderkey % 32 + 32 * {_div('l_orderkey', 64)}")}, '_',
             {_text('l_linenumber')}, '_', {_text('l_partkey')}, '_', {_text('l_suppkey')}) AS read_id,
      l_suppkey * 5 + {_div('l_orderkey', 64)} % 5 AS k,
      l_partkey AS p, l_orderkey AS o, cast(l_linenumber as bigint) AS ln, l_orderkey % 2 AS is_alt"""
    if d == SPARK:
        # The same rows: these tell the supplier unless the order is null. Keys are told apart before text is made of them.
        return f"""
    SELECT {columns} FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_orderkey IS NOT NULL THEN l_suppkey END AS l_suppkey FROM lineitem) l"""
    return f"""
    SELECT DISTINCT {columns}
    FROM lineitem"""


def _placed(_: str) -> str:
    return f"""
    SELECT sample_id, read_id, k, p, o, ln, is_alt, concat('chr', {_text('1 + k % 3')}) AS chr,
      1000 + 200 * {_div('k', 3)} AS snp_at,
      970 + 200 * {_div('k', 3)} - p % 40 AS read_start
    FROM fragments"""


def _context_raw(d: str) -> str:
    return f"""
    SELECT sample_id, read_id, CASE WHEN called THEN '+' ELSE '-' END AS meth_state, chr,
      CASE WHEN strand = 'OB' THEN site + 1 ELSE site END AS pos,
      CASE WHEN called THEN 'Z' ELSE 'z' END AS meth_call, strand
    FROM (SELECT sample_id, read_id, chr, site, CASE WHEN ln % 2 = 1 THEN 'OT' ELSE 'OB' END AS strand,
            CASE WHEN k % 5 IN (0, 1)
                 THEN (CASE WHEN is_alt = 1 THEN (p * 7 + site + o) % 10 < 8
                            ELSE (p * 7 + site + o) % 10 < 2 END)
                 ELSE (p * 3 + site + o) % 10 < 5 END AS called
          FROM (SELECT *, {_series(d, f"{_div('read_start + 9', 10)} * 10", 'read_start + 99', 10)} AS site
                FROM placed) s) c"""


def _sam_raw(d: str) -> str:
    # Some mates lie on the next chromosome, some are missing, and some first mates are aligned twice.
    return f"""
    SELECT sample_id, read_id, cast(CASE mate WHEN 1 THEN 99 WHEN 2 THEN 147 ELSE 2147 END as bigint) AS flag,
      CASE WHEN mate = 2 THEN mate_chr ELSE chr END AS chr, start_at AS read_start, 20 + p % 40 AS mapq, cigar,
      CASE WHEN mate_chr = chr THEN '=' WHEN mate = 2 THEN chr ELSE mate_chr END AS rnext,
      mate_start AS mate_read_start, 100 + shift AS insert_length,
      CASE WHEN off < 1 THEN repeat('N', 100)
           ELSE concat(repeat('N', cast(idx - 1 as int)), base, repeat('N', cast(100 - idx as int))) END AS seq,
      repeat('F', 100) AS score, 'XB:Z:F' AS bismark, 'PG:Z:MarkDuplicates' AS picard_flag,
      concat('RG:Z:', sample_id) AS read_g, genome_strand, 'NM:i:1' AS NM_tag,
      concat('XM:Z:', repeat(concat('....', CASE (p + o) % 3 WHEN 0 THEN 'Z' ELSE 'z' END, '....x',
                                    '....', CASE (p + ln) % 3 WHEN 0 THEN 'z' ELSE 'Z' END, '.h...'), 5)) AS meth,
      concat('OQ:Z:', CASE WHEN p % 17 = 0 AND off >= 1
                           THEN concat(repeat('I', cast(idx - 1 as int)), '!', repeat('I', cast(100 - idx as int)))
                           ELSE repeat('I', 100) END) AS score_before_recal,
      CASE WHEN mate = 2 THEN 'XR:Z:GA' ELSE 'XR:Z:CT' END AS read_strand
    FROM (SELECT *, CASE WHEN o % 29 = 0 THEN 'N'
                         WHEN b0 = 'C' AND genome_strand = 'XG:Z:CT' AND p % 2 = 0 THEN 'T'
                         WHEN b0 = 'G' AND genome_strand = 'XG:Z:GA' AND p % 2 = 0 THEN 'A' ELSE b0 END AS base,
            CASE WHEN cigar = '20M2D80M' AND off > 20 THEN off - 2
                 WHEN cigar = '20M1I79M' AND off > 20 THEN off + 1
                 WHEN cigar = '30M1I30M1D39M' AND off > 30 AND off < 60 THEN off + 1
                 ELSE off END AS idx
      FROM (SELECT *, snp_at - start_at + 1 AS off,
              CASE WHEN (CASE WHEN mate = 2 AND o % 26 = 0 THEN 1 - is_alt ELSE is_alt END) = 1
                   THEN {_ALT} ELSE {_REF} END AS b0
        FROM (SELECT *, CASE mate WHEN 1 THEN read_start WHEN 2 THEN read_start + shift ELSE read_start + 2000 END AS start_at,
                CASE WHEN mate = 2 THEN read_start ELSE read_start + shift END AS mate_start,
                concat('chr', {_text('1 + (k + CASE WHEN o % 23 = 0 THEN 1 ELSE 0 END) % 3')}) AS mate_chr,
                CASE o % 10 WHEN 7 THEN '30M1I30M1D39M' WHEN 8 THEN '20M2D80M'
                            WHEN 9 THEN '20M1I79M' ELSE '100M' END AS cigar,
                CASE WHEN ln % 2 = 1 THEN 'XG:Z:CT' ELSE 'XG:Z:GA' END AS genome_strand
          FROM (SELECT *, CASE WHEN o % 31 = 0 THEN 500 ELSE (p % 3) * 30 END AS shift, {_series(d, '1', '3')} AS mate
                FROM placed) m
          WHERE mate = 1 OR (mate = 2 AND o % 19 <> 0) OR (mate = 3 AND o % 31 = 0)) a) b) c"""


def _aligned_raw(_: str) -> str:
    # Reads as they come from the aligner: some clipped at the end that is sequenced first, some fragments unmapped.
    return """
    SELECT sample_id, read_id, flag + CASE WHEN lost THEN 12 ELSE 0 END AS flag,
      CASE WHEN NOT lost THEN chr WHEN mapq = 25 THEN '*' END AS chr,
      CASE WHEN lost THEN 0 WHEN cut AND flag & 16 = 0 THEN read_start + 2 ELSE read_start END AS read_start,
      CASE WHEN lost THEN '*' WHEN cut AND flag & 16 = 0 THEN '2S98M' WHEN cut THEN '97M1S2H' ELSE cigar END AS cigar,
      CASE WHEN lost THEN '*' ELSE rnext END AS rnext, CASE WHEN lost THEN 0 ELSE mate_read_start END AS mate_read_start,
      score_before_recal, genome_strand
    FROM (SELECT *, mapq IN (25, 38) AS lost, cigar = '100M' AND ascii(substring(read_id, 2, 1)) % 2 = 1 AS cut FROM sam_raw) r"""


def _vcf_raw(d: str) -> str:
    # Five sites per supplier and sample, and one row cleaning has to deal with:
    # a repeat, or the same id at another position, an indel, an id of "." or of another kind, or a bad position.
    # The second sample's chromosomes are written without the prefix its reads have.
    return f"""
    SELECT sample_id, concat(CASE WHEN sample_id = 's2' THEN '' ELSE 'chr' END, {_text('1 + k % 3')}) AS chr,
      CASE WHEN odd = 4 THEN 'NA' ELSE {_text(f"1000 + 200 * {_div('k', 3)} + CASE WHEN odd = 0 AND k % 2 = 0 THEN 40 ELSE 0 END")} END AS pos,
      CASE WHEN odd = 2 THEN '.' WHEN odd = 3 THEN concat('ss', {_text('k')})
           ELSE concat('rs', {_text('k')}) END AS snp_id,
      CASE WHEN odd = 1 THEN 'AT' ELSE {_REF} END AS ref, {_ALT} AS alt,
      cast(30 + k % 50 as double) AS qual, 'PASS' AS filter, concat('DP=', {_text('k % 90')}) AS info,
      'GT' AS format, '0/1' AS data
    FROM (SELECT concat('s', {_text('smp')}) AS sample_id,
            CASE WHEN site = 5 THEN s_suppkey * 5 ELSE s_suppkey * 5 + site END AS k,
            CASE WHEN site = 5 THEN s_suppkey % 5 ELSE -1 END AS odd
          FROM (SELECT s_suppkey, smp, {_series(d, '0', '5')} AS site
                FROM (SELECT s_suppkey, {_series(d, '1', '2')} AS smp FROM supplier) x) y) z"""


def _excluded_raw(d: str) -> str:
    return f"""
    SELECT concat('s', {_text('smp')}) AS sample_id, concat('chr', {_text('1 + k % 3')}) AS chr,
      {_text('930 + 7 * k')} AS pos,
      CASE WHEN k % 9 = 0 THEN '.' ELSE concat('rs9', {_text('k')}) END AS snp_id,
      CASE WHEN k % 13 = 0 THEN 'CA' ELSE {_REF} END AS ref, {_ALT} AS alt,
      cast(k % 60 as double) AS qual, 'PASS' AS filter, 'DP=9' AS info, 'GT' AS format, '0/1' AS data
    FROM (SELECT p_partkey AS k, {_series(d, '1', '2')} AS smp FROM part) x"""


def _common_raw(d: str) -> str:
    return f"""
    SELECT concat('s', {_text('smp')}) AS sample_id, k % 585 AS bin,
      concat('chr', {_text('1 + k % 3')}, CASE WHEN k % 7 = 0 THEN '_cox_hap2' ELSE '' END) AS chr,
      929 + 7 * k AS pos_inf, 930 + 7 * k AS pos,
      concat(CASE WHEN k % 11 = 0 THEN 'ss' ELSE 'rs' END, {_text('k')}) AS snp_id,
      cast(0 as bigint) AS score, '+' AS strand, {_REF} AS refNCBI, {_REF} AS refUCSC,
      concat({_REF}, '/', {_ALT}) AS observed, 'genomic' AS molType, 'single' AS class,
      'by-frequency' AS valid, cast(0.25 as double) AS avHet, cast(0.5 as double) AS avHetSE,
      'intron' AS func, 'exact' AS locType, cast(1 as bigint) AS weight, 'none' AS exceptions,
      cast(3 as bigint) AS submitterCount, 'A,B,C,' AS submitters, cast(2 as bigint) AS alleleFreqCount,
      concat({_REF}, ',', {_ALT}, ',') AS alleles, '100,100,' AS alleleNs,
      CASE WHEN k % 13 = 0 THEN 'n/a'
           ELSE concat('0.', {_text('1000 - 2 * size')}, ',0.', lpad({_text('2 * size')}, 3, '0'), ',') END
        AS alleleFreqs, 'maf-5-some-pop' AS bitfields
    FROM (SELECT p_partkey AS k, cast(p_size as bigint) AS size, {_series(d, '1', '2')} AS smp FROM part) x"""


# In order of use: each may read those before it.
TABLES: dict[str, Callable[[str], str]] = {
    "fragments": _fragments,
    "placed": _placed,
    "context_raw": _context_raw,
    "sam_raw": _sam_raw,
    "aligned_raw": _aligned_raw,
    "vcf_raw": _vcf_raw,
    "excluded_raw": _excluded_raw,
    "common_raw": _common_raw,
}


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    given = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "supplier", "part")
    }
    needed = {"placed": ["fragments"], "context_raw": ["fragments", "placed"],
              "sam_raw": ["fragments", "placed"], "aligned_raw": ["fragments", "placed", "sam_raw"]}.get(name, [])
    ctes = ", ".join(f"{t} AS ({TABLES[t](SPARK)})" for t in needed)
    text = (f"WITH {ctes} " if ctes else "") + f"SELECT * FROM ({TABLES[name](SPARK)}) q"
    for t in given:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
    used = {t: df for t, df in given.items() if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def duckdb_ctes() -> str:
    return ",\n".join(f"{t} AS ({sql(DUCKDB)})" for t, sql in TABLES.items())
