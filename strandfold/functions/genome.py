"""Column expressions over reads, CIGAR strings and variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tag in front of a quality string, the letters and numbers
# of a CIGAR string, and the wanted form of a variant id.
SCORE_TAG = "OQ:Z:"
CALL_TAG = "XM:Z:"
CIGAR_LETTERS = "[M|D|I]"
CIGAR_NUMBERS = "[0-9]+"
CIGAR_STEP = "[0-9]+[MIDNSHP=X]"
LEADING_CLIPS = "^(([0-9]+[SH])+)"
TRAILING_CLIPS = "(([0-9]+[SH])+)$"
RS_ID = "%rs%"


def try_bigint(value: Column) -> Column:
    return value.try_cast("bigint")


def is_single_base_snp(snp_id: Column, ref: Column, alt: Column) -> Column:
    return snp_id.like(RS_ID) & (F.octet_length(ref) == 1) & (F.octet_length(alt) == 1)


def informative_strands(ref: Column, alt: Column) -> tuple[Column, Column]:
    """Whether bisulfite conversion leaves the SNP readable on (CT, GA) reads.

    Conversion turns C into T on CT reads and G into A on GA reads, so a C/T
    pair cannot be told apart on the former nor a G/A pair on the latter.
    """
    pair = F.array_join(F.array_sort(F.array(ref, alt)), "")
    return F.coalesce(pair != "CT", F.lit(True)), F.coalesce(pair != "AG", F.lit(True))


def bare_chr(name: Column) -> Column:
    """A chromosome name without its ``chr`` prefix, for tables that write it differently."""
    return F.regexp_replace(name, "^chr", "")


def cigar_steps(cigar: Column) -> Column:
    """The CIGAR as an array of operations and lengths."""
    steps = F.regexp_extract_all(cigar, F.lit(CIGAR_STEP), F.lit(0))
    return F.transform(
        steps,
        lambda s: F.struct(
            F.right(s, F.lit(1)).alias("op"),
            try_bigint(F.regexp_extract(s, CIGAR_NUMBERS, 0)).alias("n"),
        ),
    )


def exact_index(cigar: Column, offset: Column) -> Column:
    """1-based read index of a reference offset by walking the whole CIGAR.

    Null inside a deletion and beyond the alignment.
    """

    def walk(acc: Column, step: Column) -> Column:
        on_ref = step.op.isin("M", "=", "X", "D", "N")
        on_read = step.op.isin("M", "=", "X", "I", "S")
        inside = (offset > acc.ref) & (offset <= acc.ref + step.n) & on_ref & on_read
        return F.struct(
            (acc.ref + F.when(on_ref, step.n).otherwise(0)).alias("ref"),
            (acc["read"] + F.when(on_read, step.n).otherwise(0)).alias("read"),
            F.when(inside, acc["read"] + offset - acc.ref).otherwise(acc.found).alias("found"),
        )

    start = F.struct(
        F.lit(0).cast("bigint").alias("ref"),
        F.lit(0).cast("bigint").alias("read"),
        F.lit(None).cast("bigint").alias("found"),
    )
    return F.aggregate(cigar_steps(cigar), start, walk, lambda acc: acc.found)


def exact_offset(steps: Column, index: Column) -> Column:
    """Reference offset (1-based) of a read index; null in insertions and clips.

    Takes ``cigar_steps`` as a column, since it is asked for many bases of a read.
    """

    def walk(acc: Column, step: Column) -> Column:
        on_ref = step.op.isin("M", "=", "X", "D", "N")
        on_read = step.op.isin("M", "=", "X", "I", "S")
        inside = (index > acc["read"]) & (index <= acc["read"] + step.n) & on_ref & on_read
        return F.struct(
            (acc.ref + F.when(on_ref, step.n).otherwise(0)).alias("ref"),
            (acc["read"] + F.when(on_read, step.n).otherwise(0)).alias("read"),
            F.when(inside, acc.ref + index - acc["read"]).otherwise(acc.found).alias("found"),
        )

    start = F.struct(
        F.lit(0).cast("bigint").alias("ref"),
        F.lit(0).cast("bigint").alias("read"),
        F.lit(None).cast("bigint").alias("found"),
    )
    ungapped = (F.size(steps) == 1) & (F.get(steps, F.lit(0)).op == "M")
    return F.when(ungapped & (index <= F.get(steps, F.lit(0)).n), index).otherwise(
        F.aggregate(steps, start, walk, lambda acc: acc.found)
    )


def aligned_segments(steps: Column) -> Column:
    """(read_at, ref_at, n) of the CIGAR's segments of n bases that lie on both read and reference, with offsets from zero.

    Takes ``cigar_steps`` as a column. A base that ``exact_offset`` places lies in one of them.
    """

    def walk(acc: Column, step: Column) -> Column:
        on_ref = step.op.isin("M", "=", "X", "D", "N")
        on_read = step.op.isin("M", "=", "X", "I", "S")
        known = on_ref & on_read & step.n.isNotNull() & acc.ref.isNotNull() & acc["read"].isNotNull()
        segment = F.array(F.struct(acc["read"].alias("read_at"), acc.ref.alias("ref_at"), step.n.alias("n")))
        return F.struct(
            (acc.ref + F.when(on_ref, step.n).otherwise(0)).alias("ref"),
            (acc["read"] + F.when(on_read, step.n).otherwise(0)).alias("read"),
            F.when(known, F.concat(acc.found, segment)).otherwise(acc.found).alias("found"),
        )

    start = F.struct(
        F.lit(0).cast("bigint").alias("ref"),
        F.lit(0).cast("bigint").alias("read"),
        F.array().cast("array<struct<read_at: bigint, ref_at: bigint, n: bigint>>").alias("found"),
    )
    return F.aggregate(steps, start, walk, lambda acc: acc.found)


def reference_span(cigar: Column) -> Column:
    """Reference bases an alignment covers."""
    return F.aggregate(
        cigar_steps(cigar),
        F.lit(0).cast("bigint"),
        lambda acc, step: acc
        + F.when(step.op.isin("M", "=", "X", "D", "N"), step.n).otherwise(0),
    )


def clipped_bases(cigar: Column, clips: str) -> Column:
    """Bases clipped off at one end, soft or hard; ``clips`` is LEADING_CLIPS or TRAILING_CLIPS."""
    numbers = F.regexp_extract_all(F.regexp_extract(cigar, clips, 1), F.lit(CIGAR_NUMBERS), F.lit(0))
    total = F.aggregate(numbers, F.lit(0).cast("bigint"), lambda acc, n: acc + n.cast("bigint"))
    return F.when(F.contains(cigar, F.lit("S")) | F.contains(cigar, F.lit("H")), total).otherwise(0)


def unclipped_five_prime(start: Column, cigar: Column, is_reversed: Column) -> Column:
    """Where the first sequenced base of a read would lie had no base been clipped.

    A forward read's clips before its start are added back, a reverse read's behind its end.
    """
    end = start + reference_span(cigar) - 1 + clipped_bases(cigar, TRAILING_CLIPS)
    return F.when(is_reversed, end).otherwise(start - clipped_bases(cigar, LEADING_CLIPS))


def char_at(text: Column, index: Column) -> Column:
    """One character, counted from the end below zero; further left, the first one."""
    return F.substring(text, F.greatest(index, -F.length(text)).cast("int"), 1)


def allele_of(base: Column, ref: Column, alt: Column, ct_snp: Column, ga_snp: Column,
              ct_read: Column, ga_read: Column) -> Column:
    """REF, ALT or null for the base a read shows at a SNP.

    A SNP readable on both strands may also show its converted form: T for C
    on CT reads, A for G on GA reads. REF is tried first.
    """

    both = ct_snp & ga_snp

    def accepted(expected: Column) -> Column:
        converted = F.when(both & (expected == "C") & ct_read, "T").when(
            both & (expected == "G") & ga_read, "A"
        )
        return F.concat(expected, F.coalesce(converted, F.lit("")))

    return F.when(F.contains(accepted(ref), base), "REF").when(
        F.contains(accepted(alt), base), "ALT"
    )
