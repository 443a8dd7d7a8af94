"""Queries that go over a derived table once do not write it first, and reads meet before their calls are taken out."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strandfold.operators import alignment
from strandfold.params import AsmParams
from strandfold.plans import catalog, derived

SF = "/root/testdata/sf0.001"
SAM_DDL = ("sample_id string, read_id string, flag bigint, chr string, read_start bigint, cigar string, "
           "genome_strand string, meth string, read_strand string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", ["distinct", "write_bedgraph", "variant_depth_cap", "cpg_coverage", "except_distinct"])
def test_a_table_read_once_is_not_written(spark, query):
    tables = catalog.Tables(spark, SF)
    assert catalog._QUERIES[query](tables).count() > 0
    assert not tables.stages.finished("context_raw") and not tables.stages.finished("sam_raw")


def test_a_table_that_is_there_is_read(spark):
    tables = catalog.Tables(spark, SF)
    tables.raw("context_raw")
    assert "lineitem" not in plan_of(tables.once("context_raw"))


def test_fragments_are_those_of_a_distinct_over_their_text(spark):
    rng, some = random.Random(2), lambda *values: rng.choice([None, *values])
    rows = [(some(1, 64, 70), some(1, 2), some(5, 6), some(7, 8)) for _ in range(400)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint").createOrReplaceTempView("lineitem")
    got = spark.sql(derived.TABLES["fragments"](derived.SPARK))
    want = spark.sql(derived.TABLES["fragments"](derived.DUCKDB))
    assert got.schema == want.schema and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert "concat" not in plan_of(got).partition("Exchange")[2]
    spark.catalog.dropTempView("lineitem")


def calls_by_loop(rows, params):
    def span(cigar):
        return sum(n for n, op in steps(cigar) if op in "M=XDN")

    def steps(cigar):
        return [(int(n), op) for n, op in re.findall("([0-9]+)([MIDNSHP=X])", cigar)]

    first = [r for r in rows if "CT" in (r[8] or "")]
    for r in rows:
        sample, read, flag, chromosome, start, cigar, strand, meth, mate = r
        if None in (start, cigar, meth):
            continue
        calls = meth[5:]
        cut = (params.ignore_r1, params.ignore_3prime_r1) if r in first else (params.ignore_r2, params.ignore_3prime_r2)
        left, right = cut[::-1] if flag is not None and flag & 16 else cut
        at_read = at_ref = 0
        places = {}
        for n, op in steps(cigar):
            if op in "M=X":
                places |= {at_read + j: at_ref + j for j in range(n)}
            at_read, at_ref = at_read + n * (op in "M=XIS"), at_ref + n * (op in "M=XDN")
        for i, c in enumerate(calls):
            if c in "Zz" and left <= i < len(calls) - right and i in places:
                pos = start + places[i]
                hit = r not in first and any(
                    None not in (*f[:2], f[3], f[4], f[5]) and (f[0], f[1], f[3]) == (sample, read, chromosome) and f[4] <= pos <= f[4] + span(f[5]) - 1 for f in first)
                if not hit:
                    yield sample, read, "+" if c == "Z" else "-", chromosome, pos, c, "OT" if "CT" in (strand or "") else "OB"


def test_calls_are_those_of_a_walk_along_each_read(spark):
    rng = random.Random(4)
    cigars = ["12M", "5M2D7M", "5M2I5M", "2S8M2S", "3M1I2M3N6M", "3H12M", "20M", "4M", "*", None]
    rows = [(rng.choice(["s", "t", None]), rng.choice(["a", "b", "c", None]), rng.choice([0, 16, 99, 147, None]), rng.choice(["1", "2", None]),
             rng.choice([None, 100, 104, 110]), rng.choice(cigars), rng.choice(["XG:Z:CT", "XG:Z:GA", None]),
             rng.choice([None, "XM:Z:", *("XM:Z:" + "".join(rng.choice("Zz.xh") for _ in range(12)) for _ in range(6))]), rng.choice(["XR:Z:CT", "XR:Z:GA", None]))
            for _ in range(300)]
    for params in (AsmParams(), AsmParams(ignore_r1=2, ignore_3prime_r1=1, ignore_r2=3, ignore_3prime_r2=4), AsmParams(ignore_r1=20)):
        out = alignment.extract_methylation(spark.createDataFrame(rows, SAM_DDL), params)
        got = sorted(map(repr, map(tuple, out.collect())))
        assert got == sorted(map(repr, calls_by_loop(rows, params))) and got


def test_calls_are_not_shuffled(spark):
    sam = spark.createDataFrame([("s", "a", 0, "1", 1, "4M", "XG:Z:CT", "XM:Z:ZzZ.", "XR:Z:CT")], SAM_DDL)
    text = plan_of(alignment.extract_methylation(sam, AsmParams()))
    assert "Exchange" in text and all("substring_index" not in part for part in text.split("Exchange")[1:])


def test_scores_are_summed_for_all_kinds_of_strings(spark):
    texts = ["III", "", None, "!", "é~", "K" * 300, None, "日本", "#"]
    old = F.aggregate(F.split("q", ""), F.lit(0).cast("bigint"), lambda acc, c: acc + F.ascii(c) - 33)
    for some in (texts, [t for t in texts if t is None or t.isascii()], [None]):
        df = spark.createDataFrame([(t,) for t in some], "q string").coalesce(1)
        assert all(r.a == r.b for r in df.select(alignment._score_sum("q").alias("a"), old.alias("b")).collect())
