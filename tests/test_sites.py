"""Rows at and off a set of sites, and the text that the readers are given."""

import random
from glob import glob

import pytest
from pyspark.sql import functions as F

from strandfold.operators import context as ctx
from strandfold.operators import cpg, sites
from strandfold.plans import catalog


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    place = lambda: (rng.choice(["s1", "s2", None]), rng.choice(["c1", "c2", None]),
                     rng.choice([None, -1, -1024, 0, 63, 64, 1 << 40, *range(1000, 1100)]))
    context = [(*place(), 1, 1, f"r{i % 50}") for i in range(400)]
    context += context[:40]
    ddl = "sample_id string, chr string, pos bigint"
    return (spark.createDataFrame(context, f"{ddl}, meth int, cov int, read_id string"),
            spark.createDataFrame([place() for _ in range(150)] * 2, ddl))


def test_rows_at_and_off_sites_are_those_of_the_joins(rows):
    context, chosen = rows
    for got, how in ((sites.at_sites(context, chosen), "left_semi"), (sites.off_sites(context, chosen), "left_anti")):
        want = context.join(chosen, ctx.SITE, how)
        assert got.columns == context.columns and got.count() == want.select(*context.columns).count() > 0
        assert got.exceptAll(want.select(*context.columns)).isEmpty()


def test_covered_calls_are_not_sorted_by_site(rows):
    context, chosen = rows
    covered = chosen.dropDuplicates().withColumnsRenamed({"pos": "pos_start"})
    text = plan_of(ctx.covered_context(context, covered))
    assert "ShuffledHashJoin" in text and "Sort " not in text and "Broadcast" not in text


def test_except_distinct_is_one_aggregate(rows):
    context, chosen = rows
    exclusion = chosen.withColumnsRenamed({"chr": "chr_snp", "pos": "pos_snp"})
    left = cpg.except_distinct(context, exclusion)
    assert "Join" not in plan_of(left)
    want = context.select(*ctx.SITE).subtract(cpg.destroyed_sites(exclusion))
    assert left.count() == want.count() > 0 and left.exceptAll(want).isEmpty()


def test_text_for_the_readers_is_compressed(spark):
    tables = catalog.Tables(spark, "none")
    raw = spark.createDataFrame(
        [(s, f"r{i}", "+", "chr1", i, "Z", k) for s in catalog.SAMPLES for k in ("OB", "OT") for i in range(3)],
        "sample_id string, read_id string, meth_state string, chr string, pos bigint, meth_call string, strand string")
    tables.stages.write("context_raw", lambda: raw)
    assert catalog._scan_context(tables).select(*raw.columns).exceptAll(raw).isEmpty()
    path = tables.lines("calls", raw)
    for folder in (path, tables.stages.path("text_context")):
        files = [f for f in glob(f"{folder.removeprefix('file:')}/**/part-*", recursive=True)]
        assert files and all(f.endswith(".gz") for f in files)
    assert spark.read.text(path).filter(F.col("value").startswith("r0\t")).count() == 4
