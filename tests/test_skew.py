"""Joins with a key that holds most rows: found, split, and still exact."""

import random

import pytest
from pyspark.sql import functions as F

from strandfold.operators import prefilter, skew
from strandfold.operators.intervals import point_interval_join


@pytest.fixture()
def left(spark):
    return spark.range(6000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"),
        F.lit("a").alias("g"), (F.col("id") % 4).alias("v"))


def test_hot_key_is_found(left):
    (hot,) = skew.find_hot_keys(left, ["g", "k"], rows_per_split=500)
    assert list(hot.splits.values()) == [5]
    assert not skew.find_hot_keys(left, ["g", "k"])[0]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_keeps_every_row(spark, left, how):
    right = spark.createDataFrame([("a", k, k * 10) for k in (7, 7, 8, 99)], "g string, k bigint, w bigint")
    if how in ("left_semi", "left_anti"):
        right = right.drop("w")
    (hot,) = skew.find_hot_keys(left, ["g", "k"], rows_per_split=300)
    assert hot
    split = skew.split_join(left, right, ["g", "k"], how, hot)
    plain = left.join(right, ["g", "k"], how)
    assert split.columns == plain.columns
    assert sorted(split.collect()) == sorted(plain.collect())


def test_split_rows_spread_over_tasks(spark):
    """Hot rows in every second partition only, as position-sorted input has them, and all alike."""
    left = spark.range(6000, numPartitions=12).select(
        F.when(F.spark_partition_id() % 2 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.lit("a").alias("g"), (F.col("id") % 40).alias("v"))
    (hot,) = skew.find_hot_keys(left, ["g", "k"], rows_per_split=600)
    assert list(hot.splits.values()) == [6]
    right = spark.createDataFrame([("a", 7)], "g string, k bigint")
    salted = skew.split_join(left, right, ["g", "k"], "left_semi", hot)._jdf.queryExecution().optimizedPlan().toString()
    assert skew.SALT in salted
    rows = left.filter("k = 7").withColumn("s", F.pmod(F.xxhash64(F.spark_partition_id(), "v"), F.lit(6))).groupBy("s").count().collect()
    assert len(rows) == 6 and max(r["count"] for r in rows) < 900


def test_keys_are_watched_while_a_table_is_written(spark, left):
    df, observation = skew.watched(left, {"by_key": ["g", "k"], "by_value": ["v"]})
    df.write.format("noop").mode("overwrite").save()
    sketches = skew.gathered(observation)
    assert skew.hot_keys(spark, [sketches["by_key"]], 500) == skew.find_hot_keys(left, ["g", "k"], rows_per_split=500)[0]
    twice = skew.hot_keys(spark, [sketches["by_key"]] * 2, 500)
    assert list(twice.splits.values()) == [9] and len(skew.hot_keys(spark, [sketches["by_value"]], 500).splits) == 4
    assert not skew.hot_keys(spark, [], 1) and not skew.hot_keys(spark, [sketches["by_key"]])


def test_an_empty_table_has_no_sketch(spark, left):
    df, observation = skew.watched(left.filter("false"), {"by_key": ["g", "k"]})
    df.write.format("noop").mode("overwrite").save()
    found = skew.gathered(observation)
    assert not skew.hot_keys(spark, list(found.values()), 1)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 22])
def test_bitmap_never_drops_a_match(spark, monkeypatch, bits):
    monkeypatch.setattr(prefilter, "bits_for", lambda keys: bits)
    keyed = spark.range(0, 3000, 3).select(F.lit("s").alias("a"), F.col("id").cast("string").alias("b"))
    rows = spark.range(60_000).select(F.lit("s").alias("a"), F.col("id").cast("string").alias("b"), F.lit(1).alias("v"))
    rows = rows.union(spark.createDataFrame([("s", None, 1), (None, "3", 1)], "a string, b string, v int"))
    kept = prefilter.may_match(rows, keyed, ["a", "b"], 1000)
    assert kept.columns == rows.columns and kept.join(keyed, ["a", "b"], "left_semi").count() == 1000
    assert kept.count() <= (4500 if bits == 1 << 15 else 1030)
    assert prefilter.may_match(rows, keyed.limit(0), ["a", "b"], 0).count() == 0


def test_bitmap_is_bounded(spark):
    assert prefilter.bits_for(1) == prefilter.MIN_BITS and prefilter.bits_for(1 << 26) == prefilter.MAX_BITS
    assert prefilter.bits_for((1 << 26) + 1) == 0
    rows = spark.range(10)
    assert prefilter.may_match(rows, rows, ["id"], 1 << 40) is rows


def test_a_thousand_hot_keys_are_all_split(spark):
    left = spark.range(40_000, numPartitions=8).select((F.col("id") % 1000).alias("k"), (F.col("id") % 7).alias("v"))
    (hot,) = skew.find_hot_keys(left, ["k"], rows_per_split=15)
    assert len(hot.splits) == 1000 and set(hot.splits.values()) == {3}
    right = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 3).alias("w"))
    for how in ("inner", "left_anti"):
        split = skew.split_join(left, right if how == "inner" else right.drop("w"), ["k"], how, hot)
        plain = left.join(right if how == "inner" else right.drop("w"), ["k"], how)
        assert sorted(split.collect()) == sorted(plain.collect())


def test_sketch_grows_with_the_table(spark, monkeypatch):
    small = spark.range(1000)
    assert skew._sizes(small, 4_000_000) == (128, 8192, 4_000_000)
    assert skew._sizes(small, 10)[0] == 800
    keys, items, per_split = skew._sizes(small.crossJoin(small).crossJoin(small).crossJoin(small), 4_000_000)
    assert keys == skew.MAX_HOT_KEYS and items > 500_000 and per_split == 10_000_000


def test_a_large_size_in_bytes_does_not_raise_the_split(spark, left, monkeypatch):
    """Wide rows: the plan's bytes are many times the rows."""
    sizes = skew._sizes
    monkeypatch.setattr(skew, "_sizes", lambda df, rows_per_split: (*sizes(df, rows_per_split)[:2], 10 * rows_per_split))
    (hot,) = skew.find_hot_keys(left, ["g", "k"], rows_per_split=500)
    assert list(hot.splits.values()) == [5]


def test_right_joins_cannot_be_split(spark, left):
    with pytest.raises(ValueError):
        skew.split_join(left, left, ["k"], "right", skew.HotKeys({1: 2}))


@pytest.mark.parametrize("base", [1, 7, 64, 256])
def test_interval_join_equals_brute_force(spark, base):
    rng = random.Random(base)
    intervals = [("s1", "c1", s, s + rng.choice([0, 5, 99, 700, 90_000, -3]))
                 for s in (rng.randint(-200, 5000) for _ in range(150))]
    points = [(rng.choice(["s1", "s2"]), rng.choice(["c1", "c2"]), rng.randint(-300, 9000))
              for _ in range(120)] + [("s1", "c1", None)]
    left = spark.createDataFrame(intervals, "sample_id string, chr string, a bigint, b bigint")
    right = spark.createDataFrame(points, "sample_id string, chr string, p bigint")
    got = sorted(tuple(r) for r in point_interval_join(
        left, right, ["sample_id", "chr"], "a", "b", "p", base_width=base
    ).select("sample_id", "chr", "a", "b", "p").collect())
    want = sorted((s, c, a, b, p) for s, c, a, b in intervals for s2, c2, p in points
                  if (s, c) == (s2, c2) and p is not None and a <= p <= b)
    assert got == want


def test_offered_points_are_never_gathered_for_a_broadcast(spark):
    """Each point stands in fourteen bins, of which the size estimate knows nothing."""
    intervals = spark.range(50).selectExpr("'s' AS sample_id", "id AS a", "id + 9 AS b")
    points = spark.range(50).selectExpr("'s' AS sample_id", "id AS p")
    joined = point_interval_join(intervals, points, ["sample_id"], "a", "b", "p")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == sum(min(i + 9, 49) - i + 1 for i in range(50))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("splits", [None, 3])
def test_a_side_that_grows_is_never_gathered_for_a_broadcast(spark, how, splits):
    """However small its file looks: compressed, it tells little of the rows that the driver would hold."""
    left, right = spark.range(60).selectExpr("id % 20 AS k", "id AS v"), spark.range(10).selectExpr("id AS k")
    hot = skew.HotKeys()
    if splits:
        hot = skew.HotKeys({spark.range(7, 8).select(F.xxhash64("id")).first()[0]: splits})
    joined, free = (skew.split_join(left, right, ["k"], how, hot, *strategy) for strategy in ((), (None,)))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(joined) and "Broadcast" in plan(free)
    assert joined.count() == free.count() == {"left": 60}.get(how, 30)
