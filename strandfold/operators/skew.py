"""Splitting the join keys that hold an outsized share of the rows."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows of one key a single task should join.
ROWS_PER_SPLIT = 4_000_000
# Keys and counters that Spark's frequent-items sketch allows.
MAX_HOT_KEYS = 100_000
MAX_ITEMS = 1_000_000
LEAST_KEYS, LEAST_ITEMS = 128, 8192
# Rows up to which the sketch tells a key of ROWS_PER_SPLIT rows for certain.
MOST_ROWS = 10**12
# More keys than these are looked up in a table rather than in the expression.
LITERAL_KEYS = 128

SALT = "_salt"
# What a frequent-items sketch over hashes is, as a column.
SKETCH_DDL = "sketch binary, maxItemsTracked int, itemDataType bigint, itemDataTypeDDL string"


@dataclass(frozen=True)
class HotKeys:
    """Splits per hash of a frequent key; at most ``MAX_HOT_KEYS`` entries of 12 bytes."""

    splits: dict[int, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.splits)

    def splits_of(self, keys: Sequence[Column]) -> Column:
        table = F.create_map(
            *[F.lit(v) for h, n in self.splits.items() for v in (h, n)]
        )
        return F.coalesce(F.try_element_at(table, F.xxhash64(*keys)), F.lit(1))

    def attach(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The table with the splits of each row's key as a column ``_splits``."""
        if len(self.splits) <= LITERAL_KEYS:
            return df.withColumn("_splits", self.splits_of([F.col(k) for k in keys]))
        table = df.sparkSession.createDataFrame(list(self.splits.items()), "_hash bigint, _splits int")
        found = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(table), "_hash", "left")
        return found.withColumn("_splits", F.coalesce("_splits", F.lit(1))).drop("_hash")


def watched(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> tuple[DataFrame, Observation]:
    """The table, and sketches of its frequent keys that fill while something else reads it.

    Each task keeps a sketch of bounded size over the hashed keys, and only the sketches are
    merged: neither keys nor rows are shuffled, and no job runs for it. Once an action has gone over the
    table the observation has a sketch per key set, as JSON. The sketch is sized
    by the table: up to ``MOST_ROWS`` rows it finds every key with more than ROWS_PER_SPLIT rows
    and more than a ``MAX_HOT_KEYS``-th of the table. Rows read twice, by a retry for instance, count twice;
    that decides how work is spread, never what is joined.
    """
    # A table has fewer rows than bytes, so its size raises the counters and never the rows from which a key is split.
    _, items, _ = _sizes(df, ROWS_PER_SPLIT)
    observation = Observation()
    sketches = [
        F.expr(f"to_json(approx_top_k_accumulate({_hash(keys)}, {items}))").alias(name) for name, keys in key_sets.items()
    ]
    return df.observe(observation, *sketches), observation


def gathered(observation: Observation) -> dict[str, str]:
    """The sketches of a finished observation; none if the optimizer left the table out as empty."""
    try:
        return observation.get
    except Py4JError:
        return {}


def hot_keys(spark: SparkSession, sketches: Sequence[str], rows_per_split: int = ROWS_PER_SPLIT) -> HotKeys:
    """The frequent keys of the tables, or parts of one, that the sketches were taken of."""
    if not sketches:
        return HotKeys()
    if len(sketches) == 1:  # worked out while the query is planned
        number = min(json.loads(sketches[0])["maxItemsTracked"], MAX_HOT_KEYS)
        top = f"approx_top_k_estimate(from_json(s, '{SKETCH_DDL}'), {number})"
    else:  # combined, a sketch keeps its counters; a key that is frequent overall is so in some part
        top = f"approx_top_k_estimate(approx_top_k_combine(from_json(s, '{SKETCH_DDL}'), {MAX_ITEMS}), {MAX_HOT_KEYS})"
    values = ", ".join(f"(:s{i})" for i in range(len(sketches)))
    found = spark.sql(f"SELECT {top} AS top FROM VALUES {values} AS t(s)", args={f"s{i}": s for i, s in enumerate(sketches)}).first()
    return _split_hot(found.top, rows_per_split)


def find_hot_keys(df: DataFrame, *key_sets: Sequence[str | Column],
                  rows_per_split: int = ROWS_PER_SPLIT) -> list[HotKeys]:
    """Frequent keys of a table, in one pass over it for all key sets.

    For a table that nobody has watched while it was written; see ``watched`` for what is found.
    """
    number, items, _ = _sizes(df, rows_per_split)
    hashed = df.select(*[F.xxhash64(*keys).alias(f"_h{i}") for i, keys in enumerate(key_sets)])
    row = hashed.agg(*[F.expr(f"approx_top_k(_h{i}, {number}, {items})") for i in range(len(key_sets))]).first()
    return [_split_hot(sketch, rows_per_split) for sketch in row]


def _split_hot(top, rows_per_split: int) -> HotKeys:
    return HotKeys({
        r["item"]: math.ceil(r["count"] / rows_per_split)
        for r in (top or [])
        if r["item"] is not None and r["count"] > rows_per_split
    })


def _hash(keys: Sequence[str]) -> str:
    return f"xxhash64({', '.join(f'`{k}`' for k in keys)})"


def _sizes(df: DataFrame, rows_per_split: int) -> tuple[int, int, int]:
    """Keys to report, counters to keep, and the rows that these tell apart for certain if each is a byte, from the plan's size.

    A row has at least a byte, so the size bounds the rows without a job.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows = min(max(size, 1), MOST_ROWS)
    rows_per_split = max(rows_per_split, math.ceil(rows / MAX_HOT_KEYS))
    most = math.ceil(rows / rows_per_split)
    number = min(max(most, LEAST_KEYS), MAX_HOT_KEYS)
    return number, min(max(8 * most, LEAST_ITEMS), MAX_ITEMS), rows_per_split


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
               hot: HotKeys, strategy: str | None = "merge") -> DataFrame:
    """Equi-join in which each hot key of ``left`` is spread over several tasks.

    Both sides grow with the input, so the join is asked to shuffle by ``strategy``, a join hint: the optimizer's size
    check sees a stage's compressed file, of which 10 MB may be hundreds in the driver once gathered for a broadcast.
    ``None`` leaves the choice to the optimizer, for a right side of bounded size.

    A left row of a hot key goes to one split, chosen by a hash of the input partition
    it was read from and of its other columns, so that identical rows part, neighbouring partitions do not
    take turns with the splits, and a retried task chooses the same. The right rows of that
    key are repeated per split. Only kinds that keep rows of the left side once are allowed.
    """
    if how not in ("inner", "left_semi", "left_anti", "left"):
        raise ValueError(f"cannot split a {how} join")
    hinted = (lambda df: df.hint(strategy)) if strategy else (lambda df: df)
    if not hot:
        return left.join(hinted(right), list(keys), how)
    splits = F.col("_splits")
    others = [F.col(f.name) for f in left.schema if f.name not in keys and f.dataType.typeName() not in ("map", "variant")]
    salted = F.pmod(F.xxhash64(F.spark_partition_id(), *others), splits).cast("int")
    left = hot.attach(left, keys).withColumn(SALT, F.when(splits > 1, salted).otherwise(0)).drop("_splits")
    right = hot.attach(right, keys).withColumn(SALT, F.explode(F.sequence(F.lit(0), splits - 1))).drop("_splits")
    return left.join(hinted(right), [*keys, SALT], how).drop(SALT)
