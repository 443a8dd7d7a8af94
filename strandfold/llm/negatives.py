"""Hard negatives from blocks of vectors in the order of a Hilbert curve.

Vectors are laid out along a Hilbert curve through the dimensions that spread most and written as Parquet
in blocks of consecutive rows, with a second table of zone maps: each block's least and largest value
per dimension. By interval arithmetic a zone map bounds the inner product of an anchor with anything in
the block from both sides. An anchor's positives are looked for only in blocks whose upper bound reaches what its own
block already offers, and its negatives only in blocks whose bounds meet one of its windows of scores. What these blocks
hold is scored in full, so the bounds decide what is read and never what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandfold.llm.common import stored

#: Rows of a block.
ROWS = 1024
#: Zone maps that an anchor is held against at a time, and slices of the anchors that are so in parallel.
ZONES, SLICES = 256, 16
#: Dimensions of the curve and bits of each: 56 bits of a long.
CURVE, CURVE_BITS = 8, 7
#: Anchors scored at a time.
ANCHORS = 256

ANCHOR = "block long, row int, vec_id long, label long, vector binary"


def integral(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) with components floor(scale * x), of the rows that take part."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    taken = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return vectors.where(taken & F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), whole.alias("vector"))


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """The position of each point (a row of coordinates below 2 ** bits) on the Hilbert curve, as Skilling (2004) computes it."""
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for b in range(bits - 1, 0, -1):
        below = (1 << b) - 1
        for i, axis in enumerate(axes):
            turned = axis >> b & 1 == 1
            swap = np.where(turned, 0, (axes[0] ^ axis) & below)
            if i:
                axes[i] = axis ^ swap
            axes[0] = np.where(turned, axes[0] ^ below, axes[0] ^ (swap if i else 0))
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flips = np.zeros(len(points), dtype=np.int64)
    for b in range(bits - 1, 0, -1):
        flips = np.where(axes[-1] >> b & 1 == 1, flips ^ ((1 << b) - 1), flips)
    place = np.zeros(len(points), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            place = place << 1 | ((axis ^ flips) >> b & 1)
    return place


class Layout:
    """What all vectors are like: dimensions, their ranges, and in which numbers products are exact."""

    def __init__(self, vectors: DataFrame):
        each = vectors.select(F.posexplode("vector").alias("dim", "x")).groupBy("dim").agg(
            F.min("x").alias("lo"), F.max("x").alias("hi"), F.var_pop(F.col("x").cast("double")).alias("spread"))
        found = sorted(each.collect())  # a row per dimension
        self.dims = len(found)
        self.lo, self.hi = (np.array([r[k] for r in found], dtype=np.int64) for k in ("lo", "hi"))
        self.curve = sorted(range(self.dims), key=lambda i: (-found[i].spread, i))[:CURVE]
        most = sum(max(abs(r.lo), abs(r.hi)) ** 2 for r in found)
        if most >= 1 << 56:  # a hundred times a product must fit 64 bits
            raise ArithmeticError("inner products of these vectors are too large for exact 64-bit arithmetic")
        self.kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64

    def matrix(self, vectors: list[bytes]) -> np.ndarray:
        """Packed vectors as rows; missing components at the end are zero."""
        out = np.zeros((len(vectors), self.dims), dtype=self.kind)
        for i, data in enumerate(vectors):
            values = np.frombuffer(data, dtype=np.int64)
            out[i, :len(values)] = values
        return out

    def places(self, rows: np.ndarray) -> np.ndarray:
        if not self.curve:
            return np.zeros(len(rows), dtype=np.int64)
        lo, hi = self.lo[self.curve].astype(float), self.hi[self.curve].astype(float)
        unit = (rows[:, self.curve] - lo) / (hi - lo + 1)
        return hilbert(np.clip(unit * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1), CURVE_BITS)


def packed(vectors: DataFrame, layout: Layout) -> DataFrame:
    """(place, vec_id, label, vector) with the vector as bytes of 64-bit integers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            data = [np.asarray(v, dtype=np.int64).tobytes() for v in pdf["vector"]]
            yield pd.DataFrame({"place": layout.places(layout.matrix(data)), "vec_id": pdf["vec_id"], "label": pdf["label"], "vector": data})

    return vectors.mapInPandas(run, "place long, vec_id long, label long, vector binary")


def blocks(placed: DataFrame) -> DataFrame:
    """(block, row, vec_id, label, vector): consecutive rows of the curve in numbered blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        done, part = 0, TaskContext.get().partitionId()
        for pdf in batches:
            at = np.arange(done, done + len(pdf))
            done += len(pdf)
            yield pd.DataFrame({"block": (part << 40) + at // ROWS, "row": at % ROWS, **{c: pdf[c] for c in ("vec_id", "label", "vector")}})

    ordered = placed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id", "label", "vector")
    return ordered.mapInPandas(run, ANCHOR)


def streamed(held: DataFrame, passing: DataFrame, keys: list[str], start: Callable, step: Callable, schema: str) -> DataFrame:
    """For each key, ``start`` takes its rows of ``held`` and ``step(state, rows)`` its rows of ``passing``, in batches.

    Both sides meet by a shuffle on the key. Only the held rows of one key are in memory.
    """
    keep = held.columns
    whole = {f.name: f.dataType for df in (held, passing) for f in df.schema if f.dataType.typeName() in ("integer", "long")}

    def filled(df: DataFrame, passes: bool) -> DataFrame:  # a null would turn pandas' integers into floats
        return df.withColumns({"passing": F.lit(passes), **{c: F.lit(0).cast(kind) for c, kind in whole.items() if c not in df.columns}})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, first, state = None, [], None
        for pdf in batches:
            marks = list(zip(*(pdf[k] for k in keys), pdf["passing"]))
            cuts = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
            for lo, hi in zip(cuts, cuts[1:]):
                rows = pdf.iloc[lo:hi]
                if marks[lo][:-1] != key:
                    key, first, state = marks[lo][:-1], [], None
                if not marks[lo][-1]:
                    first.append(rows[keep])
                elif first:
                    state = start(pd.concat(first)) if state is None else state
                    for at in range(0, len(rows), ANCHORS):
                        yield step(state, rows.iloc[at:at + ANCHORS])

    both = filled(held, False).unionByName(filled(passing, True), allowMissingColumns=True)
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(parts, *keys).sortWithinPartitions(*keys, "passing").mapInPandas(run, schema)


def zone_maps(rows: DataFrame, layout: Layout) -> DataFrame:
    """(block, lo, hi, least_label, most_label): what a block's vectors lie between, first per task, then per block."""
    schema = "block long, lo binary, hi binary, least_label long, most_label long"

    def boxes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        for pdf in batches:
            for block, part in pdf.groupby("block"):
                lo, hi = layout.matrix(list(part["lo"])).min(axis=0), layout.matrix(list(part["hi"])).max(axis=0)
                box = (lo, hi, part["least_label"].min(), part["most_label"].max())
                was = held.get(block, box)
                held[block] = (np.minimum(lo, was[0]), np.maximum(hi, was[1]), min(box[2], was[2]), max(box[3], was[3]))
        if held:
            lo, hi, least, most = zip(*held.values())
            out = {"lo": [x.astype(np.int64).tobytes() for x in lo], "hi": [x.astype(np.int64).tobytes() for x in hi]}
            yield pd.DataFrame({"block": list(held), **out, "least_label": least, "most_label": most})

    single = rows.select("block", F.col("vector").alias("lo"), F.col("vector").alias("hi"), F.col("label").alias("least_label"), F.col("label").alias("most_label"))
    return single.mapInPandas(boxes, schema).repartition("block").mapInPandas(boxes, schema)


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product that each anchor can have with anything in each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return (up @ lo.T + down @ hi.T).astype(np.int64), (up @ hi.T + down @ lo.T).astype(np.int64)


def chosen(anchors: DataFrame, zones: DataFrame, layout: Layout, wanted: Callable) -> DataFrame:
    """The anchors with each block (``target``) that they must read: where ``wanted(zones, rows, least, most)`` is true."""
    names, columns = anchors.columns, anchors.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    cells = -(-zones.count() // ZONES)

    def start(rows: pd.DataFrame):
        return layout.matrix(list(rows["lo"])), layout.matrix(list(rows["hi"])), rows.reset_index(drop=True)

    def step(state, rows: pd.DataFrame) -> pd.DataFrame:
        lo, hi, zone = state
        which, block = np.nonzero(wanted(zone, rows, *bounds(layout.matrix(list(rows["vector"])), lo, hi)))
        return rows[names].iloc[which].assign(target=zone["zone"].to_numpy()[block])

    slices = F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))
    cell = F.pmod(F.xxhash64("block"), F.lit(max(cells, 1))).cast("int")
    held = zones.select(cell.alias("cell"), slices.alias("slice"), F.col("block").alias("zone"), "lo", "hi", "least_label", "most_label")
    passing = anchors.withColumns({"cell": F.explode(F.sequence(F.lit(0), F.lit(max(cells - 1, 0)))), "slice": F.pmod(F.xxhash64("block", "row"), F.lit(SLICES)).cast("int")})
    return streamed(held, passing, ["cell", "slice"], start, step, columns + ", target long")


def scored(reading: DataFrame, rows: DataFrame, layout: Layout, hits: Callable, most: int, schema: str) -> DataFrame:
    """The best ``most`` hits of each anchor in each block it reads.

    ``hits(state, rows, scores)`` yields (extra columns, mask) for each kind of hit.
    """

    def start(part: pd.DataFrame):
        part = part.sort_values(["vec_id", "row"], kind="stable").reset_index(drop=True)
        return part, layout.matrix(list(part["vector"]))

    def step(state, anchors: pd.DataFrame) -> pd.DataFrame:
        part, values = state
        scores = (layout.matrix(list(anchors["vector"])) @ values.T).astype(np.int64)
        out = []
        for extra, mask in hits(part, anchors, scores):
            one, other = np.nonzero(mask)
            score = scores[one, other]
            order = np.lexsort((other, -score, one))  # the block's rows are in the order of vec_id
            one, other, score = one[order], other[order], score[order]
            place = np.arange(len(one)) - np.searchsorted(one, one)
            one, other, score = (x[place < most] for x in (one, other, score))
            hit = part.iloc[other]
            out.append(pd.DataFrame({"block": anchors["block"].to_numpy()[one], "row": anchors["row"].to_numpy()[one], "anchor_id": anchors["vec_id"].to_numpy()[one],
                                     **{k: v[one] for k, v in extra.items()}, "found_block": hit["target"].to_numpy(), "found_row": hit["own_row"].to_numpy(),
                                     "found_id": hit["vec_id"].to_numpy(), "score": score}))
        return pd.concat(out)

    held = rows.select(F.col("block").alias("target"), F.col("row").alias("own_row"), "row", "vec_id", "label", "vector")
    held = held.join(reading.select("target").distinct(), "target", "left_semi")
    return streamed(held, reading, ["target"], start, step, schema)


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, label, embedding. Components become floor(scale * x), scores are inner products of these,
    higher ones come first, ties by smaller vec_id. Anchors are the rows whose vec_id ``every`` divides; an
    anchor's positives are its best other rows of its label, and for each its negatives are the best rows of
    other labels with low * positive_score <= 100 * negative_score <= high * positive_score. With fewer
    than asked for, all are returned; a positive without any negative has no row.

    Rows without an id, a label or a vector, or with a component that is null, NaN or infinite, take no part. Shorter
    vectors count as ending in zeros. Rows that repeat a vec_id are rows of their own, as anchors too. An empty table gives no
    rows; extra columns are ignored. Products that may exceed 56 bits are an error.
    """
    whole = stored(integral(vectors, scale), "integral")
    layout = Layout(whole)
    rows = stored(blocks(packed(whole, layout)), "blocks")
    zones = stored(zone_maps(rows, layout), "zones")
    anchors = rows.where(F.col("vec_id") % every == 0)

    found = "block long, row int, anchor_id long, {}found_block long, found_row int, found_id long, score long"
    best = [F.col("score").desc(), F.col("found_id"), F.col("found_block"), F.col("found_row")]
    held, asked = (lambda part, c: part[c].to_numpy()[None, :]), (lambda a, c: a[c].to_numpy()[:, None])

    def alike(part: pd.DataFrame, a: pd.DataFrame, scores: np.ndarray):
        itself = (asked(a, "block") == held(part, "target")) & (asked(a, "row") == held(part, "own_row"))
        yield {}, (asked(a, "label") == held(part, "label")) & ~itself & (scores >= asked(a, "reached"))

    # What an anchor's own block offers is a floor for its positives elsewhere.
    least = F.lit(-(1 << 62))
    at_home = scored(anchors.withColumns({"target": F.col("block"), "reached": least}), rows, layout, alike, positives, found.format(""))
    floors = at_home.groupBy("block", "row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("reached")).where(F.col("n") >= positives).drop("n")
    floored = anchors.join(floors, ["block", "row"], "left").withColumn("reached", F.coalesce("reached", least))

    def may_hold_positives(zone: pd.DataFrame, a: pd.DataFrame, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        label = asked(a, "label")
        return (held(zone, "least_label") <= label) & (label <= held(zone, "most_label")) & (most >= asked(a, "reached"))

    near = scored(chosen(stored(floored, "anchors"), zones, layout, may_hold_positives), rows, layout, alike, positives, found.format(""))
    ranked = near.withColumn("nth", F.row_number().over(Window.partitionBy("block", "row").orderBy(*best))).where(F.col("nth") <= positives)
    pairs = stored(ranked.select("block", "row", "nth", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    window = F.struct("nth", F.expr(f"{low} * positive_score").alias("low"), F.expr(f"{high} * positive_score").alias("high"))
    windows = pairs.where(f"{low} * positive_score <= {high} * positive_score").groupBy("block", "row").agg(F.sort_array(F.collect_list(window)).alias("w"))
    asking = anchors.join(windows, ["block", "row"]).select(*anchors.columns, F.col("w.nth").alias("nth"), F.col("w.low").alias("low"), F.col("w.high").alias("high"))

    def bands(a: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The k-th window of each anchor, an empty one where it has none."""
        for k in range(positives):
            yield tuple(np.array([x[k] if len(x) > k else none for x in a[c]])[:, None] for c, none in (("nth", 0), ("low", 1), ("high", 0)))

    def may_hold_negatives(zone: pd.DataFrame, a: pd.DataFrame, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        met = np.zeros(least.shape, dtype=bool)
        for _, lows, highs in bands(a):
            met |= (lows <= highs) & (100 * most >= lows) & (100 * least <= highs)
        return met & ((held(zone, "least_label") != asked(a, "label")) | (held(zone, "most_label") != asked(a, "label")))

    def unlike(part: pd.DataFrame, a: pd.DataFrame, scores: np.ndarray):
        apart = held(part, "label") != asked(a, "label")
        for nth, lows, highs in bands(a):
            yield {"nth": nth[:, 0]}, apart & (100 * scores >= lows) & (100 * scores <= highs)

    hard = scored(chosen(stored(asking, "asking"), zones, layout, may_hold_negatives), rows, layout, unlike, negatives, found.format("nth int, "))
    order = F.row_number().over(Window.partitionBy("block", "row", "nth").orderBy(*best))
    hard = hard.withColumn("rank", order).where(F.col("rank") <= negatives)
    return hard.join(pairs, ["block", "row", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
