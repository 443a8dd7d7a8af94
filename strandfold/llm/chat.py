"""Dialogues of several parties as training texts, once from each participant's point of view.

Whose turn it is, is the assistant; everybody else is a user with a name. The loss mask covers what
the assistant says. A conversation is rendered in parts of a bounded number of turns, which are
worked on apart, so a conversation of any length is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandfold.llm.common import stored

#: Turn numbers in a part, and rows of a part that a task renders together, unless said otherwise.
TURNS, ROWS = 64, 4096
#: Parts of a conversation whose running counts a task works out together.
BLOCK = 4096
#: Characters of what is said that the ranges of a large part are told apart by.
PREFIX = 1024
OPEN, CLOSE = "<|", "|>"
STOP = "<|end|>\n"
NOBODY = "unknown"


def _plain(text: Column) -> Column:
    """Without strings that could pass for the marks of the format."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit("< |")), F.lit(CLOSE), F.lit("| >"))


def perspectives(turns: DataFrame, speaker: str = "role", turns_per_part: int = TURNS, rows_per_piece: int = ROWS) -> DataFrame:
    """One row per conversation, part, piece and participant, in this order the dialogue as that participant's.

    (conv_id, part, piece, start, perspective, n_turns, text, mask): ``text`` has every turn as a header, the words and a
    stop mark; ``mask`` has the (start, end) in characters of what the assistant says, stop marks included, end exclusive.
    Every participant of the whole conversation gets all its parts, so masks may be empty. Turns are
    ordered by turn number, speaker and text, null numbers first. Null or empty speakers are ``unknown``; null texts
    are empty turns; repeated turns appear as often as they are there; a null conv_id is a
    conversation. A dialogue is cut into parts of ``turns_per_part`` turn numbers, and a part of more than
    ``rows_per_piece`` rows, which takes repeated turn numbers, into pieces of so many rows in that order; the last has the
    rest. Both may be as large as a task's memory allows: a dialogue within them is one text. So the texts of one
    participant, joined by part and piece, are the whole dialogue; ``start`` is how many of its turns come before. Null
    numbers are a part of their own, -1 or one below the lowest. The result has a row per part and participant, as
    asked for: many participants of one
    conversation make it large. An empty table gives an empty result; extra columns are ignored.
    """
    name = F.coalesce(F.nullif(F.trim(_plain(F.col(speaker))), F.lit("")), F.lit(NOBODY))
    said = turns.select("conv_id", F.floor(F.col("turn") / turns_per_part).cast("long").alias("part"), F.col("turn").cast("long").alias("turn"), name.alias("speaker"), _plain(F.col("text")).alias("said"))
    sizes = said.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.collect_set("speaker").alias("speakers"))
    sizes = stored(sizes, "parts")
    cast = sizes.select("conv_id", F.explode("speakers").alias("perspective")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("part").eqNullSafe(F.col("_part"))
    large = sizes.where(F.col("n") > rows_per_piece).select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"))
    turn = F.struct("turn", "speaker", "said")
    small = said.join(large, same, "left_anti").select("conv_id", "part", F.lit(0).cast("long").alias("piece"), turn.alias("t"), F.lit(1).alias("times"))
    dealt = small.union(_cut(said.join(large, same, "left_semi"), rows_per_piece).select("conv_id", "part", "piece", turn.alias("t"), "times"))
    listed = F.array_sort(F.collect_list(F.struct("t.turn", "t.speaker", "t.said", "times")))
    pieces = dealt.groupBy("conv_id", "part", "piece").agg(F.flatten(F.transform(listed, lambda t: F.array_repeat(t, t["times"]))).alias("turns"))
    placed = pieces.join(_starts(sizes), same).withColumns({"part": F.col("number"), "start": F.col("before") + F.col("piece") * rows_per_piece})
    seen = placed.select("conv_id", "part", "piece", "start", "turns").join(cast.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")))
    seen = seen.select("conv_id", "part", "piece", "start", "perspective", F.size("turns").alias("n_turns"), rendered(F.col("turns"), F.col("perspective")).alias("r"))
    return seen.select("conv_id", "part", "piece", "start", "perspective", "n_turns", "r.text", "r.mask")


def _cut(said: DataFrame, rows: int) -> DataFrame:
    """(conv_id, part, turn, speaker, said, piece, times): rows of large parts, dealt to pieces by their position.

    Repeated turns are counted before they move. A sort by ranges puts the rest in order; each range adds up
    its own counts, and a part's ranges, of which there are as many as partitions at most, are added up apart.
    """
    place = ["turn", "speaker", "said"]
    counted = said.groupBy("conv_id", "part", *place).agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange("conv_id", "part", "turn", "speaker", F.substring("said", 1, PREFIX))
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("conv_id", "part", "range").agg(F.sum("n").alias("n"))
    part = Window.partitionBy("conv_id", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("range").alias("_range"), F.coalesce(F.sum("n").over(part), F.lit(0)).alias("before"))
    own = Window.partitionBy("conv_id", "part", "range").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("within", F.coalesce(F.sum("n").over(own), F.lit(0)))
    met = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("part").eqNullSafe(F.col("_part")) & (F.col("range") == F.col("_range"))
    at = F.col("before") + F.col("within")
    placed = placed.join(sums, met).select("conv_id", "part", *place, at.alias("at"), (at + F.col("n")).alias("to"))
    placed = placed.select("*", F.explode(F.sequence(F.floor(F.col("at") / rows), F.floor((F.col("to") - 1) / rows))).alias("piece"))
    times = F.least("to", (F.col("piece") + 1) * rows) - F.greatest("at", F.col("piece") * rows)
    return placed.select("conv_id", "part", *place, F.col("piece").cast("long").alias("piece"), times.cast("int").alias("times"))


def _starts(sizes: DataFrame) -> DataFrame:
    """(_conv, _part, number, before): each part's number, and the turns of its conversation before it.

    Parts are added up in blocks, then the blocks, so that the longest conversation is no task's alone.
    """
    lowest = sizes.groupBy(F.col("conv_id").alias("_conv")).agg((F.least(F.min("part"), F.lit(0)) - 1).cast("long").alias("first"))
    parts = sizes.join(lowest, F.col("conv_id").eqNullSafe(F.col("_conv")))
    parts = parts.select("conv_id", "part", F.coalesce("part", "first").alias("number"), "n").withColumn("block", F.floor(F.col("number") / BLOCK))
    blocks = parts.groupBy(F.col("conv_id").alias("_id"), F.col("block").alias("_block")).agg(F.sum("n").alias("n"))
    earlier = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_id", "_block", F.coalesce(F.sum("n").over(earlier(["_id"], "_block")), F.lit(0)).alias("ahead"))
    parts = parts.withColumn("within", F.coalesce(F.sum("n").over(earlier(["conv_id", "block"], "number")), F.lit(0)))
    met = parts.join(blocks, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("block") == F.col("_block")))
    return met.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "number", (F.col("ahead") + F.col("within")).alias("before"))


def rendered(turns: Column, perspective: Column) -> Column:
    """The text and the masked spans of a part as one participant sees it."""
    own = lambda t: t["speaker"] == perspective
    head = lambda t: F.when(own(t), F.lit(f"{OPEN}assistant{CLOSE}\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), t["speaker"], F.lit(f"{CLOSE}\n")))
    pieces = F.transform(turns, lambda t: F.struct(own(t).alias("own"), head(t).alias("head"), F.concat(t["said"], F.lit(STOP)).alias("said")))
    kind = "array<struct<start:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("mask"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.char_length(p["head"])
        end = begin + F.char_length(p["said"])
        return F.struct(end.alias("at"), F.when(p["own"], F.array_append(acc["mask"], F.struct(begin.alias("start"), end.alias("end")))).otherwise(acc["mask"]).alias("mask"))

    return F.struct(
        F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["said"])), "").alias("text"),
        F.aggregate(pieces, start, step)["mask"].alias("mask"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query: masks as start:end, comma-joined."""
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return found.select("conv_id", "part", "piece", "start", "perspective", F.col("n_turns").cast("long").alias("n_turns"), "text", spans.alias("mask"))
