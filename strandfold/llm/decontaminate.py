"""Benchmark items inside long documents, by size-partitioned MinHash containment search.

An item's sketch is some of its shingle hashes. Similarity of whole sets says
little where the document is a hundred times longer than the item, so items are partitioned by
their number of shingles, and each partition has the sketch length that its containment
threshold needs: with q shingles, at least ceil(t q) of them in the document, and a sketch
of q - ceil(t q) + 1, one of the sketch is in the document for certain; the largest q of the partition counts. The
sketch takes the shingles that the fewest items have, by hash among equals: a stock phrase of many items is no
probe while they have others. Documents with a hash of the sketch are verified on the shingles themselves. Items of fewer words
than a shingle are partitions of their own, by their number of words, with shingles of that length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandfold.llm.common import lower_ascii, stored, text_key, without, words

#: A sketch table of at most so many rows (16 bytes each) goes to every task; a larger one is shuffled.
BROADCAST_ROWS = 1 << 20


def _starts(found: Column, shingle: int | Column) -> Column:
    """Where shingles start; a text with fewer words has none."""
    return F.when(F.size(found) >= shingle, F.sequence(F.lit(0), F.size(found) - shingle)).otherwise(F.array().cast("array<int>"))


def with_words(rows: DataFrame) -> DataFrame:
    """Adds ``words``, a column of its own: a lambda would split the text again for every element."""
    return rows.withColumn("words", words(lower_ascii(F.coalesce("text", F.lit("")))))


def shingles(found: Column, shingle: int | Column) -> Column:
    length = F.lit(shingle) if isinstance(shingle, int) else shingle
    return F.array_distinct(F.transform(_starts(found, shingle), lambda i: F.array_join(F.slice(found, i + 1, length), " ")))


def hashed(found: Column, shingle: int) -> Column:
    """One long per shingle of an array of words, without building the shingles."""
    return F.transform(_starts(found, shingle), lambda i: F.xxhash64(*(F.get(found, i + k) for k in range(shingle))))


def tested_items(items: DataFrame, shingle: int) -> DataFrame:
    """(item_key, words, width) of the distinct items that have words; width is the length of their shingles."""
    found = with_words(items.select("text")).select(text_key("text").alias("item_key"), "words")
    return found.where(F.size("words") > 0).dropDuplicates(["item_key"]).withColumn("width", F.least(F.size("words"), F.lit(shingle)))


def sketches(tested: DataFrame, widths: list[int], threshold: float) -> DataFrame:
    """(item_key, width, n_shingles, size_class, sketch): a sketch that misses no document, by size partition.

    size_class is the power of two that the item's number of shingles reaches; all items of one
    have a sketch of the same length, and all documents it can match have at least ``threshold`` times its smallest size.
    """
    own = F.coalesce(*(F.when(F.col("width") == k, hashed(F.col("words"), k)) for k in widths))
    found = tested.select("item_key", "width", F.array_distinct(own).alias("hashes"))
    single = found.select("item_key", F.explode("hashes").alias("hash"))
    had = single.groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    rare = single.join(had, "hash").groupBy("item_key").agg(F.array_sort(F.collect_list(F.struct("items", "hash"))).alias("rare"))
    n, size_class = F.size("hashes"), F.floor(F.log2(F.size("hashes").cast("double"))).cast("int")
    largest = F.call_function("shiftleft", F.lit(2), F.col("size_class")) - 1
    length = largest - F.ceil(F.lit(threshold) * largest - 1e-9).cast("int") + 1
    classed = found.select("item_key", "width", n.alias("n_shingles"), size_class.alias("size_class")).join(rare, "item_key")
    return classed.select("item_key", "width", "n_shingles", "size_class", F.transform(F.slice("rare", F.lit(1), length), lambda r: r["hash"]).alias("sketch"))


def contained(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, text_key, item_id, n_shingles, n_shared, containment) of items inside documents.

    Containment is the share of an item's distinct word shingles (ASCII letters in lower case) that
    the document has. The shingles of an item with fewer words than a shingle are as long as the item, so
    it is found wherever its words stand together. Null or empty texts contain nothing and are contained nowhere. Rows that
    repeat a doc_id with another text are searched each; repeated rows give one result. Null ids
    are kept as ids. Empty tables give an empty result; extra columns are ignored.
    """
    tested = stored(tested_items(items, shingle), "items")
    widths = sorted(r.width for r in tested.select("width").distinct().collect())  # at most ``shingle`` of them
    sketch = stored(sketches(tested, widths or [shingle], threshold), "sketches")
    probes = sketch.select("item_key", "width", (F.lit(threshold) * F.call_function("shiftleft", F.lit(1), F.col("size_class"))).alias("least"), F.explode("sketch").alias("hash"))
    probes = stored(probes, "probes")
    if probes.count() <= BROADCAST_ROWS:
        probes = F.broadcast(probes)
    found = with_words(docs.select("doc_id", "text")).select("doc_id", text_key("text").alias("text_key"), "words")
    # A document has shingles of each length that some item has; with fewer words, none of it.
    hashes = F.flatten(F.array(*(F.when(F.size("words") >= k, hashed(F.col("words"), k)).otherwise(F.array().cast("array<bigint>")) for k in widths or [shingle])))
    found = found.select("doc_id", "text_key", F.size("words").alias("n_words"), F.explode(hashes).alias("hash"))
    pairs = found.join(probes, "hash").where("n_words >= least - 1e-9").select("doc_id", "text_key", "item_key", "width").distinct()
    pairs = stored(pairs, "candidates")

    texts = docs.select(F.col("doc_id").alias("_id"), text_key("text").alias("_key"), "text")
    near = texts.join(pairs.select("doc_id", "text_key", "width").distinct(), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    near = with_words(near).select("doc_id", "text_key", "width", shingles(F.col("words"), F.col("width")).alias("doc_shingles")).dropDuplicates(["doc_id", "text_key", "width"])
    asked = tested.select(F.col("item_key").alias("_item_key"), shingles(F.col("words"), F.col("width")).alias("item_shingles"))
    with_item = pairs.join(asked, F.col("item_key") == F.col("_item_key")).select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_doc_key"), F.col("width").alias("_width"), "item_key", "item_shingles")
    met = with_item.join(near, F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_doc_key") == F.col("text_key")) & (F.col("_width") == F.col("width")))
    shared = F.size(F.array_intersect("doc_shingles", "item_shingles"))
    met = met.select("doc_id", "text_key", "item_key", F.size("item_shingles").alias("n_shingles"), shared.alias("n_shared"))
    met = met.where(F.col("n_shared") >= F.ceil(F.lit(threshold) * F.col("n_shingles") - 1e-9)).withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    ids = items.select("item_id", text_key("text").alias("item_key")).distinct()
    return met.join(ids, "item_key").select("doc_id", "text_key", "item_id", "n_shingles", "n_shared", "containment").distinct()


def clean(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    return without(docs, contained(docs, items, shingle, threshold))
