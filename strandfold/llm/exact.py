"""Exact duplicates by polynomial fingerprints that combine from hashes of chunks.

The hash of bytes b0..bn-1 is the sum of b[i] * BASE ** (n - 1 - i) modulo a prime, so
H(xy) = H(x) * BASE ** len(y) + H(y): the hash of what came before is shifted by a chunk's length and the
chunk's own hash is added. Every chunk is a row, hashed by itself; those of huge documents are dealt out to all tasks
first. A grouped aggregate folds a document's chunk hashes, 40 bytes each, into the hash of the whole.
Texts whose fingerprints and lengths agree are then compared chunk by chunk with the first of their group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandfold.llm.common import stored, text_key, without

#: Two primes below 2 ** 31: a byte times a power, summed over a chunk, fits 64 bits.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)
#: Characters of a chunk, and the bytes these take at most.
CHUNK, WIDEST = 1 << 16, 4
#: Characters from which a document's chunks are dealt out.
HUGE = 1 << 22


class Polynomial:
    """Hashes of chunks under one prime, and their combination."""

    def __init__(self, prime: int, base: int):
        self.prime, self.base = prime, base
        powers = [1]
        for _ in range(CHUNK * WIDEST):
            powers.append(powers[-1] * base % prime)
        self.powers = np.array(powers[::-1], dtype=np.uint64)

    def chunk(self, data: bytes) -> int:
        values = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
        return int(np.dot(values, self.powers[len(self.powers) - len(values):])) % self.prime

    def shift(self, length: int) -> int:
        """What the hash of all before is multiplied by."""
        return int(self.powers[len(self.powers) - 1 - length])


def plain(text: Column) -> Column:
    """Every run of blanks as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def pieces(text: Column) -> Column:
    """The text in chunks of CHUNK characters, in one pass over it; an empty text is one empty chunk."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def chunk_hashes(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """(doc_id, text_key, text_sha256, part, hash_0, shift_0, hash_1, shift_1, n_bytes): each chunk of each row, hashed by itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = [Polynomial(p, b) for p, b in zip(primes, BASES)]
        for pdf in batches:
            data = list(pdf["piece"])
            out = pdf.drop(columns="piece")
            for k, kind in enumerate(kinds):
                out[f"hash_{k}"] = [kind.chunk(x) for x in data]
                out[f"shift_{k}"] = [kind.shift(len(x)) for x in data]
            out["n_bytes"] = [len(x) for x in data]
            yield out

    texts = docs.select("doc_id", text_key("text").alias("text_key"), plain(F.col("text")).alias("plain"))
    texts = texts.withColumn("text_sha256", F.sha2(F.col("plain").cast("binary"), 256))

    def cut(rows: DataFrame) -> DataFrame:
        parts = rows.select("doc_id", "text_key", "text_sha256", F.posexplode(pieces(F.col("plain"))).alias("part", "piece"))
        return parts.withColumn("piece", F.col("piece").cast("binary"))

    huge = F.char_length("plain") > HUGE
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(texts.where(huge)).repartition(tasks, "text_key", "part")
    hashes = "part int, hash_0 long, shift_0 long, hash_1 long, shift_1 long, n_bytes long"
    schema = f"doc_id long, text_key long, text_sha256 string, {hashes}"
    return cut(texts.where(~huge)).mapInPandas(run, schema).union(dealt.mapInPandas(run, schema))


def fingerprints(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """(doc_id, text_key, fp, n_bytes, text_sha256) of each row, of its normalised text.

    The chunks of rows that repeat an id and a text are the same, so each counts once; how often there is
    a first one says how many rows there are.
    """
    chunk = F.struct("part", "hash_0", "shift_0", "hash_1", "shift_1", "n_bytes")
    rows = chunk_hashes(docs, primes).groupBy("doc_id", "text_key", "text_sha256").agg(
        F.array_sort(F.collect_set(chunk)).alias("chunks"), F.count_if(F.col("part") == 0).alias("copies"))

    def joined(acc: Column, c: Column, k: int) -> Column:
        return ((acc[f"hash_{k}"] * c[f"shift_{k}"] + c[f"hash_{k}"]) % F.lit(primes[k])).alias(f"hash_{k}")

    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("hash_0"), zero.alias("hash_1"), zero.alias("n_bytes"))
    whole = F.aggregate("chunks", start, lambda acc, c: F.struct(joined(acc, c, 0), joined(acc, c, 1), (acc["n_bytes"] + c["n_bytes"]).alias("n_bytes")))
    rows = rows.select("doc_id", "text_key", "text_sha256", "copies", whole.alias("whole"))
    fp = F.shiftleft("whole.hash_0", 31).bitwiseOR(F.col("whole.hash_1"))
    each = rows.select("doc_id", "text_key", fp.alias("fp"), F.col("whole.n_bytes").alias("n_bytes"), "text_sha256", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return each.drop("copy")


def duplicates(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after every run of blanks became one space; null counts as
    empty. keep_id is the smallest doc_id with an equal text, and the row that has it is
    kept; rows that repeat that doc_id with an equal text are all kept, for nothing tells them apart.
    Rows without a doc_id go if an equal text has one, else keep_id is null and they stay. An empty
    table gives an empty result; extra columns are ignored.
    """
    prints = stored(fingerprints(docs, primes), "fingerprints")
    group = ["fp", "n_bytes"]
    groups = prints.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("doc_id", "text_key")).alias("first"))
    groups = stored(groups.where("rows > 1").select(*group, F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key")), "groups")
    differing = stored(_differing(docs, prints, groups), "differing")

    # A text that differs from the first of its fingerprint is a group by its digest.
    known = prints.join(differing, [*group, "text_sha256"], "left")
    known = known.withColumn("apart", F.when(F.col("differs"), F.col("text_sha256")).otherwise(""))
    named = known.groupBy(*group, "apart").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    named = stored(named, "named")
    return known.join(named, [*group, "apart"]).select(
        "doc_id", "text_key", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _differing(docs: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """(fp, n_bytes, text_sha256, differs) of texts that are not the first of their fingerprint.

    Each member of a group goes chunk by chunk against the same chunk of the first text.
    A group of any size is split among tasks, for it meets just one row of the other side.
    """
    first = groups.select("first_id", "first_key", *groups.columns[:2])
    members = prints.join(groups.select("fp", "n_bytes"), ["fp", "n_bytes"]).select("doc_id", "text_key", "fp", "n_bytes", "text_sha256").distinct()
    texts = docs.select(F.col("doc_id").alias("_id"), text_key("text").alias("_key"), plain(F.col("text")).alias("plain"))
    same_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    parts = texts.join(members, same_row).select("fp", "n_bytes", "text_sha256", "doc_id", "text_key", F.posexplode(pieces(F.col("plain"))).alias("part", "piece"))
    parts = stored(parts, "pieces")
    lead = first.join(parts, F.col("first_id").eqNullSafe(F.col("doc_id")) & (F.col("first_key") == F.col("text_key")) & (first["fp"] == parts["fp"]))
    lead = lead.select(parts["fp"], parts["n_bytes"], "part", F.col("piece").alias("lead")).dropDuplicates(["fp", "n_bytes", "part"])
    lead = stored(lead, "leads")
    met = parts.join(lead, ["fp", "n_bytes", "part"], "left").where("lead is null or piece <> lead")
    return met.select("fp", "n_bytes", "text_sha256").distinct().withColumn("differs", F.lit(True))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts, the row with the smallest doc_id."""
    return without(docs, duplicates(docs).where(~F.col("kept")))
