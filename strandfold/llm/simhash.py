"""Near duplicates by SimHash, with pigeonring pruning in front of the Hamming check.

Fingerprints are cut into ``segments`` pieces on a ring. If two of them differ in at
most ``distance`` bits, then somewhere on the ring starts a chain of segments whose
differences, summed over its first l segments, stay within ``l * distance / segments``
for every l. The first segments of such a chain, as far as that budget is below one,
are equal: they are the join key. Fingerprints that share a key go on along
the chain; only those that stay within the budget get the full Hamming check.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandfold.llm import overlap
from strandfold.llm.common import stored, text_key, without
from strandfold.llm.graph import components

BITS = 64
SEED = 42
#: Shingles hashed at a time, so that very long texts need no more memory than others.
BLOCK = 1 << 15
#: Rows of one key that a task compares; a key with more is cut into pairs of tiles.
TILE = 1024
#: Share of the pairs right at the similarity that the Hamming check in front of the verification may lose, at most.
LOSS = 1e-6
#: Unions of shingles up to this size have the chance of a differing bit worked out; larger ones are below the smallest.
COUNTED = 64


def hashes(data: bytes | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle, repeats included, block by block."""
    words = (data or b"").lower().split()
    if words:
        parts = zip(*(islice(words, k, None) for k in range(shingle))) if len(words) >= shingle else iter([words])
        shingles = map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(SEED))
        while len(block := np.fromiter(islice(shingles, BLOCK), dtype=np.uint64)):
            yield block


def majority(blocks: Iterable[np.ndarray]) -> int:
    """The bits that over half of the hashes have, as a signed long; zero without hashes."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for block in blocks:
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint(data: bytes | None, shingle: int) -> int:
    """The fingerprint of a text's word shingles, repeats included."""
    return majority(hashes(data, shingle))


def set_fingerprint(grams: np.ndarray) -> int:
    """The fingerprint of a set of hashes."""
    return majority(grams[at:at + BLOCK] for at in range(0, len(grams), BLOCK))


def _flips(shared: int, left: int, right: int) -> float:
    """The chance that a bit differs between sets with so many shingles in common and on one side only."""
    pmf = lambda n: np.array([math.comb(n, k) for k in range(n + 1)], dtype=float) / 2.0**n
    ones = np.arange(shared + 1)[:, None]
    one, other = ((pmf(n) * (2 * (ones + np.arange(n + 1)) > shared + n)).sum(axis=1) for n in (left, right))
    return float((pmf(shared) * (one * (1 - other) + other * (1 - one))).sum())


@lru_cache
def bit_budget(similarity: float, loss: float = LOSS) -> int:
    """Differing bits that at most ``loss`` of the pairs of sets with at least that Jaccard similarity exceed.

    Bits differ independently, each with the angle's chance if the sets are large; small sets, where one
    shingle can tip a majority or a tie, have more, so the worst chance over all small sets counts.
    """
    chance = float(np.arccos(min(1.0, 2 * similarity / (1 + similarity))) / np.pi)
    for union in range(1, COUNTED + 1):
        apart = int((1 - similarity) * union + 1e-9)
        chance = max(chance, *(_flips(union - apart, k, apart - k) for k in range(apart // 2 + 1)), 0.0)
    tail, bits = 0.0, BITS
    while bits and (tail := tail + math.comb(BITS, bits) * chance**bits * (1 - chance) ** (BITS - bits)) <= loss:
        bits -= 1
    return bits


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_key, fp) of each row; a null text counts as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = np.array([fingerprint(data, shingle) for data in pdf["data"]], dtype=np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_key": pdf["text_key"], "fp": found})

    rows = docs.select("doc_id", text_key("text").alias("text_key"), F.col("text").cast("binary").alias("data"))
    return rows.mapInPandas(run, "doc_id long, text_key long, fp long")


def ring_masks(segments: int, length: int) -> list[int]:
    """The bits of ``length`` consecutive segments, for each start on the ring."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    single = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(segments)]
    return [sum(single[(i + k) % segments] for k in range(length)) for i in range(segments)]


def chained(diff: np.ndarray, distance: int, segments: int) -> np.ndarray:
    """Where some chain of the ring stays within its share of the budget at every length."""
    singles = np.array(ring_masks(segments, 1), dtype=np.uint64)
    per = np.bitwise_count(diff[:, None] & singles).astype(np.int16)
    budget = distance * np.arange(1, segments + 1) // segments
    fits = np.zeros(len(diff), dtype=bool)
    for start in range(segments):
        fits |= (np.cumsum(np.roll(per, -start, axis=1), axis=1) <= budget).all(axis=1)
    return fits


def close(one: np.uint64, many: np.ndarray, distance: int, segments: int) -> np.ndarray:
    """Positions in ``many`` within the distance: chain filter first, full check on what is left."""
    diff = many ^ one
    left = np.flatnonzero(chained(diff, distance, segments))
    return left[np.bitwise_count(diff[left]) <= distance]


def forest(nodes: np.ndarray, fps: np.ndarray, distance: int, segments: int) -> Iterator[tuple[int, int]]:
    """(member, root) for the groups among the nodes of one key: a link less than members."""
    rest = np.arange(len(nodes))
    while len(rest) > 1:
        root, rest, queue = rest[0], rest[1:], [rest[0]]
        while queue and len(rest):
            node = queue.pop()
            hits = close(fps[node], fps[rest], distance, segments)
            if len(hits):
                yield from ((int(nodes[i]), int(nodes[root])) for i in rest[hits])
                queue.extend(rest[hits])
                rest = np.delete(rest, hits)


def shared_keys(keyed: DataFrame) -> DataFrame:
    """(slot, key, node, fp, lo, hi) of keys with more than one node: what a task is to compare.

    A key with more than TILE nodes is cut into tiles, and every pair of tiles becomes a task's work of its
    own, so that no group lands in one task, whatever its size. Keys with the same nodes, told by two hashes
    of 64 bits, would compare the same pairs: one of them stays.
    """
    members = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    counts = keyed.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n"), *members).where("n > 1")
    counts = counts.groupBy("n", "x1", "x2").agg(F.min(F.struct("slot", "key")).alias("first"))
    counts = stored(counts.select("first.slot", "first.key", "n"), "keys")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(7)), tiles).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), tiles - 1), lambda j: F.struct(F.least(own, j).alias("lo"), F.greatest(own, j).alias("hi")))
    return keyed.join(counts, ["slot", "key"]).select("slot", "key", "node", "fp", F.inline(pairs))


def links(dealt: DataFrame, distance: int, segments: int) -> DataFrame:
    """Links (a, b) between the nodes that share a key; each task writes spanning forests, never all pairs."""
    names = ["slot", "key", "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            marks = pdf[names].to_numpy()
            starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
            held = pdf.iloc[starts[-1]:]
            yield grouped(pdf, starts)
        if held is not None:
            yield grouped(held, np.array([0, len(held)]))

    def grouped(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        nodes, fps, found = pdf["node"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), []
        for lo, hi in zip(starts[:-1], starts[1:]):
            found += forest(nodes[lo:hi], fps[lo:hi], distance, segments)
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return dealt.repartition(*names).sortWithinPartitions(*names, "node").mapInPandas(run, "a long, b long").distinct()


def close_pairs(pairs: DataFrame, prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """The pairs (a, b) whose fingerprints pass the ring and then the Hamming check."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            diff = (pdf["fp_a"] ^ pdf["fp_b"]).to_numpy().view(np.uint64)
            left = np.flatnonzero(chained(diff, distance, segments))
            yield pdf.iloc[left[np.bitwise_count(diff[left]) <= distance]].drop(columns=["fp_a", "fp_b"])

    both = pairs.join(prints.select(F.col("node").alias("a"), F.col("fp").alias("fp_a")), "a")
    both = both.join(prints.select(F.col("node").alias("b"), F.col("fp").alias("fp_b")), "b")
    return both.select(*pairs.columns, "fp_a", "fp_b").mapInPandas(run, pairs.schema)


def fingerprint_groups(docs: DataFrame, shingle: int = 3, distance: int = 2, segments: int = 7) -> DataFrame:
    """(doc_id, text_key, fp, component_id): groups of rows whose fingerprints are linked.

    Every pair within the distance has its key in common somewhere on the ring, so no link is missed.
    component_id is the smallest doc_id in the group. Null texts count as empty; texts without
    words have fingerprint zero and link like any other. Rows that repeat a doc_id or a text each get
    their row. A null doc_id never becomes a component_id unless the group has no other. An
    empty table gives an empty result; extra columns are ignored.
    """
    exact = (segments - 1) // distance if distance else segments
    if exact < 1:
        raise ValueError("more segments than differing bits are needed")
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in ring_masks(segments, exact)]
    slots = F.array(*(F.struct(F.lit(i).alias("slot"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)))
    keyed = prints.select("fp").distinct().select(F.col("fp").alias("node"), "fp", F.inline(slots))
    return _named(prints, "fp", links(shared_keys(keyed), distance, segments))


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, text_key, fp, component_id): groups of rows linked by their shingles' Jaccard similarity.

    At 0.8, fingerprints of 64 bits differ in about ten: segments that such a pair must share are too short to
    tell texts apart. Candidates are therefore texts that share one of their rarest shingles, of which
    similar sets share one for certain, held against a few centres at a time (see ``overlap.links``). The ring and the
    Hamming check prune them at ``bit_budget``, on fingerprints of the distinct shingles (at most LOSS of the
    pairs), and what is left is verified on the shingles: only these pairs' sets are ever moved. A passage that
    many texts share is not rare, so it brings no texts together that are not alike. Repeated lines count once
    throughout. The similarity is taken in hundredths. Cases as for fingerprint_groups; all texts without words are
    one group. Texts and shingles are told apart by hashes of 64 bits.
    """
    percent = round(100 * similarity)
    distance = bit_budget(similarity)
    order = overlap.global_order(docs, shingle)
    rows = overlap.stored_records(docs, order, shingle, percent, set_fingerprint)
    prints = stored(rows.where("keys is not null").select("node", "fp").dropDuplicates(["node"]), "fingerprints")
    found = overlap.links(docs, rows, order, shingle, percent, lambda pairs: close_pairs(pairs, prints, distance, 4))
    rows = rows.select("doc_id", F.col("node").alias("text_key"), "fp", F.when(F.col("n") == 0, 0).otherwise(F.col("node")).alias("group"))
    return _named(rows, "group", found)


def _named(prints: DataFrame, node: str, found: DataFrame | None) -> DataFrame:
    """The rows with the smallest doc_id of what their node is linked to."""
    first = prints.groupBy(F.col(node).alias("node")).agg(F.min("doc_id").alias("first_id"))
    rooted = first.withColumn("root", F.col("node"))
    if found is not None:
        roots = components(stored(found, "links"), "a", "b")
        rooted = first.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(rooted.join(least, "root").select(F.col("node").alias(node), "component_id"), "components")
    return prints.join(named, node).select("doc_id", "text_key", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, one of each group of near duplicates: that with the smallest doc_id.

    Rows that repeat the smallest doc_id, or have no doc_id in a group without any, all stay. ``docs`` may have
    columns of any name beside its own.
    """
    groups = near_duplicates(docs, shingle, similarity)
    return without(docs, groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))
