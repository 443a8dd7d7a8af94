"""Documents whose sets of word n-grams have a high Jaccard similarity, by vertical partitions.

All n-grams are put in one global order: first those seen little, then common ones, by their hash within a class.
A document is its n-grams in that order, cut at fixed places of the order into one segment per fragment.
Two documents' overlap is counted fragment by fragment, each count by itself, and the partial counts are summed per pair.

Which pairs are counted: two sets as similar as asked share one of the first n - ceil(t * n) + 1 n-grams of each
(the rarest, in this order), sizes and positions permitting. Groups of copies are not expanded into pairs: of the documents that
share such an n-gram, and are of about a size, a few centres are held against the rest, what is linked by then is
skipped, more centres follow, and at last whatever is neither linked nor compared.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandfold.llm.bits import Filter, filter_of, filters_of
from strandfold.llm.collocations import LOWER, mixed, runs
from strandfold.llm.common import stored, text_key
from strandfold.llm.graph import components

#: Letters hashed at a time.
BLOCK = 1 << 18
#: Texts hashed at a time, if they are short.
ROWS = 256
#: N-grams among which a task looks for repeated ones.
GATHERED = 1 << 20
#: Repeats from which an n-gram counts as common, more common, and so on.
COMMON = tuple(4 ** k for k in range(2, 12))
#: Fragments of the n-grams that are not common; each common class is a fragment of its own.
FRAGMENTS = 8
#: Centres of each n-gram in the rounds after the first, which has one; what is left then is compared with all. Few at first: a
#: group not much larger than their number would be compared in full.
CENTRES = (4, 32)
#: Keys before an entry, of the same document, that are looked through for one where its pair is met already.
EARLIER = 64

BLANK = np.zeros(256, dtype=bool)
BLANK[[32, *range(9, 14)]] = True
GAP = re.compile(rb"[\x20\x09-\x0D]")


def hashed(data: bytes, shingle: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word n-grams; with fewer words, of the whole sequence."""
    found, held = [], np.empty(0, dtype=np.uint64)
    at = 0
    while at < len(data):
        gap = GAP.search(data, min(at + BLOCK, len(data)))  # words are not cut
        end = gap.start() if gap else len(data)
        text = LOWER[np.frombuffer(data[at:end], dtype=np.uint8)]
        edges = np.diff(np.r_[np.int8(0), (~BLANK[text]).view(np.int8), np.int8(0)])
        values = mixed(runs(text.astype(np.uint64) + np.uint64(1), np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)))
        values = np.concatenate([held, values])
        first = np.arange(max(len(values) - shingle + 1, 0))
        found.append(runs(values, first, first + shingle))
        held, at = values[len(first):], end
    if not any(map(len, found)) and len(held):
        found = [runs(held, np.array([0]), np.array([len(held)])) + np.uint64(shingle - len(held))]
    return np.unique(mixed(np.concatenate(found))) if found else np.empty(0, dtype=np.uint64)


def hashed_many(texts: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """``hashed`` of each text, short ones many at a time."""
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) < BLOCK:
            size, end = size + len(texts[end]), end + 1
        group, at = texts[at:end], end
        if len(group) == 1:
            yield hashed(group[0], shingle)
            continue
        text = LOWER[np.frombuffer(b"\n".join(group), dtype=np.uint8)]
        edges = np.diff(np.r_[np.int8(0), (~BLANK[text]).view(np.int8), np.int8(0)])
        starts = np.flatnonzero(edges == 1)
        values = mixed(runs(text.astype(np.uint64) + np.uint64(1), starts, np.flatnonzero(edges == -1)))
        begins = np.cumsum([0, *(len(x) + 1 for x in group)])
        words = np.searchsorted(starts, begins)
        first = np.arange(max(len(values) - shingle + 1, 0))
        grams = mixed(runs(values, first, first + shingle))
        for lo, hi in zip(words.tolist(), words[1:].tolist()):
            if hi - lo >= shingle:
                yield np.unique(grams[lo:hi - shingle + 1])
            elif hi > lo:
                yield mixed(runs(values[lo:hi], np.array([0]), np.array([hi - lo])) + np.uint64(shingle - (hi - lo)))
            else:
                yield np.empty(0, dtype=np.uint64)


def prefix_length(n: int, percent: int) -> int:
    """N-grams of which two similar sets share one for certain."""
    return n - -(-percent * n // 100) + 1 if n else 0


class Order:
    """The global order of n-grams, as far as one document needs it."""

    def __init__(self, common: list[Filter]):
        self.common = common

    def ordered(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes in the global order, and the class of each."""
        kind = np.zeros(len(found), dtype=np.int64)
        for level, known in enumerate(self.common):
            kind[known.has(found)] = level + 1
        order = np.argsort(kind, kind="stable")
        return found[order], kind[order]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_key("text").alias("node"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))


def repeated(docs: DataFrame, shingle: int) -> DataFrame:
    """(key, count) of n-grams that several documents of a task have, summed over the tasks: what is common, for the order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def counts() -> pd.DataFrame:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pd.DataFrame({"key": keys[n > 1].view(np.int64), "count": n[n > 1].astype(np.int64)})

        for pdf in batches:
            for grams in hashed_many(list(pdf["data"]), shingle):
                held.append(grams)
                size += len(grams)
                if size > GATHERED:
                    yield counts()
                    size = 0
        if held:
            yield counts()

    # As few tasks as there are cores: the more documents a task has, the more it sees repeated.
    few = _texts(docs).coalesce(docs.sparkSession.sparkContext.defaultParallelism)
    return few.mapInPandas(run, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))


def prefixes(docs: DataFrame, order: Order, shingle: int, percent: int) -> DataFrame:
    """(key, node) of the n-grams that stand first in each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                part = pdf.iloc[at:at + ROWS]
                found = [order.ordered(grams)[0] for grams in hashed_many(list(part["data"]), shingle)]
                found = [keys[:prefix_length(len(keys), percent)] for keys in found]
                yield pd.DataFrame({"key": np.concatenate(found).view(np.int64), "node": np.repeat(part["node"].to_numpy(), [len(k) for k in found])})

    return _texts(docs).mapInPandas(run, "key long, node long")


def records(docs: DataFrame, order: Order, shared: Filter, shingle: int, percent: int, fingerprint: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """(doc_id, node, n, fp, keys, places) of each row.

    fp is what ``fingerprint`` makes of the n-grams, zero without it; keys are the first n-grams that another document may have among its first, places where they stand; null if
    there are none, or where the same task has met a copy.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                part, rows = pdf.iloc[at:at + ROWS], []
                for node, found in zip(part["node"].tolist(), hashed_many(list(part["data"]), shingle)):
                    grams, _ = order.ordered(found)
                    first = grams[:prefix_length(len(grams), percent)]
                    places = np.flatnonzero(shared.has(first))
                    new = len(places) and node not in seen
                    fp = fingerprint(found) if fingerprint else 0
                    rows.append((len(grams), fp, first[places].view(np.int64) if new else None, places.astype(np.int32) if new else None))
                    if new:
                        seen.add(node)
                n, fp, keys, places = zip(*rows)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(dtype=object), "node": part["node"].to_numpy(), "n": n, "fp": fp, "keys": keys, "places": places})

    return _texts(docs).mapInPandas(run, "doc_id long, node long, n long, fp long, keys array<long>, places array<int>")


def segments(docs: DataFrame, nodes: Filter, order: Order, shingle: int) -> DataFrame:
    """(node, fragment, grams) of the texts that ``nodes`` lets through: their n-grams, cut where the global order is cut."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for pdf in batches:
            pdf = pdf[nodes.has(pdf["node"].to_numpy().view(np.uint64))]
            pdf = pdf[~pdf["node"].isin(seen)].drop_duplicates("node")
            seen.update(pdf["node"].tolist())
            for at in range(0, len(pdf), ROWS):
                rows = []
                for node, found in zip(pdf["node"].iloc[at:at + ROWS], hashed_many(list(pdf["data"].iloc[at:at + ROWS]), shingle)):
                    grams, kind = order.ordered(found)
                    fragment = np.where(kind == 0, (grams >> np.uint64(61)).astype(np.int64) * FRAGMENTS // 8, FRAGMENTS - 1 + kind)
                    cuts = [0, *(np.flatnonzero(np.diff(fragment)) + 1).tolist(), len(grams)]
                    rows += [(node, int(fragment[lo]), grams[lo:hi].view(np.int64)) for lo, hi in zip(cuts, cuts[1:]) if hi > lo]
                yield pd.DataFrame(rows, columns=["node", "fragment", "grams"])

    return _texts(docs).mapInPandas(run, "node long, fragment int, grams array<long>").dropDuplicates(["node", "fragment"])


def similar_pairs(pairs: DataFrame, pieces: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (a, b, n_a, n_b) whose partial overlaps sum up to enough."""
    mine = pairs.join(pieces.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("grams_b")), "b")
    met = mine.join(pieces.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("grams_a")), ["a", "fragment"])
    partial = met.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return summed.where(100 * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b") - F.col("overlap"))).select("a", "b")


def may_be_similar(pairs: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose first n-grams, counted as a fragment of their own, leave room for enough overlap.

    Of the two documents, the one whose first n-grams end earlier in the order has all else it can share behind them.
    """
    both = pairs.join(firsts.select(F.col("node").alias("a"), F.col("keys").alias("keys_a")), "a")
    both = both.join(firsts.select(F.col("node").alias("b"), F.col("keys").alias("keys_b")), "b")
    behind = F.floor((percent * F.greatest("n_a", "n_b") + 99) / 100) - 1
    room = F.size(F.array_intersect("keys_a", "keys_b")) + behind
    return both.where((100 + percent) * room >= percent * (F.col("n_a") + F.col("n_b"))).select(*pairs.columns)


def _may_link(percent: int, n_a: str, place_a: str, n_b: str, place_b: str) -> str:
    """Sizes allow it, and a shared n-gram may be the first: enough for the overlap stand from it on, in both."""
    first = " and ".join(f"{100 + percent} * ({n} - {place}) >= {percent} * ({n_a} + {n_b})" for n, place in ((n_a, place_a), (n_b, place_b)))
    return f"100 * least({n_a}, {n_b}) >= {percent} * greatest({n_a}, {n_b}) and {first}"


def global_order(docs: DataFrame, shingle: int) -> Order:
    """The order of all n-grams of the table: those seen little first."""
    often = stored(repeated(docs, shingle).where(F.col("count") >= COMMON[0]), "common")
    # An n-gram is in the filter of the highest class it reaches.
    level = sum(((F.col("count") >= least).cast("int") for least in COMMON), F.lit(-1))
    return Order(filters_of(often.select("key", level.alias("level")), len(COMMON)))


def stored_records(docs: DataFrame, order: Order, shingle: int, percent: int, fingerprint: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """``records`` as a table, once it is known which n-grams several documents have among their first."""
    ends = prefixes(docs, order, shingle, percent).groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = filter_of(stored(ends.where("lo <> hi").select("key"), "shared"))
    return stored(records(docs, order, shared, shingle, percent, fingerprint), "records")


def entries(firsts: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, place, turn, up): a document under each of its first n-grams and sizes that a partner may have.

    Sizes are cut into steps of the largest allowed ratio; a document is entered for its own step and the next, so
    that two of allowed sizes meet under the same key, for the next with the n-grams that can be the first in common with
    a partner of at least the own step's size. up is 1 for the next step, 0 for the own: two documents that both stand there for the
    next step are of one step and meet under its key as well, so only there need they be compared. turn says who is a centre first, the same for all n-grams, so that copies
    meet the same ones: the document with the fewest first n-grams of its own, as an original has among its copies.
    """
    ratio = 100 / percent * 1.0001
    step = F.floor(F.log("n") / math.log(ratio)) if percent < 100 else F.col("n")
    least = F.floor(F.pow(F.lit(ratio), F.col("own"))) - 1 if percent < 100 else F.col("n")
    length = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    own = F.floor(1000 * (1 - F.size("keys") / length)).cast("long")
    turn = F.shiftleft(own, 48) + F.shiftrightunsigned(F.xxhash64("node", F.lit(11)), 16)
    each = firsts.select("node", F.col("n").cast("int").alias("n"), turn.alias("turn"), F.explode(F.arrays_zip("keys", "places")).alias("e"), step.alias("own"))
    each = each.select("node", "n", "turn", F.col("e.keys").alias("gram"), F.col("e.places").alias("place"), "own", F.explode(F.array(F.lit(0), F.lit(1))).alias("up"))
    each = each.where((F.col("up") == 0) | ((100 + percent) * (F.col("n") - F.col("place")) >= percent * (F.col("n") + least)))
    return each.select(F.xxhash64("gram", F.col("own") + F.col("up")).alias("key"), "node", "n", "place", "turn", "up")


def _rows_of(docs: DataFrame, wanted: DataFrame, order: Order, shingle: int) -> DataFrame:
    """The segments of the documents in a stored table of nodes."""
    cut = segments(docs, filter_of(wanted, "node"), order, shingle)
    return stored(cut.join(wanted, "node", "left_semi"), "segments")


def links(docs: DataFrame, rows: DataFrame, order: Order, shingle: int, percent: int, prune: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
    """Links (a, b) that connect all that similar pairs connect; None if there are none.

    ``prune`` may drop candidate pairs before their n-grams are counted.
    """
    firsts = stored(rows.where("keys is not null").select("node", "n", "keys", "places").dropDuplicates(["node"]), "firsts")
    entered = entries(firsts, percent)
    # The first centre of each n-gram comes out of the aggregate that finds the n-grams with several documents.
    centre = F.min(F.struct("turn", "node", "n", "place")).alias("c")
    members = [F.bit_xor(F.xxhash64("node", "up", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    met = entered.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("up").alias("up"), centre, *members).where("rows > 1 and up = 0").drop("up")
    # Of n-grams with the same documents, told by two hashes, the first in the order stays: it comes first in each of them, and
    # whatever a pair has in common before it is under another key. A passage is one key so, not one for each n-gram.
    met = met.groupBy("rows", "x1", "x2").agg(F.min_by(F.struct("key", "c"), F.col("c.place")).alias("m")).select("rows", "m.key", "m.c")
    met = met.select("key", "rows", F.col("c.node").alias("a"), F.col("c.n").alias("n_a"), F.col("c.place").alias("place_a"))
    linkable = F.expr(_may_link(percent, "n_a", "place_a", "n", "place"))
    left = entered.join(met, "key").where("node <> a").withColumn("linkable", linkable).where("linkable or rows > 2")
    left = stored(left, "first")
    pairs = left.where("linkable").select("a", F.col("node").alias("b"), "n_a", F.col("n").alias("n_b")).distinct()
    left, roots = left.where("rows > 2").select("key", "node", "n", "place", "turn", "up"), None
    found = tested = have = pieces = None
    for centres in (*CENTRES, None, 0):
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        likely = may_be_similar(pairs, firsts, percent)
        likely = stored(prune(likely) if prune else likely, "likely")
        needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        needed = stored(needed if have is None else needed.join(have, "node", "left_anti"), "needed")
        cut = _rows_of(docs, needed, order, shingle)
        new = stored(similar_pairs(likely, cut if pieces is None else pieces.union(cut), percent), "links")
        if centres == 0:
            break
        # What is left: n-grams with documents that are neither linked nor all compared.
        roots = _centres_of(new) if found is None else components(found.union(new), "a", "b")
        rooted = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        still = _open_keys(rooted, members)
        rooted = stored(rooted.join(still, "key", "left_semi"), "open")
        if rooted.isEmpty():
            break
        have, pieces = (needed, cut) if have is None else (have.union(needed), pieces.union(cut))
        found = new if found is None else found.union(new)
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        chosen = rooted
        if centres:
            ranked = rooted.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("turn", "node")))
            chosen = stored(ranked.where(F.col("nth") <= centres).drop("nth"), "centres")
            left = rooted.drop("root").join(chosen.select("key", "node"), ["key", "node"], "left_anti")
        pairs = _candidates(chosen, rooted, percent).distinct()
    return new if found is None else found.union(new)


def _open_keys(rooted: DataFrame, members: Sequence[Column]) -> DataFrame:
    """Keys with documents to compare that are not linked; of those with the same documents left, the first in the order.

    Centres leave the keys round by round, so ever more keys of one crowd come to hold the same documents.
    """
    ends = [F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("up").alias("up"), F.count(F.lit(1)).alias("rows"), F.min(F.struct("node", "place")).alias("c")]
    found = rooted.groupBy("key").agg(*ends, *members).where("lo <> hi and up = 0")
    return found.groupBy("rows", "x1", "x2").agg(F.min_by("key", F.col("c.place")).alias("key")).select("key")


def _centres_of(stars: DataFrame) -> DataFrame:
    """(node, root) as the first round's links have it: a centre's documents are together, whatever else links them."""
    return stars.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def _candidates(chosen: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of a chosen document and one after it that it is not linked with, under a common key.

    Documents that share a passage have many keys in common: a pair is taken at the first, where it has the most room. Whoever
    comes first of the two is chosen wherever the other is, so its chosen keys tell where the pair is met.
    """
    later = "(a.turn < b.turn or a.turn = b.turn and a.node < b.node)"
    link = _may_link(percent, "a.n", "a.place", "b.n", "b.place")
    before = Window.partitionBy("node").orderBy("place", "up").rowsBetween(-EARLIER, -1)
    one, other = (df.withColumn("earlier", F.collect_list("key").over(before)) for df in (chosen, rooted))
    first = "a.up + b.up < 2 and not arrays_overlap(a.earlier, b.earlier)"
    met = one.alias("a").join(other.alias("b"), F.expr(f"a.key = b.key and a.root <> b.root and {later} and {link} and {first}"))
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))


def similar_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): groups of rows linked by the Jaccard similarity of their word n-grams.

    Two rows link if 100 * intersection >= ``percent`` * union of their sets of distinct n-grams, of words
    lower-cased in A-Z; a text of fewer words is one n-gram. component_id is the smallest doc_id in the group. Null, empty and
    blank texts have no n-grams, link with nothing and are a group each. Rows that repeat a doc_id or a text each
    get their row. A null doc_id becomes a component_id only where a group has no other. An empty table gives
    an empty result; extra columns are ignored. N-grams and texts are told apart by hashes of 64 bits.
    """
    order = global_order(docs, shingle)
    rows = stored_records(docs, order, shingle, percent)
    found = links(docs, rows, order, shingle, percent)
    least = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    if found is not None:
        least = least.join(components(found, "a", "b"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        groups = least.groupBy("root").agg(F.min("first_id").alias("component_id"))
        least = stored(least.join(groups, "root").select("node", "component_id"), "components")
    else:
        least = stored(least.withColumnRenamed("first_id", "component_id"), "components")
    named = rows.select("doc_id", "node", "n").join(least, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
