"""Phrases that stand together more often than their parts would by chance.

Rabin-Karp: the prefix sums of ``byte * BASE ** position`` give every word's hash as a difference of two
of them, and the prefix sums of the words' hashes give that of every run of words the same way, so all
n-grams of a block of text are hashed with a few array operations. Fingerprints are counted
per task, the counts are shuffled and summed. An n-gram can only be frequent if the shorter ones in it
are, so words are counted first, then pairs of frequent words, then longer runs of frequent pairs;
what is known to be frequent goes to the tasks as a bit filter of bounded size.

A fingerprint's sum is never below the count of any phrase that has it, since equal phrases have equal
fingerprints. So the frequent fingerprints hold all frequent phrases, and one last pass settles which those
are: each task keeps a pointer to one occurrence per frequent fingerprint of a block, compares all other
occurrences there with that one letter by letter, and writes out the text of the pointer
with the count; those are summed by text. Phrases whose fingerprints collide part there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandfold.llm.bits import Filter, filter_of
from strandfold.llm.common import stored

#: Letters handled at a time: some 50 bytes of arrays each.
BLOCK = 1 << 18
#: Fingerprints a task gathers before it hands them on.
GATHERED = 1 << 19
#: Phrases a task gathers before it hands them on.
PHRASES = 1 << 16
#: Bytes of text that a task cuts into blocks at a time.
JOINED = 1 << 22
#: Parts that a language's candidates are ranked in before the last ranking.
PARTS = 64

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
BETWEEN_WORDS, BETWEEN_PIECES = 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
KIND = np.zeros(256, dtype=np.uint8)
KIND[list(b" \t")] = BETWEEN_WORDS
KIND[list(b".,;:!?\n\x0b\x0c\r")] = BETWEEN_PIECES


class Powers:
    """Powers of the base and of its inverse modulo 2 ** 64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            size = 1 << n.bit_length()
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size, base, dtype=np.uint64)]) for base in (BASE, pow(BASE, -1, 1 << 64)))


POWERS = Powers()


def mixed(values: np.ndarray) -> np.ndarray:
    """Values spread over all 64 bits; one to one."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(33))


def runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial hash of each run of values, wherever it starts."""
    POWERS.reach(len(values))
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * POWERS.up[:len(values)], out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * POWERS.down[starts]


class Words:
    """The words of a block of text of one language, with the fingerprints of their n-grams.

    ``new`` is the first word that an earlier block has not had; n-grams belong to the block of their last word.
    """

    def __init__(self, text: bytes, lang: str, new: int):
        self.text = LOWER[np.frombuffer(text, dtype=np.uint8)]
        kind = KIND[self.text]
        edges = np.diff(np.r_[np.int8(0), (kind == 0).view(np.int8), np.int8(0)])
        self.starts, self.ends, self.new = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), new
        self.piece = np.cumsum(kind == BETWEEN_PIECES, dtype=np.int32)[self.starts]
        self.values = mixed(runs(self.text.astype(np.uint64) + np.uint64(1), self.starts, self.ends))
        self.lang = xxhash.xxh64_intdigest(lang.encode())

    def __len__(self) -> int:
        return len(self.starts)

    def grams(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the n-grams that lie within a piece and end in this block, and all n-grams' keys by first word."""
        count = max(len(self) - length + 1, 0)
        first = np.arange(count)
        keys = mixed(runs(self.values, first, first + length) + np.uint64((self.lang + length * BASE) & MASK))
        fits = self.piece[:count] == self.piece[length - 1:length - 1 + count]
        return fits, keys

    def own(self, length: int) -> np.ndarray:
        return np.arange(max(len(self) - length + 1, 0)) >= self.new - length + 1


def blocks(texts: list[bytes], lang: str, reach: int) -> Iterator[Words]:
    """Texts of one language as blocks of words; one that goes on in the middle of a piece brings the ``reach`` words before along."""
    whole = b"\n".join(texts)
    at = begin = new = 0
    while at < len(whole):
        end = _cut(whole, min(at + BLOCK, len(whole)), at)
        words = Words(whole[begin:end], lang, new)
        yield words
        new = min(reach, len(words))
        begin, at = begin + int(words.starts[-new]) if new else end, end


def _cut(whole: bytes, end: int, at: int) -> int:
    """The last gap between words before ``end``, else the first behind."""
    if end == len(whole):
        return end
    step = 1 << 16
    for low in range(end - step, at - step, -step):
        gaps = np.flatnonzero(KIND[np.frombuffer(whole[max(low, at):low + step], dtype=np.uint8)])
        if len(gaps) and max(low, at) + int(gaps[-1]) > at:
            return max(low, at) + int(gaps[-1])
    for low in range(end, len(whole), step):
        gaps = np.flatnonzero(KIND[np.frombuffer(whole[low:low + step], dtype=np.uint8)])
        if len(gaps):
            return low + int(gaps[0])
    return len(whole)


def _by_language(pdf: pd.DataFrame, reach: int) -> Iterator[tuple[str, Words]]:
    for lang, part in pdf.groupby("lang", sort=True):
        texts = part["data"].to_numpy()
        group = np.cumsum([len(t) for t in texts]) // JOINED
        for lo, hi in zip(*(x.tolist() for x in _spans(group))):
            for words in blocks(list(texts[lo:hi]), lang, reach):
                if len(words):
                    yield lang, words


def _spans(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values starts and ends."""
    cuts = np.flatnonzero(np.diff(group)) + 1
    return np.r_[0, cuts], np.r_[cuts, len(group)]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*found))
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)


def counted(docs: DataFrame, choose: Callable[[Words], Iterator[np.ndarray]], reach: int) -> DataFrame:
    """(key, count) of the fingerprints that ``choose`` takes from each block, summed per task as far as memory allows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for pdf in batches:
            for _, words in _by_language(pdf, reach):
                keys, counts = np.unique(np.concatenate(list(choose(words))), return_counts=True)
                held.append((keys, counts))
                if sum(len(k) for k, _ in held) > GATHERED:
                    held = [_summed(held)]
                    if len(held[0][0]) > GATHERED // 2:
                        yield pd.DataFrame({"key": held[0][0].view(np.int64), "count": held[0][1]})
                        held = []
        if held:
            keys, counts = _summed(held)
            yield pd.DataFrame({"key": keys.view(np.int64), "count": counts})

    return _texts(docs).mapInPandas(run, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))


def _frequent(counts: DataFrame, least: int, name: str) -> DataFrame:
    return stored(counts.where(F.col("count") >= least).select("key"), name)


def _same(words: Words, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether words are equal letter by letter."""
    lengths = words.ends[one] - words.starts[one]
    same = lengths == words.ends[other] - words.starts[other]
    at = np.flatnonzero(same)
    sizes = lengths[at]
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    differs = words.text[np.repeat(words.starts[one[at]], sizes) + within] != words.text[np.repeat(words.starts[other[at]], sizes) + within]
    same[at[np.repeat(np.arange(len(at)), sizes)[differs]]] = False
    return same


def _known(words: Words, hits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each word the first word of the block that is equal to it by letters; itself for those not in ``hits``."""
    known = np.arange(len(words))
    _, first, back = np.unique(keys[hits], return_index=True, return_inverse=True)
    lead = hits[first][back]
    same = _same(words, hits, lead)
    known[hits] = lead
    apart: dict[bytes, int] = {}
    for i in hits[~same].tolist():  # words whose fingerprints collide
        known[i] = apart.setdefault(words.text[words.starts[i]:words.ends[i]].tobytes(), i)
    return known


def frequent_in(words: Words, frequent: Filter, longest: int) -> Iterator[tuple[str, int, int]]:
    """(phrase, length, count) of a block's phrases whose fingerprint may be frequent, by text."""
    data = words.text.tobytes()
    text = lambda i, n: b" ".join([data[a:b] for a, b in zip(words.starts[i:i + n].tolist(), words.ends[i:i + n].tolist())]).decode("utf-8", "replace")
    known = np.empty(0, dtype=np.int64)
    for length in range(1, longest + 1):
        fits, keys = words.grams(length)
        fits &= frequent.has(keys)
        if length == 1:
            known = _known(words, np.flatnonzero(fits), keys)
        hits = np.flatnonzero(fits & words.own(length))
        if not len(hits):
            continue
        _, first, back, counts = np.unique(keys[hits], return_index=True, return_inverse=True, return_counts=True)
        lead = hits[first][back]
        same = np.ones(len(hits), dtype=bool)
        for k in range(length):
            same &= known[hits + k] == known[lead + k]
        apart = Counter(text(i, length) for i in hits[~same].tolist())  # collisions
        counts = counts - np.bincount(back[~same], minlength=len(counts))
        yield from ((text(i, length), length, n) for i, n in zip(hits[first].tolist(), counts.tolist()))
        yield from ((phrase, length, n) for phrase, n in apart.items())


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = 5) -> DataFrame:
    """(lang, phrase, length, f) of every phrase of up to ``longest`` words with f >= ``least``, by text.

    A row of length 0 has all word occurrences of its language, if there are any.
    """
    reach = longest - 1

    def single(words: Words) -> Iterator[np.ndarray]:
        yield words.grams(1)[1][words.new:]

    frequent = _frequent(counted(docs, single, reach), least, "frequent-words")
    of_words = filter_of(frequent)

    def pairs(words: Words) -> Iterator[np.ndarray]:
        often = of_words.has(words.grams(1)[1])
        fits, keys = words.grams(2)
        yield keys[fits & words.own(2) & often[:-1] & often[1:]]

    if longest > 1:
        of_two = _frequent(counted(docs, pairs, reach), least, "frequent-pairs")
        of_pairs, frequent = filter_of(of_two), frequent.union(of_two)

    def longer(words: Words) -> Iterator[np.ndarray]:
        fits, keys = words.grams(2)
        often = fits & of_pairs.has(keys)
        for length in range(3, longest + 1):
            fits, keys = words.grams(length)
            for k in range(length - 1):
                fits &= often[k:k + len(keys)]
            yield keys[fits & words.own(length)]

    if longest > 2:
        frequent = frequent.union(_frequent(counted(docs, longer, reach), least, "frequent-longer"))
    of_all = filter_of(frequent)

    def materialised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[tuple[str, str, int]] = Counter()

        def handed() -> pd.DataFrame:
            out = pd.DataFrame([(*k, n) for k, n in held.items()], columns=["lang", "phrase", "length", "f"])
            held.clear()
            return out

        for pdf in batches:
            for lang, words in _by_language(pdf, reach):
                held[lang, "", 0] += len(words) - words.new
                for phrase, length, n in frequent_in(words, of_all, longest):
                    held[lang, phrase, length] += n
                if len(held) > PHRASES:
                    yield handed()
        if held:
            yield handed()

    found = _texts(docs).mapInPandas(materialised, "lang string, phrase string, length int, f long")
    return found.groupBy("lang", "phrase", "length").agg(F.sum("f").alias("f")).where((F.col("length") == 0) | (F.col("f") >= least))


def _joined(words: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored_cuts(cuts: DataFrame) -> DataFrame:
    """The cuts with their score 1000 * a * n / (l * r), rounded down; products are decimals of 38 digits."""
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    products = cuts.withColumns({"above": wide["a"] * 1000 * wide["n"], "below": wide["l"] * wide["r"]})
    return products.withColumn("score", F.expr("above div below")).drop("above", "below")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two words or more.

    Texts are lower-cased in A-Z and split into pieces at ``.,;:!?`` and line ends, pieces into words at
    spaces and tabs. a, l and r count the phrase, its first part and its rest within pieces; n counts the language's
    words. The cut with the lowest score counts (ties: the shorter first part); score is
    1000 * a * n / (l * r), rounded down. A phrase inside a longer candidate that is as frequent is left out.
    A null text counts as empty, a null language as ``und``; rows that repeat an id or a text count each.
    An empty table, or one without frequent phrases, gives no rows. Extra columns are ignored.
    """
    counts = stored(phrase_counts(docs, least, longest), "phrases")
    candidates = counts.where("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("length") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("length") - m + 1), lambda i: _joined("words", i, m))))
    covered = candidates.where("length > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = candidates.join(covered, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")
    cuts = left.select("lang", "phrase", "a", "length", "words", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined("words", F.lit(1), F.col("k")).alias("first"), _joined("words", F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    part = lambda name, f: counts.where("length > 0").select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    totals = counts.where("length = 0").select("lang", F.col("f").alias("n"))
    scored = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    best = scored_cuts(scored).withColumn("cut", F.struct("score", "k", "a", "l", "r", "n")).groupBy("lang", "phrase").agg(F.min("cut").alias("cut")).select("lang", "phrase", "cut.*").drop("k")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # Ranked in parts first, so that a language's candidates do not all go through one task.
    parts = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
