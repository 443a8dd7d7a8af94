"""The n-gram join, the hard negatives and the phrases against plain versions."""

from __future__ import annotations

import collections
import random
import re

import brute
import numpy as np
import pandas as pd
import pytest
from brute import prose, texts

from strandfold.llm import bits, collocations, negatives, overlap

ROWS = texts()


def by_row(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# --- the bit filter ----------------------------------------------------------------------------------


@pytest.mark.parametrize("most", (1 << 16, 1 << 20))
def test_filter_never_says_no_wrongly(spark, most):
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), 1 << 63, 20_000)
    table = spark.createDataFrame([(int(k),) for k in keys], "key long")
    found = bits.filter_of(table, most_bits=most)
    assert len(found.bits) * 8 <= most and found.has(keys.view(np.uint64)).all()
    others = rng.integers(-(1 << 63), 1 << 63, 20_000).view(np.uint64)
    assert most < 1 << 20 or found.has(others).mean() < 0.1
    assert not bits.filter_of(table.limit(0)).has(others).any()
    two = bits.filters_of(table.selectExpr("key", "CAST(abs(key) % 2 AS int) AS level"), 3, most_bits=most)
    for level in (0, 1):
        assert two[level].has(keys[np.abs(keys) % 2 == level].view(np.uint64)).all()
    assert len(two) == 3 and not two[2].has(others).any()


# --- n-gram Jaccard join -----------------------------------------------------------------------------


def jaccard_groups(rows):
    sets = [brute.shingles(t) for _, t in rows]
    tops = brute.groups(sets, lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b))
    first = {top: min((i for (i, _), t in zip(rows, tops) if t == top and i is not None), default=None) for top in tops}
    return sorted(((i, len(s), first[top] if s else i) for (i, _), s, top in zip(rows, sets, tops)), key=str)


def test_similar_groups(docs, no_docs):
    assert by_row(overlap.similar_groups(docs), "doc_id", "n_shingles", "component_id") == jaccard_groups(ROWS)
    assert overlap.similar_groups(no_docs).count() == 0


@pytest.mark.parametrize("common, centres", (((16, 1024), (32,)), ((2, 4), ()), ((2, 8, 20), (1, 2))))
def test_similar_groups_of_many_copies(spark, monkeypatch, common, centres):
    """Chains and stars of near copies, passages that many share, one text over several blocks, few and many centres."""
    monkeypatch.setattr(overlap, "COMMON", common)
    monkeypatch.setattr(overlap, "CENTRES", centres)
    monkeypatch.setattr(overlap, "BLOCK", 1 << 10)
    rng, rows = random.Random(4), []
    footer = prose(900, 30)
    for group in range(4):
        words = prose(910 + group, 60 + 40 * group).split(" ")
        for k in range(14):  # each copy changes the one before, so that the ends differ by far
            if k:
                words[rng.randrange(len(words))] = f"new{group}x{k}"
            rows.append((len(rows), " ".join(words)))
        base = list(words)
        for k in range(10):
            changed = list(base)
            for at in rng.sample(range(len(base)), 2):
                changed[at] = f"other{k}"
            rows.append((len(rows), " ".join(changed).upper() if k % 2 else " ".join(changed)))
    rows += [(len(rows) + i, prose(950 + i, 25) + " " + footer) for i in range(40)]
    rows += [(len(rows) + i, footer + " " + prose(990 + i, 3)) for i in range(5)]
    rng.shuffle(rows)
    got = overlap.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert by_row(got, "doc_id", "n_shingles", "component_id") == jaccard_groups(rows)


@pytest.mark.parametrize("earlier", (2, 64))
def test_a_pair_is_a_candidate_once(spark, monkeypatch, earlier):
    """However many n-grams a crowd shares, its join makes a row a pair; with fewer keys looked through, more rows and the same groups."""
    monkeypatch.setattr(overlap, "CENTRES", (2,))
    monkeypatch.setattr(overlap, "EARLIER", earlier)
    real, made = overlap._candidates, []

    def counted(*args):
        pairs = real(*args)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(overlap, "_candidates", counted)
    rng, rows, passage = random.Random(8), [], prose(700, 40).split(" ")
    for i in range(30):  # from well below the similarity to above it, of sizes a step apart
        own = prose(710 + i, rng.choice((4, 9, 25, 40))).split(" ")
        rows.append((i, " ".join(passage[:rng.choice((36, 40))] + own)))
    got = overlap.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert by_row(got, "doc_id", "n_shingles", "component_id") == jaccard_groups(rows)
    assert sum(n for _, n in made) and (earlier < 64 or all(rows == pairs for rows, pairs in made))


def test_many_at_a_time_is_one_by_one(monkeypatch):
    monkeypatch.setattr(overlap, "BLOCK", 1 << 12)
    data = [(t or "").encode() for _, t in ROWS]
    for one, other in zip((overlap.hashed(d, 5) for d in data), overlap.hashed_many(data, 5), strict=True):
        assert one.tolist() == sorted(other.tolist())
    assert [len(x) for x in overlap.hashed_many(data, 5)] == [len(brute.shingles(t)) for _, t in ROWS]


def test_segments_are_the_sets(spark, docs):
    order = overlap.Order([bits.filter_of(spark.createDataFrame([(int(k),) for k in overlap.hashed(prose(1, 120).encode(), 5)[:50].view(np.int64)], "key long"))])
    everything = bits.Filter(np.full(8192, 255, dtype=np.uint8))
    pieces = overlap.segments(docs, everything, order, 5).collect()
    assert len({(p.node, p.fragment) for p in pieces}) == len(pieces) and {p.fragment for p in pieces} > {0, 7, 8}
    for row in overlap._texts(docs).dropDuplicates(["node"]).collect():
        want = sorted(overlap.hashed(bytes(row.data), 5).view(np.int64).tolist())
        assert sorted(g for p in pieces if p.node == row.node for g in p.grams) == want


# --- hard negatives ----------------------------------------------------------------------------------


def plain_negatives(rows, every=50, positives=5, negatives=3, low=50, high=95):
    taken = [(v, lab, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for v, e, lab in rows
             if v is not None and lab is not None and e is not None and all(x is not None and np.isfinite(np.float32(x)) for x in e)]
    out = []
    for i, (v, lab, q) in enumerate(taken):
        if v % every:
            continue
        others = sorted((-sum(a * b for a, b in zip(q, q2)), v2, lab2) for j, (v2, lab2, q2) in enumerate(taken) if j != i)
        for score, p, _ in [o for o in others if o[2] == lab][:positives]:
            hard = [o for o in others if o[2] != lab and -low * score <= -100 * o[0] <= -high * score]
            out += [(v, p, k + 1, o[1], -score, -o[0]) for k, o in enumerate(hard[:negatives])]
    return sorted(out, key=str)


VECTORS = "vec_id long, embedding array<float>, label int, block string, row string, target string, place string"


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * 0.3 + rng.normal(size=8) * 0.2).round(2).tolist(), i % 4) for i in range(300)]
    rows += [(300 + i, [0.5, 0.25, 0.0, 0.0, 0.5, 0.0, 0.0, 0.25], i % 3) for i in range(60)]  # one very common vector
    rows += [(0, [0.5] * 8, 1), (50, rows[50][1], rows[50][2]), (50, rows[50][1], rows[50][2])]  # repeated ids and rows
    rows += [(400, None, 1), (450, [float("nan")] * 8, 1), (500, [None] * 8, 1), (550, [float("inf")] + [0.0] * 7, 1), (600, [0.1] * 8, None),
             (None, [0.1] * 8, 1), (650, [], 2), (700, [0.5, 0.5], 2), (750, [0.0] * 8, 3), (800, [-0.5] * 8, 0), (801, [-0.5] * 7 + [0.3], 0)]
    return rows


@pytest.mark.parametrize("size, zones", ((1024, 256), (16, 3)))
def test_hard_negatives(spark, monkeypatch, size, zones):
    monkeypatch.setattr(negatives, "ROWS", size)
    monkeypatch.setattr(negatives, "ZONES", zones)
    rows = vectors()
    table = spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], VECTORS).repartition(4)
    got = by_row(negatives.hard_negatives(table), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    want = plain_negatives(rows)
    assert got == want and len(want) > 50
    assert negatives.hard_negatives(table.limit(0)).count() == 0


def test_exact_at_any_size_and_errors_beyond(spark):
    rows = [(i, [float(1 << 18) + i, float(i % 7) * 1000.5, -3.25], i % 3) for i in range(120)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = by_row(negatives.hard_negatives(table, low=10, high=100), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert got == plain_negatives(rows, low=10, high=100) and got
    with pytest.raises(ArithmeticError):
        negatives.hard_negatives(spark.createDataFrame([(0, [1e30], 1)], table.schema))


def test_hilbert_curve_is_one_walk():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side, indexing="ij"), axis=-1).reshape(-1, 3)
    place = negatives.hilbert(grid, 3)
    walk = grid[np.argsort(place)]
    assert sorted(place) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(0)
    rows = rng.integers(-50, 50, (200, 6))
    anchors = rng.integers(-50, 50, (40, 6))
    least, most = negatives.bounds(anchors, rows.min(axis=0)[None, :], rows.max(axis=0)[None, :])
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()


# --- phrases -----------------------------------------------------------------------------------------


def plain_phrases(rows, least, longest=5, top=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        scored = []
        for p, a in found.items():
            if inside[p] < a:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=str)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("block", (1 << 20, 300))
def test_collocations(spark, docs, no_docs, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "GATHERED", 500)
    monkeypatch.setattr(collocations, "PHRASES", 500)
    monkeypatch.setattr(collocations, "PARTS", 3)
    rows = [("en" if (i or 0) % 3 else None, t) for i, t in ROWS]
    want = plain_phrases(rows, 3, top=40)
    got = by_row(collocations.collocations(docs, least=3, top=40), *COLUMNS)
    assert got == want and {r[0] for r in want} == {"en", "und"}
    assert collocations.collocations(no_docs).count() == 0
    mixed = [("en", "New York City, new york; new YORK.\nnew york\tcity a a a a a a"), ("und", "b b b b"), (None, "b b"), ("fr", None), ("é", " : ; ")] * 4
    table = spark.createDataFrame([(1, *r) for r in mixed], "doc_id long, lang string, text string")
    for longest in (2, 5):
        assert by_row(collocations.collocations(table, least=4, longest=longest), *COLUMNS) == plain_phrases(mixed, 4, longest)


def test_collisions_part_by_text(spark, monkeypatch):
    """Fingerprints of few bits: many phrases share one, and none is counted wrongly."""
    whole = collocations.mixed
    monkeypatch.setattr(collocations, "mixed", lambda values: whole(values) & np.uint64(0xFC00000000000000))
    rng = random.Random(8)
    rows = [("en", " ".join(rng.choices(["a", "b", "ab", "ba", "abc", "xyz", "zz", "é"], k=200))) for _ in range(6)]
    lines = [collocations.Words(t.encode(), "en", 0) for _, t in rows]
    everything = bits.Filter(np.full(8192, 255, dtype=np.uint8))
    got = collections.Counter()
    for words in lines:
        for phrase, length, n in collocations.frequent_in(words, everything, 5):
            got[phrase] += n
    want = collections.Counter(" ".join(t.split()[i:i + m]) for _, t in rows for m in range(1, 6) for i in range(200 - m + 1))
    assert got == want


def test_score_is_exact_beyond_64_bits(spark):
    rng, rows = random.Random(1), []
    for _ in range(200):
        a, n, left, right = (rng.randrange(1 << 42, 1 << 43) for _ in range(4))
        rows.append((a, n, left, right, 1000 * a * n // (left * right)))
    table = spark.createDataFrame(rows, "a long, n long, l long, r long, want long")
    found = collocations.scored_cuts(table)
    assert found.where("score <> want or score is null").count() == 0 and max(r[4] for r in rows) > 1000


def test_texts_are_joined_a_bounded_size_at_a_time(monkeypatch):
    """However large a batch is, a task holds one group of its texts joined; words and their n-grams are the same."""
    texts = [b"a b c", b"", b"d" * 30, b"e f", b"g. h i", b"", b"j"] * 5
    pdf = pd.DataFrame({"lang": ["en"] * len(texts), "data": texts})

    def grams():
        return sorted(int(k) for _, words in collocations._by_language(pdf, 4) for fits, keys in [words.grams(2)] for k in keys[fits & words.own(2)])

    whole, sizes, plain = grams(), [], collocations.blocks
    monkeypatch.setattr(collocations, "JOINED", 40)
    monkeypatch.setattr(collocations, "blocks", lambda some, lang, reach: sizes.append(sum(map(len, some))) or plain(some, lang, reach))
    assert grams() == whole and len(sizes) > 1 and max(sizes) <= 40 + max(map(len, texts))
