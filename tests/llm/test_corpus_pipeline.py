"""The stages one after the other against plain versions of them, on a small folder of tables."""

from __future__ import annotations

import collections
import random

import brute
import corpus_pipeline
import numpy as np
import pytest
from brute import prose

from strandfold.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    place = tmp_path_factory.mktemp("tables")
    passage = prose(900, 40)
    rows = [(i, prose(i, rng.randint(30, 120)), "en", f"s{i % 3}") for i in range(120)]
    rows += [(200 + i, "  ".join(rows[i][1].split(" ")), "en", "s0") for i in range(0, 30, 2)]  # equal but for blanks
    for i in range(1, 30, 2):  # one word changed
        words = rows[i][1].split(" ")
        words[len(words) // 2] = "other"
        rows.append((300 + i, " ".join(words), "en", "s1"))
    rows += [(400 + i, prose(400 + i, 30) + " " + passage + " " + prose(500 + i, 30), "en", "s2") for i in range(8)]
    junk = [(600 + i, " ".join(w + "###" for w in prose(600 + i, 60).split(" ")), "en", "s0") for i in range(40)]
    rows += junk + [(700, None, "en", "s0"), (701, "", None, None)]
    table = [(i, text, lang, source, len(text or "")) for i, text, lang, source in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{place}/documents.parquet")
    known = [(i, 0 if i >= 600 else 1, 0) for i in [*range(0, 120, 2), *range(600, 640, 2)]]
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, prose(901, 30))], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return str(place), {r[0]: r[1] for r in rows}, passage


def test_every_stage(spark, folder):
    place, texts, passage = folder
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs, kept = spark.read.parquet(f"{place}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, place), name)
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.collect()})
    good, exact, near, clean = kept
    assert not good & set(range(600, 640)) and good >= set(range(120))

    plain = collections.defaultdict(list)
    for i in good:
        plain[" ".join((texts[i] or "").split())].append(i)
    assert exact == {min(ids) for ids in plain.values()} and not exact & set(range(200, 230))

    ids = sorted(exact)
    sets = [brute.shingles(texts[i]) for i in ids]
    tops = brute.groups(sets, lambda a, b: (not a and not b) or len(a & b) >= 0.8 * len(a | b) - 1e-9)
    assert near == {ids[t] for t in tops} and len(near) < len(exact)

    item = brute.shingles(passage)
    assert clean == {i for i in near if len(item & brute.shingles(texts[i])) < 0.8 * len(item)} and not clean & set(range(400, 408))

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokens = {i: len(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids) + 1 for i in clean}
    pieces = corpus_pipeline.run(spark, place).collect()
    assert {r.doc_id: r.doc_tokens for r in pieces} == tokens
    assert sum(r.length for r in pieces) == sum(tokens.values())
    assert np.all(np.array([r.offset + r.length for r in pieces]) <= 2048)


def test_empty_documents(spark, folder):
    place, *_ = folder
    docs = spark.read.parquet(f"{place}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, place)
        assert docs.count() == 0
