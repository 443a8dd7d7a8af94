"""Each operator against a plain version, on a table of odd cases and on an empty one."""

from __future__ import annotations

import collections
import gzip
import hashlib
import json
import math
import random
import re
import zlib

import brute
import numpy as np
import pytest
from brute import prose, texts

from pyspark.sql import functions as F

from strandfold.llm import chat, credentials, decontaminate, exact, licenses, overlap, packing, pii, quality, queries, simhash, warc
from strandfold.llm.common import new_folder
from strandfold.llm.graph import components

ROWS = texts()


def by_row(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def least(values):
    return min((v for v in values if v is not None), default=None)


# --- SimHash -----------------------------------------------------------------------------------------


def test_fingerprint_groups(docs, no_docs):
    prints = [brute.fingerprint(t) for _, t in ROWS]
    tops = brute.groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {top: least(i for (i, _), t in zip(ROWS, tops) if t == top) for top in tops}
    want = sorted(((i, p if p < 1 << 63 else p - (1 << 64), first[top]) for (i, _), p, top in zip(ROWS, prints, tops)), key=str)
    assert by_row(simhash.fingerprint_groups(docs), "doc_id", "fp", "component_id") == want
    assert simhash.fingerprint_groups(no_docs).count() == 0


def test_fingerprint_groups_of_close_bits(spark, monkeypatch):
    """Crowds of fingerprints around common centres, with tiles so small that every key is cut up."""
    rng = random.Random(5)
    values = []
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            flips = rng.sample(range(64), rng.randint(0, 4))
            values.append(centre ^ sum(1 << f for f in flips))
    values = sorted(set(values))
    monkeypatch.setattr(simhash, "TILE", 4)
    rows = [(i, i, v if v < 1 << 63 else v - (1 << 64)) for i, v in enumerate(values)]
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: spark.createDataFrame(rows, "doc_id long, text_key long, fp long"))
    tops = brute.groups(values, lambda a, b: (a ^ b).bit_count() <= 2)
    got = {r.doc_id: r.component_id for r in simhash.fingerprint_groups(None).collect()}
    assert got == dict(enumerate(tops))


def test_ring_keeps_all_close_pairs():
    rng = np.random.default_rng(0)
    for distance, segments in ((2, 7), (5, 4), (12, 4), (0, 4), (20, 4)):
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, distance + 1), replace=False)) for _ in range(300)], dtype=np.uint64)
        assert simhash.chained(flips, distance, segments).all()
    noise = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    assert simhash.chained(noise, 2, 7).mean() < 0.1


def test_near_duplicates_by_similarity(spark, docs, no_docs):
    base = [prose(i, 90).split(" ") for i in range(5)]
    rng = random.Random(1)
    rows = []
    for group, words in enumerate(base):
        for k in range(9):
            changed = list(words)
            for at in rng.sample(range(len(words)), k):
                changed[at] = f"new{k}"
            rows.append((len(rows), " ".join(changed)))
    rows += ROWS
    sets = [brute.shingles(t) for _, t in rows]

    def linked(a, b):
        return (not a and not b) or len(a & b) >= 0.8 * len(a | b) - 1e-9

    tops = brute.groups(sets, lambda a, b: linked(a, b))
    first = {top: least(i for (i, _), t in zip(rows, tops) if t == top) for top in tops}
    want = sorted(((i, first[top]) for (i, _), top in zip(rows, tops)), key=str)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_row(simhash.near_duplicates(table), "doc_id", "component_id") == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {0, 3, 7, 20}
    assert simhash.keep_one(no_docs).count() == 0


def test_near_duplicates_with_repeated_lines(spark):
    """The same set of shingles but for a few, with a line repeated: similar sets, whatever the counts."""
    rows = []
    for group, (words, times) in enumerate([(60, 40), (300, 30), (300, 100), (1000, 60)] * 3):
        body, line = prose(700 + group, words), prose(800 + group, 8)
        rows += [(3 * group, f"{body} {line}"), (3 * group + 1, f"{body}{f' {line}' * times}"), (3 * group + 2, f"{line} {body}{f' {line}' * 3}")]
    sets = [brute.shingles(t) for _, t in rows]
    tops = brute.groups(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-9)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(tops)) and len(set(tops)) == 12


def test_near_duplicates_in_a_crowd(spark):
    """20,000 different texts that share one footer: no pairs of the crowd, and the copies in it are found."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(5000)]
    footer = " ".join(rng.choices(words, k=12))
    rows = [(i, " ".join(rng.choices(words, k=40)) + " " + footer) for i in range(20_000)]
    copies = [(20_000 + i, rows[100 * i][1].replace(" ", " other ", 1)) for i in range(50)]
    made = []
    real = overlap.similar_pairs

    def counted(pairs, pieces, percent):
        made.append(pairs.count())
        return real(pairs, pieces, percent)

    overlap.similar_pairs = counted
    try:
        table = spark.createDataFrame(rows + copies, "doc_id long, text string").repartition(8)
        got = {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()}
    finally:
        overlap.similar_pairs = real
    assert got == {i: i for i in range(20_000)} | {20_000 + i: 100 * i for i in range(50)}
    assert sum(made) < 2000


def test_removal_whatever_the_columns_are_called(spark):
    rows = [(i, t) for i, t in ROWS if t] + [(800, "x " + prose(7, 60)), (801, "x " + prose(7, 60))]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["_gone_doc_id", "_gone_text_key", "_GONE_doc_id_", "_gone_id", "_hit_id", "_id", "_key", "group", "n", "keys", "part", "sketch"]
    clashing = plain.select("*", *[F.lit("clash").alias(c) for c in names])
    items = spark.createDataFrame([(1, " ".join(prose(7, 60).split(" ")[:30]))], "item_id long, text string")
    for remove in (simhash.keep_one, exact.keep_one, lambda d: decontaminate.clean(d, items)):
        kept = remove(clashing)
        assert kept.columns == clashing.columns
        assert by_row(kept, "doc_id", "text") == by_row(remove(plain), "doc_id", "text")


def test_bit_budget_holds_for_small_and_large_sets():
    rng = np.random.default_rng(3)
    budget = simhash.bit_budget(0.8)
    assert simhash.bit_budget(1.0) == 0 < simhash.bit_budget(0.9) < budget < 32
    for shared, left, right in ((4, 0, 1), (12, 1, 2), (40, 0, 10), (160, 20, 20)):
        ones = rng.integers(0, 2, (2000, 64, shared + left + right))
        a = 2 * ones[:, :, :shared + left].sum(axis=2) > shared + left
        b = 2 * (ones[:, :, :shared].sum(axis=2) + ones[:, :, shared + left:].sum(axis=2)) > shared + right
        differ = a != b
        assert abs(differ.mean() - simhash._flips(shared, left, right)) < 0.01 and differ.sum(axis=1).max() <= budget


def test_keys_with_the_same_nodes_are_compared_once(spark):
    rows = [(0, key, node) for key in (5, 6, 7) for node in (1, 2)] + [(1, 5, 1), (1, 5, 2), (0, 8, 1), (0, 8, 2), (0, 8, 3), (0, 9, 4)]
    keyed = spark.createDataFrame([(*r, r[2]) for r in rows], "slot int, key long, node long, fp long")
    assert by_row(simhash.shared_keys(keyed), "slot", "key", "node") == [(0, 5, 1), (0, 5, 2), (0, 8, 1), (0, 8, 2), (0, 8, 3)]


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (101, 102), (200, 200)]
    table = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(table, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}, 200: 200}
    assert components(table.where("a < 0"), "a", "b").count() == 0


# --- exact duplicates ---------------------------------------------------------------------------------


@pytest.mark.parametrize("primes", [exact.PRIMES, (3, 2)], ids=["full", "colliding"])
def test_exact_duplicates(docs, no_docs, primes):
    plain = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in ROWS]
    ids = collections.defaultdict(list)
    for (i, _), t in zip(ROWS, plain):
        ids[t].append(i)
    want = sorted(((i, least(ids[t]), len(ids[t]), i == least(ids[t]), brute.sha(t)) for (i, _), t in zip(ROWS, plain)), key=str)
    assert by_row(exact.duplicates(docs, primes), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact.duplicates(no_docs, primes).count() == 0


def test_exact_keep_one(docs, no_docs):
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids[7] == 1 and ids[8] == ids[9] == ids[1] == 0 and ids[0] == ids[2] == 1 and ids[6] == 0
    assert exact.keep_one(no_docs).count() == 0


def test_polynomial_hashes_combine():
    data = random.Random(3).randbytes(3000)
    for prime, base in zip(exact.PRIMES, exact.BASES):
        p, whole = exact.Polynomial(prime, base), 0
        for b in data:
            whole = (whole * base + b) % prime
        assert p.chunk(data) == whole
        assert (p.chunk(data[:1000]) * p.shift(2000) + p.chunk(data[1000:])) % prime == whole


def test_chunks_are_hashed_apart_and_folded(spark, monkeypatch):
    """Texts of many chunks, some dealt out, have the fingerprints of their whole, and their chunks lie in several tasks."""
    monkeypatch.setattr(exact, "CHUNK", 64)
    monkeypatch.setattr(exact, "HUGE", 1000)
    rows = [(i, t) for i, t in ROWS if len(t or "") < 30_000] + [(900, "é😀x " * 3000), (901, "é😀x  " * 3000), (900, "é😀x " * 3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_row(exact.fingerprints(table), "doc_id", "fp", "n_bytes", "text_sha256")
    want = []
    for i, text in rows:
        data = re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()
        fps = [0, 0]
        for k, (prime, base) in enumerate(zip(exact.PRIMES, exact.BASES)):
            for b in data:
                fps[k] = (fps[k] * base + b) % prime
        want.append((i, fps[0] << 31 | fps[1], len(data), hashlib.sha256(data).hexdigest()))
    assert got == sorted(want, key=str)
    tasks = exact.chunk_hashes(table.where("doc_id = 900")).withColumn("task", F.spark_partition_id()).where("part > 0").select("task").distinct()
    assert tasks.count() > 1


# --- packing --------------------------------------------------------------------------------------------


def test_packing_round_trip(docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    pieces = packing.packed(docs, queries.tokenizer_path()).collect()
    want = collections.Counter((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()) for i, t in ROWS)
    sequences = collections.defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length and 0 < p.length <= 2048 and p.start + p.length <= p.doc_tokens
        sequences[p.sequence_id].append((p.offset, p.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    tokens = sum(len(ids) // 4 * n for (_, ids), n in want.items())
    assert len(sequences) <= tokens / 2048 + 2 * docs.rdd.getNumPartitions()
    joined = collections.defaultdict(bytes)
    unique = {i for (i, _), n in want.items() if n == 1 and sum(k[0] == i for k in want) == 1}
    for p in sorted(pieces, key=lambda p: p.start):
        if p.doc_id in unique:
            joined[p.doc_id] += p.ids
    assert dict(joined) == {i: ids for i, ids in want if i in unique}
    assert sum(p.length for p in pieces) == tokens
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in packing.with_checksum(packing.packed(docs, queries.tokenizer_path())).collect()}
    assert all(crc[p.doc_id, p.start] == zlib.crc32(p.ids) for p in pieces if p.doc_id in unique)
    assert packing.packed(no_docs, queries.tokenizer_path()).count() == 0


def test_encoder_agrees_with_the_tokenizer():
    encode = packing.Encoder(queries.tokenizer_path())
    samples = ["", " ", "Don't y'all 's #'s!'ll", "a<|endoftext|>b", "ÀÉ ſt İI ß ΑΣ ²½ ªº", "\x85x\x1cy", "x" * 500 + " é!" * 70, "é combining", "tab\tnew\nline", "日本語 text", "a\x00b", prose(1, 300)]
    for _ in range(2):  # the second time from memory
        for text, ids in zip(samples, encode(samples)):
            assert ids == np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text


def test_packing_balances_cost():
    rng = random.Random(0)
    lengths = [rng.choice([3, 20, 150, 700, 1500, 5000]) for _ in range(500)]
    fill = collections.Counter()
    for _, _, length, sequence, _ in packing.pack(lengths, 2048):
        fill[sequence] += length
    assert sum(fill.values()) == sum(lengths) and max(fill.values()) <= 2048
    assert len(fill) == len(range(0, sum(lengths), 2048))


# --- WARC ---------------------------------------------------------------------------------------------------


PAGES = [
    (5, "http://a/x", "<p>" + "same " * 40), (2, "http://b/\r\ny", "<p>" + "same " * 40), (9, None, "<p>" + "same " * 40), (1, "http://c", "short"), (3, "http://d", "short"),
    (4, "u", None), (6, "u", ""), (None, "u", "<p>" + "same " * 40), (7, "u", "WARC/1.1\r\n\r\n\r\n" * 20 + "é😀"), (8, "u", "x" * 3_000_000), (8, "u", "x" * 3_000_000),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string")
    target = new_folder(spark, "test-warc")
    index = warc.archive(pages, target)
    got = by_row(warc.digest(warc.read(index)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    first = collections.defaultdict(list)
    for page, _, html in PAGES:
        first[html or ""].append(page)
    want = []
    for page, _, html in PAGES:
        data, low = (html or "").encode(), least(first[html or ""])
        again = len(data) >= 100 and low is not None and page != low
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", low if again else None))
    assert got == sorted(want, key=str)
    payloads = {r.record_id: bytes(r.payload) for r in warc.read(index).where("record_type = 'response'").collect()}
    assert payloads["<urn:page:7>"] == PAGES[8][2].encode()
    # every member is a gzip file of its own, and the sidecar says where
    rows = index.collect()
    path = rows[0].file.removeprefix("file:")
    with open(path, "rb") as archive, open(f"{path}.idx") as sidecar:
        data = archive.read()
        for line in map(json.loads, sidecar):
            record = gzip.decompress(data[line["offset"]:line["offset"] + line["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert warc.archive(pages.limit(0), new_folder(spark, "test-warc")).count() == 0


def test_damaged_archives_are_named(tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    whole = gzip.compress(good)
    for name, data in (("cut", whole[:-12]), ("none", b"plain"), ("length", gzip.compress(good.replace(b"3", b"x"))), ("short", gzip.compress(good.replace(b": 3", b": 99")))):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(ValueError, match=name):
            warc.rewrite(f"file://{tmp_path}/{name}", f"file://{tmp_path}/{name}.out")
    (tmp_path / "two").write_bytes(whole + whole)
    assert len(warc.rewrite(f"file://{tmp_path}/two", f"file://{tmp_path}/two.out")) == 2
    (tmp_path / "empty").write_bytes(b"")
    assert warc.rewrite(f"file://{tmp_path}/empty", f"file://{tmp_path}/empty.out") == []


# --- quality ------------------------------------------------------------------------------------------------


def test_quality_held_out(spark):
    rng = random.Random(2)
    junk = lambda i: " ".join(w + rng.choice(["***", "$$$"]) for w in prose(i, 50).split())
    rows = [(i, junk(i) if i % 4 == 0 else prose(i, 60), f"s{i % 5}", f"p{i % 2}") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)], "doc_id long, quality int")
    found = {r.doc_id: r.keep for r in quality.scores(table, labels).collect()}
    assert sum(found[i] == (i % 4 != 0) for i in range(200, 400)) >= 198
    assert {r.doc_id for r in quality.keep(table, labels).collect()} == {i for i, keep in found.items() if keep}


def test_every_sampled_id_is_fitted(spark, monkeypatch):
    """One id with hundreds of texts and copies takes no other id's place, and a second run fits the same rows."""
    rows = [(0, f"{prose(i, 12)} ### {i}") for i in range(300)] + [(0, "copy " * 9)] * 300 + [(i, prose(i, 30)) for i in range(1, 20)]
    labels = spark.createDataFrame([(i, int(i > 0)) for i in range(20)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "SAMPLE", 20)
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda x, y: fitted.append((x.tolist(), y.tolist())))
    for parts in (4, 7):
        quality.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), labels)
    assert fitted[0] == fitted[1] and collections.Counter(fitted[0][1]) == {0.0: quality.TEXTS, 1.0: 19}


def plain_posteriors(judged, prior, host_pull, path_pull):
    """(host_rate, path_rate, p_quality) of each (host, path, p_text), from the others of its site, one by one."""
    out = []
    for i, (host, path, p) in enumerate(judged):
        others = [x for j, x in enumerate(judged) if j != i]
        on_host = [q for h, _, q in others if h == host]
        on_path = [q for h, r, q in others if (h, r) == (host, path)]
        host_rate = (sum(on_host) + host_pull * prior) / (len(on_host) + host_pull)
        path_rate = (sum(on_path) + path_pull * host_rate) / (len(on_path) + path_pull)
        odds = lambda x: math.log(x / (1 - x))
        out.append((host_rate, path_rate, 1 / (1 + math.exp(-odds(p) - odds(min(max(path_rate, 0.001), 0.999)) + odds(prior)))))
    return out


def plain_pull(sites):
    """Of (documents, sum, mean) per site: what the prior counts for."""
    some = [(n, good, mean) for n, good, mean in sites if n > 1]
    seen = sum((good / n - mean) ** 2 for n, good, mean in some) / len(some)
    chance = sum(mean * (1 - mean) / n for n, _, mean in some) / len(some)
    spread = sum(mean * (1 - mean) for _, _, mean in some) / len(some)
    return min(max(spread / max(seen - chance, 1e-6 * spread) - 1, 1.0), 1e6)


def test_posteriors_equal_plain_numbers(spark):
    """Priors, pulls and rates against loops, with single documents, null sites and a path of the same name on two hosts."""
    rng = random.Random(5)
    judged = [(f"h{i % 7}" if i % 11 else None, f"p{i % 3}" if i % 5 else None, round(min(max(rng.gauss(0.2 + 0.1 * (i % 7), 0.2), 0.01), 0.99), 6)) for i in range(300)]
    judged += [("alone", "p0", 0.02), ("h0", "single", 0.98)]
    sites = quality.site_sums(spark.createDataFrame(judged, "host string, path string, p_text double").repartition(3))
    prior = (sum(p for *_, p in judged) + 0.5) / (len(judged) + 1)
    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for host, path, p in judged:
        hosts[host].append(p)
        paths[host, path].append(p)
    host_pull = plain_pull([(len(x), sum(x), prior) for x in hosts.values()])
    means = {h: (sum(x) + host_pull * prior) / (len(x) + host_pull) for h, x in hosts.items()}
    path_pull = plain_pull([(len(x), sum(x), means[h]) for (h, _), x in paths.items()])
    assert (sites.prior, sites.host_pull, sites.path_pull) == pytest.approx((prior, host_pull, path_pull))
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(judged)], "i int, host string, path string, p_text double")
    got = {r.i: (r.host_rate, r.path_rate, r.p_quality) for r in quality.with_sites(rows, sites).collect()}
    for i, want in enumerate(plain_posteriors(judged, prior, host_pull, path_pull)):
        assert got[i] == pytest.approx(want)
    assert got[300][:2] == pytest.approx((prior, prior))


def test_sparse_sites_are_drawn_to_the_prior(spark):
    rows = [("good", "a", 0.95)] * 400 + [("bad", "a", 0.05)] * 400 + [("good", "b", 0.05)] + [(None, None, 0.05)]
    table = spark.createDataFrame(rows, "host string, path string, p_text double")
    sites = quality.site_sums(table)
    rate = {(r.host, r.path): r.path_rate for r in quality.with_sites(table, sites).collect()}
    assert 0.4 < sites.prior < 0.6 and rate["good", "a"] > 0.9 and rate["bad", "a"] < 0.1
    assert rate["good", "b"] > rate[None, None] > 0.05


def test_quality_odd_cases(docs, no_docs, spark):
    labels = spark.createDataFrame([(3, 1), (7, 1), (20, 1), (21, 0), (23, 0), (None, 1), (4, None), (5, 7)], "doc_id long, quality int")
    assert quality.scores(docs, labels).count() == len(ROWS)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(ROWS)
    assert quality.keep(docs, labels.limit(0)).count() == len(ROWS)
    assert quality.scores(no_docs, labels).count() == 0


# --- decontamination ----------------------------------------------------------------------------------------


def test_contained_items(spark, docs, no_docs):
    passage = prose(50, 40)
    words = passage.split(" ")
    items = [(1, passage), (2, prose(51, 60)), (3, "One two"), (8, " ".join(words[3:6])), (9, words[30]), (10, "one\ttwo THREE"), (4, None), (5, ""), (6, passage), (None, "nobody's text here"), (7, " ".join(words[:12])), (7, prose(52, 9))]
    changed = lambda k: " ".join(w if i % 20 else f"c{k}" for i, w in enumerate(words))
    rows = ROWS + [(200, prose(60, 3000) + "\n" + passage.upper() + " " + prose(61, 3000)), (201, changed(1)), (202, " ".join(words[10:])), (203, prose(62, 20) + " " + prose(52, 9)), (203, "other")]
    ascii_upper = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    rows[len(ROWS)] = (200, prose(60, 3000) + "\n" + passage.translate(ascii_upper) + " " + prose(61, 3000))
    want = set()
    for i, text in rows:
        for item, needle in items:
            b = brute.shingles(needle)
            width = len(next(iter(b), ""))
            a = {x for x in brute.shingles(text, max(width, 1)) if len(x) == width}
            if b and len(a & b) >= 0.8 * len(b) - 1e-9:
                want.add((i, item, len(b), len(a & b)))
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, words string, item_id string")
    tested = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, hash string")
    for limit in (decontaminate.BROADCAST_ROWS, 0):
        decontaminate.BROADCAST_ROWS, kept = limit, decontaminate.BROADCAST_ROWS
        got = decontaminate.contained(table, tested).collect()
        decontaminate.BROADCAST_ROWS = kept
        assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got), key=str) == sorted(want, key=str)
    assert (200, 1, 36, 36) in want and any(w[0] == 203 for w in want)
    assert {(200, 8, 1, 1), (5, 10, 1, 1), (6, 3, 1, 1)} <= want  # short items inside longer texts
    clean = decontaminate.clean(table, tested)
    assert clean.columns == table.columns
    assert sorted((r.doc_id, r.text or "") for r in clean.where("doc_id >= 200").collect()) == [(i, t) for i, t in sorted(rows[len(ROWS):]) if not any(w[0] == i for w in want) or t == "other"]
    assert decontaminate.contained(no_docs, tested).count() == decontaminate.contained(docs, tested.limit(0)).count() == 0


def test_a_stock_phrase_brings_no_candidates(spark, monkeypatch):
    """10,000 items begin alike and most documents hold that phrase: it is nobody's probe."""
    stock = prose(70, 12)
    items = [(i, f"{stock} {prose(20_000 + i, 9)}") for i in range(10_000)]
    rows = [(i, f"{prose(70_000 + i, 30)} {stock} {prose(80_000 + i, 20)}") for i in range(300)] + [(900, f"see {items[77][1]} there")]
    seen, real = [], decontaminate.stored

    def counted(df, name):
        out = real(df, name)
        if name == "candidates":
            seen.append(out.count())
        return out

    monkeypatch.setattr(decontaminate, "stored", counted)
    found = decontaminate.contained(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(900, 77)] and seen[0] < 100


def test_sketches_by_size_partition(spark):
    """One length per partition, and every document with enough of an item has some of its sketch."""
    rng = random.Random(3)
    items = [(i, prose(i, rng.randint(1, 90))) for i in range(200)]
    tested = decontaminate.tested_items(spark.createDataFrame(items, "item_id long, text string"), 5)
    rows = decontaminate.sketches(tested, [1, 2, 3, 4, 5], 0.8).collect()
    lengths = collections.defaultdict(set)
    for r in rows:
        q, largest = r.n_shingles, (2 << r.size_class) - 1
        assert q < 2 << r.size_class <= 2 * q
        assert len(r.sketch) == min(q, largest - math.ceil(0.8 * largest - 1e-9) + 1) >= q - math.ceil(0.8 * q - 1e-9) + 1
        lengths[r.size_class].add(len(r.sketch))
    assert len(rows) == 200 and all(len(x) == 1 for c, x in lengths.items() if c > 2)


# --- secrets ------------------------------------------------------------------------------------------------


def test_secret_spans(docs, no_docs):
    found = credentials.find(docs)
    want = sorted(((i, brute.sha(brute.join_spans(brute.secrets(t)))) for i, t in ROWS), key=str)
    assert by_row(credentials.digest(found), "doc_id", "base_sha256") == want
    for r in found.collect():
        for s in r.spans:
            text = dict(ROWS)[r.doc_id]
            assert s.value in text[s.start:s.end]
    assert credentials.find(no_docs).count() == 0


def test_grammars_tell_formats_from_words(spark):
    rng = random.Random(4)
    key = lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    words = lambda i: "".join(prose(i, 8).split())
    train = {"access": [key() for _ in range(300)], "hex": [hexa(40) for _ in range(300)], credentials.FOUND: [w for w in map(words, range(300)) if len(w) > 15]}
    automata = {kind: credentials.Automaton(values) for kind, values in train.items()}
    other = ["ASIA" + key()[4:] for _ in range(100)]
    assert sum(credentials.likely(v, automata) >= credentials.MARGIN for v in other) >= 95
    plain = [w for w in map(words, range(1000, 1100)) if len(w) > 15]
    assert sum(credentials.likely(v, automata) >= credentials.MARGIN for v in plain) <= 1
    # through the whole operator: an upper-case hexadecimal key that no pattern covers
    rows = [(i, f"{prose(i, 30)} {words(i)} token={hexa(32)} {key()}") for i in range(150)] + [(900, f"so {'ASIA' + key()[4:]} is new"), (901, prose(7, 200))]
    found = {r.doc_id: [s.kind for s in r.spans] for r in credentials.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[900] == [credentials.FOUND] and found[901] == []


def plain_candidates(text, alphabet, least):
    """Longest runs of the alphabet, character by character, without the dots and hyphens at their ends."""
    out, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in alphabet:
            end += 1
        start, stop = at, end
        while start < stop and text[start] in credentials.EDGES:
            start += 1
        while stop > start and text[stop - 1] in credentials.EDGES:
            stop -= 1
        if stop - start >= least and end - at >= least:
            out.append((start, stop))
        at = max(end, at + 1)
    return out


def secret_rows():
    rng = random.Random(14)
    letters = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz0123456789"
    token = lambda n: "".join(rng.choices(letters, k=n))
    word = lambda i: "".join(prose(i, 9).split())
    rows = [(i, f"{prose(i, 40)} {word(i)}. token={token(12 + i % 20)} and {token(40).lower()}. {'AKIA' + token(16).upper()} {word(i + 500)}") for i in range(200)]
    rows += [(300, f"key ghp_{'Zk0123456789abcdef01QwErTyUi'} here"), (301, "see Zk9Qw3ErTy12 there"), (302, prose(3, 300)), (303, "id " + "0123456789" * 900), (304, None)]
    return rows


def test_every_candidate_is_scored(spark):
    """Added spans against a plain version, with the grammar of the table: overlapping, short and very long ones."""
    rows = secret_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    grammar = credentials.learn(table)
    values = [v for _, t in rows for *_, v in credentials.spans(t or "")]
    assert grammar.least == min(map(len, values)) == 12
    alphabet = set("".join(values) + credentials.JOINTS)
    found = {r.doc_id: r.spans for r in credentials.find(table).collect()}
    for i, text in rows:
        taken = brute.secrets(text)
        inner = {(e - len(v), e) for *_, e, v in credentials.spans(text or "")} | {(a, b) for _, a, b in taken}
        want = [(credentials.FOUND, a, b) for a, b in plain_candidates(text or "", alphabet, 12)
                if (a, b) not in inner and credentials.likely(text[a:b], grammar.automata) >= credentials.MARGIN]
        got = [(s.kind, s.start, s.end) for s in found[i]]
        assert sorted(got) == sorted(taken + want)
    assert [s.value for s in found[300]] == ["ghp_Zk0123456789abcdef01QwErTyUi", "0123456789abcdef01"]
    assert [s.value for s in found[301]] == ["Zk9Qw3ErTy12"] and not found[302] and not found[304]


def test_automata_learn_whole_strings():
    """What comes after the first characters of long strings counts too."""
    rng = random.Random(2)
    long = ["".join(rng.choices("0123456789", k=80)) + "".join(rng.choices("ABCDEF", k=40)) for _ in range(300)]
    automaton = credentials.Automaton(long)
    good, bad = long[0], long[0][:80] + "z" * 40
    assert automaton.log_likelihood(good) > automaton.log_likelihood(bad) + 40
    assert automaton.log_likelihood(long[1]) > automaton.log_likelihood(long[1][:60])


def test_sample_is_the_same_however_the_table_is_dealt(spark):
    rows = secret_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    one, other = (credentials.learn(table.repartition(n), sample=30) for n in (1, 7))
    assert one.least == other.least and one.runs == other.runs and one.automata.keys() == other.automata.keys()
    for kind, automaton in one.automata.items():
        assert automaton.counts == other.automata[kind].counts


def test_merging_keeps_probabilities():
    automaton = credentials.Automaton(["a1" * 4, "a1" * 5, "a1" * 6] * 50)
    total = sum(sum(c.values()) for c in automaton.counts)
    assert len({s for s in range(len(automaton.next)) if automaton.counts[s]}) > 0 and total > 0
    assert automaton.log_likelihood("a1" * 5) > automaton.log_likelihood("1a" * 5)


# --- personal data --------------------------------------------------------------------------------------


def test_personal_spans(docs, no_docs):
    found = pii.find(docs)
    want = sorted(((i, brute.sha(brute.join_spans(brute.personal(t)))) for i, t in ROWS), key=str)
    assert by_row(pii.digest(found), "doc_id", "base_sha256") == want
    for r in found.where("doc_id in (31, 34)").collect():
        for s in r.spans:
            assert dict(ROWS)[r.doc_id][s.start:s.end] == s.value
    assert pii.find(no_docs).count() == 0
    assert not [n for n in found._jdf.queryExecution().toString().split("\n") if "Python" in n or "Pandas" in n or "Arrow" in n]


def test_personal_spans_of_random_strings(spark):
    rng = random.Random(9)
    alphabet = list("ab1234560@@..--+() _%") + ["é", "\x01", "\x02", "\n", "255.", "+1 5", "4111"]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randint(0, 60)))) for i in range(1500)]
    got = by_row(pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))), "doc_id", "base_sha256")
    assert got == sorted(((i, brute.sha(brute.join_spans(brute.personal(t)))) for i, t in rows), key=str)


def test_expectation_maximisation_finds_reliable_labelers():
    rng = random.Random(3)
    right = (0.95, 0.9, 0.85, 0.8, 0.55, 0.5)
    counts, truth = collections.Counter(), collections.defaultdict(list)
    for _ in range(5000):
        z = rng.random() < 0.4
        votes = tuple((1 if z else -1) * (1 if rng.random() < p else -1) for p in right)
        counts[votes] += 1
        truth[votes].append(z)
    posterior = pii.reliabilities(dict(counts))
    hits = sum((posterior(v) >= 0.5) == z for v, zs in truth.items() for z in zs)
    assert hits / 5000 > 0.95


# --- licenses -------------------------------------------------------------------------------------------


def test_license_base(docs, no_docs):
    got = by_row(licenses.digest(licenses.scan(docs)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((i, *brute.phrases(t)) for i, t in ROWS), key=str)
    scored = {r.doc_id: r for r in licenses.digest(licenses.scan(docs)).collect()}
    assert scored[32].labels == "apache-2.0,cc-by,gpl,gpl-3.0,reserved" and 0.5 <= scored[32].score <= 1 and scored[3].score == 0
    assert licenses.scan(no_docs).count() == 0


def test_license_suppression_against_plain_version(spark):
    rng = random.Random(6)
    vocabulary = "cc by sa license licensed under the apache version 2 0 gnu general public v3 3 mit copyright 2020 lesser or any later creative commons attribution 4".split()
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(300)]
    every = licenses.rules()
    assert len(every) > 300
    want = {}
    for i, text in rows:
        joined, hits = f" {text} ", set()
        for label, pattern, keyword, priority in every:
            if keyword in text.split():
                for m in re.finditer(f"(?<= )(?:{pattern})(?= )", joined):
                    first = joined[:m.start()].count(" ") - 1
                    hits.add((first, first + m.group().count(" "), priority, label))
        inside = lambda a, b: a != b and b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2] and (b[:3] != a[:3] or b[3] < a[3])
        want[i] = sorted(h for h in hits if not any(inside(h, g) for g in hits))
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: sorted({tuple(d) for d in r.detections}) for r in found.collect()}
    assert got == want


# --- chat -----------------------------------------------------------------------------------------------


def test_perspectives(spark):
    rng = random.Random(8)
    people = ["Ann", "Bob", "Cid|>", None, ""]
    rows = [(c, t, rng.choice(people), rng.choice([f"says {t}", "<|end|> trick", "", None]), "clash") for c in range(6) for t in rng.sample(range(150), 40)]
    rows += [(1, None, "Ann", "no number", "x"), (None, 0, "Ann", "hi", "x"), (None, 1, "Bob", "hello", "x")] + [(9, 3, "Ann", "again", "x")] * 700 + [(9, 3, "Bob", f"b{i}", "x") for i in range(60)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, said string")
    plain = lambda s: (s or "").replace("<|", "< |").replace("|>", "| >")
    talk = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        talk[conv].append((-1 if turn is None else turn // 64, -1 if turn is None else turn, plain(role).strip() or "unknown", plain(text)))
    got = collections.defaultdict(list)
    for r in chat.perspectives(table, rows_per_piece=128).collect():
        assert r.n_turns <= 700
        own = "".join(r.text[m.start:m.end] for m in r.mask)
        got[r.conv_id, r.part, r.perspective].append((r.text, own))
    for conv, turns in talk.items():
        for who in {t[2] for t in turns}:
            for part in {t[0] for t in turns}:
                said = sorted(t for t in turns if t[0] == part)
                text = "".join(("<|assistant|>\n" if t[2] == who else f"<|user name={t[2]}|>\n") + t[3] + "<|end|>\n" for t in said)
                own = "".join(t[3] + "<|end|>\n" for t in said if t[2] == who)
                pieces = got.pop((conv, part, who))
                if conv == 9:
                    assert sum(len(p[0]) for p in pieces) == len(text) and sum(len(p[1]) for p in pieces) == len(own) and len(pieces) > 1
                else:
                    assert pieces == [(text, own)]
    assert not got
    assert chat.perspectives(table.limit(0)).count() == 0


def test_pieces_join_to_the_whole_dialogue(spark, monkeypatch):
    rng = random.Random(11)
    monkeypatch.setattr(chat, "BLOCK", 2)
    rows = [(1, t, rng.choice(["Ann", "Bob"]), f"says {t}") for t in range(-300, 700, 3)]  # many parts, negative ones too
    rows += [(1, None, "Bob", f"no number {i}") for i in range(100)] + [(1, 5, "Ann", f"a{i}") for i in range(150)] + [(1, 5, "Bob", "same")] * 90 + [(1, 6, "Bob", "b")] * 3
    rows += [(None, 3, "Cid", f"c{i % 40}") for i in range(200)] + [(2, 0, "Ann", "hi"), (2, 64, "Bob", "there")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    got = collections.defaultdict(list)
    for r in chat.perspectives(table, rows_per_piece=32).collect():
        got[r.conv_id, r.perspective].append((r.part, r.piece, r.start, r.n_turns, r.text, "".join(r.text[m.start:m.end] for m in r.mask)))
    assert set(got) == {(1, "Ann"), (1, "Bob"), (None, "Cid"), (2, "Ann"), (2, "Bob")}
    for (conv, who), pieces in got.items():
        said = sorted((t is not None, t or 0, role, text) for c, t, role, text in rows if c == conv)
        pieces.sort()
        assert "".join(p[4] for p in pieces) == "".join(("<|assistant|>\n" if role == who else f"<|user name={role}|>\n") + text + "<|end|>\n" for *_, role, text in said)
        assert "".join(p[5] for p in pieces) == "".join(text + "<|end|>\n" for *_, role, text in said if role == who)
        at = 0
        for _, _, start, n, *_ in pieces:
            assert start == at and 0 < n <= 32 + 32 * (conv == 2)
            at += n
        assert at == len(said)


def test_a_long_dialogue_can_be_one_text(spark):
    rows = [(1, t, "Ann" if t % 2 else "Bob", f"says {t}") for t in range(500)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    whole = chat.perspectives(table, turns_per_part=1000).collect()
    assert {(r.perspective, r.part, r.piece, r.n_turns) for r in whole} == {("Ann", 0, 0, 500), ("Bob", 0, 0, 500)}
    parts = {r.perspective: [] for r in whole}
    for r in chat.perspectives(table).orderBy("part").collect():
        parts[r.perspective].append(r.text)
    assert all("".join(parts[r.perspective]) == r.text for r in whole) and len(parts["Ann"]) == 8


def test_chat_sql_cuts_pieces_too(spark, tmp_path):
    """A part of more rows than a piece takes, through the registered query and its SQL."""
    import duckdb

    rows = [(1, i % 7, "Ann" if i % 3 else "Bob", f"line {i % 1500}") for i in range(9000)] + [(1, 70, "Bob", "late"), (2, 0, "Cid", "hi")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = db.execute(queries.oracle_sql()["op9_chat"])
    names = [d[0] for d in found.description]
    got = queries.op9_chat(spark, str(tmp_path))
    assert sorted(got.columns) == sorted(names)
    assert by_row(got, *names) == sorted(found.fetchall(), key=str) and got.where("piece = 2").count() == 2
