"""The operators as registered queries over the given tables, and SQL for those that have any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandfold.llm import chat, collocations, credentials, decontaminate, exact, licenses, negatives, overlap, packing, pii, quality, simhash, warc
from strandfold.llm.common import new_folder

#: The tokenizer that packing counts tokens with.
VOCABULARY = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.fingerprint_groups(_read(spark, folder, "documents"), shingle=3, distance=2, segments=7)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.with_checksum(packing.packed(_read(spark, folder, "documents"), tokenizer_path()))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.archive(_read(spark, folder, "pages"), new_folder(spark, "warc"))
    return warc.digest(warc.read(index))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scores(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", F.col("n_shingles").cast("long"), F.col("n_shared").cast("long"), "containment")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.duplicates(_read(spark, folder, "documents")).drop("text_key")


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.digest(credentials.find(_read(spark, folder, "documents")))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find(_read(spark, folder, "documents")))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digest(chat.perspectives(_read(spark, folder, "conversations")))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(licenses.scan(_read(spark, folder, "documents")))


def op11_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.similar_groups(_read(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _read(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_read(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_simhash, op2_packing, op3_warc, op4_quality, op5_exact_dedup, op6_decontamination, op7_secrets, op8_pii, op9_chat, op10_licenses, op11_ngram_jaccard, op12_hard_negatives, op13_collocations)
    return {f.__name__: f for f in found}


OP5_SQL = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""


OP6_SQL = """
WITH words AS (
         SELECT 'd' AS side, doc_id AS id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w FROM documents
         UNION ALL
         SELECT 'i', item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] FROM benchmark),
     widths AS (SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE side = 'i' AND len(w) > 0),
     s AS (SELECT DISTINCT side, id, k, unnest([array_to_string(w[i + 1:i + k], ' ') for i in range(len(w) - k + 1)]) AS shingle
           FROM words, widths WHERE len(w) >= k AND (side = 'd' OR k = least(len(w), 5))),
     n AS (SELECT id, count(*) AS n_shingles FROM s WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
FROM s d JOIN s i ON d.shingle = i.shingle AND d.k = i.k AND d.side = 'd' AND i.side = 'i' JOIN n ON n.id = i.id
GROUP BY d.id, i.id, n_shingles HAVING count(*) >= ceil(0.8 * n_shingles - 1e-9)
"""


OP3_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP9_SQL = """
WITH t AS (
         SELECT conv_id, CAST(floor(turn / 64) AS BIGINT) AS part, turn, role,
                replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS said FROM conversations),
     c AS (SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, said) - 1 AS nth,
                  rank() OVER (PARTITION BY conv_id ORDER BY part) - 1 AS before FROM t),
     p AS (SELECT *, CAST(nth // 4096 AS BIGINT) AS piece, CAST(before + nth // 4096 * 4096 AS BIGINT) AS start FROM c),
     w AS (SELECT DISTINCT conv_id, role AS perspective FROM t),
     r AS (SELECT p.*, perspective, role = perspective AS own,
                  CASE WHEN role = perspective THEN '<|assistant|>' ELSE '<|user name=' || role || '|>' END || chr(10) AS head,
                  said || '<|end|>' || chr(10) AS tail FROM p JOIN w USING (conv_id)),
     o AS (SELECT *, sum(length(head) + length(tail)) OVER (PARTITION BY conv_id, part, piece, perspective ORDER BY nth) AS reached FROM r)
SELECT conv_id, part, piece, start, perspective, count(*) AS n_turns, string_agg(head || tail, '' ORDER BY nth) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(reached - length(tail) AS BIGINT) || ':' || CAST(reached AS BIGINT) END, ',' ORDER BY nth), '') AS mask
FROM o GROUP BY conv_id, part, piece, start, perspective
"""

OP11_SQL = """
WITH RECURSIVE words AS (
         SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i + 1:i + 5], ' ') for i in range(greatest(len(w) - 4, 1))]) AS shingle FROM words WHERE len(w) > 0),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
     l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
     reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id)
"""

OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
     s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS id, a.label = o.label AS alike, list_inner_product(a.q, o.q)::BIGINT AS score
           FROM v a JOIN v o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id),
     p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP13_SQL = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, [x for x in regexp_split_to_array(piece, '[\\x20\\x09]+') if x <> ''] AS w FROM p),
     t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
     g AS (SELECT lang, m, unnest([w[i:i + m - 1] for i in range(1, len(w) - m + 2)]) AS words FROM w, range(1, 6) r(m) WHERE len(w) >= m),
     f AS (SELECT lang, m, words, array_to_string(words, ' ') AS phrase, count(*) AS f FROM g GROUP BY lang, m, words HAVING count(*) >= 100),
     inside AS (SELECT c.lang, array_to_string(c.words[i:i + k - 1], ' ') AS phrase, max(f) AS longer
                FROM f c, range(2, 5) a(k), range(1, 5) b(i) WHERE k < m AND i + k - 1 <= m GROUP BY ALL),
     c AS (SELECT f.* FROM f LEFT JOIN inside USING (lang, phrase) WHERE m > 1 AND (longer IS NULL OR 100 * longer < 100 * f.f)),
     cut AS (SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n, k, ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
             FROM c, range(1, 5) k(k), f l, f r, t
             WHERE k < c.m AND l.lang = c.lang AND r.lang = c.lang AND t.lang = c.lang
               AND l.phrase = array_to_string(c.words[1:k], ' ') AND r.phrase = array_to_string(c.words[k + 1:], ' ')),
     best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": OP3_SQL, "op9_chat": OP9_SQL, "op5_exact_dedup": OP5_SQL, "op6_decontamination": OP6_SQL, "op11_ngram_jaccard": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_collocations": OP13_SQL}
