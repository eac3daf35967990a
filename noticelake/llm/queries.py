"""The operators over the given tables: whole tables, whole texts, production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm import bpe, crf, divergence, jaccard, lines, mixing, nearest, packed, products, quality, repeats, secret_scan, variants
from noticelake.llm.store import ship_package


def vocabulary_path(name: str) -> str:
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return nearest.search(_table(spark, sf, "embeddings"))


def op2_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(_table(spark, sf, "documents"), count_links=True)


def op3_packed_ids(spark: SparkSession, sf: str) -> DataFrame:
    return packed.write_and_read(spark, _table(spark, sf, "documents"), vocabulary_path("word_bpe_49k.json"), end_id=2)


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = vocabulary_path("byte_bpe_50k.json")
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode_and_decode(docs, path))


def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return secret_scan.digest(docs, secret_scan.scan(docs))


def op9_products(spark: SparkSession, sf: str) -> DataFrame:
    return products.search(_table(spark, sf, "embeddings"))


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", F.col("source").alias("mix_source"))


QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_jaccard": op2_jaccard,
    "op3_packed_ids": op3_packed_ids,
    "op4_bpe": op4_bpe,
    "op5_secrets": op5_secrets,
    "op9_products": op9_products,
    "op10_mixing": op10_mixing,
}

ORACLE: dict[str, str] = {
    "op9_products": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_inner_product(CAST(q.vec AS DOUBLE[]), CAST(c.vec AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
}


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


QUERIES["op6_quality"] = op6_quality


def op7_languages(spark: SparkSession, sf: str) -> DataFrame:
    return crf.identify(_table(spark, sf, "documents")).drop("segments")


QUERIES["op7_languages"] = op7_languages


def op8_repeats(spark: SparkSession, sf: str) -> DataFrame:
    cut = repeats.remove(_table(spark, sf, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES["op8_repeats"] = op8_repeats


def op11_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.group(_table(spark, sf, "documents"))


def op12_lines(spark: SparkSession, sf: str) -> DataFrame:
    cut = lines.dedup(_table(spark, sf, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(_table(spark, sf, "documents"))


QUERIES |= {"op11_variants": op11_variants, "op12_lines": op12_lines, "op13_divergence": op13_divergence}

ORACLE["op11_variants"] = r"""
WITH RECURSIVE table_of AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents WHERE text IS NOT NULL)
    GROUP BY ALL
), sums AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
            lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [(192 + (ord(c) >> 6))::BIGINT, (128 + (ord(c) & 63))::BIGINT] END))),
        lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) AS h
    FROM runs, table_of
), slips AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM sums
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM slips WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), holes AS (
    SELECT word, n, i, substr(word, 1, i) || '*' || substr(word, i + 2) AS hole, substr(word, 1, i) || substr(word, i + 2) AS less
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
    UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.less = w.word
    UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.less = w.word
), best AS (
    SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
), forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 5 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
), walk AS (
    SELECT word, word AS stop, 0 AS steps FROM forms
    UNION ALL SELECT k.word, f.form, steps + 1 FROM walk k JOIN forms f ON k.stop = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, k.stop AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, max_by(stop, steps) AS stop FROM walk GROUP BY word) k USING (word)"""

ORACLE["op12_lines"] = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (SELECT row_no, doc_id, string_split(text, chr(10)) AS parts FROM d
), l AS (SELECT row_no, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM cut
), k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row_no) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (o.key IS NOT NULL) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (o.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often o ON k.key = o.key GROUP BY row_no, doc_id"""

ORACLE["op13_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
    SELECT row_no, lang, source,
        translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM d
), kept AS (SELECT lang, term, count(*)::HUGEINT AS n_lang FROM t GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3
), langs AS (SELECT lang, sum(n_lang)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM d
), here AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), sizes AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM here GROUP BY lang, source
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(h.n, 0) + 1) // (coalesce(s.total, 0) + l.v) AS p,
        1 + 1000000000::HUGEINT * (k.n_lang + 1) // (l.total + l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN here h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
), met AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(m.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN met m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
), terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""

ORACLE["op2_jaccard"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), g AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS gram FROM (SELECT *, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM d WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), reached AS (
    SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), comp AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
), degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(n_links, 0) AS n_links, component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN degree ON a = d.doc_id LEFT JOIN comp ON comp.doc_id = d.doc_id"""

ORACLE["op8_repeats"] = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (SELECT row_no, unnest(words) AS word, unnest(range(len(words))) AS place, len(words) AS n FROM d
), s AS (SELECT row_no, i AS place, array_to_string(words[i + 1 : i + 35], ' ') AS run FROM (SELECT *, unnest(range(len(words) - 34)) AS i FROM d WHERE len(words) > 34)
), twice AS (SELECT row_no, place FROM (SELECT row_no, place, count(*) OVER (PARTITION BY run) AS k FROM s) WHERE k > 1
), marked AS (
    SELECT w.*, max(CASE WHEN t.place IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY w.row_no ORDER BY w.place ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone
    FROM w LEFT JOIN twice t ON t.row_no = w.row_no AND t.place = w.place
), kept AS (
    SELECT row_no, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept FROM marked GROUP BY row_no
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (row_no)"""
