"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import extraction, licenses, merkle, mixing, near_dedup, neighbours, packing, quality, sharding, substrings, toxicity, variants, warc
from .store import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.default_tokenizer())


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(table(spark, sf_dir, "documents"), 2)


@query
def op4_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


#: Base 32 of a digest: five hexadecimal digits give four symbols of five bits.
SQL["op4_warc_zstd"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


@query
def op5_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op8_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op9_crf_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


#: Step a crc32 over the UTF-8 bytes of ``s`` for each ``k`` of ``texts``; the result is ``crcs``.
CRC32 = """
crc_table AS (SELECT i AS byte, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) AS step
              FROM (SELECT unnest(range(0, 256)) AS i)),
crc_run(k, rest, c) AS (
    SELECT k, hex(encode(s)), CAST(4294967295 AS BIGINT) FROM texts
    UNION ALL
    SELECT k, substr(rest, 3), xor(c >> 8, step) FROM crc_run JOIN crc_table
    ON byte = xor(c & 255, CAST('0x' || substr(rest, 1, 2) AS BIGINT)) WHERE rest <> ''),
crcs AS (SELECT k, xor(c, 4294967295) AS crc FROM crc_run WHERE rest = '')
"""

SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE texts AS (SELECT DISTINCT doc_id AS k, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
{CRC32},
versions AS (
    SELECT doc_id, lang, source, n_chars, text, CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS now
    FROM documents LEFT JOIN crcs ON k = doc_id),
hashed AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS changed
    FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                 || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM versions)),
leaves AS (
    SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
nodes(lang, level, idx, n, h) AS (
    SELECT lang, CAST(0 AS BIGINT), pos, n, leaf FROM leaves
    UNION ALL
    SELECT lang, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY lang, level + 1, idx // 8, (n + 7) // 8),
subroots AS (SELECT lang, level AS depth, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees FROM nodes WHERE n = 1),
tops(level, idx, n, h) AS (
    SELECT CAST(0 AS BIGINT), tree, trees, subroot FROM subroots
    UNION ALL
    SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level + 1, idx // 8, (n + 7) // 8),
ways AS (
    SELECT r, level AS step, idx, pos // CAST(pow(8, level) AS BIGINT) AS own, h
    FROM leaves JOIN nodes ON nodes.lang IS NOT DISTINCT FROM leaves.lang AND nodes.n > 1 AND idx // 8 = pos // CAST(pow(8, level + 1) AS BIGINT)
    UNION ALL
    SELECT r, depth + tops.level, idx, tree // CAST(pow(8, tops.level) AS BIGINT), h
    FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
    JOIN tops ON tops.n > 1 AND idx // 8 = tree // CAST(pow(8, tops.level + 1) AS BIGINT)),
sides AS (
    SELECT r, step, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < own), '') AS before, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > own), '') AS after
    FROM ways GROUP BY r, step),
proofs AS (SELECT r, string_agg(before || after, '' ORDER BY step) AS proof FROM sides GROUP BY r),
folds(r, step, h) AS (
    SELECT r, CAST(0 AS BIGINT), changed FROM leaves
    UNION ALL
    SELECT folds.r, folds.step + 1, sha256(before || h || after) FROM folds JOIN sides ON sides.r = folds.r AND sides.step = folds.step),
folded AS (SELECT r, arg_max(h, step) AS folded_root FROM folds GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN folded USING (r) LEFT JOIN proofs USING (r) JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
CROSS JOIN (SELECT h AS root FROM tops WHERE n = 1)
"""


@query
def op12_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.places(sharding.shard(table(spark, sf_dir, "documents"), 8))


@query
def op13_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


#: Words with a gap (``b$a`` for a word ``a c b`` or ``a b``); near words meet in one.
SQL["op13_permuterm_variants"] = f"""
WITH RECURSIVE found AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT id, run, count(*) AS times FROM found GROUP BY id, run),
texts AS (SELECT id || ':' || run AS k, id || ':' || run AS s FROM runs),
{CRC32},
damaged AS (
    SELECT CASE WHEN crc % 97 = 0 THEN left(run, CAST(crc % length(run) AS INTEGER)) || substr(run, crc % length(run) + 2) ELSE run END AS word, times
    FROM runs JOIN crcs ON k = id || ':' || run),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
places AS (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words),
gaps AS (
    SELECT word, n, substr(word, i + 2) || '$' || left(word, CAST(i AS INTEGER)) AS gap, 1 AS open FROM places WHERE i < length(word)
    UNION ALL
    SELECT word, n, substr(word, i + 1) || '$' || left(word, CAST(i AS INTEGER)), 0 FROM places),
near AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word AND a.open + b.open > 0),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS near, max(other_n) AS near_n FROM near GROUP BY word),
forms AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM words LEFT JOIN best ON best.word = words.word),
chains(word, tip) AS (
    SELECT word, word FROM forms
    UNION ALL
    SELECT chains.word, form FROM chains JOIN forms ON forms.word = tip WHERE form IS NOT NULL)
SELECT forms.word, forms.form, tip AS root, n, n_near, form_n
FROM forms JOIN chains ON chains.word = forms.word
WHERE tip IN (SELECT word FROM forms WHERE form IS NULL)
"""
