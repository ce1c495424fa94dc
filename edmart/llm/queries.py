"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edmart.llm import (
    decontaminate,
    hard_negatives,
    language_id,
    line_dedup,
    merkle,
    quality_rules,
    sentencepieces,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
    url_filters,
    warc,
)
from edmart.llm.shared import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, docs, table(spark, sf_dir, "labels"), with_text=False)
    return judged.select("doc_id", *quality_rules.COUNTS, "llr", "base_failed", "kept")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    out = sharding.assign_shards(docs, ["lang", "source", "size"], ["text_crc32", "doc_id"])
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
        "file",
    )


def op4_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.encode_docs(table(spark, sf_dir, "documents"), path)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def op7_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_hash")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_language_id,
        op3_hilbert_shards,
        op4_sentencepiece_nbest,
        op5_url_filters,
        op6_token_counts,
        op7_benchmark_templates,
        op8_simhash,
        op9_warc_revisits,
        op10_suffix_dedup,
        op11_merkle_manifest,
        op12_hard_negatives,
        op13_line_dedup,
    )
}


# sha256 of the texts and digests as they stand; the crc32 of the id by its definition, bit by bit
OP11_SQL = """
WITH RECURSIVE ids AS (
  SELECT DISTINCT doc_id, encode(CAST(doc_id AS VARCHAR)) AS raw FROM documents WHERE doc_id IS NOT NULL
), crc AS (
  SELECT doc_id, raw, CAST(0 AS BIGINT) AS i, CAST(4294967295 AS BIGINT) AS c FROM ids
  UNION ALL
  SELECT doc_id, raw, i + 1,
    list_reduce(list_prepend(xor(c, CAST(ascii(substring(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER) + 1, 1)) AS BIGINT)),
        [CAST(k AS BIGINT) FOR k IN range(8)]),
      lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))
  FROM crc WHERE i < strlen(CAST(doc_id AS VARCHAR))
), marked AS (
  SELECT doc_id, xor(c, 4294967295) % 3 = 0 AS marked FROM crc WHERE i = strlen(CAST(doc_id AS VARCHAR))
), rows_ AS (
  SELECT d.doc_id, lang, marked,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || CAST(d.doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id
), leaves AS (
  SELECT doc_id, lang, marked, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) AS changed
  FROM rows_
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), trees AS (
  SELECT lang, n, list(leaf ORDER BY pos) AS line FROM placed GROUP BY lang, n
), levels AS (
  SELECT lang, 0 AS level, line FROM trees
  UNION ALL
  SELECT lang, level + 1,
    [sha256(array_to_string(line[8 * k + 1 : 8 * k + 8], '')) FOR k IN range((len(line) + 7) // 8)]
  FROM levels WHERE len(line) > 1
), subroots AS (
  SELECT lang, line[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
  FROM levels WHERE len(line) = 1
), tops AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS line FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(array_to_string(line[8 * k + 1 : 8 * k + 8], '')) FOR k IN range((len(line) + 7) // 8)]
  FROM tops WHERE len(line) > 1
), climb AS (
  SELECT doc_id, p.lang, leaf, pos, 0 AS level, CASE WHEN marked THEN changed ELSE leaf END AS folded, '' AS proof, p.n
  FROM placed p
  UNION ALL
  SELECT doc_id, c.lang, leaf, pos // 8, c.level + 1,
    sha256(array_to_string(line[8 * (pos // 8) + 1 : pos], '') || folded
      || array_to_string(line[pos + 2 : 8 * (pos // 8) + 8], '')),
    proof || array_to_string(line[8 * (pos // 8) + 1 : pos], '')
      || array_to_string(line[pos + 2 : 8 * (pos // 8) + 8], ''),
    (c.n + 7) // 8
  FROM climb c JOIN levels l ON c.lang IS NOT DISTINCT FROM l.lang AND c.level = l.level
  WHERE c.n > 1
), over AS (
  SELECT doc_id, leaf, subroot, s.pos, 0 AS level, folded, proof, (SELECT count(*) FROM subroots) AS n
  FROM climb c JOIN subroots s ON c.lang IS NOT DISTINCT FROM s.lang WHERE c.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, pos // 8, o.level + 1,
    sha256(array_to_string(line[8 * (pos // 8) + 1 : pos], '') || folded
      || array_to_string(line[pos + 2 : 8 * (pos // 8) + 8], '')),
    proof || array_to_string(line[8 * (pos // 8) + 1 : pos], '')
      || array_to_string(line[pos + 2 : 8 * (pos // 8) + 8], ''),
    (o.n + 7) // 8
  FROM over o JOIN tops t ON o.level = t.level
  WHERE o.n > 1
), root AS (
  SELECT line[1] AS root FROM tops WHERE len(line) = 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM over, root WHERE n = 1
"""

OP12_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM whole a JOIN whole r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP13_SQL = """
WITH lines AS (
  SELECT doc_id, hash(text) AS row, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.first_id AS lost FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id, row
"""

OP9_SQL = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), latest AS (
  SELECT payload, max(page_id) AS original FROM sized WHERE payload_bytes >= 1000 GROUP BY payload
)
SELECT page_id, payload_bytes, sha1(s.payload) AS payload_digest,
  CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < original THEN original END AS refers_to
FROM sized s LEFT JOIN latest l ON s.payload = l.payload
"""

ORACLES: dict[str, str] = {
    "op9_warc_revisits": OP9_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
