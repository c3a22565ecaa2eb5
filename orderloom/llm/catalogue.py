"""Queries of the corpus operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import (
    byte_bpe,
    decontaminate,
    fingerprints,
    line_dedup,
    near_dedup,
    prefix_trie,
    quality,
    substring_dedup,
    token_counts,
    token_output,
    toxicity,
    warc,
    whitening,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_matches(table(spark, folder, "documents"))


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_output.stored(table(spark, folder, "documents"), path)


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, folder, "documents"), path)


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, folder, "documents"), path)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, folder, "conversations"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.components(table(spark, folder, "embeddings"))


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digests(table(spark, folder, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_token_files": op6_token_files,
    "op7_fingerprints": op7_fingerprints,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_quality": op10_quality,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_substring_dedup": op13_substring_dedup,
}

ORACLE_SQL = {
    # base32 of the hexadecimal digest: every five hexadecimal digits make four letters
    "op1_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT)
           >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
""",
    # windows of the items' sizes are listed for all documents and joined as texts
    "op2_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)
), dw AS (
  SELECT rid, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)
), h AS (
  SELECT rid, i, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM h) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL)
  GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
""",
    # every prefix of every rebuilt conversation, and sums over all pairs of a prefix and one below it
    "op11_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '')
           || coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS b, turn
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, list({'h': h, 'b': b} ORDER BY turn NULLS FIRST, h) AS w FROM t GROUP BY conv_id
), crc_bits(i, v) AS (
  SELECT i, CAST(i AS UBIGINT) FROM range(256) r(i)
), crc_table AS (
  SELECT list(list_reduce(list_prepend(v, range(8)::UBIGINT[]),
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY i) AS steps
  FROM crc_bits
), crc AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
    lambda a, c: xor(a >> 8, steps[CAST(xor(a & 255, c) + 1 AS INT)])), 4294967295::UBIGINT) % 9 AS h
  FROM l, crc_table
), r AS (
  SELECT l.conv_id, list_concat(coalesce(b.w, [])[1:CAST(h AS INT)], l.w[CAST(h AS INT) + 1:]) AS w
  FROM l JOIN crc USING (conv_id) LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 5
), p AS (
  SELECT conv_id, d, len(w) AS size, CASE WHEN d > 0 THEN w[d].b ELSE 0 END AS b,
         sha256(array_to_string(list_transform(w[1:d], lambda x: x.h), '')) AS p,
         CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(w[1:d - 1], lambda x: x.h), '')) END AS up
  FROM (SELECT conv_id, w, unnest(range(len(w) + 1)) AS d FROM r)
), n AS (
  SELECT p, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM p GROUP BY p, d
), c AS (
  SELECT up AS p, count(*) AS n_children FROM n GROUP BY up
), pairs AS (
  SELECT DISTINCT x.p AS top, y.p AS below FROM p x JOIN p y ON x.conv_id = y.conv_id AND x.d <= y.d
), s AS (
  SELECT top AS p, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * b) AS saved_tokens
  FROM pairs JOIN n ON n.p = below LEFT JOIN c ON c.p = below GROUP BY top
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN n u ON u.p = n.up LEFT JOIN c ON c.p = n.p JOIN s ON s.p = n.p
""",
    # all windows of all documents are listed
    "op13_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), win AS (
  SELECT rid, o, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT rid, o, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), hit AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS p
  FROM win JOIN (SELECT s, min(o) AS least FROM win GROUP BY s) USING (s) WHERE o > least
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
       ANTI JOIN hit USING (rid, p)
  GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
""",
}
