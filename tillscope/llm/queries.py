"""One query per operator, over whole tables, and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillscope.llm import (
    decontamination, exact_dedup, importance, language_id, lm_scoring, mixing, near_dedup,
    page_text, prefix_trie, pseudonyms, substring_dedup, token_alignment, winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, folder))


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, folder))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, folder))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, folder))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicate_once(documents(spark, folder))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extract(spark.read.parquet(f"{folder}/pages.parquet"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.predict_languages(documents(spark, folder))


def op8_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op9_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed key, so that results repeat; a user keeps a secret one."""
    return pseudonyms.pseudonymised(documents(spark, folder), "query")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, folder), items)


def op11_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.fingerprinted(documents(spark, folder))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_tokens(documents(spark, folder))


QUERIES: dict[str, Query] = {
    "op1_source_mix": op1_source_mix,
    "op2_near_dedup": op2_near_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_language_id": op7_language_id,
    "op8_importance_resampling": op8_importance_resampling,
    "op9_pseudonyms": op9_pseudonyms,
    "op10_decontamination": op10_decontamination,
    "op11_winnowing": op11_winnowing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_alignment": op13_token_alignment,
}

# SQL for the operators that SQL can express on whole tables.
ORACLE_SQL: dict[str, str] = {
    "op1_source_mix": f"""
WITH sizes AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT *, 2 * source_size AS upper_limit,
         [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
  FROM per_source
), levels AS (
  SELECT *,
         sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - coalesce(sum(upper_limit) OVER earlier, 0) AS words_left,
         sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weight_open
  FROM weighed
  WINDOW earlier AS (ORDER BY upper_limit / weight, source IS NULL, source
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), flagged AS (
  SELECT *, upper_limit * weight_open < weight * words_left AS limited FROM levels
), targets AS (
  SELECT source, source_size, CASE WHEN limited THEN CAST(upper_limit AS DOUBLE) ELSE
           weight * max(words_left) FILTER (NOT limited) OVER ()
           / max(weight_open) FILTER (NOT limited) OVER () END AS target
  FROM flagged
), claims AS (
  SELECT *, target / {mixing.BLOCK_WORDS} AS quota,
         CAST(round(sum(target) OVER () / {mixing.BLOCK_WORDS}) AS BIGINT) AS seats,
         CAST(greatest(1, least({mixing.MAX_SHARDS}, ceil(source_size / {mixing.SHARD_WORDS}))) AS BIGINT) AS shards
  FROM targets
), quotients AS (
  SELECT source, quota / (2 * k + 1) AS quotient,
         row_number() OVER (ORDER BY quota / (2 * k + 1) DESC, source, k) <= seats AS won
  FROM claims, LATERAL (SELECT unnest(range(CAST(ceil(quota) AS BIGINT) + 50)) AS k)
  WHERE quota > 0
), source_seats AS (
  SELECT claims.*, coalesce(blocks, 0) AS source_blocks
  FROM claims LEFT JOIN (SELECT source AS s, count(*) FILTER (won) AS blocks FROM quotients GROUP BY s) AS dealt
  ON claims.source IS NOT DISTINCT FROM dealt.s
), drawn AS (
  SELECT doc_id, size, t.*, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM sizes JOIN source_seats AS t ON sizes.source IS NOT DISTINCT FROM t.source
), sharded AS (
  SELECT *, CAST('0x' || substr(draw, 1, 8) AS BIGINT) % shards AS shard FROM drawn
), shard_claims AS (
  SELECT source, shard, source_blocks, CAST(sum(size) AS BIGINT) AS shard_size,
         source_blocks * CAST(sum(size) AS BIGINT) / any_value(source_size) AS quota
  FROM sharded GROUP BY source, shard, source_blocks
), shard_quotients AS (
  SELECT source, shard,
         row_number() OVER (PARTITION BY source ORDER BY quota / (2 * k + 1) DESC, shard, k)
           <= source_blocks AS won
  FROM shard_claims, LATERAL (SELECT unnest(range(CAST(ceil(quota) AS BIGINT) + 50)) AS k)
  WHERE quota > 0
), shard_seats AS (
  SELECT source, shard, any_value(in_shard) AS in_shard, least(count(*) FILTER (won), 2 * any_value(in_shard)) AS blocks
  FROM shard_quotients JOIN (
    SELECT source AS s, shard AS h, CAST(ceil(shard_size / {mixing.BLOCK_WORDS}) AS BIGINT) AS in_shard FROM shard_claims
  ) ON source IS NOT DISTINCT FROM s AND shard = h
  GROUP BY source, shard
), placed AS (
  SELECT a.doc_id, a.size, a.source_size, a.target,
         coalesce(b.blocks, 0) AS blocks, coalesce(b.in_shard, 1) AS in_shard,
         sum(a.size) OVER (PARTITION BY a.source, a.shard ORDER BY a.draw, a.doc_id, a.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
  FROM sharded AS a LEFT JOIN shard_seats AS b
  ON a.source IS NOT DISTINCT FROM b.source AND a.shard = b.shard
), cut AS (
  SELECT *, blocks // in_shard AS rounds, (blocks % in_shard) * {mixing.BLOCK_WORDS} AS front FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(rounds * size + least(stop, front) - least(stop - size, front) AS BIGINT) AS taken
FROM cut""",
    "op2_near_dedup": f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{exact_dedup.UPPER}',
           '{exact_dedup.UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM split
), sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle AS x JOIN shingle AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM shared JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT a AS doc_id, a AS other FROM link
  UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a
), component AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id,
       d.doc_id = coalesce(c, d.doc_id) AS kept
FROM documents AS d LEFT JOIN sizes USING (doc_id) LEFT JOIN component USING (doc_id)""",
    "op5_exact_dedup": f"""
WITH rows AS (
  SELECT doc_id,
         sha256(translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.UPPER.lower()}')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM rows WINDOW same AS (PARTITION BY text_sha256)""",
    # The checksum is that of zip files: its bits are shifted out one at a time.
    "op12_prefix_trie": """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT c, count(*) AS n, c - (c % 20 + 20) % 20 AS first,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(range(1, len(CAST(c AS VARCHAR)) + 1),
                              lambda i: CAST(ascii(CAST(c AS VARCHAR)[i]) AS BIGINT))),
             lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                                      lambda v, j: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM turns GROUP BY c
), shared AS (
  SELECT s.c, s.first, s.h, least(s.h, coalesce(f.n, 0)) AS taken
  FROM sizes AS s LEFT JOIN sizes AS f ON s.first = f.c
), rebuilt AS (
  SELECT c, k - h + taken AS d, r, x FROM turns JOIN shared USING (c) WHERE k > h
  UNION ALL
  SELECT shared.c, k, r, x FROM shared JOIN turns ON turns.c = first WHERE k <= taken
), whole AS (
  SELECT c, list({'r': r, 'x': x} ORDER BY d) AS s FROM rebuilt GROUP BY c
), members AS (
  SELECT c, d, s[1:d] AS path, len(s) = d AS ends, len(regexp_extract_all(s[d].x, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM whole, LATERAL (SELECT unnest(range(1, len(s) + 1)) AS d)
  UNION ALL
  SELECT sizes.c, 0, [], whole.c IS NULL, 0 FROM sizes LEFT JOIN whole USING (c)
), nodes AS (
  SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends) AS ids
  FROM members GROUP BY path
), children AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), valued AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children, CAST(n IS NULL AS BIGINT) AS leaf, (n_convs - 1) * words AS saved
  FROM nodes LEFT JOIN children ON nodes.path = children.path
), sums AS (
  SELECT path[1:d] AS path, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM valued, LATERAL (SELECT unnest(range(depth + 1)) AS d) GROUP BY ALL
)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children,
       sums.n_leaves, sums.saved_tokens, sha256(coalesce(v.ids, '')) AS ends_sha256
FROM valued AS v JOIN sums ON v.path = sums.path
LEFT JOIN nodes AS up ON v.depth > 0 AND v.path[1:v.depth - 1] = up.path""",
}
