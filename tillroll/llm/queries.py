"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import alignment, bpe, conversations, decontaminate, exact_dedup, html_text, packing, pii, quality, simhash, suffix_dedup, swap_packing, toxicity
from tillroll.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), depth=200)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, length=2048, pad=50256)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3, seed=42)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("full_sha256").alias("text_sha256"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digest(conversations.damage(table(spark, sf_dir, "conversations")))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return swap_packing.pack_documents(table(spark, sf_dir, "documents"), path, length=4096, end_id=1)


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    a_path, b_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_digest(table(spark, sf_dir, "documents"), a_path, b_path)


QUERIES: dict[str, QueryFn] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_html_text": op8_html_text,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pii": op10_pii,
    "op11_conversations": op11_conversations,
    "op12_best_fit": op12_best_fit,
    "op13_align": op13_align,
}

ORACLE_SQL: dict[str, str] = {
    # Another complete filter than the masks: 12 words with two substitutions
    # at most hold a run of four equal words, items of 2 to 11 words a run of two.
    "op4_decontaminate": """
        WITH d AS (
          SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
          FROM documents
        ), b AS (
          SELECT *, len(w) AS m, CASE WHEN len(w) >= 12 THEN 4 WHEN len(w) >= 2 THEN 2 ELSE 1 END AS k
          FROM (SELECT DISTINCT item_id,
                       list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
                FROM benchmark)
          WHERE len(w) > 0
        ), dg AS (
          SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
                FROM (SELECT *, unnest((SELECT list(DISTINCT k) FROM b)) AS k FROM d))
        ), bg AS (
          SELECT item_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
          FROM (SELECT item_id, w, k, unnest(range(1, m - k + 2)) AS p FROM b)
        ), line AS (
          SELECT DISTINCT doc_id, item_id, dg.p - bg.p AS shift FROM dg JOIN bg USING (k, g)
        ), word AS (
          SELECT doc_id, item_id, shift, m, n, i, CASE WHEN bw[i] = dw[i + shift] THEN 1 ELSE 0 END AS same
          FROM (SELECT line.*, b.w AS bw, d.w AS dw, len(b.w) AS m, len(d.w) AS n, unnest(range(1, len(b.w) + 1)) AS i
                FROM line JOIN b USING (item_id) JOIN d USING (doc_id))
          WHERE i + shift BETWEEN 1 AND n
        ), seen AS (
          SELECT doc_id, item_id, shift, m, i,
                 sum(same) OVER ahead AS n_equal, count(*) OVER ahead AS size
          FROM word
          WINDOW ahead AS (PARTITION BY doc_id, item_id, shift ORDER BY i ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)
        ), hit AS (
          SELECT doc_id, item_id, i + shift - 1 AS doc_at, size, n_equal
          FROM seen
          WHERE (m >= 12 AND size = 12 AND n_equal >= 10)
             OR (m < 12 AND i = 1 AND size = m AND n_equal >= ceil(0.8 * m))
        )
        SELECT doc_id, item_id, count(*) AS n_windows, CAST(max(n_equal) AS INTEGER) AS best_equal,
               CAST(min(doc_at) AS INTEGER) AS first_word, CAST(max(doc_at + size - 1) AS INTEGER) AS last_word
        FROM hit GROUP BY doc_id, item_id
    """,
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    # A plain search row by row, forward: per state the least (cost, audit).
    "op11_conversations": """
        WITH RECURSIVE source AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
          FROM conversations
        ), coded AS (
          SELECT *, xor(list_reduce(
                   list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
                   lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))
                 ), 4294967295) % 20 AS code
          FROM source
        ), damaged AS (
          SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
                 CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
          FROM coded, (VALUES (1), (2)) AS v(copy) WHERE code <> 0 AND (copy = 1 OR code = 3)
        ), placed AS (
          SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n
          FROM damaged
        ), faulty AS (
          SELECT *, CASE WHEN seen = '' THEN 'blank'
                         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                         WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                 left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
          FROM placed
        ), inserted(p, k, q, letters, added) AS (
          VALUES (0, 0, 0, '', []), (0, 1, 2, 'I', ['user:']), (0, 2, 3, 'II', ['user:', 'assistant:']),
                 (1, 0, 1, '', []), (1, 1, 2, 'I', ['user:']), (1, 2, 3, 'II', ['user:', 'assistant:']),
                 (2, 0, 2, '', []), (2, 1, 3, 'I', ['assistant:']), (2, 2, 2, 'II', ['assistant:', 'user:']),
                 (3, 0, 3, '', []), (3, 1, 2, 'I', ['user:']), (3, 2, 3, 'II', ['user:', 'assistant:'])
        ), kept(p, initial, q) AS (
          VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
        ), done(p, letter, price, q, word) AS (
          VALUES (0, 'D', 2, 0, ''), (1, 'D', 2, 1, ''), (2, 'D', 2, 2, ''), (3, 'D', 2, 3, ''),
                 (0, 'K', 0, 0, ''), (1, 'K', 0, 0, ''), (2, 'K', 0, 0, ''), (3, 'K', 0, 0, ''),
                 (0, 'R', 1, 2, 'user'), (1, 'R', 1, 2, 'user'), (2, 'R', 1, 3, 'assistant'), (3, 'R', 1, 2, 'user')
        ), walk AS (
          SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, 0 AS q, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best
          FROM source
          UNION ALL
          SELECT w.conv_id, f.n, CASE done.letter WHEN 'K' THEN kept.q ELSE done.q END AS q,
                 min({'cost': w.best.cost + 5 * i.k + done.price + CASE WHEN done.letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END,
                      'audit': w.best.audit || i.letters || done.letter,
                      'lines': list_concat(w.best.lines, list_concat(i.added, CASE done.letter
                        WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [done.word || ':' || f.text] END))}) AS best
          FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
          JOIN inserted i ON i.p = w.q JOIN done ON done.p = i.q
          LEFT JOIN kept ON kept.p = i.q AND kept.initial = f.initial
          WHERE done.letter = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (done.letter = 'R' OR kept.q IS NOT NULL))
          GROUP BY 1, 2, 3
        ), size AS (
          SELECT c.conv_id, count(f.n) AS n,
                 coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps,
                 count(*) FILTER (f.fault = 'blank') AS blank, count(*) FILTER (f.fault = 'duplicate') AS duplicate,
                 count(*) FILTER (f.fault = 'truncated') AS truncated,
                 count(*) FILTER (f.before IS NOT NULL AND f.before || f.initial NOT IN ('su', 'ua', 'au')) AS illegal
          FROM (SELECT DISTINCT conv_id FROM source) c LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
          GROUP BY c.conv_id
        ), finished AS (
          SELECT s.*, min({'cost': w.best.cost + 5 * i.k, 'audit': w.best.audit || i.letters, 'lines': list_concat(w.best.lines, i.added)})
                        OVER (PARTITION BY s.conv_id) AS best,
                 row_number() OVER (PARTITION BY s.conv_id) AS r
          FROM size s JOIN walk w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.n = s.n
          JOIN inserted i ON i.p = w.q AND i.q IN (0, 3)
        )
        SELECT conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
               sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
        FROM finished WHERE r = 1
    """,
}
