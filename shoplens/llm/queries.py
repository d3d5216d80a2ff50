"""The operators' queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, bpe, conversations, decontamination, license_scan, near_dedup, pii, repeats, simhash, token_counts, token_files,
    topk, toxicity,
)
from .common import read_table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_report(read_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(read_table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(read_table(spark, sf_dir, "documents"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return conversations.repair_report(rows, conversations.damage(rows))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"))


_OPERATORS = [
    op1_decontaminate, op2_exact_topk, op3_minhash_near_dedup, op4_token_files, op5_license_scan, op6_toxicity,
    op7_bpe_round_trip, op8_pii, op9_token_counts, op10_repeated_strings, op11_simhash_near_dedup, op12_conversation_repair,
    op13_tokenizer_alignment,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {f.__name__: f for f in _OPERATORS} | {"pipeline": corpus_pipeline.run}


_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_NEAR_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN []
         WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), both_have AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM both_have JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach(x, y) AS (
  SELECT x, y FROM link
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), least AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(l.y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.y, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least l ON l.x = d.doc_id
"""


def _repair_sql() -> str:
    """The cheapest edits by recursion from a conversation's last row, keeping
    (cost, letters, rows) of the best rest for each of the four states."""

    def put(q: int, v: str) -> str:  # insert in state q, then go on by v
        to, role = (3, "assistant") if q == 2 else (2, "user")
        rest = f"{v}[{to + 1}]"
        return f"{{'c': {rest}.c + 5, 'a': 'I' || {rest}.a, 'r': chr(10) || '{role}:' || {rest}.r}}"

    def take(q: int) -> str:  # the row's own edit in state q
        to, role = (3, "assistant") if q == 2 else (2, "user")
        keep = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[q]
        options = [f"{{'c': v[{q + 1}].c + 2, 'a': 'D' || v[{q + 1}].a, 'r': v[{q + 1}].r}}"]
        for initial, after in keep.items():
            rest = f"v[{after + 1}]"
            options.append(
                f"CASE WHEN NOT gone AND left(role, 1) = '{initial}' THEN {{'c': {rest}.c + extra, 'a': 'K' || {rest}.a,"
                f" 'r': chr(10) || role || ':' || text || {rest}.r}} END"
            )
        rest = f"v[{to + 1}]"
        options.append(
            f"CASE WHEN NOT gone THEN {{'c': {rest}.c + 1 + extra, 'a': 'R' || {rest}.a,"
            f" 'r': chr(10) || '{role}:' || text || {rest}.r}} END"
        )
        return f"list_min([{', '.join(options)}])"

    def better(v: str) -> str:
        return "[" + ", ".join(f"least(b[{q + 1}], {put(q, v)})" for q in range(4)) + "]"

    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), faulty AS (
  SELECT *, xor(list_reduce(
      flatten(list_transform(string_split(k, ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
      lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS fault
  FROM keyed
), hurt AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM faulty WHERE fault <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt
), judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS meet,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM numbered
), edits AS (
  SELECT *, blank OR again AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS extra FROM judged
), rest(conv_id, i, v) AS (
  SELECT DISTINCT conv_id, n, [
    {{'c': 0, 'a': '', 'r': ''}}, {{'c': 10, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}},
    {{'c': 5, 'a': 'I', 'r': chr(10) || 'assistant:'}}, {{'c': 0, 'a': '', 'r': ''}}]
  FROM edits
  UNION ALL
  SELECT conv_id, i, {better("o")} FROM (
    SELECT conv_id, i, b, {better("b")} AS o FROM (
      SELECT e.conv_id, e.i - 1 AS i, [{", ".join(take(q) for q in range(4))}] AS b
      FROM rest JOIN edits e ON e.conv_id IS NOT DISTINCT FROM rest.conv_id AND e.i = rest.i
    )
  )
), best AS (
  SELECT conv_id, v[1] AS b FROM rest WHERE i = 0
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (NOT gone AND cut) AS truncated, count(*) FILTER (meet NOT IN ('su', 'ua', 'au')) AS illegal
  FROM edits GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_topk": _TOPK_SQL, "op3_minhash_near_dedup": _NEAR_SQL, "op12_conversation_repair": _repair_sql()}
