"""One query per operator, over whole tables, and SQL where it can express the result."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import (
    bpe, exact, langid, licenses, lm, minhash, packing, quality, repair, repetition, suffix, tokenfile, whitening,
)
from tradeloom.llm.text import table


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_minmax_hash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.decide(table(spark, folder))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(table(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op6_token_file(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op7_repetition_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, folder))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return lm.cross_entropy_difference(table(spark, folder), good)


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder), table(spark, folder, "labels"))


def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, folder))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.repair_report(repair.damage(conversations), conversations)


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder)).drop("notices", "expressions")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_minmax_hash_dedup": op2_minmax_hash_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_vector_packing": op4_vector_packing,
    "op5_language_id": op5_language_id,
    "op6_token_file": op6_token_file,
    "op7_repetition_rules": op7_repetition_rules,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_license_scan": op13_license_scan,
}

ORACLE = {
    "op2_minmax_hash_dedup": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        shingle AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM worded),
        size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
        pair AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
            FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (
            SELECT u, v FROM pair JOIN size a ON a.doc_id = u JOIN size b ON b.doc_id = v
            WHERE 100 * common >= 75 * (a.n + b.n - common)),
        reach AS (
            SELECT doc_id AS u, doc_id AS v FROM documents
            UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept
        FROM (SELECT u AS doc_id, min(v) AS c FROM reach GROUP BY u) LEFT JOIN size USING (doc_id)""",
    "op3_exact_dedup": """
        WITH plain AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM plain WINDOW g AS (PARTITION BY text_sha256)""",
    "op10_suffix_array_dedup": """
        WITH body AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x FROM documents),
        win AS (
            SELECT doc_id, unnest(range(1, octet_length(b) - 48)) AS p,
                unnest(list_transform(range(1, octet_length(b) - 48), lambda i: substr(x, 2 * i - 1, 100))) AS w
            FROM body),
        least AS (SELECT w, min(doc_id) AS d FROM win GROUP BY w),
        hit AS (SELECT doc_id, p FROM win JOIN least USING (w) WHERE d < doc_id),
        island AS (
            SELECT *, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true) AS starts FROM hit),
        span AS (
            SELECT doc_id, min(p) AS first, max(p) + 49 AS last
            FROM (SELECT doc_id, p, count(*) FILTER (starts) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM island)
            GROUP BY doc_id, k),
        gap AS (
            SELECT doc_id, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS before FROM span),
        gone AS (
            SELECT doc_id, sum(last - first + 1) AS r, count(*) AS s, max(last) AS rest,
                list({'a': before, 'z': first} ORDER BY first) AS cuts
            FROM gap GROUP BY doc_id)
        SELECT doc_id, octet_length(b) AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(s, 0) AS n_spans,
            sha256(unhex(coalesce(array_to_string(list_transform(cuts, lambda c: substr(x, 2 * c.a + 1, 2 * (c.z - 1 - c.a))), ''), '')
                || substr(x, 2 * coalesce(rest, 0) + 1))) AS kept_sha256
        FROM body LEFT JOIN gone USING (doc_id)""",
    "op11_conversation_repair": r"""
        WITH RECURSIVE bits AS (
            SELECT k AS byte, k::UBIGINT AS v, 0 AS n FROM range(256) t(k)
            UNION ALL SELECT byte, xor(v >> 1, 3988292384::UBIGINT * (v & 1)), n + 1 FROM bits WHERE n < 8),
        crc AS (SELECT list(v ORDER BY byte) AS steps FROM bits WHERE n = 8),
        source AS (
            SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
            FROM conversations),
        faulty AS (
            SELECT conv, turn, role, text, xor(4294967295::UBIGINT, list_reduce(
                list_prepend(4294967295::UBIGINT, list_transform(range(1, len(key) + 1), lambda i: ascii(substr(key, i::INT, 1))::UBIGINT)),
                lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255)::INT + 1]))) % 20 AS fault
            FROM source, crc),
        damaged AS (
            SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
            FROM faulty WHERE fault <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM damaged),
        judged AS (
            SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS again,
                NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open,
                lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY pos) AS before
            FROM placed),
        step AS (
            SELECT *, (NOT blank AND NOT again AND open)::INT AS late, blank OR again AS must_go FROM judged),
        ins(a, b, cost, letters, lines) AS (VALUES
            (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
            (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'),
            (3, 2, 2, 'I', chr(10) || 'user:'), (2, 3, 2, 'I', chr(10) || 'assistant:'),
            (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
            (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
            (3, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
            (2, 2, 4, 'II', chr(10) || 'assistant:' || chr(10) || 'user:')),
        moves(b, z, edit, initial, cost, role) AS (VALUES
            (0, 0, 'D', NULL, 3, NULL), (1, 1, 'D', NULL, 3, NULL), (2, 2, 'D', NULL, 3, NULL), (3, 3, 'D', NULL, 3, NULL),
            (0, 1, 'K', 's', 0, NULL), (0, 2, 'K', 'u', 0, NULL), (1, 2, 'K', 'u', 0, NULL), (3, 2, 'K', 'u', 0, NULL),
            (2, 3, 'K', 'a', 0, NULL), (0, 2, 'R', NULL, 2, 'user'), (1, 2, 'R', NULL, 2, 'user'), (3, 2, 'R', NULL, 2, 'user'),
            (2, 3, 'R', NULL, 2, 'assistant')),
        path AS (
            SELECT DISTINCT conv, 0::BIGINT AS pos, 0 AS z, {'c': 0::BIGINT, 'a': '', 'r': ''} AS best FROM placed
            UNION ALL
            SELECT p.conv, s.pos, m.z, min({'c': best.c + i.cost + m.cost + CASE WHEN edit = 'D' THEN 0 ELSE late END,
                'a': best.a || i.letters || edit,
                'r': best.r || i.lines || CASE WHEN edit = 'D' THEN '' ELSE chr(10) || coalesce(m.role, s.role) || ':' || s.text END})
            FROM path p JOIN step s ON s.conv IS NOT DISTINCT FROM p.conv AND s.pos = p.pos + 1
                JOIN ins i ON i.a = p.z JOIN moves m ON m.b = i.b
            WHERE (edit = 'D' OR NOT must_go) AND (m.initial IS NULL OR m.initial = s.initial)
            GROUP BY p.conv, s.pos, m.z),
        size AS (
            SELECT conv, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, sum(late) AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM step GROUP BY conv),
        ends AS (
            SELECT size.*, min({'c': best.c + i.cost, 'a': best.a || i.letters, 'r': best.r || i.lines}) AS best
            FROM size JOIN path p ON p.conv IS NOT DISTINCT FROM size.conv AND p.pos = n JOIN ins i ON i.a = p.z
            WHERE i.b = 3 OR (i.b = 0 AND i.a = 0) GROUP BY ALL)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
            coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
            coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ends ON ends.conv IS NOT DISTINCT FROM o.conv_id""",
}
