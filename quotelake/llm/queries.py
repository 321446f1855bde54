"""The registered queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quotelake.llm.chat import format_chats
from quotelake.llm.common import table
from quotelake.llm.decontamination import decontaminate
from quotelake.llm.exact_dedup import exact_dedup
from quotelake.llm.fingerprints import compare_with_next
from quotelake.llm.language_id import predict_languages
from quotelake.llm.ngram_join import similar_documents
from quotelake.llm.packing import pack_documents
from quotelake.llm.periodic_runs import run_digests
from quotelake.llm.quality import score_quality
from quotelake.llm.sharding import balanced_shards
from quotelake.llm.spelling import TYPO_EVERY, spelling_variants
from quotelake.llm.suffix_dedup import remove_repeats
from quotelake.llm.token_store import token_digest

BYTE_BPE = "byte_bpe_50k.json"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=400)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_ngram_join": op2_ngram_join,
    "op3_sharding": op3_sharding,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_token_store": op7_token_store,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_language_id": op10_language_id,
    "op11_spelling": op11_spelling,
    "op12_fingerprints": op12_fingerprints,
    "op13_periodic_runs": op13_periodic_runs,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NORMAL = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

ORACLE: dict[str, str] = {
    "op1_chat_formatting": """
        WITH turns AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                    md5(coalesce(text, ''))) AS pos
          FROM conversations),
        whole AS (
          SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY pos) AS body FROM turns GROUP BY conv_id),
        uniq AS (SELECT min(conv_id) AS conv_id, n, body, count(*) AS copies FROM whole GROUP BY n, body),
        prefixes AS (SELECT DISTINCT body[1:k] AS body FROM (SELECT body, unnest(range(1, n)) AS k FROM whole)),
        keep AS (SELECT * FROM uniq u WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.body = u.body))
        SELECT t.conv_id, (t.pos - 1) // 256 AS part, k.n AS n_turns, k.copies,
               string_agg('<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10), '' ORDER BY t.pos)
                 AS rendered
        FROM turns t JOIN keep k ON t.conv_id IS NOT DISTINCT FROM k.conv_id
        GROUP BY t.conv_id, (t.pos - 1) // 256, k.n, k.copies""",
    "op4_exact_dedup": f"""
        WITH norm AS (
          SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents),
        grp AS (
          SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM norm JOIN grp USING (text_sha256)""",
    "op2_ngram_join": f"""
        WITH RECURSIVE worded AS (
          SELECT doc_id, regexp_extract_all({NORMAL}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sets AS (
          SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
            ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END) AS s FROM worded),
        tokens AS (SELECT doc_id, unnest(s) AS t, len(s) AS n FROM sets),
        common AS (
          SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
          FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles,
               least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
        FROM sets""",
    "op8_decontamination": f"""
        WITH docs AS (
          SELECT doc_id, regexp_extract_all({NORMAL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        items AS (
          SELECT item_id, regexp_extract_all({NORMAL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        windows AS (
          SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 13 THEN [w]
            ELSE list_transform(range(1, len(w) - 11), lambda i: w[i:i + 12]) END) AS v FROM items WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT len(v) AS k FROM windows),
        places AS (
          SELECT doc_id, k, i, w[i:i + k - 1] AS v
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes)),
        hits AS (SELECT doc_id, k, i, item_id FROM places JOIN windows USING (v)),
        marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                   FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
        named AS (SELECT doc_id, list_sort(list_distinct(list(item_id::VARCHAR))) AS names FROM hits GROUP BY 1)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(len(names), 0)::BIGINT AS n_items,
               sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)""",
}
