"""Registered queries of this subpackage; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm import (
    alignment, decontamination, licenses, mixing, pages, passages, preferences, quality, scoring, simhash, vectors, warc, whitening,
)
from holdfast.llm.text import LOWER, UPPER


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(_table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.report(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(_table(spark, sf_dir, "pages"))


def op10_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return preferences.formatted(turns, preferences.neighbours(turns))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(_table(spark, sf_dir, "documents"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.report(_table(spark, sf_dir, "embeddings"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_simhash_near_dedup, op2_suffix_array_dedup, op3_license_scan, op4_decontamination, op5_warc_audit, op6_quality_rules,
        op7_lm_scoring, op8_mixing, op9_html_extraction, op10_preference_formatting, op11_tokenizer_alignment,
        op12_embedding_near_dedup, op13_embedding_whitening,
    )
    return {f.__name__: f for f in every}


_LETTERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"


def _lettered(table: str, key: str) -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"SELECT {key}, regexp_extract_all({lower}, '{_LETTERED}') AS w FROM {table}"


def oracle_sql() -> dict[str, str]:
    """SQL twins. The other operators rest on hashes or models that SQL has not; tests/llm holds plain versions of them."""
    return {
        "op4_decontamination": f"""WITH d AS ({_lettered("documents", "doc_id")}), b AS ({_lettered("benchmark", "item_id")}),
            s AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
            wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
              FROM s, unnest(range(1, len(w) - n + 2)) t(i)),
            places AS (SELECT doc_id, i, z.n, array_to_string(w[i:i + z.n - 1], ' ') AS g
              FROM d, (SELECT DISTINCT n FROM s) z, unnest(range(1, len(w) - z.n + 2)) t(i)),
            hits AS (SELECT doc_id, item_id, i, n FROM places JOIN wins USING (n, g)),
            words AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n_hit FROM hits, unnest(range(n)) t(k) GROUP BY doc_id),
            items AS (SELECT doc_id, COUNT(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id),
            t AS (SELECT item_id, w, unnest(w) AS t FROM b), c AS (SELECT t, COUNT(*) AS n FROM t GROUP BY t),
            few AS (SELECT item_id, list(t ORDER BY n, t)[:3] AS f FROM (SELECT DISTINCT * FROM t) JOIN c USING (t)
              GROUP BY item_id, w HAVING COUNT(*) > 2),
            p AS (SELECT doc_id, i, w[i] AS t FROM d, unnest(range(1, len(w) + 1)) x(i)
              WHERE w[i] IN (SELECT unnest(f) FROM few)),
            nears AS (SELECT a.doc_id, COUNT(DISTINCT item_id) AS n_near,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS near_ids
              FROM few JOIN p a ON a.t = f[1] JOIN p b ON b.t = f[2] AND b.doc_id = a.doc_id AND abs(b.i - a.i) <= 20
              JOIN p c ON c.t = f[3] AND c.doc_id = a.doc_id AND abs(c.i - a.i) <= 20 GROUP BY a.doc_id)
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
              sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
              coalesce(n_near, 0) AS n_near, sha256(coalesce(near_ids, '')) AS near_sha256
            FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN nears USING (doc_id)""",
        "op6_quality_rules": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
              regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
            g AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS n
              FROM d, unnest(range(1, len(w) - 1)) x(i)),
            r AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM g, unnest(range(3)) x(k) WHERE g.n > 1 GROUP BY doc_id),
            m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
              length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
              list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_SPACED}')) AS lines,
              coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN r USING (doc_id)),
            n AS (SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
              n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
            SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
              CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
              NOT (base_failed OR 100 * n_symbols > 8 * word_chars OR 100 * n_dup_lines > 50 * n_lines
                OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM n""",
    }
