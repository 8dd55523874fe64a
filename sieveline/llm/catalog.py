"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm.chats import op3_chat_format
from sieveline.llm.decontamination import OP5_SQL, op5_decontamination
from sieveline.llm.linededup import OP9_SQL, op9_line_dedup
from sieveline.llm.language import op4_language
from sieveline.llm.licenses import op2_licenses
from sieveline.llm.packing import op8_packing
from sieveline.llm.quality import op7_quality
from sieveline.llm.secrets import op6_secrets
from sieveline.llm.simhash import op1_simhash_dedup
from sieveline.llm.toxicity import op10_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op2 SQL can say: the phrases, without templates."""
    return op2_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op6 SQL can say: how often each plain pattern matches."""
    return op6_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op7 SQL can say: the counts and the base rule."""
    return op7_quality(spark, sf_dir).drop("kept", "ratio")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PHRASES_SQL = rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split
), runs AS (
  SELECT doc_id, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), found AS (
  SELECT doc_id, i, CASE WHEN w = 'mit' AND w2 = 'license' THEN 'mit' WHEN w = 'apache' AND w2 = 'license' THEN 'apache'
    WHEN w = 'general' AND w2 = 'public' AND w3 = 'license' THEN 'gpl' END AS label FROM runs
), sums AS (
  SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found WHERE label IS NOT NULL GROUP BY doc_id
)
SELECT split.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word, coalesce(labels, '') AS base_labels
FROM split LEFT JOIN sums USING (doc_id)
"""
SECRETS_SQL = r"""
SELECT doc_id,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6)) AS BIGINT) AS n_assign,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS BIGINT) AS n_access,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24)) AS BIGINT) AS n_hex
FROM documents
"""
QUALITY_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split
), runs AS (
  SELECT doc_id, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), again AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n FROM runs WHERE w3 IS NOT NULL
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
  SELECT split.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
"""


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_dedup": op1_simhash_dedup,
        "op2_licenses": op2_licenses,
        "op3_chat_format": op3_chat_format,
        "op4_language": op4_language,
        "op5_decontamination": op5_decontamination,
        "op6_secrets": op6_secrets,
        "op7_quality": op7_quality,
        "op8_packing": op8_packing,
        "op9_line_dedup": op9_line_dedup,
        "op10_toxicity": op10_toxicity,
        "license_phrases": license_phrases,
        "secret_counts": secret_counts,
        "quality_counts": quality_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": OP5_SQL, "op9_line_dedup": OP9_SQL, "license_phrases": PHRASES_SQL, "secret_counts": SECRETS_SQL, "quality_counts": QUALITY_SQL}
