"""Queries of this subpackage: name to function of (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import DISGUISED_BLANKS, WHITESPACE
from plumbline.llm import encoding_repair, format_dedupe, leakage, survivors, text_quality, tokenizing, visual_form
from plumbline.sources.tables import table

PLACEHOLDERS = list(DISGUISED_BLANKS)
RECORD_FIELDS = ["description", "part_description", "unit_price", "quantity", "country", "status", "order_date"]


def p1_restored(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_repair.find_garbled(table(spark, folder, "app_records"), "row_id", "description")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_restored(spark, folder).select("row_id")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return visual_form.lookalike_pairs(table(spark, folder, "app_records"), "row_id", ["app_number", "description"], PLACEHOLDERS)


def p2_classes(spark: SparkSession, folder: str) -> DataFrame:
    return visual_form.lookalike_classes(table(spark, folder, "app_records"), "row_id", ["app_number", "description"], PLACEHOLDERS)


def p2_one_form(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "app_records")
    return df.select("row_id", visual_form.visual_form(F.col("app_number")).alias("app_number"), visual_form.visual_form(F.col("description")).alias("description"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    df, sources = table(spark, folder, "app_records"), table(spark, folder, "source_systems")
    return survivors.surviving_row(df, sources, "row_id", "app_number", RECORD_FIELDS, ["description", "part_description"], "updated_at", "source_system", PLACEHOLDERS)


def p3_built(spark: SparkSession, folder: str) -> DataFrame:
    df, sources = table(spark, folder, "app_records"), table(spark, folder, "source_systems")
    return survivors.built_record(df, sources, "app_number", RECORD_FIELDS, "updated_at", "source_system", PLACEHOLDERS)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return format_dedupe.copies(table(spark, folder, "listing_rows"), "listing_id", ["app_number", "description"])


def p6_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return format_dedupe.collapse(table(spark, folder, "listing_rows"), "listing_id", ["app_number", "description"])


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizing.token_ids(table(spark, folder, "documents"), "doc_id", "text")


def p8_passages(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.passages(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_passages(spark, folder).select("doc_id", "item_id").distinct()


def p8_removal(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.removal_spans(p8_passages(spark, folder))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return text_quality.find_not_prose(table(spark, folder, "documents"), "doc_id", "text", text_quality.common_words(table(spark, folder, "common_words")))


def p9_figures(spark: SparkSession, folder: str) -> DataFrame:
    return text_quality.statistics(table(spark, folder, "documents"), "doc_id", "text", text_quality.common_words(table(spark, folder, "common_words")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_classes, p2_one_form, p3_found, p3_built, p6_found, p6_collapsed, p7_ids, p8_found, p8_passages, p8_removal, p9_found, p9_figures)}


_WORDS = r"regexp_extract_all(lower(t), '[\p{L}\p{M}]+')"
_FIGURES = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), c AS (SELECT DISTINCT lower(word) AS w FROM common_words WHERE word IS NOT NULL),
 a AS (SELECT doc_id, t, {_WORDS} AS words, list_filter(regexp_split_to_array(t, '[\r\n]+'), lambda x: length(trim(x, ' ' || chr(9))) > 0) AS lines,
  length(t) AS n_chars, len(list_filter(regexp_split_to_array(t, '[,;:.!?|/=()<>\[\]{{}}\t]+'), lambda x: regexp_matches(x, '\p{{L}}'))) AS clauses FROM d),
 b AS (SELECT *, len(words) AS n, len(lines) AS k FROM a),
 k AS (SELECT doc_id, count(w) AS common FROM (SELECT doc_id, unnest(words) AS word FROM b) LEFT JOIN c ON w = word GROUP BY doc_id)
SELECT b.doc_id, n_chars, k AS n_lines, n AS n_words, CASE WHEN n > 0 THEN length(array_to_string(words, '')) / n END AS mean_word_length, CASE WHEN k > 0 THEN n / k END AS words_per_line, CASE WHEN clauses > 0 THEN n / clauses END AS words_per_clause,
 CASE WHEN n_chars > 0 THEN length(regexp_replace(t, '[\p{{L}}\p{{M}}\p{{N}}\s\x0b]+', '', 'g')) / n_chars END AS symbol_ratio, CASE WHEN n_chars > 0 THEN length(regexp_replace(t, '[^0-9]+', '', 'g')) / n_chars END AS digit_ratio,
 CASE WHEN n_chars > 0 THEN length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) / n_chars END AS upper_ratio, CASE WHEN k > 0 THEN len(list_filter(lines, lambda x: regexp_matches(x, '[.!?:…"”»][\s\x0b]*$'))) / k END AS line_end_share,
 CASE WHEN k > 0 THEN len(list_filter(lines, lambda x: regexp_matches(x, '^[\s\x0b]*([-*•–#|\[]|[0-9]+[.)])'))) / k END AS bullet_share, CASE WHEN n > 0 THEN coalesce(common, 0) / n END AS common_share, CASE WHEN n > 0 THEN len(list_distinct(words)) / n END AS distinct_share
FROM b LEFT JOIN k ON k.doc_id = b.doc_id"""


def oracle_sql() -> dict[str, str]:
    found = f"SELECT doc_id FROM ({_FIGURES}) WHERE doc_id IN (SELECT doc_id FROM documents WHERE length(trim(text, {' || '.join(f'chr({ord(c)})' for c in WHITESPACE)})) > 0) AND {text_quality.not_prose()}"
    return {"p9_figures": _FIGURES, "p9_found": found}
