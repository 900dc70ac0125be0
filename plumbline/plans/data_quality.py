"""Queries on rows that fail to parse and on the quality of columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.config import DISGUISED_BLANKS, WHITESPACE
from plumbline.functions.values import NUMBER
from plumbline.operators import failed_rows, quality_profile
from plumbline.sources.tables import table

RAW_COLUMNS = ["app_number", "description", "part_description", "unit_price", "quantity", "weight", "country", "status", "order_date", "is_active"]


def p4_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return failed_rows.rejected(table(spark, folder, "raw_records"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_rejected(spark, folder).select("record_id")


def p4_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return failed_rows.loaded(failed_rows.read_records(table(spark, folder, "raw_records")), "record_id", RAW_COLUMNS)


PROFILED = ["app_number", "description", "part_description", "unit_price", "quantity", "country", "status", "order_date"]


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return quality_profile.changed_columns(table(spark, folder, "app_records"), "load_no", PROFILED, table(spark, folder, "cell_masks"))


def p5_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality_profile.profile(table(spark, folder, "app_records"), "load_no", PROFILED, table(spark, folder, "cell_masks"))


def p5_stability(spark: SparkSession, folder: str) -> DataFrame:
    return quality_profile.stability(table(spark, folder, "app_records"), "load_no", PROFILED, table(spark, folder, "cell_masks"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p4_found, p4_rejected, p4_loaded, p5_found, p5_profile, p5_stability)}


_STRIPPED = "trim(value, " + "||".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"
_PROFILE = f"""WITH cells AS ({" UNION ALL ".join(f"SELECT load_no, '{c}' AS column_name, {c} AS value FROM app_records" for c in PROFILED)}),
 c AS (SELECT load_no, column_name, value, count(*) AS n, NOT coalesce(lower({_STRIPPED}) IN ({",".join(f"'{w}'" for w in DISGUISED_BLANKS)}), true) AS filled, translate(value, '£$€¥, ()', '') AS t FROM cells GROUP BY load_no, column_name, value),
 d AS (SELECT *, CASE WHEN filled AND regexp_matches(t, '{NUMBER}') THEN try_cast(t AS DOUBLE) END AS x FROM c),
 m AS (SELECT load_no, column_name, count(*) FILTER (WHERE fail_mask) AS f, count(*) FILTER (WHERE price_review_mask) AS r FROM cell_masks GROUP BY load_no, column_name)
SELECT d.load_no, d.column_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS n_missing, CAST(coalesce(sum(n) FILTER (WHERE value IS NOT NULL AND NOT filled), 0) AS BIGINT) AS n_placeholder,
 count(*) FILTER (WHERE filled) AS n_distinct, min(length(value)) FILTER (WHERE filled) AS min_length, max(length(value)) FILTER (WHERE filled) AS max_length, min(x) AS min_number, max(x) AS max_number,
 min(value) FILTER (WHERE filled) AS min_text, max(value) FILTER (WHERE filled) AS max_text, (max({{'n': n, 'value': value}}) FILTER (WHERE filled)).value AS top_value, (max({{'n': n, 'value': value}}) FILTER (WHERE filled)).n AS top_count,
 coalesce(max(f), 0) AS n_failed, coalesce(max(r), 0) AS n_review FROM d LEFT JOIN m ON m.load_no IS NOT DISTINCT FROM d.load_no AND m.column_name = d.column_name GROUP BY d.load_no, d.column_name"""


def oracle_sql() -> dict[str, str]:
    return {"p5_profile": _PROFILE}
