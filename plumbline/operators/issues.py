"""Issues of cells: missing, placeholder, failed conversion, price to review, duplicate and invalid keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DISGUISED_BLANKS
from plumbline.functions import names as N
from plumbline.functions.blanks import is_filled, is_placeholder, strip
from plumbline.functions.values import failed, to_money, to_number
from plumbline.operators.rows import q


class Issue(Enum):
    """Kinds of issues with the colour and the name of their sheet (fixed values)."""

    FAILED = ("FFB3B3", "Failed Values")
    MISSING = ("FFD9A6", "Missing Values")
    DISGUISED = ("D5B3FF", "Disguised Blanks")
    PRICE = ("FFE599", "Price Anomalies")
    KEY_DUPLICATE = ("F4B6C2", "ID Duplicates")
    KEY_INVALID = ("CDB4DB", "ID Anomalies")
    FIELD = ("D9EAF7", "Field Anomalies")
    EQUAL_FIELD = ("92D050", "Field Duplicate Values")


def missing(c: Column) -> Column:
    return c.isNull()


def key_invalid(c: Column, blanks: Sequence[str] = DISGUISED_BLANKS) -> Column:
    return ~is_filled(c, blanks)


def duplicate_keys(df: DataFrame, key: str, row: str, blanks: Sequence[str] = DISGUISED_BLANKS) -> DataFrame:
    """(row, key) of every row whose key occurs more than once, outer blanks aside."""
    rows = df.where(is_filled(q(key), blanks)).select(q(row).alias(row), strip(q(key)).alias("__k"))
    many = rows.groupBy("__k").agg(F.count("*").alias("c")).where("c > 1").select(F.col("__k").alias("__m"))
    return rows.join(many, F.col("__k") == F.col("__m"), "left_semi").select(row, F.col("__k").alias(key))


def price_rule(df: DataFrame, column: str, blanks: Sequence[str] = DISGUISED_BLANKS, parse=to_number) -> Column:
    """Not above zero; and, where at least half of the filled cells are numbers, any other text but true and false."""
    c = q(column).cast("string")
    boolean = F.lower(strip(c)).isin("true", "false")
    number = F.when(~boolean, parse(c))
    counts = df.agg(F.count(number).alias("numbers"), F.count(c).alias("present")).first()
    low = F.coalesce(number <= 0, F.lit(False))
    if not counts.numbers:
        return F.lit(False)
    odd = c.isNotNull() & number.isNull() & ~boolean & ~is_placeholder(c, blanks)
    return (low | odd) if counts.numbers * 2 >= counts.present else low


def price_anomalies(df: DataFrame, column: str, row: str, blanks: Sequence[str] = DISGUISED_BLANKS) -> DataFrame:
    """(row, column) of the cells to review; money as people write it counts as a number."""
    return df.where(price_rule(df, column, blanks, to_money)).select(row, column)


def issue_columns(df: DataFrame, originals: Mapping[str, Column], kinds: Mapping[str, str], columns: Sequence[str], blanks: Sequence[str] = DISGUISED_BLANKS, prices: Mapping[str, Column] | None = None) -> list[Column]:
    """For each column an array of the issues of its cell, as structs (column_name, issue, value)."""
    out, prices = [], prices or {}
    for c in columns:
        value, original = q(c), originals.get(c, q(c).cast("string"))
        app = N.is_app_number(c)
        tests = [(Issue.FAILED, failed(original, value))] if c in originals else []
        if c in prices:
            tests.append((Issue.PRICE, prices[c]))
        if app:
            tests.append((Issue.KEY_INVALID, key_invalid(original, blanks)))
        else:
            review = prices.get(c, F.lit(False))
            tests += [(Issue.MISSING, original.isNull() & ~review), (Issue.DISGUISED, is_placeholder(original, blanks))]
        out += [F.when(t, F.struct(F.lit(c).alias("column_name"), F.lit(i.name).alias("issue"), original.alias("value"))) for i, t in tests]
    return out


def long_issues(df: DataFrame, row: str, cells: Sequence[Column]) -> DataFrame:
    """(row, column_name, issue, value): one row per flagged cell."""
    if not cells:
        return df.select(row).where("false").select(row, F.lit("").alias("column_name"), F.lit("").alias("issue"), F.lit("").alias("value"))
    return df.select(q(row).alias(row), F.explode(F.array_compact(F.array(*cells))).alias("__issue")).select(row, "__issue.*")


def table_issues(df: DataFrame, row: str, columns: Sequence[str], money: Sequence[str] = (), blanks: Sequence[str] = DISGUISED_BLANKS) -> DataFrame:
    """All issues of the given text columns, key duplicates included, in long form."""
    converted = {c: to_money(q(c)) for c in money}
    prices = {c: price_rule(df, c, blanks, to_money) for c in money if N.is_price(c)}
    staged = df.select(row, *[q(c).alias(c) for c in columns], *[v.alias(f"__{c}") for c, v in converted.items()])
    cells = []
    for c in columns:
        part = issue_columns(staged, {}, {}, [c], blanks, {c: prices[c]} if c in prices else None)
        if c in converted:
            part.append(F.when(failed(q(c), F.col(f"`__{c}`")), F.struct(F.lit(c).alias("column_name"), F.lit(Issue.FAILED.name).alias("issue"), q(c).alias("value"))))
        cells += part
    result = long_issues(staged, row, cells)
    for c in columns:
        if N.is_app_number(c):
            result = result.unionByName(duplicate_keys(df, c, row, blanks).select(row, F.lit(c).alias("column_name"), F.lit(Issue.KEY_DUPLICATE.name).alias("issue"), F.col(f"`{c}`").alias("value")))
    return result
