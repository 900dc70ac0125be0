"""Column operators: names, blank columns, copies of a column under another name."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import names as N
from plumbline.functions.blanks import strip
from plumbline.functions.values import compare_key
from plumbline.operators.rows import q


def standardise(df: DataFrame) -> DataFrame:
    """Standard, unique and unreserved names, by position."""
    return df.toDF(*N.free_reserved(N.unique_names([N.standard_name(c) for c in df.columns])))


def blank_columns(df: DataFrame) -> set[str]:
    """Columns without a single value, from one aggregate."""
    if not df.columns:
        return set()
    row = df.agg(*[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return {c for i, c in enumerate(df.columns) if row[i] == 0}


def _key(df: DataFrame, name: str):
    return compare_key(q(name), df.schema[df.columns.index(name)].dataType)


def copy_mismatches(df: DataFrame) -> dict[tuple[str, str], int]:
    """(base, base.N) to the number of rows that differ, from one aggregate."""
    pairs = N.suffixed_copies(df.columns)
    if not pairs:
        return {}
    row = df.agg(*[F.count_if(_key(df, a) != _key(df, b)).alias(f"m{i}") for i, (a, b) in enumerate(pairs)]).first()
    return {p: row[i] for i, p in enumerate(pairs)}


def resolve_copies(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Copies that hold other data than their base are renamed <base>_alt_k; equal copies keep their names."""
    renamed = N.alternative_names(df.columns, [b for (_, b), n in copy_mismatches(df).items() if n])
    return df.toDF(*[renamed.get(c, c) for c in df.columns]), renamed


def equal_columns(df: DataFrame, order: str, columns: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """Pairs of columns with the same data in every row, letter case aside; blank columns are equal to nothing.

    One aggregate gives each column an order-sensitive fingerprint; columns that share one are compared exactly in a second.
    """
    columns = [c for c in (df.columns if columns is None else columns) if c != order]
    if len(columns) < 2:
        return []
    mark = lambda c: F.xxhash64(q(order), _key(df, c))
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [F.sum(mark(c).cast("decimal(38,0)")).alias(f"s{i}"), F.bit_xor(mark(c)).alias(f"x{i}"), F.count_if(strip(q(c).cast("string")) != "").alias(f"n{i}")]
    row = df.agg(*aggregates).first()
    groups: dict[tuple, list[str]] = {}
    for i, c in enumerate(columns):
        if row[f"n{i}"]:
            groups.setdefault((row[f"s{i}"], row[f"x{i}"]), []).append(c)
    likely = [p for g in groups.values() for p in combinations(g, 2)]
    if not likely:
        return []
    exact = df.agg(*[F.count_if(_key(df, a) != _key(df, b)).alias(f"d{i}") for i, (a, b) in enumerate(likely)]).first()
    return [p for i, p in enumerate(likely) if exact[i] == 0]


def description_columns(columns: Sequence[str], keywords: Sequence[str]) -> list[str]:
    """Columns that describe the item; two or more are worth a look."""
    return [c for c in columns if N.has_keyword(c, keywords)]


def drop_blank(df: DataFrame) -> DataFrame:
    """Optional mode: without columns that hold no value."""
    gone = blank_columns(df)
    return df.select(*[q(c) for c in df.columns if c not in gone])


def drop_equal_copies(df: DataFrame) -> DataFrame:
    """Optional mode: without base.N columns that equal their base in every row."""
    gone = {b for (_, b), n in copy_mismatches(df).items() if n == 0}
    return df.select(*[q(c) for c in df.columns if c not in gone])
