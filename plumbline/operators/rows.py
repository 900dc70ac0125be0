"""Row operators: repeated headers, totals, duplicates, one row per key, blank rows.

Rows carry no order of their own in Spark, so every rule that speaks of "the first" takes an order column. Duplicate and
per-key rules aggregate with map-side combine and join a small result back, or carry the winner in the aggregate itself;
no operator gathers a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DISGUISED_BLANKS, TOTAL_LABELS
from plumbline.functions.blanks import is_filled, strip
from plumbline.functions.values import compare_key


def q(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _same_as_header(name: str) -> Column:
    return F.coalesce(F.lower(F.regexp_replace(strip(q(name).cast("string")), r"(?U)\s+", "_")), F.lit("")) == "_".join(name.strip().lower().split())


def repeated_headers(df: DataFrame, columns: Sequence[str] | None = None) -> Column | None:
    """The test for a row that repeats the header, or None where fewer than two columns can be compared."""
    columns = list(df.columns if columns is None else columns)
    return reduce(and_, map(_same_as_header, columns)) if len(columns) >= 2 else None


def drop_repeated_headers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Without rows that repeat the header, unless there is only one such row or all rows are such."""
    test = repeated_headers(df, columns)
    if test is None:
        return df
    n = df.agg(F.count_if(test).alias("hits"), F.count("*").alias("rows")).first()
    return df.where(~test) if 1 < n.hits < n.rows else df


def is_number_like(c: Column) -> Column:
    bare = F.translate(strip(c.cast("string")), ",£$€% ", "")
    return F.coalesce(bare.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^(?i)[+-]?(nan|inf|infinity)$"), F.lit(False))


def total_row(columns: Sequence[str]) -> Column:
    """A total: its first cell is a total label, two or more other cells are filled, one of them like a number."""
    first, others = columns[0], [q(c).cast("string") for c in columns[1:]]
    if not others:
        return F.lit(False)
    label = F.coalesce(F.lower(F.regexp_replace(strip(q(first).cast("string")), r"(?U)\s+", " ")).isin(*TOTAL_LABELS), F.lit(False))
    filled = [F.coalesce(strip(c) != "", F.lit(False)) for c in others]
    count = reduce(lambda a, b: a + b, [f.cast("int") for f in filled])
    return label & (count >= 2) & reduce(lambda a, b: a | b, [f & is_number_like(c) for f, c in zip(filled, others)])


def drop_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(~total_row(columns))


def row_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Two 64-bit digests of a row in comparison form."""
    types = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    keys = [compare_key(q(c), types[c]) for c in columns]
    return F.struct(F.xxhash64(*keys).alias("a"), F.xxhash64(F.lit(1), *keys).alias("b"))


def drop_duplicates(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Rows that differ in more than letter case and outer blanks; of equal rows the first by ``order``."""
    if not columns:
        return df
    keyed = df.withColumn("__key", row_key(df, columns)).select("*", F.col("__key.a").alias("__a"), F.col("__key.b").alias("__b")).drop("__key")
    first = keyed.groupBy("__a", "__b").agg(F.min(q(order)).alias("__first")).select("__first")
    return keyed.drop("__a", "__b").join(first, q(order) == F.col("__first"), "left_semi")


def longest_per_key(df: DataFrame, key: str, order: str, texts: Sequence[str], blanks: Sequence[str] = DISGUISED_BLANKS) -> DataFrame:
    """Of rows with one key, the one with the longest texts, the first by ``order`` among equals.

    Null, blank and placeholder keys are no keys, and where all texts of a key are empty all its rows stay.
    """
    length = reduce(lambda a, b: a + b, [F.when(is_filled(q(t), blanks), F.length(strip(q(t)))).otherwise(0) for t in texts])
    rows = df.withColumn("__k", F.when(is_filled(q(key), blanks), strip(q(key)))).withColumn("__n", length)
    best = rows.where("__k is not null").groupBy("__k").agg(F.max(F.struct(F.col("__n"), (-q(order)).alias("o"))).alias("m"), F.count("*").alias("c"))
    losers = best.where("c > 1 and m.__n > 0").select(F.col("__k").alias("__bk"), (-F.col("m.o")).alias("__keep"))
    return rows.join(losers, F.col("__k") == F.col("__bk"), "left").where(F.col("__keep").isNull() | (q(order) == F.col("__keep"))).drop("__k", "__n", "__bk", "__keep")


def drop_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without rows whose cells are all null; an empty text counts as a value."""
    return df.where(reduce(lambda a, b: a | b, [q(c).isNotNull() for c in columns])) if columns else df


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """The greatest row of each group by ``order``, in one aggregate with map-side combine."""
    return df.groupBy(*group).agg(F.max_by(F.struct(*[q(c) for c in keep]), F.struct(*order)).alias("__top")).select(*group, "__top.*")
