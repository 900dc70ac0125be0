"""Best representative of each group of records that share a key.

Both operators unpivot to long rows, choose winners by max_by, and pivot back. ``built_record`` builds one record per key
field by field: each normalised value of a field gets the sum of its rows' votes (source trust times recency decay), and the
value with the most votes wins. ``surviving_row`` picks an existing row, the one that no other row of its key beats in any
of four aspects (filled fields, length, date, trust): every row stands for itself in each aspect, the winner of an aspect is
the row with the greatest value in it, ties going by the other aspects, and the row that wins all of them survives. Summed
votes cannot give that row, as two poorer rows that agree outvote a better one (see the README for figures).

Keys that one row alone has need no long rows: they are told apart first, by counts of 128-bit key digests. All aggregates
combine on the map side, so a key that a third of the rows have is a few rows for each task by the time it is shuffled.

Defined cases: null, blank and placeholder keys form no group; unfilled fields neither vote nor win; a source without a
trust level is trusted least; rows without a date are the oldest; ties go to the smallest row id, of values to the greater.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.blanks import is_filled
from plumbline.llm.visual_form import comparison_form, visual_form
from plumbline.plans.lineage import cut, join_to_keys, leave_out_keys

LEAST_TRUST = 1_000_000
OLDEST = "timestamp_ntz'0001-01-01 00:00:00'"


def _with_trust(df: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    """Adds __trust. The optimizer broadcasts the sources only if their measured size is below its threshold."""
    levels = sources.groupBy(F.col("source_system").alias("__source")).agg(F.min("trust_level").alias("__trust"))
    return df.join(levels, F.col(f"`{source}`") == F.col("__source"), "left").withColumn("__trust", F.coalesce("__trust", F.lit(LEAST_TRUST)))


_KEY = ["k1", "k2"]


def _digests(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2")]


def surviving_row(df: DataFrame, sources: DataFrame, row_id: str, key: str, fields: list[str], lengths: list[str], updated: str, source: str, blanks: list[str]) -> DataFrame:
    """(row_id) of the row of each group of two or more that is best in filled fields, summed length, date and trust."""
    filled = {f: is_filled(F.col(f"`{f}`"), blanks) for f in fields}
    size: Column = sum((F.when(filled[f], F.length(F.btrim(visual_form(F.col(f"`{f}`")), F.lit(" \t\n\r")))).otherwise(0) for f in lengths), F.lit(0))
    mask: Column = sum((F.when(filled[f], 1 << i).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    keys = df.select(comparison_form(F.col(f"`{key}`")).alias("k")).where(F.col("k").isNotNull() & ~F.col("k").isin([*blanks, ""])).select(*_digests("k"))
    several = keys.groupBy(*_KEY).agg(F.count("*").alias("n")).where("n > 1")
    rows = _with_trust(df, sources, source).select(
        F.col(f"`{row_id}`").alias("id"), comparison_form(F.col(f"`{key}`")).alias("k"), mask.alias("mask"), size.alias("size"), F.coalesce(F.col(f"`{updated}`"), F.expr(OLDEST)).alias("at"), (-F.col("__trust")).alias("trust")
    ).select("id", *_digests("k"), "mask", "size", "at", "trust")
    rest = [F.bit_count("mask").alias("c"), F.col("size"), F.col("at"), F.col("trust"), (-F.col("id")).alias("i")]
    at = F.unix_micros(F.col("at").cast("timestamp"))
    aspects = F.array(*[F.struct(F.lit(i).alias("aspect"), v.cast("long").alias("v")) for i, v in enumerate((F.bit_count("mask"), F.col("size"), at, F.col("trust")))])
    long = join_to_keys(rows, several, _KEY, "n").select(*_KEY, "id", "mask", F.struct(*rest).alias("rest"), F.explode(aspects).alias("a"))
    winners = long.groupBy(*_KEY, "a.aspect").agg(F.max_by(F.struct("id", "mask"), F.struct("a.v", "rest")).alias("w"), F.bit_or("mask").alias("filled"))
    wide = winners.groupBy(*_KEY).pivot("aspect", [0, 1, 2, 3]).agg(F.first(F.struct("w", "filled")))
    alike = [F.col(f"`{i}`.w.id") == F.col("`0`.w.id") for i in (1, 2, 3)]
    return wide.where(alike[0] & alike[1] & alike[2] & (F.col("`0`.w.mask") == F.col("`0`.filled"))).select(F.col("`0`.w.id").alias(row_id))


def built_record(df: DataFrame, sources: DataFrame, key: str, fields: list[str], updated: str, source: str, blanks: list[str], half_life_days: int = 180, as_of: str = "timestamp_ntz'2025-01-01 00:00:00'") -> DataFrame:
    """One record per key: (key, <fields>), each field the value with the most votes, null where none is filled.

    A row's vote is 1/trust_level times 0.5 for each half-life of its age (rows without a date: ten half-lives). Votes are
    summed as decimals, so the result does not depend on the order of addition. A key that one row alone has is that row;
    a key without any filled field gives no record.
    """
    age = F.timestamp_diff("DAY", F.col(f"`{updated}`"), F.expr(as_of)) / F.lit(float(half_life_days))
    weight = F.pow(F.lit(0.5), F.greatest(F.least(F.coalesce(age, F.lit(10.0)), F.lit(30.0)), F.lit(-10.0))) / F.greatest(F.col("__trust"), F.lit(1))
    rows = _with_trust(df, sources, source).select(comparison_form(F.col(f"`{key}`")).alias(key), weight.cast("decimal(24,14)").alias("w"), *[F.when(is_filled(F.col(f"`{f}`"), blanks), F.col(f"`{f}`")).alias(f"f{i}") for i, f in enumerate(fields)])
    rows = rows.where(F.col(key).isNotNull() & ~F.col(key).isin([*blanks, ""])).select("*", *_digests(key))
    several = cut(rows.groupBy(*_KEY).agg(F.count("*").alias("n")).where("n > 1"))
    alone = leave_out_keys(rows, several, _KEY, "n").where(F.coalesce(*[f"f{i}" for i in range(len(fields))]).isNotNull()).select(key, *[F.col(f"f{i}").alias(f) for i, f in enumerate(fields)])
    shared = join_to_keys(rows, several, _KEY, "n")
    long = shared.select(key, "w", F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f"f{i}").alias("v")) for i in range(len(fields))])).alias("s")).select(key, "w", "s.field", "s.v").where("v is not null")
    votes = long.withColumn("norm", comparison_form(F.col("v"))).groupBy(key, "field", "norm").agg(F.sum("w").alias("vote"), F.max_by("v", F.struct("w", "v")).alias("v"))
    wide = votes.groupBy(key).pivot("field", list(range(len(fields)))).agg(F.max_by("v", F.struct("vote", "norm")))
    return alone.unionByName(wide.select(key, *[F.col(f"`{i}`").alias(f) for i, f in enumerate(fields)]))
