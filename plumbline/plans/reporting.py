"""Overview, column details and report lines of a cleaned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.rows import q, row_key
from plumbline.plans.cleaning import ROW, CleanResult

REVIEW_WORDS = ("failed", "could not", "kept -- differs", "check_failed", "flagged for review")


def overview(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, columns, rows that repeat another (exactly), missing cells and their share."""
    missing = sum((q(c).isNull().cast("int") for c in columns), F.lit(0))
    per_row = df.select(F.struct(*[q(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]).alias("r"), missing.alias("m"))
    groups = per_row.groupBy("r").agg(F.count("*").alias("n"), F.sum("m").alias("m"))
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_missing"))
    cells = F.col("n_rows") * len(columns)
    return total.select("n_rows", F.lit(len(columns)).alias("n_columns"), "n_duplicates", "n_missing", F.when(cells > 0, F.round(100 * F.col("n_missing") / cells, 2)).alias("missing_percent"))


def column_details(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: missing cells, distinct values, smallest, greatest and mean number, most frequent value."""
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), q(c).cast("string").alias("v")) for c in columns])))
    counts = cells.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    number = F.when(F.col("v").rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.col("v").try_cast("double"))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("n_missing"), F.count("v").alias("n_distinct"),
        F.min(number).alias("min_number"), F.max(number).alias("max_number"),
        F.round(F.sum(number * F.col("n")) / F.sum(F.when(number.isNotNull(), F.col("n"))), 2).alias("mean_number"),
        F.max(F.when(F.col("v").isNotNull(), F.struct("n", "v"))).alias("top"),
    ).select("column_name", "n_rows", "n_missing", "n_distinct", "min_number", "max_number", "mean_number", F.col("top.v").alias("top_value"), F.col("top.n").alias("top_count"))


def changes(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows before and after, rows that left and that are new, compared in comparison form."""
    mark = lambda df, x: df.select(row_key(df, columns).alias("k")).groupBy("k").agg(F.count("*").alias("n")).withColumn("side", F.lit(x))
    both = mark(before, "b").unionByName(mark(after, "a")).groupBy("k").agg(F.sum(F.when(F.col("side") == "b", F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(F.col("side") == "a", F.col("n")).otherwise(0)).alias("a"))
    return both.agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"), F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("rows_removed"), F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("rows_added"))


def report_lines(result: CleanResult) -> list[str]:
    """The report as text, section by section."""
    display, columns = result.display(), [c for c in result.columns()]
    facts = overview(display, columns).first()
    lines = ["SOURCE", f"  {result.source}", "DATASET", f"  {facts.n_rows} rows, {facts.n_columns} columns, {facts.n_duplicates} repeated rows, {facts.missing_percent}% missing", "COLUMNS"]
    for r in column_details(display, columns).orderBy("column_name").collect():
        lines.append(f"  {r.column_name} ({result.kinds.get(r.column_name, 'text')}): {r.n_missing} missing, {r.n_distinct} distinct, most frequent {r.top_value!r}")
    lines += ["BEFORE AND AFTER", f"  {result.stats['rows_before']} rows before, {result.stats['rows_after']} after"]
    lines += ["TO REVIEW", *[f"  {k}: {v}" for k, v in sorted(result.stats.items()) if k.startswith("cells_")]]
    lines += [f"  {c}: {n}" for c, ns in result.header_notes.items() for n in ns]
    lines += [f"  {s}: {d}" for s, d in result.audit if any(w in d for w in REVIEW_WORDS)]
    lines += ["AUDIT LOG", *[f"  {i}. {s}: {d}" for i, (s, d) in enumerate(result.audit, 1)]]
    return lines


__all__ = ["ROW", "changes", "column_details", "overview", "report_lines"]
