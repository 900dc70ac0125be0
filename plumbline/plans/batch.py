"""Folders of files: load, clean, write each; one bad file, writing included, never stops the rest."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plumbline.operators.issues import Issue
from plumbline.plans.cleaning import ROW, SOURCE, CleanResult, Options, clean
from plumbline.plans.reporting import report_lines
from plumbline.sources.text import LoadedFile, describe_source, find_input_files, load_text
from plumbline.sources.workbooks import MAX_SHEET_ROWS, load_workbook, write_workbook


def load_file(spark: SparkSession, path: str, options: Options = Options()) -> LoadedFile:
    ext = os.path.splitext(path)[1].lower()
    return load_text(spark, path, options.blanks) if ext in (".csv", ".tsv", ".txt") else load_workbook(spark, path)


def clean_file(spark: SparkSession, path: str, options: Options = Options()) -> CleanResult:
    loaded = load_file(spark, path, options)
    result = clean(loaded.df, os.path.basename(path), options)
    result.audit.insert(0, ("source_file_info", ", ".join(f"{k}: {v}" for k, v in describe_source(loaded).items() if v not in (None, []))))
    if loaded.sheet_note:
        result.audit.insert(0, ("choose_sheet", loaded.sheet_note))
    result.stats["filler_rows_top_removed"] = loaded.header_row
    return result


def free_folder(base: str) -> str:
    """The path itself, or with (1), (2) ... until nothing is there."""
    path, n = base, 0
    while os.path.exists(path):
        n += 1
        path = f"{base} ({n})"
    return path


def issue_sheet(result: CleanResult, issue: str):
    """Rows with an issue of that kind: cleaned row number, issue columns and all cells as text."""
    flagged = result.issues.where(F.col("issue") == issue).groupBy(ROW).agg(F.array_sort(F.collect_set("column_name")).alias("flagged_columns"))
    return result.display().join(flagged, ROW)


def save_outputs(result: CleanResult, folder: str, workbook: bool = False) -> str:
    """Parquet of every sheet under ``<name> - CLEANED``, never over an existing folder; on request a workbook as well."""
    target = free_folder(os.path.join(folder, os.path.splitext(result.source)[0] + " - CLEANED"))
    spark = result.cleaned.sparkSession
    result.display().write.parquet(f"{target}/Cleaned")
    result.raw.write.parquet(f"{target}/Raw")
    spark.createDataFrame([(i, x) for i, x in enumerate(report_lines(result), 1)], "line int, text string").coalesce(1).write.parquet(f"{target}/Report")
    result.audit_table().coalesce(1).write.parquet(f"{target}/Audit")
    result.issues.write.partitionBy("issue").parquet(f"{target}/Issues")
    if workbook:
        columns = result.columns()
        shown = result.display().orderBy(ROW).limit(MAX_SHEET_ROWS)
        sheets = [("Cleaned", ["row_number", *columns], [(i, *list(r)[1:]) for i, r in enumerate(shown.toLocalIterator(), 1)])]
        raw = [c for c in result.raw.columns if c != ROW]
        sheets.append(("Raw", result.raw_names, [tuple(r) for r in result.raw.orderBy(ROW).limit(MAX_SHEET_ROWS).select(*[F.col("`" + c + "`") for c in raw]).toLocalIterator()]))
        sheets.append(("Report", ["report"], [(x,) for x in report_lines(result)]))
        for kind in (Issue.KEY_DUPLICATE, Issue.KEY_INVALID, Issue.PRICE, Issue.FAILED, Issue.MISSING, Issue.DISGUISED):
            rows = [tuple(",".join(v) if isinstance(v, list) else v for v in list(r)[1:]) for r in issue_sheet(result, kind.name).orderBy(ROW).limit(MAX_SHEET_ROWS).toLocalIterator()]
            sheets.append((kind.value[1], [*columns, "flagged_columns"], rows or [("No issues found for this category.",)]))
        equal = sorted({c for pair in result.equal_columns for c in pair})
        if equal:
            same = result.display().orderBy(ROW).limit(MAX_SHEET_ROWS).select(*[F.col(f"`{c}`") for c in equal])
            sheets.append((Issue.EQUAL_FIELD.value[1], equal, [tuple(r) for r in same.toLocalIterator()]))
        sheets.append(("Generated Fields", ["cleaned_row_number", SOURCE], [(i, result.source) for i in range(1, min(result.stats["rows_after"], MAX_SHEET_ROWS) + 1)]))
        sheets.append((Issue.FIELD.value[1], ["field", "note"], [(c, n) for c, ns in result.header_notes.items() for n in ns]))
        write_workbook(f"{target}/{os.path.splitext(result.source)[0]}.xlsx", sheets, {i.value[1]: i.value[0] for i in Issue})
    return target


def run_batch(spark: SparkSession, inbox: str, outbox: str, options: Options = Options(), workbook: bool = False) -> list[tuple[str, str, str]]:
    """(file, done or failed, where or why) of every input file. Inputs are never deleted."""
    os.makedirs(inbox, exist_ok=True)
    os.makedirs(outbox, exist_ok=True)
    done = []
    for path in find_input_files(inbox):
        try:
            done.append((path, "done", save_outputs(clean_file(spark, path, options), outbox, workbook)))
        except Exception as e:  # a bad file is reported, whatever is wrong with it
            done.append((path, "failed", f"{type(e).__name__}: {e}"))
    return done
