"""Cleaning of one table of unknown shape: profile, decide on the driver, one lazy projection; a few times over.

Data only moves through lazy DataFrames. What depends on the data (which columns are blank, what kind each column is, which
copies differ) is settled from small aggregates, and the decision is compiled into the next projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import CASING_RULES, CATEGORY_MAPPINGS, DESCRIPTION_KEYWORDS, DISGUISED_BLANKS
from plumbline.functions import names as N
from plumbline.functions import values as V
from plumbline.functions.blanks import is_placeholder, strip
from plumbline.operators import columns as C
from plumbline.operators import issues as I
from plumbline.operators import rows as R
from plumbline.operators import typing as Ty
from plumbline.operators.rows import q

ROW = "__row_id"
SOURCE = "source_file"


@dataclass(frozen=True)
class Options:
    """Word lists and optional modes. Modes that change or drop data beyond the standard steps are off by default."""

    blanks: Sequence[str] = DISGUISED_BLANKS
    mappings: dict[str, dict[str, str]] = field(default_factory=lambda: CATEGORY_MAPPINGS)
    casing: Sequence[tuple[str, str]] = CASING_RULES
    flag_description_columns: bool = False
    blanks_to_null: bool = False
    fill_numbers_with_zero: bool = False
    drop_blank_columns: bool = False
    drop_equal_copies: bool = False
    max_rows_lost: int | None = None


@dataclass
class CleanResult:
    """A cleaned table with everything found on the way. ``cleaned`` has ``<column>__raw`` beside converted columns."""

    source: str
    raw: DataFrame
    raw_names: list[str]
    cleaned: DataFrame
    issues: DataFrame
    kinds: dict[str, str]
    equal_columns: list[tuple[str, str]]
    header_notes: dict[str, list[str]]
    audit: list[tuple[str, str]]
    stats: dict[str, int]

    def columns(self) -> list[str]:
        return [c for c in self.cleaned.columns if c != ROW and not c.endswith("__raw")]

    def display(self) -> DataFrame:
        """Every cell as text: the converted value, or the original where conversion failed or a placeholder was kept."""
        cells = []
        for c in self.columns():
            typed = q(c)
            kind = dict(self.cleaned.dtypes)[c]
            text = V.number_text(typed) if kind == "double" else typed.cast("string")
            cells.append((F.coalesce(text, q(f"{c}__raw")) if f"{c}__raw" in self.cleaned.columns else text).alias(c))
        return self.cleaned.select(ROW, *cells)

    def audit_table(self) -> DataFrame:
        return self.cleaned.sparkSession.createDataFrame([(i, s, d) for i, (s, d) in enumerate(self.audit, 1)], "seq int, step string, detail string")


def _is_text(df: DataFrame, column: str) -> bool:
    return dict(df.dtypes)[column] == "string"


def value_steps(df: DataFrame, data: Sequence[str], blank: set[str], options: Options) -> tuple[dict[str, list], list[tuple[str, str]]]:
    """For each column the expressions after each value step, and the audit of what was decided."""
    text = [c for c in data if c not in blank and _is_text(df, c)]
    facts = df.agg(*[x for i, c in enumerate(text) for x in (F.count_if(q(c).rlike(r"[^\x00-\x7F]")).alias(f"o{i}"), F.count_if(strip(q(c)).rlike(V.PHONE_LIKE)).alias(f"p{i}"), F.count(q(c)).alias(f"n{i}"))]).first() if text else None
    steps, audit = {c: [("original", q(c))] for c in data}, []
    for i, c in enumerate(text):
        steps[c].append(("trim_whitespace", strip(steps[c][-1][1])))
        if facts[f"o{i}"]:
            steps[c].append(("fix_encoding_issues", V.fix_encoding(steps[c][-1][1])))
            audit.append(("fix_encoding_issues", f"{c}: {facts[f'o{i}']} value(s) beyond ASCII were checked"))
        if N.is_phone_column(c) and facts[f"n{i}"] and facts[f"p{i}"] >= 0.5 * facts[f"n{i}"]:
            steps[c].append(("format_phone_numbers", V.phone_digits(steps[c][-1][1])))
            audit.append(("format_phone_numbers", f"{c}: numbers brought to digits"))
        rule = next((r for word, r in options.casing if N.has_bounded_word(c, word)), None)
        if rule:
            steps[c].append(("standardize_casing", V.apply_case(steps[c][-1][1], rule)))
            audit.append(("standardize_casing", f"{c}: {rule} case"))
        if c in options.mappings:
            steps[c].append(("category_value_mapping", V.map_category(steps[c][-1][1], options.mappings[c])))
            audit.append(("category_value_mapping", f"{c}: known spellings mapped"))
        if options.blanks_to_null:
            steps[c].append(("placeholders_to_blank", F.when(~is_placeholder(steps[c][-1][1], options.blanks), steps[c][-1][1])))
    return steps, audit


def check_no_loss(df: DataFrame, steps: dict[str, list], allowed: bool) -> dict[str, int]:
    """Changed cells per column; raises if a value step turned a filled cell into null."""
    touched = [c for c, s in steps.items() if len(s) > 1]
    if not touched:
        return {}
    row = df.agg(*[x for i, c in enumerate(touched) for x in (F.count_if(q(c).isNotNull() & steps[c][-1][1].isNull()).alias(f"l{i}"), F.count_if(q(c).isNotNull() & ~q(c).eqNullSafe(steps[c][-1][1])).alias(f"c{i}"))]).first()
    lost = {c: row[f"l{i}"] for i, c in enumerate(touched) if row[f"l{i}"]}
    if lost and not allowed:
        raise ValueError(f"value steps lost cells: {lost}")
    return {c: row[f"c{i}"] for i, c in enumerate(touched)}


def check_row_loss(before: int, after: int, allowed: int) -> None:
    """Raises if more rows went than the row steps account for."""
    if before - after > allowed:
        raise ValueError(f"{before - after} rows were lost, {allowed} accounted for")


def clean(df: DataFrame, source: str, options: Options = Options()) -> CleanResult:
    """Clean a table of text columns that has an order column ``__row_id``."""
    data = [c for c in df.columns if c != ROW]
    audit: list[tuple[str, str]] = []
    notes: dict[str, list[str]] = {}
    unnamed = [i for i, c in enumerate(data) if N.is_unnamed(c)]
    names = N.free_reserved(N.unique_names([N.standard_name(c) for c in data]))
    renamed_by_place = iter(names)  # by position: header spellings may differ in nothing but case
    table = raw = df.toDF(*[ROW if c == ROW else next(renamed_by_place) for c in df.columns])
    audit.append(("standardize_column_names", f"{sum(a != b for a, b in zip(data, names))} column name(s) standardised"))
    for i in unnamed:
        notes.setdefault(names[i], []).append("The header was blank in the source")
    blank = C.blank_columns(table.select(*[q(n) for n in names]))
    audit.append(("find_blank_columns", f"{len(blank)} blank column(s)"))
    live = [n for n in names if n not in blank]
    before = table.count()
    table = R.drop_repeated_headers(table, live)
    table = R.drop_totals(table, names)
    steps, said = value_steps(table, names, blank, options)
    changed = check_no_loss(table, steps, options.blanks_to_null)
    audit += said + [("values_changed", f"{c}: {n} value(s)") for c, n in changed.items() if n]
    table = table.select(q(ROW), *[steps[n][-1][1].alias(n) for n in names]).persist()  # read by every profile below
    resolved, renamed = C.resolve_copies(table.select(*[q(n) for n in names]))
    names = [renamed.get(n, n) for n in names]
    table = table.toDF(ROW, *names)
    audit += [("resolve_duplicate_columns", f"{a} renamed to {b}: its data differ") for a, b in renamed.items()]
    live = [renamed.get(n, n) for n in live]
    table = R.drop_duplicates(table, ROW, live)
    key = next((n for n in names if N.is_app_number(n)), None)
    texts = [n for n in C.description_columns(names, DESCRIPTION_KEYWORDS) if n != key]
    if key and texts:
        table = R.longest_per_key(table, key, ROW, texts, options.blanks)
        audit.append(("dedupe_by_app_number", f"one row per {key}, the longest of {texts}"))
    if options.flag_description_columns and len(texts) > 1:
        for n in texts:
            notes.setdefault(n, []).append("Several description columns")
    table = R.drop_blank_rows(table, names)
    if options.drop_blank_columns:
        names = [n for n in names if n not in blank]
    if options.drop_equal_copies:
        kept = C.drop_equal_copies(table.select(*[q(n) for n in names])).columns
        names = [n for n in names if n in kept]
    kinds = Ty.semantic_types(table, names, options.blanks)
    audit += [("infer_types", f"{n} -> {k}") for n, k in kinds.items()]
    cells, originals = [], {}
    for n in names:
        convert = Ty.converter(kinds[n], n)
        if convert is None:
            cells.append(q(n).alias(n))
            continue
        value = convert(q(n))
        if options.fill_numbers_with_zero and kinds[n] in Ty.CONVERSIONS:
            value = F.when(q(n).isNull(), F.lit(0.0)).otherwise(value)
        cells += [value.alias(n), q(n).alias(f"{n}__raw")]
        originals[n] = F.col(f"`{n}__raw`")
    cleaned = table.select(q(ROW), *cells)
    equal = C.equal_columns(table, ROW, names)
    for a, b in equal:
        notes.setdefault(a, []).append(f"Duplicate of: {b}")
        notes.setdefault(b, []).append(f"Duplicate of: {a}")
    prices = {}
    for n in names:
        if N.is_price(n) and n not in blank:
            source_column = f"{n}__raw" if n in originals else n
            prices[n] = I.price_rule(cleaned, source_column, options.blanks, V.to_money)
    found = [x for n in names if n not in blank for x in I.issue_columns(cleaned, {n: originals[n]} if n in originals else {}, kinds, [n], options.blanks, prices)]
    issues = I.long_issues(cleaned, ROW, found)
    for n in names:
        if N.is_app_number(n):
            issues = issues.unionByName(I.duplicate_keys(cleaned, n, ROW, options.blanks).select(ROW, F.lit(n).alias("column_name"), F.lit(I.Issue.KEY_DUPLICATE.name).alias("issue"), q(n).alias("value")))
    cleaned = cleaned.withColumn(SOURCE, F.lit(source))
    counts = {r.issue: r.n for r in issues.groupBy("issue").agg(F.count("*").alias("n")).collect()}
    after = cleaned.count()
    if options.max_rows_lost is not None:
        check_row_loss(before, after, options.max_rows_lost)
    stats = {"rows_before": before, "rows_after": after, "columns": len(names)} | {f"cells_{k.lower()}": v for k, v in counts.items()}
    return CleanResult(source, raw, data, cleaned, issues, kinds, equal, notes, audit, stats)
