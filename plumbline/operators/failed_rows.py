"""Rows that fail to parse: load the valid records of delimited text, and say why the others fail.

Separator and header of each file are settled from all of its records by aggregates, and the table of layouts is joined back
to the records, so a file of any size is parsed in parallel, record by record. A record is read by a minimum-cost parse: its
text is cut at every separator, and dynamic programming over (pieces used, fields done, inside quotes or not), in the order
of cost, joins pieces to fields. Each field pays for quotes that have to be put in or taken out, for separators taken out of
or put into the record, and for a value that does not fit its column. A record of cost zero is loaded; the operations of any
other are its reason. Where built-in expressions can tell that the cost is zero (the quoting is plain, the number of fields
is right and every value fits its column), the record is loaded without leaving the JVM.

Defined cases: a null, empty or separators-only record is blank, a repeated header is skipped, records above the header
are filler; none of these is loaded or failed. A file without any header-like record takes its first record as header.
Equal records are read alike; a record without file or number has no place in a file and is left out. Records of any
length and any number of fields are parsed whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import APP_NUMBER_KEYWORDS, WHITESPACE
from plumbline.functions import grammar as G
from plumbline.functions import values as V
from plumbline.functions.blanks import is_placeholder, strip
from plumbline.functions.scalars import blank_or_placeholder, is_flag, parse_date, parse_number
from plumbline.plans.lineage import cut, join_to_keys

SEPARATORS = "\t;|,"
HEADER_FILL, HEADER_TEXT = 0.5, 0.7
#: Where a header is looked for first; files without one there are read on.
FIRST_RECORDS = 16
COST_SEPARATOR, COST_QUOTE, COST_VALUE = 1.0, 1.0, 1.5

#: Column name (normalised) to the test a value must pass.
COLUMN_TESTS = {"quantity": "number", "weight": "number", "unit_price": "number", "order_date": "date", "is_active": "flag"}
_TESTS = {"number": lambda v: parse_number(v) is not None, "date": lambda v: parse_date(v) is not None, "flag": is_flag}
_COLUMN_TESTS = {"number": V.to_money, "date": V.to_date_uk, "flag": V.to_flag}


def column_name(header: str) -> str:
    """Header spelling to column name: lower case, other characters as underscores, one name for the key column."""
    name = re.sub(r"[^a-z0-9]+", "_", header.strip().lower()).strip("_")
    return APP_NUMBER_KEYWORDS[0] if name in APP_NUMBER_KEYWORDS else name


def split_strict(text: str, sep: str) -> tuple[list[str] | None, str | None]:
    """Fields of a well-formed record, or None and what is wrong with its quoting."""
    if '"' not in text:
        return text.split(sep), None
    out, i, n = [], 0, len(text)
    while True:
        if i < n and text[i] == '"':
            start, i = i + 1, i + 1
            while (i := text.find('"', i)) >= 0 and text[i + 1 : i + 2] == '"':
                i += 2
            if i < 0:
                return None, "quote never closed"
            out.append(text[start:i].replace('""', '"'))
            i += 1
            if i < n and text[i] != sep:
                return None, "text after a closing quote"
        else:
            end = text.find(sep, i)
            end = n if end < 0 else end
            if '"' in text[i:end]:
                return None, "quote inside an unquoted field"
            out.append(text[i:end])
            i = end
        if i >= n:
            return out, None
        i += 1


def fits(value: str, test: str | None) -> bool:
    return test is None or blank_or_placeholder(value) or _TESTS[test](value)


def is_header_like(cell: str) -> bool:
    """Filled, and not a number once currency and percent signs, commas and blanks are taken away."""
    bare = re.sub(r"[£$€¥%,\s]", "", cell)
    if not cell.strip():
        return False
    try:
        float(bare)
    except ValueError:
        return True
    return False


#: What may be a number once its dress is taken away; any other cell is no number, seen at its first other character.
_MAY_BE_NUMBER = rf"(?i)^[-+0-9e._{G.CURRENCY_SIGNS}%,{WHITESPACE}]*$|^[-+\W]*(inf|nan)"


def header_like(cell: Column) -> Column:
    """As ``is_header_like``."""
    bare = F.translate(cell, G.CURRENCY_SIGNS + "%," + WHITESPACE, "")
    number = bare.rlike(G.NUMBER) | bare.rlike(G.INFINITE) | bare.rlike("(?i)^[+-]?nan$") | bare.rlike(r"^[+-]?[0-9]+(_[0-9]+)+(\.[0-9]*)?$")
    return F.when(cell.rlike(_MAY_BE_NUMBER), (strip(cell) != "") & ~number).otherwise(True)


def _stray(text: str) -> int:
    """Quotes of a quoted stretch that are not doubled."""
    return text.replace('""', "").count('"')


def _quoted(piece: str, first: bool, last: bool) -> tuple[float, str, list[str]]:
    """A piece of a quoted field, as its first or last piece or between: cost, text, edits."""
    edits = []
    if first:
        if piece.startswith('"'):
            piece = piece[1:]
        else:
            edits.append("put in an opening quote")
    if last:
        if (len(piece) - len(piece.rstrip('"'))) % 2:
            piece = piece[:-1]
        else:
            edits.append("put in a closing quote")
    edits += ["double a quote"] * _stray(piece)
    return COST_QUOTE * len(edits), piece.replace('""', '"'), edits


def _merged(pieces: list[str], sep: str, quoted: bool) -> tuple[float, str, list[str]]:
    """Pieces read as one field, quoted or not: cost, value, edits."""
    if not quoted:
        quotes = sum(p.count('"') for p in pieces)
        edits = ["take out a quote"] * quotes + ["take out a separator"] * (len(pieces) - 1)
        return COST_QUOTE * quotes + COST_SEPARATOR * (len(pieces) - 1), sep.join(pieces).replace('"', ""), edits
    parts = [_quoted(p, i == 0, i == len(pieces) - 1) for i, p in enumerate(pieces)]
    return sum(c for c, _, _ in parts), sep.join(t for _, t, _ in parts), [e for _, _, es in parts for e in es]


def _may_be_quoted(first: str, last: str) -> bool:
    return first.startswith('"') or last.endswith('"')


#: What was one number, date or word before separators cut it has no more characters than this, runs of blanks counted as
#: one. A single piece may have any length.
LONGEST_BROKEN_VALUE = 64


def _fitting(pieces: list[str], start: int, sep: str, test: str) -> Iterator[tuple[int, bool, float]]:
    """(end, quoted, cost) of every stretch from ``start`` that fits a typed column as one field."""
    bare = ""
    for end in range(start + 1, len(pieces) + 1):
        stretch = pieces[start:end]
        for quoted in (False, True) if _may_be_quoted(stretch[0], stretch[-1]) else (False,):
            cost, value, _ = _merged(stretch, sep, quoted)
            if fits(value, test):
                yield end, quoted, cost
        bare = re.sub(r"\s+", " ", bare + sep + stretch[-1].replace('"', ""))
        if len(bare.strip()) > LONGEST_BROKEN_VALUE:
            return


BETWEEN, UNQUOTED, QUOTED, QUOTE_PUT_IN = range(4)


def cheapest_parse(text: str, sep: str, tests: list[str | None]) -> tuple[float, list[str], list[str]]:
    """Cost, values and edits of the cheapest reading of a record as ``len(tests)`` fields.

    States are settled in the order of their cost plus the separators that are still to be put in or taken out at least, so
    a record that is nearly well formed takes little more than one state for each of its pieces.
    """
    pieces, n = text.split(sep), len(tests)
    m = len(pieces)
    last_quote = max((i for i, p in enumerate(pieces) if '"' in p), default=-1)

    def least(j: int, k: int, mode: int) -> float:
        missing = (n - k - (mode != BETWEEN)) - (m - j)
        return COST_SEPARATOR * (missing if missing > 0 else 0 if mode >= QUOTED or j <= last_quote else -missing)

    def moves(j: int, k: int, mode: int) -> Iterator[tuple[float, tuple[int, int, int], tuple]]:
        """(cost, state, (end of field or None, quoted, misfit)) one step away."""
        if mode == BETWEEN:
            if k == n:
                return
            yield COST_SEPARATOR, (j, k + 1, BETWEEN), ("empty",)
            if j == m:
                return
            piece, misfit = pieces[j], 0.0
            if tests[k] is not None:
                for end, quoted, cost in _fitting(pieces, j, sep, tests[k]):
                    yield cost, (end, k + 1, BETWEEN), ("fits", j, quoted)
                misfit = COST_VALUE
            yield misfit + COST_QUOTE * piece.count('"'), (j + 1, k, UNQUOTED), ("begin",)
            if _may_be_quoted(piece, piece):
                yield misfit + _quoted(piece, True, True)[0], (j + 1, k + 1, BETWEEN), ("single",)
            if j < last_quote:
                yield misfit + _quoted(piece, True, False)[0], (j + 1, k, QUOTED if piece.startswith('"') else QUOTE_PUT_IN), ("begin",)
        elif mode == UNQUOTED:
            yield 0.0, (j, k + 1, BETWEEN), ("end", False)
            if j < m:
                yield COST_SEPARATOR + COST_QUOTE * pieces[j].count('"'), (j + 1, k, UNQUOTED), ("more",)
        elif j < m:
            yield _quoted(pieces[j], False, False)[0], (j + 1, k, mode), ("more",)
            if mode == QUOTED or pieces[j].endswith('"'):
                yield _quoted(pieces[j], False, True)[0], (j + 1, k + 1, BETWEEN), ("end", True)

    start, goal = (0, 0, BETWEEN), (m, n, BETWEEN)
    paid, came, settled, serial = {start: 0.0}, {}, set(), 0
    queue = [(least(*start), 0, 0, start)]
    while queue:
        state = heapq.heappop(queue)[3]
        if state == goal:
            break
        if state in settled:
            continue
        settled.add(state)
        for cost, after, how in moves(*state):
            total = paid[state] + cost
            if total < paid.get(after, float("inf")):
                paid[after], came[after] = total, (state, how)
                settled.discard(after)
                serial += 1
                heapq.heappush(queue, (total + least(*after), -after[0], serial, after))
    values, edits, state, end, quoted = [], [], goal, None, False
    while state != start:
        before, how = came[state]
        if how[0] == "empty":
            values.append("")
            edits.append(["put in a separator"])
        elif how[0] == "end":
            end, quoted = state[0], how[1]
        elif how[0] in ("fits", "single", "begin"):
            stretch = pieces[before[0] : state[0] if end is None else end]
            _, value, own = _merged(stretch, sep, how[0] == "single" or (how[2] if how[0] == "fits" else quoted))
            misfit = tests[before[1]] is not None and how[0] != "fits"
            values.append(value)
            edits.append(([f"value {value[:40]!r} does not fit column {before[1] + 1}"] if misfit else []) + own)
            end = None
        state = before
    return paid[goal], values[::-1], [e for es in reversed(edits) for e in es]


@lru_cache(maxsize=10_000)
def _tests_of(names: tuple[str, ...]) -> list[str | None]:
    return [COLUMN_TESTS.get(x) for x in names]


def read_record(text: str | None, sep: str, names: Iterable[str]) -> tuple[str, list[str] | None, str | None, float]:
    """(kind, values, reason, cost) of one record below the header; kind is loaded, failed, blank or header."""
    names = tuple(names)
    if text is None or not text.replace(sep, "").strip():
        return "blank", None, None, 0.0
    strict, wrong = split_strict(text, sep)
    if strict is not None and not any(v.strip() for v in strict):
        return "blank", None, None, 0.0
    if strict is not None and tuple(map(column_name, strict)) == names:
        return "header", None, None, 0.0
    tests = _tests_of(names)
    cost, values, edits = cheapest_parse(text, sep, tests)
    if cost == 0:
        return "loaded", values, None, 0.0
    if strict is not None and len(strict) != len(names):
        wrong = f"{len(strict)} fields instead of {len(names)}"
    elif strict is not None:
        wrong = "invalid value in " + ", ".join(n for n, v, t in zip(names, strict, tests) if not fits(v, t))
    return "failed", values, f"{wrong}: " + "; ".join(edits), cost


_READ = T.StructType([T.StructField("kind", T.StringType()), T.StructField("values", T.ArrayType(T.StringType())), T.StructField("reason", T.StringType()), T.StructField("cost", T.DoubleType())])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _names_udf(texts: pd.Series, seps: pd.Series) -> pd.Series:
    return pd.Series([[column_name(x) for x in split_strict(t or "", s)[0] or [""]] for t, s in zip(texts, seps)])


@F.pandas_udf(_READ)
def _read_udf(texts: pd.Series, seps: pd.Series, names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_record(t, s, n) if s is not None else (None, None, None, None) for t, s, n in zip(texts, seps, names)], columns=["kind", "values", "reason", "cost"])


_read_udf = _read_udf.asNondeterministic()  # so that no filter on its result moves below it and has it run twice


# The same reading as expressions, for records whose quoting is plain ---------------------------------------------------
_DOUBLED, _INNER = "\x01", "\x02"  # stand for a doubled quote, and for a separator inside quotes


def _cells(text: Column, sep: Column) -> Column:
    """A text cut at its separators."""
    cases = [F.split(text, "\\" + s if s == "|" else s) for s in SEPARATORS]
    return F.when(sep == SEPARATORS[0], cases[0]).when(sep == SEPARATORS[1], cases[1]).when(sep == SEPARATORS[2], cases[2]).otherwise(cases[3])


def plain_fields(text: Column, sep: Column) -> Column:
    """The fields of a record whose quotes all stand around whole fields or doubled inside them; null where that is not plain
    to see (it may be so all the same, as of a field that begins with a doubled quote)."""

    def unquoted(parts: Column) -> Column:
        last = F.size(parts) - 1
        begins = lambda x, i: (i == 0) | x.startswith(sep) | ((i == last) & (x == ""))
        ends = lambda x, i: (i == last) | x.endswith(sep) | ((i == 0) & (x == ""))
        sound = F.forall(F.transform(parts, lambda x, i: (i % 2 == 1) | (~x.contains(_DOUBLED) & begins(x, i) & ends(x, i))), lambda ok: ok)
        masked = F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.replace(x, sep, F.lit(_INNER))).otherwise(x)), "")
        return F.when((last % 2 == 0) & sound, F.transform(_cells(masked, sep), lambda x: F.replace(F.replace(x, F.lit(_INNER), sep), F.lit(_DOUBLED), F.lit('"'))))

    quoted = V.let(F.split(F.replace(text, F.lit('""'), F.lit(_DOUBLED)), '"'), unquoted)
    return F.when(~text.contains('"'), _cells(text, sep)).when(~text.contains(_DOUBLED) & ~text.contains(_INNER), quoted)


def layouts(records: DataFrame, file: str, number: str, text: str) -> DataFrame:
    """(file, sep, header_no, names, n) of every file, from all of its records.

    The separator is the most frequent one outside quotes, and a file is as wide as most of its records. The header is the
    first record that is filled enough for that width and mostly text; else the first that is filled enough; else the first.
    It is looked for in the first records of every file, and in all records of the files that have none there.
    """
    rows = records.select(F.col(file), F.col(number).alias("__no"), F.col(text).alias("__text")).where(F.col(file).isNotNull() & F.col("__no").isNotNull())
    bare = F.when(F.col("__text").contains('"'), F.regexp_replace("__text", '"[^"]*"', "")).otherwise(F.coalesce("__text", F.lit("")))
    counted = rows.select(file, "__no", F.coalesce(F.col("__text").rlike(r"(?U)[^\s;|,]"), F.lit(False)).alias("written"), bare.alias("b"))
    counted = counted.select(file, "__no", "written", *[(F.length("b") - F.length(F.replace("b", F.lit(s), F.lit("")))).alias(f"s{i}") for i, s in enumerate(SEPARATORS)])
    places = [F.col(f"s{i}") for i in range(len(SEPARATORS))]
    shapes = cut(counted.groupBy(file, "written", *places).agg(F.count("*").alias("c"), F.min("__no").alias("first")))
    sums = shapes.groupBy(file).agg(F.sum("c").alias("n"), F.min("first").alias("first"), *[F.sum(p * F.col("c")).alias(f"t{i}") for i, p in enumerate(places)])
    totals = [F.col(f"t{i}") for i in range(len(SEPARATORS))]
    chosen = F.coalesce(*[F.when((t > 0) & (t == F.greatest(*totals)), i) for i, t in enumerate(totals)], F.lit(SEPARATORS.index(",")))
    seps = sums.select(file, "n", "first", chosen.alias("i"), F.element_at(F.array(*map(F.lit, SEPARATORS)), chosen + 1).alias("sep"))
    widths = shapes.where("written").join(seps.select(file, "i"), file).groupBy(file, (F.element_at(F.array(*places), F.col("i") + 1) + 1).alias("fields")).agg(F.sum("c").alias("c"))
    widths = widths.groupBy(file).agg(F.max(F.struct("c", "fields")).getField("fields").alias("width"))
    files = cut(seps.join(widths, file, "left").select(file, "n", "first", "sep", F.coalesce("width", F.lit(1)).alias("width")))

    def headers(of: DataFrame, some: DataFrame) -> DataFrame:
        """(file, titled, filled): the first record that is filled enough and mostly text, and the first that is filled enough."""
        cells = join_to_keys(some, of.select(file, "n", "sep", "width"), [file], "n").select(file, "__no", "width", plain_fields(F.col("__text"), F.col("sep")).alias("f"))
        cells = cells.select(file, "__no", "f", F.size(F.filter("f", lambda x: strip(x) != "")).alias("filled"), "width").where(F.col("filled") >= HEADER_FILL * F.col("width"))
        texts = F.size(F.filter("f", header_like)) >= HEADER_TEXT * F.col("filled")
        return cells.select(file, "__no", texts.alias("texts")).groupBy(file).agg(F.min(F.when(F.col("texts"), F.col("__no"))).alias("titled"), F.min("__no").alias("filled"))

    early = cut(headers(files, rows.where(F.col("__no") < FIRST_RECORDS)))
    missing = files.join(early.where("titled is not null"), file, "left_anti")
    found = early.where("titled is not null")
    if not missing.isEmpty():
        found = found.unionByName(headers(missing, rows))
    heads = cut(files.join(found, file, "left").select(file, "n", "sep", F.coalesce("titled", "filled", "first").alias("header_no")))
    named = join_to_keys(rows, heads, [file], "n").where(F.col("__no") == F.col("header_no")).groupBy(file, "sep").agg(F.min("__text").alias("t"))
    return heads.join(named.select(file, _names_udf("t", "sep").alias("names")), file).select(file, "sep", "header_no", "names", "n")


def _below_header(records: DataFrame, key: str, file: str, number: str, text: str) -> DataFrame:
    """(key, file, __text, sep, names) of the records below the header of their file."""
    rows = records.select(key, file, number, text)
    found = layouts(rows, file, number, text)
    return join_to_keys(rows, found, [file], "n").where(F.col(number) > F.col("header_no")).select(key, file, F.col(text).alias("__text"), "sep", "names")


def _settled(text: Column, sep: Column, names: Column) -> Column:
    """(kind, fields) of a record where expressions settle it: blank, or loaded with these fields. Null elsewhere."""

    def loads(fields: Column) -> Column:
        def fit(column: str, test: str) -> Column:
            place = F.array_position(names, column)
            value = F.get(fields, (place - 1).cast("int"))
            return (place == 0) | V.let(value, lambda v: is_placeholder(v) | _COLUMN_TESTS[test](v).isNotNull())

        first = F.regexp_replace(F.regexp_replace(F.lower(strip(F.get(fields, F.lit(0)))), "[^a-z0-9]+", "_"), "^_+|_+$", "")
        good = (F.size(fields) == F.size(names)) & (F.size(F.array_distinct(names)) == F.size(names)) & F.exists(fields, lambda x: strip(x) != "")
        good = good & ~first.isin(*APP_NUMBER_KEYWORDS) & (first != F.get(names, F.lit(0)))  # a header otherwise, perhaps
        for column, test in COLUMN_TESTS.items():
            good = good & fit(column, test)
        return F.when(good, F.struct(F.lit("loaded").alias("kind"), fields.alias("fields")))

    blank = F.coalesce(strip(F.replace(text, sep, F.lit(""))) == "", F.lit(True))
    none = F.lit(None).cast("array<string>")
    return F.when(blank, F.struct(F.lit("blank").alias("kind"), none.alias("fields"))).otherwise(V.let(plain_fields(text, sep), loads))


def read_records(records: DataFrame, key: str = "record_id", file: str = "file_id", number: str = "record_no", text: str = "record_text") -> DataFrame:
    """(key, file, kind, names, values, reason, cost) of every record below its file's header."""
    below = _below_header(records, key, file, number, text)
    staged = below.withColumn("s", _settled(F.col("__text"), F.col("sep"), F.col("names")))
    open_only = [F.when(F.col("s").isNull(), F.col(c)) for c in ("__text", "sep", "names")]
    return staged.withColumn("r", _read_udf(*open_only)).select(key, file, F.coalesce("s.kind", "r.kind").alias("kind"), "names", F.coalesce("s.fields", "r.values").alias("values"), "r.reason", F.coalesce("r.cost", F.lit(0.0)).alias("cost"))


def rejected(records: DataFrame, key: str = "record_id", file: str = "file_id", number: str = "record_no", text: str = "record_text") -> DataFrame:
    """(key, reason, cost) of the records that fail. Only those that expressions do not settle are parsed."""
    below = _below_header(records, key, file, number, text)
    still_open = below.where(_settled(F.col("__text"), F.col("sep"), F.col("names")).isNull())
    return failed(still_open.withColumn("r", _read_udf("__text", "sep", "names")).select(key, "r.*"), key)


def loaded(read: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The valid records as columns; a column that a file lacks is null, and of two columns of one name the first is taken."""
    rows = read.where("kind = 'loaded'")
    return rows.select(key, *[F.get("values", (F.array_position("names", c) - 1).cast("int")).alias(c) for c in columns])


def failed(read: DataFrame, key: str) -> DataFrame:
    """The other records with reason and cost."""
    return read.where("kind = 'failed'").select(key, "reason", "cost")
