"""Delimited text files of unknown encoding, separator and header."""

from __future__ import annotations

import codecs
import datetime
import hashlib
import os
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import DISGUISED_BLANKS, EXTENSIONS
from plumbline.functions import names as N
from plumbline.operators.failed_rows import HEADER_FILL, HEADER_TEXT, header_like, is_header_like, plain_fields

#: The separator is counted in the first lines that hold anything, of the first characters (as the rule has it).
SAMPLE_CHARS = 65_536
SAMPLE_LINES = 20
#: The words that pandas reads as "no value" by default.
DEFAULT_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


@dataclass(frozen=True)
class LoadedFile:
    """A loaded table and what was settled on the way."""

    path: str
    ext: str
    df: DataFrame
    header_row: int
    encoding: str | None = None
    separator: str | None = None
    sheet_name: str | None = None
    sheet_note: str | None = None
    sheet_names: tuple[str, ...] = ()
    number_display: dict[str, dict[float, int]] = field(default_factory=dict)


def find_input_files(folder: str, extensions: Sequence[str] = EXTENSIONS) -> list[str]:
    """Files of the folder itself by extension, in the order of the extensions, then by name."""
    files = sorted(e.name for e in os.scandir(folder) if e.is_file())
    return [os.path.join(folder, f) for x in extensions for f in files if f.lower().endswith("." + x)]


#: What a file of an extension is called.
TYPE_LABELS = {".csv": "CSV text", ".tsv": "Tab-separated text", ".txt": "Plain text", ".xlsx": "Excel workbook", ".xlsm": "Excel workbook with macros", ".xls": "Excel 97-2003 workbook", ".xlsb": "Excel binary workbook"}


def describe_source(loaded: LoadedFile) -> dict[str, object]:
    """What is known of a source file: kind, size, time, digest, encoding, sheets and filler rows."""
    info, digest = os.stat(loaded.path), hashlib.sha256()
    with open(loaded.path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return {
        "name": os.path.basename(loaded.path), "kind": TYPE_LABELS.get(loaded.ext, loaded.ext), "bytes": info.st_size, "modified": datetime.datetime.fromtimestamp(info.st_mtime, datetime.UTC).isoformat(timespec="seconds"),
        "sha256": digest.hexdigest(), "encoding": loaded.encoding, "separator": loaded.separator, "sheet": loaded.sheet_name, "sheets": list(loaded.sheet_names), "filler_rows": loaded.header_row,
    }


def marked_encoding(head: bytes) -> str | None:
    """The encoding that a byte-order mark at the start of a file names."""
    return next((name for mark, name in ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")) if head.startswith(mark)), None)


def settle_encoding(spark: SparkSession, path: str, mark: str | None) -> str:
    """The encoding of a file, from one distributed pass over all its lines: UTF-8 if every line is valid, else Windows-1252
    if it holds none of the five codes that are open there, else Latin-1. What a mark promises must hold."""
    if mark == "utf-16":
        return mark
    raw = F.col("value").cast("binary")
    row = spark.read.text(path).agg(F.count_if(~F.is_valid_utf8(raw.cast("string"))).alias("broken"), F.count_if(F.decode(raw, "ISO-8859-1").rlike("[\x81\x8d\x8f\x90\x9d]")).alias("open")).first()
    if mark and row.broken:
        raise RuntimeError(f"'{os.path.basename(path)}' begins as {mark} but is not so throughout")
    return mark or ("utf-8" if not row.broken else "latin-1" if row.open else "cp1252")


def detect_separator(text: str) -> str:
    """The most frequent of tab, semicolon, bar and comma in the first lines; the earlier of equals; a comma if none."""
    lines = [x for x in text[:SAMPLE_CHARS].splitlines() if x.strip()][:SAMPLE_LINES]
    counts = {s: sum(x.count(s) for x in lines) for s in "\t;|,"}
    best = max("\t;|,", key=lambda s: counts[s])
    return best if counts[best] else ","


def find_header_row(rows: Sequence[Sequence[str | None]], fill: float = HEADER_FILL) -> int:
    """The first row that is filled enough and mostly text; else the first that is filled enough; else 0."""
    width = max((len(r) for r in rows), default=0)
    full = [i for i, r in enumerate(rows) if width and sum(c is not None and c not in DEFAULT_NA for c in r) / width >= fill]
    for i in full:
        cells = [c for c in rows[i] if c is not None and c not in DEFAULT_NA]
        if sum(map(is_header_like, cells)) >= HEADER_TEXT * len(cells):
            return i
    return full[0] if full else 0


def na_words(blanks: Sequence[str] = DISGUISED_BLANKS) -> list[str]:
    """Words that are read as no value: the defaults but for those that count as placeholders."""
    return ["", *(w for w in DEFAULT_NA if w and w.strip().lower() not in {b.strip().lower() for b in blanks})]


#: Python codec to the charset of Spark's reader. It refuses Windows-1252, which is Latin-1 but for the 32 codes from 0x80.
_CHARSETS = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "utf-16": "UTF-16", "latin-1": "ISO-8859-1", "cp1252": "ISO-8859-1"}
_DEFINED = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_CP1252 = ("".join(map(chr, _DEFINED)), "".join(bytes([b]).decode("cp1252") for b in _DEFINED))


def _reader(spark: SparkSession, path: str, encoding: str, separator: str, width: int, whole: bool) -> DataFrame:
    """Records as c0, c1, ... and, where a record has more or fewer cells than that, its text. Lines are read by splits of
    the file unless ``whole``, which is needed where a quoted cell holds a line break."""
    schema = T.StructType([*[T.StructField(f"c{i}", T.StringType()) for i in range(width)], T.StructField("__record", T.StringType())])
    rows = spark.read.schema(schema).options(sep=separator, quote='"', escape='"', mode="PERMISSIVE", encoding=_CHARSETS[encoding], multiLine=str(whole).lower(), columnNameOfCorruptRecord="__record", maxCharsPerColumn="-1", maxColumns="1000000").csv(path)
    if encoding == "cp1252":
        rows = rows.select(*[F.translate(c, *_CP1252).alias(c) for c in rows.columns])
    if encoding in ("utf-8-sig", "utf-16"):  # the mark stays in the first cell of a file that is read by splits
        rows = rows.withColumn("c0", F.nullif(F.ltrim("c0", F.lit("\ufeff")), F.lit("")))
    return rows


def load_text(spark: SparkSession, path: str, blanks: Sequence[str] = DISGUISED_BLANKS) -> LoadedFile:
    """A delimited file as text columns plus ``__row_id``, in the order of the file.

    Encoding, width and header come from the whole file, each by one distributed pass or, the header, by a search that ends
    with the first row that fits. The width is that of the widest record, so ragged rows keep their cells and lose none; the
    header is looked for among rows filled in proportion to the most frequent width. Rows whose cells are all blank are left
    out, wherever they stand. A file that is not in the encoding of its mark, or is empty, raises.
    """
    ext = os.path.splitext(path)[1].lower()
    with open(path, "rb") as f:
        head = f.read(4 * SAMPLE_CHARS)
    if not head:
        raise RuntimeError(f"'{os.path.basename(path)}' is empty -- nothing to clean")
    encoding = settle_encoding(spark, path, marked_encoding(head))
    text = codecs.getincrementaldecoder(encoding)("replace").decode(head).lstrip("\ufeff")
    separator = "\t" if ext == ".tsv" else detect_separator(text)
    breaks_inside = (F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1) | F.col("value").rlike("(?s)\r.")  # in quotes, or a lone return
    whole = encoding == "utf-16" or not spark.read.text(path, lineSep="\n").where(breaks_inside).isEmpty()
    # A record of one cell has no text here. Where the quoting is odd, every separator may be one.
    plain, most = F.size(plain_fields(F.col("__record"), F.lit(separator))), F.length(F.regexp_replace("__record", f"[^{re.escape(separator)}]", "")) + 1
    size = F.when(F.col("__record").isNull(), F.when(F.col("c0").isNull(), 0).otherwise(1)).otherwise(F.coalesce(plain, most))
    counts = _reader(spark, path, encoding, separator, 1, whole).groupBy(size.alias("n"), (F.col("__record").isNotNull() & plain.isNull()).alias("odd")).count().collect()
    sizes = {r.n: r["count"] for r in counts if not r.odd and r.n}
    usual = max(sizes, key=lambda n: (sizes[n], n), default=1)
    width, widest = max(sizes, default=1), max((r.n for r in counts), default=1)
    rows = _reader(spark, path, encoding, separator, max(width, widest), whole)
    if widest > width:
        used = rows.agg(*[F.count(f"c{i}").alias(f"c{i}") for i in range(width, widest)]).first()
        width = max([width, *[i + 1 for i in range(width, widest) if used[f"c{i}"]]])
    rows = rows.withColumn("__row_id", F.monotonically_increasing_id())
    names = [f"c{i}" for i in range(width)]
    words = na_words(blanks)
    kept = [F.when(~F.col(c).isin(words), F.col(c)).alias(c) for c in names]
    head_row = _header(rows, names, usual)
    header_id = head_row["__row_id"] if head_row else -1
    columns = N.mangle_header([head_row[c] for c in names] if head_row else [None] * width)
    filler = rows.where((F.col("__row_id") < header_id) & F.coalesce(*names).isNotNull()).count() if head_row else 0
    body = rows.where(F.col("__row_id") > header_id).where(F.coalesce(*names).isNotNull()).select("__row_id", *kept)
    return LoadedFile(path, ext, body.toDF("__row_id", *columns), filler, encoding, separator)


def _header(rows: DataFrame, names: Sequence[str], width: int):
    """The first row that is filled enough and mostly text; else the first that is filled enough; else the first."""
    present = [F.col(c).isNotNull() & ~F.col(c).isin(*DEFAULT_NA) for c in names]
    total = lambda tests: reduce(lambda a, b: a + b, [t.cast("int") for t in tests])
    full = total(present) >= HEADER_FILL * width
    texts = total([p & header_like(F.col(c)) for p, c in zip(present, names)]) >= HEADER_TEXT * total(present)
    return rows.where(full & texts).first() or rows.where(full).first() or rows.first()


def physical_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """int, float, bool, text or blank: what an untyped text column would be read as. Leading zeros make it text."""
    tests = []
    for i, c in enumerate(columns):
        v = F.col("`" + c.replace("`", "``") + "`")
        tests += [F.count(v).alias(f"n{i}"), F.count_if(v.rlike(r"^\s*[+-]?(0|[1-9][0-9]*)\s*$")).alias(f"i{i}"), F.count_if(v.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$") & ~v.rlike(r"^\s*0[0-9]")).alias(f"f{i}"), F.count_if(F.lower(v).isin("true", "false")).alias(f"b{i}"), F.count("*").alias(f"r{i}")]
    row = df.agg(*tests).first() if tests else None
    out = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        out[c] = "blank" if not n else "bool" if row[f"b{i}"] == n else ("int" if row[f"r{i}"] == n else "float") if row[f"i{i}"] == n else "float" if row[f"f{i}"] == n else "text"
    return out


def number_display(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, number, decimals): numbers written with more decimals than they need, with the most that occur."""
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.trim(F.col("`" + c.replace("`", "``") + "`").cast("string")).alias("v")) for c in columns])))
    v = F.replace(F.col("v"), F.lit(","), F.lit(""))
    written = cells.where(F.col("v").rlike(r"^[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?$")).select("column_name", v.try_cast("double").alias("number"), F.length(F.regexp_extract(v, r"\.([0-9]+)$", 1)).alias("decimals"), F.length(F.regexp_extract(F.regexp_replace(v, r"(\.[0-9]*?)0+$", "$1"), r"\.([0-9]+)$", 1)).alias("needed"))
    return written.groupBy("column_name", "number").agg(F.max("decimals").alias("decimals"), F.max("needed").alias("needed")).where("decimals > needed").select("column_name", "number", "decimals")


def fixed_decimals(number_format: str) -> int | None:
    """Decimals that a spreadsheet number format always shows; None where it shows no plain number with fixed decimals."""
    section = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", number_format.split(";")[0])
    if re.search(r"[%EDMYHS@/]", section, re.I):
        return None
    m = re.search(r"\.(0+)(?![0#?])", section)
    return len(m[1]) if m else None
