"""Duplicates hidden by formatting: records that differ only in white space, case, punctuation or the order of fields.

Equal rows are collapsed first, so each distinct writing is canonicalised once: its columns are split into fields at their
separators, and each field is reduced to its letters and digits. The distinct fields are the dictionary. A field's
identifier is the integer that a 64-bit hash gives it, once the dictionary has shown that no other field has it; fields that
do share one are told apart by their place among those, so identifiers are exact, need no join and are the same when a lost
task runs again. A record is rewritten as the sorted tuple of its fields' integers, and records are grouped by these compact
tuples, with map-side combine. No text is shuffled but that of distinct writings and distinct fields.

A writing without any separators is one long field. Its letters are those of its separated copies in their field order, so
it is matched by a 128-bit digest of the unseparated columns (two hashes of the text, of different seeds) and takes over the
tuple of the separated copies.

Defined cases: null, empty and punctuation-only columns have no fields; a record without any field belongs to no group;
exact copies are copies; of several tuples that one unseparated writing fits, the smallest is taken. Texts are used whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.values import let
from plumbline.plans.lineage import cut, join_to_keys

#: Fields that share a hash with another: at 64 bits some two in ten billion. More of them mean that something is wrong.
MAX_SHARED = 10_000
_POINT, _COMMA, _CUT = "\x01", "\x02", "\x03"  # a point or comma between digits, and a border of fields, while a value is cut


def fields_of(c: Column) -> Column:
    """The canonical fields of a value in the order of writing.

    Fields end at a semicolon, bar or line break, at a comma that is not between two digits, and at a slash beside a blank.
    Of a field stay its letters and digits, and a point or comma between two digits.
    """
    plain = F.when(c.rlike(f"[{_POINT}{_COMMA}{_CUT}]"), F.translate(c, _POINT + _COMMA + _CUT, "")).otherwise(c)
    kept = lambda s: F.when(s.rlike("[0-9][.,][0-9]"), F.regexp_replace(F.regexp_replace(s, r"(?<=[0-9])\.(?=[0-9])", _POINT), "(?<=[0-9]),(?=[0-9])", _COMMA)).otherwise(s)
    cut_at = lambda s: F.when(s.contains("/"), F.regexp_replace(s, r"(?<=\s)/|/(?=\s)", _CUT)).otherwise(s)
    bare = F.regexp_replace(F.translate(let(let(F.lower(plain), kept), cut_at), ";|,\n\r", _CUT * 5), rf"(?U)[^\p{{L}}\p{{N}}{_POINT}{_COMMA}{_CUT}]+", "")
    return F.filter(F.split(F.translate(bare, _POINT + _COMMA, ".,"), _CUT), lambda x: x != "")


def coder(fields: DataFrame, hashed=F.xxhash64):
    """The integers of an array of fields as an expression, exact for the distinct texts of the column ``field``."""
    numbers = fields.groupBy("field").agg(F.count("*").alias("n")).select("field", hashed("field").alias("field_no"))
    shared = numbers.groupBy("field_no").agg(F.count("*").alias("n")).where("n > 1")
    rows = numbers.join(shared, "field_no", "left_semi").orderBy("field_no", "field").limit(MAX_SHARED + 1).collect() if not shared.isEmpty() else []
    if len(rows) > MAX_SHARED:
        raise ValueError(f"more than {MAX_SHARED} fields share a hash")
    place: dict[str, int] = {}
    for i, r in enumerate(rows):
        place[r.field] = 0 if not i or rows[i - 1].field_no != r.field_no else place[rows[i - 1].field] + 1
    if not place:
        return lambda array: F.transform(array, lambda x: hashed(x))
    places = F.create_map(*[F.lit(x) for k, v in place.items() for x in (k, v)])
    return lambda array: F.flatten(F.transform(array, lambda x: F.when(places[x].isNotNull(), F.array(hashed(x), places[x].cast("long"))).otherwise(F.array(hashed(x)))))


def _row_digest(columns: list[str]) -> list[Column]:
    """128 bits of a row's texts as they are written, nulls and empty texts alike."""
    texts = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns]
    return [F.xxhash64(*texts).alias("w1"), F.xxhash64(F.lit(1), *texts).alias("w2")]


def _writings(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(w1, w2, id, n, r): each distinct writing with its smallest id and count, and the tuple of its record."""
    distinct = df.groupBy(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(f"c{i}") for i, c in enumerate(columns)]).agg(F.min(f"`{key}`").alias("id"), F.count("*").alias("n"))
    names = [f"c{i}" for i in range(len(columns))]
    rows = distinct.select("id", "n", *_row_digest(names), F.array(*[fields_of(F.col(c)) for c in names]).alias("f"))
    codes = coder(rows.select(F.explode(F.flatten("f")).alias("field")))
    runs = F.array_sort(F.filter(F.transform("f", lambda x: F.concat_ws("", x)), lambda x: x != ""))
    coded = rows.select("id", "n", "w1", "w2", F.array_sort(codes(F.flatten("f"))).alias("t"), let(runs, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))).alias("u"), F.forall("f", lambda x: F.size(x) <= 1).alias("open"))
    coded = cut(coded).where(F.size("t") > 0)
    closed, unseparated = coded.where("not open").withColumnRenamed("t", "r"), coded.where("open")
    wanted = unseparated.select("u").distinct()
    known = closed.join(wanted, "u", "left_semi").groupBy("u").agg(F.min("r").alias("known"))
    settled = unseparated.join(known, "u", "left").withColumn("r", F.coalesce("known", "t"))
    return closed.select("w1", "w2", "id", "n", "r").unionByName(settled.select("w1", "w2", "id", "n", "r"))


def collapse(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per record: (first id, n_copies)."""
    return _writings(df, key, columns).groupBy("r").agg(F.min("id").alias(key), F.sum("n").alias("n_copies")).select(key, "n_copies")


def copies(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(first_id, copy_id): the smallest id of each record that is written more than once, with each of its other ids.

    The rows meet one small row per writing of a repeated record. Writings are broadcast if they are few; beyond, the
    writings that very many rows have are broadcast alone, so no task ever holds the rows of a hot record.
    """
    writings = _writings(df, key, columns)
    repeated = writings.groupBy("r").agg(F.min("id").alias("first_id"), F.sum("n").alias("copies")).where("copies > 1")
    members = writings.select("w1", "w2", "n", "r").join(repeated.select("r", "first_id"), "r").select("w1", "w2", "n", "first_id")
    rows = df.select(F.col(f"`{key}`").alias("id"), *_row_digest(columns))
    return join_to_keys(rows, members, ["w1", "w2"], "n").where("id <> first_id").select("first_id", F.col("id").alias("copy_id"))
