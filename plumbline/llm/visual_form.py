"""Visually identical text with different characters: bring text to one consistent form.

Arrow's UTF-8 buffer of a whole batch is turned into one numpy array of code points (no Python string per row). Lookup
tables indexed by code point give the replacement of every character: nothing for invisible ones, the ordinary blank for
other blanks, base letter plus marks for composed letters, several letters for a ligature, the Latin letter for a
look-alike. Replacements longer than one character are placed by cumulative expansion offsets. Marks are then put into
canonical order and composed with their base by one gather per round in a table of pairs, and the array is encoded back.

Defined cases: null stays null, empty stays empty, texts of any length are processed whole; unpaired or unknown
characters stay as they are. A text that is invisible as a whole becomes empty.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.plans.lineage import cut, join_to_keys

# Letters of other scripts that print like a Latin one, in the order of the Latin letters.
CYRILLIC_LOOKALIKES = {"А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "х": "x", "у": "y", "ѵ": "v", "ԝ": "w"}
GREEK_LOOKALIKES = {"Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "α": "a", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "ϲ": "c", "ϳ": "j", "Ϲ": "C"}
OTHER_LOOKALIKES = {"ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "օ": "o", "ѕ": "s", "Ꭺ": "A", "Ꮃ": "W", "′": "'", "’": "'", "‘": "'", "ʼ": "'", "“": '"', "”": '"', "„": '"', "µ": "μ", "Ω": "Ω", "Å": "Å", "∕": "/", "⁄": "/", "∶": ":", "․": "."}
HYPHENS = "‐‑‒–—―−˗﹘﹣－⁃֊"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "Ĳ": "IJ", "ĳ": "ij", "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj", "Ǆ": "DŽ", "ǅ": "Dž", "ǆ": "dž"}
INVISIBLE_BESIDES_FORMATS = "͏ᅟᅠ឴឵ㅤﾠ"

TOP = 0xE0200  # code points from here on are for private use and are copied


def _replacement(c: str) -> str | None:
    """What a character becomes, decomposed; None where it stays."""
    o, kind = ord(c), unicodedata.category(c)
    if c in HYPHENS:
        return "-"
    if kind == "Cf" or c in INVISIBLE_BESIDES_FORMATS or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or 0x180B <= o <= 0x180D or (kind == "Cc" and c not in "\t\n\r\x0b\x0c\x85"):
        return ""
    if kind == "Zs" or c in "\t\x0b\x0c\x85  ":
        return " "
    if c in LIGATURES:
        return unicodedata.normalize("NFD", LIGATURES[c])
    text = unicodedata.normalize("NFD", c)
    how = unicodedata.decomposition(c)
    if how.startswith(("<wide>", "<narrow>")):
        text = unicodedata.normalize("NFKD", c)
        if text in HYPHENS:
            return "-"
        text = " " if text.isspace() else text
    text = "".join(lookalikes().get(x, x) for x in text)
    return None if text == c else text


@lru_cache(maxsize=1)
def lookalikes() -> dict[str, str]:
    return CYRILLIC_LOOKALIKES | GREEK_LOOKALIKES | OTHER_LOOKALIKES


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, ...]:
    """Length, place (0: stays) and text of each replacement, combining class, sorted (base, mark) pairs, their composition."""
    length, place, pool, ccc, pairs = np.ones(TOP, np.int8), np.zeros(TOP, np.int32), [0], np.zeros(TOP, np.uint8), {}
    for o in (*range(0x30000), *range(0xE0000, TOP)):  # nothing is assigned between
        if 0xD800 <= o < 0xE000:
            continue
        c = chr(o)
        ccc[o] = unicodedata.combining(c)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.is_normalized("NFC", c):
            pairs[int(parts[0], 16) << 21 | int(parts[1], 16)] = o
        if 0x20 <= o < 0x7F or 0xAC00 <= o < 0xD7A4 or (new := _replacement(c)) is None:
            continue  # Korean syllables stay composed
        length[o], place[o] = len(new), len(pool)
        pool += map(ord, new or "\0")
    keys = np.array(sorted(pairs), np.int64)
    return length, place, np.array(pool, np.uint32), ccc, keys, np.array([pairs[k] for k in keys.tolist()], np.uint32)


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a UTF-8 byte array, and for each the place of its first byte."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    b = data.astype(np.uint32)
    padded = np.concatenate([b, np.zeros(3, np.uint32)])
    x, y, z, w = padded[at], padded[at + 1], padded[at + 2], padded[at + 3]
    cp = np.where(x < 0x80, x, np.where(x < 0xE0, (x & 0x1F) << 6 | y & 0x3F, np.where(x < 0xF0, (x & 0x0F) << 12 | (y & 0x3F) << 6 | z & 0x3F, (x & 0x07) << 18 | (y & 0x3F) << 12 | (z & 0x3F) << 6 | w & 0x3F)))
    return cp, at


def _encode(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of code points, and the byte length of each."""
    n = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    start = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.uint8)
    for k, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
        m = n == k
        c, s = cp[m], start[m]
        out[s] = (c >> (6 * (k - 1))) | lead
        for i in range(1, k):
            out[s + i] = (c >> (6 * (k - 1 - i))) & 0x3F | 0x80
    return out, n


#: Bytes of text that are worked on at once; a longer single text is worked on whole.
SLICE_BYTES = 1 << 20


def one_form(texts: pa.Array) -> pa.Array:
    """The consistent form of each text of an Arrow string array."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    if len(texts) == 0:
        return texts.cast(pa.string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    cuts = [0, *(np.flatnonzero(np.diff((ends[1:] - ends[0]) // SLICE_BYTES)) + 1).tolist(), len(texts)]
    return pa.concat_arrays([_slice_form(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])


def _slice_form(texts: pa.LargeStringArray) -> pa.Array:
    length, place, pool, ccc, keys, made = _tables()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    cp, at = _code_points(data)
    row = np.searchsorted(offsets, at, side="right") - 1  # the row of each character; empty rows have none
    low = np.where(cp < TOP, cp, 0x20).astype(np.int64)
    same = place[low] == 0
    n = np.where(same, 1, length[low]).astype(np.int64)
    begin = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.uint32)
    out[begin[same]] = cp[same]
    changed = np.flatnonzero(~same & (n > 0))
    for k in range(int(n[changed].max()) if len(changed) else 0):
        m = changed[n[changed] > k]
        out[begin[m] + k] = pool[place[low[m]] + k]
    row = np.repeat(row, n)
    cls = ccc[np.where(out < TOP, out, 0x20)]
    if cls.any():
        start = np.empty(len(out), bool)
        start[:1] = True
        start[1:] = (cls[1:] == 0) | (row[1:] != row[:-1])
        segment = np.cumsum(start)
        order = np.lexsort((cls, segment))
        out, cls, row = out[order], cls[order], row[order]
        while len(out) > 1:  # each round composes one mark with each base; a mark of the same class before it is in the way
            place_of = np.arange(len(out))
            head = (cls == 0) | np.concatenate([[True], row[1:] != row[:-1]])
            base = np.maximum.accumulate(np.where(head, place_of, 0))
            key = out[base].astype(np.int64) << 21 | out
            k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            free = np.concatenate([[False], (cls[1:] != cls[:-1]) | head[:-1]])
            hit = np.flatnonzero((keys[k] == key) & (cls > 0) & ~head & free)
            if not len(hit):
                break
            hit = hit[np.unique(base[hit], return_index=True)[1]]
            out[base[hit]] = made[k[hit]]
            stay = np.ones(len(out), bool)
            stay[hit] = False
            out, cls, row = out[stay], cls[stay], row[stay]
    made_bytes, width = _encode(out)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, weights=width, minlength=len(texts)).astype(np.int64))]) if len(out) else np.zeros(len(texts) + 1, np.int64)
    valid = texts.is_valid()
    result = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(made_bytes))
    if texts.null_count:
        result = pa.compute.if_else(valid, result, pa.scalar(None, pa.large_string()))
    return result.cast(pa.string())


@F.arrow_udf(T.StringType())
def _one_form_udf(texts: pa.Array) -> pa.Array:
    return one_form(texts)


_one_form_udf = _one_form_udf.asNondeterministic()  # so that no filter on its result moves below it and has it run twice


#: Texts that are in the one form already: printable ASCII, without control characters.
_PLAIN = r"^[\x20-\x7E\n\r]*$"


def visual_form(c: Column) -> Column:
    """The consistent form as a column. Plain ASCII stays in the JVM; only other texts are handed to Python."""
    plain = c.rlike(_PLAIN)
    return F.when(plain | c.isNull(), c).otherwise(_one_form_udf(F.when(~plain, c)))


def comparison_form(c: Column) -> Column:
    """What is compared: the consistent form, without outer blanks and in lower case."""
    return F.lower(F.btrim(visual_form(c), F.lit(" \t\n\r")))


def _forms(df: DataFrame, key: str, fields: list[str], blanks: list[str]) -> DataFrame:
    """(id, field_no, f1, f2, spelling) of every filled value: 128 bits of its compared form, 64 of its spelling."""
    cells = df.select(F.col(f"`{key}`").alias("id"), F.explode(F.array(*[F.struct(F.lit(i).alias("field_no"), F.col(f"`{f}`").alias("v")) for i, f in enumerate(fields)])).alias("s")).select("id", "s.field_no", "s.v").where("v is not null")
    formed = cells.select("id", "field_no", "v", comparison_form(F.col("v")).alias("form")).where(~F.col("form").isin([*blanks, ""]))
    return formed.select("id", "field_no", F.xxhash64("form").alias("f1"), F.xxhash64(F.lit(1), "form").alias("f2"), F.xxhash64(F.lower(F.btrim("v", F.lit(" ")))).alias("spelling"))


_GROUP = ["field_no", "f1", "f2"]


def _members(df: DataFrame, key: str, fields: list[str], blanks: list[str]) -> DataFrame:
    """The rows of ``_forms`` whose form has several spellings, with n (rows of the form). Groups with a single spelling are
    dropped by an aggregate with map-side combine before any row is matched."""
    forms = _forms(df, key, fields, blanks)
    groups = forms.groupBy(*_GROUP).agg(F.count("*").alias("n"), F.min("spelling").alias("lo"), F.max("spelling").alias("hi")).where("lo <> hi")
    return join_to_keys(forms, groups.select(*_GROUP, "n", F.col("n").alias("size")), _GROUP, "n")


def lookalike_classes(df: DataFrame, key: str, fields: list[str], blanks: list[str]) -> DataFrame:
    """(field_name, <key>, class_id, spelling_id): the values that print like another spelling of them, without any pairs.

    A class is all rows whose values print alike, named by its smallest id; a spelling is the rows of a class that differ by
    no more than outer blanks and letter case, named alike. Two rows print alike and differ where they have one class and
    two spellings, so all pairs follow from this.
    """
    rows = cut(_members(df, key, fields, blanks))
    spellings = cut(rows.groupBy(*_GROUP, "spelling").agg(F.min("id").alias("spelling_id"), F.count("*").alias("n")))
    named = spellings.join(spellings.groupBy(*_GROUP).agg(F.min("spelling_id").alias("class_id")), _GROUP)
    name = F.element_at(F.array(*map(F.lit, fields)), F.col("field_no") + 1)
    return join_to_keys(rows, named, [*_GROUP, "spelling"], "n").select(name.alias("field_name"), F.col("id").alias(key), "class_id", "spelling_id")


def lookalike_pairs(df: DataFrame, key: str, fields: list[str], blanks: list[str], hot: int = 4096) -> DataFrame:
    """Pairs of rows whose values of a field print alike but differ by more than outer blanks and letter case.

    Result: (field_name, <key>_a, <key>_b) with <key>_a < <key>_b. Null, blank and placeholder values form no pairs; equal
    spellings form none either. What is asked for grows with the square of a group (``lookalike_classes`` does not); groups
    of more than ``hot`` rows are spread over several buckets on one side and copied on the other, so no task holds a whole
    hot group.
    """
    rows = cut(_members(df, key, fields, blanks)).withColumn("buckets", F.ceil(F.col("size") / hot).cast("int"))
    a = rows.select(F.col("id").alias(f"{key}_a"), F.col("spelling").alias("sa"), *_GROUP, F.pmod(F.xxhash64("id"), F.col("buckets")).cast("int").alias("bucket"))
    b = rows.select(F.col("id").alias(f"{key}_b"), F.col("spelling").alias("sb"), *_GROUP, F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    pairs = a.join(b, [*_GROUP, "bucket"]).where((F.col(f"{key}_a") < F.col(f"{key}_b")) & (F.col("sa") != F.col("sb")))
    return pairs.select(F.element_at(F.array(*map(F.lit, fields)), F.col("field_no") + 1).alias("field_name"), f"{key}_a", f"{key}_b")
