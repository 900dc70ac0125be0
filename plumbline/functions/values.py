"""Value operators as column expressions: whitespace, encoding, phones, casing, categories, numbers, flags, dates.

All of them map null to null, work on texts of any length, and never raise on odd input: what cannot be converted becomes
null, and the caller keeps the original beside it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import CATEGORY_MAPPINGS, FALSE_WORDS, STATE_WORDS, TRUE_WORDS
from plumbline.functions import grammar as G
from plumbline.functions.blanks import is_placeholder, strip
from plumbline.functions.names import tokens

NUMBER = G.NUMBER
PHONE_LIKE = r"^[\s()+\-.0-9]{5,}$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used: expressions would otherwise be copied."""
    return F.element_at(F.transform(F.array(value), body), 1)


def latin1_repair(c: Column) -> Column:
    """UTF-8 text that was read as Latin-1, read again; other text unchanged."""
    narrow = F.when(c.rlike(r"^[\x00-\xFF]*$") & c.rlike(r"[\x80-\xFF]"), c)
    raw = F.encode(narrow, "ISO-8859-1").cast("string")
    return F.when(narrow.isNotNull() & F.is_valid_utf8(raw), raw).otherwise(c)


def plain_punctuation(c: Column) -> Column:
    """Curly quotes, dashes, ellipses and no-break spaces as their plain forms; byte-order marks dropped."""
    return F.translate(F.replace(F.replace(c, F.lit("\u2026"), F.lit("...")), F.lit("\ufeff"), F.lit("")), "\u00a0\u2018\u2019\u201c\u201d\u2013\u2014", " ''\"\"--")


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def fix_encoding(c: Column) -> Column:
    """Latin-1 damage repaired, punctuation made plain, compatibility characters composed. ASCII stays in the JVM."""
    odd = F.when(c.rlike(r"[^\x00-\x7F]"), c)
    return F.coalesce(_nfkc(plain_punctuation(latin1_repair(odd))), c)


def phone_digits(c: Column) -> Column:
    """Digits of a phone number in national form; what does not look like a number stays."""
    d = F.regexp_replace(c, r"[^0-9]", "")
    national = F.when(d.startswith("0044"), F.substring(d, 3, 1000)).otherwise(d)
    national = F.when(national.startswith("44"), F.concat(F.lit("0"), F.substring(national, 3, 1000))).otherwise(national)
    national = F.when((F.length(national) == 10) & national.startswith("7"), F.concat(F.lit("0"), national)).otherwise(national)
    return F.when(c.rlike(PHONE_LIKE), national).otherwise(c)


def title_case(c: Column) -> Column:
    """A capital after every character that is no letter, small letters elsewhere."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"([\p{L}]+|[^\p{L}]+)"), F.lit(1)), F.initcap), "")


def apply_case(c: Column, rule: str) -> Column:
    return {"title": title_case, "lower": F.lower, "upper": F.upper}[rule](c)


def map_category(c: Column, mapping: Mapping[str, str]) -> Column:
    """The canonical value of a known spelling; other values stay."""
    if not mapping:
        return c
    table = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k.strip().lower(), v)])
    return F.coalesce(table[F.lower(strip(c))], c)


def currency_text(c: Column) -> Column:
    """A number as people write money, in a form that a number parser reads."""
    return let(strip(c), lambda s: let(_unsigned(s), _unseparated))


def _unsigned(s: Column) -> Column:
    """Brackets and trailing minus as a leading minus, dashes as minus, currency signs gone."""
    inner, before = strip(F.substr(s, F.lit(2), F.length(s) - 2)), strip(F.substr(s, F.lit(1), F.length(s) - 1))
    signed = F.when(s.startswith("(") & s.endswith(")") & (F.length(s) > 1), F.concat(F.lit("-"), inner)).when(s.endswith("-") & ~s.startswith("-"), F.concat(F.lit("-"), before)).otherwise(s)
    return F.translate(signed, G.DASHES + G.CURRENCY_SIGNS, "-" * len(G.DASHES))


def _unseparated(s: Column) -> Column:
    """The last of comma and point is the decimal sign; a lone comma is one before two digits, else it marks thousands."""
    comma, point = F.instr(F.reverse(s), ","), F.instr(F.reverse(s), ".")  # from the end; 0 where absent
    plain = F.replace(s, F.lit(","), F.lit(""))
    both = F.when(comma < point, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(plain)
    single = F.when(s.rlike("^[^,]*,[^,]{2}$"), F.replace(s, F.lit(","), F.lit("."))).when(s.rlike("^[^,]*(,[^,]{3})+$"), plain).otherwise(s)
    return strip(F.when((comma > 0) & (point > 0), both).when(comma > 0, single).otherwise(s))


def to_number(c: Column) -> Column:
    """Strictly a number or a word for infinity, else null. Spark's own cast also takes type suffixes and "not a number"."""
    return let(strip(c), lambda s: F.when(s.rlike(NUMBER) | s.rlike(G.INFINITE), s.try_cast("double")))


def to_money(c: Column) -> Column:
    return to_number(currency_text(c))


def to_percentage(c: Column) -> Column:
    return to_number(F.replace(c, F.lit("%"), F.lit("")))


@F.arrow_udf(T.StringType())
def _shortest_text(numbers: pa.Array) -> pa.Array:
    return pa.array([None if x is None else repr(x) for x in numbers.to_pylist()], pa.string())


def number_text(c: Column) -> Column:
    """A number as text: integral values without a point, others with the fewest digits that give the number back and, as
    people write them, without an exponent from 1e-4 up to 1e16; beyond that an exponent of at least two digits, as in
    ``1e+16`` and ``1e-05``.

    Before Java 19, Java's text may have a digit too many or not the nearest last one. It has neither with up to 15 digits,
    as no two decimals of that length are one double, subnormal ones aside; only longer ones go to Python. What goes there is
    chosen without ``let``: Spark does not always find a Python function again whose argument holds a lambda."""
    x = c.cast("double")
    long = (F.abs(x) <= 1e-300) | ((F.length(x.cast("string")) > 16) & (F.length(_digits(x.cast("string"))) > 15))
    return F.coalesce(_shortest_text(F.when(~_whole(x) & long, x)), let(x, _number_text))


def _whole(x: Column) -> Column:
    return (x == F.floor(x)) & (F.abs(x) < 1e16)


def _number_text(x: Column) -> Column:
    """The text of whole numbers and of those that Java writes with up to 15 digits."""
    written = let(x.cast("string"), lambda t: F.when(t.contains("E"), _exponent_text(x, t)).otherwise(t))
    return F.when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf")).when(_whole(x), x.cast("decimal(38,0)").cast("string")).otherwise(written)


def _digits(t: Column) -> Column:
    """The significant digits of a written number."""
    return F.regexp_replace(F.regexp_replace(F.split_part(t, F.lit("E"), F.lit(1)), r"^[-0.]+|\.", ""), "0+$", "")


def _exponent_text(x: Column, t: Column) -> Column:
    """``t`` is a writing of x with an exponent: its digits are kept, its point is moved or its exponent rewritten."""
    digits = _digits(t)
    power = F.split_part(t, F.lit("E"), F.lit(2)).cast("int")
    sign = F.when(x < 0, "-").otherwise("")
    after = F.substr(digits, F.lit(2), F.length(digits))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    large = F.concat(F.substr(digits, F.lit(1), power + 1), F.lit("."), F.substr(digits, power + 2, F.length(digits)))
    exponent = F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(after != "", F.concat(F.lit("."), after)).otherwise(""), F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return F.concat(sign, F.when((power < 0) & (power >= -4), small).when((power >= 0) & (power < 16), large).otherwise(exponent))


def flag_words(name: str, mappings: Mapping[str, Mapping[str, str]] = CATEGORY_MAPPINGS) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """True and false words of a column; a column with categories of its own has no state words."""
    own = any(t in mappings for t in tokens(name))
    keep = lambda words: tuple(w for w in words if not (own and w in STATE_WORDS))
    return keep(TRUE_WORDS), keep(FALSE_WORDS)


def flag_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), r"^([01])\.0+$", "$1")


def to_flag(c: Column, name: str = "") -> Column:
    true, false = flag_words(name)
    return F.when(flag_key(c).isin(*true), "Y").when(flag_key(c).isin(*false), "N")


def to_date_uk(c: Column) -> Column:
    """A calendar date: year first as written, otherwise day first, month first only where day first is no date."""
    return let(strip(c), _date_of)


def _date_of(s: Column) -> Column:
    result = None
    for style in G.DATE_STYLES:
        found, date = s.rlike(style.pattern), _date(s, style)
        result = F.when(found, date) if result is None else result.when(found, date)
    return result


def _date(s: Column, style: G.DateStyle) -> Column:
    year, month, day = (F.regexp_extract(s, style.pattern, i) for i in (style.year, style.month, style.day))
    if style.named_month:
        month = F.floor((F.position(F.lower(F.substring(month, 1, 3)), F.lit(G.MONTH_STARTS)) + 2) / 3).cast("string")
    century = F.when(F.length(year) == 4, "").when(year < str(G.PIVOT_YEAR), "20").otherwise("19")
    whole = F.nullif(F.concat(century, year), F.lit("0000"))
    orders = [(month, day), (day, month)][: 1 + style.either_order]
    return F.coalesce(*[F.concat(whole, F.lit("-"), m, F.lit("-"), d).try_cast("date") for m, d in orders])


def date_text(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def failed(original: Column, converted: Column) -> Column:
    """Conversion failed: nothing came out although something other than a placeholder went in."""
    return converted.isNull() & original.isNotNull() & ~is_placeholder(original)


def compare_key(c: Column, data_type: T.DataType) -> Column:
    """Cell identity across columns: blank, number, boolean and text are different things; text ignores case."""
    if isinstance(data_type, T.BooleanType):
        tagged = F.concat(F.lit("b"), c.cast("string"))
    elif isinstance(data_type, T.NumericType):
        d = c.cast("double")
        tagged = F.concat(F.lit("n"), F.when(d == F.floor(d), d.cast("decimal(38,0)").cast("string")).otherwise(d.cast("string")))
    elif isinstance(data_type, T.StringType):
        tagged = F.concat(F.lit("s"), F.lower(strip(c)))
    else:
        tagged = F.concat(F.lit("o"), c.cast("string"))
    return F.coalesce(tagged, F.lit("\x00"))
