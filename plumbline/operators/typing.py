"""What kind of column is this: rules over the name and one profile row per column.

The profile is taken in long form, so a wide table costs one aggregate: columns are unpivoted and every rate that a rule
needs is a conditional count. Distinct values are counted exactly from (column, value) counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import CLEAR_FLAG_WORDS, DISGUISED_BLANKS, FALSE_WORDS, FLAG_NAME_TOKENS, ID_KEYWORDS, TRUE_WORDS
from plumbline.functions import names as N
from plumbline.functions import values as V
from plumbline.functions.blanks import is_placeholder

DATE_RATE, FLAG_RATE, PHONE_RATE, EMAIL_RATE, NUMBER_RATE, SIGN_RATE = 0.6, 0.75, 0.5, 0.5, 0.5, 0.3
UNIQUE_RATE, CATEGORY_RATE, FLAG_VALUES = 0.95, 0.2, 16


@dataclass(frozen=True)
class ColumnProfile:
    """Counts over one column; ``n`` leaves out null and placeholder cells."""

    name: str
    rows: int
    present: int
    n: int
    distinct: int
    emails: int
    phones: int
    currency: int
    percents: int
    leading_zero: int
    number_like: int
    money: int
    dates: int
    filled_text: int
    flag_words: int
    word_flags: int
    flag_keys: frozenset[str]

    def rate(self, count: int) -> float:
        return count / self.n if self.n else 0.0


def profiles(df: DataFrame, columns: Sequence[str], blanks: Sequence[str] = DISGUISED_BLANKS) -> dict[str, ColumnProfile]:
    """One profile per column, from one long-form aggregate over exact value counts.

    Money is counted only where a rule asks for it, in columns whose name is that of a price or a measure, and dates only in
    columns of text or time; both see whole values.
    """
    if not columns:
        return {}
    types = dict(df.dtypes)
    money = [i for i, c in enumerate(columns) if N.is_price(c) or N.is_measure(c)]
    dated = [i for i, c in enumerate(columns) if types[c] == "string" or types[c].startswith(("date", "timestamp"))]
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col("`" + c.replace("`", "``") + "`").cast("string").alias("v")) for i, c in enumerate(columns)])))
    counts = cells.groupBy("i", "v").agg(F.count("*").alias("n"))
    v, n = F.col("v"), F.col("n")
    sample = v.isNotNull() & ~is_placeholder(v, blanks)
    words = list(TRUE_WORDS + FALSE_WORDS)
    total = lambda test: F.sum(F.when(test, n).otherwise(0))
    like = lambda pattern: F.col("sample") & v.rlike(pattern)
    parsed = lambda which, f: F.col("sample") & F.col("i").isin(which) & f(F.when(F.col("sample") & F.col("i").isin(which), v)).isNotNull()
    counts = counts.select("i", "v", "n", sample.alias("sample"))
    counts = counts.select("*", parsed(money, V.to_money).alias("money"), parsed(dated, V.to_date_uk).alias("date"), V.flag_key(v).alias("key"))
    sample, key = F.col("sample"), F.col("key")
    rows = counts.groupBy("i").agg(
        F.sum("n").alias("rows"), total(v.isNotNull()).alias("present"), total(sample).alias("n"), F.count_if(v.isNotNull()).alias("distinct"),
        total(like(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")).alias("emails"), total(like(r"^[0-9\s\-().+]{7,}$")).alias("phones"),
        total(like("[£$€]")).alias("currency"), total(like("%")).alias("percents"), total(like("^0[0-9]")).alias("leading_zero"),
        total(like(r"^[£$€]?-?[0-9]+(\.[0-9]+)?%?$")).alias("number_like"),
        total(sample & F.col("money")).alias("money"), total(sample & F.col("date")).alias("dates"),
        total(like(r"(?U)\S")).alias("filled_text"), total(sample & key.isin(words)).alias("flag_words"),
        total(sample & key.isin([w for w in words if w not in ("0", "1")])).alias("word_flags"),
        F.collect_set(F.when(sample & key.isin(words), key)).alias("flag_keys"),
    )
    found = {r.i: r for r in rows.collect()}
    out = {}
    for i, c in enumerate(columns):
        r = found.get(i)
        counted = list(ColumnProfile.__dataclass_fields__)[1:-1]
        out[c] = ColumnProfile(c, *(int(r[f] or 0) for f in counted), frozenset(r.flag_keys)) if r else ColumnProfile(c, *[0] * len(counted), frozenset())
    return out


def is_flag_column(p: ColumnProfile) -> bool:
    """Flag words alone, or nearly so; digits and one-sided words count only where words of both sides or the name support them."""
    if N.is_app_number(p.name) or not p.n:
        return False
    true, false = map(set, V.flag_words(p.name))
    digits, keys = {"1", "0"}, set(p.flag_keys)
    named = p.name.lower().startswith(("is_", "has_")) or bool(set(FLAG_NAME_TOKENS) & set(N.tokens(p.name)))
    two_sided = lambda k: bool(k & true) and bool(k & false)
    if p.flag_words == p.n and keys and keys <= true | false:
        return named if keys <= digits else two_sided(keys) or named or keys <= set(CLEAR_FLAG_WORDS)
    return p.word_flags < p.n and p.rate(p.word_flags) >= FLAG_RATE and two_sided(keys - digits)


def is_id_column(p: ColumnProfile) -> bool:
    if N.has_phone_token(p.name) or is_flag_column(p):
        return False
    if N.has_keyword(p.name, ID_KEYWORDS):
        return True
    lower = p.name.lower()
    if N.is_price(p.name) or N.is_measure(p.name) or "date" in lower or lower.endswith("_dt"):
        return False
    if p.rate(p.currency) >= SIGN_RATE or p.rate(p.percents) >= SIGN_RATE or p.rate(p.emails) >= EMAIL_RATE or not p.n:
        return False
    return p.leading_zero > 0 or p.distinct / p.n > UNIQUE_RATE


def is_date_column(p: ColumnProfile) -> bool:
    return bool(p.filled_text) and p.number_like / p.filled_text < 0.5 and p.dates / p.filled_text >= DATE_RATE


def semantic_type(p: ColumnProfile) -> str:
    """The first rule that fits, in fixed order."""
    if not p.present:
        return "blank"
    if is_date_column(p):
        return "date"
    if not p.n:
        return "placeholders"
    if is_id_column(p):
        return "id"
    if p.rate(p.emails) >= EMAIL_RATE:
        return "email"
    if N.has_phone_token(p.name) or (not N.is_price(p.name) and not N.is_measure(p.name) and p.rate(p.phones) >= PHONE_RATE):
        return "phone"
    if p.rate(p.currency) >= SIGN_RATE:
        return "currency"
    if p.rate(p.percents) >= SIGN_RATE:
        return "percentage"
    if is_flag_column(p):
        return "flag"
    if N.is_price(p.name) and p.rate(p.money) >= NUMBER_RATE:
        return "price"
    if N.is_measure(p.name) and p.rate(p.money) >= NUMBER_RATE:
        return "measure"
    if 1 < p.distinct <= CATEGORY_RATE * p.present:
        return "category"
    return "text"


def semantic_types(df: DataFrame, columns: Sequence[str] | None = None, blanks: Sequence[str] = DISGUISED_BLANKS) -> dict[str, str]:
    columns = list(df.columns if columns is None else columns)
    return {c: semantic_type(p) for c, p in profiles(df, columns, blanks).items()}


CONVERSIONS = {"currency": V.to_money, "price": V.to_money, "measure": V.to_money, "percentage": V.to_percentage}


def converter(kind: str, name: str):
    """The conversion of a kind of column, or None where values stay as they are."""
    if kind == "date":
        return lambda c: V.date_text(V.to_date_uk(c))
    if kind == "flag":
        return lambda c: V.to_flag(c, name)
    return CONVERSIONS.get(kind)
