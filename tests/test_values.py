import re

import pytest
from pyspark.sql import functions as F

from plumbline.config import DISGUISED_BLANKS, WHITESPACE
from plumbline.functions import scalars
from plumbline.functions import values as V
from plumbline.functions.blanks import is_filled, is_placeholder, strip


def one(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(f(F.col("v"))).collect()]


def test_strip_is_python_strip(spark):
    values = [None, "", "  a\t", "  b　", WHITESPACE, "a b"]
    assert one(spark, values, strip) == [None if v is None else v.strip() for v in values]


def test_placeholders(spark):
    values = [*DISGUISED_BLANKS, " N/A ", "Tbd", "ok", None, "\t"]
    assert one(spark, values, is_placeholder) == [True] * len(DISGUISED_BLANKS) + [True, True, False, False, True]
    assert one(spark, values, is_filled)[-3:] == [True, False, False]


def test_encoding(spark):
    values = ["cafÃ©", "â€™", "‘a’ “b” – — …", "x y", "﻿z", "ﬁn", "plain", None, "naïve"]
    assert one(spark, values, V.fix_encoding) == ["café", "â€TM", "'a' \"b\" - - ...", "x y", "z", "fin", "plain", None, "naïve"]


def test_phones(spark):
    values = ["+44 7123 456789", "00447123456789", "7123456789", "(020) 7123 4567", "call office", None, "12"]
    assert one(spark, values, V.phone_digits) == ["07123456789", "07123456789", "07123456789", "02071234567", "call office", None, "12"]


def test_title(spark):
    assert one(spark, ["o'neil-smith", "abc1def", "ÉLAN", None, ""], V.title_case) == ["O'Neil-Smith", "Abc1Def", "Élan", None, ""]


MONEY = {"£1,234.50": 1234.5, "(12.00)": -12.0, "1.234,56": 1234.56, "5-": -5.0, "−7": -7.0, "1,23": 1.23, "1,2,3": None, "5d": None, "0x1F": None, "1_000": None, "": None, " 7 ": 7.0, "1,234": 1234.0, "1,234,567": 1234567.0, "£": None, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "--5": None, "nan": None, "€ 3": 3.0, "()": None, "-": None}


def test_money(spark):
    assert dict(zip(MONEY, one(spark, list(MONEY), V.to_money))) == MONEY
    assert {k: scalars.parse_number(k) for k in MONEY} == MONEY


def test_percent_and_flags(spark):
    assert one(spark, ["10%", "1,234%", "abc%", " 5 % "], V.to_percentage) == [10.0, None, None, 5.0]
    assert one(spark, ["TRUE", " yes ", "1.0", "0", "off", "maybe", None], V.to_flag) == ["Y", "Y", "Y", "N", "N", None, None]
    assert one(spark, ["active", "yes"], lambda c: V.to_flag(c, "status")) == [None, "Y"]


DATES = {"2026-04-01": "01/04/2026", "2026-04-01 13:45:00": "01/04/2026", "2026/04/01": "01/04/2026", "05/03/2026": "05/03/2026", "5 March 2026": "05/03/2026", "March 5, 2026": "05/03/2026", "Jan 15 2023": "15/01/2023", "01/15/2023": "15/01/2023", "31/02/2026": None, "5-3-26": "05/03/2026", "5.3.2026": "05/03/2026", "20220825": "25/08/2022", "N/A": None, "soon": None, "30-Feb-2025": None, "32 March 2024": None, "2025-00-10": None, "May": None, "": None}


def test_dates(spark):
    assert dict(zip(DATES, one(spark, list(DATES), lambda c: V.date_text(V.to_date_uk(c))))) == DATES
    plain = {k: (d.strftime("%d/%m/%Y") if (d := scalars.parse_date(k)) else None) for k in DATES}
    assert plain == DATES


def test_number_text(spark):
    df = spark.createDataFrame([(1.0,), (1e7,), (2.5,), (None,), (-0.0,)], "v double")
    assert [r[0] for r in df.select(V.number_text(F.col("v"))).collect()] == ["1", "10000000", "2.5", None, "0"]


def test_categories(spark):
    mapping = {"usa": "United States", "u.s.a": "United States"}
    assert one(spark, [" USA ", "u.s.a", "France", None], lambda c: V.map_category(c, mapping)) == ["United States", "United States", "France", None]


def test_blank_zero_false_differ(spark):
    df = spark.createDataFrame([(0, 0.0, False, "0", None)], "a int, b double, c boolean, d string, e string")
    keys = df.select(*[V.compare_key(F.col(f.name), f.dataType) for f in df.schema.fields]).first()
    assert keys[0] == keys[1] and len(set(keys)) == 4


@pytest.mark.parametrize("text", ["x" * 200_000, "9" * 5_000])
def test_long_texts(spark, text):
    assert one(spark, [text], V.title_case)[0].lower() == text


def test_messy_random_numbers_agree(spark):
    import random

    rng = random.Random(5)
    values = ["".join(rng.choice("0123456789,.-+()£ e") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    for v, got in zip(values, one(spark, values, V.to_money)):
        assert got == scalars.parse_number(v), v
    assert re.fullmatch(V.NUMBER, "1.5e3")
