"""The two readers of the grammar agree on every writing, and nothing else in the library reads numbers or dates."""

import itertools
import random

from pyspark.sql import functions as F

from plumbline.functions import scalars
from plumbline.functions import values as V

DATES = [
    "5-Mar-23", "Mon 5 March 2023", "18991231", "2023-01/05 anything", "01-02/2023", "5 March 2026 25:99", "5 March 2026 23:59", "2026-02-29", "2024-02-29", "0000-01-01", "1/2/68", "1/2/69", "1.2.2023 7:05 pm", "2023-05-06T10:11:12.5Z", "2023/5/6 10:11+01:00",
    "Sept 3, 2021", "sep 3 21", "3rd of May 2020", "3rd May, 2020", "Thursday, 3 May 2018", "31 April 2020", "13/13/2020", "12/31/2020", "31/12/2020", " 1 / 2 / 2020", "1 2 2020", "１/2/2020", "2020-1-1\n", "May 2020", "2020", "20201301", "20200101", "1-2-3", "5march2020", "5 Marchember 2020",
    *[f"{d}{s}{m}{s}{y}" for d, m, y, s in itertools.product((1, 31, 0), (2, 12, 13), (2020, 99), "-/. ")], *[f"{d} {m} 2021" for d in (1, 30) for m in "January Feb MARCH apr May june Jul August sept October Nov december foo".split()],
]
NUMBERS = [
    "1", "-1", "+1", "1.", ".5", "1e5", "1E-5", "1,234", "1,23", "1,2", "1,234,56", "1,234,567", "1.234.567", "1.234,56", "1,234.56", "1,2,3.5", "1.2,3,4", "(5)", "( 5 )", "(5", "5)", "5-", "5 -", "-5-", "--5", "−5", "–5", "5—", "£5", "5€", "£ 5", "-£5", "£-5", "(£5)", "$1,000.00", "¥", "()", "-", "",
    " ", "inf", "-inf", "Infinity", "nan", "NaN", "1_000", "0x1F", "5d", "1f", "١", "１", "1 000", "1 000", "e5", "1e", "1,e5", ",", ".", ",5", "5,", "1,,2", "1..2", "5%", "a", "1" * 400, "1" + " " * 300,
]


def both(spark, texts, column, scalar):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", column(F.col("t")).alias("v")).collect():
        assert r.v == scalar(r.t), r


def test_dates(spark):
    both(spark, DATES, V.to_date_uk, scalars.parse_date)


def test_numbers(spark):
    rng = random.Random(1)
    both(spark, NUMBERS + ["".join(rng.choice("0123456789,.-+()£−€e ") for _ in range(rng.randint(1, 12))) for _ in range(2000)], V.to_money, scalars.parse_number)


def test_flags(spark):
    both(spark, ["Y", " yes", "1.0", "1.00", "1.", "0", "maybe", "", "ON", "enabled", "2"], lambda c: V.to_flag(c).isNotNull(), scalars.is_flag)


def test_number_text_is_python_text(spark):
    values = [12345678.9, 0.0001, 0.00001234, 1e16, 1.5e16, 1e-5, -2.5e-7, 123456789012345.6, 1e15, 9999999.5, -0.001, 1e300, 2.5e-300, 0.1, 1e22, float("inf"), float("-inf"), 100.0, -7.0, 1234567.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = [str(int(v)) if abs(v) < 1e16 and v == int(v) else str(v) for v in values if abs(v) != float("inf")]
    got = [r[0] for r in df.select(V.number_text(F.col("v"))).collect()]
    assert [g for g in got if "inf" not in g] == wanted and got[15:17] == ["inf", "-inf"]


def test_number_text_has_the_fewest_digits(spark):
    values = [-9.06282354799018e16, 9.892985009487029e17, 3.0617315596860195e25, 2.0**-44, 5e-324, 2e23, 1e23, 0.1 + 0.2, 1 / 3, 4503599627370497.5, 2.2250738585072014e-308, 1.7976931348623157e308]
    rng = random.Random(2)
    values += [-rng.uniform(800, 500000) * 2**40 for _ in range(3000)] + [rng.uniform(0, 1) * 10 ** rng.randint(-20, 20) for _ in range(2000)]
    wanted = [str(int(v)) if abs(v) < 1e16 and v == int(v) else repr(v) for v in values]
    for shift in (0, 1):  # planned anew each time
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").where(F.col("i") >= shift)
        assert [r[0] for r in df.orderBy("i").select(V.number_text(F.col("v"))).collect()] == wanted[shift:]
