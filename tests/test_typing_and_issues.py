from pyspark.sql import functions as F

from plumbline.operators import issues as I
from plumbline.operators import typing as Ty


def kinds(spark, **columns):
    n = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    return Ty.semantic_types(df)


def test_kinds(spark):
    n = 20
    got = kinds(
        spark,
        code=[str(i) for i in range(n)], email=[f"a{i}@b.c" for i in range(n)], contact=["020 7123 45%02d" % i for i in range(n)], phone_number=["x"] * n,
        revenue=["£%d" % (i % 4) for i in range(n)], discount=["%d%%" % (i % 3) for i in range(n)], is_paid=["yes", "no"] * (n // 2), status=["active", "inactive"] * (n // 2),
        unit_price=["5.00"] + ["TBD"] * (n - 1), height=["1,5%d" % (i % 2) for i in range(n)], order_date=["2026-04-%02d" % (i % 9 + 1) for i in range(n)], colour=["red", "blue"] * (n // 2),
        remark=["t%d" % (i % 12) for i in range(n)], nothing=[None] * n, gaps=["N/A"] * n, answer=["yes"] * 16 + ["maybe", "no", "no", "no"], orders=["1", "0"] * (n // 2), vatno=["01"] + ["2"] * (n - 1),
    )
    assert got == {
        "code": "id", "email": "email", "contact": "id", "phone_number": "phone", "revenue": "currency", "discount": "percentage", "is_paid": "flag", "status": "category", "unit_price": "price", "height": "measure",
        "order_date": "date", "colour": "category", "remark": "text", "nothing": "blank", "gaps": "placeholders", "answer": "flag", "orders": "category", "vatno": "id",
    }


def test_thresholds(spark):
    assert kinds(spark, v=[f"a{min(i, 94)}" for i in range(100)])["v"] == "text"  # 95 of 100 distinct
    assert kinds(spark, v=[f"a{min(i, 95)}" for i in range(100)])["v"] == "id"
    assert kinds(spark, v=[f"a{i % 20}" for i in range(100)])["v"] == "category"
    assert kinds(spark, v=[f"a{i % 21}" for i in range(100)])["v"] == "text"


def test_empty_table(spark):
    assert Ty.semantic_types(spark.createDataFrame([], "a string")) == {"a": "blank"}
    assert Ty.semantic_types(spark.createDataFrame([], "a string"), []) == {}


def test_price_issues(spark):
    df = spark.createDataFrame([(1, "12.5"), (2, "0"), (3, None), (4, "FALSE"), (5, "3"), (6, "abc"), (7, "TBD"), (8, "-1")], "i int, unit_price string")
    assert sorted(r.i for r in I.price_anomalies(df, "unit_price", "i").collect()) == [2, 6, 8]
    text = spark.createDataFrame([(1, "abc"), (2, "def"), (3, "0")], "i int, unit_price string")
    assert [r.i for r in I.price_anomalies(text, "unit_price", "i").collect()] == [3]


def test_keys(spark):
    df = spark.createDataFrame([(1, "A"), (2, " A "), (3, "a"), (4, "N/A"), (5, "N/A"), (6, None), (7, "")], "i int, app string")
    assert sorted(r.i for r in I.duplicate_keys(df, "app", "i").collect()) == [1, 2]
    assert sorted(r.i for r in df.where(I.key_invalid(F.col("app"))).collect()) == [4, 5, 6, 7]


def test_issue_table(spark):
    df = spark.createDataFrame([(1, "A", "x", "abc"), (2, "A", None, "5"), (3, None, "TBD", "0"), (4, "B", "y", "7")], "i int, app_number string, note string, unit_price string")
    got = sorted((r.i, r.column_name, r.issue) for r in I.table_issues(df, "i", ["app_number", "note", "unit_price"], ["unit_price"]).collect())
    assert got == [(1, "app_number", "KEY_DUPLICATE"), (1, "unit_price", "FAILED"), (1, "unit_price", "PRICE"), (2, "app_number", "KEY_DUPLICATE"), (2, "note", "MISSING"), (3, "app_number", "KEY_INVALID"), (3, "note", "DISGUISED"), (3, "unit_price", "PRICE")]
