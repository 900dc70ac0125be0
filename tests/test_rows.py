import pytest
from pyspark.sql import functions as F

from plumbline.operators import columns as C
from plumbline.operators import rows as R


def ids(df, c="i"):
    return sorted(r[0] for r in df.select(c).collect())


@pytest.mark.parametrize("copies, left", [(0, 2), (1, 3), (2, 2), (3, 2)])
def test_repeated_headers(spark, copies, left):
    df = spark.createDataFrame([("1", "a"), ("2", "b")] + [(" ID", "Full  Name")] * copies, "id string, full_name string")
    assert R.drop_repeated_headers(df.toDF("id", "full_name")).count() == left


def test_all_rows_headers_and_one_column(spark):
    df = spark.createDataFrame([("id", "name")] * 3, "id string, name string")
    assert R.drop_repeated_headers(df).count() == 3
    assert R.drop_repeated_headers(df.select("id")).count() == 3


def test_totals(spark):
    df = spark.createDataFrame([(1, "Grand  Total", "5", "£6", None), (2, "total", "5", None, None), (3, "Total", "a", "b", None), (4, "x", "1", "2", None), (5, None, "1", "2", "3"), (6, " TOTALS", "1,200", "", "z")], "i int, label string, a string, b string, c string")
    assert ids(R.drop_totals(df, ["label", "a", "b", "c"])) == [2, 3, 4, 5]


def test_duplicates_keep_first_as_written(spark):
    df = spark.createDataFrame([(2, "ACME", None), (1, " acme ", None), (3, "acme", ""), (4, None, None), (5, None, None)], "i int, a string, b string")
    assert ids(R.drop_duplicates(df, "i", ["a", "b"])) == [1, 3, 4]
    assert R.drop_duplicates(df, "i", []).count() == 5
    assert R.drop_duplicates(df.limit(0), "i", ["a", "b"]).count() == 0


def test_longest_per_key(spark):
    rows = [(1, "A1", "short"), (2, "A1", "longest"), (3, "A1", "longes2"), (4, "a1", "x"), (5, "N/A", "u"), (6, "n/a", "v"), (7, None, "w"), (8, "B", ""), (9, "B", None), (10, " A1 ", "TBD")]
    df = spark.createDataFrame(rows, "i int, app string, d string")
    assert ids(R.longest_per_key(df, "app", "i", ["d"])) == [2, 4, 5, 6, 7, 8, 9]


def test_blank_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", None), (3, None, None), (4, "a", "b")], "i int, a string, b string")
    assert ids(R.drop_blank_rows(df, ["a", "b"])) == [2, 4]


def test_top_per_group_ties(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("y", 3, 1)], "g string, i int, v int")
    assert sorted(tuple(r) for r in R.top_per_group(df, ["g"], [F.col("v"), F.col("i")], ["i"]).collect()) == [("x", 2), ("y", 3)]


def test_copies_of_columns(spark):
    df = spark.createDataFrame([("a", "A", "b", 1), ("c", "C", None, 2)], "email string, `email.1` string, `email.2` string, i int")
    new, renamed = C.resolve_copies(df)
    assert renamed == {"email.2": "email_alt_1"} and new.columns == ["email", "email.1", "email_alt_1", "i"]
    assert C.drop_equal_copies(df).columns == ["email", "email.2", "i"]


def test_equal_columns(spark):
    df = spark.createDataFrame([(1, "a", "A", None, " ", 0, False, None), (2, "b", "b", None, "", 1, True, None)], "i int, a string, b string, c string, d string, n int, t boolean, e string")
    assert C.equal_columns(df, "i") == [("a", "b")]
    assert C.blank_columns(df) == {"c", "e"} and C.drop_blank(df).columns == ["i", "a", "b", "d", "n", "t"]
    assert C.equal_columns(df.limit(0), "i") == []


def test_one_moved_value_is_no_copy(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "b", "a")], "i int, x string, y string")
    assert C.equal_columns(df, "i") == []
