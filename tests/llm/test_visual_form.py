import unicodedata

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm import visual_form as V


def form(*texts):
    return V.one_form(pa.array(texts, pa.string())).to_pylist()


def test_what_does_not_change_print():
    same = ["fine Größe K-12", "ﬁne Größe K‑12", "fi​ne Größe K-12", "ｆｉｎｅ　Größe Ｋ－１２", "﻿fіne Größе Κ-12", "fine Größe K−12"]
    assert set(form(*same)) == {same[0]}


def test_what_stays():
    for text in ("½ × 3 ²", "Maker™ ®", "Ünïcödé", "日本", "😀 𝒳", "각", "a\nb", ""):
        assert form(text) == [text]
    assert form(None, "a", None) == [None, "a", None] and form() == []
    assert form("​") == [""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), max_size=6))
def test_plain_python_gives_the_same(texts):
    def plain(t):
        parts = "".join(r if (r := V._replacement(c)) is not None and not 0xAC00 <= ord(c) < 0xD7A4 and ord(c) < V.TOP and not 0x20 <= ord(c) < 0x7F else c for c in t)
        return parts

    got = form(*texts)
    for t, g in zip(texts, got):
        assert (t is None) == (g is None)
        if t is not None and all(unicodedata.combining(c) == 0 for c in plain(t)):
            assert g == plain(t)
    assert form(*got) == got  # bringing to one form twice changes nothing


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeoucnszAEOÙ̧̨́̂̃̈̊̌", max_size=10))
def test_composition_is_canonical(text):
    assert form(text) == [unicodedata.normalize("NFC", text)] == form(unicodedata.normalize("NFD", text))


def test_slices(monkeypatch):
    texts = [("x%dé" % i) * (i % 5) for i in range(200)] + [None, "", "ﬁ" * 5_000]
    whole = form(*texts)
    monkeypatch.setattr(V, "SLICE_BYTES", 37)
    assert form(*texts) == whole == [t if t is None else t.replace("ﬁ", "fi") for t in texts]


def test_pairs(spark):
    rows = [(1, "AB-1", "x"), (2, "ab‑1 ", "x"), (3, "ab-1", "x"), (4, " AB-1", "y"), (5, None, "N/A"), (6, "N/A", "ｎ/a"), (7, "", None), (8, "​", None), (9, "Ａ", None), (10, "a", None)]
    df = spark.createDataFrame(rows, "row_id long, app string, form string")
    got = sorted(tuple(r) for r in V.lookalike_pairs(df, "row_id", ["app", "form"], ["n/a"]).collect())
    assert got == [("app", 1, 2), ("app", 2, 3), ("app", 2, 4), ("app", 9, 10)]
    assert V.lookalike_pairs(df.limit(0), "row_id", ["app"], []).count() == 0


def test_hot_groups_are_split(spark):
    df = spark.createDataFrame([(i, "A" if i % 2 else "Α") for i in range(60)], "row_id long, app string")
    few, many = (V.lookalike_pairs(df, "row_id", ["app"], [], hot=h) for h in (4, 4096))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 900


def test_column(spark):
    df = spark.createDataFrame([("plain",), ("Ｆ",), (None,), ("x" * 60_000 + "ﬁ",)], "t string")
    assert [r[0] for r in df.select(V.visual_form(F.col("t"))).collect()] == ["plain", "F", None, "x" * 60_000 + "fi"]
    assert [r[0] for r in df.select(V.comparison_form(F.col("t"))).collect()][:3] == ["plain", "f", None]
