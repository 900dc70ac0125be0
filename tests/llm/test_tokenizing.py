import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import tokenizing as K

pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    reference = tokenizers.Tokenizer.from_file(K.vocabulary_path())
    reference.encode_special_tokens = True
    return K.transducer(K.vocabulary_path()), reference


def same(both, text):
    mine, reference = both
    ids = mine.encode(text)
    assert ids == reference.encode(text, add_special_tokens=False).ids
    assert mine.decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_random_text(both, text):
    same(both, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAb 'sdtré0019,.-\n\t日😀_<|>", max_size=80))
def test_likely_text(both, text):
    same(both, text)


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a" * 5_000, " " * 3_000, "antidisestablishmentarianism" * 50, "あ" * 700, "I'll we've  \r\n\r\n x", "﻿‍"])
def test_special(both, text):
    same(both, text)


def test_small_memos_change_nothing(both, monkeypatch):
    text = "The quick brown fox, 12.5 x 30 mm; für Größe " * 20
    monkeypatch.setattr(K, "MAX_STATES", 50)
    monkeypatch.setattr(K, "MAX_WORDS", 5)
    assert K.Transducer(K.vocabulary_path()).encode(text) == both[0].encode(text)


def test_stream():
    data = "aé日😀".encode() + b"\xff\xe2\x82"
    s = K.Utf8Stream()
    assert "".join(s.feed(bytes([b])) for b in data) + s.end() == data.decode("utf-8", "replace")


def test_table(spark):
    df = spark.createDataFrame([(1, "Hello world", 5), (2, "", 5), (3, None, 5), (4, "Hello world", 5), (5, "x " * 50_000, 5)], "doc_id long, text string, ids int")
    got = {r.doc_id: r.ids for r in K.token_ids(df, "doc_id", "text").collect()}
    assert got[1] == got[4] == [15496, 995] and got[2] == got[3] == [] and len(got[5]) >= 50_000
    assert K.token_ids(df.limit(0), "doc_id", "text").count() == 0
