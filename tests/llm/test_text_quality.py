import numpy as np

from plumbline.llm import text_quality as Q
from plumbline.llm.train_quality import layout_label

COMMON = ["the", "of", "is", "and", "a", "to", "in", "it", "was", "that", "we", "for"]
PROSE = "We sent the sheet back because the macro was wrong. It is the only copy of the list, and that was a surprise to the depot.\nThe rest can wait until next week."


def figures(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r.asDict() for r in Q.statistics(df, "id", "text", COMMON).orderBy("id").collect()]


def test_figures(spark):
    a, b, c, d = figures(spark, "The cat is here.\n\n- 12 of it", "", None, "x" * 100_000)
    assert (a["n_words"], a["n_lines"], a["n_chars"]) == (6, 2, 28) and a["common_share"] == 4 / 6 and a["line_end_share"] == 0.5 and a["bullet_share"] == 0.5
    assert a["digit_ratio"] == 2 / 28 and a["symbol_ratio"] == 2 / 28 and a["mean_word_length"] == 16 / 6 and a["distinct_share"] == 1.0
    for empty in (b, c):
        assert empty["n_words"] == 0 and empty["mean_word_length"] is None and empty["common_share"] is None
    assert d["mean_word_length"] == 100_000


def test_found(spark):
    table = "\n".join(f"CAB-{i};long valve;{i}.50" for i in range(20))
    bullets = "\n".join(f"- item {i} brass" for i in range(20))
    rows = [(1, PROSE), (2, table), (3, bullets), (4, None), (5, " \n\t "), (6, "4f 3e 99 0c " * 50), (7, PROSE + "\n- one\n- two"), (8, "1 2 3"), (9, table)]
    df = spark.createDataFrame([(*r, "w") for r in rows], "doc_id long, text string, words string")
    assert sorted(r.doc_id for r in Q.find_not_prose(df, "doc_id", "text", COMMON).collect()) == [2, 3, 6, 8, 9]
    assert Q.find_not_prose(df.limit(0), "doc_id", "text", COMMON).count() == 0
    assert Q.statistics(df, "doc_id", "text", []).count() == 9


def test_rules_are_learned_from_labels():
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, (3_000, 4))
    y = ((x[:, 0] < 0.2) | ((x[:, 1] > 0.7) & (x[:, 2] < 0.5))).astype(int)
    rules = Q.induce(x[:2_000], y[:2_000], ["a", "b", "c", "d"])
    found = np.zeros(1_000, bool)
    for rule in rules:
        m = np.ones(1_000, bool)
        for f, op, v in rule:
            m &= (x[2_000:, "abcd".index(f)] <= v) if op == "<=" else (x[2_000:, "abcd".index(f)] >= v)
        found |= m
    assert (found == y[2_000:]).mean() > 0.97


def test_layout_labels():
    assert layout_label(PROSE) == 0 and layout_label("- a b\n- c d\n- e f") == 1 and layout_label("a;b;c\n1;2;3\n4;5;6") == 1


def test_common_words(spark):
    words = spark.createDataFrame([("The",), ("the",), (None,)], "word string")
    assert Q.common_words(words) == ["the"]
