import random

import numpy as np

from plumbline.llm import leakage as L

rng = random.Random(11)
VOCABULARY = [f"w{i}" for i in range(400)]
ITEMS = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(60))) for i in range(1, 9)] + [(20, "too short"), (21, None), (22, "")]


def test_index_finds_what_a_scan_finds():
    r = np.random.default_rng(2)
    text = np.concatenate([r.integers(1, 9, 3_000), [0]]).astype(np.int64)
    index = L.ShardIndex(text, 9)
    phrases = np.array([text[i : i + 4] for i in range(0, 2_900, 37)] + [[8, 8, 8, 8], [1, 2, 3, 4]])
    lo, hi = index.search(phrases)
    for p, a, b in zip(phrases, lo, hi):
        wanted = [i for i in range(len(text) - 4) if (text[i : i + 4] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted


def test_suffix_order():
    r = np.random.default_rng(5)
    for text in ([0], [1, 0], [2, 1, 2, 1, 2, 0], [1] * 50 + [0], [*r.integers(1, 3, 300), 0], [*np.tile(r.integers(1, 2000, 40), 9), 0], [*r.integers(1, 1 << 40, 60), 0]):
        a = np.array(text, np.int64)
        assert L.suffix_order(a).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def filler(n):
    return " ".join(rng.choice(["alpha", "beta", "w1", "gamma", "w2"]) for _ in range(n))


def edited(words, changes):
    out = list(words)
    for at in rng.sample(range(1, len(out) - 1), changes):
        kind = rng.randrange(3)
        out[at] = {0: "changed", 1: "", 2: out[at] + " added"}[kind]
    return " ".join(out)


def found(spark, docs, items=ITEMS):
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted({(r.doc_id, r.item_id) for r in L.passages(df, "doc_id", "text", bench, "item_id", "text").collect()})


def test_planted_passages(spark):
    docs, wanted = [(900, None), (901, ""), (902, filler(400))], []
    for n in range(1, 81):
        item = rng.randrange(8)
        words = ITEMS[item][1].split()
        length = rng.choice([10, 15, 22, 30, 45, 60])
        start = rng.randint(0, 60 - length)
        changes = rng.choice([0, 1, length // 10]) if length > 15 else 0
        passage = edited(words[start : start + length], changes)
        style = rng.choice([str.upper, lambda t: t.replace(" ", "\n"), lambda t: t.replace("w", "ｗ"), lambda t: t.replace(" ", ", "), str])
        docs.append((n, f"{filler(30)} {style(passage)} {filler(20)}"))
        wanted += [(n, item + 1)] if length > 15 else []
    assert found(spark, docs) == sorted(wanted)


def test_repeats_long_and_empty(spark):
    text = ITEMS[0][1]
    assert found(spark, [(1, text), (2, text), (3, filler(60_000) + " " + text)]) == [(1, 1), (2, 1), (3, 1)]
    assert found(spark, [(1, text)], [(5, text), (6, text)]) == [(1, 5), (1, 6)]
    assert found(spark, [(1, text)], [(7, None)]) == []
    assert found(spark, [(1, "alpha")], ITEMS) == []


def test_blocks_of_items(spark, monkeypatch):
    docs = [(i, t) for i, t in ITEMS[:8]]
    monkeypatch.setattr(L, "WORDS_PER_BLOCK", 150)
    assert found(spark, docs) == [(i, i) for i in range(1, 9)]


def test_several_passages_near_one_diagonal(spark):
    item = [f"w{i}" for i in range(80)]
    text = " ".join([*item[:25], *[f"other{i}" for i in range(25)], *item[50:]])
    df, bench = spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item)), (8, " ".join(item[5:40]))], "item_id long, text string")
    got = L.passages(df, "doc_id", "text", bench, "item_id", "text")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 7, 25, 0, 0, 24), (1, 7, 30, 0, 50, 79), (1, 8, 20, 0, 5, 24)]
    assert sorted(tuple(r) for r in L.removal_spans(got).collect()) == [(1, 0, 24), (1, 50, 79)]


def test_passage_beside_a_better_path_that_holds_none():
    item = list(range(2, 167))
    poor = [1 if i % 5 == 4 else x for i, x in enumerate(item[:80])]
    assert L.align(item, poor + [1] * 60 + item[140:], 0) == [(25, 0, 140, 164)]
    assert L.align(item, poor + [1] * 60, 0) == []


def test_removal_spans_are_merged(spark):
    rows = [(1, 0, 20), (1, 5, 9), (1, 15, 40), (1, 41, 60), (1, 62, 90), (2, 3, 30)]
    got = L.removal_spans(spark.createDataFrame(rows, "doc_id long, first_word int, last_word int"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 60), (1, 62, 90), (2, 3, 30)]
