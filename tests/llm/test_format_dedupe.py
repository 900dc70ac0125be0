import random

from plumbline.llm import format_dedupe as D

SCHEMA = "listing_id long, app_number string, description string, k string, u string"


def pairs(spark, rows):
    df = spark.createDataFrame([(*r, "k", "u") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in D.copies(df, "listing_id", ["app_number", "description"]).collect())


def test_writings(spark):
    rows = [
        (1, "CAB/0488/45819", "quick spring; bay F21; pack 50; 3.1 mm thick"), (2, "cab048845819", "Bay F21|(Quick  Spring)|3.1mm thick|PACK 50 !"), (3, "BAY F21, 3.1 MM THICK, PACK 50, QUICK\tSPRING.", "#cab-0488-45819"),
        (4, "CAB/0488/45819", "quick spring bay F21 pack 50 3.1 mm thick"), (5, "CAB/0488/45819", "quick spring; bay F21; pack 50; 31 mm thick"), (6, "CAB/0488/45819", "spring quick; bay F21; pack 50; 3.1 mm thick"),
        (7, "CAB/0488/45819", "bay F21 quick spring pack 50 3.1 mm thick"), (8, "CAB/0488/45819", "quick spring; bay F21; pack 50"), (9, None, None), (10, "", " - "), (11, "CAB/0488/45819", "quick spring; bay F21; pack 50; 3.1 mm thick"),
    ]
    assert pairs(spark, rows) == [(1, 2), (1, 3), (1, 4), (1, 11)]


def test_unseparated_alone_and_empty(spark):
    assert pairs(spark, [(5, "A", "one two"), (6, "a", "ONE  two."), (7, "a", "two one")]) == [(5, 6)]
    assert pairs(spark, []) == []
    assert pairs(spark, [(1, "A", "x" * 100_000), (2, "a", "X" * 100_000)]) == [(1, 2)]


def test_random_against_brute_force(spark):
    rng = random.Random(8)
    parts = ["red", "blue", "m8 x 5", "1.5 mm", "15 mm", "w-12"]
    records, rows = {}, []
    for i in range(1, 400):
        fields = rng.sample(parts, rng.randint(2, 3))
        app = rng.choice(["A-1", "B-2"])
        text = rng.choice(["; ", " | ", ";", " / "]).join(rng.choice([f, f.upper(), f"({f})", f.replace("-", " ")]) for f in fields)
        swap = rng.random() < 0.3
        rows.append((i, text if swap else app, app if swap else text))
        records.setdefault((app, frozenset(f.replace(" ", "").replace("-", "") for f in fields)), []).append(i)
    wanted = sorted((min(g), x) for g in records.values() for x in g if x != min(g))
    assert pairs(spark, rows) == wanted
    df = spark.createDataFrame([(*r, "k", "u") for r in rows], SCHEMA)
    got = {r.listing_id: r.n_copies for r in D.collapse(df, "listing_id", ["app_number", "description"]).collect()}
    assert got == {min(g): len(g) for g in records.values()}


def test_fields_that_share_a_hash_are_told_apart(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("aa",), ("ab",), ("b",), ("aa",)], "field string")
    codes = D.coder(df, lambda c: F.xxhash64(F.substring(c, 1, 1)))
    got = {r.field: tuple(r.t) for r in df.select("field", codes(F.array("field")).alias("t")).collect()}
    assert len(set(got.values())) == 3 and got["aa"][0] == got["ab"][0] and len(got["b"]) == 1
