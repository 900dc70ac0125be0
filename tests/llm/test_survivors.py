import datetime
import random

from plumbline.llm import survivors as S
from plumbline.llm.visual_form import one_form

FIELDS = ["description", "part_description", "unit_price"]
BLANKS = ["", "n/a", "-"]
SCHEMA = "row_id long, app_number string, description string, part_description string, unit_price string, source_system string, updated_at timestamp_ntz, k string"
TRUST = {"erp": 1, "feed": 3, "dump": 6}


def brute(rows):
    import pyarrow as pa

    def form(t):
        return one_form(pa.array([t])).to_pylist()[0].strip(" \t\n\r")

    def filled(v):
        return v is not None and v.strip().lower() not in BLANKS

    groups = {}
    for r in rows:
        if r[1] is not None and form(r[1]).lower() not in BLANKS:
            groups.setdefault(form(r[1]).lower(), []).append(r)
    out = []
    for g in groups.values():
        if len(g) < 2:
            continue
        key = {}
        for r in g:
            fields = r[2:5]
            key[r[0]] = ({i for i, v in enumerate(fields) if filled(v)}, sum(len(form(v)) for v in fields[:2] if filled(v)), r[6] or datetime.datetime.min, -TRUST.get(r[5], 10**6))
        best = [i for i, k in key.items() if all(o[0] <= k[0] and o[1] <= k[1] and o[2] <= k[2] and o[3] <= k[3] for o in key.values())]
        out += [min(best)] if best else []
    return sorted(out)


def sources(spark):
    return spark.createDataFrame([*TRUST.items(), ("erp", 1)], "source_system string, trust_level int")


def survive(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(r.row_id for r in S.surviving_row(df, sources(spark), "row_id", "app_number", FIELDS, FIELDS[:2], "updated_at", "source_system", BLANKS).collect())


def test_against_brute_force(spark):
    rng = random.Random(4)
    day = datetime.datetime(2025, 1, 1)
    rows = []
    for i in range(600):
        app = rng.choice([None, "N/A", ""] + [f"A{rng.randint(1, 120)}", f" a{rng.randint(1, 120)}", f"Ａ{rng.randint(1, 120)}"])
        rows.append((i, app, rng.choice([None, "-", "ab", "ﬁb", "abc "]), rng.choice([None, "x", "xy"]), rng.choice(["1", None]), rng.choice(["erp", "feed", "other", None]), rng.choice([None, day, day + datetime.timedelta(days=1)]), "k"))
    assert survive(spark, rows) == brute(rows) != []


def test_ties_copies_and_empty(spark):
    row = ("A", "d", "p", "1", "erp", None, "k")
    assert survive(spark, [(3, *row), (2, *row), (9, "B", None, None, None, None, None, None)]) == [2]
    assert survive(spark, []) == []
    worse = (1, "A", "d", "p", "1", "feed", datetime.datetime(2025, 1, 1), "k")
    assert survive(spark, [worse, (2, *row)]) == []  # newer but less trusted: none survives


def test_built_record(spark):
    new, old = datetime.datetime(2024, 12, 31), datetime.datetime(2020, 1, 1)
    rows = [(1, "A", "good", "p", None, "erp", new, "k"), (2, " a", "bad", None, "n/a", "dump", old, "k"), (3, "A", "Bad ", "q" * 70_000, "5", "dump", old, "k"), (4, None, "x", "y", "z", "erp", new, "k"), (5, "B", None, "", None, None, None, "k")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.app_number: tuple(r)[1:] for r in S.built_record(df, sources(spark), "app_number", FIELDS, "updated_at", "source_system", BLANKS).collect()}
    assert got == {"a": ("good", "p", "5")}
    assert S.built_record(df.limit(0), sources(spark), "app_number", FIELDS, "updated_at", "source_system", BLANKS).count() == 0
