import random

from plumbline.operators import quality_profile as P

SCHEMA = "load_no int, row_id int, price string, kind string, value string"


def loads(spark, odd):
    rng = random.Random(3)
    rows = []
    for load in range(1, 9):
        for i in range(300):
            price, kind = f"{rng.uniform(1, 100):.2f}", rng.choice(["a", "b", "c", None, "N/A"])
            if load == 5:
                price, kind = odd(price, kind, rng)
            rows.append((load, load * 1000 + i, price, kind, f"text {rng.randint(1, 500)}"))
    return spark.createDataFrame(rows, SCHEMA)


def changed(spark, odd):
    return sorted(tuple(r) for r in P.changed_columns(loads(spark, odd), "load_no", ["price", "kind", "value"]).collect())


def test_nothing_changed(spark):
    assert changed(spark, lambda p, k, r: (p, k)) == []


def test_missing_scale_and_writing(spark):
    assert changed(spark, lambda p, k, r: (None if r.random() < 0.4 else p, k)) == [(5, "price")]
    assert changed(spark, lambda p, k, r: (f"{float(p) * 100:.2f}", k)) == [(5, "price")]
    assert changed(spark, lambda p, k, r: ("EUR " + p.replace(".", ","), "c" if r.random() < 0.6 else k)) == [(5, "kind"), (5, "price")]


def test_form_of_long_texts_is_seen_whole(spark):
    """Changes past the first 16 characters of the form, in texts that are all distinct and hardly longer for it."""
    rng = random.Random(5)
    words = ["Steel", "bolt", "M8", "zinc", "plated", "Hex", "nut", "A2", "washer", "grade", "10", "Flat"]
    text = [[" ".join(rng.choice(words) for _ in range(14)) + f" item {load * 1000 + i}" for i in range(400)] for load in range(8)]

    def changed_by(change):
        rows = [(load, i, change(t) if load == 5 and i % 10 < 4 else t, None, None) for load, ts in enumerate(text) for i, t in enumerate(ts)]
        return [tuple(r) for r in P.changed_columns(spark.createDataFrame(rows, SCHEMA), "load_no", ["price"]).collect()]

    assert changed_by(lambda t: t) == []
    middle = lambda t: t[:40] + t[40:].replace(" ", " - ", 1)
    for change in (lambda t: t + ", V2", lambda t: t + " ", lambda t: t + ".", lambda t: t[:40] + t[40:].upper(), middle):
        assert changed_by(change) == [(5, "price")]


def test_long_numbers_have_magnitudes(spark):
    rows = [(1, i, v, None, None) for i, v in enumerate(["£ (7.5)" + " " * 60, "9", "0" * 50 + "8", "7 mm", "e" * 50])]
    bins = P.histograms(spark.createDataFrame(rows, SCHEMA), "load_no", ["price"], None, P.DISGUISED_BLANKS).where("kind = 'number'")
    assert sorted((r.bin, r.n) for r in bins.collect()) == [("+4", 3)]


def test_profile(spark):
    rows = [(1, 1, "5", "x", None), (1, 2, "5", " n/a ", ""), (1, 3, "-2.50", None, "é"), (None, 4, "7", "y", "z"), (2, 5, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.load_no, r.column_name): r for r in P.profile(df, "load_no", ["price", "kind", "value"]).collect()}
    assert len(got) == 9
    r = got[1, "price"]
    assert (r.n_rows, r.n_missing, r.n_placeholder, r.n_distinct, r.min_number, r.max_number, r.top_value, r.top_count, r.min_length, r.max_length) == (3, 0, 0, 2, -2.5, 5.0, "5", 2, 1, 5)
    r = got[1, "kind"]
    assert (r.n_missing, r.n_placeholder, r.n_distinct) == (1, 1, 1)
    assert got[2, "value"].n_distinct == 0 and got[2, "value"].top_value is None and got[None, "price"].n_rows == 1


def test_masks(spark):
    df = spark.createDataFrame([(1, 1, "5", "x", "a")] * 4, SCHEMA)
    masks = spark.createDataFrame([(1, 1, "price", True, False)], "row_id int, load_no int, column_name string, fail_mask boolean, price_review_mask boolean")
    r = P.profile(df, "load_no", ["price"], masks).first()
    assert (r.n_failed, r.n_review) == (1, 0)


def test_empty_and_single(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert P.profile(df, "load_no", ["price"]).count() == 0 and P.changed_columns(df, "load_no", ["price"]).count() == 0
    one = spark.createDataFrame([(1, i, str(i), "x" * 50_000, None) for i in range(20)], SCHEMA)
    assert P.changed_columns(one, "load_no", ["price", "kind", "value"]).count() == 0
