import itertools
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import failed_rows as R

NAMES = ("app_number", "description", "quantity", "order_date", "is_active")


def read(text, sep=","):
    return R.read_record(text, sep, NAMES)


@pytest.mark.parametrize("text", ["A,b,1,2026-01-02,Y", 'A,"b, c",1,,N', 'A,"b ""x"" y","1,000",5 March 2026,1.0', 'A,"two\nlines",(5),TBD,unknown', "A,,,,", 'A,"",N/A,31/12/2025,off'])
def test_valid(text):
    kind, values, reason, cost = read(text)
    assert kind == "loaded" and len(values) == 5 and reason is None and cost == 0


@pytest.mark.parametrize(
    "text, said",
    [
        ("A,b,1,2026-01-02", "4 fields instead of 5: put in a separator"), ("A,b,c,1,2026-01-02,Y", "6 fields instead of 5: take out a separator"), ('A,"b,1,2026-01-02,Y', "quote never closed"),
        ('A,"b" c,1,2026-01-02,Y', "text after a closing quote"), ('A,b"c,1,2026-01-02,Y', "quote inside an unquoted field: take out a quote"), ("A,b,x,2026-01-02,Y", "invalid value in quantity"),
        ("A,b,1,31/02/2026,Y", "invalid value in order_date"), ("A,b,1,2026-01-02,maybe", "invalid value in is_active"), ("A", "1 fields instead of 5"),
    ],
)
def test_failed(text, said):
    kind, _, reason, cost = read(text)
    assert kind == "failed" and reason.startswith(said) and cost > 0


def test_no_cases():
    for text in (None, "", " ", ",,,,", '"",,'):
        assert read(text)[0] == "blank"
    assert read("App No,Description,QUANTITY,Order Date,Is Active")[0] == "header"


def test_cheapest_parse_against_all_cuts():
    """On records without quotes, the cost is the least over all ways to merge pieces into fields and leave fields empty."""
    tests = ["number", None, "number"]

    def brute(text):
        pieces, best = text.split(","), float("inf")
        for cuts in itertools.combinations_with_replacement(range(len(pieces) + 1), 2):
            a, b = cuts
            parts = [pieces[:a], pieces[a:b], pieces[b:]]
            cost = sum(1.0 if not p else len(p) - 1.0 for p in parts) + sum(1.5 for p, t in zip(parts, tests) if p and not R.fits(",".join(p), t))
            best = min(best, cost)
        return best

    for text in ("1,a,2", "1,a", "a,1,2", "1,2", "1,a,b,2", "x,y,z,1,2", "1", "1,a,b,c,d", "", "1,2,3,4"):
        assert R.cheapest_parse(text, ",", tests)[0] == brute(text), text


def test_long_and_hostile():
    assert R.read_record("x" * 100_000, ",", NAMES)[0] == "failed"
    assert R.read_record("," * 5_000 + "x", ",", NAMES)[2].startswith("5001 fields")
    assert R.read_record('"' * 999, ",", NAMES)[0] == "failed"


def layouts(spark, files):
    rows = [(f, i, t) for f, lines in files.items() for i, t in enumerate(lines)]
    df = spark.createDataFrame(rows, "file_id long, record_no int, record_text string")
    return {r.file_id: (r.sep, r.header_no, r.names) for r in R.layouts(df, "file_id", "record_no", "record_text").collect()}


def test_layouts(spark):
    files = {
        1: ["Report run weekly", "Stock;;;", "App No;Description;Qty;Weight", "A;b;1;2"], 2: ["", "1|2", "3|4"], 3: [None],
        4: [f"filler {i}" for i in range(100)] + ["App No,Description,Quantity"] + ['A,"b, c",1'] * 150,  # the header is far down
    }
    assert layouts(spark, files) == {1: (";", 2, ["app_number", "description", "qty", "weight"]), 2: ("|", 1, ["1", "2"]), 3: (",", 0, [""]), 4: (",", 100, ["app_number", "description", "quantity"])}
    assert layouts(spark, {}) == {}


def test_plain_fields_are_the_strict_ones(spark):
    texts = [",".join(p) for p in itertools.product(["", "a", '""', '"a"', '"a,b"', '"a""b"', 'a"b', '"""a"', '"a"""', '"', '""""', 'a""b'], repeat=2)] + ["", "x\ny", '"x\ny",z', "\x01,b", '"\x02",b']
    for sep in R.SEPARATORS:
        df = spark.createDataFrame([(t.replace(",", sep), sep) for t in texts], "t string, s string")
        for r in df.select("t", R.plain_fields(F.col("t"), F.col("s")).alias("f")).collect():
            strict = R.split_strict(r.t, sep)[0]
            assert r.f == strict or (r.f is None and strict is not None and any(x in r.t for x in ('""', "\x01", "\x02"))), r


def test_expressions_load_what_the_parse_loads(spark):
    rng = random.Random(6)
    cell = lambda: rng.choice(["", "A", '"b, c"', "5", "(1,5)", "£2.50", '"1,234.5"', "x", "31/12/2025", "31/02/2025", "5 March 2026", "Y", "maybe", "N/A", 'q"', '"open'])
    lines = ["app_number,description,quantity,order_date,is_active"] + [",".join(cell() for _ in range(rng.choice([4, 5, 5, 5, 5, 6]))) for _ in range(1500)] + ["APP NO,Description,Quantity,Order Date,Is Active", "x" * 50_000]
    df = spark.createDataFrame([(i, 1, i, t) for i, t in enumerate(lines)], "record_id long, file_id long, record_no int, record_text string")
    got = {r.record_id: (r.kind, r["values"], r.reason, r.cost) for r in R.read_records(df).collect()}
    assert got == {i: read(t) for i, t in enumerate(lines) if i}
    assert {r.record_id: (r.reason, r.cost) for r in R.rejected(df).collect()} == {i: g[2:] for i, g in got.items() if g[0] == "failed"}
    strict = {i for i, t in enumerate(lines) if i and (v := R.split_strict(t, ",")[0]) and len(v) == 5 and all(R.fits(x, R.COLUMN_TESTS.get(n)) for n, x in zip(NAMES, v)) and any(x.strip() for x in v) and R.column_name(v[1]) != "description"}
    assert {i for i, g in got.items() if g[0] == "loaded"} == strict  # cost zero is what a strict reader takes


def test_wide_records_are_parsed(spark):
    names = tuple(f"c{i}" for i in range(299)) + ("quantity",)
    kind, values, reason, cost = R.read_record(",".join(["v"] * 299 + ["x"]), ",", names)
    assert (kind, cost, len(values)) == ("failed", 1.5, 300) and reason.endswith("value 'x' does not fit column 300")
    assert R.read_record(",".join(["v"] * 300 + ["5"]), ",", names)[3] == 1.0


def test_tables(spark):
    lines = ["Stock list", "App No;Description;Quantity", "A;b;1", "A;b;1", "", "App No;Description;Quantity", "B;c", 'C;"d;e";2', "D;f;x", None]
    rows = [(100 * f + i, f, i, t, "extra") for f in (1, 2) for i, t in enumerate(lines)] + [(999, None, 0, "A;b;c", "z"), (998, 1, None, "A;b;c", "z")]
    df = spark.createDataFrame(rows, "record_id long, file_id long, record_no int, record_text string, kind string")
    read_all = R.read_records(df)
    assert sorted(r.record_id for r in R.failed(read_all, "record_id").collect()) == [106, 108, 206, 208]
    good = sorted(tuple(r) for r in R.loaded(read_all, "record_id", ["app_number", "description", "quantity", "weight"]).collect())
    assert good == [(i + f, a, d, q, None) for f in (100, 200) for i, a, d, q in ((2, "A", "b", "1"), (3, "A", "b", "1"), (7, "C", "d;e", "2"))]
    assert R.read_records(df.limit(0)).count() == 0
