import codecs
import os

import pytest

from plumbline.plans import batch
from plumbline.plans.cleaning import ROW, Options
from plumbline.plans.reporting import report_lines
from plumbline.sources import text as X
from plumbline.sources import workbooks as W
from plumbline.streaming.arrivals import clean_arrivals


def cleaned(spark, tmp_path, text, name="in.csv", options=Options(), encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return batch.clean_file(spark, str(path), options)


def column(result, name):
    return [r[0] for r in result.display().orderBy(ROW).select(f"`{name}`").collect()]


def flags(result, issue):
    return sorted((r.column_name, r.value) for r in result.issues.where(f"issue = '{issue}'").collect())


def test_placeholders(spark, tmp_path):
    r = cleaned(spark, tmp_path, "id,note\n1,ok\n2,N/A\n3,TBD\n4,unknown\n5,-\n6,\n7,fine\n8,#N/A\n9,nan\n")
    assert column(r, "note") == ["ok", "N/A", "TBD", "unknown", "-", None, "fine", None, None]
    assert [v for _, v in flags(r, "DISGUISED")] == ["-", "N/A", "TBD", "unknown"] and len(flags(r, "MISSING")) == 3


def test_other_placeholders(spark, tmp_path):
    r = cleaned(spark, tmp_path, "id,note\n1,xx\n2,TBD\n3,N/A\n4,real\n", options=Options(blanks=["xx"]))
    assert flags(r, "DISGUISED") == [("note", "xx")] and column(r, "note") == ["xx", "TBD", None, "real"]


def test_numbers_and_dates_keep_what_fails(spark, tmp_path):
    r = cleaned(spark, tmp_path, "id,unit_price,order_date\n1,5.00,2026-04-01\n2,TBD,TBD\n3,abc,05/03/2026\n4,7,31/02/2026\n5,£8,2026-02-03\n")
    assert column(r, "unit_price") == ["5", "TBD", "abc", "7", "8"] and column(r, "order_date") == ["01/04/2026", "TBD", "05/03/2026", "31/02/2026", "03/02/2026"]
    assert flags(r, "FAILED") == [("order_date", "31/02/2026"), ("unit_price", "abc")] and r.kinds["unit_price"] == "price"


def test_key_collapse(spark, tmp_path):
    r = cleaned(spark, tmp_path, "app,description\nN/A,a\nN/A,b\nTBD,c\nTBD,d\nA1,unknown\nA1,ok\n")
    assert len(column(r, "app")) == 5 and "ok" in column(r, "description") and len(flags(r, "KEY_INVALID")) == 4 and flags(r, "KEY_DUPLICATE") == []
    plain = cleaned(spark, tmp_path, "app_number,price\nA1,1\nA2,2\nA2,3\n", "p.csv")
    assert flags(plain, "KEY_DUPLICATE") == [("app_number", "A2")] * 2


def test_flags_and_false_in_price(spark, tmp_path):
    r = cleaned(spark, tmp_path, "id,unit_price,reviewed,comment\n1,12.5,yes,a\n2,0,no,b\n3,,yes,c\n4,FALSE,yes,d\n5,3,maybe,e\n6,4,yes,f\n7,5,yes,g\n8,6,no,h\n")
    assert [v for _, v in flags(r, "PRICE")] == ["0"] and ("unit_price", "FALSE") in flags(r, "FAILED") and ("reviewed", "maybe") in flags(r, "FAILED")
    assert column(r, "reviewed")[:2] == ["Y", "N"]


def test_duplicate_columns_and_rows(spark, tmp_path):
    r = cleaned(spark, tmp_path, "id,email,Email,notes,owner\n1,A@b.c,a@b.c,x,x\n2,d@e.f,D@E.F,y,Y\n2,D@e.f,d@e.f,Y,y\n")
    assert r.columns() == ["id", "email", "email.1", "notes", "owner", "source_file"] and r.equal_columns == [("email", "email.1"), ("notes", "owner")] and column(r, "id") == ["1", "2"]
    other = cleaned(spark, tmp_path, "id,email,email\n1,a@b.c,x@b.c\n2,d@e.f,d@e.f\n", "o.csv")
    assert other.columns() == ["id", "email", "email_alt_1", "source_file"]


def test_whitespace_title_and_reserved_names(spark, tmp_path):
    r = cleaned(spark, tmp_path, "Stock report,,\nid,Full Name,Source File\n1, o'neil  ,x\n2,JOHN,y\n3,ann,z\n")
    assert column(r, "full_name") == ["O'Neil", "John", "Ann"] and "source_file_original" in r.columns() and r.stats["filler_rows_top_removed"] == 1


@pytest.mark.parametrize("encoding, detected", [("utf-8", "utf-8"), ("utf-8-sig", "utf-8-sig"), ("utf-16", "utf-16"), ("cp1252", "cp1252")])
def test_encodings(spark, tmp_path, encoding, detected):
    path = tmp_path / "e.txt"
    path.write_bytes('id;name\n1;Größe\n2;"a;b\nc"\n3;€uro\n'.encode(encoding))
    loaded = X.load_text(spark, str(path))
    assert (loaded.encoding, loaded.separator) == (detected, ";")
    assert [r["name"] for r in loaded.df.orderBy(ROW).collect()] == ["Größe", "a;b\nc", "€uro"]


HEAD = "id,name\n" + "".join(f"{i},some plain name\n" for i in range(12_000))  # longer than the sample


def test_records_past_the_head_keep_their_cells(spark, tmp_path):
    assert len(HEAD) > 4 * X.SAMPLE_CHARS or len(HEAD) > 200_000
    path = tmp_path / "w.csv"
    path.write_text(HEAD + 'x,"a,\r\nb",c,,d\ny,z\n', newline="")
    last = X.load_text(spark, str(path)).df.orderBy(ROW).collect()[-2:]
    assert [[None if v is None else v.replace("\r", "") for v in list(r)[1:]] for r in last] == [["x", "a,\nb", "c", None, "d"], ["y", "z", None, None, None]]
    path.write_text(HEAD + "x,a\rb,c\n", newline="")
    assert list(X.load_text(spark, str(path)).df.orderBy(ROW).collect()[-1])[1:] == ["x", "a\rb", "c"]


def test_rows_above_the_header_and_odd_quotes(spark, tmp_path):
    """Rows of blank cells above the header shift nothing; a header far down is found; odd quotes cost no cell."""
    path = tmp_path / "t.csv"
    path.write_text(",,\nTitle page,,\nid,name,price\n1,a,2\n,,\n2,b,3\n")
    loaded = X.load_text(spark, str(path))
    assert [tuple(r)[1:] for r in loaded.df.orderBy(ROW).collect()] == [("1", "a", "2"), ("2", "b", "3")] and loaded.header_row == 1
    path.write_text("".join(f"note {i},,\n" for i in range(900)) + "id,name,price\n" + "".join(f"{i},a,2\n" for i in range(300)))
    loaded = X.load_text(spark, str(path))
    assert loaded.df.columns[1:] == ["id", "name", "price"] and loaded.df.count() == 300 and loaded.header_row == 900
    path.write_text('id,name,price\n1,a"b,c"d\n2,"x, y",3\n3,u"v,w"z,4,5\n')
    assert [tuple(r)[1:] for r in X.load_text(spark, str(path)).df.orderBy(ROW).collect()] == [("1", 'a"b', 'c"d', None, None), ("2", "x, y", "3", None, None), ("3", 'u"v', 'w"z', "4", "5")]
    path.write_text('id,name\n1,"two\nlines"\n2,b\n')
    assert [tuple(r)[1:] for r in X.load_text(spark, str(path)).df.orderBy(ROW).collect()] == [("1", "two\nlines"), ("2", "b")]


def test_encoding_past_the_head(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_bytes(HEAD.encode() + "x,Größe €\n".encode("cp1252"))
    loaded = X.load_text(spark, str(path))
    assert loaded.encoding == "cp1252" and loaded.df.where("name = 'Größe €'").count() == 1
    path.write_bytes(codecs.BOM_UTF8 + HEAD.encode() + "x,Größe\n".encode("cp1252"))
    with pytest.raises(RuntimeError, match="e.csv"):
        X.load_text(spark, str(path))


def test_sniffing():
    assert X.marked_encoding(codecs.BOM_UTF16_BE + b"x") == "utf-16" and X.marked_encoding(b"") is None
    assert X.detect_separator("a|b|c\n1|2|3\n") == "|" and X.detect_separator("abc") == "," and X.detect_separator("a\tb;c\n") == "\t"
    assert X.find_header_row([["Title", None, None], ["id", "name", "price"], ["1", "2", "3"]]) == 1 and X.find_header_row([]) == 0
    assert X.find_header_row([["1", "2"], ["3", "4"]]) == 0
    formats = {"0.00": 2, '"GBP"#,##0.000': 3, "0.0#": None, "General": None, "0": None, "0.00%": None, "dd/mm/yyyy": None, "0.00;[Red]-0.00": 2, "[$£-809]#,##0.00": 2, "0.00E+00": None, "@": None, "#,##0": None}
    assert {f: X.fixed_decimals(f) for f in formats} == formats


def test_empty_file(spark, tmp_path):
    with pytest.raises(RuntimeError, match="in.csv"):
        cleaned(spark, tmp_path, "")


def test_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "w.xlsx")
    W.write_workbook(path, [("Cover", ["Report"], []), ("Data", ["id", "name", "ok", "x"], [(1, "=1+1", True, 2.5), (2, "b & <c>", False, None), (None, None, None, None)])])
    loaded = W.load_workbook(spark, path)
    assert loaded.sheet_name == "Data" and loaded.sheet_note
    assert [tuple(r)[1:] for r in loaded.df.orderBy(ROW).collect()] == [("1", "=1+1", "TRUE", "2.5"), ("2", "b & <c>", "FALSE", None)]
    with pytest.raises(RuntimeError, match="only .xlsx"):
        W.Workbook(str(tmp_path / "a.xls"))


def test_types_and_decimals(spark):
    df = spark.createDataFrame([("1", "1.50", "TRUE", "007", None), ("2", "3", "false", "8", None)], "a string, b string, c string, d string, e string")
    assert X.physical_types(df, df.columns) == {"a": "int", "b": "float", "c": "bool", "d": "text", "e": "blank"}
    assert [tuple(r) for r in X.number_display(df, ["b"]).collect()] == [("b", 1.5, 2)]


def test_batch_isolates_and_never_overwrites(spark, tmp_path):
    inbox, outbox = tmp_path / "in", tmp_path / "out"
    inbox.mkdir()
    (inbox / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (inbox / "b.csv").write_text("")
    done = batch.run_batch(spark, str(inbox), str(outbox), workbook=True)
    assert [(os.path.basename(p), s) for p, s, _ in done] == [("a.csv", "done"), ("b.csv", "failed")]
    again = batch.run_batch(spark, str(inbox), str(outbox))
    assert again[0][2].endswith("CLEANED (1)") and (inbox / "a.csv").exists()
    assert spark.read.parquet(done[0][2] + "/Cleaned").count() == 2


def test_stream_cleans_each_file_once(spark, tmp_path):
    inbox, outbox, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    inbox.mkdir()
    (inbox / "a.csv").write_text("id,name\n1,x\n2,y\n")
    for _ in range(2):
        clean_arrivals(spark, str(inbox), str(outbox), str(state)).awaitTermination(120)
    assert os.listdir(outbox) == ["a - CLEANED"]


def test_row_loss_guard(spark, tmp_path):
    with pytest.raises(ValueError, match="1 rows were lost"):
        cleaned(spark, tmp_path, "id,name\n1,x\n1,X\n2,y\n", options=Options(max_rows_lost=0))


def test_source_description(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_bytes(b"id\tname\n1\tx\n")
    said = X.describe_source(X.load_text(spark, str(path)))
    assert said["bytes"] == 12 and said["kind"] == "Tab-separated text" and len(said["sha256"]) == 64 and said["filler_rows"] == 0


def test_report_and_optional_modes(spark, tmp_path):
    r = cleaned(spark, tmp_path, "id,gap,note\n1,,N/A\n2,,b\n", options=Options(blanks_to_null=True, drop_blank_columns=True))
    assert r.columns() == ["id", "note", "source_file"] and column(r, "note") == [None, "b"]
    assert any("AUDIT LOG" in x for x in report_lines(r))
