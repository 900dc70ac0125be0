"""Queries for the cleaning operators, each over whole tables, with the same thing in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import CATEGORY_MAPPINGS, DISGUISED_BLANKS, FALSE_WORDS, TRUE_WORDS, WHITESPACE
from plumbline.functions import names as N
from plumbline.functions import values as V
from plumbline.functions.blanks import is_placeholder, strip
from plumbline.operators import columns as C
from plumbline.operators import failed_rows, issues, rows
from plumbline.operators import typing as Ty
from plumbline.plans import cleaning, reporting
from plumbline.sources import text as text_source
from plumbline.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

RECORD_COLUMNS = ["app_number", "description", "part_description", "unit_price", "quantity", "country", "status", "order_date", "other_id"]


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


# SQL fragments --------------------------------------------------------------------------------------------------------
_WS = "(" + "||".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"
_BLANKS = "(" + ",".join(f"'{w}'" for w in DISGUISED_BLANKS) + ")"
_NUMBER = V.NUMBER


def _strip(c: str) -> str:
    return f"trim({c}, {_WS})"


def _blank(c: str) -> str:
    return f"coalesce(lower({_strip(c)}) IN {_BLANKS}, false)"


def _filled(c: str) -> str:
    return f"NOT coalesce(lower({_strip(c)}) IN {_BLANKS}, true)"


def _money(column: str, source: str, keep: str) -> str:
    """A subquery with ``keep`` columns, ``v`` (the text) and ``num`` (the number or null)."""
    return f"""(SELECT {keep}, v, CASE WHEN regexp_matches({_strip('s3')}, '{_NUMBER}') THEN try_cast({_strip('s3')} AS DOUBLE) END AS num FROM (
      SELECT *, CASE WHEN comma > 0 AND point > 0 THEN CASE WHEN comma < point THEN replace(replace(s2, '.', ''), ',', '.') ELSE replace(s2, ',', '') END
        WHEN comma > 0 THEN CASE WHEN regexp_matches(s2, '^[^,]*,[^,][^,]$') THEN replace(s2, ',', '.') WHEN regexp_matches(s2, '^[^,]*(,[^,][^,][^,])+$') THEN replace(s2, ',', '') ELSE s2 END ELSE s2 END AS s3
      FROM (SELECT *, instr(reverse(s2), ',') AS comma, instr(reverse(s2), '.') AS point FROM (
        SELECT *, regexp_replace(translate(s1, '−–—', '---'), '[£$€¥]', '', 'g') AS s2 FROM (
          SELECT *, CASE WHEN s0 LIKE '(%)' AND length(s0) > 1 THEN '-' || {_strip('substr(s0, 2, length(s0) - 2)')} WHEN s0 LIKE '%-' AND s0 NOT LIKE '-%' THEN '-' || {_strip('substr(s0, 1, length(s0) - 1)')} ELSE s0 END AS s1
          FROM (SELECT *, {column} AS v, {_strip(column)} AS s0 FROM {source}))))))"""


def _date(c: str) -> str:
    """The styles of dates, written out by hand for DuckDB, whose patterns have no back references."""
    time = r"(?:[tT\s]+(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?\s*(?:[zZ]|[+-][0-9]{2}:?[0-9]{2}|[aApP][mM])?)?$"
    weekday = r"(?i)^(?:(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?,?\s+)?"
    month = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?"
    date = lambda y, m, d: f"try_cast(CASE WHEN length({y}) = 4 THEN {y} WHEN {y} < '69' THEN '20' || {y} ELSE '19' || {y} END || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"
    part = lambda p, i: f"regexp_extract({c}, '{p}', {i})"
    named = lambda p, i: f"CAST(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower({part(p, i)})) AS VARCHAR)"
    cases = []
    for s in ("-", "/", "[.]"):
        p = f"^([0-9]{{4}}){s}([0-9]{{1,2}}){s}([0-9]{{1,2}}){time}"
        cases.append((p, date(part(p, 1), part(p, 2), part(p, 3))))
    p = "^((?:1[6-9]|2[01])[0-9]{2})([0-9]{2})([0-9]{2})$"
    cases.append((p, date(part(p, 1), part(p, 2), part(p, 3))))
    for s in ("-", "/", "[.]", " "):
        p = f"^([0-9]{{1,2}}){s}([0-9]{{1,2}}){s}([0-9]{{4}}|[0-9]{{2}}){time}"
        cases.append((p, f"coalesce({date(part(p, 3), part(p, 2), part(p, 1))}, {date(part(p, 3), part(p, 1), part(p, 2))})"))
    p = rf"{weekday}([0-9]{{1,2}})(?:st|nd|rd|th)?[-\s./]+{month}\.?,?[-\s./]+([0-9]{{4}}|[0-9]{{2}}){time}"
    cases.append((p, date(part(p, 3), named(p, 2), part(p, 1))))
    p = rf"{weekday}{month}\.?[-\s]+([0-9]{{1,2}})(?:st|nd|rd|th)?,?[-\s]+([0-9]{{4}}|[0-9]{{2}}){time}"
    cases.append((p, date(part(p, 3), named(p, 1), part(p, 2))))
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN {v}" for p, v in cases) + " END"


def _mapping(c: str, mapping: dict[str, str]) -> str:
    return f"CASE {' '.join(f'''WHEN lower({_strip(c)}) = '{k}' THEN '{v}' ''' for k, v in mapping.items())} ELSE {c} END"


def _words(words: tuple[str, ...]) -> str:
    return "(" + ",".join(f"'{w}'" for w in words) + ")"


def _title(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '([\\p{{L}}]+|[^\\p{{L}}]+)'), lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), '')"


_KEY = f"regexp_replace(lower({_strip('v')}), '^([01])\\.0+$', '\\1')"


# Values ---------------------------------------------------------------------------------------------------------------
@_query(f"SELECT row_id, {_strip('app_number')} AS app_number, {_strip('description')} AS description, {_strip('part_description')} AS part_description FROM app_records")
def trim_whitespace(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", *[strip(F.col(c)).alias(c) for c in ("app_number", "description", "part_description")])


_PUNCTUATION = reduce(lambda s, p: f"replace({s}, chr({p[0]}), '{p[1]}')", [(0x2026, "..."), (0xFEFF, ""), (0xA0, " "), (0x2018, "''"), (0x2019, "''"), (0x201C, '"'), (0x201D, '"'), (0x2013, "-"), (0x2014, "-")], "text")


@_query(f"SELECT doc_id, {_PUNCTUATION} AS text FROM documents")
def plain_punctuation(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", V.plain_punctuation(F.col("text")).alias("text"))


@_query()
def encoding_repair(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", V.fix_encoding(F.col("text")).alias("text"))


#: Phone numbers in several writings, the same in both dialects.
_PHONES = """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '+44 ' || CAST(7000000000 + c_custkey AS VARCHAR(20)) WHEN 1 THEN '0044-' || CAST(7000000000 + c_custkey AS VARCHAR(20)) WHEN 2 THEN CAST(7000000000 + c_custkey AS VARCHAR(20))
  WHEN 3 THEN '(020) ' || CAST(70000000 + c_custkey AS VARCHAR(20)) WHEN 4 THEN 'call office' WHEN 5 THEN '020.' || CAST(70000000 + c_custkey AS VARCHAR(20)) END AS phone FROM {customer}"""


@_query(f"""SELECT c_custkey, CASE WHEN regexp_matches(phone, '{V.PHONE_LIKE}') THEN CASE WHEN length(n2) = 10 AND n2 LIKE '7%' THEN '0' || n2 ELSE n2 END ELSE phone END AS phone FROM (
  SELECT *, CASE WHEN n1 LIKE '44%' THEN '0' || substr(n1, 3) ELSE n1 END AS n2 FROM (SELECT *, CASE WHEN n0 LIKE '0044%' THEN substr(n0, 3) ELSE n0 END AS n1 FROM (
  SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS n0 FROM ({_PHONES.format(customer='customer')}))))""")
def phone_normalise(spark: SparkSession, d: str) -> DataFrame:
    messy = spark.sql(_PHONES.format(customer=f"parquet.`{d}/customer.parquet`"))
    return messy.select("c_custkey", V.phone_digits(F.col("phone")).alias("phone"))


@_query(f"SELECT row_id, {_title('country')} AS country, {_title('status')} AS status FROM app_records")
def title_case(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", V.title_case(F.col("country")).alias("country"), V.title_case(F.col("status")).alias("status"))


@_query(f"SELECT row_id, {_mapping('country', CATEGORY_MAPPINGS['country'])} AS country, {_mapping('status', CATEGORY_MAPPINGS['status'])} AS status FROM app_records")
def category_mapping(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", *[V.map_category(F.col(c), CATEGORY_MAPPINGS[c]).alias(c) for c in ("country", "status")])


@_query(f"SELECT row_id, v AS unit_price, num AS price FROM {_money('unit_price', 'app_records', 'row_id')}")
def currency_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", "unit_price", V.to_money(F.col("unit_price")).alias("price"))


@_query(f"SELECT row_id, num AS quantity FROM {_money('quantity', 'app_records', 'row_id')}")
def measure_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", V.to_money(F.col("quantity")).alias("quantity"))


_PERCENT = "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'abc%' WHEN 1 THEN CAST(CAST(l_discount * 100 AS DECIMAL(10,2)) AS VARCHAR(20)) || '%' WHEN 2 THEN ' ' || CAST(CAST(l_discount * 100 AS DECIMAL(10,2)) AS VARCHAR(20)) || ' % ' ELSE '1,' || CAST(CAST(l_discount AS DECIMAL(10,2)) AS VARCHAR(20)) || '%' END AS v FROM {lineitem}"


@_query(f"SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches({_strip('replace(v, chr(37), chr(0)||chr(0))').replace('chr(0)||chr(0)', chr(39) * 2)}, '{_NUMBER}') THEN try_cast({_strip('replace(v, chr(37), chr(0))').replace('chr(0)', chr(39) * 2)} AS DOUBLE) END AS percentage FROM ({_PERCENT.format(lineitem='lineitem')})")
def percentage_parse(spark: SparkSession, d: str) -> DataFrame:
    messy = spark.sql(_PERCENT.format(lineitem=f"parquet.`{d}/lineitem.parquet`"))
    return messy.select("l_orderkey", "l_linenumber", V.to_percentage(F.col("v")).alias("percentage"))


_FLAGS = "SELECT o_orderkey, CASE o_orderkey % 11 WHEN 0 THEN 'Y' WHEN 1 THEN ' yes ' WHEN 2 THEN 'TRUE' WHEN 3 THEN '1' WHEN 4 THEN '0.0' WHEN 5 THEN 'off' WHEN 6 THEN 'Inactive' WHEN 7 THEN 'maybe' WHEN 8 THEN 'N' WHEN 9 THEN 'enabled' END AS v FROM {orders}"


@_query(f"SELECT o_orderkey, CASE WHEN {_KEY} IN {_words(TRUE_WORDS)} THEN 'Y' WHEN {_KEY} IN {_words(FALSE_WORDS)} THEN 'N' END AS flag FROM ({_FLAGS.format(orders='orders')})")
def flag_to_yn(spark: SparkSession, d: str) -> DataFrame:
    messy = spark.sql(_FLAGS.format(orders=f"parquet.`{d}/orders.parquet`"))
    return messy.select("o_orderkey", V.to_flag(F.col("v")).alias("flag"))


@_query(f"SELECT row_id, strftime({_date('s')}, '%d/%m/%Y') AS order_date FROM (SELECT row_id, {_strip('order_date')} AS s FROM app_records)")
def date_uk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", V.date_text(V.to_date_uk(F.col("order_date"))).alias("order_date"))


_SCALED = "CASE WHEN o_orderkey % 5 = 0 THEN floor(o_totalprice) WHEN o_orderkey % 5 = 1 THEN o_totalprice * 1000 WHEN o_orderkey % 5 = 2 THEN o_totalprice / 1048576 / 1024 WHEN o_orderkey % 5 = 3 THEN -o_totalprice * 1048576 * 1048576 ELSE o_totalprice END"


@_query(f"SELECT o_orderkey, CASE WHEN x = floor(x) AND abs(x) < 1e16 THEN CAST(CAST(x AS DECIMAL(38,0)) AS VARCHAR) ELSE CAST(x AS VARCHAR) END AS price_text FROM (SELECT o_orderkey, {_SCALED} AS x FROM orders)")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", V.number_text(F.expr(_SCALED).cast("double")).alias("price_text"))


_DECIMALS = f"""SELECT column_name, number, max(decimals) AS decimals FROM (
  SELECT column_name, try_cast(replace(v, ',', '') AS DOUBLE) AS number, length(regexp_extract(v, '\\.([0-9]+)$', 1)) AS decimals, length(regexp_extract(regexp_replace(v, '(\\.[0-9]*?)0+$', '\\1'), '\\.([0-9]+)$', 1)) AS needed
  FROM (SELECT 'unit_price' AS column_name, trim(unit_price) AS v FROM app_records UNION ALL SELECT 'quantity', trim(quantity) FROM app_records) WHERE regexp_matches(v, '^[+-]?([0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+)(\\.[0-9]+)?$'))
GROUP BY column_name, number HAVING max(decimals) > max(needed)"""


@_query(_DECIMALS)
def number_display(spark: SparkSession, d: str) -> DataFrame:
    return text_source.number_display(table(spark, d, "app_records"), ["unit_price", "quantity"])


# Cells ----------------------------------------------------------------------------------------------------------------
def _per_column(test: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT row_id, '{c}' AS column_name FROM app_records WHERE {test.format(c=c, blank=_blank(c))}" for c in columns)


@_query(_per_column("{blank}", RECORD_COLUMNS[1:]))
def placeholder_mask(spark: SparkSession, d: str) -> DataFrame:
    cells = [F.when(is_placeholder(F.col(c)), F.lit(c)) for c in RECORD_COLUMNS[1:]]
    return table(spark, d, "app_records").select("row_id", F.explode(F.array_compact(F.array(*cells))).alias("column_name"))


@_query(_per_column("{c} IS NULL", RECORD_COLUMNS))
def missing_mask(spark: SparkSession, d: str) -> DataFrame:
    cells = [F.when(F.col(c).isNull(), F.lit(c)) for c in RECORD_COLUMNS]
    return table(spark, d, "app_records").select("row_id", F.explode(F.array_compact(F.array(*cells))).alias("column_name"))


@_query("SELECT count(*) FILTER (WHERE n > 0) AS rows_with_missing, CAST(sum(n) AS BIGINT) AS missing_cells FROM (SELECT " + " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in RECORD_COLUMNS) + " AS n FROM app_records)")
def missing_summary(spark: SparkSession, d: str) -> DataFrame:
    n = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in RECORD_COLUMNS])
    return table(spark, d, "app_records").select(n.alias("n")).agg(F.count_if(F.col("n") > 0).alias("rows_with_missing"), F.sum("n").alias("missing_cells"))


@_query(f"SELECT row_id, v AS unit_price FROM {_money('unit_price', 'app_records', 'row_id')} WHERE v IS NOT NULL AND num IS NULL AND NOT {_blank('v')}")
def failed_conversion_mask(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("unit_price")
    return table(spark, d, "app_records").where(V.failed(c, V.to_money(c))).select("row_id", "unit_price")


@_query(f"SELECT row_id, s AS order_date FROM (SELECT row_id, order_date, {_strip('order_date')} AS s FROM app_records) WHERE order_date IS NOT NULL AND NOT {_blank('order_date')} AND ({_date('s')}) IS NULL")
def failed_date_mask(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("order_date")
    return table(spark, d, "app_records").where(V.failed(c, V.to_date_uk(c))).select("row_id", strip(c).alias("order_date"))


_PRICES = f"""WITH p AS (SELECT row_id, v, coalesce(lower({_strip('v')}) IN ('true','false'), false) AS is_bool, num FROM {_money('unit_price', 'app_records', 'row_id')}),
 q AS (SELECT *, CASE WHEN NOT is_bool THEN num END AS n FROM p), t AS (SELECT count(n) AS numbers, count(v) AS present FROM q)
SELECT row_id, v AS unit_price FROM q, t WHERE numbers > 0 AND (coalesce(n <= 0, false) OR (numbers * 2 >= present AND v IS NOT NULL AND n IS NULL AND NOT is_bool AND NOT {_blank('v')}))"""


@_query(_PRICES)
def price_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return issues.price_anomalies(table(spark, d, "app_records"), "unit_price", "row_id")


@_query(f"SELECT row_id, k AS app_number FROM (SELECT row_id, {_strip('app_number')} AS k, count(*) OVER (PARTITION BY {_strip('app_number')}) AS c FROM app_records WHERE {_filled('app_number')}) WHERE c > 1")
def key_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return issues.duplicate_keys(table(spark, d, "app_records"), "app_number", "row_id")


@_query(f"SELECT row_id, app_number FROM app_records WHERE NOT ({_filled('app_number')})")
def key_invalid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").where(issues.key_invalid(F.col("app_number"))).select("row_id", "app_number")


_ISSUES = f"""{_PRICES.split(chr(10) + "SELECT row_id, v AS")[0]}, price AS (SELECT row_id, v FROM q, t WHERE numbers > 0 AND (coalesce(n <= 0, false) OR (numbers * 2 >= present AND v IS NOT NULL AND n IS NULL AND NOT is_bool AND NOT {_blank('v')})))
SELECT row_id, 'app_number' AS column_name, 'KEY_INVALID' AS issue, app_number AS value FROM app_records WHERE NOT ({_filled('app_number')})
UNION ALL SELECT row_id, 'app_number', 'KEY_DUPLICATE', k FROM (SELECT row_id, {_strip('app_number')} AS k, count(*) OVER (PARTITION BY {_strip('app_number')}) AS c FROM app_records WHERE {_filled('app_number')}) WHERE c > 1
UNION ALL SELECT row_id, 'description', 'MISSING', description FROM app_records WHERE description IS NULL
UNION ALL SELECT row_id, 'description', 'DISGUISED', description FROM app_records WHERE {_blank('description')}
UNION ALL SELECT row_id, 'unit_price', 'PRICE', v FROM price
UNION ALL SELECT row_id, 'unit_price', 'MISSING', unit_price FROM app_records WHERE unit_price IS NULL
UNION ALL SELECT row_id, 'unit_price', 'DISGUISED', unit_price FROM app_records WHERE {_blank('unit_price')}
UNION ALL SELECT row_id, 'unit_price', 'FAILED', v FROM p WHERE v IS NOT NULL AND num IS NULL AND NOT {_blank('v')}"""


@_query(_ISSUES)
def issues_long(spark: SparkSession, d: str) -> DataFrame:
    return issues.table_issues(table(spark, d, "app_records"), "row_id", ["app_number", "description", "unit_price"], ["unit_price"])


# Rows -----------------------------------------------------------------------------------------------------------------
@_query(f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY lower({_strip('text')}), lower({_strip('lang')})")
def drop_duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    return rows.drop_duplicates(table(spark, d, "documents").select("doc_id", "text", "lang"), "doc_id", ["text", "lang"]).select("doc_id")


_LENGTH = " + ".join(f"CASE WHEN {_filled(c)} THEN length({_strip(c)}) ELSE 0 END" for c in ("description", "part_description"))


@_query(f"""SELECT row_id FROM (SELECT row_id, k, n, count(*) OVER w AS c, max(n) OVER w AS m, row_number() OVER (PARTITION BY k ORDER BY n DESC, row_id) AS r
  FROM (SELECT row_id, CASE WHEN {_filled('app_number')} THEN {_strip('app_number')} END AS k, {_LENGTH} AS n FROM app_records) WINDOW w AS (PARTITION BY k)) WHERE k IS NULL OR c = 1 OR m = 0 OR r = 1""")
def longest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return rows.longest_per_key(table(spark, d, "app_records").select("row_id", "app_number", "description", "part_description"), "app_number", "row_id", ["description", "part_description"]).select("row_id")


_HEADERS = "SELECT CAST(r_regionkey AS VARCHAR(20)) AS id, r_name AS name FROM {region} UNION ALL SELECT 'ID', ' Name ' UNION ALL SELECT 'id', 'NAME' UNION ALL SELECT 'id', 'other'"


@_query(f"SELECT id, name FROM ({_HEADERS.format(region='region')}) WHERE NOT (lower(trim(id)) = 'id' AND lower(trim(name)) = 'name')")
def repeated_header_rows(spark: SparkSession, d: str) -> DataFrame:
    return rows.drop_repeated_headers(spark.sql(_HEADERS.format(region=f"parquet.`{d}/region.parquet`")))


_TOTALS = """SELECT n_name AS label, CAST(n_nationkey AS VARCHAR(20)) AS amount, CAST(n_regionkey AS VARCHAR(20)) AS qty FROM {nation} UNION ALL SELECT 'Grand  Total', '300', '£50' UNION ALL SELECT 'total', '5', NULL
  UNION ALL SELECT 'Subtotal ', 'many', 'some' UNION ALL SELECT 'TOTAL', 'x', '1,200' UNION ALL SELECT l, '7', '8' FROM (VALUES ('totals'), ('grand total'), ('grand totals'), ('subtotal'), ('sub-total'), ('Sub Total'), ('grand subtotal'), ('grand sub-total'), ('grand sub total'),
  ('overall total'), ('column total'), ('report total'), ('total of all'), ('sub totals')) t(l)"""


@_query(f"""SELECT label, amount, qty FROM ({_TOTALS.format(nation='nation')}) WHERE NOT (lower(regexp_replace(trim(label), '\\s+', ' ', 'g')) IN ('total', 'totals', 'grand total', 'grand totals', 'subtotal', 'sub-total', 'sub total', 'grand subtotal', 'grand sub-total', 'grand sub total')
  AND amount IS NOT NULL AND qty IS NOT NULL AND (regexp_matches(translate(amount, ',£', ''), '^[0-9.]+$') OR regexp_matches(translate(qty, ',£', ''), '^[0-9.]+$')))""")
def total_rows(spark: SparkSession, d: str) -> DataFrame:
    df = spark.sql(_TOTALS.format(nation=f"parquet.`{d}/nation.parquet`"))
    return rows.drop_totals(df, ["label", "amount", "qty"])


_BLANKED = "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS event_type, CASE WHEN event_id % 5 > 0 THEN value END AS value FROM {events}"


@_query(f"SELECT * FROM ({_BLANKED.format(events='events')}) WHERE event_type IS NOT NULL OR value IS NOT NULL")
def blank_rows(spark: SparkSession, d: str) -> DataFrame:
    return rows.drop_blank_rows(spark.sql(_BLANKED.format(events=f"parquet.`{d}/events.parquet`")), ["event_type", "value"])


# Columns --------------------------------------------------------------------------------------------------------------
_COPIES = "SELECT o_orderkey AS id, o_orderstatus AS status, lower(o_orderstatus) AS status_copy, o_orderpriority AS priority, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS priority_copy, o_custkey AS customer, CAST(o_custkey AS VARCHAR(20)) AS customer_text, CAST(o_custkey AS DOUBLE) AS customer_double FROM {orders}"


@_query(f"""WITH t AS ({_COPIES.format(orders='orders')}) SELECT 'status' AS column_a, 'status_copy' AS column_b FROM t HAVING count(*) FILTER (WHERE lower(status) IS DISTINCT FROM lower(status_copy)) = 0
UNION ALL SELECT 'priority', 'priority_copy' FROM t HAVING count(*) FILTER (WHERE lower(priority) IS DISTINCT FROM lower(priority_copy)) = 0
UNION ALL SELECT 'customer', 'customer_double' FROM t HAVING count(*) FILTER (WHERE customer IS DISTINCT FROM customer_double) = 0""")
def duplicate_content_columns(spark: SparkSession, d: str) -> DataFrame:
    df = spark.sql(_COPIES.format(orders=f"parquet.`{d}/orders.parquet`"))
    return spark.createDataFrame(C.equal_columns(df, "id"), "column_a string, column_b string")


@_query("SELECT 'status' AS base, 'status.1' AS copy, count(*) FILTER (WHERE lower(o_orderstatus) IS DISTINCT FROM lower(o_orderpriority)) AS mismatches FROM orders UNION ALL SELECT 'priority', 'priority.1', 0")
def resolve_duplicate_columns(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("status.1"), F.col("o_orderpriority").alias("priority"), F.upper("o_orderpriority").alias("priority.1"))
    return spark.createDataFrame([(a, b, n) for (a, b), n in C.copy_mismatches(df).items()], "base string, copy string, mismatches long")


@_query("SELECT * FROM (VALUES (0, 'email'), (1, 'email.2'), (2, 'email.1'), (3, 'Unnamed: 3'), (4, 'source_file_original'), (5, 'year_2024')) t(position, name)")
def dedupe_names(spark: SparkSession, d: str) -> DataFrame:
    header = ["Email", "email", "email.1", None, "Source File", "Year 2024"]
    names = N.free_reserved(N.unique_names([N.standard_name(c) if c else N.mangle_header(header)[i] for i, c in enumerate(header)]))
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


@_query()
def semantic_types(spark: SparkSession, d: str) -> DataFrame:
    found = []
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "app_records", "loaded_files", "cell_masks", "listing_rows"):
        found += [(name, c, k) for c, k in Ty.semantic_types(table(spark, d, name)).items()]
    return spark.createDataFrame(found, "table_name string, column_name string, kind string")


@_query()
def physical_types(spark: SparkSession, d: str) -> DataFrame:
    found = text_source.physical_types(table(spark, d, "app_records"), RECORD_COLUMNS)
    return spark.createDataFrame(list(found.items()), "column_name string, kind string")


@_query()
def file_layouts(spark: SparkSession, d: str) -> DataFrame:
    return failed_rows.layouts(table(spark, d, "raw_records"), "file_id", "record_no", "record_text")


# Reports --------------------------------------------------------------------------------------------------------------
_DETAIL = [("country", "country"), ("status", "status"), ("quantity", "quantity")]


@_query("WITH c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS v FROM app_records" for c, _ in _DETAIL) + """), g AS (SELECT column_name, v, count(*) AS n, CASE WHEN regexp_matches(v, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN try_cast(v AS DOUBLE) END AS x FROM c GROUP BY column_name, v)
SELECT column_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS BIGINT) AS n_missing, count(v) AS n_distinct, min(x) AS min_number, max(x) AS max_number,
  round(sum(x * n) / sum(n) FILTER (WHERE x IS NOT NULL), 2) AS mean_number, (max({'n': n, 'v': v}) FILTER (WHERE v IS NOT NULL)).v AS top_value, (max({'n': n, 'v': v}) FILTER (WHERE v IS NOT NULL)).n AS top_count FROM g GROUP BY column_name""")
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return reporting.column_details(table(spark, d, "app_records"), [c for c, _ in _DETAIL])


_OVERVIEW = ["app_number", "description", "unit_price", "country"]


@_query(f"""WITH g AS (SELECT {', '.join(_OVERVIEW)}, count(*) AS n, {' + '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END' for c in _OVERVIEW)} AS m FROM app_records GROUP BY {', '.join(_OVERVIEW)})
SELECT CAST(sum(n) AS BIGINT) AS n_rows, {len(_OVERVIEW)} AS n_columns, CAST(sum(n - 1) AS BIGINT) AS n_duplicates, CAST(sum(m * n) AS BIGINT) AS n_missing, round(100.0 * sum(m * n) / (sum(n) * {len(_OVERVIEW)}), 2) AS missing_percent FROM g""")
def dataset_overview(spark: SparkSession, d: str) -> DataFrame:
    return reporting.overview(table(spark, d, "app_records"), _OVERVIEW)


@_query(f"SELECT count(*) AS rows_before, count(*) - (count(*) - count(DISTINCT k)) AS rows_after, count(*) - count(DISTINCT k) AS rows_removed, 0 AS rows_added FROM (SELECT coalesce(lower({_strip('text')}), '~null') AS k FROM documents)")
def before_after(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "documents").select("doc_id", "text")
    return reporting.changes(df, rows.drop_duplicates(df, "doc_id", ["text"]), ["text"])


@_query()
def clean_app_records(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "app_records").select(F.col("row_id").alias(cleaning.ROW), *RECORD_COLUMNS)
    return cleaning.clean(df, "app_records").display()


# Relational primitives ------------------------------------------------------------------------------------------------
@_query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def top_order_per_customer(spark: SparkSession, d: str) -> DataFrame:
    return rows.top_per_group(table(spark, d, "orders"), ["o_custkey"], [F.col("o_totalprice"), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])


@_query("SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_totalprice) AS lowest, max(o_totalprice) AS highest, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS share_f FROM orders GROUP BY o_orderpriority")
def group_reductions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"), F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest"), F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("share_f"))


@_query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@_query("SELECT n_name, n FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) JOIN nation ON n_nationkey = c_nationkey")
def lookup_map(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return counts.join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("n_name", "n")


# Optional modes -------------------------------------------------------------------------------------------------------
@_query(f"SELECT row_id, {', '.join(f'CASE WHEN NOT {_blank(c)} THEN {c} END AS {c}' for c in ('description', 'country', 'status'))} FROM app_records")
def placeholders_to_null(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", *[F.when(~is_placeholder(F.col(c)), F.col(c)).alias(c) for c in ("description", "country", "status")])


@_query(f"SELECT row_id, CASE WHEN v IS NULL THEN 0.0 ELSE num END AS price FROM {_money('unit_price', 'app_records', 'row_id')}")
def missing_numbers_to_zero(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("unit_price")
    return table(spark, d, "app_records").select("row_id", F.when(c.isNull(), F.lit(0.0)).otherwise(V.to_money(c)).alias("price"))


@_query(f"SELECT row_id, num AS price FROM {_money('unit_price', 'app_records', 'row_id')} WHERE num <= 0")
def low_prices_only(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("row_id", V.to_money(F.col("unit_price")).alias("price")).where("price <= 0")


@_query("SELECT DISTINCT app_number, description, unit_price, load_no FROM app_records")
def exact_distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "app_records").select("app_number", "description", "unit_price", "load_no").distinct()


@_query(f"SELECT o_orderkey, CASE WHEN {_KEY} IN {_words(TRUE_WORDS)} THEN true WHEN {_KEY} IN {_words(FALSE_WORDS)} THEN false END AS flag FROM ({_FLAGS.format(orders='orders')})")
def flag_to_boolean(spark: SparkSession, d: str) -> DataFrame:
    messy = spark.sql(_FLAGS.format(orders=f"parquet.`{d}/orders.parquet`"))
    return messy.select("o_orderkey", (V.to_flag(F.col("v")) == "Y").alias("flag"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
