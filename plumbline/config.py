"""Settings: word lists, patterns and thresholds, passed to operators and never read as globals by them."""

from __future__ import annotations

# Fixed values ---------------------------------------------------------------------------------------------------------
DISGUISED_BLANKS = ("missing", "not available", "not applicable", "n/a", "na", "tbd", "unknown", "null", "none", "", "-", "...", "???", ".", "?", "*")
EXTENSIONS = ("csv", "tsv", "txt", "xlsx", "xls", "xlsm", "xlsb")
ID_KEYWORDS = ("id", "code", "zip", "postcode", "sku", "no", "number", "app", "commodity_code", "ean")
PRICE_KEYWORDS = ("price", "cost", "amount", "rate", "value", "total", "fee", "charge", "surcharge", "unit_price", "part_price")
PRICE_SUFFIXES = ("price", "cost", "amount", "total")
NOT_PRICE_TOKENS = (
    "qty", "quantity", "quantities", "count", "items", "units", "pcs", "rows", "lines",
    "weight", "height", "length", "width", "depth", "volume",
    "code", "centre", "center", "type", "name", "date", "id", "no", "num", "number",
    "notes", "description", "status", "band",
    "exchange", "heart", "tax", "interest", "attribute", "default", "key", "field",
    "flag", "flags", "flagged",
    "percent", "percents", "percentage", "percentages", "pct",
)
MEASURE_KEYWORDS = ("height", "weight", "length", "width", "depth", "diameter", "thickness", "volume", "dimension", "dimensions", "qty", "quantity")
APP_NUMBER_KEYWORDS = ("app_number", "app_num", "app_no", "app")
DESCRIPTION_KEYWORDS = ("description", "part_description", "item_description")
CASING_RULES = (("name", "title"), ("email", "lower"), ("country", "title"), ("status", "title"))
CATEGORY_MAPPINGS = {
    "country": {"usa": "United States", "us": "United States", "u.s.a": "United States", "uk": "United Kingdom", "britain": "United Kingdom"},
    "status": {"active": "Active", "act": "Active", "inactive": "Inactive", "cancelled": "Inactive"},
}
PHONE_TOKENS = ("phone", "telephone", "tel", "mobile", "cell", "fax")
PHONE_NAMES = ("number", "phonenumber")
TRUE_WORDS = ("true", "t", "yes", "y", "1", "active", "enabled", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "inactive", "disabled", "off")
STATE_WORDS = ("active", "inactive", "enabled", "disabled", "on", "off")
CLEAR_FLAG_WORDS = ("true", "false", "yes", "no")
FLAG_NAME_TOKENS = ("flag", "enabled", "active", "boolean", "bool", "yn")
TOTAL_LABELS = ("total", "totals", "grand total", "grand totals", "subtotal", "sub-total", "sub total", "grand subtotal", "grand sub-total", "grand sub total")
#: Unicode white space as Python's str.strip() sees it.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
