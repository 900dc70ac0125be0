from hypothesis import given
from hypothesis import strategies as st

from plumbline.functions import names as N

PRICES = ["price", "unit_price", "list_price", "prices", "unitprice", "net_amount", "listprice", "subtotal", "totalcost", "rate", "value", "total", "fee", "charge", "surcharge", "part_price", "Amount", "Unit Price", "hourly rate", "amounts"]
NOT_PRICES = ["total_qty", "cost_centre", "pricelist", "charge_on_finance_charge_flag", "discharge_date", "valued_by", "priceband", "price_code", "exchange_rate", "heart_rate", "tax_rate", "interest_rate", "default_value", "key_value", "field_value", "priceflag", "chargeflags", "discount_percentage_charge", "costpercentage", "total_weight", "amount_name", "price_type", "number_of_fees", "rate_id", "value_date"]


def test_price_names():
    assert [n for n in PRICES if not N.is_price(n)] == []
    assert [n for n in NOT_PRICES if N.is_price(n)] == []


def test_measures_and_keys():
    assert N.is_measure("total_weight") and N.is_measure("Height") and not N.is_measure("unit_price")
    assert all(map(N.is_app_number, ["app", "App No.", "APP_NUMBER", "appno"]))
    assert not any(map(N.is_app_number, ["app_name", "bpa_date", "app.1", "app_number_alt_1"]))


def test_boundaries():
    assert N.has_bounded_word("user_name", "name") and N.has_bounded_word("name2", "name") and not N.has_bounded_word("username", "name")
    assert N.has_phone_token("phone_number") and not N.has_phone_token("hotel_name") and N.is_phone_column("Number")
    assert N.has_keyword("itemdescription", ["description"]) and not N.has_keyword("apple", ["app"])


def test_unique_and_reserved():
    assert N.unique_names(["email", "email", "email.1", "email"]) == ["email", "email.2", "email.1", "email.3"]
    assert N.free_reserved(["source_file", "source_file_original"]) == ["source_file_original_", "source_file_original"]
    assert N.mangle_header(["a", None, "a", " "]) == ["a", "Unnamed: 1", "a.1", "Unnamed: 3"]
    assert N.alternative_names(["email", "email.1", "email_alt_1"], ["email.1"]) == {"email.1": "email_alt_2"}


@given(st.lists(st.sampled_from(["a", "b", "a.1", "a.2", "b.1"]), max_size=12))
def test_unique_names_are_unique_and_keep_first(names):
    out = N.unique_names(names)
    assert len(set(out)) == len(out) == len(names)
    assert all(out[names.index(n)] == n for n in set(names))
