from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.operators import quality
from tallyhouse.operators.quality import first_broken, is_valid, length_rules, rule_summary, rules_for
from tallyhouse.schemas import RAW_TABLES

OLD, NEW = date(2000, 1, 1), date(2020, 1, 1)
PERIOD = {"effective_start_date": OLD, "effective_end_date": NEW}
CLEAN = {
    "region_master": {"region_code": "R", "region_name": "n", "is_active": "Y", **PERIOD},
    "currency_master": {"currency_code": "C", "currency_name": "n", "is_active": "N", **PERIOD},
    "tax_master": {"tax_code": "T", "tax_type": "VAT", "tax_rate": Decimal("0.2"), "tax_inclusive_flag": "Y",
                   "is_active": "Y", **PERIOD},
    "country_master": {"country_code": "US", "country_name": "n", "region_code": "R", "currency_code": "C",
                       "ecommerce_supported": "Y", "retail_store_supported": "N"},
    "product_category_master": {"category_code": "K", "category_name": "n", "is_active": "Y", **PERIOD},
    "product_family_master": {"family_code": "F", "family_name": "n", "category_code": "K", "is_active": "Y",
                              "launch_year": 2020},
    "product_model_master": {"model_code": "M", "model_name": "n", "family_code": "F", "is_active": "Y",
                             "launch_date": OLD, "discontinue_date": NEW},
    "product_sku_master": {"sku_code": "S", "model_code": "M", "variant": "v", "is_active": "Y"},
    "product_country_availability": {"sku_code": "S", "country_code": "US", "is_available": "Y",
                                     "local_launch_date": OLD, "local_discontinue_date": NEW},
    "store_master": {"store_code": "S", "store_name": "n", "country_code": "US", "is_active": "Y",
                     "latitude": Decimal(1), "longitude": Decimal(1), "store_open_date": OLD, "store_close_date": NEW,
                     "floor_area_sqft": 1, "annual_rent_usd": 1, **PERIOD},
    "customer_master": {"customer_id": "C", "customer_number": "1", "email": "a@b.c", "date_of_birth": OLD,
                        "registration_date": date(2026, 3, 2), "country_code": "US"},
    "sales_header": {"transaction_id": "T", "transaction_number": "1", "customer_id": "C", "store_id": "S",
                     "currency": "USD", "gross_amount": Decimal(1), "total_discount": Decimal(0),
                     "total_tax": Decimal(0), "net_total": Decimal(1)},
    "sales_item": {"transaction_line_id": "L", "transaction_id": "T", "sku_code": "S", "quantity": 1,
                   "unit_price": Decimal(1), "discount_amount": Decimal(0), "tax_amount": Decimal(0),
                   "line_total": Decimal(1)},
}
TURNED = {"effective_end_date": date(1999, 1, 1)}
# per table and rule, in order: changes to the clean row that break that rule and no earlier one
BROKEN = {
    "region_master": [{"region_code": None}, {"region_name": " "}, {"is_active": "y"}, {"effective_start_date": None}, TURNED],
    "currency_master": [{"currency_code": None}, {"currency_name": None}, {"is_active": ""}, {"effective_start_date": None},
                        TURNED],
    "tax_master": [{"tax_code": None}, {"tax_type": ""}, {"tax_rate": Decimal("1.01")}, {"tax_inclusive_flag": "X"},
                   {"is_active": "X"}, {"effective_start_date": None}, TURNED],
    "country_master": [{"country_code": None}, {"country_name": ""}, {"region_code": None}, {"currency_code": None},
                       {"ecommerce_supported": "?"}, {"retail_store_supported": "?"}],
    "product_category_master": [{"category_code": None}, {"category_name": " "}, {"is_active": "X"}, TURNED],
    "product_family_master": [{"family_code": None}, {"family_name": None}, {"category_code": None}, {"is_active": "X"},
                              {"launch_year": 1899}],
    "product_model_master": [{"model_code": None}, {"model_name": ""}, {"family_code": None}, {"is_active": "X"},
                             {"discontinue_date": date(1999, 1, 1)}],
    "product_sku_master": [{"sku_code": None}, {"model_code": None}, {"variant": " "}, {"is_active": "X"}],
    "product_country_availability": [{"sku_code": None}, {"country_code": None}, {"is_available": "X"},
                                     {"local_discontinue_date": date(1999, 1, 1)}],
    "store_master": [{"store_code": None}, {"store_name": ""}, {"country_code": None}, {"is_active": "X"},
                     {"latitude": Decimal("90.1")}, {"longitude": Decimal("-180.1")},
                     {"store_close_date": date(1999, 1, 1)}, TURNED, {"floor_area_sqft": -1}, {"annual_rent_usd": -1}],
    "customer_master": [{"customer_id": None}, {"customer_number": None}, {"email": "a.b@c"},
                        {"date_of_birth": date(2026, 3, 3)}, {"registration_date": date(2026, 3, 3)},
                        {"country_code": None}],
    "sales_header": [{"transaction_id": None}, {"transaction_number": None}, {"customer_id": None}, {"store_id": None},
                     {"currency": None}, *[{c: Decimal("-0.01")} for c in
                                           ("gross_amount", "total_discount", "total_tax", "net_total")]],
    "sales_item": [{"transaction_line_id": None}, {"transaction_id": None}, {"sku_code": None}, {"quantity": 0},
                   *[{c: Decimal("-0.01")} for c in ("unit_price", "discount_amount", "tax_amount", "line_total")]],
}


@pytest.mark.parametrize("table", list(RAW_TABLES))
def test_one_bad_row_per_rule(raw, table):
    rules, clean = rules_for(table), CLEAN[table]
    assert len(rules) == len(BROKEN[table])
    rows = [clean, *[{**clean, **change} for change in BROKEN[table]]]
    df = raw(table, *[{**r, "__row_number": i} for i, r in enumerate(rows)])
    got = df.select("__row_number", is_valid(rules).alias("ok"), first_broken(rules).alias("why")).orderBy("__row_number")
    assert [(r.ok, r.why) for r in got.collect()] == [(True, None), *[(False, rule.name) for rule in rules]]
    summary = rule_summary(df, rules, table).collect()
    assert [r.broken_rows for r in summary] == [1] * len(rules)
    assert {r.total_rows for r in summary} == {len(rows)}


def test_unknown_values_break_no_rule(raw):
    region = {**CLEAN["region_master"], "is_active": None, "effective_end_date": None}
    sale = {k: v for k, v in CLEAN["sales_header"].items() if not isinstance(v, Decimal)}
    for table, row in (("region_master", region), ("sales_header", sale)):
        assert raw(table, row).select(is_valid(rules_for(table))).first()[0] is True


def test_missing_rate_and_quantity_are_invalid(raw):
    tax = {**CLEAN["tax_master"], "tax_rate": None}
    line = {**CLEAN["sales_item"], "quantity": None}
    assert raw("tax_master", tax).select(is_valid(rules_for("tax_master"))).first()[0] is False
    assert raw("sales_item", line).select(is_valid(rules_for("sales_item"))).first()[0] is False


def test_customer_date_is_a_parameter(raw):
    df = raw("customer_master", CLEAN["customer_master"])
    assert df.select(is_valid(rules_for("customer_master", "2026-03-01"))).first()[0] is False
    assert quality.LATEST_CUSTOMER_DATE == "2026-03-02"


def test_length_rules_come_from_the_schema(raw):
    df = raw("region_master", {**CLEAN["region_master"], "region_code": "12345678901"}, CLEAN["region_master"])
    rules = length_rules(df.schema)
    assert {r.name for r in rules} >= {"region_code is longer than 10", "is_active is longer than 1"}
    broken = rule_summary(df, rules, "region_master").filter("broken_rows > 0").collect()
    assert [(r.rule_name, r.broken_rows) for r in broken] == [("region_code is longer than 10", 1)]


def test_summary_counts_first_break_once(raw):
    row = {**CLEAN["region_master"], "region_code": None, "region_name": None}
    got = rule_summary(raw("region_master", row), rules_for("region_master"), "r").orderBy("rule_number").collect()
    assert [(r.broken_rows, r.first_broken_rows) for r in got[:2]] == [(1, 1), (1, 0)]
