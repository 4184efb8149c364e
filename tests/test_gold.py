from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.functions.keys import versioned_key
from tallyhouse.operators.integrity import (constraint_report, key_violations, orphan_summary, orphans, values_outside)
from tallyhouse.plans import dimensions, facts, summaries
from tallyhouse.plans.silver import silver
from tallyhouse.runtime import stored
from tests.test_rules import CLEAN

AT = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def make(raw):
    """Silver table from changes to the clean row of its raw table."""

    def build(table, *changes):
        rows = [{**CLEAN[table], "__load_ts": AT, "__row_number": i, **c} for i, c in enumerate(changes)]
        return stored(silver(raw(table, *rows), table))

    return build


@pytest.fixture(scope="module")
def country(make):
    return stored(dimensions.dim_country(
        make("country_master", {"country_code": "US", "tax_code": "T1"}, {"country_code": "JP", "tax_code": "T9"},
             {"country_code": "IN", "tax_code": "T2"}, {"country_code": "XX", "currency_code": None}),
        make("region_master", {"region_code": "R"}), make("currency_master", {"currency_code": "C"}),
        make("tax_master", {"tax_code": "T1"}, {"tax_code": "T2", "tax_rate": Decimal(2)})))


def test_country_keeps_rows_without_a_valid_tax(country):
    got = {r.country_code: (r.region_code, r.currency_code, r.tax_code, r.tax_rate) for r in country.collect()}
    assert got == {"US": ("R", "C", "T1", Decimal("0.2000")), "JP": ("R", "C", None, None), "IN": ("R", "C", None, None)}


def test_product_needs_the_whole_chain(make):
    masters = (make("product_model_master", {}), make("product_family_master", {}), make("product_category_master", {}))
    sku = make("product_sku_master", {"sku_code": "S1"}, {"sku_code": "S2", "model_code": "unknown"})
    assert [r.sku_code for r in dimensions.dim_product(sku, *masters).collect()] == ["S1"]
    broken = make("product_category_master", {"category_name": ""})
    assert dimensions.dim_product(sku, *masters[:2], broken).count() == 0


def test_bridge_counts_and_keys(make, country):
    # 53 articles in seven countries, four of which are known
    codes = ["US", "DE", "JP", "IN", "UK", "CA", "AU"]
    skus = [f"S{i}" for i in range(53)]
    availability = make("product_country_availability", *[{"sku_code": s, "country_code": c} for s in skus for c in codes])
    sku = make("product_sku_master", *[{"sku_code": s, "model_code": "not in the product dimension"} for s in skus])
    countries = make("country_master", *[{"country_code": c} for c in ("US", "JP", "IN", "UK", "CN")])
    bridge = dimensions.bridge_product_country(availability, sku, countries)
    assert bridge.count() == 212
    assert bridge.select("bridge_key").distinct().count() == 212
    want = sku.filter("sku_code = 'S7'").select(versioned_key("__bronze_load_ts", "sku_code")).first()[0]
    assert bridge.filter("sku_code = 'S7'").select("product_dim_key").distinct().collect() == [(want,)]


def sale(number, **change):
    return {"transaction_id": f"T{number}", "transaction_timestamp": date(2024, 3, 30), "channel_id": "POS", **change}


@pytest.fixture(scope="module")
def star(make, country):
    header = make(
        "sales_header",
        sale(1, net_total=Decimal(10)), sale(2, net_total=Decimal(20), currency="EUR"),
        sale(3, transaction_timestamp=date(2024, 12, 30)), sale(4, transaction_timestamp=date(2024, 1, 2)),
        sale(5, store_id="S-DE"), sale(6, customer_id="nobody"), sale(7, net_total=Decimal(-1)),
        sale(8, transaction_timestamp=None), sale(9, customer_id="C2", net_total=Decimal(5)))
    customer = dimensions.dim_customer(make("customer_master", {}, {"customer_id": "C2"}, {"customer_id": "C3", "email": None}))
    store = dimensions.dim_store(make("store_master", {}, {"store_code": "S-DE", "country_code": "DE"}))
    days = dimensions.dim_date(header)
    return header, stored(customer), stored(store), country, stored(days)


@pytest.fixture(scope="module")
def fact(star):
    header, customer, store, country, _ = star
    return stored(facts.fact_sales_header(header, customer, store, country))


def test_header_fact_drops_what_has_no_dimension(star, fact):
    header, customer, store, country, days = star
    assert sorted(r.transaction_id for r in fact.collect()) == ["T1", "T2", "T3", "T4", "T9"]
    looked_up = facts.fact_sales_header(header, customer, store, country, days)
    assert sorted(looked_up.collect()) == sorted(fact.collect())


def test_item_fact_follows_the_header(make, fact):
    product = dimensions.dim_product(make("product_sku_master", {}), make("product_model_master", {}),
                                     make("product_family_master", {}), make("product_category_master", {}))
    items = make("sales_item", {"transaction_line_id": "L1", "transaction_id": "T1"},
                 {"transaction_line_id": "L2", "transaction_id": "T1"}, {"transaction_line_id": "L3", "transaction_id": "T5"},
                 {"transaction_line_id": "L4", "transaction_id": "T2", "sku_code": "unknown"},
                 {"transaction_line_id": "L5", "transaction_id": "T9", "quantity": 0})
    got = facts.fact_sales_item(items, fact, product).collect()
    assert sorted(r.transaction_line_id for r in got) == ["L1", "L2"]
    assert {r.customer_dim_key for r in got} == {r.customer_dim_key for r in fact.filter("transaction_id = 'T1'").collect()}


def test_summaries(star, fact):
    _, _, store, country, days = star
    daily = summaries.fact_sales_daily(fact, days, store, country)
    got = {(r.date_key, r.currency): (r.transaction_count, r.total_net_sales, r.avg_transaction_value, r.unique_customers)
           for r in daily.collect()}
    assert got[(date(2024, 3, 30), "USD")] == (2, Decimal(15), 7.5, 2)  # currencies stay apart
    assert got[(date(2024, 3, 30), "EUR")] == (1, Decimal(20), 20.0, 1)
    assert sum(v[0] for v in got.values()) == fact.count()

    weekly = {(r.year_number, r.week_number): r for r in summaries.fact_sales_weekly(fact, days, country).collect()}
    shared = weekly[(2024, 1)]  # 2 January and 30 December 2024 are both in a week 1
    assert (shared.week_start_date, shared.week_end_date, shared.selling_days) == (date(2024, 1, 2), date(2024, 12, 30), 2)
    iso = {(r.year_number, r.week_number) for r in summaries.fact_sales_weekly(fact, days, country, iso=True).collect()}
    assert {(2024, 1), (2025, 1)} <= iso

    monthly = {(r.year_month, r.currency): r for r in summaries.fact_sales_monthly(fact, days, country).collect()}
    march = monthly[("2024-03", "USD")]
    assert (march.fiscal_year, march.fiscal_quarter, march.active_stores, march.unique_customers) == (2023, 4, 1, 2)


def test_checks(local, star, fact):
    header, customer, store, country, days = star
    assert orphans(header, store, "store_id", "store_code").collect() == []
    summary = orphan_summary(header, customer, "customer_id", "customer_id", "buyers").first()
    assert tuple(summary) == ("buyers", 1, 1, 0)
    assert {r["value"]: r["rows"] for r in values_outside(header, "currency", ["USD"]).collect()} == {"EUR": 1}
    twice = fact.unionByName(fact.filter("transaction_id = 'T1'"))
    assert tuple(key_violations(twice, ["fact_sales_header_key"]).first()) == (0, 1, 1)
    nulls = local([(None,), (None,), ("a",)], "k string")
    assert tuple(key_violations(nulls, ["k"]).first()) == (2, 0, 0)
    items = local(
        [("i", "gone", "p")], "fact_sales_item_key string, fact_sales_header_key string, product_dim_key string")
    product = local([("p",)], "product_dim_key string")
    report = constraint_report({
        "dim_customer": customer, "dim_store": store, "dim_country": country, "dim_date": days, "dim_product": product,
        "fact_sales_header": twice, "fact_sales_item": items}).collect()
    assert len(report) == 13
    bad = {r.constraint_name: r.violations for r in report if r.violations}
    # the sale without a day is valid, so the date dimension has a row without a key
    assert bad == {"pk_dim_date": 1, "pk_fact_sales_header": 1, "fk_item_header": 1}
    assert [r.table_name for r in report] == sorted(r.table_name for r in report)
