import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import questions
from tallyhouse.plans.metrics import LOGICAL, RELATIONSHIPS, AmbiguousName, Metric, Model, UnknownName, relationship
from tallyhouse.plans.warehouse import NotBuilt, Warehouse


@pytest.fixture(scope="module")
def model(house):
    return Model(house.table)


def test_counts_of_the_model():
    assert sum(len(t.dimensions) for t in LOGICAL.values()) == 82
    assert sum(len(t.times) for t in LOGICAL.values()) == 8
    assert sum(len(t.facts) for t in LOGICAL.values()) == 12
    assert sum(len(t.metrics) for t in LOGICAL.values()) == 18
    assert len(RELATIONSHIPS) == 10


def test_names_and_synonyms(model):
    assert model.find_metric("net revenue")[1] == "total_net_sales"
    assert model.find_metric("fact_sales_header.total_tax")[0] == "fact_sales_header"
    header = ["fact_sales_header"]
    assert model.find_column("sales channel", header) == ("fact_sales_header", "channel")
    assert model.find_column("dim_date.month", header) == ("dim_date", "month")
    assert model.find_column("fy", header) == ("dim_date", "fiscal_year")
    assert relationship("fact_sales_header", "dim_date") == ("date_dim_key", "date_dim_key")
    for name in ("region", "month", "city", "state", "country", "country_code"):
        with pytest.raises(AmbiguousName):
            model.find_column(name, header)
    for name in ("nothing", "dim_x.y", "dim_date.nothing"):
        with pytest.raises(UnknownName):
            model.find_column(name, header)
    with pytest.raises(UnknownName):
        model.query(["total_net_sales"], ["category_name"])


def test_two_facts_do_not_multiply(model, house):
    got = model.query(["total_net_sales", "total_units_sold"], ["channel"]).orderBy("channel").collect()
    for row in got:
        sales = house.table("fact_sales_header").filter(f"channel_id = '{row.channel}'")
        items = house.table("fact_sales_item").filter(f"channel_id = '{row.channel}'")
        assert row.total_net_sales == sales.groupBy().sum("net_total").first()[0]
        assert row.total_units_sold == items.groupBy().sum("quantity").first()[0]


def test_distinct_unless_uniqueness_is_assumed(model, house, plan):
    quick = Model(house.table, assume_unique=True).query(["total_transactions"], ["channel"])
    exact = model.query(["total_transactions"], ["channel"])
    assert sorted(quick.collect()) == sorted(exact.collect())
    assert "distinct" not in plan(quick) and "distinct" in plan(exact)

    def repeated(name):
        return house.table(name).unionByName(house.table(name))

    assert Model(repeated).query(["total_transactions"]).first()[0] == house.table("fact_sales_header").count()


def test_filters_order_limit_and_totals(model, house):
    total = model.query(["total_line_items"]).collect()
    assert [tuple(r) for r in total] == [(house.table("fact_sales_item").count(),)]
    top = model.query({"n": "order count"}, {"store": "dim_store.store_name"}, ["pos_sales"], ["-n"], 3).collect()
    assert len(top) == 3 and [r.n for r in top] == sorted((r.n for r in top), reverse=True)
    late = model.query(["total_transactions"], filters=[("dim_date.year", ">=", 2000)]).first()[0]
    early = model.query(["total_transactions"], filters=[("dim_date.year", "<", 2000)]).first()[0]
    assert late + early == house.table("fact_sales_header").count()
    by_method = model.query(["total_units_sold"], ["payment_method"])  # lines reach it through their transaction
    assert sum(r[1] for r in by_method.collect()) == model.query(["total_units_sold"]).first()[0]
    counted = model.query({"rows": Metric("count")}, base="fact_sales_item").first()[0]
    assert counted == total[0][0]


def test_only_needed_dimensions_are_joined(model, plan):
    text = plan(model.query(["total_net_sales"], ["dim_country.region_name"]))
    assert text.count("Join") == 1
    assert "Join" not in plan(model.query(["total_net_sales"], ["channel"]))


def test_questions(model):
    assert len(questions.QUESTIONS) == 8
    for ask in questions.QUESTIONS.values():
        assert ask(model).count() > 0


def test_large_dimensions_meet_sums(model, house, plan, monkeypatch):
    def ask():
        return model.query(
            {"n": "order count", "net": "total_net_sales", "avg": "atv", "rows": Metric("count")},
            {"tier": "dim_customer.loyalty_tier", "channel": "channel", "year": "dim_date.year"},
            ["web_sales", ("dim_customer.gender", "=", "Male")], base="fact_sales_header")

    want = sorted(ask().collect())
    monkeypatch.setattr("tallyhouse.runtime.BROADCAST_BYTES", 0)
    text = plan(ask())
    assert text.count("HashAggregate") == 4  # two steps before the joins, two after
    assert sorted(ask().collect()) == want


@pytest.mark.parametrize("condition", [
    ("dim_date.year", "=", 1996), ("dim_date.month", "=", 3), ("dim_date.year_quarter", "=", "1996-Q2"),
    ("dim_date.date", "between", (date(1996, 3, 1), date(1996, 3, 15))),
    ("fact_sales_header.transaction_date", ">=", date(1998, 1, 1))])
def test_conditions_on_time_skip_months(model, house, plan, condition):
    asked = model.query(["total_net_sales", "total_transactions"], ["channel"], [condition])
    scan = next(line for line in plan(asked).splitlines() if "FileScan" in line and "net_total" in line)
    assert "PartitionFilters: [" in scan and "sales_month" in scan.partition("PartitionFilters: ")[2].partition("]")[0]
    days = house.table("dim_date").withColumnsRenamed({})
    column = {"dim_date.year": "year_number", "dim_date.month": "month_number", "dim_date.year_quarter": "year_quarter"}.get(condition[0], "date_key")
    test = {"=": lambda c: c == condition[2], ">=": lambda c: c >= condition[2], "between": lambda c: c.between(*condition[2])}[condition[1]]
    kept = house.table("fact_sales_header").join(days.filter(test(F.col(column))).select("date_dim_key"), "date_dim_key")
    want = {r.channel_id: (r.net, r.n) for r in kept.groupBy("channel_id").agg(F.sum("net_total").alias("net"), F.count(F.lit(1)).alias("n")).collect()}
    assert {r.channel: (r.total_net_sales, r.total_transactions) for r in asked.collect()} == want and want


def test_questions_are_answered_from_stored_groups(house, plan):
    """The same answers with and without; what the groups do not hold is read from the fact."""
    plain, grouped = Model(house.open), Model(house.open, groups=lambda: house.open("sales_groups"))
    ask = [
        lambda m: m.query(["total_net_sales", "total_transactions", "average_transaction_value"], ["dim_country.region_name", "dim_date.year_month"]),
        lambda m: m.query({"n": Metric("count")}, {"store": "dim_store.store_name"}, ["web_sales"], base="fact_sales_header"),
        lambda m: m.query(["total_tax", "total_discounts", "total_gross_sales"], ["channel", "currency"], [("dim_date.year", "=", 1996)]),
        lambda m: m.query(["total_transactions", "total_net_sales"], (), [("dim_date.year", "=", 1)])]
    for question in ask:
        a, b = question(plain), question(grouped)
        assert a.dtypes == b.dtypes and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert not re.search(r"\b(net_total|gross_amount|transaction_id)\b", plan(b))
    for name in ("What are the total sales by region?", "Show me the monthly sales trend", "What are sales by quarter?"):
        assert "net_total" not in plan(questions.QUESTIONS[name](grouped)) and "net_total" in plan(questions.QUESTIONS[name](plain))
    by_day = grouped.query(["total_net_sales"], ["fact_sales_header.transaction_date"])
    by_person = grouped.query(["total_net_sales"], ["dim_customer.loyalty_tier"])
    assert all("net_total" in plan(df) for df in (by_day, by_person))


def files_of(root):
    return {p: p.stat().st_mtime_ns for p in Path(root).rglob("*") if p.is_file()}


def test_opening_never_writes(spark, house):
    root = house.root.removesuffix("/dev")
    before = files_of(root)
    other = Warehouse(spark, root)
    assert Model(other.open).query(["total_net_sales"], ["channel"]).count() > 0
    other.views()
    assert files_of(root) == before
    with pytest.raises(NotBuilt):
        other.open("no_such_table")


def test_a_new_build_leaves_open_readers_alone(spark, house, tmp_path):
    mine = Warehouse(spark, str(tmp_path), house.raw)
    mine.build("dim_store")
    opened = Warehouse(spark, str(tmp_path)).open("dim_store")
    mine.build("dim_store")
    assert opened.count() == mine.open("dim_store").count() > 0
    assert [p.name for p in sorted((tmp_path / "dev" / "gold" / "dim_store").iterdir())] == ["1", "2"]
    for _ in range(2):
        mine.build("dim_store")
    assert len(list((tmp_path / "dev" / "gold" / "dim_store").iterdir())) == 2


def test_only_what_depends_on_a_change_is_built_again(spark, house, tmp_path):
    mine = Warehouse(spark, str(tmp_path), house.raw)
    mine.build("dim_store", "dim_country", "dim_customer")
    before = files_of(tmp_path)
    mine.build("dim_store", "dim_country", "dim_customer", after=())
    assert files_of(tmp_path) == before
    mine.build("dim_store", "dim_country", "dim_customer", after=["store_master"])
    new = set(files_of(tmp_path)) - set(before)
    assert new and all("dim_store" in str(p) for p in new)


def test_whole_build(house):
    tables = house.build(after=())
    assert len(tables) == 28
    daily = tables["fact_sales_daily"].groupBy().sum("transaction_count").first()[0]
    assert daily == tables["fact_sales_header"].count()
