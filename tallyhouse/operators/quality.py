"""Validity rules: declared once, used for the row flag and for the reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAG = "is_valid_record"

# Fixed value: customers may not be born or registered after this day.
LATEST_CUSTOMER_DATE = "2026-03-02"


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a row that breaks the rule; NULL does not break it."""

    name: str
    broken: Callable[[], Column]


def required(column: str) -> Rule:
    return Rule(f"{column} is missing", lambda: F.col(column).isNull())


def not_blank(column: str) -> Rule:
    return Rule(f"{column} is blank", lambda: F.col(column).isNull() | (F.trim(column) == ""))


def yes_or_no(column: str) -> Rule:
    return Rule(f"{column} is not Y or N", lambda: ~F.col(column).isin("Y", "N"))


def in_order(first: str, last: str) -> Rule:
    return Rule(f"{last} is before {first}", lambda: F.col(last) < F.col(first))


def within(column: str, low, high) -> Rule:
    return Rule(f"{column} is outside {low}..{high}", lambda: (F.col(column) < low) | (F.col(column) > high))


def not_negative(column: str) -> Rule:
    return Rule(f"{column} is negative", lambda: F.col(column) < 0)


def positive(column: str) -> Rule:
    return Rule(f"{column} is not positive", lambda: F.col(column).isNull() | (F.col(column) <= 0))


def mail_address(column: str) -> Rule:
    return Rule(f"{column} is no mail address", lambda: F.col(column).isNull() | ~F.col(column).like("%@%.%"))


def not_after(column: str, day: str) -> Rule:
    return Rule(f"{column} is after {day}", lambda: F.col(column) > F.lit(day).cast("date"))


def required_rate(column: str) -> Rule:
    return Rule(
        f"{column} is no rate",
        lambda: F.col(column).isNull() | (F.col(column) < 0) | (F.col(column) > 1),
    )


def rules_for(table: str, latest_customer_date: str = LATEST_CUSTOMER_DATE) -> list[Rule]:
    """The rules of one raw table, in the order they are applied."""
    validity_period = [required("effective_start_date"), in_order("effective_start_date", "effective_end_date")]
    rules = {
        "region_master": [
            required("region_code"), not_blank("region_name"), yes_or_no("is_active"), *validity_period],
        "currency_master": [
            required("currency_code"), not_blank("currency_name"), yes_or_no("is_active"), *validity_period],
        "tax_master": [
            required("tax_code"), not_blank("tax_type"), required_rate("tax_rate"),
            yes_or_no("tax_inclusive_flag"), yes_or_no("is_active"), *validity_period],
        "country_master": [
            required("country_code"), not_blank("country_name"), required("region_code"), required("currency_code"),
            yes_or_no("ecommerce_supported"), yes_or_no("retail_store_supported")],
        "product_category_master": [
            required("category_code"), not_blank("category_name"), yes_or_no("is_active"),
            in_order("effective_start_date", "effective_end_date")],
        "product_family_master": [
            required("family_code"), not_blank("family_name"), required("category_code"), yes_or_no("is_active"),
            within("launch_year", 1900, 2100)],
        "product_model_master": [
            required("model_code"), not_blank("model_name"), required("family_code"), yes_or_no("is_active"),
            in_order("launch_date", "discontinue_date")],
        "product_sku_master": [
            required("sku_code"), required("model_code"), not_blank("variant"), yes_or_no("is_active")],
        "product_country_availability": [
            required("sku_code"), required("country_code"), yes_or_no("is_available"),
            in_order("local_launch_date", "local_discontinue_date")],
        "store_master": [
            required("store_code"), not_blank("store_name"), required("country_code"), yes_or_no("is_active"),
            within("latitude", -90, 90), within("longitude", -180, 180),
            in_order("store_open_date", "store_close_date"), in_order("effective_start_date", "effective_end_date"),
            not_negative("floor_area_sqft"), not_negative("annual_rent_usd")],
        "customer_master": [
            required("customer_id"), required("customer_number"), mail_address("email"),
            not_after("date_of_birth", latest_customer_date), not_after("registration_date", latest_customer_date),
            required("country_code")],
        "sales_header": [
            required("transaction_id"), required("transaction_number"), required("customer_id"),
            required("store_id"), required("currency"), not_negative("gross_amount"),
            not_negative("total_discount"), not_negative("total_tax"), not_negative("net_total")],
        "sales_item": [
            required("transaction_line_id"), required("transaction_id"), required("sku_code"), positive("quantity"),
            not_negative("unit_price"), not_negative("discount_amount"), not_negative("tax_amount"),
            not_negative("line_total")],
    }
    return rules[table]


def length_rules(schema: T.StructType) -> list[Rule]:
    """One rule per text column with a declared length."""

    def too_long(name: str, limit: int) -> Rule:
        return Rule(f"{name} is longer than {limit}", lambda: F.length(name) > limit)

    return [too_long(f.name, f.metadata["max_length"]) for f in schema.fields if "max_length" in f.metadata]


def first_broken(rules: Sequence[Rule]) -> Column:
    """Name of the first rule a row breaks, NULL for a clean row."""
    return F.coalesce(*[F.when(rule.broken(), F.lit(rule.name)) for rule in rules])


def is_valid(rules: Sequence[Rule]) -> Column:
    """False as soon as one rule is broken; an undecided (NULL) rule passes."""
    head, *tail = rules
    chain = reduce(lambda case, rule: case.when(rule.broken(), False), tail, F.when(head.broken(), False))
    return chain.otherwise(True)


def rule_summary(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Per rule: how many rows break it, and how many break it first. One pass over ``df``."""
    first = df.select("*", first_broken(rules).alias("__first"))
    counts = first.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(rule.broken()).alias(f"any_{i}") for i, rule in enumerate(rules)],
        *[F.count_if(F.col("__first") == rule.name).alias(f"first_{i}") for i, rule in enumerate(rules)],
    )
    lines = F.array(*[
        F.struct(
            F.lit(i + 1).alias("rule_number"),
            F.lit(rule.name).alias("rule_name"),
            F.col(f"any_{i}").alias("broken_rows"),
            F.col(f"first_{i}").alias("first_broken_rows"),
        )
        for i, rule in enumerate(rules)
    ])
    return counts.select(F.lit(table).alias("table_name"), "rows", F.inline(lines)).withColumnRenamed(
        "rows", "total_rows"
    )
