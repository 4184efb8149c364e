"""The eight standard questions, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.plans.metrics import Metric, Model


def total_sales_by_region(model: Model) -> DataFrame:
    return model.query({"total_sales": "total_net_sales"}, {"region": "dim_country.region_name"},
                       order_by=["-total_sales"])


def top_10_products(model: Model) -> DataFrame:
    return model.query({"revenue": "total_line_revenue", "units_sold": "total_units_sold"},
                       {"product": "dim_product.model_name", "category": "dim_product.category_name"},
                       order_by=["-revenue"], limit=10)


def monthly_sales_trend(model: Model) -> DataFrame:
    return model.query({"net_sales": "total_net_sales", "transactions": "total_transactions"},
                       {"month": "dim_date.year_month"}, order_by=["month"])


def sales_by_loyalty_tier(model: Model) -> DataFrame:
    return model.query({"transactions": "total_transactions", "total_sales": "total_net_sales",
                        "avg_transaction": "average_transaction_value"},
                       {"loyalty_tier": "dim_customer.loyalty_tier"}, order_by=["-total_sales"])


def top_stores(model: Model) -> DataFrame:
    return model.query({"transactions": Metric("count"), "total_sales": "total_net_sales"},
                       {"store": "dim_store.store_name", "city": "dim_store.store_city",
                        "format": "dim_store.store_format"},
                       order_by=["-total_sales"], limit=10, base="fact_sales_header")


def sales_by_category(model: Model) -> DataFrame:
    return model.query({"units_sold": "total_units_sold", "revenue": "total_line_revenue"},
                       {"category": "dim_product.category_name"}, order_by=["-revenue"])


def sales_by_channel(model: Model) -> DataFrame:
    return model.query({"transactions": "total_transactions", "total_sales": "total_net_sales",
                        "avg_order_value": "average_transaction_value"}, {"channel": "fact_sales_header.channel"})


def quarterly_sales(model: Model) -> DataFrame:
    return model.query({"total_sales": "total_net_sales"}, {"quarter": "dim_date.year_quarter"},
                       order_by=["quarter"])


# The questions as they are asked.
QUESTIONS = {
    "What are the total sales by region?": total_sales_by_region,
    "What are the top 10 products by revenue?": top_10_products,
    "Show me the monthly sales trend": monthly_sales_trend,
    "What are sales by customer loyalty tier?": sales_by_loyalty_tier,
    "Which stores have the highest sales?": top_stores,
    "What are sales by product category?": sales_by_category,
    "Compare sales between POS and Web channels": sales_by_channel,
    "What are sales by quarter?": quarterly_sales,
}
