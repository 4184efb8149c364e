"""Descriptions of computed gold columns; columns taken from raw tables bring their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEXT = """
country_dim_key          hash key of the country
product_dim_key          hash key of the article
store_dim_key            hash key of the store
customer_dim_key         hash key of the customer
date_dim_key             hash key of the day
bridge_key               hash key of the article and country pair
fact_sales_header_key    hash key of the transaction
fact_sales_item_key      hash key of the line
effective_start_ts       start of the version
effective_end_ts         end of the version, far in the future while in use
is_current               true for the version in use
__source_load_ts         load time of the source row
sku_launch_date          first day of sale anywhere
sku_is_active            Y or N, of the article
model_launch_date        day of launch of the model
model_discontinue_date   last day of sale of the model
family_launch_year       year of launch of the family
date_key                 the day itself
year_number              calendar year
quarter_number           calendar quarter, 1 to 4
month_number             month, 1 to 12
week_number              ISO week, 1 to 53
day_of_year              day in the year, 1 to 366
day_of_month             day in the month, 1 to 31
day_of_week              0 for Sunday to 6 for Saturday
year_name                year as text
quarter_name             Q1 to Q4
month_name               month in full
month_short_name         month in three letters
day_name                 weekday in three letters
year_month               year and month, 2024-03
year_quarter             year and quarter, 2024-Q1
fiscal_year              year from April to March, named by its first year
fiscal_quarter           1 for April to June, 4 for January to March
is_weekend               true on Saturday and Sunday
is_holiday               always false, no holidays are known
transaction_count        number of transactions
line_count               number of lines
total_gross_amount       amount before discount and tax
total_net_sales          amount paid
avg_transaction_value    amount paid per transaction
unique_customers         buyers, each counted once
active_stores            stores with a sale
selling_days             days with a sale
week_start_date          first day with a sale
week_end_date            last day with a sale
month_start_date         first day with a sale
month_end_date           last day with a sale
"""

COMMENTS = dict(line.split(None, 1) for line in TEXT.strip().splitlines())


def described(df: DataFrame) -> DataFrame:
    """``df`` with a comment on every column that has none and whose name is known."""
    return df.select(*[
        F.col(f.name).alias(f.name, metadata={**f.metadata, "comment": COMMENTS[f.name]})
        if f.name in COMMENTS and "comment" not in f.metadata else F.col(f.name)
        for f in df.schema.fields
    ])
