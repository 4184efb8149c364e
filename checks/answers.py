"""Names, columns, relationships and metrics of the model, written out for the SQL answers.

Nothing here is read from the registry under test.
"""

# logical table -> kind -> "logical name=column[:mark]"; marks as in the column lists
COLUMNS = {
    "dim_customer": {
        "dimensions": (
            "customer_key=customer_dim_key customer_id=customer_id customer_number=customer_number "
            "customer_name=full_name first_name=first_name last_name=last_name gender=gender email=email "
            "city=city state=state_province country=country_name country_code=country_code region=region "
            "customer_segment=customer_segment loyalty_tier=loyalty_tier is_active=is_active "),
        "times": (
            "registration_date=registration_date:d date_of_birth=date_of_birth:d "),
    },
    "dim_product": {
        "dimensions": (
            "product_key=product_dim_key sku_code=sku_code variant=variant price_tier=price_tier "
            "model_code=model_code model_name=model_name lifecycle_status=lifecycle_status "
            "family_code=family_code family_name=family_name category_code=category_code "
            "category_name=category_name reporting_segment=reporting_segment "),
        "times": (
            "sku_launch_date=sku_launch_date:d model_launch_date=model_launch_date:d "),
    },
    "dim_store": {
        "dimensions": (
            "store_key=store_dim_key store_code=store_code store_name=store_name store_format=format_code "
            "store_city=city store_state=state_code store_country=country_code store_region=region_code "
            "store_status=lifecycle_status is_active=is_active "),
        "times": (
            "store_open_date=store_open_date:d "),
        "row_facts": (
            "floor_area_sqft=floor_area_sqft:i annual_rent_usd=annual_rent_usd:i "),
    },
    "dim_country": {
        "dimensions": (
            "country_key=country_dim_key country_code=country_code country_name=country_name "
            "region_code=region_code region_name=region_name currency_code=currency_code "
            "currency_name=currency_name currency_symbol=currency_symbol tax_type=tax_type "
            "market_tier=market_tier "),
        "row_facts": (
            "tax_rate=tax_rate:n "),
    },
    "dim_date": {
        "dimensions": (
            "date_key=date_dim_key year=year_number:i quarter=quarter_number:i quarter_name=quarter_name "
            "month=month_number:i month_name=month_name week=week_number:i day_of_week=day_of_week:i "
            "day_name=day_name year_month=year_month year_quarter=year_quarter fiscal_year=fiscal_year:i "
            "fiscal_quarter=fiscal_quarter:i is_weekend=is_weekend "),
        "times": (
            "date=date_key:d "),
    },
    "fact_sales_header": {
        "dimensions": (
            "fact_header_key=fact_sales_header_key customer_dim_key=customer_dim_key "
            "store_dim_key=store_dim_key country_dim_key=country_dim_key date_dim_key=date_dim_key "
            "transaction_id=transaction_id transaction_number=transaction_number channel=channel_id "
            "payment_method=payment_method currency=currency "),
        "times": (
            "transaction_date=transaction_timestamp:d "),
        "row_facts": (
            "gross_amount=gross_amount:n discount_amount=total_discount:n tax_amount=total_tax:n "
            "net_amount=net_total:n "),
    },
    "fact_sales_item": {
        "dimensions": (
            "fact_item_key=fact_sales_item_key fact_header_key=fact_sales_header_key "
            "customer_dim_key=customer_dim_key product_dim_key=product_dim_key store_dim_key=store_dim_key "
            "country_dim_key=country_dim_key date_dim_key=date_dim_key line_id=transaction_line_id "
            "transaction_id=transaction_id channel=channel_id "),
        "times": (
            "transaction_date=transaction_timestamp:d "),
        "row_facts": (
            "quantity=quantity:i unit_price=unit_price:n line_discount=discount_amount:n "
            "line_tax=tax_amount:n line_total=line_total:n "),
    },
}

# logical table -> its key
KEYS = {
    "dim_customer": ("customer_key", "customer_dim_key"),
    "dim_product": ("product_key", "product_dim_key"),
    "dim_store": ("store_key", "store_dim_key"),
    "dim_country": ("country_key", "country_dim_key"),
    "dim_date": ("date_key", "date_dim_key"),
    "fact_sales_header": ("fact_header_key", "fact_sales_header_key"),
    "fact_sales_item": ("fact_item_key", "fact_sales_item_key"),
}

# name -> from table, to table, column on both sides
LINKS = {
    "header_to_customer": ("fact_sales_header", "dim_customer", "customer_dim_key"),
    "header_to_store": ("fact_sales_header", "dim_store", "store_dim_key"),
    "header_to_country": ("fact_sales_header", "dim_country", "country_dim_key"),
    "header_to_date": ("fact_sales_header", "dim_date", "date_dim_key"),
    "item_to_header": ("fact_sales_item", "fact_sales_header", "fact_sales_header_key"),
    "item_to_product": ("fact_sales_item", "dim_product", "product_dim_key"),
    "item_to_customer": ("fact_sales_item", "dim_customer", "customer_dim_key"),
    "item_to_store": ("fact_sales_item", "dim_store", "store_dim_key"),
    "item_to_country": ("fact_sales_item", "dim_country", "country_dim_key"),
    "item_to_date": ("fact_sales_item", "dim_date", "date_dim_key"),
}

# declared values: table -> dimension, column, values
VALUES = [
    ("dim_customer", "gender", "gender", ("Male", "Female")),
    ("dim_customer", "region", "region", ("AMER", "EMEA", "APAC", "JAPAN")),
    ("dim_customer", "customer_segment", "customer_segment", ("Consumer", "Business")),
    ("dim_customer", "loyalty_tier", "loyalty_tier", ("None", "Silver", "Gold", "Platinum")),
    ("dim_product", "price_tier", "price_tier", ("Standard", "Premium")),
    ("dim_product", "lifecycle_status", "lifecycle_status", ("ACTIVE", "DISCONTINUED")),
    ("dim_product", "reporting_segment", "reporting_segment", ("Hardware", "Services", "Accessories")),
    ("dim_store", "store_format", "format_code", ("MALL", "MINI", "FLAGSHIP")),
    ("dim_store", "store_status", "lifecycle_status", ("ACTIVE", "CLOSED")),
    ("dim_country", "country_name", "country_name", ("United States", "United Kingdom", "Japan", "China", "India")),
    ("dim_country", "region_name", "region_name", ("Americas", "Europe Middle East Africa", "Asia Pacific", "Japan")),
    ("dim_country", "tax_type", "tax_type", ("VAT", "GST", "SALES_TAX")),
    ("dim_date", "quarter_name", "quarter_name", ("Q1", "Q2", "Q3", "Q4")),
    ("fact_sales_header", "channel", "channel_id", ("POS", "WEB")),
]

# metric -> name of the group, SQL of the group, SQL of the metric, tables
METRICS = {
    "customer_count": ("customer_segment", "customer_segment", "count(DISTINCT customer_id)", "g_dim_customer"),
    "product_count": ("category_name", "category_name", "count(DISTINCT sku_code)", "g_dim_product"),
    "store_count": ("store_format", "format_code", "count(DISTINCT store_code)", "g_dim_store"),
    "total_floor_area": ("store_format", "format_code", "CAST(sum(floor_area_sqft) AS BIGINT)", "g_dim_store"),
    "total_annual_rent": ("store_format", "format_code", "CAST(sum(annual_rent_usd) AS BIGINT)", "g_dim_store"),
    "country_count": ("region_name", "region_name", "count(DISTINCT country_code)", "g_dim_country"),
    "total_transactions": ("year_quarter", "year_quarter", "count(DISTINCT transaction_id)", "g_fact_sales_header JOIN g_dim_date USING (date_dim_key)"),
    "total_gross_sales": ("year_quarter", "year_quarter", "CAST(sum(gross_amount) AS DOUBLE)", "g_fact_sales_header JOIN g_dim_date USING (date_dim_key)"),
    "total_discounts": ("year_quarter", "year_quarter", "CAST(sum(total_discount) AS DOUBLE)", "g_fact_sales_header JOIN g_dim_date USING (date_dim_key)"),
    "total_tax": ("year_quarter", "year_quarter", "CAST(sum(total_tax) AS DOUBLE)", "g_fact_sales_header JOIN g_dim_date USING (date_dim_key)"),
    "total_net_sales": ("year_quarter", "year_quarter", "CAST(sum(net_total) AS DOUBLE)", "g_fact_sales_header JOIN g_dim_date USING (date_dim_key)"),
    "average_transaction_value": ("year_quarter", "year_quarter", "CAST(sum(net_total) AS DOUBLE) / count(net_total)", "g_fact_sales_header JOIN g_dim_date USING (date_dim_key)"),
    "total_units_sold": ("price_tier", "price_tier", "CAST(sum(quantity) AS BIGINT)", "g_fact_sales_item JOIN g_dim_product USING (product_dim_key)"),
    "total_line_revenue": ("price_tier", "price_tier", "CAST(sum(line_total) AS DOUBLE)", "g_fact_sales_item JOIN g_dim_product USING (product_dim_key)"),
    "total_line_discounts": ("price_tier", "price_tier", "CAST(sum(discount_amount) AS DOUBLE)", "g_fact_sales_item JOIN g_dim_product USING (product_dim_key)"),
    "total_line_tax": ("price_tier", "price_tier", "CAST(sum(tax_amount) AS DOUBLE)", "g_fact_sales_item JOIN g_dim_product USING (product_dim_key)"),
    "average_unit_price": ("price_tier", "price_tier", "CAST(sum(unit_price) AS DOUBLE) / count(unit_price)", "g_fact_sales_item JOIN g_dim_product USING (product_dim_key)"),
    "total_line_items": ("price_tier", "price_tier", "count(*)", "g_fact_sales_item JOIN g_dim_product USING (product_dim_key)"),
}
