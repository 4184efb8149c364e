"""Shapes of the thirteen raw tables.

Each line below is one column: name, type, description. ``v20`` is text of at
most 20 characters, ``d12.2`` a decimal. The declared length is kept as field
metadata, where the length rules of the quality module find it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

FILE_NAME, ROW_NUMBER, LOAD_TS = "__file_name", "__row_number", "__load_ts"

AUDIT = """
__file_name    v500  file the row was read from
__row_number   long  position of the row in that file
__load_ts      ntz   moment of the load, one value per load
"""

_PLAIN = {
    "date": T.DateType(),
    "ntz": T.TimestampNTZType(),
    "bool": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
}


def _fields(text: str) -> list[T.StructField]:
    fields = []
    for line in text.strip().splitlines():
        name, kind, comment = line.split(None, 2)
        meta = {"comment": comment}
        if kind in _PLAIN:
            dtype = _PLAIN[kind]
        elif kind.startswith("d"):
            precision, scale = kind[1:].split(".")
            dtype = T.DecimalType(int(precision), int(scale))
        else:
            dtype = T.StringType()
            meta["max_length"] = int(kind[1:])
        fields.append(T.StructField(name, dtype, True, meta))
    return fields


@dataclass(frozen=True)
class RawTable:
    """One raw table: its business key, its file and the columns loaded from it."""

    name: str
    keys: tuple[str, ...]
    folder: str
    text: str
    trailing: int = 0  # columns at the end of the file that are not loaded

    @property
    def file(self) -> str:
        return f"{self.folder}/{self.name}.csv"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in _fields(self.text)]

    @property
    def loaded(self) -> T.StructType:
        return T.StructType(_fields(self.text))

    @property
    def schema(self) -> T.StructType:
        return T.StructType(_fields(self.text) + _fields(AUDIT))


REGION = RawTable("region_master", ("region_code",), "country-master", """
region_code           v10   region code
region_name           v100  region name
is_active             v1    Y or N
effective_start_date  date  first day in use
effective_end_date    date  last day in use
created_at            ntz   creation time at the source
source_system         v50   system of origin
""")

CURRENCY = RawTable("currency_master", ("currency_code",), "country-master", """
currency_code         v3    currency code
currency_name         v100  currency name
currency_symbol       v5    sign shown with amounts
minor_unit            int   digits after the point
is_active             v1    Y or N
effective_start_date  date  first day in use
effective_end_date    date  last day in use
created_at            ntz   creation time at the source
source_system         v50   system of origin
""")

TAX = RawTable("tax_master", ("tax_code",), "country-master", """
tax_code              v20   tax code
tax_type              v20   kind of tax
tax_rate              d5.4  rate as a fraction
tax_inclusive_flag    v1    Y when prices contain the tax
effective_start_date  date  first day in use
effective_end_date    date  last day in use
is_active             v1    Y or N
created_at            ntz   creation time at the source
source_system         v50   system of origin
""")

COUNTRY = RawTable("country_master", ("country_code",), "country-master", """
country_code            v3    country code
country_name            v100  country name
region_code             v10   region of the country
currency_code           v3    currency of the country
tax_code                v20   tax of the country
primary_language        v50   main language
timezone                v50   main time zone
ecommerce_supported     v1    Y when sold online
retail_store_supported  v1    Y when sold in stores
market_tier             v10   market class
""", trailing=7)

CATEGORY = RawTable("product_category_master", ("category_code",), "product-master", """
category_code         v10   category code
category_name         v100  category name
reporting_segment     v50   segment in financial reports
is_active             v1    Y or N
effective_start_date  date  first day in use
effective_end_date    date  last day in use
created_at            ntz   creation time at the source
source_system         v50   system of origin
""")

FAMILY = RawTable("product_family_master", ("family_code",), "product-master", """
family_code       v20   family code
family_name       v100  family name
category_code     v10   category of the family
launch_year       int   year of launch
is_active         v1    Y or N
lifecycle_status  v20   stage of life
created_at        ntz   creation time at the source
source_system     v50   system of origin
""")

MODEL = RawTable("product_model_master", ("model_code",), "product-master", """
model_code        v20   model code
model_name        v100  model name
family_code       v20   family of the model
launch_date       date  day of launch
discontinue_date  date  last day of sale
lifecycle_status  v20   stage of life
is_active         v1    Y or N
created_at        ntz   creation time at the source
source_system     v50   system of origin
""")

SKU = RawTable("product_sku_master", ("sku_code",), "product-master", """
sku_code            v30   article code
model_code          v20   model of the article
variant             v50   size and colour
price_tier          v20   price class
global_launch_date  date  first day of sale anywhere
is_active           v1    Y or N
created_at          ntz   creation time at the source
source_system       v50   system of origin
""")

AVAILABILITY = RawTable("product_country_availability", ("sku_code", "country_code"), "product-master", """
sku_code                v30   article code
country_code            v3    country code
local_launch_date       date  first day of sale there
local_discontinue_date  date  last day of sale there
is_available            v1    Y or N
created_at              ntz   creation time at the source
source_system           v50   system of origin
""")

STORE = RawTable("store_master", ("store_code",), "store-master", """
store_code             v20    store code
store_name             v100   store name
country_code           v3     country of the store
region_code            v10    region of the store
tax_jurisdiction_code  v20    tax area of the store
format_code            v10    kind of store
city                   v100   city
state_code             v10    state or province
postal_code            v20    postal code
address_line1          v200   street address
latitude               d10.6  degrees north
longitude              d10.6  degrees east
store_open_date        date   opening day
store_close_date       date   closing day
lifecycle_status       v20    stage of life
floor_area_sqft        long   floor area in square feet
annual_rent_usd        long   rent per year in dollars
is_active              v1     Y or N
effective_start_date   date   first day in use
effective_end_date     date   last day in use
""", trailing=2)

CUSTOMER = RawTable("customer_master", ("customer_id",), "customer-master", """
customer_id         v50   customer id
customer_number     v20   number shown to the customer
first_name          v100  first name
last_name           v100  last name
full_name           v200  name in full
gender              v20   gender
date_of_birth       date  day of birth
email               v200  mail address
phone_number        v50   phone number
street_address      v300  street address
city                v100  city
state_province      v100  state or province
postal_code         v20   postal code
country_code        v3    country code
country_name        v100  country name
region              v10   region code
preferred_language  v50   language of choice
customer_segment    v50   segment
loyalty_tier        v20   tier, the text None for no tier
registration_date   date  day of sign-up
is_active           bool  account in use
source_system       v50   system of origin
record_source       v50   channel of origin
created_at          date  creation day at the source
updated_at          ntz   last change at the source
""")

SALES_HEADER = RawTable("sales_header", ("transaction_id",), "sales-transaction", """
transaction_id         v50    transaction id
transaction_number     v20    number on the receipt
transaction_timestamp  date   day of sale
customer_id            v50    buyer
store_id               v20    store
channel_id             v10    channel of sale
payment_method         v50    means of payment
currency               v3     currency of all amounts
gross_amount           d12.2  amount before discount and tax
total_discount         d12.2  discount
total_tax              d12.2  tax
net_total              d12.2  amount paid
created_at             date   creation day at the source
""")

SALES_ITEM = RawTable("sales_item", ("transaction_line_id",), "sales-transaction", """
transaction_line_id  v20    line id
transaction_id       v50    transaction of the line
sku_code             v30    article sold
quantity             long   pieces sold
unit_price           d12.2  price of one piece
discount_amount      d12.2  discount on the line
tax_amount           d12.2  tax on the line
line_total           d12.2  amount paid for the line
created_at           date   creation day at the source
""")

RAW_TABLES = {
    t.name: t
    for t in (REGION, CURRENCY, TAX, COUNTRY, CATEGORY, FAMILY, MODEL, SKU, AVAILABILITY,
              STORE, CUSTOMER, SALES_HEADER, SALES_ITEM)
}
