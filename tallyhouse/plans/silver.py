"""Silver tables: newest row per key, flagged by the rules; bad rows are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.latest import keep_latest
from tallyhouse.operators.quality import FLAG, LATEST_CUSTOMER_DATE, is_valid, rules_for
from tallyhouse.schemas import FILE_NAME, LOAD_TS, RAW_TABLES, ROW_NUMBER

SOURCE_ROW, BRONZE_TS = "__source_row_number", "__bronze_load_ts"


def flagged(latest: DataFrame, table: str, latest_customer_date: str = LATEST_CUSTOMER_DATE) -> DataFrame:
    """Validity flag and silver names of the audit columns, for rows that are already the newest."""
    spec = RAW_TABLES[table]
    return latest.select(
        *spec.columns,
        is_valid(rules_for(table, latest_customer_date)).alias(FLAG),
        FILE_NAME,
        F.col(ROW_NUMBER).alias(SOURCE_ROW),
        F.col(LOAD_TS).alias(BRONZE_TS),
    )


def silver(raw: DataFrame, table: str, latest_customer_date: str = LATEST_CUSTOMER_DATE) -> DataFrame:
    """The newest row wins before its validity is looked at, so a bad reload hides a good row."""
    return flagged(keep_latest(raw, RAW_TABLES[table].keys), table, latest_customer_date)


def valid(df: DataFrame) -> DataFrame:
    """Only valid rows go on to gold."""
    return df.filter(F.col(FLAG))
