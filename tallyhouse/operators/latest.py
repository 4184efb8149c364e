"""Keep the newest row of every business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.schemas import FILE_NAME, LOAD_TS, ROW_NUMBER


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str] = (LOAD_TS, ROW_NUMBER, FILE_NAME),
) -> DataFrame:
    """One row per key: the first by ``newest`` descending, NULLs counting as newest.

    The file name comes last: of rows with one number in two files of one load the same
    one is picked every time.

    Rows whose key is NULL form one group. Spark turns ``row_number() = 1`` into a
    window group limit before the shuffle, so each map task sends at most one row
    per key and a key with a third of all rows costs no task more than any other.
    """
    order = [F.desc_nulls_first(c) for c in newest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
