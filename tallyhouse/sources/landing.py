"""Landed CSV files: listing, reading by position and numbering the rows of each file."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import FILE_NAME, LOAD_TS, ROW_NUMBER, RawTable
from tallyhouse.sources.tables import append

# One header line, fields optionally in double quotes, a quote inside is doubled.
CSV = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "true", "mode": "FAILFAST"}

BLOCK, SEQUENCE = "__block", "__sequence"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Path, size and time of every landed file; file contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(folder))
    return files.select("path", "length", "modificationTime")


def clean_name(name: str) -> str:
    """Header text as a column name: lower case, no blanks or special characters."""
    return re.sub(r"[^0-9a-z_]+", "_", name.strip().lower()).strip("_")


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A file without a declared shape: types from the data, names from a cleaned header."""
    df = spark.read.options(**{**CSV, "enforceSchema": "false"}).option("inferSchema", "true").csv(path)
    return df.toDF(*[clean_name(c) for c in df.columns])


def file_schema(spec: RawTable) -> T.StructType:
    """All columns of the file: a shorter schema would make every row malformed.

    Booleans are read as text, so that Y, 1 and TRUE all convert by the usual cast.
    """
    columns = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType)
        for f in spec.loaded
    ]
    return T.StructType(columns + [T.StructField(f"__rest_{i}", T.StringType()) for i in range(spec.trailing)])


def with_origin(df: DataFrame, spec: RawTable, root: str) -> DataFrame:
    """The loaded columns, the file a row came from and the split of the file it was in."""
    # the path is an encoded URI; a plus sign stands for itself there, which url_decode does not know
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in spec.loaded],
        F.substring_index(path, f"{root.rstrip('/')}/", -1).alias(FILE_NAME),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def read_by_position(
    spark: SparkSession, spec: RawTable, path: str, root: str = "", multiline: bool = False
) -> DataFrame:
    """Columns are bound by position, header names are ignored; a bad value stops the load.

    ``multiline`` allows line breaks inside quotes; such a file is read by one task.
    """
    df = spark.read.schema(file_schema(spec)).options(**CSV).option("multiLine", multiline).csv(path)
    return with_origin(df, spec, root)


def number_rows(df: DataFrame, spec: RawTable, load_ts: datetime | None = None) -> DataFrame:
    """Raw table rows with file name, row number in the file and load time.

    A first pass over the files, which reads no column, counts the rows of each file split;
    splits are cut the same way in every pass. The rows of the splits before a row and its
    place in its own give its number, so no file, however large, passes through one task,
    and nothing is written in between.
    """
    stamp = F.lit(load_ts) if load_ts else F.current_timestamp()
    parsed = df.select("*", F.monotonically_increasing_id().alias(SEQUENCE))
    before = Window.partitionBy(FILE_NAME).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    splits = parsed.groupBy(FILE_NAME, BLOCK).agg(
        F.min(SEQUENCE).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    splits = splits.select(FILE_NAME, BLOCK, "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    numbered = parsed.withColumn(LOAD_TS, stamp.cast("timestamp_ntz")).join(splits, [FILE_NAME, BLOCK])
    number = F.col(SEQUENCE) - F.col("__first") + F.col("__before") + 1
    audit = {FILE_NAME: F.col(FILE_NAME), ROW_NUMBER: number, LOAD_TS: F.col(LOAD_TS)}
    return numbered.select(*[
        audit.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in spec.schema
    ])


def load(
    spark: SparkSession,
    spec: RawTable,
    path: str,
    target: str,
    load_ts: datetime | None = None,
    root: str = "",
    multiline: bool = False,
    load: str | None = None,
) -> None:
    """Append the rows of the files at ``path`` to the raw table at ``target``."""
    append(number_rows(read_by_position(spark, spec, path, root, multiline), spec, load_ts), target, load)
