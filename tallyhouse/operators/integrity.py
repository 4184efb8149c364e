"""Checks of keys, references and allowed values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.keys import grouped, is_hash_key, packed, unpacked
from tallyhouse.operators.lookup import small


@dataclass(frozen=True)
class Key:
    """Primary key of a gold table."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"pk_{self.table}"


@dataclass(frozen=True)
class Reference:
    """Foreign key from one gold table to another, on a column of the same name."""

    name: str
    table: str
    column: str
    parent: str


# The declared constraints.
KEYS = (
    Key("dim_customer", "customer_dim_key"),
    Key("dim_product", "product_dim_key"),
    Key("dim_store", "store_dim_key"),
    Key("dim_country", "country_dim_key"),
    Key("dim_date", "date_dim_key"),
    Key("fact_sales_header", "fact_sales_header_key"),
    Key("fact_sales_item", "fact_sales_item_key"),
)
REFERENCES = (
    Reference("fk_header_customer", "fact_sales_header", "customer_dim_key", "dim_customer"),
    Reference("fk_header_store", "fact_sales_header", "store_dim_key", "dim_store"),
    Reference("fk_header_country", "fact_sales_header", "country_dim_key", "dim_country"),
    Reference("fk_header_date", "fact_sales_header", "date_dim_key", "dim_date"),
    Reference("fk_item_header", "fact_sales_item", "fact_sales_header_key", "fact_sales_header"),
    Reference("fk_item_product", "fact_sales_item", "product_dim_key", "dim_product"),
)


def key_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows without a key, values used more than once, and rows beyond the first use."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    groups = grouped(df.select(*columns), columns, F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(missing, F.col("__n"))), F.lit(0)).alias("null_rows"),
        F.count_if(~missing & (F.col("__n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(~missing, F.col("__n") - 1)), F.lit(0)).alias("surplus_rows"),
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Key values of ``child`` without a row in ``parent``, with their row counts.

    Rows are counted per key before the join, so a hot key crosses the network as one
    row per map task, hash keys as bytes. A NULL reference points nowhere and is no orphan.
    """
    hashed = is_hash_key(child, child_key) and is_hash_key(parent, parent_key)
    met = packed if hashed else F.col
    used = (child.filter(F.col(child_key).isNotNull())
            .groupBy(met(child_key).alias("missing_key")).agg(F.count(F.lit(1)).alias("orphan_rows")))
    known = parent.select(met(parent_key).alias("missing_key"))
    lost = used.join(known, "missing_key", "left_anti")
    return lost.withColumn("missing_key", unpacked("missing_key")) if hashed else lost


def orphan_rows(child: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """``reference`` and ``orphan_rows`` of several references of one table: column, parent, column there.

    Parents small enough to broadcast are looked up in one scan of the child; a larger one
    is met by the child's keys, counted before.
    """
    near = {n: r for n, r in references.items() if small(r[1])}
    lines = [
        orphans(child, parent, column, other).agg(F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("orphan_rows"))
        .select(F.lit(name).alias("reference"), "orphan_rows")
        for name, (column, parent, other) in references.items() if name not in near]
    if near:
        df = child.select(*dict.fromkeys(column for column, _, _ in near.values()))
        for i, (column, parent, other) in enumerate(near.values()):
            known = parent.select(F.col(other).alias(f"__key_{i}")).distinct()
            df = df.join(F.broadcast(known), F.col(column) == F.col(f"__key_{i}"), "left")
        counts = df.agg(*[F.count_if(F.col(column).isNotNull() & F.col(f"__key_{i}").isNull()).alias(f"__{i}") for i, (column, _, _) in enumerate(near.values())])
        pairs = F.array(*[F.struct(F.lit(n).alias("reference"), F.col(f"__{i}").alias("orphan_rows")) for i, n in enumerate(near)])
        lines.append(counts.select(F.inline(pairs)))
    return reduce(DataFrame.unionByName, lines)


def dropped_rows(child: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """What an inner join on each of several references drops: ``reference``, ``orphan_keys``, ``orphan_rows``, ``null_rows``.

    A reference is column, parent, column there. ``child`` holds the rows that reach the join:
    for a fact, the valid ones. Parents small enough to broadcast are looked up in one scan of
    the child, from which only misses go on, counted by key; a larger one is met by the child's
    keys, counted before, missing ones among them.
    """
    near = {n: r for n, r in references.items() if small(r[1])}
    names = F.array(*[F.struct(F.lit(n).alias("reference"), F.lit(None).cast("string").alias("k"), F.lit(0).cast("long").alias("n")) for n in references])
    counts = [child.sparkSession.range(1).select(F.inline(names))]
    for name, (column, parent, other) in references.items():
        if name not in near:
            used = child.groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
            missing = used.join(parent.select(F.col(other).alias("k")), "k", "left_anti")
            counts.append(missing.select(F.lit(name).alias("reference"), F.col("k").cast("string").alias("k"), "n"))
    if near:
        df = child.select(*dict.fromkeys(column for column, _, _ in near.values()))
        misses = []
        for i, (name, (column, parent, other)) in enumerate(near.items()):
            known = parent.select(F.col(other).alias(f"__key_{i}")).distinct()
            df = df.join(F.broadcast(known), F.col(column) == F.col(f"__key_{i}"), "left")
            miss = F.struct(F.lit(name).alias("reference"), F.col(column).cast("string").alias("k"))
            misses.append(F.when(F.col(f"__key_{i}").isNull(), miss))
        found = df.select(F.inline(F.filter(F.array(*misses), lambda m: m.isNotNull())))
        counts.append(found.groupBy("reference", "k").agg(F.count(F.lit(1)).alias("n")))
    both = reduce(DataFrame.unionByName, counts)
    total = lambda rows: F.coalesce(F.sum(F.when(rows, F.col("n"))), F.lit(0))
    return both.groupBy("reference").agg(
        F.count("k").alias("orphan_keys"), total(F.col("k").isNotNull()).alias("orphan_rows"), total(F.col("k").isNull()).alias("null_rows"))


def orphan_summary(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, label: str) -> DataFrame:
    """:func:`dropped_rows` of one reference."""
    return dropped_rows(child, {label: (child_key, parent, parent_key)})


def values_outside(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Values that are not in the declared list, with their row counts."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
            .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows")))


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared key and reference with the number of rows that break it."""
    lines = []
    for key in KEYS:
        bad = key_violations(tables[key.table], [key.column])
        lines.append(bad.select(
            F.lit(key.table).alias("table_name"), F.lit(key.name).alias("constraint_name"),
            F.lit("PRIMARY KEY").alias("constraint_type"), (F.col("null_rows") + F.col("surplus_rows")).alias("violations")))
    for table in dict.fromkeys(r.table for r in REFERENCES):
        found = orphan_rows(tables[table], {r.name: (r.column, tables[r.parent], r.column) for r in REFERENCES if r.table == table})
        lines.append(found.select(
            F.lit(table).alias("table_name"), F.col("reference").alias("constraint_name"),
            F.lit("FOREIGN KEY").alias("constraint_type"), F.col("orphan_rows").alias("violations")))
    return reduce(DataFrame.unionByName, lines).orderBy("table_name", "constraint_type", "constraint_name")
