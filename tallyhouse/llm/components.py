"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the smallest of them.

    The smallest neighbour is found by a grouped minimum (combined before the shuffle) and
    joined back, so a node with very many neighbours is never collected anywhere.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``root`` (the smallest id that can be reached) of every node of ``edges`` (a, b).

    Rounds end when a round changes nothing; each round's edges are a written table.
    """
    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = kept_table(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    while before[0]:
        edges = kept_table(_stars(_stars(edges, True), False))
        after = state(edges)
        if tuple(after) == tuple(before):
            break
        before = after
    roots = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
