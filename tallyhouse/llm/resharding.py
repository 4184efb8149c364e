"""Resharding that moves the fewest bytes, by minimum-cost flow.

The old layout files every text by its hash, so equal texts lie together and shards are as
uneven as the texts. New capacities are equal. A minimum-cost flow from old sizes to new
capacities, where staying is free and moving costs its bytes, says how many bytes go from
which shard to which. The solver sees shards only, a few hundred edges at any data size.

Rows of an old shard are ordered in blocks, large rows first; what stays is the front, and
transfers are cut from the end, where rows are small and borders are met closely. Positions
come from two levels of sums: block totals, a table of bounded size, are added up on the
driver, rows within a block by a window. No shard is ever sorted by one task.

Defined results: null text has no bytes and counts 8, the size of its id. Equal rows are
placed one by one. Null ids are allowed. An empty table gives an empty result and no moves.
Other columns are ignored by the placement and kept by the rewrite, but for one named shard,
which the layout's takes the place of.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept_table, keyed
from tallyhouse.sources.tables import balanced, move, remove

SHARDS, OLD_SHARDS = 24, 20
TEXT_PARTS, ROW_PARTS = 8, 8  # blocks of a size class: by text, then by row, so that no text fills one alone
ROW_BYTES = 8


def min_cost_flow(old: list[int], new: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one: all of them, no more than capacities, fewest moved.

    Successive cheapest paths in the residual network. A path changes shard at most as often
    as there are shards, and each fills an edge or uses up a supply.
    """
    source, sink = -1, -2
    room: dict[tuple, int] = {}
    cost: dict[tuple, int] = {}
    near: dict[object, list] = defaultdict(list)

    def edge(a, b, capacity, price):
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            room[x, y], cost[x, y] = c, p
            near[x].append(y)
    for i, size in enumerate(old):
        edge(source, ("old", i), size, 0)
    for j, capacity in enumerate(new):
        edge(("new", j), sink, capacity, 0)
    total = sum(old)
    for i in range(len(old)):
        for j in range(len(new)):
            edge(("old", i), ("new", j), total, 0 if i == j else 1)
    while True:
        far, back, queue = {source: 0}, {}, deque([source])
        waiting = {source}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for b in near[a]:
                if room[a, b] and far[a] + cost[a, b] < far.get(b, 1 << 60):
                    far[b], back[b] = far[a] + cost[a, b], a
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        if sink not in far:
            break
        path, at = [], sink
        while at != source:
            path.append((back[at], at))
            at = back[at]
        push = min(room[e] for e in path)
        for a, b in path:
            room[a, b] -= push
            room[b, a] += push
    return {(i, j): room[("new", j), ("old", i)] for i in range(len(old)) for j in range(len(new)) if room[("new", j), ("old", i)]}


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _blocked(rows: DataFrame) -> DataFrame:
    """Narrow rows: key, size, checksum, old shard and block; blocks sort large rows first."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = text_size(F.col("text"))
    hashed = F.xxhash64(text)
    block = ((64 - F.floor(F.log2(size)).cast("int")) * TEXT_PARTS + F.pmod(F.shiftright(hashed, 20), F.lit(TEXT_PARTS)).cast("int")) * ROW_PARTS + F.pmod(F.xxhash64("_row"), F.lit(ROW_PARTS)).cast("int")
    return rows.select("_row", "doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.pmod(hashed, F.lit(OLD_SHARDS)).cast("int").alias("old_shard"), block.alias("block"))


def _small(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table of bounded size, at most a row for each block and shard, for a broadcast join."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def placements(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``_row``, ``doc_id``, ``size``, ``text_crc32``, ``old_shard``, ``shard``, ``slot`` of keyed rows."""
    spark = rows.sparkSession
    rows = kept_table(_blocked(rows))
    totals = sorted(tuple(r) for r in rows.groupBy("old_shard", "block").agg(F.sum("size")).collect())
    old = [0] * OLD_SHARDS
    begins = []
    for shard, block, size in totals:
        begins.append((shard, block, old[shard]))
        old[shard] += size
    total = sum(old)
    flow = min_cost_flow(old, [total // shards + (j < total % shards) for j in range(shards)])
    parts = []
    for i in range(OLD_SHARDS):
        at = 0
        for j in sorted((j for k, j in flow if k == i), key=lambda j: (j != i, j)):  # what stays comes first
            parts.append((i, at, at + flow[i, j], j))
            at += flow[i, j]
    cuts: dict[int, list] = defaultdict(list)
    for i, a, b, j in parts:
        cuts[i].append((b, j))
    window = Window.partitionBy("old_shard", "block").orderBy(F.desc("size"), "_row")
    placed = rows.join(_small(spark, begins, "old_shard int, block int, begin long"), ["old_shard", "block"])
    placed = placed.withColumns({"_number": F.row_number().over(window), "_middle": F.col("begin") + F.sum("size").over(window) - F.floor(F.col("size") / 2)})
    ends = _small(spark, [(i, [b for b, _ in c], [j for _, j in c]) for i, c in cuts.items()], "old_shard int, ends array<long>, targets array<int>")
    placed = placed.join(ends, "old_shard").withColumn("shard", F.coalesce(F.get("targets", F.size(F.filter("ends", lambda e: e < F.col("_middle")))), F.element_at("targets", -1)))
    placed = kept_table(placed.select("_row", "doc_id", "size", "text_crc32", "old_shard", "block", "shard", "_number"))
    runs = sorted(tuple(r) for r in placed.groupBy("shard", "old_shard", "block").agg(F.count(F.lit(1)), F.min("_number")).collect())
    slots, offsets = defaultdict(int), []
    for shard, i, block, count, first in runs:
        offsets.append((shard, i, block, slots[shard] - first))
        slots[shard] += count
    out = placed.join(_small(spark, offsets, "shard int, old_shard int, block int, offset long"), ["shard", "old_shard", "block"])
    return out.select("_row", "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("offset") + F.col("_number")).alias("slot"))


def layout(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Where every row goes under the law of equal bytes."""
    return placements(keyed(docs), shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def write_old(docs: DataFrame, path: str) -> None:
    """The old layout as folders ``shard=<n>`` below ``path``."""
    old = F.pmod(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(OLD_SHARDS)).cast("int")
    balanced(docs.withColumn("shard", old), ["shard"]).write.partitionBy("shard").mode("overwrite").parquet(path)


def rewrite(docs: DataFrame, path: str, shards: int = SHARDS) -> list[int]:
    """Bring the folders below ``path`` from the old layout of ``docs`` to the new; returns the shards that were rewritten.

    Folders of shards that neither give nor take rows are left alone. The others are written
    beside ``path``, large shards by several tasks, and then take the place of the old
    folders one by one; the folder of a shard that lost its last row goes. ``docs`` are not
    read from ``path``, so a run that breaks off is repeated as a whole.
    """
    spark = docs.sparkSession
    rows = kept_table(keyed(docs, rest=True))
    placed = kept_table(placements(rows, shards))
    moved = placed.where("shard <> old_shard")
    affected = sorted({r[0] for r in moved.select("shard").union(moved.select("old_shard")).distinct().collect()})
    if affected:
        new = rows.select("_row", "_rest").join(placed.where(F.col("shard").isin(affected)).select("_row", "shard"), "_row")
        out = new.select(*[F.col("_rest")[c].alias(c) for c in docs.columns if c != "shard"], "shard")
        beside = f"{path.rstrip('/')}__new"
        balanced(out, ["shard"]).write.partitionBy("shard").mode("overwrite").parquet(beside)
        for shard in affected:
            remove(spark, f"{path}/shard={shard}")
            move(spark, f"{beside}/shard={shard}", f"{path}/shard={shard}")
        remove(spark, beside)
    return affected
