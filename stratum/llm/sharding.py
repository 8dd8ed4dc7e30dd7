"""Sharding by longest-processing-time scheduling over groups that must stay together.

Groups are taken by falling size and each goes to the least-loaded shard, which a heap finds. The schedule
is made over a bounded list: a group larger than a small fraction of a shard is an item of its own (there
cannot be many of those), all smaller groups share hash buckets, and a bucket is one item. So the list has at
most ``2 * shards * fineness`` entries at every input size, and what it costs is a bucket's size in balance.

Defined results: a null text has size ``overhead`` and all null texts are one group; empty input gives no rows.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import same_key, settled

#: Items per shard in the schedule. The list that reaches the driver holds at most twice this times the shards.
FINENESS = 1000
OVERHEAD = 16


def lpt(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Item -> shard: items by falling size (then id) to the least-loaded shard (then lowest number)."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def lpt_shards(
    docs: DataFrame, shards: int = 40, group: Column | None = None, fineness: int = FINENESS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, group_key, shard, slot``: every row in a shard, its group undivided.

    ``group`` defaults to equal texts. ``size`` is UTF-8 bytes plus a fixed overhead, ``slot`` counts from 0
    without gaps in each shard. Only narrow rows move. Very large groups are numbered in salted parts, so no
    task numbers a whole group or shard.
    """
    text = F.col(text_col)
    whole = F.coalesce(text, F.lit(""))
    key = group if group is not None else F.sha2(text, 256)
    rows = settled(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(whole) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.coalesce(key.cast("string"), F.lit("")).alias("group_key"),
    ), "shard-rows")
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    groups = settled(groups, "shard-groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    limit, row_limit = max(1, total[0] // (shards * fineness)), max(1, total[1] // (shards * 25))
    buckets = shards * fineness
    # positive numbers: a large group; negative: a bucket of small ones
    bucket = -1 - F.pmod(F.xxhash64("group_key"), F.lit(buckets))
    large = F.col("bytes") >= limit
    item = F.when(large, F.shiftrightunsigned(F.xxhash64("group_key", F.lit("item")), 1)).otherwise(bucket)
    items = groups.withColumn("item", item).groupBy("item").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    listed = items.toPandas()  # at most 2 * shards * fineness rows
    placed = lpt(list(zip(listed["item"].tolist(), listed["bytes"].tolist())), shards)
    plan = pd.DataFrame({
        "item": listed["item"].astype("int64"),
        "shard": pd.array([placed[x] for x in listed["item"]], dtype="int32"),
        "parts": (listed["rows"] // row_limit + 1).astype("int32"),
    })
    spark = docs.sparkSession
    plan = spark.createDataFrame(plan, "item long, shard int, parts int")
    keyed = groups.select(F.col("group_key").alias("known_key"), item.alias("item")).join(plan, "item")
    placed_rows = rows.join(settled(keyed, "shard-plan"), same_key("group_key", "known_key", "shards"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.col("parts"))
    placed_rows = settled(placed_rows.select(
        "doc_id", "size", "text_crc32", "group_key", "shard", "item", part.cast("int").alias("part"),
    ), "shard-placed")
    # parts are a bounded list again: items plus shards * 25
    parts = placed_rows.groupBy("shard", "item", "part").agg(F.count(F.lit(1)).alias("rows"))
    running = Window.partitionBy("shard").orderBy("item", "part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parts.select(
        F.col("item").alias("i"), F.col("part").alias("p"), F.coalesce(F.sum("rows").over(running), F.lit(0)).alias("first"),
    )
    inside = Window.partitionBy("item", "part").orderBy("doc_id", "group_key")
    numbered = placed_rows.withColumn("inside", F.row_number().over(inside))
    return numbered.join(firsts, (F.col("item") == F.col("i")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "size", "text_crc32", "group_key", "shard", (F.col("first") + F.col("inside") - 1).alias("slot"),
    )
