"""Sharding by longest processing time: equal texts stay together, bytes even out.

Groups of equal texts are counted by size class in Spark. The schedule runs over
those classes, largest first, and gives every class its number of groups per
shard. Spark then ranks the groups of a class and reads each one's shard off that
schedule, so the driver sees classes and never groups.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import ranked, whole_text
from sightline.session import cut

SHARDS = 16
# Sizes are scheduled by their leading bits. This bounds the classes to about 1.6
# million for any table; a size is off by less than 1 in 32,768, small ones not at all.
SIZE_BITS = 16
_ROWS_SCHEMA = "size_class long, ends array<long>"


def size_class(size: Column) -> Column:
    drop = F.greatest(F.length(F.bin(size)) - SIZE_BITS, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def schedule(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """Longest processing time over (class, groups, bytes), as counts per class and shard.

    Groups go, largest first, to the least-loaded shard through a heap. A long
    run of one class first fills the shards up to a common level, which is where
    the heap would bring them one by one, and ends in the heap.
    """
    heap = [(0.0, s) for s in range(shards)]
    plan = []
    for name, groups, total in sorted(classes, reverse=True):
        each = total / groups
        taken = [0] * shards
        left = groups
        if left > 4 * shards:
            loads = sorted(heap)
            budget = (left - shards) * each
            # The level up to which `budget` fills the least-loaded shards.
            summed = 0.0
            for k, (load, _) in enumerate(loads, start=1):
                summed += load
                level = (budget + summed) / k
                if k == shards or level <= loads[k][0]:
                    break
            heap = []
            for load, s in loads:
                n = max(0, int((level - load) / each))
                taken[s] = n
                left -= n
                heap.append((load + n * each, s))
            heapq.heapify(heap)
        for _ in range(left):
            load, s = heapq.heappop(heap)
            taken[s] += 1
            heapq.heappush(heap, (load + each, s))
        plan.append((name, taken))
    return plan


def assign(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Shard and slot of every document.

    Columns: doc_id, size (bytes of the text plus 1), text_crc32, shard, slot
    (gapless from 0 in each shard). A null text has no bytes and CRC 0; null texts
    form one group apart from empty ones. Repeated rows and ids each keep their
    own slot. An empty table gives an empty result. One group larger than an even
    share stays whole, as groups must.
    """
    spark = docs.sparkSession
    raw = F.encode(whole_text("text"), "UTF-8")
    rows = cut(
        docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).select(
            "doc_id",
            (F.octet_length(whole_text("text")) + F.lit(1)).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.when(F.col("text").isNull(), F.lit("null")).otherwise(F.md5(raw)).alias("group"),
        )
    )
    totals = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    groups = cut(totals.withColumn("size_class", size_class(F.col("bytes"))))
    by_class = groups.groupBy("size_class").agg(F.count("*").alias("n"), F.sum("bytes").alias("total"))
    plan = schedule([tuple(r) for r in by_class.select("size_class", "n", "total").collect()], shards)
    ends = pd.DataFrame(
        {"size_class": [c for c, _ in plan], "ends": [pd.Series(taken).cumsum().tolist() for _, taken in plan]}
    )
    table = spark.createDataFrame(ends, _ROWS_SCHEMA)
    placed = ranked(groups, "size_class", ["bytes", "group"], "rank").join(table, "size_class")
    # The shard is the number of shards whose share of the class ends at or before this rank.
    shard = F.size(F.filter("ends", lambda e: e <= F.col("rank"))).cast("int")
    placed = placed.select("group", shard.alias("shard"))
    sharded = cut(rows.join(placed, "group").drop("group"))
    return ranked(sharded, "shard", ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )
