"""Sharding by longest-processing-time scheduling.

Rows of equal text form a group that stays together. Groups go by falling size to the shard with
the least load, taken from a heap. The heap sees sizes, not groups: a histogram with a bounded
number of size classes is scheduled on the driver, and each group finds its shard by its rank in
its class.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.tables import buckets_of, columns, text_crc32, text_of, with_rank
from wayfare.session import cut_lineage

#: Leading bits of a group's size that tell classes apart: sizes below 2,048 have classes of their
#: own, larger ones share a class within 0.1 %. At most 2,048 + 52 * 1,024 classes exist.
CLASS_BITS = 11
#: Bytes of the schedule up to which it is sent to all tasks; beyond, it is joined.
BROADCAST_BYTES = 8 << 20


def size_class(size):
    """Size with all but its ``CLASS_BITS`` leading bits cleared, exact below ``2 ** CLASS_BITS``."""
    spare = F.greatest(F.length(F.bin(size)) - CLASS_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, spare), spare)


def deal(loads: list[float], count: int, size: float) -> list[int]:
    """How many of ``count`` items of one size each shard gets when each goes to the least loaded.

    ``loads`` is raised accordingly. Long runs are filled up to a common level first, which is what
    the heap would do item by item; the heap deals the rest.
    """
    got = [0] * len(loads)
    if count > 4 * len(loads):
        low, high = min(loads), max(loads) + count * size / len(loads) + size
        for _ in range(80):
            level = (low + high) / 2
            if sum(max(0, int((level - load) // size)) for load in loads) > count:
                high = level
            else:
                low = level
        for shard, load in enumerate(loads):
            got[shard] = max(0, int((low - load) // size))
        while (over := sum(got) - count) > 0:
            got[max(range(len(got)), key=got.__getitem__)] -= over
    heap = [(load + n * size, shard) for shard, (load, n) in enumerate(zip(loads, got))]
    heapq.heapify(heap)
    for _ in range(count - sum(got)):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        got[shard] += 1
    for load, shard in heap:
        loads[shard] = load
    return got


def schedule(histogram: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """(class, running counts by shard) from (class, groups, total size), largest class first."""
    loads, plan = [0.0] * shards, []
    for size, count, total in sorted(histogram, reverse=True):
        ends, end = [], 0
        for got in deal(loads, count, total / count):
            end += got
            ends.append(end)
        plan.append((size, ends))
    return plan


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text).

    ``size`` is the UTF-8 length plus 1; a null text counts as the empty one and belongs to its
    group. ``slot`` is gapless from 0 in each shard. Repeated rows are rows of their own, in the same
    shard. A null doc_id stays null. An empty table gives no rows. The key of a group is a pair of
    64-bit hashes. What reaches the driver is the histogram: at most 55,296 rows of three numbers.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    rows = columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        text_crc32().alias("text_crc32"),
        F.xxhash64(text_of()).alias("key"),
        F.xxhash64(F.lit(1), text_of()).alias("key2"),
    )
    rows = cut_lineage(rows)
    groups = rows.groupBy("key", "key2").agg(F.sum("size").alias("weight"))
    groups = cut_lineage(groups.withColumn("class", size_class(F.col("weight"))))
    histogram = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"))
    plan = schedule([tuple(row) for row in histogram.collect()], shards)
    table = docs.sparkSession.createDataFrame(plan, "class long, ends array<long>")
    if len(plan) * (shards + 2) * 8 <= BROADCAST_BYTES:
        table = F.broadcast(table)
    placed = (
        with_rank(groups, "class", ["key", "key2"], buckets_of(groups))
        .join(table, "class")
        .withColumn("shard", F.size(F.filter("ends", lambda end: end <= F.col("__rank"))))
        .select("key", "key2", "shard")
    )
    sharded = cut_lineage(rows.join(placed, ["key", "key2"]).drop("key", "key2"))
    slots = with_rank(sharded, "shard", ["doc_id", "size", "text_crc32"], buckets_of(sharded), "slot")
    return slots.select("doc_id", "size", "text_crc32", "shard", "slot")
