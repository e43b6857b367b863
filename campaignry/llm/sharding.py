"""Shards of nearly equal bytes by Karmarkar-Karp differencing; equal texts stay together.

The items are groups of equal texts. Groups below a small part of a shard's bytes are first gathered, by a hash of
their text, into a fixed number of bundles; larger ones are items of their own, of which there can only be so many. So
the differencing itself handles a number of items that a parameter bounds, whatever the input, and it still has small
items to level what the large ones leave: the two partial partitions with the largest spread are combined, the
heaviest shard of one with the lightest of the other, until one is left. Only a group of more than a shard is divided,
into as few parts of equally many copies as none is larger than a shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campaignry.session import cut_lineage


@dataclass(frozen=True)
class ShardPlan:
    shards: int = 16
    bundles: int = 4096  # of small groups
    single: int = 64  # a group of more than one such part of a shard's bytes is an item of its own
    rows_per_chunk: int = 50_000  # for the numbering inside shards
    copies_per_chunk: int = 2_000  # for the numbering inside divided groups


def differenced(parts: Iterable[tuple[list[int], list]], shards: int) -> tuple[list[int], list[list]]:
    """Combines partial partitions (sums, members per shard) by largest spread first, oppositely ordered.

    Sums are kept in falling order. Members are nested lists, flattened by ``members``.
    """
    heap = []
    for serial, (sums, groups) in enumerate(parts):
        order = sorted(range(shards), key=lambda i: -sums[i])
        sums, groups = [sums[i] for i in order], [groups[i] for i in order]
        heap.append((sums[-1] - sums[0], serial, sums, groups))
    if not heap:
        return [0] * shards, [[] for _ in range(shards)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        both = sorted(((a[i] + b[-1 - i], i) for i in range(shards)), key=lambda p: -p[0])
        sums = [s for s, _ in both]
        groups = [[x[i], y[-1 - i]] if x[i] and y[-1 - i] else x[i] or y[-1 - i] for _, i in both]
        heapq.heappush(heap, (sums[-1] - sums[0], serial, sums, groups))
        serial += 1
    return heap[0][2], heap[0][3]


def members(nested) -> list:
    """The leaves of nested lists; a leaf is a tuple."""
    out, stack = [], [nested]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            out.append(x)
        else:
            stack.extend(x)
    return out


def _homes(plan: ShardPlan):
    """Differences all items of one small table."""
    def run(batches):
        items = [x for batch in batches for x in zip(batch.column("item").to_pylist(), batch.column("bytes").to_pylist())]
        rest = plan.shards - 1
        parts = (([size] + [0] * rest, [[(item,)]] + [[]] * rest) for item, size in sorted(items))
        _, groups = differenced(parts, plan.shards)
        cells = [(item, shard) for shard, g in enumerate(groups) for item, in members(g)]
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.string()), pa.array([c[1] for c in cells], pa.int32())],
                                         names=["item", "shard"])
    return run


def _divided(rows: DataFrame, chunks: int) -> DataFrame:
    """Rows of the groups to divide with their item; copies are numbered in chunks, so that no task holds a group."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(max(1, chunks))).cast("int"))
    counts = rows.groupBy("hash", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("hash").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("hash", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("hash", "chunk").orderBy("row")
    at = F.col("offset") + F.row_number().over(inside) - 1
    part = F.floor(at * F.col("parts") / F.col("copies")).cast("string")
    return rows.join(offsets, ["hash", "chunk"]).withColumn("item", F.concat(F.hex("hash"), F.lit(" "), part)).drop("offset", "chunk")


def shard(docs: DataFrame, plan: ShardPlan = ShardPlan()) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Nulls: a null text has no bytes; null texts are one group, which is not that of the empty text; rows with a null id
    are dealt like others and come first in the slots of their chunk. Repeated rows are copies of one text. With fewer groups than
    shards some shards stay empty. An empty table gives no rows. Other columns are not read.
    """
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text")).select(
        "doc_id", "row", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit(b"")).otherwise(F.unhex(F.md5("text"))).alias("hash"))
    rows = cut_lineage(rows)
    groups = cut_lineage(rows.groupBy("hash").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    share = (total["bytes"] or 0) / plan.shards
    # Groups of more than a part of a shard: at most shards x single of them, whatever the input.
    most = F.greatest(F.floor(F.col("n") * share / F.col("bytes")), F.lit(1))  # copies that fit in a shard
    parts = F.when(F.col("bytes") > share, F.ceil(F.col("n") / most)).otherwise(1)
    large = groups.filter(F.col("bytes") > share / plan.single).select("hash", parts.cast("long").alias("parts"), F.col("n").alias("copies"))
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("hash"), F.lit(plan.bundles)).cast("string"))
    placed = rows.join(F.broadcast(large), "hash", "left")
    whole = placed.filter("parts IS NULL OR parts = 1").withColumn(
        "item", F.when(F.col("parts") == 1, F.concat(F.hex("hash"), F.lit(" 0"))).otherwise(bundle))
    placed = whole.unionByName(_divided(placed.filter("parts > 1"), -(-(total["n"] or 0) // plan.copies_per_chunk))).drop("parts", "copies", "hash")
    placed = cut_lineage(placed)
    items = placed.groupBy("item").agg(F.sum("size").alias("bytes"))  # bundles + shards x (single + 2) rows at most
    homes = items.coalesce(1).mapInArrow(_homes(plan), "item string, shard int")
    dealt = placed.join(F.broadcast(homes), "item")  # as many rows as items

    chunks = max(1, -(-(total["n"] or 0) // plan.rows_per_chunk))
    dealt = cut_lineage(dealt.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")))
    counts = dealt.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "row")
    slots = dealt.withColumn("at", F.row_number().over(inside)).join(offsets, ["shard", "chunk"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                        (F.col("offset") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
