"""Sharding by Karmarkar-Karp differencing: groups of equal texts stay whole, shards hold nearly equal bytes."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyjoin.llm.common import Stage, input_tasks

#: Partial partitions that one task of the tree combines.
FAN_IN = 64


def differenced(elements: list[list[int]], shards: int) -> list[list[int]]:
    """For each element, a list of shards sums, the shard that each of its slots goes to.

    The two elements with the largest spread are combined, the largest sum of one with the smallest of the
    other, until one is left. Sums count above their smallest, and ties go by age, so results repeat.
    """
    heap = []
    for k, sums in enumerate(elements):
        slots = sorted(range(shards), key=lambda s: (sums[s], s))
        low = sums[slots[0]]
        # each slot holds the tree of (element, slot) pairs that share it
        heap.append((low - sums[slots[-1]], k, [sums[s] - low for s in slots], [(k, s) for s in slots]))
    heapq.heapify(heap)
    age = len(elements)
    while len(heap) > 1:
        _, _, a, a_slots = heapq.heappop(heap)
        _, _, b, b_slots = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b), strict=True)]
        slots = [[x, y] for x, y in zip(a_slots, reversed(b_slots), strict=True)]
        order = sorted(range(shards), key=sums.__getitem__)
        low = sums[order[0]]
        heapq.heappush(heap, (low - sums[order[-1]], age, [sums[s] - low for s in order], [slots[s] for s in order]))
        age += 1
    out = [[0] * shards for _ in elements]
    for shard, tree in enumerate(heap[0][3] if heap else []):
        rest = [tree]
        while rest:
            node = rest.pop()
            if isinstance(node, list):
                rest += node
            else:
                out[node[0]][node[1]] = shard
    return out


def combine(documents: pa.Table, shards: int) -> pa.Table:
    """Slots of one task's groups of equal texts (block, digest, bytes)."""
    order = sorted(range(len(documents)), key=documents.column("digest").to_pylist().__getitem__)
    documents = documents.take(order)
    sizes = documents.column("bytes").to_pylist()
    slots = differenced([[0] * (shards - 1) + [b] for b in sizes], shards)
    return documents.append_column("slot", pa.array([s[-1] for s in slots], pa.int32()))


def combine_parts(parts: pa.Table, shards: int) -> pa.Table:
    """The parent's slot for each slot of up to FAN_IN partial partitions (node, block, slot, bytes)."""
    rows = parts.to_pylist()
    blocks = sorted({r["block"] for r in rows})
    place = {b: k for k, b in enumerate(blocks)}
    elements = [[0] * shards for _ in blocks]
    for r in rows:
        elements[place[r["block"]]][r["slot"]] = r["bytes"]
    up = differenced(elements, shards)
    return pa.table({
        "block": pa.array([b for b in blocks for _ in range(shards)], pa.int64()), "slot": pa.array(list(range(shards)) * len(blocks), pa.int32()),
        "node": pa.array([rows[0]["node"]] * (len(blocks) * shards), pa.int64()), "node_slot": pa.array([s for part in up for s in part], pa.int32()),
        "bytes": pa.array([b for e in elements for b in e], pa.int64())})


def balanced_shards(documents: DataFrame, stage: Stage, *, shards: int = 16, tasks: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of documents (doc_id, text).

    size: UTF-8 bytes of the text and one. Equal texts make a group, summed before the shuffle, which stays
    in one shard. Groups are dealt to tasks by hash; each task differences its own into a partial partition of
    shards sums, and partial partitions are differenced again, FAN_IN at a time, up a tree. Slots count from 0
    within a shard: places within buckets of a shard, and sums of the buckets before.

    law is "bytes": shards have nearly equal bytes, unless one group exceeds a shard's part; grown_shard is null.
    Null text: as an empty one. Null doc_id stays null. Rows that share doc_id and text share a shard. Other
    columns are ignored; an empty table gives none.
    """
    tasks = tasks or 2 * input_tasks(documents)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stage.write(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")), "rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes")).withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(tasks)).cast("long"))
    groups = stage.write(groups.groupBy("block").applyInArrow(
        lambda table: combine(table.select(["block", "digest", "bytes"]), shards), "block long, digest binary, bytes long, slot int"), "groups")

    parts = groups.groupBy("block", "slot").agg(F.sum("bytes").alias("bytes"))
    where = groups.select("block").distinct().select("block", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("slot"))
    where = where.select("block", "slot", F.col("block").alias("at"), F.col("slot").alias("shard"))
    count = tasks
    while count > 1:
        count = -(-count // FAN_IN)
        step = stage.write(parts.withColumn("node", F.floor(F.col("block") / FAN_IN)).groupBy("node").applyInArrow(
            lambda table: combine_parts(table.select(["node", "block", "slot", "bytes"]), shards),
            "block long, slot int, node long, node_slot int, bytes long"), "level")
        parts = step.groupBy(F.col("node").alias("block"), F.col("node_slot").alias("slot")).agg(F.sum("bytes").alias("bytes"))
        up = step.select(F.col("block").alias("at"), F.col("slot").alias("shard"), "node", "node_slot")
        where = where.join(up, ["at", "shard"]).select("block", "slot", F.col("node").alias("at"), F.col("node_slot").alias("shard"))
    homes = groups.join(stage.write(where, "where"), ["block", "slot"]).select("digest", "shard")

    bucket = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(tasks))
    placed = stage.write(rows.join(homes, "digest").select("doc_id", "size", "text_crc32", "shard", bucket.alias("bucket")), "placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(W.partitionBy("shard").orderBy("bucket")) - F.col("rows")
    own = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    out = placed.withColumn("own", own).join(counts.select("shard", "bucket", before.alias("before")), ["shard", "bucket"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("own")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
