"""Byte-balanced shards by Karmarkar-Karp differencing.

Groups (rows with equal texts) are indivisible.  Differencing keeps
partial partitions of all shards' sums, repeatedly takes the two with the
largest spread and adds them in opposite order, so that the heavy end of
one meets the light end of the other.  It runs in levels: groups are dealt
by hash into nodes of bounded size, each node is differenced into one
partial partition, and these are in turn the parts of the next level,
until one is left.  Each level keeps, for every part, where its positions
went; walking these tables down gives every group its shard.  No task sees
more than ``node`` parts and nothing goes through the driver.

Cases: a NULL text has no bytes, so size 1, and all NULL texts are one
group; empty texts are another; repeated rows belong to one group and get
slots of their own; an empty table gives an empty result; a group larger
than a fair share fills a shard by itself; columns named like the added
ones are replaced.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.store import Scratch, packed, unpacked


def differencing(parts: list[list[int]], ids: list[str] | None = None) -> list[list[int]]:
    """Final position of every position of every part (rows: one per part).

    ``parts[i]`` holds the k sums of part i; ties of spread are broken by
    the order of the parts, which the caller fixes."""
    k = len(parts[0])
    order, heap = [], []
    for i, sums in enumerate(parts):
        o = sorted(range(k), key=lambda j: (-sums[j], j))
        order.append(o)
        low = sums[o[-1]]
        heap.append((-(sums[o[0]] - low), i, [sums[j] - low for j in o]))
    heapq.heapify(heap)
    merged, count = [], len(parts)
    while len(heap) > 1:
        _, a, p = heapq.heappop(heap)
        _, b, q = heapq.heappop(heap)
        total = [x + y for x, y in zip(p, reversed(q))]
        o = sorted(range(k), key=lambda j: (-total[j], j))
        low = total[o[-1]]
        merged.append((a, b, o))
        heapq.heappush(heap, (-(total[o[0]] - low), count, [total[j] - low for j in o]))
        count += 1
    label: list = [None] * count
    label[count - 1] = list(range(k))
    for c in range(count - 1, len(parts) - 1, -1):
        a, b, o = merged[c - len(parts)]
        la, lb = [0] * k, [0] * k
        for place, j in enumerate(o):
            la[j] = lb[k - 1 - j] = label[c][place]
        label[a], label[b], label[c] = la, lb, None
    out = []
    for i in range(len(parts)):
        final = [0] * k
        for place, j in enumerate(order[i]):
            final[j] = label[i][place]
        out.append(final)
    return out


def _difference(shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part").reset_index(drop=True)
        parts = [list(map(int, s)) for s in pdf["sums"]]
        moves = differencing(parts)
        total = [0] * shards
        for sums, to in zip(parts, moves):
            for j, place in enumerate(to):
                total[place] += sums[j]
        return pd.DataFrame({"node": pdf["node"], "part": pdf["part"], "moves": moves, "total": [total] * len(pdf)})
    return run


def assign_groups(groups: DataFrame, shards: int, scratch: Scratch, node: int = 20_000, fan_in: int = 2_048) -> DataFrame:
    """Rows (part, shard) for rows (part string, size long) of distinct parts."""
    size_of = F.array(F.col("size").cast("long"), *[F.lit(0).cast("long")] * (shards - 1))
    level = groups.select("part", size_of.alias("sums"))
    count, tables, i = groups.count(), [], 0
    while True:
        nodes = -(-count // (fan_in if i else node))
        key = F.pmod(F.xxhash64("part", F.lit(i)), F.lit(nodes)) if nodes > 1 else F.lit(0)
        done = scratch.save(level.withColumn("node", key.cast("long")).groupBy("node")
                            .applyInPandas(_difference(shards), "node long, part string, moves array<int>, total array<long>"), f"level-{i}")
        tables.append(done.select("part", F.concat(F.lit(f"{i}-"), F.col("node").cast("string")).alias("up"), "moves"))
        if nodes <= 1:
            break
        # one partial partition for each node
        level = done.groupBy("node").agg(F.first("total").alias("sums")).select(
            F.concat(F.lit(f"{i}-"), F.col("node").cast("string")).alias("part"), "sums")
        count, i = nodes, i + 1
    top = tables.pop().select("part", F.col("moves").alias("to"))
    while tables:
        below = tables.pop()
        top = (below.join(top.withColumnRenamed("part", "up"), "up")
               .select("part", F.transform("moves", lambda m: F.element_at("to", m + 1)).alias("to")))
    return top.select("part", F.element_at("to", 1).alias("shard"))


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   slot_rows: int = 50_000) -> DataFrame:
    """``docs`` with size, text_crc32, shard and slot (gapless from 0 in each
    shard).  Sizes: UTF-8 bytes of the text plus 1 a row."""
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.col(text_col).cast("string")
    added = ("size", "text_crc32", "shard", "slot")
    plain = [c for c in docs.columns if c.lower() not in added]
    rows = packed(docs, id=F.col(id_col), size=(F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long"),
                  text_crc32=F.crc32(F.coalesce(text, F.lit(""))), part=F.coalesce(F.sha2(text, 256), F.lit("null")))
    groups = scratch.save(rows.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("rows")), "groups")
    placed = scratch.save(assign_groups(groups.select("part", "size"), shards, scratch), "placed")
    total = groups.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    buckets = max(1, -(-int(total) // slot_rows))
    placed_rows = rows.join(placed, "part").withColumn("bucket", F.pmod(F.xxhash64("id", "part"), F.lit(buckets)))
    # slots: rows before a bucket of the shard, then the place within it
    before = (placed_rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n"))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "part")) - 1
    return (placed_rows.join(before, ["shard", "bucket"]).withColumn("slot", (F.col("before") + place).cast("long"))
            .select(*unpacked(plain), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot"))
