"""Sharding by Karmarkar-Karp differencing: near-equal bytes with indivisible groups of rows.

Differencing starts from one partial partition for each group and repeatedly combines the two
with the largest spread, laying the larger shards of one against the smaller of the other. It
runs in two levels, so that no task sees all groups: each task differences its groups into
bundles, and the bundles together with the few large groups are differenced into the shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import prefix_sums, stored, task_count, tidy, utf8_bytes

#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Bundles for each shard: a group above the size of one, in bytes or rows, is placed by itself.
BUNDLES_PER_SHARD = 256
#: Groups that one task differences.
GROUPS_PER_TASK = 500_000


def difference(sizes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each item, 0 to ``parts`` - 1, by Karmarkar-Karp differencing.

    A partial partition keeps its part sums in descending order and, for each part, the first and
    last item of a linked list; combining two adds the sums in opposite order and ties the lists.
    Items not yet combined are numbers in the heap, so memory grows with the items alone.
    """
    n = len(sizes)
    out = np.zeros(n, dtype=np.int64)
    if n == 0 or parts == 1:
        return out
    follow = np.full(n, -1, dtype=np.int64)
    partial: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]  # spread of one item is its size
    heapq.heapify(heap)

    def dense(node: int):
        if node in partial:
            return partial.pop(node)
        sums = np.zeros(parts, dtype=np.int64)
        first = np.full(parts, -1, dtype=np.int64)
        sums[0], first[0] = sizes[node], node
        return sums, first, first.copy()

    fresh = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        if a < n:
            a, b = b, a  # a single item, if any, is b
        sums, first, last = dense(a)
        if b < n:
            # one item goes onto the smallest part, which moves up to its place in the order
            grown = sums[-1] + sizes[b]
            to = int(np.searchsorted(-sums[:-1], -grown, side="right"))
            head, tail = first[-1], b
            if last[-1] >= 0:
                follow[last[-1]] = b
            else:
                head = b
            for arr, value in ((sums, grown), (first, head), (last, tail)):
                arr[to + 1 :] = arr[to:-1].copy()
                arr[to] = value
        else:
            sums2, first2, last2 = (x[::-1] for x in dense(b))
            both = (last >= 0) & (first2 >= 0)
            follow[last[both]] = first2[both]
            head = np.where(first >= 0, first, first2)
            tail = np.where(first2 >= 0, last2, last)
            total = sums + sums2
            order = np.argsort(-total, kind="stable")
            sums, first, last = total[order], head[order], tail[order]
        partial[fresh] = (sums, first, last)
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), fresh))
        fresh += 1
    _, first, _ = dense(heap[0][1])
    for part, item in enumerate(first.tolist()):
        while item >= 0:
            out[item] = part
            item = int(follow[item])
    return out


def bundle(sizes: np.ndarray, unit: int) -> np.ndarray:
    """Bundle of each item: bundles of about ``unit`` by differencing, and a tail of ever smaller ones.

    Every 16th item by size is put aside; these are cut into bundles of half, a quarter, ... of
    them, which the last differencing needs to even out shards below the size of a bundle.
    """
    order = np.argsort(-sizes, kind="stable")
    out = np.zeros(len(sizes), dtype=np.int64)
    aside = order[15::16]
    rest = np.delete(order, np.s_[15::16])
    n = max(1, int(round(sizes[rest].sum() / max(1, unit)))) if len(rest) else 0
    out[rest] = difference(sizes[rest], n)
    cut = len(aside)
    while cut > 0:
        half = cut // 2
        out[aside[half:cut]] = n
        n, cut = n + 1, half
    return out


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null).

    Size is the UTF-8 length of the text plus 16. Documents with equal texts form a group, which
    stays in one shard; null texts are one group, empty ones another. A group larger than a shard
    should be gets a shard that other groups avoid. ``slot`` counts a shard's rows from 0 in key
    order, null keys first. Repeated rows are rows of their own. An empty table gives an empty
    result; with fewer groups than shards some shards stay empty.

    Groups above 1 / (shards * 256) of all bytes or rows are at most 2 * shards * 256 by their
    definition: they take part in the last differencing by themselves and their shards are
    broadcast. All others are bundled by tasks; the last differencing gets the bundles' sums only.
    """
    spark = docs.sparkSession
    t = F.col(f"`{text}`")
    # a group is its text: MD5 with the length and CRC beside it
    light = docs.select(
        F.col(f"`{key}`").alias("k"),
        (utf8_bytes(t) + ROW_BYTES).alias("size"),
        F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("long").alias("crc"),
        F.when(t.isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.md5(t.cast("binary")))).alias("g"),
    )
    light = stored(light, "shard-rows")
    groups = stored(light.groupBy("g", "size", "crc").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "shard-groups")
    n_groups, rows, total = groups.agg(F.count(F.lit(1)), F.sum("n"), F.sum("bytes")).first()
    rows, total = rows or 0, total or 0
    units = shards * BUNDLES_PER_SHARD
    unit = max(1, total // units)
    large = (F.col("bytes") > unit) | (F.col("n") > max(1, rows // units))
    head = groups.filter(large).select("g", "size", "crc", "bytes")  # at most 2 * units rows
    tasks = task_count(spark, n_groups, GROUPS_PER_TASK)
    tail = groups.filter(~large).select("g", "size", "crc", "bytes").repartition(tasks, "g")

    def bundles(batches):
        own = list(batches)  # light rows, at most about GROUPS_PER_TASK
        if not own:
            return
        held = pa.Table.from_batches(own)
        number = bundle(held.column("bytes").to_numpy().astype(np.int64), unit)
        number = pa.array(number + (TaskContext.get().partitionId() << 32))
        yield from held.append_column("bundle", number).to_batches(max_chunksize=65_536)

    tail = stored(tail.mapInArrow(tidy(bundles), "g binary, size long, crc long, bytes long, bundle long"), "shard-bundles")
    # bundle sums: units plus a few for each task; large groups: at most 2 * units
    sums = [(r["bundle"], None, r["bytes"]) for r in tail.groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()]
    sums += [(None, (bytes(r["g"]), r["size"], r["crc"]), r["bytes"]) for r in head.collect()]
    sums.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1] or ()))
    placed = difference(np.array([b for _, _, b in sums], dtype=np.int64), shards).tolist()
    of_bundle = spark.createDataFrame([(b, s) for (b, _, _), s in zip(sums, placed) if b is not None], "bundle long, shard int")
    of_head = spark.createDataFrame([(*h, s) for (_, h, _), s in zip(sums, placed) if h is not None], "g binary, size long, crc long, hshard int")
    of_tail = tail.join(F.broadcast(of_bundle), "bundle").select("g", "size", "crc", "shard")
    same = ["g", "size", "crc"]
    first = light.join(F.broadcast(of_head), same, "left")
    by_head = first.filter("hshard is not null").select("k", "size", "crc", F.col("hshard").alias("shard"))
    by_tail = first.filter("hshard is null").drop("hshard").join(of_tail, same).select("k", "size", "crc", "shard")
    numbered = prefix_sums(by_head.unionByName(by_tail), ["k"], {"slot": None}, groups=["shard"], name="shard-slots")
    return numbered.select(
        F.col("k").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

