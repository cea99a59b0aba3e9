"""Shards of equal bytes for groups that must not be torn, by Karmarkar-Karp differencing.

Every group starts as a partial partition that has its bytes in one shard and nothing in the others. The two partial
partitions of largest spread (fullest minus emptiest shard) are joined in opposite order, the fullest of one with the
emptiest of the other, until one is left. Here groups are dealt into buckets of bounded size that are differenced in
parallel; each leaves one partial partition, and these are differenced in the same way, level by level.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyrine.llm import common
from papyrine.llm.common import store

SHARDS = 8
#: Partial partitions that one task combines.
BUCKET_PARTS = 1 << 14
#: Rows numbered together in one window.
SLOT_ROWS = 100_000


def difference(parts: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Joins partial partitions (bytes per place, fullest first).

    Returns the bytes per place of the result, and for each part the place of the result that each of its places went to.
    """
    width = len(parts[0])
    heap = [(sums[-1] - sums[0], i) for i, sums in enumerate(parts)]
    heapq.heapify(heap)
    sums_of, joined = dict(enumerate(parts)), []
    node = len(parts)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        left, right = sums_of.pop(a), sums_of.pop(b)
        together = [x + y for x, y in zip(left, reversed(right), strict=True)]
        order = sorted(range(width), key=together.__getitem__, reverse=True)
        sums = [together[i] for i in order]
        joined.append((a, b, order))
        sums_of[node] = sums
        heapq.heappush(heap, (sums[-1] - sums[0], node))
        node += 1
    root = heap[0][1]
    places = {root: list(range(width))}
    for own, (a, b, order) in zip(range(node - 1, len(parts) - 1, -1), reversed(joined), strict=True):
        labels = places.pop(own)
        of_left, of_right = [0] * width, [0] * width
        for place, i in enumerate(order):
            of_left[i] = of_right[width - 1 - i] = labels[place]
        places[a], places[b] = of_left, of_right
    return sums_of[root], [places[i] for i in range(len(parts))]


def _level(parts: DataFrame, part_key: str, kind: str, buckets: int) -> DataFrame:
    """One level: ``parts`` (key, sums) -> key, bucket, places, and in one row of each bucket its sums."""

    def combine(table: pa.Table) -> pa.Table:
        keys = table[part_key].combine_chunks()
        found = table["sums"].to_pylist()
        # The result does not depend on the order in which rows arrive.
        order = sorted(range(len(found)), key=lambda i: (found[i], keys[i].as_py()))
        sums, places = difference([found[i] for i in order])
        of_row = [None] * len(found)
        for i, own in zip(order, places, strict=True):
            of_row[i] = own
        totals = [sums if i == order[0] else None for i in range(len(found))]
        return pa.table(
            {
                part_key: keys,
                "bucket": table["bucket"].combine_chunks(),
                "places": pa.array(of_row, pa.list_(pa.int32())),
                "totals": pa.array(totals, pa.list_(pa.int64())),
            }
        )

    spread = parts.withColumn("bucket", F.pmod(F.xxhash64(part_key), F.lit(buckets)))
    return common.map_groups(
        spread, ["bucket"], combine, f"{part_key} {kind}, bucket long, places array<int>, totals array<long>"
    )


def balance(groups: DataFrame, key: str, size: str, shards: int = SHARDS, bucket_parts: int = BUCKET_PARTS) -> DataFrame:
    """key, shard for every row of ``groups`` (unique keys, sizes): no task holds more than a bucket of them."""
    kind = dict(groups.dtypes)[key]
    rest = F.array_repeat(F.lit(0).cast("long"), shards - 1)
    parts = groups.select(key, F.concat(F.array(F.col(size).cast("long")), rest).alias("sums"))
    count, levels, name = groups.count(), [], key
    buckets = -(-count // bucket_parts)
    while count:
        level = store(_level(parts, name, kind, buckets), "level")
        levels.append((name, level))
        if buckets == 1:
            break
        parts = level.filter("totals is not null").select("bucket", F.col("totals").alias("sums"))
        count, name, kind = parts.count(), "part", "long"
        parts = parts.withColumnRenamed("bucket", "part")
        buckets = -(-count // bucket_parts)
    if not levels:
        return groups.select(key, F.lit(0).alias("shard"))
    # Places of the last level are shards; a level below follows its bucket's places.
    labels = levels[-1][1].select(levels[-1][0], F.col("places").alias("labels"))
    for name, level in reversed(levels[:-1]):
        above = common.broadcast_if_bytes(store(labels.withColumnRenamed("part", "bucket"), "labels"))
        composed = F.transform("places", lambda place: F.col("labels")[place])
        labels = level.join(above, "bucket").select(name, composed.alias("labels"))
    return labels.select(key, F.col("labels")[0].alias("shard"))


def shards(
    docs: DataFrame, number: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", bucket_parts: int = BUCKET_PARTS
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row; equal texts share a shard.

    Size is the bytes of the text (null: none) plus one. Shards of a law ``bytes`` are as equal as the groups allow: a
    group larger than a share fills its shard alone. Slots of a shard run from 0 without gaps, in no stated order. Null
    and repeated ids are rows like any other.
    """
    text = F.col("text")
    own = common.texts(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("content"),
    )
    own = store(own, "sizes")
    groups = store(own.groupBy("content").agg(F.sum("size").alias("bytes")), "groups")
    shard_of = store(balance(groups, "content", "bytes", number, bucket_parts), "shards")
    rows = own.count()
    slices = max(common.shuffle_partitions(docs.sparkSession), -(-rows // SLOT_ROWS))
    placed = own.join(shard_of, "content").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        F.pmod(F.xxhash64("doc_id", "text_crc32", F.rand(7)), F.lit(slices)).alias("slice"),
    )
    placed = store(placed, "placed")
    # Rows before a slice: a running sum over one row per shard and slice.
    counts = placed.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    nth = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32"))
    numbered = placed.withColumn("nth", nth).join(
        common.broadcast_if_bytes(store(offsets, "offsets")), ["shard", "slice"]
    )
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("offset") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
