"""Near duplicates by SimHash, found by meet-in-the-middle ball hashing, and their components.

Two 64-bit fingerprints that differ in at most four bits have a common variant: a value within two bits of both. So every
distinct fingerprint stands for all its 2081 variants within half the radius, the shuffle brings equal variants together,
and fingerprints that share one are linked. The shuffle goes by the leading bits of the variant: a fingerprint is sent once
to each destination that holds some of its variants, and the task there writes out the variants that belong to it. Of the
fingerprints that share a variant the first is linked to each other one, not all to all, and a task sends on no more links
than a forest needs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm import common
from papyrine.llm.common import store

SEED = 42
SHINGLE_WORDS = 4
#: Bits by which linked fingerprints may differ; variants go half as far.
RADIUS = 4
#: Variants that one task sorts at a time; buckets are made so small, and larger ones are split.
TASK_VARIANTS = 2_000_000
_HASHES = 1 << 15
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str) -> int:
    """SimHash of the word shingles of a whole text, repeats included; no words: zero."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    data, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE_WORDS:
        return digest(data, SEED)
    starts = [0, *itertools.accumulate(len(w) + 1 for w in words)]
    total, ones = len(words) - SHINGLE_WORDS + 1, np.zeros(64, np.int64)
    for at in range(0, total, _HASHES):
        part = starts[at : min(at + _HASHES, total) + SHINGLE_WORDS]
        hashes = [digest(data[a : b - 1], SEED) for a, b in zip(part, part[SHINGLE_WORDS:], strict=False)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint as a signed long) for every row."""
    own = common.texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text_hash"], pa.array(found)], ["doc_id", "text_hash", "fp"]
        )

    return common.map_batches(own, step, "doc_id long, text_hash long, fp long")


def flips(bits: int, most: int) -> np.ndarray:
    """All masks with at most ``most`` of the lowest ``bits`` bits set."""
    masks = [sum(1 << i for i in c) for n in range(most + 1) for c in itertools.combinations(range(bits), n)]
    return np.array(masks, np.uint64)


def forest(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The smallest reachable index of each index, by links between indices."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def bucket_links(fps: np.ndarray, bucket: int, lead: int, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Links found in one bucket: (fingerprint, smallest fingerprint that it is linked with there), as unsigned integers.

    ``bucket``: the leading ``lead`` bits of its variants. Of a bucket in ``parts`` parts, this is part ``part``: the
    variants that a hash deals to it.
    """
    fps = np.unique(fps)
    low_bits = np.uint64(64 - lead)
    distance = np.bitwise_count((fps >> low_bits) ^ np.uint64(bucket)) if lead else np.zeros(len(fps), np.uint8)
    lows = fps & ((np.uint64(1) << low_bits) - np.uint64(1))
    variants, owners = [], []
    for flipped in range(RADIUS // 2 + 1):
        own = np.flatnonzero(distance == flipped)
        masks = flips(64 - lead, RADIUS // 2 - flipped)
        step = max(1, TASK_VARIANTS // len(masks))
        for at in range(0, len(own), step):
            rows = own[at : at + step]
            made = (lows[rows, None] ^ masks[None, :]).ravel()
            of = np.repeat(rows, len(masks))
            if parts > 1:
                mixed = (made * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                mine = mixed % np.uint64(parts) == part
                made, of = made[mine], of[mine]
            variants.append(made)
            owners.append(of)
    made, of = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(made)
    made, of = made[order], of[order]
    new = np.concatenate([[True], made[1:] != made[:-1]])
    shared = np.flatnonzero(~new)
    if not len(shared):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    leaders = of[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))[shared]]
    pairs = np.unique(leaders * len(fps) + of[shared])
    a, b = np.divmod(pairs, len(fps))
    near = np.bitwise_count(fps[a] ^ fps[b]) <= RADIUS
    label = forest(a[near], b[near], len(fps))
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def links(distinct: DataFrame, rows: int, task_variants: int = TASK_VARIANTS) -> DataFrame:
    """a, b: links between distinct fingerprints (column ``fp``) that join all that are within the radius of each other."""
    spark, ball = distinct.sparkSession, len(flips(64, RADIUS // 2))
    lead = max(4, (max(1, rows * ball // task_variants) - 1).bit_length())
    masks = flips(lead, RADIUS // 2)
    held_rows = 1 << 16

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= held_rows:
                yield from packed(np.concatenate(held))
                held = []
        if held:
            yield from packed(np.concatenate(held))

    def packed(fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = fps >> np.uint64(64 - lead)
        buckets = (own[:, None] ^ masks[None, :]).ravel()
        order = np.argsort(buckets, kind="stable")
        buckets, sent = buckets[order], np.repeat(fps, len(masks))[order]
        home = np.repeat(own, len(masks))[order] == buckets
        cuts = [*np.flatnonzero(np.diff(buckets, prepend=buckets[0] ^ np.uint64(1))).tolist(), len(buckets)]
        for at in range(0, len(cuts) - 1, 4096):
            spans = list(zip(cuts[at : at + 4096], cuts[at + 1 : at + 4097], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(buckets[a]) for a, _ in spans], pa.int64()),
                    pa.array([sent[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([int(home[a:b].sum()) for a, b in spans], pa.int64()),
                ],
                ["bucket", "fps", "home"],
            )

    def find(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket, part, parts = (k.as_py() for k in key)
        fps = np.frombuffer(b"".join(table["fps"].to_pylist()), np.uint64)
        a, b = bucket_links(fps, bucket, lead, part, parts)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    sent = store(common.map_partitions(distinct.select("fp"), send, "bucket long, fps binary, home long"), "sent")
    # A bucket with many fingerprints of its own is dealt to several tasks, each with a share of the variants.
    per_home = len(flips(64 - lead, RADIUS // 2))
    loads = sent.groupBy("bucket").agg(F.sum("home").alias("home"))
    wanted = F.ceil(F.col("home") * per_home / (2 * task_variants))
    large = store(loads.select("bucket", wanted.alias("parts")).filter("parts > 1"), "large")
    dealt = sent.join(common.broadcast_if_bytes(large), "bucket", "left").select(
        "bucket", "fps", F.least(F.coalesce("parts", F.lit(1)), F.lit(per_home)).cast("long").alias("parts")
    )
    dealt = dealt.select("bucket", "fps", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    found = common.map_groups(dealt, ["bucket", "part", "parts"], find, "a long, b long")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable from each node of ``edges`` (a, b).

    Large-star and small-star steps in turn: every step links the neighbours of a node to the smallest of them, so that
    paths shrink until each component is a star. Each step is written and reread; a node with many neighbours is one key
    of a join whose skewed partitions Spark splits, and its smallest neighbour is found by partial aggregation.
    """
    edges = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b"), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(store(smallest, "smallest"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = store(large.filter("a <> b").distinct(), "large_star")
        smallest = store(large.groupBy("a").agg(F.min("b").alias("m")), "smallest")
        small = large.join(smallest, "a").select("a", "b", "m")
        star = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            smallest.select("a", F.col("m").alias("b"))
        )
        star = store(star.filter("a <> b").distinct(), "small_star")
        if star.count() == edges.count() and star.join(edges, ["a", "b"], "left_anti").isEmpty():
            return star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                star.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges = star


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_keys: bool = False
) -> DataFrame:
    """doc_id, fingerprint, component_id (with ``with_keys`` also text_hash and root, a fingerprint, never null) for every row: the smallest id that links lead to, the own one included.

    Null and empty texts have fingerprint zero, which is linked like any other. Null ids do not count as smallest; a
    component of null ids only has a null id. Repeated rows are rows like any other.
    """
    marks = store(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = store(marks.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    root_of = components(links(distinct, distinct.count()))
    rooted = distinct.join(root_of.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    rooted = store(rooted, "rooted")
    lowest = store(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = store(rooted.join(lowest, "root").select("fp", "root", "component_id"), "named")
    extra = ["text_hash", "root"] if with_keys else []
    return marks.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *extra
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept: of each component the row with the smallest id, null ids last.

    Components are told apart by their root, so that those of null ids only keep a row each. Of different texts with that id
    the one with the smallest hash stays; rows that share both stay together.
    """
    found = store(near_duplicates(docs, id_col, text_col, with_keys=True), "near")
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    stays = store(found.groupBy("root").agg(F.min(rank).alias("stays")).select("root", "stays.doc_id", "stays.text_hash"), "stays")
    others = found.join(
        common.broadcast_if_bytes(stays.select(F.col("root").alias("_root"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))),
        (F.col("root") == F.col("_root")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")),
        "left_anti",
    )
    return common.without_rows(docs, others, id_col, text_col)
