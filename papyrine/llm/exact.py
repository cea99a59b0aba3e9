"""Exact duplicates by counting quotient filters: built per partition, merged without loss, repeats verified byte by byte.

A filter splits a 64-bit fingerprint into a quotient (its leading bits) and a remainder. Remainders of one quotient form a
run, runs follow each other in order, so a filter is a sorted list in compact form: one bit for each quotient in use, one
bit at the end of each run, the remainders and a counter for each. Merging two filters is merging sorted remainders and
adding counters, and loses nothing. Fingerprints with a count above one send their texts to the byte comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyrine.llm import common
from papyrine.llm.common import store

#: Leading bits of a fingerprint that are its quotient; more where more slices are needed.
QUOTIENT_BITS = 16
#: Fingerprints in one filter of a partition, and about as many in one merged slice.
FILTER_ROWS = 1 << 20
BLANKS = r"[\x20\x09-\x0D]+"


class CountingQuotientFilter:
    """Sorted (fingerprint, count) pairs as quotient bits, run ends, remainders and counters."""

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, bits: int = QUOTIENT_BITS):
        """``fingerprints``: sorted distinct unsigned 64-bit integers."""
        self.bits = bits
        shift = np.uint64(64 - bits)
        quotients = (fingerprints >> shift).astype(np.int64)
        self.occupied = np.zeros(1 << bits, bool)
        self.occupied[quotients] = True
        self.run_end = np.ones(len(fingerprints), bool)
        if len(quotients):
            self.run_end[:-1] = quotients[1:] != quotients[:-1]
        self.remainders = fingerprints & ((np.uint64(1) << shift) - np.uint64(1))
        self.counts = counts

    @classmethod
    def build(cls, fingerprints: np.ndarray, bits: int = QUOTIENT_BITS) -> CountingQuotientFilter:
        distinct, counts = np.unique(fingerprints.astype(np.uint64), return_counts=True)
        return cls(distinct, counts.astype(np.uint64), bits)

    def fingerprints(self) -> np.ndarray:
        """The stored fingerprints, in order: the k-th run belongs to the k-th quotient in use."""
        run = np.concatenate([[0], np.cumsum(self.run_end[:-1])]).astype(np.int64) if len(self.run_end) else []
        quotients = np.flatnonzero(self.occupied).astype(np.uint64)[run]
        return (quotients << np.uint64(64 - self.bits)) | self.remainders

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        both = np.concatenate([self.fingerprints(), other.fingerprints()])
        counts = np.concatenate([self.counts, other.counts])
        order = np.argsort(both, kind="stable")  # two sorted runs: a merge
        both, counts = both[order], counts[order]
        if not len(both):
            return self
        starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        return CountingQuotientFilter(both[starts], np.add.reduceat(counts, starts), self.bits)

    def repeated(self) -> np.ndarray:
        return self.fingerprints()[self.counts > 1]

    def to_bytes(self) -> bytes:
        """Quotients in use as their distances, run ends as bits, remainders in the bytes that they need, counters."""
        used = np.flatnonzero(self.occupied).astype("<u4")
        width = (64 - self.bits + 7) // 8
        remainders = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = np.array([self.bits, len(used), len(self.counts)], "<u8")
        counts = self.counts.astype("<u8")
        small = counts < 255
        return b"".join(
            [
                head.tobytes(),
                used.tobytes(),
                np.packbits(self.run_end).tobytes(),
                np.ascontiguousarray(remainders).tobytes(),
                np.where(small, counts, 255).astype(np.uint8).tobytes(),
                counts[~small].tobytes(),
            ]
        )

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        bits, used, n = (int(x) for x in np.frombuffer(raw, "<u8", 3))
        width, at = (64 - bits + 7) // 8, 24
        quotients = np.frombuffer(raw, "<u4", used, at)
        at += 4 * used
        out = cls.__new__(cls)
        out.bits = bits
        out.occupied = np.zeros(1 << bits, bool)
        out.occupied[quotients] = True
        out.run_end = np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, at), count=n).astype(bool)
        at += (n + 7) // 8
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
        out.remainders = wide.view("<u8").ravel().astype(np.uint64)
        at += n * width
        counts = np.frombuffer(raw, np.uint8, n, at).astype(np.uint64)
        counts[counts == 255] = np.frombuffer(raw, "<u8", -1, at + n)
        out.counts = counts
        return out


def repeated_fingerprints(fingerprints: DataFrame, column: str, rows: int) -> DataFrame:
    """The values of a long column that occur more than once (column ``fingerprint``).

    ``rows`` (their number) sets how many slices the filters are cut into by leading quotient bits: each slice is merged
    in one task and holds about ``FILTER_ROWS`` fingerprints whatever the size of the input. A value that fills a third of
    the rows is one counter of each partition's filter.
    """
    spark = fingerprints.sparkSession
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // FILTER_ROWS))
    bits = max(QUOTIENT_BITS, slices.bit_length())

    def filters(found: np.ndarray) -> pa.RecordBatch:
        distinct, counts = np.unique(found, return_counts=True)
        slice_of = ((distinct >> np.uint64(64 - bits)) * np.uint64(slices)) >> np.uint64(bits)
        cuts = np.flatnonzero(np.diff(slice_of, prepend=np.uint64(slices))).tolist() + [len(distinct)]
        out = [
            (int(slice_of[a]), CountingQuotientFilter(distinct[a:b], counts[a:b].astype(np.uint64), bits).to_bytes())
            for a, b in zip(cuts, cuts[1:], strict=False)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in out], pa.int64()), pa.array([f for _, f in out], pa.binary())], ["slice", "filter"]
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0
        for batch in batches:
            own = batch[column].drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            held.append(own)
            total += len(own)
            if total >= FILTER_ROWS:
                yield filters(np.concatenate(held))
                held, total = [], 0
        if total:
            yield filters(np.concatenate(held))

    def merge(table: pa.Table) -> pa.Table:
        whole = None
        # Smallest first, by halves: every remainder is moved a logarithmic number of times.
        todo = [CountingQuotientFilter.from_bytes(raw) for raw in table["filter"].to_pylist()]
        while len(todo) > 1:
            odd = [todo[-1]] if len(todo) % 2 else []
            todo = [a.merge(b) for a, b in zip(todo[::2], todo[1::2], strict=False)] + odd
        whole = todo[0]
        return pa.table({"fingerprint": pa.array(whole.repeated().view(np.int64), pa.int64())})

    built = common.map_partitions(fingerprints.select(column), build, "slice long, filter binary")
    return common.map_groups(built, ["slice"], merge, "fingerprint long")


def normalised(text) -> F.Column:
    return F.regexp_replace(text, BLANKS, " ")


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; texts are equal if their normalised bytes are.

    A null text is empty, and empty texts are equal. The smallest id stays, null ids come last; of rows that share text and
    id, one stays. Texts leave their partition only if the filters count their fingerprint more than once, and then one
    copy per partition.
    """
    raw = common.texts(docs, id_col, text_col)
    own = raw.select("doc_id", normalised(F.col("text")).alias("text"), F.xxhash64("text").alias("text_hash"))
    extra = ["text_hash"] if with_hash else []
    marks = store(
        own.select("doc_id", F.xxhash64("text").alias("fingerprint"), F.sha2("text", 256).alias("text_sha256"), *extra),
        "marks",
    )
    own = own.drop("text_hash")
    repeated = store(repeated_fingerprints(marks, "fingerprint", marks.count()), "repeated")
    # Byte verification: equal fingerprints are grouped by their text itself.
    suspects = own.withColumn("fingerprint", F.xxhash64("text")).join(
        common.broadcast_if_bytes(repeated), "fingerprint", "left_semi"
    )
    equal = (
        suspects.groupBy("fingerprint", "text")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    joined = marks.join(common.broadcast_if_bytes(store(equal, "groups")), "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "text_sha256",
        *extra,
    )
    same_row = Window.partitionBy("text_sha256", "doc_id").orderBy(*extra or [F.lit(1)])
    return joined.withColumn("nth", F.row_number().over(same_row)).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
        *extra,
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each text.

    Rows of one text and id that differ in white space are told apart by a hash of the whole text, of which the smallest
    stays; rows alike in both are one row twice.
    """
    found = store(groups(docs, id_col, text_col, with_hash=True), "grouped")
    # One (id, whole text) of each normalised text stays; all others go.
    chosen = found.filter("kept").select("text_sha256", F.col("text_hash").alias("kept_hash"))
    gone = found.filter("group_size > 1").join(chosen, "text_sha256").filter("not (doc_id <=> keep_id) or text_hash <> kept_hash")
    left = common.without_rows(docs, store(gone.select("doc_id", "text_hash"), "dropped"), id_col, text_col)
    twice = found.filter("not kept and doc_id <=> keep_id").join(chosen, "text_sha256").filter("text_hash = kept_hash")
    ids = store(twice.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "twice")
    if ids.isEmpty():
        return left
    key = [c.alias(n) for c, n in zip(common.row_key(id_col, text_col), ("_id", "_hash"), strict=True)]
    whole = left.select(F.struct("*").alias("row"), *key)
    same = whole["_id"].eqNullSafe(ids["_id"]) & (whole["_hash"] == ids["_hash"])
    once = whole.join(ids, same, "left_semi").groupBy("_id", "_hash").agg(F.any_value("row").alias("row"))
    return whole.join(ids, same, "left_anti").select("row.*").unionByName(once.select("row.*"))
