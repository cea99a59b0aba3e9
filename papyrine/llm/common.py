"""What the operators share: plain inputs, bounded Arrow batches, stored intermediate results."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.session import scratch_path

#: Rows that one Arrow batch holds at most: long documents stay a few dozen MB together.
BATCH_ROWS = 500
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the whole text (a null text is empty); other columns cannot clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``step`` on every Arrow batch of ``df``, batches bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := step(batch)) is not None:
                yield out

    return map_partitions(df, run, schema)


def map_partitions(
    df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``step`` on the batches of each partition, batches bounded."""
    prepare(df.sparkSession)
    return df.mapInArrow(step, schema)


def map_groups(df: DataFrame, keys: list[str], step: Callable, schema: str) -> DataFrame:
    """``step`` on the Arrow table of each group; groups are of bounded size by their keys."""
    prepare(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(step, schema)


def prepare(spark: SparkSession) -> None:
    """Batches are bounded, and workers find this package where the driver did (elsewhere it is shipped with the job)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))
    if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


#: Bytes of a stored table up to which it is sent to every executor.
BROADCAST_BYTES = 8 << 20


def broadcast_if_bytes(stored: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``stored`` with a broadcast hint if its rows are known to take at most ``limit`` bytes, else as it is.

    Rows are counted, fixed columns count 8 bytes and others their measured length; without the hint the join is a shuffle
    join, whose skewed partitions Spark splits.
    """
    lengths = [
        8 * F.size(c) + 8 if t.startswith("array") else F.length(c) + 8 if t in ("string", "binary") else F.lit(8)
        for c, t in stored.dtypes
    ]
    size = stored.agg(F.sum(sum(lengths[1:], lengths[0]).cast("long"))).first()[0] or 0
    return F.broadcast(stored) if size <= limit else stored


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once, as compressed Parquet in the shared folder, and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without_rows(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is not in ``dropped`` (columns ``doc_id``, ``text_hash``), all columns kept."""
    gone = dropped.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    whole = docs.select(F.struct("*").alias("row"), *[c.alias(n) for c, n in zip(row_key(id_col, text_col), ("_id", "_hash"), strict=True)])
    gone = store(gone, "gone")
    left = whole.join(
        broadcast_if_bytes(gone),
        whole["_id"].eqNullSafe(gone["_id"]) & (whole["_hash"] == gone["_hash"]),
        "left_anti",
    )
    return left.select("row.*")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> tuple[F.Column, F.Column]:
    """What tells rows apart: the id and a hash of the text, so that rows that share an id are still rows of their own."""
    return F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


#: Buckets per shuffle partition that packed rows are dealt to.
BUCKETS_PER_PARTITION = 8
PACKED = "bucket long, payload binary"


def packed(table: pa.Table, bucket: np.ndarray) -> pa.RecordBatch:
    """One row per bucket with its rows of ``table``, in their order, as a compressed Arrow stream.

    For millions of small rows on their way to a task that takes all rows of a bucket anyway: a shuffled row of its own
    would cost more than what is in it.
    """
    order = np.argsort(bucket, kind="stable")
    table, bucket = table.take(pa.array(order)).combine_chunks(), bucket[order]
    cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
    options, payloads = pa.ipc.IpcWriteOptions(compression="zstd"), []
    for start, stop in zip(cuts, cuts[1:], strict=False):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
            writer.write_table(table.slice(start, stop - start))
        payloads.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts[:-1]], pa.int64()), pa.array(payloads, pa.binary())], ["bucket", "payload"]
    )


def unpacked(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of the packed batches."""
    tables = [pa.ipc.open_stream(raw).read_all() for batch in batches for raw in batch["payload"].to_pylist()]
    return pa.concat_tables(tables) if tables else None
