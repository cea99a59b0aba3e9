"""New raw parts to reduced rows, each part once, restartable."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.operators.reduction import WORK_SCHEMA, parse_lines, reduce_records, split_records
from papyrine.session import stage
from papyrine.sources.readers import new_files, read_lines


def reduced_stream(lines: DataFrame, schema: str = WORK_SCHEMA) -> DataFrame:
    """Lines (stream or batch) to reduced rows; no state is kept."""
    good, _ = split_records(parse_lines(lines, schema))
    return reduce_records(good)


def incremental_reduce(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = WORK_SCHEMA, files_per_batch: int = 1000
) -> None:
    """Reduce the parts that arrived since the last call and stop.

    The checkpoint remembers the parts, the file sink commits a batch as a whole: a
    call that dies is repeated by the next without loss or duplicates.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source)
    query = (
        reduced_stream(lines, schema)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


MANIFEST = "path string, ingest_run string, run_no bigint, is_full boolean"


def ingest_new_parts(
    spark: SparkSession,
    source: str,
    target: str,
    manifest: str,
    force_overwrite: bool = False,
    glob: str = "*",
    rejects: str | None = None,
) -> int:
    """The same as a batch: parts missing from the manifest table are reduced and recorded.

    Returns the number of parts taken. Both tables are only appended to, and a run counts
    once its manifest, one file written last, is there: rows carry their run, and
    ``recorded_rows`` leaves out runs that died. ``force_overwrite`` takes every part again
    in a full run, which replaces all earlier runs at that same moment; their rows stay on
    disk, unread. Lines that cannot be parsed are appended to ``rejects`` where it is given.
    """
    recorded = _recorded(spark, manifest)
    known = None if force_overwrite else _current(recorded)
    parts = stage(new_files(spark, source, known, glob).select("path"))
    paths = sorted(row.path for row in parts.toLocalIterator())
    if not paths:
        return 0
    next_no = recorded.agg(F.coalesce(F.max("run_no"), F.lit(0)) + 1)
    run, run_no = next_no.select(F.expr("'run-' || uuid()"), F.col(next_no.columns[0])).first()
    good, bad = split_records(parse_lines(read_lines(spark, paths)))
    reduce_records(good).withColumn("ingest_run", F.lit(run)).write.mode("append").parquet(target)
    if rejects is not None:
        bad.withColumn("ingest_run", F.lit(run)).write.mode("append").parquet(rejects)
    done = parts.select("path", F.lit(run).alias("ingest_run"), F.lit(run_no).cast("bigint").alias("run_no"))
    done.withColumn("is_full", F.lit(force_overwrite)).coalesce(1).write.mode("append").parquet(manifest)
    return len(paths)


def recorded_rows(spark: SparkSession, target: str, manifest: str) -> DataFrame:
    """Rows of completed runs since the last full one."""
    runs = _current(_recorded(spark, manifest)).select("ingest_run").distinct()
    return spark.read.parquet(target).join(runs, "ingest_run", "left_semi").drop("ingest_run")


def _recorded(spark: SparkSession, manifest: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(manifest)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def _current(recorded: DataFrame) -> DataFrame:
    full = recorded.filter("is_full").agg(F.coalesce(F.max("run_no"), F.lit(0)))
    return recorded.filter(F.col("run_no") >= full.scalar())
