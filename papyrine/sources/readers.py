"""Reading raw files: JSON lines, date partitions, CSV maps, text lines, parts of a file set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.operators.reduction import WORK_SCHEMA, parse_lines, split_records


def read_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """``value`` and ``source_file`` of every line; ``glob`` leaves out files such as manifests."""
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    return reader.text(paths).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_jsonl(
    spark: SparkSession, paths: str | list[str], schema: str = WORK_SCHEMA, key: str = "id", glob: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good records, and rejected lines (unparsable, or without ``key``) with file and reason."""
    return split_records(parse_lines(read_lines(spark, paths, glob), schema, key))


def read_partitioned(spark: SparkSession, folder: str, schema: str, file_format: str = "json") -> DataFrame:
    """``<folder>/updated_date=YYYY-MM-DD/part`` folders as one table with the date as a column,
    so that a filter on it skips folders."""
    return (
        spark.read.schema(schema)
        .option("basePath", folder)
        .format(file_format)
        .load(folder)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def read_csv_map(spark: SparkSession, path: str | list[str], schema: str = "id string, merge_into_id string") -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Path, size and time of every file below ``folder``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return files.load(folder).select("path", "length", "modificationTime")


def file_range(spark: SparkSession, folder: str, first: int, last: int, glob: str = "*") -> list[str]:
    """Paths with index ``first`` <= i < ``last`` in name order; only these names reach the driver."""
    ordered = list_files(spark, folder, glob).select("path").orderBy("path")
    return [row.path for row in ordered.offset(first).limit(last - first).collect()]


def new_files(spark: SparkSession, folder: str, done: DataFrame | None, glob: str = "*") -> DataFrame:
    """Files that the manifest ``done`` (column ``path``) does not know yet."""
    files = list_files(spark, folder, glob)
    return files if done is None else files.join(done.select("path"), "path", "left_anti")
