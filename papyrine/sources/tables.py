"""Tables: create with a strategy, register raw folders, drop, preview; split and pair exports."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STRATEGIES = ("fail", "overwrite", "ignore")


def create_table(
    df: DataFrame,
    database: str,
    name: str,
    overwrite_strategy: str = "fail",
    location: str | None = None,
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, str] | None = None,
    sort_by: list[str] | None = None,
) -> str:
    """Store a frame as a Parquet table: ``created``, ``ignored`` or ``overwritten``.

    An existing table raises (``fail``), is left alone (``ignore``) or is dropped
    with its files first (``overwrite``). ``bucket_by`` (number, column) lays the
    table out for joins on that column without a shuffle; ``sort_by`` orders the rows
    inside each file. ``location`` is the folder of the database.
    """
    if overwrite_strategy not in STRATEGIES:
        raise ValueError(f"unknown overwrite_strategy {overwrite_strategy!r}, use one of {STRATEGIES}")
    spark = df.sparkSession
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    full = f"`{database}`.`{name}`"
    exists = spark.catalog.tableExists(full)
    if exists and overwrite_strategy == "fail":
        raise ValueError(f"table {database}.{name} already exists")
    if exists and overwrite_strategy == "ignore":
        return "ignored"
    writer = (df.sortWithinPartitions(*sort_by) if sort_by and not bucket_by else df).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by)
        writer = writer.sortBy(*sort_by) if sort_by else writer
    writer.mode("overwrite" if overwrite_strategy == "overwrite" else "error").saveAsTable(full)
    return "overwritten" if exists else "created"


def register_inferred(
    spark: SparkSession, paths: str | list[str], database: str, prefix: str, glob: str = "*.gz",
    sampling: float = 1.0, location: str | None = None,
) -> list[str]:
    """Infer the schema of raw JSON folders and register one table ``<prefix><folder>`` per folder."""
    if isinstance(paths, str):
        paths = [paths]
    if not isinstance(paths, list):
        raise ValueError("paths must be a string or a list of strings")
    names = []
    for path in paths:
        rows = spark.read.option("pathGlobFilter", glob).option("samplingRatio", sampling).json(path)
        name = prefix + path.rstrip("/").rsplit("/", 1)[-1]
        create_table(rows, database, name, "overwrite", location)
        names.append(f"{database}.{name}")
    return names


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe_table(spark: SparkSession, name: str, rows: int = 3) -> tuple[DataFrame, int]:
    """A few rows of a table, and its row count."""
    frame = spark.table(name)
    return frame.limit(rows), frame.count()


def write_jsonl(df: DataFrame, path: str) -> None:
    """One gzip file of JSON lines per partition of ``df``."""
    df.write.json(path, compression="gzip")


def write_splits(df: DataFrame, path: str, subset_col: str = "subset") -> None:
    """``<path>/subset=<name>/part.parquet``: every split in one write."""
    df.write.partitionBy(subset_col).parquet(path)


def split_table(df: DataFrame, subset: str, subset_col: str = "subset") -> DataFrame:
    return df.filter(F.col(subset_col) == subset)


def pair_configs(texts: list[str], labels: dict[str, str]) -> dict[str, tuple[str, str]]:
    """Configuration name ``<text>_<label>`` -> (text column, label index column)."""
    return {f"{t}_{n}": (t, c) for t, (n, c) in itertools.product(texts, labels.items())}


def text_label_pairs(df: DataFrame, text: str, label: str, keep: list[str] = ()) -> DataFrame:
    """Two columns, rows with both present."""
    return df.select(*keep, text, label).dropna(subset=[text, label])


def export_pairs(df: DataFrame, texts: list[str], labels: dict[str, str], path: str) -> list[str]:
    """One folder per text/label pair, partitioned by subset."""
    configs = pair_configs(texts, labels)
    for name, (text, label) in configs.items():
        write_splits(text_label_pairs(df, text, label, ["subset"]), f"{path}/{name}")
    return list(configs)
