"""Coverage, join success, licence and taxonomy reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators.labels import with_percent
from papyrine.operators.linkage import lookup
from papyrine.session import stage


def coverage(df: DataFrame, flags: list[str], rows: Column | None = None) -> DataFrame:
    """Rows per combination of flags: in millions, in percent, and the total in millions.

    ``rows`` is a weight for frames in which one row stands for several.
    """
    counts = stage(df.groupBy(*flags).agg(F.sum(F.lit(1) if rows is None else rows).alias("_n")))
    total = counts.agg(F.sum("_n")).scalar()
    return (
        with_percent(counts, "_n", "p")
        .withColumn("c_mill", F.col("_n") / F.lit(1e6))
        .withColumn("total_mill", total / F.lit(1e6))
        .drop("_n")
        .orderBy(F.asc_nulls_last(flags[0]), *[F.desc_nulls_last(f) for f in flags[1:]])
    )


def with_matches(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, spread_by: str, name: str):
    """Add the number of rows of ``right`` that a LEFT JOIN on the key would find.

    The right side is counted per key first, so a key shared by many rows on both
    sides is a multiplication and not a list of pairs.
    """
    counts = right.groupBy(F.col(right_key).alias("_right")).agg(F.count(F.lit(1)).alias("_n"))
    found = lookup(left, counts, left_key, "_right", spread_by)
    return found.withColumn(name, F.coalesce("_n", F.lit(0))).drop("_right", "_n")


def coverage_crosstab(
    left: DataFrame, right: DataFrame, keys: list[tuple[str, str, str]], flags: list[str], spread_by: str
) -> DataFrame:
    """Cross-tab of id flags and join success of a fallback linkage, over its joined rows.

    ``keys``: (left column, right column, name of the success flag), tried in turn.
    ``flags``: all columns of the cross-tab, success flags included.
    """
    joined = left.withColumn("_rows", F.lit(1).cast("bigint")).withColumn("_open", F.lit(True))
    for left_key, right_key, success in keys:
        key = F.when(F.col("_open"), F.col(left_key))
        joined = (
            with_matches(joined, right, key, right_key, spread_by, "_found")
            .withColumn(success, F.when(F.col("_found") > 0, 1).otherwise(0))
            .withColumn("_rows", F.col("_rows") * F.greatest(F.col("_found"), F.lit(1)))
            .withColumn("_open", F.col("_open") & (F.col("_found") == 0))
        )
    return coverage(joined, flags, F.col("_rows"))


def join_success(left: DataFrame, rights: dict[str, tuple[DataFrame, str, str]], spread_by: str) -> DataFrame:
    """Rows with and without a match per join, and the plain row count as ``original``.

    ``rights``: name -> (frame, left key, right key).
    """
    report = left.agg(F.count(F.lit(1)).alias("c")).select(
        F.lit("original").alias("join_type"), F.lit(None).cast("int").alias("join_worked"), "c"
    )
    for name, (right, left_key, right_key) in rights.items():
        keys = left.select(*{spread_by, left_key})
        found = with_matches(keys, right, F.col(left_key), right_key, spread_by, "_found")
        counts = (
            found.groupBy(F.when(F.col("_found") > 0, 1).otherwise(0).alias("join_worked"))
            .agg(F.sum(F.greatest("_found", F.lit(1))).alias("c"))
            .select(F.lit(name).alias("join_type"), "join_worked", "c")
        )
        report = report.unionByName(counts)
    return report


def rollups(df: DataFrame, levels: dict[str, tuple[list[str], Column | None]]) -> DataFrame:
    """Row counts at several levels of a taxonomy, from one pass over the rows.

    ``levels``: name -> (columns, filter). The finest grouping is counted first; every
    level is a sum over that.
    """
    columns: list[str] = []
    for wanted, _ in levels.values():
        columns += [c for c in wanted if c not in columns]
    finest = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    report = None
    for name, (wanted, keep) in levels.items():
        rows = finest if keep is None else finest.filter(keep)
        level = (
            rows.groupBy(*wanted)
            .agg(F.sum("_n").alias("c"))
            .select(
                F.lit(name).alias("level"),
                *[F.col(c) if c in wanted else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns],
                "c",
            )
        )
        report = level if report is None else report.unionByName(level)
    return report


def value_frequency(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """Distinct values and how often they occur, most frequent first."""
    return (
        df.groupBy(value.alias(name))
        .agg(F.count(F.lit(1)).alias("c"))
        .orderBy(F.desc("c"), F.asc_nulls_last(name))
    )
