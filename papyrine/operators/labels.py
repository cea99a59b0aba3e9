"""Class labels: contiguous indices, counts, shares, and their way back onto the works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.operators.ranking import total_order_index
from papyrine.operators.sizing import broadcast_if_small
from papyrine.session import stage


def with_percent(counts: DataFrame, count_col: str, name: str, total: DataFrame | None = None) -> DataFrame:
    """Add each count's percent of all counts, or of the single number in ``total``."""
    if total is None:
        total = counts.agg(F.sum(count_col))
    return counts.withColumn(name, F.col(count_col) * F.lit(100.0) / total.scalar())


def class_index(counts: DataFrame, keys: list[str], count_col: str, index_col: str) -> DataFrame:
    """0-based index by descending count; the keys break ties, so it is repeatable."""
    order = [F.col(count_col).desc_nulls_last()] + [F.col(k).asc_nulls_last() for k in keys]
    return total_order_index(stage(counts), order, index_col)


def attach_labels(df: DataFrame, labels: DataFrame, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """LEFT lookup of label columns. ``on``: column of ``df`` -> column of ``labels``;
    ``take``: column of ``labels`` -> new name. NULL keys match nothing."""
    picked = broadcast_if_small(
        labels.select(
            *[F.col(right).alias(f"_key_{left}") for left, right in on.items()],
            *[F.col(c).alias(n) for c, n in take.items()],
        )
    )
    condition = F.lit(True)
    for left in on:
        condition = condition & (df[left] == picked[f"_key_{left}"])
    return df.join(picked, condition, "left").drop(*[f"_key_{left}" for left in on])


def class_distribution(df: DataFrame, keys: list[str], total: DataFrame | None = None, digits: int = 2) -> DataFrame:
    """Rows and percent per class, largest first. ``total``: another frame whose row
    count is the denominator."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("number_of_papers"))
    whole = None if total is None else total.agg(F.count(F.lit(1)))
    shares = with_percent(counts, "number_of_papers", "percent_of_papers", whole)
    return shares.withColumn("percent_of_papers", F.round("percent_of_papers", digits)).orderBy(
        F.desc("number_of_papers"), *[F.col(k).asc_nulls_last() for k in keys]
    )


def dataset_size(df: DataFrame, distinct: dict[str, str], approximate: bool = False) -> DataFrame:
    """One row: number of rows and of distinct values. ``distinct``: new name -> column."""
    count: Column = F.count(F.lit(1)).alias("number_of_papers")
    how = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(count, *[how(F.col(c)).alias(n) for n, c in distinct.items()])


def split_shares(parts: list[DataFrame], whole: DataFrame) -> DataFrame:
    """Rows and percent per subset, from the stored split tables stacked into one report."""
    report = None
    for part in parts:
        counts = part.groupBy("subset").agg(F.count(F.lit(1)).alias("c"))
        report = counts if report is None else report.unionByName(counts)
    return with_percent(report, "c", "p", whole.agg(F.count(F.lit(1))))
