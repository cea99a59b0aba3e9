"""Splits, caps and samples in a repeatable random order."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.operators.ranking import Ties, global_row_number, mark_up_to, ntile_by_class, seeded_hash
from papyrine.operators.sizing import broadcast_if_small
from papyrine.session import stage


def subset_of_bucket(bucket: Column, test: tuple[int, ...] = (1,), validation: tuple[int, ...] = (2,)) -> Column:
    return F.when(bucket.isin(*test), "test").when(bucket.isin(*validation), "validation").otherwise("train")


def stratified_split(
    df: DataFrame,
    by: str,
    id_col: str,
    seed: int | str = 42,
    buckets: int = 10,
    test: tuple[int, ...] = (1,),
    validation: tuple[int, ...] = (2,),
    ties: Ties = (),
) -> DataFrame:
    """Add ``bucket_10p`` (equal-size random tiles per class) and ``subset``.

    A class of one row goes to test, of two rows to test and validation. Null ids come
    first, rows of one id are ordered by ``ties``.
    """
    tiled = ntile_by_class(df, by, id_col, seed, buckets, "bucket_10p", ties)
    return tiled.withColumn("subset", subset_of_bucket(F.col("bucket_10p"), test, validation))


def class_counts(df: DataFrame, by: str, name: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def attach_class_count(df: DataFrame, by: str, name: str, more_than: int | None = None) -> DataFrame:
    """Add the number of rows of the row's class; optionally keep only larger classes.

    Counts are aggregated before they move and joined back, so no class is
    gathered in one task as a window over the class would do.
    """
    counts = class_counts(df, by, name)
    if more_than is not None:
        counts = counts.filter(F.col(name) > more_than)
    counts = broadcast_if_small(stage(counts))
    how = "left" if more_than is None else "inner"
    return df.join(counts, df[by].eqNullSafe(counts[by]), how).drop(counts[by])


def cap_classes(
    df: DataFrame,
    caps: dict[str, int],
    id_col: str,
    seed: int | str = 42,
    min_count: int | None = None,
    min_col: str | None = None,
    count_name: str = "new_topic_count",
    ties: Ties = (),
) -> DataFrame:
    """Keep rows ranked below ``caps[c]`` in each class of every column ``c``.

    The rank test is ``<``, so a cap of N keeps N-1 rows. All ranks are taken on
    the uncapped input, each in its own random order; null ids come first, rows of one
    id are ordered by ``ties`` and count one by one. With ``min_count``, classes
    of ``min_col`` with no more than that many rows left are dropped and
    ``count_name`` is added.
    """
    if min(caps.values()) < 2:
        raise ValueError("a cap below 2 keeps no rows")
    kept, marks = df, []
    for column, cap in caps.items():
        marks.append(f"_within_{column}")
        kept = mark_up_to(kept, column, id_col, f"{seed}/{column}", cap - 1, marks[-1], ties)
    kept = kept.filter(reduce(and_, map(F.col, marks))).drop(*marks)
    if min_count is None:
        return kept
    return attach_class_count(kept, min_col, count_name, more_than=min_count)


def random_sample(df: DataFrame, id_col: str, k: int, seed: int | str = 42) -> DataFrame:
    """``k`` rows in seeded random order (each task keeps its own first ``k`` only)."""
    return df.orderBy(seeded_hash(id_col, seed), F.col(id_col)).limit(k)


def head_percent(df: DataFrame, id_col: str, percent: float) -> DataFrame:
    """The first ``percent`` % of the rows in id order, rounded half to even; 100 keeps all.

    Null ids come first. Ids are counted before they are ranked, so that a repeated id is one row of the ranking; of the
    copies of the last id as many stay as are wanted, the first by a hash of the row.
    """
    if percent >= 100:
        return df
    counts = stage(df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")))
    rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    wanted = rows.select(F.bround(F.col("rows") * F.lit(percent / 100.0)).cast("bigint")).first()[0]
    last, before = _id_at(counts, id_col, wanted)
    if last is None:
        return df.limit(0)
    own, value = F.col(id_col), F.lit(last[id_col])
    below = F.lit(False) if last[id_col] is None else own.isNull() | (own < value)
    if wanted == before + last["_n"]:
        return df.filter(below | own.eqNullSafe(value))
    copies = df.filter(own.eqNullSafe(value)).orderBy(F.xxhash64(*df.columns)).limit(wanted - before)
    return df.filter(below).unionByName(copies)


def _id_at(counts: DataFrame, id_col: str, place: int):
    """The row of ``counts`` (id, _n) that holds the ``place``-th (from 1) of all rows in id order, and the rows before it.

    Ids are range-partitioned; the sums of the ranges, one row each, tell the range, and only that one is looked through.
    """
    if place < 1:
        return None, 0
    ranged = stage(counts.repartitionByRange(F.col(id_col).asc()).withColumn("_range", F.spark_partition_id()))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ranged.groupBy("_range").agg(F.sum("_n").alias("_rows")).withColumn("_upto", F.sum("_rows").over(ahead))
    found = sums.filter(F.col("_upto") >= place).orderBy("_range").first()
    if found is None:
        return None, 0
    start = found["_upto"] - found["_rows"]
    inside = ranged.filter(F.col("_range") == found["_range"])
    running = Window.orderBy(F.col(id_col).asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = inside.withColumn("_upto", F.sum("_n").over(running) + start).filter(F.col("_upto") >= place).orderBy("_upto").first()
    return row, row["_upto"] - row["_n"]


def page_by_id(df: DataFrame, id_col: str, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` .. ``offset + limit`` in id order, null ids first.

    The first id of the page is looked up among the ids alone; only its own earlier
    copies are sorted along.
    """
    ids = stage(global_row_number(df.select(id_col), [F.col(id_col).asc()], "_row"))
    first = ids.filter(F.col("_row") == offset + 1).first()
    if first is None:
        return df.limit(0)
    value = F.lit(first[id_col])
    copies_from = ids.filter(F.col(id_col).eqNullSafe(value)).agg(F.min("_row")).first()[0]
    rows = df if first[id_col] is None else df.filter(F.col(id_col) >= value)
    return rows.orderBy(id_col).offset(offset + 1 - copies_from).limit(limit)


def page_after(df: DataFrame, id_col: str, last_seen, limit: int) -> DataFrame:
    """The next page after a known id; the filter reaches the scan."""
    return df.filter(F.col(id_col) > F.lit(last_seen)).orderBy(id_col).limit(limit)
