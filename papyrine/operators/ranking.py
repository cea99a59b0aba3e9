"""Exact ranks inside classes and over whole tables, with no class or table in one task.

A class may hold a third of all rows, so a window over the class is out of the
question. Rows are ordered by a seeded hash, and hash prefixes are uniform:
a class is cut into slices of the hash range, as many as the square root of its
rows, and counting rows per slice tells which slice holds the row of a wanted
rank. Only those slices are sorted, each id once. The result is one small set of cut-off rows per class;
tagging or filtering the table is then a comparison with those, without moving
the table's own (wide) rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.operators.sizing import BROADCAST_ROWS, broadcast_if_small
from papyrine.session import stage

PREFIX_DIGITS = 8
"""Hash digits that place a row in its slice; a class has the square root of its rows as slices."""

HOT_SHARE = 1000
"""Classes with more than one in so many rows, fewer than that many, are joined by broadcast."""

SPREAD = 1024

Ties = Sequence[str]


def seeded_hash(id_col: str | Column, seed: int | str) -> Column:
    """Repeatable stand-in for a random sort key: the same on every run and every engine."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")).cast("binary"))


def _key_fields(id_col: str, seed: int | str, ties: Ties) -> list[Column]:
    """Hash (empty for a null id, so these come first), id, and the columns that order rows of one id."""
    hashed = F.coalesce(seeded_hash(id_col, seed), F.lit("")).alias("h")
    return [hashed, F.col(id_col).alias("i"), *[F.col(c).alias(f"t{n}") for n, c in enumerate(ties)]]


def _attach(df: DataFrame, per_class: DataFrame, by: str, spread: Column, keep: str) -> DataFrame:
    """Add the columns of ``per_class`` (``_class``, ``_hot``, others) to the rows of ``df``.

    Hot classes are few by definition and always broadcast. The others are broadcast up to
    a measured size; beyond it their rows are shuffled by class, while rows of hot classes,
    which are served already, are spread evenly.
    """
    names = [c for c in per_class.columns if c not in ("_class", "_hot")]
    hot = per_class.filter("_hot").select(F.col("_class").alias("_hot_class"), F.lit(True).alias("_served"), *[
        F.col(n).alias(f"_hot_{n}") for n in names
    ])
    rest = per_class.filter("not _hot").drop("_hot").withColumn("_at", F.lit(0).cast("bigint"))
    rows = df.join(F.broadcast(hot), df[by].eqNullSafe(hot["_hot_class"]), "left")
    served = F.coalesce("_served", F.lit(False))
    rows = rows.withColumn("_spread", F.when(served, F.pmod(F.xxhash64(spread), F.lit(SPREAD)) + 1).otherwise(0))
    met = F.col(by).eqNullSafe(F.col("_class")) & (F.col("_spread") == F.col("_at"))
    rows = rows.join(broadcast_if_small(rest, BROADCAST_ROWS), met, "left")
    rows = rows.withColumns({n: F.coalesce(f"_hot_{n}", n) for n in names})
    if keep == "inner":
        rows = rows.filter(served | F.col("_at").isNotNull())
    return rows.drop("_hot_class", "_served", "_spread", "_class", "_at", *[f"_hot_{n}" for n in names])


def class_cutoffs(
    df: DataFrame, by: str, id_col: str, seed: int | str, ranks: Callable[[Column], Column], ties: Ties = ()
) -> DataFrame:
    """One row per class with a wanted rank: ``cutoffs`` = sort keys of the rows at the wanted
    ranks, ascending, and ``repeated``, whether one of these keys occurs more than once.

    ``ranks`` maps the class size to a short array of 1-based ranks. A cut-off is the hash, the
    id, the ``ties`` and the place among rows alike in these. Only ``by``, ``id_col`` and ``ties``
    are read from ``df``. Null ids come first.
    """
    keyed = df.select(F.col(by).alias("class"), F.struct(*_key_fields(id_col, seed, ties)).alias("key"))
    sizes = stage(keyed.groupBy("class").agg(F.count(F.lit(1)).alias("class_rows")))
    rows = sizes.agg(F.coalesce(F.sum("class_rows"), F.lit(0))).first()[0]
    asked = sizes.select(
        F.col("class").alias("_class"),
        (F.col("class_rows") * HOT_SHARE > rows).alias("_hot"),
        F.ceil(F.sqrt("class_rows")).cast("bigint").alias("slices"),
        ranks(F.col("class_rows")).alias("ranks"),
    ).filter(F.size("ranks") > 0)
    prefix = F.coalesce(F.conv(F.substring("key.h", 1, PREFIX_DIGITS), 16, 10).cast("bigint"), F.lit(0))
    slice_of = F.floor(prefix * F.col("slices") / F.lit(float(16**PREFIX_DIGITS)))
    placed = _attach(keyed, asked.drop("ranks"), "class", F.col("key"), "inner").withColumn("slice", slice_of)
    # Slices per class and rows per slice both are about the square root of the class.
    before = Window.partitionBy("class").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        placed.groupBy("class", "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    wanted = (
        counted.join(asked.select("_class", "ranks"), F.col("class").eqNullSafe(F.col("_class")))
        .withColumn("rank", F.explode("ranks"))
        .filter((F.col("rank") > F.col("rows_before")) & (F.col("rank") <= F.col("rows_before") + F.col("n")))
        .withColumn("wanted", F.struct("slice", (F.col("rank") - F.col("rows_before")).alias("place")))
        .groupBy("_class")
        .agg(F.collect_list("wanted").alias("wanted"))
    )
    searched = asked.drop("ranks").withColumnRenamed("_class", "_own")
    searched = stage(searched.join(wanted, F.col("_own").eqNullSafe(F.col("_class"))).drop("_own"))
    in_slice = Window.partitionBy("class", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    found = (
        _attach(keyed, searched, "class", F.col("key"), "inner")
        .withColumn("slice", slice_of)
        .withColumn("places", F.filter("wanted", lambda w: w["slice"] == F.col("slice")))
        .filter(F.size("places") > 0)
        .groupBy("class", "slice", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.first("places").alias("places"))
        .withColumn("above", F.coalesce(F.sum("n").over(in_slice), F.lit(0)))
        .withColumn("place", F.explode("places.place"))
        .withColumn("place", F.col("place") - F.col("above"))
        .filter(F.col("place").between(1, F.col("n")))
        .groupBy("class")
        .agg(
            F.sort_array(F.collect_list(F.struct("key.*", "place"))).alias("cutoffs"),
            (F.max("n") > 1).alias("repeated"),
        )
    )
    hot = asked.select(F.col("_class").alias("_own"), "_hot")
    return stage(hot.join(found.withColumnRenamed("class", "_class"), F.col("_own").eqNullSafe(F.col("_class"))).drop("_own"))


def _with_cutoffs(df: DataFrame, cutoffs: DataFrame, by: str, id_col: str, seed: int | str, ties: Ties) -> DataFrame:
    """Attach the class's cut-offs (null where it has none) and ``_key``, what they are compared with.

    The place among rows alike matters only at a repeated cut-off; only such rows are numbered.
    """
    fields = _key_fields(id_col, seed, ties)
    rows = _attach(df, cutoffs, by, F.col(id_col), "left").withColumn("_key", F.struct(*fields))

    def with_place(frame: DataFrame, place: Column) -> DataFrame:
        return frame.withColumn("_key", F.struct("_key.*", place.cast("bigint").alias("place")))

    if cutoffs.filter("repeated").isEmpty():
        return with_place(rows, F.lit(1)).drop("repeated")
    names = ["h", "i", *[f"t{n}" for n in range(len(ties))]]

    def same(cutoff: Column) -> Column:
        return F.struct(*[cutoff[n].alias(n) for n in names]) == F.col("_key")

    shared = F.coalesce(F.col("repeated") & F.exists("cutoffs", same), F.lit(False))
    tied = numbered_copies(rows.filter(shared), [F.col(by), F.col("_key")], "_copy")
    alone = with_place(rows.filter(~shared), F.lit(1))
    return alone.unionByName(with_place(tied, F.col("_copy")).drop("_copy")).drop("repeated")


def numbered_copies(df: DataFrame, group: list[Column], name: str) -> DataFrame:
    """1-based number of each row among the rows of its group, in no particular order.

    Rows are numbered inside their partition and moved up by the rows of earlier
    partitions, so a group of any size stays spread. The rows are staged.
    """
    keyed = df.withColumn("_group", F.struct(*[c.alias(f"g{n}") for n, c in enumerate(group)]))
    rows = stage(keyed.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33)))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy("_group", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_group", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
        .select(F.col("_group").alias("_g"), F.col("_part").alias("_p"), "_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_group", "_part").orderBy("_row"))
    return (
        rows.withColumn("_inside", inside)
        .join(parts, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop("_group", "_row", "_part", "_inside", "_g", "_p", "_offset")
    )


def tile_ranks(buckets: int) -> Callable[[Column], Column]:
    """Last rank of each tile but the last, for tiles whose sizes differ by at most one."""

    def ranks(rows: Column) -> Column:
        ends = F.transform(
            F.sequence(F.lit(1), F.lit(buckets - 1)),
            lambda tile: tile * F.floor(rows / buckets) + F.least(tile, rows % buckets),
        )
        return F.array_distinct(ends)

    return ranks


def ntile_by_class(
    df: DataFrame, by: str, id_col: str, seed: int | str, buckets: int, name: str, ties: Ties = ()
) -> DataFrame:
    """Add the 1-based tile of each row inside its class, in seeded random order.

    Null ids come first. Rows of one id are ordered by ``ties``; rows alike in these too are
    told apart by row, so tiles have their exact sizes.
    """
    cutoffs = class_cutoffs(df, by, id_col, seed, tile_ranks(buckets), ties)
    tagged = _with_cutoffs(df, cutoffs, by, id_col, seed, ties)
    # Spelled out per cut-off: compiled code.
    tile = F.lit(1)
    for place in range(buckets - 1):
        tile = tile + F.when(F.get("cutoffs", F.lit(place)) < F.col("_key"), 1).otherwise(0)
    return tagged.withColumn(name, tile.cast("bigint")).drop("cutoffs", "_key")


def mark_up_to(df: DataFrame, by: str, id_col: str, seed: int | str, rows: int, name: str, ties: Ties = ()) -> DataFrame:
    """Add whether the row is among the first ``rows`` (>= 1) of its class, in seeded random order.

    Exactly that many rows of a larger class are marked, also where ids are null or repeated.
    """
    wanted = class_cutoffs(df, by, id_col, seed, lambda n: F.when(n > rows, F.array(F.lit(rows).cast("bigint"))), ties)
    tagged = _with_cutoffs(df, wanted, by, id_col, seed, ties)
    inside = F.col("cutoffs").isNull() | (F.col("_key") <= F.get("cutoffs", F.lit(0)))
    return tagged.withColumn(name, inside).drop("cutoffs", "_key")


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1-based position in the total order ``order``, without a single-task window.

    Rows are range-partitioned and sorted; the generated ids then hold the partition and
    the place in it. They are staged with the rows, so that they stay as they are, and the
    offsets of the partitions are one row each. ``order`` must tell all rows apart, else
    equal rows crowd into one range.
    """
    ranged = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_id", 33)).withColumn("_place", F.col("_id") - F.shiftleft("_range", 33))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_place") + F.col("_offset") + 1)
        .drop("_id", "_range", "_place", "_offset")
    )


def total_order_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """0-based position of each row of a staged label table."""
    return global_row_number(df, order, name).withColumn(name, F.col(name) - 1)
