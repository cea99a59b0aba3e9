"""Record linkage between corpora by ordered identifiers, deduplication, id merge chains."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.functions.ids import strip_prefix_id
from papyrine.session import stage

SPREAD = 1024


def lookup(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, spread_by: str) -> DataFrame:
    """LEFT JOIN on one nullable key; NULL matches nothing and '' matches ''.

    Left rows without a key are given ``SPREAD`` different second keys, so that
    they do not all land in the partition of NULL. A hot key that does match is
    split at run time by the adaptive skew join.
    """
    keyed = left.withColumn("_key", left_key).withColumn(
        "_spread",
        F.when(F.col("_key").isNull(), F.pmod(F.xxhash64(F.col(spread_by)), F.lit(SPREAD)) + 1).otherwise(F.lit(0)),
    )
    known = right.filter(F.col(right_key).isNotNull()).withColumn("_zero", F.lit(0).cast("bigint"))
    match = keyed["_key"].eqNullSafe(known[right_key]) & (keyed["_spread"] == known["_zero"])
    return keyed.join(known, match, "left").drop("_key", "_spread", "_zero")


def dedup_keep_first(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``. Each task keeps one row per key before the
    shuffle (window group limit), so a key with very many copies moves few rows."""
    keys = [key] if isinstance(key, str) else key
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(first)).filter(F.col("_row") == 1).drop("_row")


@dataclass(frozen=True)
class LinkKey:
    """``left`` = ``right`` links two records and is recorded as ``tag``."""

    left: str
    right: str
    tag: str


def link_with_fallback(
    left: DataFrame,
    right: DataFrame,
    keys: list[LinkKey],
    spread_by: str,
    best: list[Column] | None = None,
    strict_link_flag: bool = False,
    prefix: str = "linked_",
    method: str = "joined_on",
) -> DataFrame:
    """LEFT linkage by the first key, then by the next for rows not linked yet, and so on.

    All columns come from the one record that matched, named ``prefix`` + name.
    ``method`` is the tag of the key that linked. As in the pipelines this
    serves, a record found by a later key is tagged only if it also has the
    first key; ``strict_link_flag`` tags every link.

    ``best`` orders the candidates of one key, ascending with NULL first: only the first is linked
    and ``<tag>_candidates`` tells how many there were. A key with many records on
    both sides then costs rows, not pairs. Without ``best`` every match gives a row.
    """
    fields = right.columns
    whole = F.struct(*[F.col(c) for c in fields])
    linked = left.withColumn("_found", F.lit(None).cast(right.schema)).withColumn(method, F.lit(None).cast("string"))
    for key in keys:
        side = right.filter(F.col(key.right).isNotNull()).withColumn("_next", whole)
        if best is None:
            side = side.select(F.col(key.right).alias("_right"), "_next")
        else:
            side = side.groupBy(F.col(key.right).alias("_right")).agg(
                F.min_by("_next", F.struct(*best)).alias("_next"), F.count(F.lit(1)).alias("_n")
            )
        # Rows already linked join on NULL, which matches nothing.
        linked = lookup(linked, side, F.when(F.col("_found").isNull(), F.col(key.left)), "_right", spread_by)
        tagged = F.col("_next").isNotNull()
        if not strict_link_flag:
            tagged = tagged & F.col(f"_next.{keys[0].right}").isNotNull()
        linked = (
            linked.withColumn(method, F.coalesce(F.col(method), F.when(tagged, key.tag)))
            .withColumn(f"{key.tag}_join_worked", F.when(F.col("_next").isNull(), 0).otherwise(1))
            .withColumn("_found", F.coalesce("_found", "_next"))
            .drop("_next", "_right")
        )
        if best is not None:
            linked = linked.withColumn(f"{key.tag}_candidates", F.coalesce("_n", F.lit(0))).drop("_n")
    return linked.select(
        *[c for c in linked.columns if c != "_found"], *[F.col(f"_found.{c}").alias(f"{prefix}{c}") for c in fields]
    )


def merge_map(df: DataFrame, letter: str = "W") -> DataFrame:
    """Ids without their letter as numbers; a wrong letter raises at the cast."""
    return df.select(
        *[strip_prefix_id(F.col(c), letter).cast("bigint").alias(c) for c in ("id", "merge_into_id")]
    )


def resolve_merges(merges: DataFrame, hops: int = 4) -> DataFrame:
    """Follow ``id -> merge_into_id`` for up to ``hops`` steps.

    Keeps every step (``id_2``, ``merge_into_id_2``, ...) and adds
    ``merge_into_id_final``, the last target reached. A source id that occurs
    twice gives two chains.
    """
    step = merges.select("id", "merge_into_id")
    chain = step
    for hop in range(2, hops + 1):
        following = step.select(F.col("id").alias(f"id_{hop}"), F.col("merge_into_id").alias(f"merge_into_id_{hop}"))
        previous = "merge_into_id" if hop == 2 else f"merge_into_id_{hop - 1}"
        chain = chain.join(following, F.col(previous) == F.col(f"id_{hop}"), "left")
    targets = [f"merge_into_id_{hop}" for hop in range(hops, 1, -1)] + ["merge_into_id"]
    return chain.withColumn("merge_into_id_final", F.coalesce(*targets))


def resolve_merges_fully(merges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id``, ``merge_into_id``, ``merge_into_id_final`` for chains of any length.

    Each round doubles the distance covered and is staged. Chains that run into a
    cycle have no last target: NULL. Duplicate source ids keep their smallest target.
    """
    edges = stage(dedup_keep_first(merges.select("id", "merge_into_id"), "id", [F.col("merge_into_id").asc()]))
    longest, reach = edges.count(), 1
    current = edges.select("id", F.col("merge_into_id").alias("target"))
    for _ in range(max_rounds):
        following = current.select(F.col("id").alias("_id"), F.col("target").alias("_next"))
        current = stage(
            current.join(following, F.col("target") == F.col("_id"), "left").select(
                "id", F.coalesce("_next", "target").alias("target"), F.col("_id").isNotNull().alias("open")
            )
        )
        reach *= 2
        if reach > longest or current.filter("open").isEmpty():
            break
        current = current.drop("open")
    sources = edges.select(F.col("id").alias("_source"))
    ends = current.join(sources, F.col("target") == F.col("_source"), "left").select(
        "id", F.when(F.col("_source").isNull(), F.col("target")).alias("merge_into_id_final")
    )
    return edges.join(ends, "id")
