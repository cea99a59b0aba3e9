"""Broadcasts that are decided by a measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
"""Both bound a broadcast; the bytes are those of the rows as text."""


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of ``max_bytes`` in all; reads no more rows to find out."""
    size = F.octet_length(F.to_json(F.struct("*")))
    rows, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and held <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a measured small side; a larger one keeps the shuffle join,
    whose hot partitions are split at run time by adaptive execution.

    ``df`` is read twice (count, join), so pass a staged frame or a plain scan.
    """
    return F.broadcast(df) if fits(df, max_rows) else df


def frequent_from(df: DataFrame, count: str, key: str, row_bytes: Column | int = 24) -> int:
    """The smallest power of two such that the rows of ``df`` with that ``count`` or more can be broadcast together.

    For a join in which few keys have most of the rows: those of frequent keys meet a broadcast, the rest are shuffled.
    ``df`` is read once for this and twice for the join, so pass a stored frame. ``row_bytes``: of a row besides its ``key``.
    """
    power = F.floor(F.log2(count)).alias("power")
    size = F.sum(F.octet_length(key) + row_bytes).alias("bytes")
    powers = df.groupBy(power).agg(F.count(F.lit(1)).alias("rows"), size).orderBy(F.desc("power")).collect()
    rows = held = 0
    least = 1 << 62
    for p in powers:
        rows, held = rows + p["rows"], held + p["bytes"]
        if rows > BROADCAST_ROWS or held > BROADCAST_BYTES:
            break
        least = 1 << p["power"]
    return least
