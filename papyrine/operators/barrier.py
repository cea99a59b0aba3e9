"""Expensive expressions that must run once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` for costly expressions (JSON parsing, text cutting).

    Filters on an ordinary computed column are pushed below it by repeating its
    expression; a generator stops that, so each expression is evaluated once.
    """
    made = F.struct(*[expression.alias(name) for name, expression in columns.items()])
    return df.select("*", F.inline(F.array(made)))
