"""Identifier clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrine.functions.text import strip


def url_last_segment(url: Column) -> Column:
    """``https://host/T10062`` -> ``T10062``; a text without ``/`` stays as it is."""
    return F.element_at(F.split(url, "/"), -1)


def url_number(url: Column) -> Column:
    """``https://host/W2079861989`` -> ``2079861989`` (last segment without its first letter)."""
    return F.substr(url_last_segment(url), F.lit(2))


def url_path_id(url: Column, drop: int = 3) -> Column:
    """``https://doi.org/10.1/a/b`` -> ``10.1/a/b``; fewer than ``drop`` slashes give ''."""
    parts = F.split(url, "/")
    rest = F.slice(parts, F.lit(drop + 1), F.greatest(F.size(parts) - drop, F.lit(0)))
    return F.when(url.isNotNull(), F.array_join(rest, "/"))


def strip_prefix_id(value: Column, letter: str) -> Column:
    """``W12`` -> ``12``; anything else is tagged ``ERROR: ...``."""
    return F.when(value.startswith(letter), F.substr(value, F.lit(len(letter) + 1))).otherwise(
        F.concat(F.lit("ERROR: "), value)
    )


def first_letter(value: Column) -> Column:
    return F.substring(value, 1, 1)


def present(*columns: Column) -> Column:
    """1 if any of the columns is neither NULL nor ''."""
    filled = F.lit(False)
    for column in columns:
        filled = filled | (F.coalesce(column, F.lit("")) != "")
    return F.when(filled, 1).otherwise(0)


def not_null(column: Column) -> Column:
    """1 unless NULL; '' counts as there."""
    return F.when(column.isNull(), 0).otherwise(1)


def clean_line(line: Column) -> Column:
    """Strip white space at both ends, then TAB becomes a line break."""
    return F.replace(strip(line), F.lit("\t"), F.lit("\n"))
