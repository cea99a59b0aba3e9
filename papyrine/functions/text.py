"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\r\f\x0b"
#: Letters with their marks, digits and the underscore of any script.
TOKEN = r"[\p{L}\p{M}\p{N}_]{2,}"


def strip(text: Column) -> Column:
    """White space off both ends (plain ``trim`` takes blanks only).

    Trimming a set of characters walks the whole text, so it is done only where an
    end needs it. ``text`` should be a plain column or lambda variable: it is used
    more than once.
    """
    ends = F.substring(text, 1, 1).isin(*WHITE_SPACE) | F.substring(text, -1, 1).isin(*WHITE_SPACE)
    return F.when(ends, F.btrim(text, F.lit(WHITE_SPACE))).otherwise(text)


BLOCK = 2048


def blocks(text: Column) -> Column:
    """The text in pieces of ``BLOCK`` characters, made in one walk over it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` .. ``end`` (0-based, end excluded) of a text in ``blocks``.

    Finding a character means walking there from the beginning, so cutting many spans
    out of one long text takes quadratic time; from its block it takes linear time.
    """
    first = F.floor(start / BLOCK).cast("int")
    count = F.greatest(F.floor((end - 1) / BLOCK).cast("int") - first + 1, F.lit(0))
    return F.substr(
        F.array_join(F.slice(pieces, first + 1, count), ""),
        start - first * BLOCK + 1,
        F.greatest(end - start, F.lit(0)),
    )


def tokens(text: Column, pattern: str = TOKEN) -> Column:
    """Lower-cased words of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def without(words: Column, stop_words: list[str]) -> Column:
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def preview(text: Column, length: int = 100) -> Column:
    """First line, cut to ``length`` characters."""
    return F.substring(F.substring_index(text, "\n", 1), 1, length)


def truncated(words: Column, length: int = 512) -> Column:
    return F.slice(words, 1, length)
