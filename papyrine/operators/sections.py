"""Sections and chapters of documents from stand-off annotations.

All annotations of a work sit in the work's own row, as JSON text next to the
full text. So spans, section texts, counts and chapters can be made inside the
row with array functions: one pass, nothing is shuffled and the text is not
copied per span. The same steps over stored section rows are here too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.functions.headers import classify_header
from papyrine.functions.text import blocks, cut, strip
from papyrine.operators.barrier import computed_once

ANNOTATIONS = "array<struct<attributes:struct<n:string>,start:string,end:string>>"
LAST = 2**31 - 1


def _spans_of(json: Column, kind: str) -> Column:
    """Annotations of one type, numbered by (start, end); NULL, [] and broken JSON give none."""
    parsed = F.coalesce(F.from_json(json, ANNOTATIONS), F.array().cast(ANNOTATIONS))
    spans = F.transform(
        parsed,
        lambda a: F.struct(
            F.coalesce(a["start"].cast("int"), F.lit(LAST)).alias("first"),
            F.coalesce(a["end"].cast("int"), F.lit(LAST)).alias("last"),
            F.lit(kind).alias("section_type"),
            (a["attributes"]["n"] if kind == "header" else F.lit(None).cast("string")).alias("n"),
            a["start"].cast("int").alias("section_start"),
            a["end"].cast("int").alias("section_end"),
        ),
    )
    return F.transform(
        F.sort_array(spans),
        lambda s, i: F.struct(
            s["first"].alias("first"),
            s["last"].alias("last"),
            s["section_type"].alias("section_type"),
            s["n"].alias("n"),
            s["section_start"].alias("section_start"),
            s["section_end"].alias("section_end"),
            (i + 1).alias("section_type_index"),
        ),
    )


def annotation_rejects(df: DataFrame, id_col: str, header_col: str, paragraph_col: str) -> DataFrame:
    """Works whose annotations cannot be read, with their type and the annotations as they are: ``work_id,
    section_type, annotations``. Such works have no spans of that type; NULL and blank annotations are none."""
    both = F.array(
        *[
            F.struct(F.lit(kind).alias("section_type"), F.col(column).alias("annotations"))
            for kind, column in (("header", header_col), ("paragraph", paragraph_col))
        ]
    )
    given = df.select(F.col(id_col).alias("work_id"), F.inline(both)).filter(F.trim("annotations") != "")
    return given.filter(F.from_json("annotations", ANNOTATIONS).isNull())


def _fields(s: Column, *names: str) -> list[Column]:
    return [s[n].alias(n) for n in names]


SPAN = ("section_type_index", "n", "section_start", "section_end", "section_type")


def spans_in_row(header_json: Column, paragraph_json: Column) -> Column:
    """Both types in one array ordered by (start, end), headers first on a tie."""
    both = F.sort_array(F.concat(_spans_of(header_json, "header"), _spans_of(paragraph_json, "paragraph")))
    return F.transform(both, lambda s, i: F.struct((i + 1).alias("section_index"), *_fields(s, *SPAN)))


def texts_in_row(spans: Column, pieces: Column) -> Column:
    """The spans with their stripped text and its length; ``pieces`` are the blocks of the text."""
    raw = F.transform(
        spans,
        lambda s: F.struct(
            *_fields(s, "section_index", *SPAN), cut(pieces, s["section_start"], s["section_end"]).alias("section_text")
        ),
    )
    stripped = F.transform(
        raw,
        lambda s: F.struct(*_fields(s, "section_index", *SPAN), strip(s["section_text"]).alias("section_text")),
    )
    return F.transform(
        stripped,
        lambda s: F.struct(
            *_fields(s, "section_index", *SPAN, "section_text"),
            F.length(s["section_text"]).alias("section_text_length"),
        ),
    )


def _works_in_pieces(df: DataFrame, id_col: str, text_col: str, header_col: str, paragraph_col: str) -> DataFrame:
    works = df.select(F.col(id_col).alias("work_id"), text_col, header_col, paragraph_col)
    spans = spans_in_row(F.col(header_col), F.col(paragraph_col))
    return computed_once(works, spans=spans, pieces=blocks(F.col(text_col)))


def _exploded_texts(works: DataFrame) -> DataFrame:
    cut_up = computed_once(works, sections=texts_in_row(F.col("spans"), F.col("pieces")))
    return cut_up.select("work_id", F.inline("sections"))


def annotation_spans(df: DataFrame, id_col: str, header_col: str, paragraph_col: str) -> DataFrame:
    """One row per annotation. Works are unique in ``df``; works without annotations vanish."""
    works = df.select(F.col(id_col).alias("work_id"), header_col, paragraph_col)
    spans = spans_in_row(F.col(header_col), F.col(paragraph_col))
    return computed_once(works, spans=spans).select("work_id", F.inline("spans"))


def sections_with_text(df: DataFrame, id_col: str, text_col: str, header_col: str, paragraph_col: str) -> DataFrame:
    """One row per annotation with its text, straight from the works."""
    works = _works_in_pieces(df, id_col, text_col, header_col, paragraph_col)
    return _exploded_texts(works)


def section_texts(spans: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The same from stored spans: a work's spans meet its text once, not once per span."""
    columns = ["section_index", *SPAN]
    packed = spans.groupBy("work_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("spans"))
    joined = packed.join(docs.select(F.col(id_col).alias("work_id"), text_col), "work_id", "left")
    return _exploded_texts(computed_once(joined, pieces=blocks(F.col(text_col))))


def section_stats(works: DataFrame, sections: DataFrame, id_col: str) -> DataFrame:
    """Works with numbers of sections, headers and paragraphs (0 if none) and 0/1 flags."""

    def highest(column: str, kind: str | None = None) -> Column:
        return F.max(F.col(column) if kind is None else F.when(F.col("section_type") == kind, F.col(column)))

    numbers = sections.groupBy(F.col("work_id").alias("_work")).agg(
        highest("section_index").alias("sections"),
        highest("section_type_index", "header").alias("headers"),
        highest("section_type_index", "paragraph").alias("paragraphs"),
    )
    joined = works.join(numbers, works[id_col] == numbers["_work"], "left").drop("_work")
    return _with_flags(joined, {k: F.coalesce(k, F.lit(0)) for k in KINDS}).drop(*KINDS)


def section_stats_in_row(df: DataFrame, header_col: str, paragraph_col: str) -> DataFrame:
    """The same numbers from the annotations in the work's own row: no text is moved and nothing is joined."""
    counted = computed_once(df, _spans=spans_in_row(F.col(header_col), F.col(paragraph_col)))
    return _with_flags(counted, _numbers(F.col("_spans"))).drop("_spans")


def _numbers(spans: Column) -> dict[str, Column]:
    def of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["section_type"] == kind))

    return {"sections": F.size(spans), "headers": of("header"), "paragraphs": of("paragraph")}


def _with_flags(df: DataFrame, numbers: dict[str, Column]) -> DataFrame:
    counted = df.withColumns({f"number_of_{k}": n for k, n in numbers.items()})
    return counted.withColumns({f"has_{k}": F.when(F.col(f"number_of_{k}") == 0, 0).otherwise(1) for k in numbers})


KINDS = ("sections", "headers", "paragraphs")
WORK_STATS = [f"{w}_{k}" for w in ("has", "number_of") for k in ("sections", "headers", "paragraphs")]


def sections_with_headers(sections: DataFrame, stats: DataFrame, id_col: str) -> DataFrame:
    """Sections of works that have headers, with the work's numbers."""
    of_work = stats.select(F.col(id_col).alias("_work"), *[F.col(c).alias(f"work_{c}") for c in WORK_STATS])
    joined = sections.join(of_work, sections["work_id"] == of_work["_work"], "left").drop("_work")
    return joined.filter(F.coalesce("work_has_headers", F.lit(0)) != 0)


def sections_with_headers_in_row(
    df: DataFrame, id_col: str, text_col: str, header_col: str, paragraph_col: str
) -> DataFrame:
    """The same straight from the works: those without headers go before any text is cut."""
    works = _works_in_pieces(df, id_col, text_col, header_col, paragraph_col)
    counted = _with_flags(works, _numbers(F.col("spans"))).filter("number_of_headers > 0")
    cut_up = computed_once(counted, sections=texts_in_row(F.col("spans"), F.col("pieces")))
    return cut_up.select("work_id", F.inline("sections"), *[F.col(c).alias(f"work_{c}") for c in WORK_STATS]).select(
        "work_id", "section_index", *SPAN, "section_text", "section_text_length", *[f"work_{c}" for c in WORK_STATS]
    )


def _text_separator(literal_compat: bool) -> str:
    return r"\n\n" if literal_compat else "\n\n"


def _line_breaks(text: Column, literal_compat: bool) -> Column:
    """In compatible mode the two characters backslash and n become a line break, also
    where they belong to the text itself."""
    return F.replace(text, F.lit(r"\n"), F.lit("\n")) if literal_compat else text


CHAPTER = [
    "work_id", "header_index", "number_of_paragraphs_in_chapter", "min_section_start", "max_section_end",
    "header_text", "header_text_lower", "header_text_length", "chapter_text", "chapter_text_length",
    "section_starts", "section_ends", "section_indices", "section_type_indices", "chapter_is_research_methodology",
]


def _classified(chapters: DataFrame) -> DataFrame:
    code = classify_header(F.col("header_text"), F.col("header_text_length"), F.col("chapter_text_length"))
    return (
        chapters.withColumn("header_text_lower", F.lower("header_text"))
        .withColumn("chapter_is_research_methodology", code)
        .select(*CHAPTER)
    )


def build_chapters(sections: DataFrame, literal_compat: bool = False) -> DataFrame:
    """Group stored sections under the header they follow; header 0 is the text before the first."""
    so_far = Window.partitionBy("work_id").orderBy("section_index").rowsBetween(Window.unboundedPreceding, 0)
    is_header, is_paragraph = F.col("section_type") == "header", F.col("section_type") == "paragraph"
    placed = sections.withColumn(
        "header_index",
        F.coalesce(F.last(F.when(is_header, F.col("section_type_index")), ignorenulls=True).over(so_far), F.lit(0)),
    )
    parts = ("section_index", "section_type_index", "section_start", "section_end")
    paragraph_text = F.when(is_paragraph, F.col("section_text"))
    paragraph_length = F.when(is_paragraph, F.col("section_text_length"))
    separator = _text_separator(literal_compat).replace("\\", "\\\\").replace("\n", "\\n")
    grouped = placed.groupBy("work_id", "header_index").agg(
        F.sort_array(F.collect_list(F.struct(*parts))).alias("parts"),
        F.count(paragraph_text).alias("number_of_paragraphs_in_chapter"),
        F.min("section_start").alias("min_section_start"),
        F.max("section_end").alias("max_section_end"),
        F.expr(
            "listagg(case when section_type = 'header' then section_text end, '') within group (order by section_index)"
        ).alias("header_text"),
        F.sum(F.when(is_header, F.col("section_text_length"))).alias("header_text_length"),
        F.expr(
            f"listagg(case when section_type = 'paragraph' then section_text end, '{separator}') "
            "within group (order by section_index)"
        ).alias("chapter_text"),
        (F.sum(paragraph_length) + F.count(paragraph_text) * 2 - 2).alias("chapter_text_length"),
    )
    return _classified(
        grouped.withColumn("chapter_text", _line_breaks(F.col("chapter_text"), literal_compat)).select(
            "*",
            F.col("parts.section_index").alias("section_indices"),
            F.col("parts.section_type_index").alias("section_type_indices"),
            F.col("parts.section_start").alias("section_starts"),
            F.col("parts.section_end").alias("section_ends"),
        )
    )


def chapters_in_row(
    df: DataFrame, id_col: str, text_col: str, header_col: str, paragraph_col: str, literal_compat: bool = False
) -> DataFrame:
    """Chapters of works that have headers, straight from the works and without a shuffle."""
    works = _works_in_pieces(df, id_col, text_col, header_col, paragraph_col)
    works = works.filter(F.exists("spans", lambda s: s["section_type"] == "header"))
    works = computed_once(works, sections=texts_in_row(F.col("spans"), F.col("pieces"))).select("work_id", "sections")
    # Places of the headers in the array, closed at both ends: each pair of neighbours is a chapter.
    places = F.transform(F.filter("sections", lambda s: s["section_type"] == "header"), lambda s: s["section_index"])
    works = works.withColumn("starts", places)
    bounds = F.concat(F.array(F.lit(1)), F.col("starts"), F.array(F.size("sections") + 1))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("starts")),
        lambda k: F.struct(
            k.alias("header_index"),
            F.slice("sections", F.get("bounds", k), F.get("bounds", k + 1) - F.get("bounds", k)).alias("parts"),
        ),
    )
    chapters = (
        works.withColumn("bounds", bounds)
        .select("work_id", F.inline(runs))
        .filter(F.size("parts") > 0)
        .withColumn("headers", F.filter("parts", lambda s: s["section_type"] == "header"))
        .withColumn("paragraphs", F.filter("parts", lambda s: s["section_type"] == "paragraph"))
    )

    def total(column: str) -> Column:
        lengths = F.aggregate(F.col(column), F.lit(0).cast("bigint"), lambda t, s: t + s["section_text_length"])
        return F.when(F.size(column) > 0, lengths)

    def joined(column: str, separator: str) -> Column:
        return F.when(F.size(column) > 0, F.array_join(F.col(f"{column}.section_text"), separator))

    return _classified(
        chapters.select(
            "work_id",
            "header_index",
            F.size("paragraphs").cast("bigint").alias("number_of_paragraphs_in_chapter"),
            F.array_min("parts.section_start").alias("min_section_start"),
            F.array_max("parts.section_end").alias("max_section_end"),
            joined("headers", "").alias("header_text"),
            total("headers").alias("header_text_length"),
            _line_breaks(joined("paragraphs", _text_separator(literal_compat)), literal_compat).alias("chapter_text"),
            (total("paragraphs") + F.size("paragraphs") * 2 - 2).alias("chapter_text_length"),
            F.col("parts.section_start").alias("section_starts"),
            F.col("parts.section_end").alias("section_ends"),
            F.col("parts.section_index").alias("section_indices"),
            F.col("parts.section_type_index").alias("section_type_indices"),
        )
    )


def methodology_chapters(chapters: DataFrame) -> DataFrame:
    """Chapters with a positive code, and how many of them their work has."""
    of_work = Window.partitionBy("work_id")  # a work's own chapters: a few rows
    return chapters.filter(F.col("chapter_is_research_methodology") > 0).withColumn(
        "number_of_methodology_chapters_per_work", F.count(F.lit(1)).over(of_work)
    )


def single_methodology_chapters(methodology: DataFrame) -> DataFrame:
    return methodology.filter(F.col("number_of_methodology_chapters_per_work") == 1)
