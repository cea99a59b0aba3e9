"""Sections, chapters and header codes over the documents, each line an annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.functions import headers
from papyrine.functions.headers import classify_header
from papyrine.operators import sections as ops
from papyrine.plans.analogues import view, with_views
from papyrine.plans.registry import query, table


def annotated_documents(spark, sf_dir) -> DataFrame:
    """Documents with header and paragraph annotations as JSON text: line 1, 4, 7, ...
    (from 0) is a header, the rest are paragraphs; every eleventh work has none."""
    lines = F.split("text", "\n")
    starts = F.aggregate(
        lines,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda seen, line: F.struct(
            (seen["at"] + F.length(line) + 1).alias("at"),
            F.concat(seen["starts"], F.array(seen["at"])).alias("starts"),
        ),
    )["starts"]
    located = table(spark, sf_dir, "documents").select("doc_id", "text", lines.alias("lines"), starts.alias("starts"))
    spans = F.transform(
        F.arrays_zip("lines", "starts"),
        lambda z, k: F.struct(
            F.struct(k.cast("string").alias("n")).alias("attributes"),
            z["starts"].cast("string").alias("start"),
            (z["starts"] + F.length(z["lines"])).alias("end"),
            (k % 3 == 1).alias("is_header"),
        ),
    )

    def as_json(header: bool):
        chosen = F.filter("spans", lambda s: s["is_header"] == F.lit(header))
        kept = F.transform(chosen, lambda s: F.struct(s["attributes"].alias("attributes"), s["start"].alias("start"), s["end"].alias("end")))
        return F.when(F.col("doc_id") % 11 != 0, F.to_json(kept))

    return located.withColumn("spans", spans).select(
        "doc_id", "text", as_json(True).alias("annotations_section_header"), as_json(False).alias("annotations_paragraph")
    )


SPANS_SQL = r"""lines as (select doc_id, text, unnest(range(len(string_split(text, chr(10))))) as k,
    unnest(string_split(text, chr(10))) as line from documents where doc_id % 11 <> 0),
located as (select *, coalesce(cast(sum(length(line) + 1) over (partition by doc_id order by k
    rows between unbounded preceding and 1 preceding) as bigint), 0) as section_start from lines),
spans as (select doc_id as work_id, k + 1 as section_index, text,
    row_number() over (partition by doc_id, k % 3 = 1 order by section_start) as section_type_index,
    case when k % 3 = 1 then cast(k as varchar) end as n, section_start,
    section_start + length(line) as section_end,
    case when k % 3 = 1 then 'header' else 'paragraph' end as section_type from located),
cut as (select * exclude (text),
    trim(substr(text, section_start + 1, section_end - section_start), concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) as section_text
  from spans),
sections as (select *, length(section_text) as section_text_length from cut)"""

IDS = ("doc_id", "annotations_section_header", "annotations_paragraph")


@query(
    "annotation_spans",
    f"with {SPANS_SQL} select work_id, section_index, section_type_index, n, section_start, section_end, section_type from spans",
)
def annotation_spans(spark, sf_dir):
    return ops.annotation_spans(annotated_documents(spark, sf_dir), *IDS)


def _sections(spark, sf_dir):
    return ops.sections_with_text(
        annotated_documents(spark, sf_dir), "doc_id", "text", "annotations_section_header", "annotations_paragraph"
    )


@query("section_texts", f"with {SPANS_SQL} select * from sections")
def section_texts(spark, sf_dir):
    return _sections(spark, sf_dir)


@query("section_texts_joined", f"with {SPANS_SQL} select * from sections")
def section_texts_joined(spark, sf_dir):
    documents = annotated_documents(spark, sf_dir)
    spans = ops.annotation_spans(documents, *IDS)
    return ops.section_texts(spans, table(spark, sf_dir, "documents"), "doc_id", "text")


STATS_SQL = f"""{SPANS_SQL},
best as (select work_id, max(section_index) as s, max(case when section_type = 'header' then section_type_index end) as h,
    max(case when section_type = 'paragraph' then section_type_index end) as p from sections group by work_id),
stats as (select d.doc_id, coalesce(s, 0) as number_of_sections, coalesce(h, 0) as number_of_headers,
    coalesce(p, 0) as number_of_paragraphs, case when coalesce(s, 0) = 0 then 0 else 1 end as has_sections,
    case when coalesce(h, 0) = 0 then 0 else 1 end as has_headers,
    case when coalesce(p, 0) = 0 then 0 else 1 end as has_paragraphs
  from documents d left join best on d.doc_id = best.work_id)"""


@query("section_stats", f"with {STATS_SQL} select * from stats")
def section_stats(spark, sf_dir):
    works = annotated_documents(spark, sf_dir)
    return ops.section_stats_in_row(works, *IDS[1:]).select("doc_id", *ops.WORK_STATS)


@query(
    "annotation_rejects",
    """select kind as section_type, count(*) as works, count(case when doc_id % 13 = 0 then 1 end) as rejected
    from documents, (values ('header'), ('paragraph')) t(kind) where doc_id % 11 <> 0 group by kind""",
)
def annotation_rejects(spark, sf_dir):
    """The annotations of every thirteenth work lack their end; counted by type against all that have some."""
    works = annotated_documents(spark, sf_dir)
    torn = works.withColumns(
        {c: F.when(F.col("doc_id") % 13 == 0, F.expr(f"left({c}, length({c}) - 1)")).otherwise(F.col(c)) for c in IDS[1:]}
    )
    rejected = ops.annotation_rejects(torn, *IDS).groupBy("section_type").agg(F.count(F.lit(1)).alias("rejected"))
    given = torn.select(
        F.explode(F.array(*[F.when(F.col(c).isNotNull(), F.lit(k)) for k, c in zip(("header", "paragraph"), IDS[1:], strict=True)]))
        .alias("section_type")
    )
    works = given.dropna().groupBy("section_type").agg(F.count(F.lit(1)).alias("works"))
    return works.join(rejected, "section_type", "left").select("section_type", "works", F.coalesce("rejected", F.lit(0)).alias("rejected"))


@query(
    "sections_with_headers",
    f"""with {STATS_SQL} select s.*, t.has_sections as work_has_sections, t.has_headers as work_has_headers,
      t.has_paragraphs as work_has_paragraphs, t.number_of_sections as work_number_of_sections,
      t.number_of_headers as work_number_of_headers, t.number_of_paragraphs as work_number_of_paragraphs
    from sections s join stats t on s.work_id = t.doc_id where t.has_headers <> 0""",
)
def sections_with_headers(spark, sf_dir):
    return ops.sections_with_headers_in_row(annotated_documents(spark, sf_dir), "doc_id", "text", *IDS[1:])


def _literals(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def code_sql(text: str, header_length: str, chapter_length: str) -> str:
    return f"""case when {chapter_length} is null or {chapter_length} < 100 then -1
      when {text} in {_literals(headers.SPOILED)} then -2 when {text} in {_literals(headers.OTHER_PURPOSE)} then -3
      when {text} like '%evaluation%' then -4 when {text} in {_literals(headers.METHODOLOGY)} then 1
      when {text} like '%research methodology%' then 2 when {text} like 'methodology:%' then 3
      when {text} like '%: methodology' then 4 when {text} like '%proposed methodology%' then 5
      when {text} like '%experimental methodology%' then 6
      when {text} like '%methodology%' and {header_length} <= 16 then 7 end"""


CHAPTERS_SQL = f"""with {SPANS_SQL},
placed as (select *, cast(count(case when section_type = 'header' then 1 end) over (partition by work_id
    order by section_index rows between unbounded preceding and current row) as bigint) as header_index
  from sections where work_id in (select work_id from sections where section_type = 'header')),
grouped as (select work_id, header_index,
    count(case when section_type = 'paragraph' then section_text end) as number_of_paragraphs_in_chapter,
    min(section_start) as min_section_start, max(section_end) as max_section_end,
    string_agg(case when section_type = 'header' then section_text end, '' order by section_index) as header_text,
    cast(sum(case when section_type = 'header' then section_text_length end) as bigint) as header_text_length,
    string_agg(case when section_type = 'paragraph' then section_text end, concat(chr(10), chr(10)) order by section_index)
      as chapter_text,
    cast(sum(case when section_type = 'paragraph' then section_text_length end)
      + count(case when section_type = 'paragraph' then section_text end) * 2 - 2 as bigint) as chapter_text_length,
    string_agg(section_start, ',' order by section_index) as section_starts,
    string_agg(section_end, ',' order by section_index) as section_ends,
    string_agg(section_index, ',' order by section_index) as section_indices,
    string_agg(section_type_index, ',' order by section_index) as section_type_indices
  from placed group by work_id, header_index)
select *, lower(header_text) as header_text_lower,
  cast({code_sql("lower(header_text)", "header_text_length", "chapter_text_length")} as bigint) as chapter_is_research_methodology
from grouped"""


def _lists_as_text(chapters: DataFrame) -> DataFrame:
    lists = ("section_starts", "section_ends", "section_indices", "section_type_indices")
    return chapters.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in lists})


@query("chapters", CHAPTERS_SQL)
def chapters(spark, sf_dir):
    return _lists_as_text(
        ops.chapters_in_row(
            annotated_documents(spark, sf_dir), "doc_id", "text", "annotations_section_header", "annotations_paragraph"
        )
    )


@query("chapters_from_sections", CHAPTERS_SQL)
def chapters_from_sections(spark, sf_dir):
    """The same chapters from section rows: window, group, ordered text aggregation."""
    sections = _sections(spark, sf_dir)
    works = table(spark, sf_dir, "documents").select("doc_id")
    stats = ops.section_stats(works, ops.annotation_spans(annotated_documents(spark, sf_dir), *IDS), "doc_id")
    return _lists_as_text(ops.build_chapters(ops.sections_with_headers(sections, stats, "doc_id")))


HEADER_CODES = f"""coded as (select *, length(header_text) as header_text_length,
    cast({code_sql("lower(header_text)", "length(header_text)", "chapter_text_length")} as bigint) as chapter_is_research_methodology
  from a_headers)"""


def _coded(spark, sf_dir):
    return (
        view(spark, sf_dir, "a_headers")
        .withColumn("header_text_length", F.length("header_text"))
        .withColumn(
            "chapter_is_research_methodology",
            classify_header(F.col("header_text"), F.col("header_text_length"), F.col("chapter_text_length")),
        )
    )


@query("header_classifier", f'{with_views("a_headers")}, {HEADER_CODES} select * from coded')
def header_classifier(spark, sf_dir):
    return _coded(spark, sf_dir)


# Two headers per work, so that works with one and with two methodology chapters occur.
PAIRED = f"""{HEADER_CODES},
paired as (select work_id // 2 as work_id, work_id % 2 as header_index, header_text, chapter_is_research_methodology
  from coded),
found as (select *, count(*) over (partition by work_id) as number_of_methodology_chapters_per_work
  from paired where chapter_is_research_methodology > 0)"""


def _found(spark, sf_dir):
    paired = _coded(spark, sf_dir).select(
        F.floor(F.col("work_id") / 2).alias("work_id"),
        (F.col("work_id") % 2).alias("header_index"),
        "header_text",
        "chapter_is_research_methodology",
    )
    return ops.methodology_chapters(paired)


@query("methodology_chapters", f'{with_views("a_headers")}, {PAIRED} select * from found')
def methodology_chapters(spark, sf_dir):
    return _found(spark, sf_dir)


@query(
    "methodology_single",
    f'{with_views("a_headers")}, {PAIRED} select * from found where number_of_methodology_chapters_per_work = 1',
)
def methodology_single(spark, sf_dir):
    return ops.single_methodology_chapters(_found(spark, sf_dir))
