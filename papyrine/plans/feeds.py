"""Raw feeds made from the documents: works, papers, abstracts, preprints, JSON lines of linked works."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.operators.reduction import parse_lines, reduce_records, split_records
from papyrine.plans.analogues import view
from papyrine.plans.registry import table
from papyrine.plans.sections import annotated_documents

# Which lines are damaged, and how.
KIND = """case when doc_id % 97 = 5 then 'broken' when doc_id % 89 = 7 then 'no_id' when doc_id % 83 = 9 then 'null_id'
  when doc_id % 79 = 11 then 'extra' when doc_id % 73 = 3 then 'no_topic' else 'plain' end"""

RECORD = """named_struct(
  'id', concat('https://openalex.org/W', doc_id),
  'doi', case when doc_id % 7 <> 0 then concat('https://doi.org/10.1234/d', doc_id) end,
  'display_name', concat('Work ', doc_id), 'title', split_part(text, char(10), 1), 'language', lang,
  'publication_year', 2000 + doc_id % 25,
  'ids', named_struct('pmid', case when doc_id % 3 = 0 then concat('https://pubmed.ncbi.nlm.nih.gov/', doc_id) end,
    'mag', doc_id),
  'type', 'article',
  'primary_topic', case when kind <> 'no_topic' then named_struct(
    'id', concat('https://openalex.org/T', 10000 + doc_id % 23), 'display_name', concat('Topic ', doc_id % 23),
    'score', (doc_id % 100) / 100.0D,
    'subfield', named_struct('id', concat('https://openalex.org/subfields/', 1700 + (doc_id % 23) % 5),
      'display_name', concat('Subfield ', (doc_id % 23) % 5)),
    'field', named_struct('id', concat('https://openalex.org/fields/', case when doc_id % 13 = 0 then '22' else '17' end),
      'display_name', case when doc_id % 13 = 0 then 'Engineering' else 'Computer Science' end),
    'domain', named_struct('id', 'https://openalex.org/domains/3', 'display_name', 'Physical Sciences')) end)"""


def raw_lines(spark, sf_dir) -> DataFrame:
    """``doc_id``, ``value``: one JSON line per document, some of them damaged."""
    documents = table(spark, sf_dir, "documents").withColumn("kind", F.expr(KIND))
    line = F.to_json(F.expr(RECORD))
    rest = F.substr(line, F.lit(2))
    without_id = F.concat(F.lit("{"), F.substr(F.regexp_replace(line, r'^\{"id":"[^"]*"', ""), F.lit(2)))
    value = (
        F.when(F.col("kind") == "broken", F.concat(F.lit('broken {"id": '), F.col("doc_id").cast("string")))
        .when(F.col("kind") == "no_id", without_id)
        .when(F.col("kind") == "null_id", F.concat(F.lit('{"id":null,'), F.substr(without_id, F.lit(2))))
        .when(F.col("kind") == "extra", F.concat(F.lit('{"surprise":1,"another":{},'), rest))
        .when(F.col("kind") == "no_topic", F.concat(F.lit('{"primary_topic":null,'), rest))
        .otherwise(line)
    )
    return documents.select("doc_id", value.alias("value"))


def _level_sql(name: str, identifier: str, display: str) -> str:
    prefix = f"primary_topic_{name}" if name else "primary_topic"
    return f"""case when kind <> 'no_topic' then {identifier} end as {prefix}_long_id,
    case when kind <> 'no_topic' then split_part({identifier}, '/', -1) end as {prefix}_short_id,
    case when kind <> 'no_topic' then {display} end as {prefix}_display_name"""


REDUCED_SQL = f"""damaged as (select *, {KIND} as kind from documents),
reduced as (select case when kind <> 'null_id' then concat('https://openalex.org/W', doc_id) end as id_openalex_long,
    case when kind <> 'null_id' then cast(doc_id as varchar) end as id_openalex_short,
    case when doc_id % 7 <> 0 then concat('https://doi.org/10.1234/d', doc_id) end as id_doi_long,
    case when doc_id % 7 <> 0 then concat('10.1234/d', doc_id) end as id_doi_short,
    concat('Work ', doc_id) as display_name, split_part(text, chr(10), 1) as title, lang as language,
    2000 + doc_id % 25 as publication_year,
    case when doc_id % 3 = 0 then concat('https://pubmed.ncbi.nlm.nih.gov/', doc_id) end as id_pmid_long,
    case when doc_id % 3 = 0 then cast(doc_id as varchar) end as id_pmid_short,
    cast(doc_id as varchar) as id_mag, 'article' as item_type,
    {_level_sql("", "concat('https://openalex.org/T', 10000 + doc_id % 23)", "concat('Topic ', doc_id % 23)")},
    case when kind <> 'no_topic' then (doc_id % 100)::double / 100::double end as primary_topic_score,
    {_level_sql("subfield", "concat('https://openalex.org/subfields/', 1700 + (doc_id % 23) % 5)",
                "concat('Subfield ', (doc_id % 23) % 5)")},
    {_level_sql("field", "concat('https://openalex.org/fields/', case when doc_id % 13 = 0 then '22' else '17' end)",
                "case when doc_id % 13 = 0 then 'Engineering' else 'Computer Science' end")},
    {_level_sql("domain", "'https://openalex.org/domains/3'", "'Physical Sciences'")}
  from damaged where kind not in ('broken', 'no_id'))"""


def taxonomy(spark, sf_dir) -> DataFrame:
    """Topics with a nested subfield: one per class number that the feeds use."""
    number = F.col("k")
    numbers = table(spark, sf_dir, "documents").select((F.col("doc_id") % 23).alias("k")).distinct()
    return numbers.select(
        F.concat(F.lit("https://openalex.org/T"), (number + 10000).cast("string")).alias("id"),
        F.concat(F.lit("Topic "), number.cast("string")).alias("display_name"),
        F.struct(
            F.concat(F.lit("https://openalex.org/subfields/"), (number % 5 + 1700).cast("string")).alias("id"),
            F.concat(F.lit("Subfield "), (number % 5).cast("string")).alias("display_name"),
        ).alias("subfield"),
    )


TAXONOMY_SQL = """taxonomy as (select concat('https://openalex.org/T', 10000 + k) as id, concat('Topic ', k) as display_name,
    1700 + k % 5 as subfield_id, concat('Subfield ', k % 5) as subfield_name
  from (select distinct doc_id % 23 as k from documents))"""


def works_feed(spark, sf_dir) -> DataFrame:
    """Works with nested open-access data and a body of text and annotations."""
    works = view(spark, sf_dir, "a_works")
    notes = annotated_documents(spark, sf_dir).drop("text")
    return works.join(notes, works["id_semanticscholar"] == notes["doc_id"]).select(
        F.col("id_semanticscholar").alias("corpusid"),
        "title",
        F.struct(
            F.struct(F.col("id_mag").alias("mag"), F.upper("id_doi").alias("doi"), F.col("id_arxiv").alias("arxiv")).alias(
                "externalids"
            ),
            F.col("original_license").alias("license"),
            F.concat(F.lit("https://example.org/"), F.col("id_semanticscholar").cast("string")).alias("url"),
            F.lit("GREEN").alias("status"),
        ).alias("openaccessinfo"),
        F.struct(
            F.col("content_text").alias("text"),
            F.struct(
                F.col("annotations_paragraph").alias("paragraph"),
                F.col("annotations_section_header").alias("section_header"),
            ).alias("annotations"),
        ).alias("body"),
    )


def raw_feeds(spark, sf_dir) -> dict[str, DataFrame]:
    documents, works = table(spark, sf_dir, "documents"), view(spark, sf_dir, "a_works")
    good, _ = split_records(parse_lines(raw_lines(spark, sf_dir)))
    return {
        "semanticscholar_s2orc_v2": works_feed(spark, sf_dir),
        "semanticscholar_papers": documents.filter(F.col("doc_id") % 10 != 3).select(
            F.col("doc_id").alias("corpusid"),
            (F.col("doc_id") % 25 + 2000).cast("int").alias("year"),
            F.concat((F.col("doc_id") % 25 + 2000).cast("string"), F.lit("-06-01")).alias("publicationdate"),
        ),
        "semanticscholar_abstracts": works.select(
            F.col("id_semanticscholar").alias("corpusid"), F.col("content_abstract").alias("abstract")
        ).dropna(),
        "arxiv_metadata": view(spark, sf_dir, "a_arxiv").select(
            F.col("id_arxiv").alias("id"),
            F.col("id_doi").alias("doi"),
            F.lit(None).cast("string").alias("title"),
            F.lit(None).cast("string").alias("abstract"),
            "license",
        ),
        "openalex_works_reduced": reduce_records(good),
        "openalex_merged_ids": view(spark, sf_dir, "a_merge"),
        "openalex_topics": taxonomy(spark, sf_dir),
    }
