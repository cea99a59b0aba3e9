"""The given tables seen as scholarly feeds: one SQL text per view, valid in Spark and DuckDB."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from papyrine.plans.registry import table

VIEWS: dict[str, str] = {}

VIEWS["a_classes"] = """
select doc_id as id, concat(lang, '-', cast(doc_id % 7 as string)) as topic, lang as subfield,
  source, n_chars, text
from {documents}
"""

VIEWS["a_works"] = """
select doc_id as id_semanticscholar,
  case when doc_id % 17 = 0 then null when doc_id % 19 = 0 then ''
       else lower(concat('10.1234/D', cast(doc_id as string))) end as id_doi,
  case when doc_id % 3 = 0 then cast(doc_id as string) end as id_mag,
  case when doc_id % 4 = 0 then concat('a', cast(doc_id as string)) end as id_arxiv,
  case doc_id % 6 when 0 then 'CCBY' when 1 then 'pd' when 2 then 'other-oa' when 3 then null
                  when 4 then 'mit' else 'CCBYNCND' end as original_license,
  split_part(text, chr(10), 1) as title, nullif(split_part(text, chr(10), 2), '') as content_abstract,
  text as content_text, 2000 + doc_id % 25 as publication_year
from {documents}
"""

VIEWS["a_linked"] = """
select cast(doc_id as string) as id_openalex,
  case when doc_id % 7 = 0 then null else concat('10.1234/d', cast(doc_id as string)) end as id_doi,
  lang as language,
  case when doc_id % 29 = 0 then null else concat('T', cast(10000 + doc_id % 23 as string)) end as primary_topic_short_id,
  concat('https://example.org/T', cast(10000 + doc_id % 23 as string)) as primary_topic_long_id,
  concat('Topic ', cast((doc_id + case when doc_id % 31 = 0 then 1 else 0 end) % 23 as string)) as primary_topic_display_name,
  cast(1700 + (doc_id % 23) % 5 as string) as primary_topic_subfield_id,
  case when doc_id % 13 = 0 then '22' else '17' end as primary_topic_field_id
from {documents} where doc_id % 5 <> 0
union all
select cast(900000 + doc_id as string), concat('10.1234/d', cast(doc_id as string)), 'en', 'T10001',
  'https://example.org/T10001', 'Topic 1', '1701', '17'
from {documents} where doc_id % 50 = 1
"""

VIEWS["a_arxiv"] = """
select concat('a', cast(doc_id as string)) as id_arxiv, concat('10.1234/d', cast(doc_id as string)) as id_doi,
  case doc_id % 5 when 0 then 'http://creativecommons.org/licenses/by/4.0/' when 1 then null
    when 2 then 'http://arxiv.org/licenses/nonexclusive-distrib/1.0/' when 3 then 'http://example.org/custom'
    else 'http://creativecommons.org/publicdomain/zero/1.0/' end as license
from {documents} where doc_id % 4 = 0
"""

VIEWS["a_merge"] = """
select concat('W', cast(p_partkey as string)) as id,
  concat('W', cast(cast(floor(p_partkey / 2) as bigint) as string)) as merge_into_id
from {part} where p_partkey > 0 and p_partkey % 2 = 0
"""

VIEWS["a_headers"] = """
select doc_id as work_id, 1 as header_index, n_chars as chapter_text_length,
  case doc_id % 12 when 0 then 'Methodology' when 1 then 'Our proposed methodology in detail' when 2 then 'A. Methodology'
    when 3 then 'Evaluation Methodology' when 4 then 'Training methodology' when 5 then 'Methodology: overview'
    when 6 then 'Our study: methodology' when 7 then 'New research methodology here' when 8 then 'Results'
    when 9 then null when 10 then 'The experimental methodology used'
    else 'A very long section on methodology choices' end as header_text
from {documents}
"""


def tables_of(text: str) -> set[str]:
    return {field for _, field, _, _ in string.Formatter().parse(text) if field}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in tables_of(text)})


def with_views(*names: str) -> str:
    """The same views as a WITH list for the SQL side, open for more entries."""
    parts = [f"{n} as ({VIEWS[n].format(**{t: t for t in tables_of(VIEWS[n])})})" for n in names]
    return "with " + ",\n".join(parts)
