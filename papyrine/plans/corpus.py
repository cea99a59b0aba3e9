"""The corpus tables built from raw feeds, from linkage to splits and chapters."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators import labels
from papyrine.plans import models
from papyrine.plans.analogues import with_views
from papyrine.plans.feeds import REDUCED_SQL, TAXONOMY_SQL, raw_feeds
from papyrine.plans.links import REUSABLE_SQL, _sql_codes, _sql_works_licence
from papyrine.plans.registry import ORACLES, query
from papyrine.plans.sections import CHAPTERS_SQL, _lists_as_text
from papyrine.session import store

SETTINGS = models.Settings(subfield_cap=80, topic_cap=18, topic_min=5)
#: Caps that cut most classes of the small tables too.
CAPPED = models.Settings(subfield_cap=30, topic_cap=9, topic_min=3)


def _capped_sql(settings):
    return f"""sampled as (select *, count(*) over (partition by topic_name) as new_count from ranked
  where sub_rank < {settings.subfield_cap} and topic_rank < {settings.topic_cap}),
kept as (select * from sampled where new_count > {settings.topic_min}),"""


_RANKED_SQL = f"""{with_views("a_works", "a_arxiv")}, {REDUCED_SQL}, {TAXONOMY_SQL},
w as (select a.id_semanticscholar, a.id_mag, a.id_doi, a.id_arxiv,
    case when a.id_semanticscholar % 10 <> 3 then a.publication_year end as publication_year,
    case when a.id_semanticscholar % 10 <> 3 then concat(a.publication_year, '-06-01') end as publication_date,
    coalesce({_sql_works_licence("a.original_license")}, p.license, 'unknown-reusability') as license,
    a.title, a.content_abstract, a.content_text
  from a_works a left join (select id_arxiv, {_sql_codes("license")} as license from a_arxiv) p on a.id_arxiv = p.id_arxiv),
o as (select id_openalex_short as id_openalex, lower(id_doi_short) as id_doi, language,
    coalesce(primary_topic_short_id, primary_topic_long_id) as topic_id, primary_topic_display_name as topic_name,
    coalesce(primary_topic_subfield_short_id, primary_topic_subfield_long_id) as subfield_id,
    primary_topic_subfield_display_name as subfield_name
  from reduced where coalesce(primary_topic_field_short_id, primary_topic_field_long_id) = '17'
    and coalesce(primary_topic_subfield_short_id, primary_topic_subfield_long_id) is not null
    and coalesce(primary_topic_short_id, primary_topic_long_id) is not null),
by_doi as (select w.*, o.id_openalex as o_id, o.id_doi as o_doi from w left join o on w.id_doi = o.id_doi),
by_both as (select d.* exclude (o_id, o_doi), case when d.o_doi is not null then 'doi' when m.id_doi is not null then 'mag' end
    as joined_on, coalesce(case when d.o_doi is not null then d.o_id end, m.id_openalex) as o_id,
    coalesce(d.o_doi, m.id_doi) as o_doi
  from by_doi d left join o m on d.o_doi is null and d.id_mag = m.id_openalex),
linked as (select * exclude (r) from (select b.*, o.language, o.topic_id, o.topic_name, o.subfield_id, o.subfield_name,
    row_number() over (partition by b.id_semanticscholar order by b.id_mag desc nulls last, b.id_doi desc nulls last,
      b.id_arxiv desc nulls last, b.publication_date desc nulls last, cast(b.o_id as bigint)) as r
  from by_both b left join o on o.id_doi = b.o_doi and o.id_openalex is not distinct from b.o_id
  where b.joined_on is not null) where r = 1),
tagged as (select *, cast(substr(topic_id, 2) as bigint) as topic_no, cast(subfield_id as bigint) as subfield_no,
    case ntile(10) over (partition by topic_id order by md5(concat('42:', id_semanticscholar)), id_semanticscholar)
      when 1 then 'test' when 2 then 'validation' else 'train' end as subset
  from linked where language = 'en' and license in {REUSABLE_SQL}),
topic_rows as (select n.*, t.display_name as topic_display_name, t.subfield_id as subfield_original_id,
    t.subfield_name as subfield_display_name
  from (select topic_no, count(*) as topic_count, row_number() over (order by count(*) desc, topic_no) - 1 as topic_index
    from tagged group by topic_no) n left join taxonomy t on concat('https://openalex.org/T', n.topic_no) = t.id),
subfield_rows as (select subfield_original_id, subfield_display_name, cast(sum(topic_count) as bigint) as subfield_count,
    row_number() over (order by sum(topic_count) desc, subfield_original_id, subfield_display_name) - 1 as subfield_index
  from topic_rows group by subfield_original_id, subfield_display_name),
full_works as (select g.*, t.topic_index, t.topic_count, s.subfield_index, s.subfield_count
  from tagged g left join topic_rows t on g.topic_no = t.topic_no
    left join subfield_rows s on g.subfield_no = s.subfield_original_id
  where g.title is not null and g.content_abstract is not null and g.content_text is not null),
ranked as (select *,
    row_number() over (partition by subfield_name order by md5(concat('42/openalex_primary_topic_subfield_display_name:',
      id_semanticscholar)), id_semanticscholar) as sub_rank,
    row_number() over (partition by topic_name order by md5(concat('42/openalex_primary_topic_display_name:',
      id_semanticscholar)), id_semanticscholar) as topic_rank from full_works),
"""

LINKED_SQL = f"""{_RANKED_SQL}{_capped_sql(SETTINGS)}
few_topics as (select topic_name, count(*) as n, row_number() over (order by count(*) desc, topic_name) - 1 as topic_index
  from kept group by topic_name),
few_subfields as (select subfield_name, count(*) as n,
    row_number() over (order by count(*) desc, subfield_name) - 1 as subfield_index from kept group by subfield_name)"""


CAPPED_SQL = LINKED_SQL.replace(_capped_sql(SETTINGS), _capped_sql(CAPPED))


def _table(spark, sf_dir, name, settings=SETTINGS):
    return models.corpus_table(raw_feeds(spark, sf_dir), name, settings)


@query(
    "corpus_linked_metadata",
    f"""{LINKED_SQL} select id_semanticscholar, id_mag, id_doi, id_arxiv, publication_year, publication_date, license,
      case when license in {REUSABLE_SQL} then 1 else 0 end as license_allows_derivative_reuse,
      concat('https://example.org/', id_semanticscholar) as source_url,
      case when coalesce(id_mag, '') = '' then 0 else 1 end as has_id_mag,
      case when coalesce(id_doi, '') = '' then 0 else 1 end as has_id_doi,
      case when coalesce(id_doi, '') = '' and coalesce(id_mag, '') = '' then 0 else 1 end as has_id_mag_or_doi,
      cast(o_id as bigint) as openalex_id_openalex, o_doi as openalex_id_doi, language as openalex_language,
      cast(substr(topic_id, 2) as bigint) as openalex_primary_topic_id, topic_name as openalex_primary_topic_display_name,
      cast(subfield_id as bigint) as openalex_primary_topic_subfield_id,
      subfield_name as openalex_primary_topic_subfield_display_name, 17 as openalex_primary_topic_field_id,
      'Computer Science' as openalex_primary_topic_field_display_name, 3 as openalex_primary_topic_domain_id,
      'Physical Sciences' as openalex_primary_topic_domain_display_name, joined_on as openalex_joined_on
    from linked""",
)
def corpus_linked_metadata(spark, sf_dir):
    return _table(spark, sf_dir, "stg_unified_works_metadata_02_joined_to_openalex")


@query(
    "corpus_topics",
    f"""{LINKED_SQL} select topic_index, topic_no as topic_original_id, topic_display_name, topic_count,
      subfield_original_id, subfield_display_name from topic_rows""",
)
def corpus_topics(spark, sf_dir):
    return _table(spark, sf_dir, "topics")


@query(
    "corpus_subfields",
    f"{LINKED_SQL} select subfield_index, subfield_original_id, subfield_display_name, subfield_count from subfield_rows",
)
def corpus_subfields(spark, sf_dir):
    return _table(spark, sf_dir, "subfields")


@query(
    "corpus_unified_works",
    f"""{LINKED_SQL} select id_semanticscholar as id, topic_index, topic_name as topic_display_name, subfield_index,
      subfield_name as subfield_display_name, title, content_abstract as abstract, content_text as fulltext, subset
    from full_works""",
)
def corpus_unified_works(spark, sf_dir):
    return _table(spark, sf_dir, "unified_works")


@query(
    "corpus_unified_works_semibalanced",
    f"""{LINKED_SQL} select k.id_semanticscholar as id, t.topic_index, k.topic_name as topic_display_name,
      s.subfield_index, k.subfield_name as subfield_display_name, k.title, k.content_abstract as abstract,
      k.content_text as fulltext, case ntile(10) over (partition by k.topic_name
        order by md5(concat('43:', k.id_semanticscholar)), k.id_semanticscholar)
        when 1 then 'test' when 2 then 'validation' else 'train' end as subset
    from kept k left join few_topics t on k.topic_name = t.topic_name
      left join few_subfields s on k.subfield_name = s.subfield_name""",
)
def corpus_unified_works_semibalanced(spark, sf_dir):
    return _table(spark, sf_dir, "unified_works_semibalanced")


@query(
    "corpus_semibalanced_labels",
    f"""{LINKED_SQL} select 'topic' as level, topic_index as label_index, topic_name as label, n as rows_in_class
    from few_topics union all select 'subfield', subfield_index, subfield_name, n from few_subfields""",
)
def corpus_semibalanced_labels(spark, sf_dir):
    wanted = {"topics_semibalanced": "topic", "subfields_semibalanced": "subfield"}
    report = None
    for name, frame in models.corpus_tables(raw_feeds(spark, sf_dir), SETTINGS):
        if name in wanted:
            short = wanted.pop(name)
            part = frame.select(
                F.lit(short).alias("level"),
                F.col(f"{short}_index").alias("label_index"),
                F.col(f"{short}_display_name").alias("label"),
                F.col(f"{short}_count").alias("rows_in_class"),
            )
            report = part if report is None else report.unionByName(part)
        if not wanted:
            return report


@query(
    "corpus_split_shares",
    f"""{LINKED_SQL} select subset, count(*) as c, round(count(*) * 100.0 / (select count(*) from full_works), 6) as p
    from full_works group by subset""",
)
def corpus_split_shares(spark, sf_dir):
    """The stored split tables against the whole."""
    whole, parts = None, []
    for name, frame in models.corpus_tables(raw_feeds(spark, sf_dir), SETTINGS):
        if name == "unified_works":
            whole = frame
        elif name.startswith("unified_works_"):
            parts.append(store(frame.select("id", "subset"), name))
        if len(parts) == 3:
            return labels.split_shares(parts, whole).withColumn("p", F.round("p", 6))


@query(
    "corpus_chapters",
    CHAPTERS_SQL.replace("with lines as", f"{LINKED_SQL}, lines as", 1).replace(
        "from documents where doc_id % 11 <> 0)",
        "from documents where doc_id % 11 <> 0 and doc_id in (select id_semanticscholar from full_works))",
        1,
    ),
)
def corpus_chapters(spark, sf_dir):
    return _lists_as_text(_table(spark, sf_dir, "stg_filtered_work_chapters"))


@query(
    "corpus_labelled",
    f"""{LINKED_SQL} select g.id_semanticscholar, g.subset, t.topic_index, t.topic_count, s.subfield_index, s.subfield_count
    from tagged g left join topic_rows t on g.topic_no = t.topic_no
      left join subfield_rows s on g.subfield_no = s.subfield_original_id""",
)
def corpus_labelled(spark, sf_dir):
    labelled = _table(spark, sf_dir, "stg_unified_works_metadata_04_with_topics_and_subfields")
    names = [(n, f"{full}_{n.split('_')[1]}") for full, short in ((models.TOPIC, "topic"), (models.SUBFIELD, "subfield"))
             for n in (f"{short}_index", f"{short}_count")]
    return labelled.select("id_semanticscholar", "subset", *[F.col(full).alias(n) for n, full in names])


@query(
    "corpus_capped",
    f"{CAPPED_SQL} select id_semanticscholar, topic_name, subfield_name, new_count from kept",
)
def corpus_capped(spark, sf_dir):
    """The classes cut to caps that bite."""
    return _table(spark, sf_dir, "stg_unified_works_filtered_semibalanced_reduced", CAPPED).select(
        "id_semanticscholar",
        F.col(f"{models.TOPIC}_display_name").alias("topic_name"),
        F.col(f"{models.SUBFIELD}_display_name").alias("subfield_name"),
        F.col("new_topic_count").alias("new_count"),
    )


@query(
    "corpus_semibalanced_splits",
    f"""{CAPPED_SQL} select concat('unified_works_semibalanced_', subset) as table_name, id, topic_index from (
      select k.id_semanticscholar as id, t.topic_index, case ntile(10) over (partition by k.topic_name
        order by md5(concat('43:', k.id_semanticscholar)), k.id_semanticscholar)
        when 1 then 'test' when 2 then 'validation' else 'train' end as subset
      from kept k left join few_topics t on k.topic_name = t.topic_name)""",
)
def corpus_semibalanced_splits(spark, sf_dir):
    """The rows of the capped set's three split tables."""
    report, prefix = None, "unified_works_semibalanced_"
    for name, frame in models.corpus_tables(raw_feeds(spark, sf_dir), CAPPED):
        if name.startswith(prefix):
            part = store(frame.select(F.lit(name).alias("table_name"), "id", "topic_index"), name)
            report = part if report is None else report.unionByName(part)
        if name == prefix + CAPPED.subsets[-1]:
            return report


@query("corpus_merged_ids", ORACLES["merge_chain"])
def corpus_merged_ids(spark, sf_dir):
    return _table(spark, sf_dir, "base_openalex_merged_ids")
