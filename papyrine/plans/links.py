"""Linkage, licences, coverage and merge chains on the feed analogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.functions import ids, licences
from papyrine.operators import linkage, reports
from papyrine.operators.linkage import LinkKey
from papyrine.operators.sizing import broadcast_if_small
from papyrine.plans import feeds, models
from papyrine.plans.analogues import view, with_views
from papyrine.plans.registry import query, table

DOI_THEN_MAG = [LinkKey("id_doi", "id_doi", "doi"), LinkKey("id_mag", "id_openalex", "mag")]
LINKED = ["id_openalex", "id_doi", "language", "primary_topic_display_name"]

# All pairs, then the choice: what the reduced join must equal.
FALLBACK_SQL = """j1 as (select w.id_semanticscholar, w.id_mag, w.id_doi, w.id_arxiv,
    l.id_openalex as a_id, l.id_doi as a_doi, l.language as a_lang, l.primary_topic_display_name as a_topic
  from a_works w left join a_linked l on w.id_doi = l.id_doi),
j2 as (select j1.*, l.id_openalex as b_id, l.id_doi as b_doi, l.language as b_lang,
    l.primary_topic_display_name as b_topic
  from j1 left join a_linked l on j1.a_doi is null and j1.id_mag = l.id_openalex),
j3 as (select id_semanticscholar, id_mag, id_doi, id_arxiv,
    case when a_doi is not null then 'doi' when b_doi is not null then 'mag' end as joined_on,
    case when a_doi is not null then 1 else 0 end as doi_join_worked,
    case when b_id is not null then 1 else 0 end as mag_join_worked,
    case when a_doi is not null then a_id else b_id end as linked_id_openalex,
    case when a_doi is not null then a_doi else b_doi end as linked_id_doi,
    case when a_doi is not null then a_lang else b_lang end as linked_language,
    case when a_doi is not null then a_topic else b_topic end as linked_primary_topic_display_name
  from j2),
j4 as (select *, row_number() over (partition by id_semanticscholar order by id_mag desc nulls last,
      id_doi desc nulls last, id_arxiv desc nulls last, linked_id_openalex) as r,
    case when doi_join_worked = 1 then count(*) over (partition by id_semanticscholar) else 0 end as doi_candidates,
    case when mag_join_worked = 1 then count(*) over (partition by id_semanticscholar) else 0 end as mag_candidates
  from j3)"""


def _works(spark, sf_dir):
    return view(spark, sf_dir, "a_works").select("id_semanticscholar", "id_mag", "id_doi", "id_arxiv")


def _linked(spark, sf_dir):
    return view(spark, sf_dir, "a_linked").select(*LINKED)


@query(
    "link_by_first_id",
    f"""{with_views("a_works", "a_linked")}, {FALLBACK_SQL}
    select id_semanticscholar, id_doi, doi_join_worked, doi_candidates,
      case when doi_join_worked = 1 then linked_id_openalex end as linked_id_openalex
    from j4 where r = 1""",
)
def link_by_first_id(spark, sf_dir):
    linked = linkage.link_with_fallback(
        _works(spark, sf_dir), _linked(spark, sf_dir), DOI_THEN_MAG[:1], "id_semanticscholar",
        best=[F.col("id_openalex")],
    )
    return linked.select("id_semanticscholar", "id_doi", "doi_join_worked", "doi_candidates", "linked_id_openalex")


@query(
    "link_fallback",
    f"""{with_views("a_works", "a_linked")}, {FALLBACK_SQL}
    select * exclude (r), case when coalesce(id_mag, '') = '' then 0 else 1 end as has_id_mag,
      case when coalesce(id_doi, '') = '' then 0 else 1 end as has_id_doi,
      case when coalesce(id_doi, '') = '' and coalesce(id_mag, '') = '' then 0 else 1 end as has_id_mag_or_doi
    from j4 where r = 1""",
)
def link_fallback(spark, sf_dir):
    works = _works(spark, sf_dir).withColumns(
        {
            "has_id_mag": ids.present(F.col("id_mag")),
            "has_id_doi": ids.present(F.col("id_doi")),
            "has_id_mag_or_doi": ids.present(F.col("id_doi"), F.col("id_mag")),
        }
    )
    return linkage.link_with_fallback(
        works, _linked(spark, sf_dir), DOI_THEN_MAG, "id_semanticscholar", best=[F.col("id_openalex")]
    )


@query(
    "link_dedup",
    f"""{with_views("a_works", "a_linked")}, {FALLBACK_SQL}
    select id_semanticscholar, id_mag, id_doi, id_arxiv, joined_on, linked_id_openalex, linked_id_doi, linked_language
    from j4 where joined_on is not null and r = 1""",
)
def link_dedup(spark, sf_dir):
    """Untagged rows dropped, then one row per work; the SQL joins all pairs and picks afterwards."""
    linked = linkage.link_with_fallback(
        _works(spark, sf_dir), _linked(spark, sf_dir), DOI_THEN_MAG, "id_semanticscholar",
        best=[F.col("id_doi").isNull(), F.col("id_openalex")],
    ).filter(F.col("joined_on").isNotNull())
    order = [F.desc_nulls_last("id_mag"), F.desc_nulls_last("id_doi"), F.desc_nulls_last("id_arxiv")]
    return linkage.dedup_keep_first(linked, "id_semanticscholar", [*order, F.col("linked_id_openalex").asc()]).select(
        "id_semanticscholar", "id_mag", "id_doi", "id_arxiv", "joined_on",
        "linked_id_openalex", "linked_id_doi", "linked_language",
    )


@query(
    "works_enriched_left",
    """select o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment, c_nationkey, n_name
    from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""",
)
def works_enriched_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    nations = broadcast_if_small(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .drop("c_custkey", "n_nationkey")
    )


def _sql_codes(column: str) -> str:
    whens = " ".join(f"when {column} = '{u}' then '{c}'" for u, c in licences.URL_CODES.items())
    return f"case when {column} is null then null {whens} else concat('ArXiv: ', {column}) end"


def _sql_works_licence(column: str) -> str:
    unusable = ", ".join(f"'{t}'" for t in licences.UNUSABLE)
    return f"case when {column} in ({unusable}) then null when {column} = 'pd' then 'public-domain' else {column} end"


REUSABLE_SQL = "(" + ", ".join(f"'{c}'" for c in licences.REUSABLE) + ")"


@query(
    "licence_codes",
    f"""{with_views("a_works", "a_arxiv")},
    codes as (select 'works' as feed, {_sql_works_licence("original_license")} as license from a_works
      union all select 'preprints', {_sql_codes("license")} from a_arxiv)
    select feed, license, case when license in {REUSABLE_SQL} then 1 else 0 end as license_allows_derivative_reuse,
      case when license like 'ArXiv:%' then 1 else 0 end as is_unmapped,
      count(*) as n, round(count(*) / 1000000.0, 6) as c_mill
    from codes group by 1, 2, 3, 4""",
)
def licence_codes(spark, sf_dir):
    works = view(spark, sf_dir, "a_works").select(
        F.lit("works").alias("feed"), licences.works_licence(F.col("original_license")).alias("license")
    )
    preprints = view(spark, sf_dir, "a_arxiv").select(
        F.lit("preprints").alias("feed"), licences.preprint_licence(F.col("license")).alias("license")
    )
    flags = [
        licences.reuse_flag(F.col("license")).alias("license_allows_derivative_reuse"),
        F.when(F.col("license").like("ArXiv:%"), 1).otherwise(0).alias("is_unmapped"),
    ]
    return (
        works.unionByName(preprints)
        .groupBy("feed", "license", *flags)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("c_mill", F.round(F.col("n") / F.lit(1e6), 6))
        .orderBy("license_allows_derivative_reuse", "n")
    )


@query(
    "unmapped_licence_sample",
    f"""{with_views("a_arxiv")} select id_arxiv, {_sql_codes("license")} as license from a_arxiv
    where {_sql_codes("license")} like 'ArXiv:%' order by id_arxiv limit 3""",
)
def unmapped_licence_sample(spark, sf_dir):
    preprints = view(spark, sf_dir, "a_arxiv").select(
        "id_arxiv", licences.preprint_licence(F.col("license")).alias("license")
    )
    return preprints.filter(F.col("license").isNotNull() & F.col("license").like("ArXiv:%")).orderBy("id_arxiv").limit(3)


@query(
    "licence_fallback",
    f"""{with_views("a_works", "a_arxiv")}, p as (select id_arxiv, {_sql_codes("license")} as license from a_arxiv),
    w as (select id_semanticscholar, id_arxiv, {_sql_works_licence("original_license")} as license from a_works),
    j as (select w.id_semanticscholar, w.id_arxiv, coalesce(w.license, p.license, 'unknown-reusability') as license
      from w left join p on w.id_arxiv = p.id_arxiv)
    select *, case when license in {REUSABLE_SQL} then 1 else 0 end as license_allows_derivative_reuse from j""",
)
def licence_fallback(spark, sf_dir):
    works = view(spark, sf_dir, "a_works").select(
        "id_semanticscholar", "id_arxiv", licences.works_licence(F.col("original_license")).alias("license")
    )
    preprints = view(spark, sf_dir, "a_arxiv").select(
        F.col("id_arxiv").alias("_arxiv"), licences.preprint_licence(F.col("license")).alias("_license")
    )
    joined = linkage.lookup(works, preprints, F.col("id_arxiv"), "_arxiv", "id_semanticscholar")
    code = F.coalesce("license", "_license", F.lit(licences.UNKNOWN))
    return joined.select("id_semanticscholar", "id_arxiv", code.alias("license")).withColumn(
        "license_allows_derivative_reuse", licences.reuse_flag(F.col("license"))
    )


def _coverage_sql(flag: str, column: str) -> str:
    return f"""select '{flag}' as flag, {flag} as has_id, round(count(*) / 1000000.0, 9) as c_mill,
      round(count(*) * 100.0 / (select count(*) from a_works), 6) as p,
      round((select count(*) from a_works) / 1000000.0, 9) as total_mill
    from (select case when coalesce({column}, '') = '' then 0 else 1 end as {flag} from a_works) group by {flag}"""


@query(
    "coverage_by_flag",
    f"""{with_views("a_works")} {_coverage_sql("has_id_mag", "id_mag")}
    union all {_coverage_sql("has_id_doi", "id_doi")} union all {_coverage_sql("has_id_arxiv", "id_arxiv")}""",
)
def coverage_by_flag(spark, sf_dir):
    works, report = _works(spark, sf_dir), None
    for name in ("mag", "doi", "arxiv"):
        flag = f"has_id_{name}"
        part = reports.coverage(works.withColumn(flag, ids.present(F.col(f"id_{name}"))), [flag]).select(
            F.lit(flag).alias("flag"), F.col(flag).alias("has_id"), "c_mill", "p", "total_mill"
        )
        report = part if report is None else report.unionByName(part)
    return report.withColumns({c: F.round(c, d) for c, d in (("c_mill", 9), ("p", 6), ("total_mill", 9))})


CROSSTAB_FLAGS = ["has_id_mag_or_doi", "has_id_doi", "join_worked_on_doi", "has_id_mag", "join_worked_on_mag"]


@query(
    "coverage_crosstab",
    f"""{with_views("a_works", "a_linked")}, {FALLBACK_SQL},
    flagged as (select case when coalesce(id_mag, '') = '' then 0 else 1 end as has_id_mag,
      case when coalesce(id_doi, '') = '' then 0 else 1 end as has_id_doi,
      case when coalesce(id_doi, '') = '' and coalesce(id_mag, '') = '' then 0 else 1 end as has_id_mag_or_doi,
      doi_join_worked as join_worked_on_doi, mag_join_worked as join_worked_on_mag from j3)
    select {", ".join(CROSSTAB_FLAGS)}, round(count(*) / 1000000.0, 9) as c_mill,
      round(count(*) * 100.0 / (select count(*) from flagged), 6) as p,
      round((select count(*) from flagged) / 1000000.0, 9) as total_mill
    from flagged group by {", ".join(CROSSTAB_FLAGS)}""",
)
def coverage_crosstab(spark, sf_dir):
    works = _works(spark, sf_dir).select(
        "id_semanticscholar",
        F.lower("id_doi").alias("id_doi"),
        "id_mag",
        ids.present(F.col("id_mag")).alias("has_id_mag"),
        ids.present(F.col("id_doi")).alias("has_id_doi"),
        ids.present(F.col("id_doi"), F.col("id_mag")).alias("has_id_mag_or_doi"),
    )
    linked = _linked(spark, sf_dir).select("id_openalex", F.lower("id_doi").alias("id_doi"))
    keys = [("id_doi", "id_doi", "join_worked_on_doi"), ("id_mag", "id_openalex", "join_worked_on_mag")]
    report = reports.coverage_crosstab(works, linked, keys, CROSSTAB_FLAGS, "id_semanticscholar")
    return report.withColumns({c: F.round(c, d) for c, d in (("c_mill", 9), ("p", 6), ("total_mill", 9))})


def _success_sql(name: str, right: str, left_key: str, right_key: str) -> str:
    return f"""select '{name}' as join_type, case when r.{right_key} is null then 0 else 1 end as join_worked,
      count(*) as c from a_works w left join {right} r on w.{left_key} = r.{right_key} group by 2"""


@query(
    "join_success_union",
    f"""{with_views("a_works", "a_linked", "a_arxiv")}
    select 'original' as join_type, cast(null as bigint) as join_worked, count(*) as c from a_works
    union all {_success_sql("linked_doi", "a_linked", "id_doi", "id_doi")}
    union all {_success_sql("linked_mag", "a_linked", "id_mag", "id_openalex")}
    union all {_success_sql("preprint_id", "a_arxiv", "id_arxiv", "id_arxiv")}
    union all {_success_sql("preprint_doi", "a_arxiv", "id_doi", "id_doi")}""",
)
def join_success_union(spark, sf_dir):
    linked, preprints = _linked(spark, sf_dir), view(spark, sf_dir, "a_arxiv")
    return reports.join_success(
        _works(spark, sf_dir),
        {
            "linked_doi": (linked, "id_doi", "id_doi"),
            "linked_mag": (linked, "id_mag", "id_openalex"),
            "preprint_id": (preprints, "id_arxiv", "id_arxiv"),
            "preprint_doi": (preprints, "id_doi", "id_doi"),
        },
        "id_semanticscholar",
    )


@query(
    "id_conflicts",
    f"""{with_views("a_works", "a_linked")}
    select w.id_semanticscholar, w.id_mag, w.id_doi as works_id_doi, l.id_doi as linked_id_doi
    from a_works w join a_linked l on w.id_mag = l.id_openalex where w.id_doi <> l.id_doi""",
)
def id_conflicts(spark, sf_dir):
    """Linked by one id while the other ids, both known, differ."""
    linked = _linked(spark, sf_dir).select("id_openalex", F.col("id_doi").alias("linked_id_doi"))
    works = _works(spark, sf_dir)
    joined = linkage.lookup(works, linked, F.col("id_mag"), "id_openalex", "id_semanticscholar")
    return joined.filter(F.col("id_doi") != F.col("linked_id_doi")).select(
        "id_semanticscholar", "id_mag", F.col("id_doi").alias("works_id_doi"), "linked_id_doi"
    )


@query(
    "taxonomy_rollup",
    """with t as (select r_name, n_name, c_mktsegment from customer
      left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey)
    select 'domain' as level, r_name, null as n_name, null as c_mktsegment, count(*) as c from t group by r_name
    union all select 'domain_field', r_name, n_name, null, count(*) from t where true group by r_name, n_name
    union all select 'field', null, n_name, null, count(*) from t where r_name = 'ASIA' group by n_name
    union all select 'topic', r_name, n_name, c_mktsegment, count(*) from t
      where r_name = 'EUROPE' or n_name in ('CANADA', 'CHINA', 'KENYA') group by r_name, n_name, c_mktsegment""",
)
def taxonomy_rollup(spark, sf_dir):
    nations = broadcast_if_small(table(spark, sf_dir, "nation"))
    regions = broadcast_if_small(table(spark, sf_dir, "region"))
    taxonomy = (
        table(spark, sf_dir, "customer")
        .select("c_nationkey", "c_mktsegment")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    selected = (F.col("r_name") == "EUROPE") | F.col("n_name").isin("CANADA", "CHINA", "KENYA")
    return reports.rollups(
        taxonomy,
        {
            "domain": (["r_name"], None),
            "domain_field": (["r_name", "n_name"], F.lit(True)),
            "field": (["n_name"], F.col("r_name") == "ASIA"),
            "topic": (["r_name", "n_name", "c_mktsegment"], selected),
        },
    )


@query(
    "linked_field_rollup",
    f"""{with_views("a_linked")}
    select primary_topic_field_id, primary_topic_subfield_id, primary_topic_display_name, count(*) as c from a_linked
    where primary_topic_field_id = '17' or primary_topic_subfield_id in ('1702', '1704') group by 1, 2, 3""",
)
def linked_field_rollup(spark, sf_dir):
    keys = ["primary_topic_field_id", "primary_topic_subfield_id", "primary_topic_display_name"]
    keep = (F.col(keys[0]) == "17") | F.col(keys[1]).isin("1702", "1704")
    return reports.rollups(view(spark, sf_dir, "a_linked"), {"topic": (keys, keep)}).drop("level")


@query(
    "id_anomalies",
    f"""{with_views("a_linked")}
    select id_openalex, primary_topic_long_id, coalesce(primary_topic_short_id, primary_topic_long_id) as primary_topic_id,
      case when id_openalex in (select id_openalex from a_linked order by id_openalex limit 300) then 1 else 0 end as in_first
    from a_linked where primary_topic_short_id is null and primary_topic_long_id is not null""",
)
def id_anomalies(spark, sf_dir):
    """Short id missing although the long one is there; ``in_first``: also within the first 300 ids."""
    linked = view(spark, sf_dir, "a_linked")
    first = F.broadcast(linked.select(F.col("id_openalex").alias("_first")).orderBy("_first").limit(300))
    odd = linked.filter(F.col("primary_topic_short_id").isNull() & F.col("primary_topic_long_id").isNotNull())
    return odd.join(first, F.col("id_openalex") == F.col("_first"), "left").select(
        "id_openalex",
        "primary_topic_long_id",
        F.coalesce("primary_topic_short_id", "primary_topic_long_id").alias("primary_topic_id"),
        ids.not_null(F.col("_first")).alias("in_first"),
    )


@query(
    "field_filter",
    f"""{with_views("a_linked")}
    select id_openalex, lower(id_doi) as id_doi, coalesce(primary_topic_short_id, primary_topic_long_id) as primary_topic_id,
      primary_topic_subfield_id from a_linked
    where primary_topic_field_id = '17' and primary_topic_subfield_id is not null
      and coalesce(primary_topic_short_id, primary_topic_long_id) is not null and length(id_openalex) > 1""",
)
def field_filter(spark, sf_dir):
    return (
        view(spark, sf_dir, "a_linked")
        .select(
            "id_openalex",
            F.lower("id_doi").alias("id_doi"),
            F.coalesce("primary_topic_short_id", "primary_topic_long_id").alias("primary_topic_id"),
            "primary_topic_subfield_id",
            "primary_topic_field_id",
        )
        .filter(
            (F.col("primary_topic_field_id") == "17")
            & F.col("primary_topic_subfield_id").isNotNull()
            & F.col("primary_topic_id").isNotNull()
            & (F.length("id_openalex") > 1)
        )
        .drop("primary_topic_field_id")
    )


@query(
    "prefix_strip_cast",
    f"""{with_views("a_merge")}
    select 'id' as column_name, substr(id, 1, 1) as starts_with, count(*) as c,
      cast(sum(cast(substr(id, 2) as bigint)) as bigint) as id_sum from a_merge group by 2
    union all select 'merge_into_id', substr(merge_into_id, 1, 1), count(*),
      cast(sum(cast(substr(merge_into_id, 2) as bigint)) as bigint) from a_merge group by 2""",
)
def prefix_strip_cast(spark, sf_dir):
    """First letters of the raw ids next to the sum of the numeric ones."""
    raw, report = view(spark, sf_dir, "a_merge"), None
    for name in ("id", "merge_into_id"):
        part = (
            raw.groupBy(ids.first_letter(F.col(name)).alias("starts_with"))
            .agg(
                F.count(F.lit(1)).alias("c"),
                F.sum(ids.strip_prefix_id(F.col(name), "W").cast("bigint")).alias("id_sum"),
            )
            .select(F.lit(name).alias("column_name"), "starts_with", "c", "id_sum")
        )
        report = part if report is None else report.unionByName(part)
    return report


NUMBERS = """m as (select cast(substr(id, 2) as bigint) as id, cast(substr(merge_into_id, 2) as bigint) as merge_into_id
  from a_merge)"""


@query(
    "merge_chain",
    f"""{with_views("a_merge")}, {NUMBERS}
    select m.id, m.merge_into_id, b.id as id_2, b.merge_into_id as merge_into_id_2, c.id as id_3,
      c.merge_into_id as merge_into_id_3, d.id as id_4, d.merge_into_id as merge_into_id_4,
      coalesce(d.merge_into_id, c.merge_into_id, b.merge_into_id, m.merge_into_id) as merge_into_id_final
    from m left join m b on m.merge_into_id = b.id left join m c on b.merge_into_id = c.id
      left join m d on c.merge_into_id = d.id""",
)
def merge_chain(spark, sf_dir):
    return linkage.resolve_merges(linkage.merge_map(view(spark, sf_dir, "a_merge")))


@query(
    "merge_chain_full",
    f"""with recursive {with_views("a_merge")[5:]}, {NUMBERS},
    walk as (select id, merge_into_id, merge_into_id as last_seen from m
      union all select walk.id, walk.merge_into_id, m.merge_into_id from walk join m on walk.last_seen = m.id)
    select id, merge_into_id, last_seen as merge_into_id_final from walk where last_seen not in (select id from m)""",
)
def merge_chain_full(spark, sf_dir):
    return linkage.resolve_merges_fully(linkage.merge_map(view(spark, sf_dir, "a_merge")))


@query(
    "url_short_ids",
    """select page_id, split_part(url, '/', -1) as last_segment, substr(split_part(url, '/', -1), 2) as number_part,
      array_to_string(string_split(url, '/')[4:], '/') as path_id from pages""",
)
def url_short_ids(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        ids.url_last_segment(url).alias("last_segment"),
        ids.url_number(url).alias("number_part"),
        ids.url_path_id(url).alias("path_id"),
    )


@query(
    "topic_canonical_names",
    f"""{with_views("a_linked")}, {feeds.TAXONOMY_SQL},
    g as (select cast(substr(primary_topic_short_id, 2) as bigint) as topic_id, count(*) as topic_count
      from a_linked where primary_topic_short_id is not null group by 1)
    select row_number() over (order by g.topic_count desc, g.topic_id) - 1 as topic_index, g.topic_id,
      t.display_name as topic_display_name, g.topic_count,
      round(g.topic_count * 100.0 / (select sum(topic_count) from g), 6) as topic_percent,
      t.subfield_id,
      t.subfield_name as subfield_display_name
    from g left join taxonomy t on concat('https://openalex.org/T', cast(g.topic_id as varchar)) = t.id""",
)
def topic_canonical_names(spark, sf_dir):
    works = view(spark, sf_dir, "a_linked").filter(F.col("primary_topic_short_id").isNotNull())
    topics = models.topics(
        works.select(F.substring("primary_topic_short_id", 2, 20).cast("int").alias("openalex_primary_topic_id")),
        feeds.taxonomy(spark, sf_dir),
    )
    names = {c: c.replace("openalex_primary_topic_", "topic_").replace("topic_subfield", "subfield") for c in topics.columns}
    return topics.withColumnsRenamed(names).withColumn("topic_percent", F.round("topic_percent", 6))
