"""The corpus tables, from raw feeds to the published splits.

Each function takes frames and returns a frame, named like the table it makes.
Tables that hold full texts are only ever filtered, projected and tagged by
broadcast cut-offs; the one place where texts move is their join to the metadata.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.functions import ids, licences
from papyrine.operators import labels, linkage, sampling
from papyrine.operators import sections as sections_ops
from papyrine.operators.linkage import LinkKey
from papyrine.session import store

TOPIC = "openalex_primary_topic"
SUBFIELD = f"{TOPIC}_subfield"


@dataclass(frozen=True)
class Settings:
    """Fixed values of the published corpus; tests use smaller caps."""

    language: str = "en"
    field_id: str = "17"
    subfield_cap: int = 20_000
    topic_cap: int = 2_500
    topic_min: int = 400
    seed: int = 42
    resplit_seed: int = 43
    subsets: tuple[str, ...] = ("train", "test", "validation")


# Raw feeds to base tables.


def base_arxiv_metadata(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("id_arxiv"),
        F.col("doi").alias("id_doi"),
        "title",
        "abstract",
        licences.preprint_licence(F.col("license")).alias("license"),
    )


def base_semanticscholar_s2orcv2(raw: DataFrame) -> DataFrame:
    """Typed fields instead of JSON paths, so that the Parquet scan reads only these leaves."""
    return raw.select(
        F.col("corpusid").alias("id_semanticscholar"),
        F.col("openaccessinfo.externalids.mag").alias("id_mag"),
        F.lower("openaccessinfo.externalids.doi").alias("id_doi"),
        F.col("openaccessinfo.externalids.arxiv").alias("id_arxiv"),
        "title",
        F.col("openaccessinfo.url").alias("source_url"),
        F.col("openaccessinfo.status").alias("openaccess_status"),
        F.col("body.text").alias("content_text"),
        F.col("body.annotations.paragraph").alias("annotations_paragraph"),
        F.col("body.annotations.section_header").alias("annotations_section_header"),
        licences.works_licence(F.col("openaccessinfo.license")).alias("license"),
    )


# Annotation types and external ids of the older works feed.
OLD_ANNOTATIONS = [
    "abstract", "author", "authoraffiliation", "authorfirstname", "authorlastname", "bibauthor",
    "bibauthorfirstname", "bibauthorlastname", "bibentry", "bibref", "bibtitle", "bibvenue", "figure",
    "figurecaption", "figureref", "formula", "paragraph", "publisher", "sectionheader", "table", "tableref",
    "title", "venue",
]
OLD_IDS = ["arxiv", "mag", "acl", "pubmed", "pubmedcentral", "dblp", "doi"]


def s2orc_structured(raw: DataFrame) -> DataFrame:
    """The older works feed, flattened. The title is the span ``start`` .. ``end`` of the text
    taken as 1-based and inclusive, as that feed's users did; a start of 0 counts as 1."""
    span = F.from_json("content.annotations.title", "array<struct<start:string,end:string>>")
    start, end = F.get(span, F.lit(0))["start"].cast("int"), F.get(span, F.lit(0))["end"].cast("int")
    title = F.substr(F.col("content.text"), F.greatest(start, F.lit(1)), F.greatest(end - start + 1, F.lit(0)))
    return raw.select(
        "corpusid",
        title.alias("content_title"),
        F.col("content.text").alias("content_text"),
        *[F.col(f"content.source.{c}").alias(f"content_source_{c}") for c in ("pdfurls", "pdfsha")],
        *[
            F.col(f"content.source.oainfo.{c}").alias(f"content_source_oainfo_{c}")
            for c in ("license", "openaccessurl", "status")
        ],
        *[F.col(f"content.annotations.{c}").alias(f"content_annotations_{c}") for c in OLD_ANNOTATIONS],
        *[F.col(f"externalids.{c}").alias(f"externalids_{c}") for c in OLD_IDS],
    )


def base_openalex_works_reduced_filtered(reduced: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Works of one field with topic and subfield; the short id, or the long one if that is missing."""

    def level(name: str) -> list:
        node = f"primary_topic{name}"
        return [
            F.coalesce(f"{node}_short_id", f"{node}_long_id").alias(f"{node}_id"),
            F.col(f"{node}_display_name"),
        ]

    works = reduced.select(
        F.col("id_openalex_short").alias("id_openalex"),
        F.lower("id_doi_short").alias("id_doi"),
        "title",
        "language",
        *level(""),
        *level("_subfield"),
        *level("_field"),
        *level("_domain"),
    )
    return works.filter(
        (F.col("primary_topic_field_id") == settings.field_id)
        & F.col("primary_topic_subfield_id").isNotNull()
        & F.col("primary_topic_id").isNotNull()
    )


def base_openalex_merged_ids(raw: DataFrame) -> DataFrame:
    return linkage.resolve_merges(linkage.merge_map(raw))


# Works with abstract and date, in a wide and two narrow forms.


def stg_semanticscholar_combined_works(works: DataFrame, papers: DataFrame, abstracts: DataFrame) -> DataFrame:
    dates = papers.select(
        F.col("corpusid").alias("_paper"),
        F.col("year").alias("publication_year"),
        F.col("publicationdate").alias("publication_date"),
    )
    texts = abstracts.select(F.col("corpusid").alias("_abstract"), F.col("abstract").alias("content_abstract"))
    return (
        works.join(dates, F.col("id_semanticscholar") == F.col("_paper"), "left")
        .join(texts, F.col("id_semanticscholar") == F.col("_abstract"), "left")
        .drop("_paper", "_abstract")
    )


CONTENT = ["title", "content_abstract", "content_text", "annotations_paragraph", "annotations_section_header"]
METADATA = [
    "id_mag", "id_doi", "id_arxiv", "source_url", "openaccess_status", "license", "publication_year",
    "publication_date",
]


def stg_semanticscholar_combined_works_content(works: DataFrame) -> DataFrame:
    return works.select("id_semanticscholar", *CONTENT)


def stg_semanticscholar_combined_works_metadata(works: DataFrame) -> DataFrame:
    return works.select("id_semanticscholar", *METADATA)


# Linkage.


def stg_unified_works_metadata_01_joined_to_arxiv(works: DataFrame, preprints: DataFrame) -> DataFrame:
    other = preprints.select(F.col("id_arxiv").alias("_arxiv"), F.col("license").alias("_license"))
    joined = linkage.lookup(works, other, F.col("id_arxiv"), "_arxiv", "id_semanticscholar")
    code = F.coalesce("license", "_license", F.lit(licences.UNKNOWN))
    return (
        joined.withColumn("license", code)
        .drop("_arxiv", "_license")
        .withColumn("license_allows_derivative_reuse", licences.reuse_flag(F.col("license")))
    )


def stg_unified_works_metadata_02_joined_to_openalex(
    works: DataFrame, linked: DataFrame, strict_link_flag: bool = False
) -> DataFrame:
    """One row per work that links by DOI, or else by MAG id; ids as numbers.

    Of several candidates for a key the one with a DOI and the lowest id is taken before
    the join, which gives the rows that joining all and deduplicating would give.
    """
    flagged = works.drop("openaccess_status").withColumns(
        {
            "has_id_mag": ids.present(F.col("id_mag")),
            "has_id_doi": ids.present(F.col("id_doi")),
            "has_id_mag_or_doi": ids.present(F.col("id_doi"), F.col("id_mag")),
        }
    )
    number = F.col("id_openalex").cast("bigint")
    joined = linkage.link_with_fallback(
        flagged,
        linked.drop("title"),
        [LinkKey("id_doi", "id_doi", "doi"), LinkKey("id_mag", "id_openalex", "mag")],
        "id_semanticscholar",
        best=[F.col("id_doi").isNull(), number],
        strict_link_flag=strict_link_flag,
        prefix="openalex_",
        method="openalex_joined_on",
    ).filter(F.col("openalex_joined_on").isNotNull())
    numbers = {
        "openalex_id_openalex": F.col("openalex_id_openalex").cast("bigint"),
        f"{TOPIC}_id": F.substr(F.col(f"{TOPIC}_id"), F.lit(2)).cast("int"),
        **{f"{TOPIC}_{n}_id": F.col(f"{TOPIC}_{n}_id").cast("int") for n in ("subfield", "field", "domain")},
    }
    order = [F.desc_nulls_last(c) for c in ("id_mag", "id_doi", "id_arxiv", "publication_date")]
    return linkage.dedup_keep_first(
        joined.withColumns(numbers).drop("doi_join_worked", "mag_join_worked", "doi_candidates", "mag_candidates"),
        "id_semanticscholar",
        [*order, F.col("openalex_id_openalex").asc_nulls_last()],
    )


# Splits and labels.


def stg_unified_works_metadata_03_filtered_and_tagged(works: DataFrame, settings: Settings = Settings()) -> DataFrame:
    usable = works.filter(
        (F.col("openalex_language") == settings.language) & (F.col("license_allows_derivative_reuse") == 1)
    )
    return sampling.stratified_split(usable, f"{TOPIC}_id", "id_semanticscholar", settings.seed)


def topics(works: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Topic counts, shares and indices; names and subfield come from the taxonomy, because
    works may carry a name that does not belong to their topic id."""
    counts = works.groupBy(f"{TOPIC}_id").agg(F.count(F.lit(1)).alias(f"{TOPIC}_count"))
    numbered = labels.class_index(counts, [f"{TOPIC}_id"], f"{TOPIC}_count", f"{TOPIC}_index")
    numbered = labels.with_percent(numbered, f"{TOPIC}_count", f"{TOPIC}_percent")
    names = taxonomy.select(
        F.col("id").alias("_id"),
        F.col("display_name").alias(f"{TOPIC}_display_name"),
        F.replace("subfield.id", F.lit("https://openalex.org/subfields/"), F.lit("")).cast("int").alias(f"{SUBFIELD}_id"),
        F.col("subfield.display_name").alias(f"{SUBFIELD}_display_name"),
    )
    key = F.concat(F.lit("https://openalex.org/T"), F.col(f"{TOPIC}_id").cast("string"))
    return numbered.join(names, key == F.col("_id"), "left").drop("_id")


def subfields(topic_rows: DataFrame) -> DataFrame:
    keys = [f"{SUBFIELD}_id", f"{SUBFIELD}_display_name"]
    counts = topic_rows.groupBy(*keys).agg(F.sum(f"{TOPIC}_count").alias(f"{SUBFIELD}_count"))
    numbered = labels.class_index(counts, keys, f"{SUBFIELD}_count", f"{SUBFIELD}_index")
    return labels.with_percent(numbered, f"{SUBFIELD}_count", f"{SUBFIELD}_percent")


def stg_unified_works_metadata_04_with_topics_and_subfields(
    works: DataFrame, topic_rows: DataFrame, subfield_rows: DataFrame
) -> DataFrame:
    """The subfield is looked up by the work's own subfield id, not by its topic's."""
    joined = works.drop("bucket_10p")
    for name, rows in ((TOPIC, topic_rows), (SUBFIELD, subfield_rows)):
        take = {f"{name}_count": f"{name}_count", f"{name}_index": f"{name}_index"}
        joined = labels.attach_labels(joined, rows, {f"{name}_id": f"{name}_id"}, take)
    return joined


def stg_unified_works_filtered(metadata: DataFrame, content: DataFrame) -> DataFrame:
    """Metadata with texts; title, abstract and text must be there. The key filter that
    Spark builds at run time from the metadata drops unneeded texts before they move."""
    complete = content.dropna(subset=["title", "content_abstract", "content_text"])
    return metadata.join(complete, "id_semanticscholar")


# The semi-balanced variant.


def stg_unified_works_filtered_semibalanced_reduced(works: DataFrame, settings: Settings = Settings()) -> DataFrame:
    caps = {f"{SUBFIELD}_display_name": settings.subfield_cap, f"{TOPIC}_display_name": settings.topic_cap}
    return sampling.cap_classes(
        works, caps, "id_semanticscholar", settings.seed, settings.topic_min, f"{TOPIC}_display_name"
    )


def semibalanced_labels(reduced: DataFrame, name: str) -> DataFrame:
    """Topics or subfields of the reduced set by display name, counted and indexed anew."""
    key = f"{name}_display_name"
    return labels.class_index(sampling.class_counts(reduced, key, f"{name}_count"), [key], f"{name}_count", f"{name}_index")


def stg_unified_works_filtered_semibalanced(
    reduced: DataFrame, topic_rows: DataFrame, subfield_rows: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """New indices and a new split; the count columns keep the values of the unreduced set."""
    works = reduced.drop("subset", "new_topic_count", f"{TOPIC}_index", f"{SUBFIELD}_index")
    for name, rows in ((TOPIC, topic_rows), (SUBFIELD, subfield_rows)):
        key = f"{name}_display_name"
        works = labels.attach_labels(works, rows, {key: key}, {f"{name}_index": f"{name}_index"})
    return sampling.stratified_split(works, f"{TOPIC}_display_name", "id_semanticscholar", settings.resplit_seed)


# Published tables.


def core_works(works: DataFrame) -> DataFrame:
    return works.select(
        F.col("id_semanticscholar").alias("id"),
        F.col(f"{TOPIC}_index").alias("topic_index"),
        F.col(f"{TOPIC}_display_name").alias("topic_display_name"),
        F.col(f"{SUBFIELD}_index").alias("subfield_index"),
        F.col(f"{SUBFIELD}_display_name").alias("subfield_display_name"),
        "title",
        F.col("content_abstract").alias("abstract"),
        F.col("content_text").alias("fulltext"),
        "subset",
    )


def core_topics(topic_rows: DataFrame) -> DataFrame:
    return topic_rows.select(
        F.col(f"{TOPIC}_index").alias("topic_index"),
        F.col(f"{TOPIC}_id").alias("topic_original_id"),
        F.col(f"{TOPIC}_display_name").alias("topic_display_name"),
        F.col(f"{TOPIC}_count").alias("topic_count"),
        F.col(f"{SUBFIELD}_id").alias("subfield_original_id"),
        F.col(f"{SUBFIELD}_display_name").alias("subfield_display_name"),
    )


def core_subfields(subfield_rows: DataFrame) -> DataFrame:
    return subfield_rows.select(
        F.col(f"{SUBFIELD}_index").alias("subfield_index"),
        F.col(f"{SUBFIELD}_id").alias("subfield_original_id"),
        F.col(f"{SUBFIELD}_display_name").alias("subfield_display_name"),
        F.col(f"{SUBFIELD}_count").alias("subfield_count"),
    )


def core_semibalanced_labels(rows: DataFrame, name: str, short: str) -> DataFrame:
    return rows.select(*[F.col(f"{name}_{c}").alias(f"{short}_{c}") for c in ("index", "display_name", "count")])


# All of them.


def corpus_tables(
    raw: dict[str, DataFrame], settings: Settings = Settings(), keep: Callable[[DataFrame], DataFrame] = store
) -> Iterator[tuple[str, DataFrame]]:
    """Every table with its name, each after those it reads.

    ``keep`` stores what several tables read and gives it back, by default as Parquet
    in the shared folder. All other tables are views until they are written.
    """
    linked_works = keep(base_openalex_works_reduced_filtered(raw["openalex_works_reduced"], settings))
    yield "base_openalex_works_reduced_filtered", linked_works
    own_works = base_semanticscholar_s2orcv2(raw["semanticscholar_s2orc_v2"])
    yield "base_semanticscholar_s2orcv2", own_works
    works = stg_semanticscholar_combined_works(
        own_works, raw["semanticscholar_papers"], raw["semanticscholar_abstracts"]
    )
    yield "stg_semanticscholar_combined_works", works
    content = stg_semanticscholar_combined_works_content(works)
    yield "stg_semanticscholar_combined_works_content", content
    metadata = stg_semanticscholar_combined_works_metadata(works)
    yield "stg_semanticscholar_combined_works_metadata", metadata
    preprints = base_arxiv_metadata(raw["arxiv_metadata"])
    yield "base_arxiv_metadata", preprints
    yield "base_openalex_merged_ids", base_openalex_merged_ids(raw["openalex_merged_ids"])

    licensed = stg_unified_works_metadata_01_joined_to_arxiv(metadata, preprints)
    yield "stg_unified_works_metadata_01_joined_to_arxiv", licensed
    linked = keep(stg_unified_works_metadata_02_joined_to_openalex(licensed, linked_works))
    yield "stg_unified_works_metadata_02_joined_to_openalex", linked
    tagged = keep(stg_unified_works_metadata_03_filtered_and_tagged(linked, settings))
    yield "stg_unified_works_metadata_03_filtered_and_tagged", tagged
    topic_rows = keep(topics(tagged, raw["openalex_topics"]))
    yield "stg_topics", topic_rows
    subfield_rows = keep(subfields(topic_rows))
    yield "stg_subfields", subfield_rows
    labelled = stg_unified_works_metadata_04_with_topics_and_subfields(tagged, topic_rows, subfield_rows)
    yield "stg_unified_works_metadata_04_with_topics_and_subfields", labelled
    yield "topics", core_topics(topic_rows)
    yield "subfields", core_subfields(subfield_rows)

    full = keep(stg_unified_works_filtered(labelled, content))
    yield "stg_unified_works_filtered", full
    yield from _with_splits("unified_works", core_works(full), settings)

    reduced = stg_unified_works_filtered_semibalanced_reduced(full, settings)
    yield "stg_unified_works_filtered_semibalanced_reduced", reduced
    few_topics = keep(semibalanced_labels(reduced, TOPIC))
    yield "stg_topics_semibalanced", few_topics
    few_subfields = keep(semibalanced_labels(reduced, SUBFIELD))
    yield "stg_subfields_semibalanced", few_subfields
    yield "topics_semibalanced", core_semibalanced_labels(few_topics, TOPIC, "topic")
    yield "subfields_semibalanced", core_semibalanced_labels(few_subfields, SUBFIELD, "subfield")
    balanced = stg_unified_works_filtered_semibalanced(reduced, few_topics, few_subfields, settings)
    yield "stg_unified_works_filtered_semibalanced", balanced
    yield from _with_splits("unified_works_semibalanced", core_works(balanced), settings)

    key, notes = "id_semanticscholar", ("annotations_section_header", "annotations_paragraph")
    spans = sections_ops.annotation_spans(full, key, *notes)
    yield "stg_filtered_work_section_annotations", spans
    sections = sections_ops.sections_with_text(full, key, "content_text", *notes)
    yield "stg_filtered_work_sections", sections
    stats = sections_ops.section_stats_in_row(full, *notes)
    yield "stg_unified_works_filtered_with_section_stats", stats
    yield "stg_filtered_work_sections_with_headers", sections_ops.sections_with_headers_in_row(
        full, key, "content_text", *notes
    )
    chapters = sections_ops.chapters_in_row(full, key, "content_text", *notes)
    yield "stg_filtered_work_chapters", chapters
    methodology = sections_ops.methodology_chapters(chapters)
    yield "stg_filtered_work_chapters_methodology", methodology
    yield "stg_filtered_work_chapters_methodology_single", sections_ops.single_methodology_chapters(methodology)


def _with_splits(name: str, works: DataFrame, settings: Settings) -> Iterator[tuple[str, DataFrame]]:
    yield name, works
    for subset in settings.subsets:
        yield f"{name}_{subset}", works.filter(F.col("subset") == subset)


def corpus_table(raw: dict[str, DataFrame], name: str, settings: Settings = Settings()) -> DataFrame:
    """One table; nothing after it is built."""
    for made, frame in corpus_tables(raw, settings):
        if made == name:
            return frame
    raise ValueError(f"no table {name!r}")
