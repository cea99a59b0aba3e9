"""Raw JSON lines of the linked corpus: parsing, rejects, reduction to flat columns, key audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.functions.ids import url_last_segment, url_number, url_path_id
from papyrine.operators.barrier import computed_once

# The fields read from a work, and all top-level keys a work may have.
WORK_SCHEMA = (
    "id string, doi string, display_name string, title string, language string, publication_year int, "
    "ids struct<pmid: string, mag: string>, type string, "
    "primary_topic struct<id: string, display_name: string, score: double, "
    "subfield: struct<id: string, display_name: string>, field: struct<id: string, display_name: string>, "
    "domain: struct<id: string, display_name: string>>"
)
KNOWN_KEYS = [
    "id", "doi", "doi_registration_agency", "display_name", "title", "publication_year", "publication_date",
    "language", "ids", "primary_location", "best_oa_location", "type", "open_access", "authorships",
    "corresponding_author_ids", "corresponding_institution_ids", "cited_by_count", "summary_stats", "biblio",
    "is_retracted", "is_paratext", "concepts", "mesh", "locations_count", "locations", "referenced_works",
    "referenced_works_count", "sustainable_development_goals", "grants", "apc_list", "apc_paid", "related_works",
    "abstract_inverted_index", "counts_by_year", "cited_by_api_url", "updated_date", "created_date", "updated",
    "authors_count", "concepts_count", "type_crossref", "institutions_distinct_count",
]

CORRUPT = "_corrupt_record"


def parse_lines(lines: DataFrame, schema: str = WORK_SCHEMA, key: str = "id", value: str = "value") -> DataFrame:
    """Add ``record`` and ``status``: ``ok``, ``unparsable`` or ``no_<key>``.

    A line whose key is there but null is kept; only its absence is an error. The
    raw keys are looked at only for lines that leave a doubt.
    """
    record = F.from_json(
        value, f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    keys = F.json_object_keys(value)
    status = (
        F.when(F.col("record").isNull(), "unparsable")
        .when(F.col(f"record.{key}").isNotNull() & F.col(f"record.{CORRUPT}").isNull(), "ok")
        .when(keys.isNull(), "unparsable")
        .when(F.array_contains(keys, key), "ok")
        .otherwise(f"no_{key}")
    )
    return computed_once(lines, record=record).withColumn("status", status)


def split_records(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of good lines, and the bad lines with their reason."""
    good = parsed.filter(F.col("status") == "ok").select("record.*").drop(CORRUPT)
    return good, parsed.filter(F.col("status") != "ok").drop("record")


def _level(name: str) -> list[Column]:
    node = f"primary_topic.{name}"
    return [
        F.col(f"{node}.id").alias(f"primary_topic_{name}_long_id"),
        url_last_segment(F.col(f"{node}.id")).alias(f"primary_topic_{name}_short_id"),
        F.col(f"{node}.display_name").alias(f"primary_topic_{name}_display_name"),
    ]


def reduce_records(df: DataFrame) -> DataFrame:
    """Nested works to 25 flat columns; what is missing is NULL."""
    return df.select(
        F.col("id").alias("id_openalex_long"),
        url_number(F.col("id")).alias("id_openalex_short"),
        F.col("doi").alias("id_doi_long"),
        url_path_id(F.col("doi")).alias("id_doi_short"),
        "display_name",
        "title",
        "language",
        "publication_year",
        F.col("ids.pmid").alias("id_pmid_long"),
        url_path_id(F.col("ids.pmid")).alias("id_pmid_short"),
        F.col("ids.mag").alias("id_mag"),
        F.col("type").alias("item_type"),
        F.col("primary_topic.id").alias("primary_topic_long_id"),
        url_last_segment(F.col("primary_topic.id")).alias("primary_topic_short_id"),
        F.col("primary_topic.display_name").alias("primary_topic_display_name"),
        F.col("primary_topic.score").alias("primary_topic_score"),
        *_level("subfield"),
        *_level("field"),
        *_level("domain"),
    )


def audit_keys(lines: DataFrame, known: list[str] = KNOWN_KEYS, value: str = "value") -> DataFrame:
    """Add ``status`` (``unparsable``, ``unknown keys``, ``ok``) and ``unknown_keys`` (sorted)."""
    unknown = F.sort_array(F.array_except(F.json_object_keys(value), F.lit(known)))
    return computed_once(lines, unknown_keys=unknown).withColumn(
        "status",
        F.when(F.col("unknown_keys").isNull(), "unparsable")
        .when(F.size("unknown_keys") > 0, "unknown keys")
        .otherwise("ok"),
    )


def lines_with_all(lines: DataFrame, needles: list[str], value: str = "value") -> DataFrame:
    """Lines that contain every one of the texts."""
    condition = F.lit(True)
    for needle in needles:
        condition = condition & F.col(value).contains(needle)
    return lines.filter(condition)
