"""Raw files, tables, exports and incremental loads, written from the documents and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from papyrine.functions.ids import clean_line
from papyrine.operators import labels, reduction, reports, sampling
from papyrine.operators.sections import annotation_spans
from papyrine.plans import models
from papyrine.plans.analogues import view, with_views
from papyrine.plans.classes import SPLIT, TOPIC_INDEX, _indices, _split
from papyrine.plans.feeds import KIND, REDUCED_SQL, raw_lines
from papyrine.plans.registry import query, table
from papyrine.plans.sections import annotated_documents
from papyrine.session import scratch_path, stage, store
from papyrine.sources import readers, tables
from papyrine.streaming import incremental

REDUCED_QUERY = f"with {REDUCED_SQL} select * from reduced"


def _write_lines(lines, path: str, mode: str = "error") -> None:
    lines.select("value").write.mode(mode).text(path, compression="gzip")


@query("raw_json_reduce", REDUCED_QUERY)
def raw_json_reduce(spark, sf_dir):
    """Gzip JSON lines to reduced JSON lines, read back."""
    raw, reduced_path = scratch_path(spark, "raw"), scratch_path(spark, "reduced")
    _write_lines(raw_lines(spark, sf_dir), raw)
    good, _ = readers.read_jsonl(spark, raw)
    reduced = reduction.reduce_records(good)
    tables.write_jsonl(reduced, reduced_path)
    return spark.read.schema(reduced.schema).json(reduced_path)


@query(
    "raw_json_rejects",
    f"""select case kind when 'broken' then 'unparsable' else 'no_id' end as status, count(*) as lines,
      cast(sum(doc_id) as bigint) as id_sum from (select doc_id, {KIND} as kind from documents)
    where kind in ('broken', 'no_id') group by 1""",
)
def raw_json_rejects(spark, sf_dir):
    """What was dropped and why; the ids are read off the rejected lines."""
    raw = scratch_path(spark, "raw")
    _write_lines(raw_lines(spark, sf_dir), raw)
    _, rejects = readers.read_jsonl(spark, raw)
    number = F.when(F.col("status") == "unparsable", F.regexp_extract("value", r'"id": (\d+)', 1)).otherwise(
        F.regexp_extract("value", r'"display_name":"Work (\d+)"', 1)
    )
    return rejects.groupBy("status").agg(F.count(F.lit(1)).alias("lines"), F.sum(number.cast("bigint")).alias("id_sum"))


@query(
    "schema_drift_audit",
    f"""select case kind when 'broken' then 'unparsable' when 'extra' then 'unknown keys' else 'ok' end as status,
      case kind when 'broken' then null when 'extra' then 'another,surprise' else '' end as unknown_keys, count(*) as lines
    from (select {KIND} as kind from documents) group by 1, 2""",
)
def schema_drift_audit(spark, sf_dir):
    raw = scratch_path(spark, "raw")
    _write_lines(raw_lines(spark, sf_dir), raw)
    audited = reduction.audit_keys(readers.read_lines(spark, raw), [*reduction.KNOWN_KEYS, "primary_topic"])
    keys = F.when(F.col("unknown_keys").isNotNull(), F.array_join("unknown_keys", ","))
    return audited.groupBy("status", keys.alias("unknown_keys")).agg(F.count(F.lit(1)).alias("lines"))


@query("incremental_reduce", REDUCED_QUERY)
def incremental_reduce(spark, sf_dir):
    """Two deliveries of raw parts and three calls of the stream: every line comes out once."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("source", "target", "checkpoint"))
    lines = raw_lines(spark, sf_dir)
    _write_lines(lines.filter(F.col("doc_id") % 2 == 0), source)
    incremental.incremental_reduce(spark, source, target, checkpoint)
    _write_lines(lines.filter(F.col("doc_id") % 2 == 1), source, "append")
    incremental.incremental_reduce(spark, source, target, checkpoint)
    incremental.incremental_reduce(spark, source, target, checkpoint)
    return spark.read.parquet(target)


@query("manifest_skip", REDUCED_QUERY)
def manifest_skip(spark, sf_dir):
    """The same two deliveries as batches with a manifest of the parts done."""
    source, target, manifest = (scratch_path(spark, n) for n in ("source", "target", "manifest"))
    lines = raw_lines(spark, sf_dir)
    _write_lines(lines.filter(F.col("doc_id") % 2 == 0), source)
    incremental.ingest_new_parts(spark, source, target, manifest)
    _write_lines(lines.filter(F.col("doc_id") % 2 == 1), source, "append")
    incremental.ingest_new_parts(spark, source, target, manifest)
    if incremental.ingest_new_parts(spark, source, target, manifest):
        raise RuntimeError("a part was taken twice")
    return incremental.recorded_rows(spark, target, manifest)


@query("csv_roundtrip", f'{with_views("a_merge")} select id, merge_into_id from a_merge')
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "merged-ids")
    view(spark, sf_dir, "a_merge").write.csv(path, header=True, compression="gzip")
    return readers.read_csv_map(spark, path)


@query(
    "partition_scan",
    """select doc_id, n_chars, concat('2024-01-0', 1 + doc_id % 5) as updated_date from documents where doc_id % 5 >= 2""",
)
def partition_scan(spark, sf_dir):
    """Date folders as one table; the filter skips the first two folders."""
    path = scratch_path(spark, "works")
    day = F.concat(F.lit("2024-01-0"), (F.col("doc_id") % 5 + 1).cast("string"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", day.alias("updated_date"))
    documents.write.partitionBy("updated_date").json(path, compression="gzip")
    rows = readers.read_partitioned(spark, path, "doc_id bigint, n_chars bigint, updated_date date")
    return rows.filter(F.col("updated_date") >= F.lit("2024-01-03").cast("date")).select(
        "doc_id", "n_chars", F.col("updated_date").cast("string").alias("updated_date")
    )


@query("file_range", "select doc_id, n_chars from documents where doc_id % 8 in (2, 3, 4)")
def file_range(spark, sf_dir):
    """Files 2 to 4 of eight, by name."""
    path = scratch_path(spark, "parts")
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", (F.col("doc_id") % 8).alias("part"))
    documents.repartition("part").write.partitionBy("part").parquet(path)
    chosen = readers.file_range(spark, path, 2, 5, "*.parquet")
    return spark.read.schema("doc_id bigint, n_chars bigint").parquet(*chosen)


@query(
    "infer_register",
    """select 'raw_notes' as table_name, count(*) as n, 'doc_id,quality' as columns from labels
    union all select 'raw_works', count(*), 'doc_id,lang,n_chars' from documents""",
)
def infer_register(spark, sf_dir):
    """Two folders with a manifest among the data become two tables."""
    base, database = scratch_path(spark, "feeds"), f"papyrine_{uuid.uuid4().hex[:12]}"
    frames = {
        "works": table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"),
        "notes": table(spark, sf_dir, "labels").select("doc_id", "quality"),
    }
    for name, frame in frames.items():
        frame.write.json(f"{base}/{name}", compression="gzip")
        manifest = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}/manifest")
        manifest.getFileSystem(spark._jsc.hadoopConfiguration()).create(manifest).close()
    names = tables.register_inferred(
        spark, [f"{base}/{n}" for n in frames], database, "raw_", location=scratch_path(spark, "database")
    )
    report = None
    for name in names:
        frame = spark.table(name)
        row = frame.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name.split(".")[1]).alias("table_name"), "n", F.lit(",".join(sorted(frame.columns))).alias("columns")
        )
        report = row if report is None else report.unionByName(row)
    return report


@query(
    "overwrite_modes",
    """select 1 as step, 'created' as outcome, count(*) as n from customer
    union all select 2, 'ignored', count(*) from customer union all select 3, 'refused', count(*) from customer
    union all select 4, 'overwritten', count(*) from customer where c_acctbal > 0
    union all select 5, 'unknown', count(*) from customer where c_acctbal > 0""",
)
def overwrite_modes(spark, sf_dir):
    """What each strategy does to a table that is there, and the rows it has afterwards."""
    customers = table(spark, sf_dir, "customer")
    some = customers.filter(F.col("c_acctbal") > 0)
    database, location = f"papyrine_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    steps = [("fail", customers), ("ignore", some), ("fail", some), ("overwrite", some), ("replace", customers)]
    done = []
    for number, (strategy, frame) in enumerate(steps, 1):
        try:
            outcome = tables.create_table(frame, database, "customers", strategy, location)
        except ValueError as error:
            outcome = "unknown" if "unknown" in str(error) else "refused"
        done.append((number, outcome, spark.table(f"{database}.customers").count()))
    return spark.createDataFrame(done, "step bigint, outcome string, n bigint")


@query(
    "drop_tables",
    """select 'customers' as table_name, 1 as existed, 0 as exists_now, count(*) as n from customer
    union all select 'nations', 1, 0, count(*) from nation union all select 'never_made', 0, 0, 0""",
)
def drop_tables(spark, sf_dir):
    database, location = f"papyrine_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    rows = {}
    for name, source in (("customers", "customer"), ("nations", "nation")):
        tables.create_table(table(spark, sf_dir, source), database, name, location=location)
        rows[name] = spark.table(f"{database}.{name}").count()
    names = [*rows, "never_made"]
    before = {n: int(spark.catalog.tableExists(f"{database}.{n}")) for n in names}
    tables.drop_tables(spark, [f"{database}.{n}" for n in names])
    after = {n: int(spark.catalog.tableExists(f"{database}.{n}")) for n in names}
    report = [(n, before[n], after[n], rows.get(n, 0)) for n in names]
    return spark.createDataFrame(report, "table_name string, existed bigint, exists_now bigint, n bigint")


@query(
    "table_preview",
    "select 'orders' as table_name, 3 as previewed, count(*) as n from orders union all select 'parts', 3, count(*) from part",
)
def table_preview(spark, sf_dir):
    """Preview and row count of stored tables, one of them bucketed and sorted."""
    database, location = f"papyrine_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    tables.create_table(
        table(spark, sf_dir, "orders"), database, "orders", location=location,
        bucket_by=(8, "o_custkey"), sort_by=["o_custkey", "o_orderkey"],
    )
    tables.create_table(table(spark, sf_dir, "part"), database, "parts", location=location, sort_by=["p_partkey"])
    report = []
    for name in ("orders", "parts"):
        head, rows = tables.describe_table(spark, f"{database}.{name}")
        report.append((name, head.count(), rows))
    return spark.createDataFrame(report, "table_name string, previewed bigint, n bigint")


@query(
    "bucketed_join",
    """select o_custkey, c_name, count(*) as n_orders, round(sum(o_totalprice), 2) as total
    from orders join customer on o_custkey = c_custkey group by o_custkey, c_name""",
)
def bucketed_join(spark, sf_dir):
    """Two tables stored in buckets of the join key: joined and grouped without moving rows."""
    database, location = f"papyrine_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    for name, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        tables.create_table(table(spark, sf_dir, name), database, name, location=location, bucket_by=(8, key), sort_by=[key])
    orders, customers = (spark.table(f"{database}.{n}") for n in ("orders", "customer"))
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("o_custkey", "c_name")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


def _labelled(spark, sf_dir):
    topics, subfields = _indices(spark, sf_dir)
    works = view(spark, sf_dir, "a_classes").select(
        "id",
        "topic",
        "subfield",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.nullif(F.split_part("text", F.lit("\n"), F.lit(2)), F.lit("")).alias("abstract"),
        F.col("text").alias("fulltext"),
    )
    indexed = labels.attach_labels(works, topics, {"topic": "topic"}, {"topic_index": "topic_index"})
    return labels.attach_labels(indexed, subfields, {"subfield": "subfield"}, {"subfield_index": "subfield_index"})


LABELLED_SQL = f"""{with_views("a_classes")}, {TOPIC_INDEX}, labelled as (select a.id, a.topic, t.topic_index, s.subfield_index,
    split_part(a.text, chr(10), 1) as title, nullif(split_part(a.text, chr(10), 2), '') as abstract, a.text as fulltext
  from a_classes a left join topics t on a.topic = t.topic left join subfields s on a.subfield = s.subfield)"""
TEXTS = ["title", "abstract", "fulltext"]
LABELS = {"subfield": "subfield_index", "topic": "topic_index"}


def _register_pair(name: str, text: str, label: str) -> None:
    @query(
        f"text_label_config_{name}",
        f"{LABELLED_SQL} select id, {text}, {label} from labelled where {text} is not null and {label} is not null",
    )
    def pair(spark, sf_dir):
        return tables.text_label_pairs(_labelled(spark, sf_dir), text, label, ["id"])


for _name, (_text, _label) in tables.pair_configs(TEXTS, LABELS).items():
    _register_pair(_name, _text, _label)


@query(
    "export_layout",
    f"""{LABELLED_SQL}, tagged as (select *, case ntile(10) over (partition by topic order by md5(concat('42:', id)), id)
        when 1 then 'test' when 2 then 'validation' else 'train' end as subset from labelled)
    """
    + " union all ".join(
        f"select '{n}' as config, subset, count(*) as n from tagged where {t} is not null and {l} is not null group by subset"
        for n, (t, l) in tables.pair_configs(TEXTS, LABELS).items()
    )
    + " union all select 'data', subset, count(*) from tagged group by subset",
)
def export_layout(spark, sf_dir):
    """All pair configurations and the full splits as files, counted from the files."""
    path = scratch_path(spark, "export")
    split = store(sampling.stratified_split(_labelled(spark, sf_dir), "topic", "id"), "split")
    tables.write_splits(split, f"{path}/data")
    configs = tables.export_pairs(split, TEXTS, LABELS, path)
    report = None
    for config in [*configs, "data"]:
        counts = spark.read.parquet(f"{path}/{config}").groupBy("subset").agg(F.count(F.lit(1)).alias("n"))
        part = counts.select(F.lit(config).alias("config"), "subset", "n")
        report = part if report is None else report.unionByName(part)
    return report


@query(
    "split_tables",
    f"with {SPLIT} select concat('documents_', subset) as table_name, doc_id, source, subset from split",
)
def split_tables(spark, sf_dir):
    """Each split as its own table, read back."""
    database, location = f"papyrine_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    split, report = stage(_split(spark, sf_dir).select("doc_id", "source", "subset")), None
    for subset in ("train", "test", "validation"):
        tables.create_table(tables.split_table(split, subset), database, f"documents_{subset}", location=location)
        part = spark.table(f"{database}.documents_{subset}").select(F.lit(f"documents_{subset}").alias("table_name"), "*")
        report = part if report is None else report.unionByName(part)
    return report


@query(
    "content_attach",
    f"""{with_views("a_works")} select id_semanticscholar, id_doi, publication_year, title, content_abstract, content_text
    from a_works where title is not null and content_abstract is not null and content_text is not null""",
)
def content_attach(spark, sf_dir):
    works = view(spark, sf_dir, "a_works")
    metadata = works.select("id_semanticscholar", "id_doi", "publication_year")
    content = works.select("id_semanticscholar", "title", "content_abstract", "content_text")
    return models.stg_unified_works_filtered(metadata, content)


OLD_FIELDS = [f"content_annotations_{a}" for a in models.OLD_ANNOTATIONS if a != "title"]


@query(
    "older_feed_structured",
    f"""select doc_id as corpusid, substr(text, 2, greatest(length(split_part(text, chr(10), 1)) - 1, 0)) as content_title,
      text as content_text, concat('https://example.org/', doc_id, '.pdf') as content_source_pdfurls,
      md5(cast(doc_id as varchar)) as content_source_pdfsha, case when doc_id % 2 = 0 then 'CCBY' end as content_source_oainfo_license,
      concat('https://example.org/', doc_id) as content_source_oainfo_openaccessurl, 'GOLD' as content_source_oainfo_status,
      {", ".join(f"concat('{f[20:]} ', doc_id) as {f}" for f in OLD_FIELDS)},
      concat('[{{"start":"2","end":', length(split_part(text, chr(10), 1)), '}}]') as content_annotations_title,
      {", ".join(f"case when doc_id % 3 = 0 then concat('{i}:', doc_id) end as externalids_{i}" for i in models.OLD_IDS)}
    from documents""",
)
def older_feed_structured(spark, sf_dir):
    """Nested records of the older feed, flattened; the title is cut out of the text."""
    number = F.col("doc_id").cast("string")
    first_line = F.length(F.split_part("text", F.lit("\n"), F.lit(1)))
    title = F.concat(F.lit('[{"start":"2","end":'), first_line.cast("string"), F.lit("}]"))
    address = F.concat(F.lit("https://example.org/"), number)
    raw = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("corpusid"),
        F.struct(
            "text",
            F.struct(
                F.concat(address, F.lit(".pdf")).alias("pdfurls"),
                F.md5(number.cast("binary")).alias("pdfsha"),
                F.struct(
                    F.when(F.col("doc_id") % 2 == 0, "CCBY").alias("license"),
                    address.alias("openaccessurl"),
                    F.lit("GOLD").alias("status"),
                ).alias("oainfo"),
            ).alias("source"),
            F.struct(
                *[
                    (title if a == "title" else F.concat(F.lit(f"{a} "), number)).alias(a)
                    for a in models.OLD_ANNOTATIONS
                ]
            ).alias("annotations"),
        ).alias("content"),
        F.struct(
            *[F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(f"{i}:"), number)).alias(i) for i in models.OLD_IDS]
        ).alias("externalids"),
    )
    return models.s2orc_structured(raw)


@query(
    "json_scalar_extract",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, json_extract_string(props, '$.k') as k_text,
      json_extract_string(props, '$.a.b') as missing, cast(json_extract_string(props, '$.k') as varchar) as k_nested from events""",
)
def json_scalar_extract(spark, sf_dir):
    """Typed field, path, missing path, and a path into a struct written as JSON."""
    events = table(spark, sf_dir, "events").withColumn("typed", F.from_json("props", "k bigint"))
    wrapped = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("typed").alias("props")))
    return events.select(
        "event_id",
        F.col("typed.k").alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.get_json_object("props", "$.a.b").alias("missing"),
        F.get_json_object(wrapped, "$.props.k").alias("k_nested"),
    )


@query("value_frequency", "select event_type as value, count(*) as c from events group by event_type")
def value_frequency(spark, sf_dir):
    return reports.value_frequency(table(spark, sf_dir, "events"), F.col("event_type"))


@query(
    "line_frequency",
    """select replace(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), chr(9), chr(10)) as value, count(*) as c
    from (select unnest(string_split(text, chr(10))) as line from documents) group by 1""",
)
def line_frequency(spark, sf_dir):
    """Text files, line by line: cleaned and counted."""
    path = scratch_path(spark, "keys")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return reports.value_frequency(readers.read_lines(spark, path), clean_line(F.col("value")))


@query(
    "substring_search",
    "select doc_id, n_chars from documents where contains(text, 'the') and contains(text, 'ing') and contains(text, 'on')",
)
def substring_search(spark, sf_dir):
    found = reduction.lines_with_all(table(spark, sf_dir, "documents"), ["the", "ing", "on"], "text")
    return found.select("doc_id", "n_chars")


@query(
    "stored_spans_sorted",
    """select count(*) as n, 0 as out_of_order from (select unnest(string_split(text, chr(10))) from documents
      where doc_id % 11 <> 0)""",
)
def stored_spans_sorted(spark, sf_dir):
    """Spans stored in buckets of the work and sorted by start: no row precedes a smaller start of its work."""
    database, location = f"papyrine_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    spans = annotation_spans(
        annotated_documents(spark, sf_dir), "doc_id", "annotations_section_header", "annotations_paragraph"
    )
    tables.create_table(
        spans, database, "spans", location=location, bucket_by=(8, "work_id"), sort_by=["work_id", "section_start"]
    )
    as_stored = Window.partitionBy("work_id").orderBy("file_path", "row_index")
    rows = spark.table(f"{database}.spans").select(
        "work_id", "section_start", F.col("_metadata.file_path"), F.col("_metadata.row_index")
    )
    earlier = F.lag("section_start").over(as_stored)
    backwards = F.when(F.col("section_start") < F.col("earlier"), 1).otherwise(0)
    return rows.withColumn("earlier", earlier).agg(
        F.count(F.lit(1)).alias("n"), F.sum(backwards).alias("out_of_order")
    )
