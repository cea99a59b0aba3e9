"""Measures of predictions, and a text classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators import evaluation, mining, sampling
from papyrine.operators.labels import attach_labels
from papyrine.plans.classes import reindex
from papyrine.plans.registry import query, table
from papyrine.plans.texts import STOP_SQL, STOP_WORDS, TOKENS_SQL
from papyrine.session import stage, store


def _measures_sql(predictions: str) -> str:
    return f"""with pr as ({predictions}), s as (select count(*)::double as s, sum(case when t = p then 1 else 0 end)::double as c from pr),
    k as (select k, sum(t)::double as t, sum(p)::double as p from (select t as k, 1 as t, 0 as p from pr
      union all select p, 0, 1 from pr) group by k),
    m as (select sum(t * p) as tp, sum(t * t) as tt, sum(p * p) as pp from k)
    select cast(s as bigint) as rows, round(c / s, 6) as accuracy, round(c / s, 6) as precision, round(c / s, 6) as recall,
      round(c / s, 6) as f1, round(case when (s * s - pp) * (s * s - tt) = 0 then 0
        else (c * s - tp) / sqrt((s * s - pp) * (s * s - tt)) end, 6) as matthews_correlation from s, m"""


def _rounded(frame):
    return frame.withColumns({c: F.round(c, 6) for c in frame.columns if c != "rows"})


BINARY = """select l.doc_id, l.quality as t, case when d.n_chars > 1000 then 1 else 0 end as p
  from labels l join documents d on l.doc_id = d.doc_id"""


def _binary(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    labelled = table(spark, sf_dir, "labels").select("doc_id", "quality").join(documents, "doc_id")
    long = F.when(F.col("n_chars") > 1000, 0.7).otherwise(0.2)
    return labelled.withColumn("scores", F.array(1 - long, long)).select(
        "doc_id", "text", F.col("quality").alias("label"), evaluation.argmax(F.col("scores")).alias("pred")
    )


@query("classification_metrics", _measures_sql(BINARY))
def classification_metrics(spark, sf_dir):
    return _rounded(evaluation.classification_metrics(_binary(spark, sf_dir), "label", "pred"))


@query(
    "classification_metrics_multiclass",
    _measures_sql("select doc_id % 5 as t, (doc_id + case when doc_id % 3 = 0 then 1 else 0 end) % 5 as p from documents"),
)
def classification_metrics_multiclass(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    shifted = F.col("doc_id") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)
    predictions = documents.select((F.col("doc_id") % 5).alias("label"), (shifted % 5).alias("pred"))
    return _rounded(evaluation.classification_metrics(predictions, "label", "pred"))


@query(
    "prediction_listing",
    f"""with pr as ({BINARY}), names as (select quality as index, concat('quality ', quality) as name
      from (select distinct quality from labels))
    select pr.doc_id, split_part(d.text, chr(10), 1)[1:100] as text_start, cast(pr.t as bigint) as label, a.name as label_name,
      cast(pr.p as bigint) as pred, b.name as pred_name
    from pr join documents d on pr.doc_id = d.doc_id left join names a on pr.t = a.index left join names b on pr.p = b.index
    order by pr.doc_id limit 100""",
)
def prediction_listing(spark, sf_dir):
    names = table(spark, sf_dir, "labels").select(F.col("quality").alias("index")).distinct()
    names = stage(names.withColumn("display_name", F.concat(F.lit("quality "), F.col("index").cast("string"))))
    return evaluation.prediction_listing(_binary(spark, sf_dir), names, "doc_id", "text", "label", "pred")


TEXTS = {"title": "split_part(text, chr(10), 1)", "fulltext": "text"}
GRID = [("fulltext", "lang", 10), ("fulltext", "lang", 100), ("title", "lang", 100), ("title", "source", 100), ("fulltext", "source", 100)]


def _bayes_sql(name: str, label: str, percent: int) -> str:
    """One row of the grid: naive Bayes from counts, on the seeded stratified split."""
    predictions = f"""select t, p from (select distinct on (b.doc_id) b.label as t, b.k as p
      from best b order by b.doc_id, b.score desc, b.k)"""
    return f"""(with tiles as (select doc_id, {TEXTS[name]} as text, {label} as label,
        ntile(10) over (partition by {label} order by md5(concat('42:', doc_id))) as tile from documents where {label} is not null),
      ordered as (select *, case when tile = 1 then 'test' when tile = 2 then 'validation' else 'train' end as subset from tiles),
      heads as (select *, row_number() over (partition by subset order by doc_id) as r, count(*) over (partition by subset) as n
        from ordered),
      part as (select * from heads where r <= round_even(n * {percent / 100}, 0)),
      w as (select doc_id, label, subset, unnest(list_filter({TOKENS_SQL}, lambda w: w not in {STOP_SQL})) as term from part),
      counts as (select label, term, count(*) as c from w where subset = 'train' group by all),
      v as (select count(distinct term) as v from counts),
      classes as (select label as k, ln(count(*)::double / sum(count(*)) over ()) as base,
        ln(coalesce((select sum(c) from counts c where c.label = p.label), 0) + (select greatest(v, 1) from v)) as norm
        from part p where subset = 'train' group by label),
      tf as (select doc_id, term, count(*) as tf from w where subset = 'test' and term in (select term from counts) group by all),
      sums as (select doc_id, label as k, sum(tf * ln(c + 1.0)) as s from tf join counts using (term) group by all),
      known as (select doc_id, sum(tf) as tokens from tf group by all),
      best as (select p.doc_id, p.label, k.k, round(base + coalesce(s, 0) - coalesce(tokens, 0) * norm, 9) as score
        from part p join classes k on true left join sums s on s.doc_id = p.doc_id and s.k = k.k left join known on known.doc_id = p.doc_id
        where p.subset = 'test')
      select '{name}' as input, '{label}' as label, {percent} as sample_percent, * from ({_measures_sql(predictions)}))"""


@query("text_classifier", " union all ".join(_bayes_sql(*row) for row in GRID))
def text_classifier(spark, sf_dir):
    """Language and source of a document from its first line or its text, on the whole splits and on a tenth of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    inputs = {"title": F.split_part("text", F.lit("\n"), F.lit(1)), "fulltext": F.col("text")}
    report, splits = None, {}
    for name, label, percent in GRID:
        if label not in splits:
            splits[label] = store(sampling.stratified_split(documents.filter(F.col(label).isNotNull()), label, "doc_id"), "split")
        terms = mining.word_candidates(inputs[name], STOP_WORDS)
        row = _rounded(evaluation.evaluate_counts(splits[label], "doc_id", terms, label, percent))
        row = row.select(F.lit(name).alias("input"), F.lit(label).alias("label"), F.lit(percent).alias("sample_percent"), "*")
        report = row if report is None else report.unionByName(row)
    return report


@query("text_classifier_library")
def text_classifier_library(spark, sf_dir):
    """Language of a document from its text, on all training rows and on a tenth of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    indexed = attach_labels(documents, reindex(documents, "lang"), {"lang": "lang"}, {"lang_index": "lang_index"})
    split = store(sampling.stratified_split(indexed, "lang", "doc_id"), "split")
    report = None
    for percent in (10, 100):
        row = evaluation.evaluate_classifier(split, "doc_id", "text", "lang_index", percent)
        row = _rounded(row).select(F.lit(percent).alias("sample_percent"), "*")
        report = row if report is None else report.unionByName(row)
    return report
