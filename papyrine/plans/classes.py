"""Splits, label indices, class caps and balance reports over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.operators import labels, sampling
from papyrine.operators.ranking import total_order_index
from papyrine.plans.analogues import view, with_views
from papyrine.plans.registry import query, table
from papyrine.session import stage

SUBSET = "case bucket_10p when 1 then 'test' when 2 then 'validation' else 'train' end"
SPLIT = f"""split as (select *, {SUBSET} as subset from (
  select doc_id, source, lang, n_chars,
    ntile(10) over (partition by source order by md5(concat('42:', doc_id)), doc_id) as bucket_10p
  from documents))"""

SUBFIELD_CAP, TOPIC_CAP, TOPIC_MIN = 400, 70, 8

CAPPED = f"""ranked as (select *,
    row_number() over (partition by subfield order by md5(concat('42/subfield:', id)), id) as sub_rank,
    row_number() over (partition by topic order by md5(concat('42/topic:', id)), id) as topic_rank
  from a_classes),
sampled as (select * from ranked where sub_rank < {SUBFIELD_CAP} and topic_rank < {TOPIC_CAP}),
kept as (select * from (select id, topic, subfield, n_chars, count(*) over (partition by topic) as new_topic_count
  from sampled) where new_topic_count > {TOPIC_MIN})"""


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return sampling.stratified_split(documents, "source", "doc_id")


def _classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "a_classes").select("id", "topic", "subfield", "n_chars")


def _capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.cap_classes(
        _classes(spark, sf_dir),
        {"subfield": SUBFIELD_CAP, "topic": TOPIC_CAP},
        "id",
        min_count=TOPIC_MIN,
        min_col="topic",
    )


@query("split_stratified", f"with {SPLIT} select doc_id, source, n_chars, bucket_10p, subset from split")
def split_stratified(spark, sf_dir):
    return _split(spark, sf_dir).select("doc_id", "source", "n_chars", "bucket_10p", "subset")


@query(
    "split_null_ids",
    f"""with ids as (select lang, case when doc_id % 10 <> 3 then doc_id end as id from documents),
    split as (select *, ntile(10) over (partition by lang order by coalesce(md5('42:' || id), ''), id) as bucket_10p from ids)
    select lang, bucket_10p, {SUBSET} as subset, count(*) as n, count(id) as n_ids, sum(id)::bigint as id_sum
    from split group by all""",
)
def split_null_ids(spark, sf_dir):
    """Rows without an id are ranked like any other, first in their class."""
    known = F.when(F.col("doc_id") % 10 != 3, F.col("doc_id")).alias("id")
    split = sampling.stratified_split(table(spark, sf_dir, "documents").select("lang", known), "lang", "id")
    counts = [F.count(F.lit(1)).alias("n"), F.count("id").alias("n_ids"), F.sum("id").alias("id_sum")]
    return split.groupBy("lang", "bucket_10p", "subset").agg(*counts)


@query(
    "cap_repeated_ids",
    """with ranked as (select l_returnflag, l_orderkey, l_linenumber,
      row_number() over (partition by l_returnflag
        order by md5('42/l_returnflag:' || l_orderkey), l_orderkey, l_linenumber) as r
    from lineitem)
    select l_returnflag, l_orderkey, l_linenumber, count(*) as n from ranked where r < 1000 group by all""",
)
def cap_repeated_ids(spark, sf_dir):
    """An order has many lines: a cap counts rows, not ids."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    kept = sampling.cap_classes(lines, {"l_returnflag": 1000}, "l_orderkey", ties=["l_linenumber"])
    return kept.groupBy("l_returnflag", "l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_class_shares",
    f"""with {SPLIT} select source, subset, count(*) as number_of_papers,
    round(count(*) * 100.0 / (select count(*) from documents), 2) as percent_of_papers
    from split group by source, subset""",
)
def split_class_shares(spark, sf_dir):
    """The flagship: repeatable stratified split, then its distribution."""
    return labels.class_distribution(_split(spark, sf_dir), ["source", "subset"], table(spark, sf_dir, "documents"))


@query(
    "split_shares",
    f"with {SPLIT} select subset, count(*) as c, round(count(*) * 100.0 / (select count(*) from split), 6) as p "
    "from split group by subset",
)
def split_shares(spark, sf_dir):
    split = stage(_split(spark, sf_dir).select("subset"))
    parts = [split.filter(F.col("subset") == s) for s in ("train", "test", "validation")]
    report = labels.split_shares(parts, table(spark, sf_dir, "documents"))
    return report.withColumn("p", F.round("p", 6))


@query(
    "class_distribution",
    """select source, lang, count(*) as number_of_papers,
    round(count(*) * 100.0 / (select count(*) from documents), 2) as percent_of_papers
    from documents group by source, lang""",
)
def class_distribution(spark, sf_dir):
    return labels.class_distribution(table(spark, sf_dir, "documents"), ["source", "lang"])


@query(
    "dataset_size",
    """select count(*) as number_of_papers, count(distinct lang) as number_of_subfields,
    count(distinct source) as number_of_topics from documents""",
)
def dataset_size(spark, sf_dir):
    return labels.dataset_size(
        table(spark, sf_dir, "documents"), {"number_of_subfields": "lang", "number_of_topics": "source"}
    )


TOPIC_INDEX = """topic_counts as (select topic, subfield, count(*) as topic_count from a_classes group by topic, subfield),
topics as (select row_number() over (order by topic_count desc, topic, subfield) - 1 as topic_index, topic, subfield,
    topic_count, topic_count * 100.0 / (select count(*) from a_classes) as topic_percent from topic_counts),
sub_counts as (select subfield, cast(sum(topic_count) as bigint) as subfield_count from topic_counts group by subfield),
subfields as (select row_number() over (order by subfield_count desc, subfield) - 1 as subfield_index, subfield,
    subfield_count, subfield_count * 100.0 / (select count(*) from a_classes) as subfield_percent from sub_counts)"""


def _indices(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    counts = _classes(spark, sf_dir).groupBy("topic", "subfield").agg(F.count(F.lit(1)).alias("topic_count"))
    topics = stage(labels.class_index(counts, ["topic", "subfield"], "topic_count", "topic_index"))
    rolled = topics.groupBy("subfield").agg(F.sum("topic_count").alias("subfield_count"))
    subfields = labels.class_index(rolled, ["subfield"], "subfield_count", "subfield_index")
    return topics, stage(subfields)


@query(
    "label_index",
    f"""{with_views("a_classes")}, {TOPIC_INDEX}
    select 'topic' as level, topic_index as label_index, topic as label, topic_count as rows_in_class,
      round(topic_percent, 6) as percent_of_rows from topics
    union all
    select 'subfield', subfield_index, subfield, subfield_count, round(subfield_percent, 6) from subfields""",
)
def label_index(spark, sf_dir):
    topics, subfields = _indices(spark, sf_dir)

    def rows(level, frame, name):
        return labels.with_percent(frame, f"{name}_count", "share").select(
            F.lit(level).alias("level"),
            F.col(f"{name}_index").alias("label_index"),
            F.col(name).alias("label"),
            F.col(f"{name}_count").alias("rows_in_class"),
            F.round("share", 6).alias("percent_of_rows"),
        )

    return rows("topic", topics, "topic").unionByName(rows("subfield", subfields, "subfield"))


@query(
    "label_index_joined",
    f"""{with_views("a_classes")}, {TOPIC_INDEX}
    select a.id, a.topic, a.subfield, t.topic_index, t.topic_count, s.subfield_index, s.subfield_count
    from a_classes a left join topics t on a.topic = t.topic left join subfields s on a.subfield = s.subfield""",
)
def label_index_joined(spark, sf_dir):
    topics, subfields = _indices(spark, sf_dir)
    works = _classes(spark, sf_dir).drop("n_chars")
    indexed = labels.attach_labels(
        works, topics, {"topic": "topic"}, {"topic_index": "topic_index", "topic_count": "topic_count"}
    )
    return labels.attach_labels(
        indexed,
        subfields,
        {"subfield": "subfield"},
        {"subfield_index": "subfield_index", "subfield_count": "subfield_count"},
    )


@query(
    "class_cap_two_level",
    f'{with_views("a_classes")}, {CAPPED} select id, topic, subfield, n_chars, new_topic_count from kept',
)
def class_cap_two_level(spark, sf_dir):
    return _capped(spark, sf_dir)


REINDEXED = f"""{CAPPED},
t as (select topic, row_number() over (order by count(*) desc, topic) - 1 as topic_index from kept group by topic),
s as (select subfield, row_number() over (order by count(*) desc, subfield) - 1 as subfield_index
  from kept group by subfield),
resplit as (select k.id, k.topic, k.subfield, k.new_topic_count, t.topic_index, s.subfield_index,
    ntile(10) over (partition by k.topic order by md5(concat('43:', k.id)), k.id) as bucket_10p
  from kept k left join t on k.topic = t.topic left join s on k.subfield = s.subfield)"""


def reindex(kept: DataFrame, name: str) -> DataFrame:
    """New 0-based index by descending count over what the cap left."""
    return stage(labels.class_index(sampling.class_counts(kept, name, "n"), [name], "n", f"{name}_index"))


@query(
    "class_reindex_resplit",
    f"""{with_views("a_classes")}, {REINDEXED}
    select *, {SUBSET} as subset from resplit""",
)
def class_reindex_resplit(spark, sf_dir):
    kept = stage(_capped(spark, sf_dir).drop("n_chars"))
    indexed = labels.attach_labels(kept, reindex(kept, "topic"), {"topic": "topic"}, {"topic_index": "topic_index"})
    indexed = labels.attach_labels(
        indexed, reindex(kept, "subfield"), {"subfield": "subfield"}, {"subfield_index": "subfield_index"}
    )
    return sampling.stratified_split(indexed, "topic", "id", seed=43)


def _balance_report(kept: DataFrame, denominator: DataFrame | None = None) -> DataFrame:
    """Summary, by subfield and by topic, stacked."""

    def by(name):
        return labels.class_distribution(kept, [name], denominator).select(
            F.lit(name).alias("level"), F.col(name).alias("label"), "number_of_papers", "percent_of_papers"
        )

    size = labels.dataset_size(kept, {"subfields": "subfield", "topics": "topic"})
    summary = size.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(label).alias("label"), F.col(column).alias("n"))
                    for label, column in (("papers", "number_of_papers"), ("subfields", "subfields"), ("topics", "topics"))
                ]
            )
        ).alias("r")
    ).select(
        F.lit("summary").alias("level"),
        F.col("r.label").alias("label"),
        F.col("r.n").alias("number_of_papers"),
        F.lit(None).cast("double").alias("percent_of_papers"),
    )
    return summary.unionByName(by("subfield")).unionByName(by("topic"))


def _balance_sql(ctes: str, kept: str, denominator: str) -> str:
    def by(name):
        return (
            f"select '{name}' as level, {name} as label, count(*) as number_of_papers, "
            f"round(count(*) * 100.0 / (select count(*) from {denominator}), 2) as percent_of_papers "
            f"from {kept} group by {name}"
        )

    return f"""{with_views("a_classes")}, {ctes}
    select 'summary' as level, 'papers' as label, count(*) as number_of_papers, cast(null as double) as percent_of_papers
    from {kept}
    union all select 'summary', 'subfields', count(distinct subfield), null from {kept}
    union all select 'summary', 'topics', count(distinct topic), null from {kept}
    union all {by("subfield")} union all {by("topic")}"""


MIN_THEN_CAP = f"""counted as (select *, count(*) over (partition by topic) as topic_count from a_classes),
s1 as (select * from (select *, row_number() over (partition by topic order by md5(concat('42/topic:', id)), id) as r
  from counted where topic_count > {TOPIC_MIN}) where r < {TOPIC_CAP})"""


@query("balance_scenario_min_then_cap", _balance_sql(MIN_THEN_CAP, "s1", "s1"))
def balance_scenario_min_then_cap(spark, sf_dir):
    large = sampling.attach_class_count(_classes(spark, sf_dir), "topic", "topic_count", more_than=TOPIC_MIN)
    return _balance_report(stage(sampling.cap_classes(large, {"topic": TOPIC_CAP}, "id")))


GROUP_CAP = f"""s2 as (select * from (select *, row_number() over (partition by subfield
  order by md5(concat('42/subfield:', id)), id) as r from a_classes) where r < {SUBFIELD_CAP})"""


@query("balance_scenario_group_cap", _balance_sql(GROUP_CAP, "s2", "s2"))
def balance_scenario_group_cap(spark, sf_dir):
    return _balance_report(stage(sampling.cap_classes(_classes(spark, sf_dir), {"subfield": SUBFIELD_CAP}, "id")))


@query("balance_scenario_both", _balance_sql(CAPPED, "kept", "sampled"))
def balance_scenario_both(spark, sf_dir):
    """Percentages are of the rows before small topics were dropped."""
    caps = {"subfield": SUBFIELD_CAP, "topic": TOPIC_CAP}
    sampled = stage(sampling.cap_classes(_classes(spark, sf_dir), caps, "id"))
    kept = sampling.attach_class_count(sampled, "topic", "new_topic_count", more_than=TOPIC_MIN)
    return _balance_report(kept, sampled)


@query(
    "balance_prototype_sample",
    f"""{with_views("a_classes")}, {CAPPED},
    t as (select topic, row_number() over (order by topic) - 1 as topic_index from kept group by topic),
    s as (select subfield, row_number() over (order by subfield) - 1 as subfield_index from kept group by subfield),
    tagged as (select a.id, a.topic, a.subfield, t.topic_index, s.subfield_index,
        ntile(10) over (partition by a.topic order by md5(concat('44:', a.id)), a.id) as bucket_10p
      from a_classes a left join t on a.topic = t.topic left join s on a.subfield = s.subfield)
    select *, {SUBSET} as subset from tagged order by md5(concat('45:', id)), id limit 100""",
)
def balance_prototype_sample(spark, sf_dir):
    """Indices by name over the capped set, joined to all works, split again, 100 random rows."""
    works = _classes(spark, sf_dir).drop("n_chars")
    kept = stage(_capped(spark, sf_dir).select("topic", "subfield"))
    indexed = works
    for name in ("topic", "subfield"):
        names = total_order_index(stage(kept.select(name).distinct()), [F.col(name).asc()], f"{name}_index")
        indexed = labels.attach_labels(indexed, names, {name: name}, {f"{name}_index": f"{name}_index"})
    return sampling.random_sample(sampling.stratified_split(indexed, "topic", "id", seed=44), "id", 100, seed=45)


@query(
    "random_sample_k",
    """select o_orderkey, o_custkey, o_totalprice from orders
    order by md5(concat('42:', o_orderkey)), o_orderkey limit 200""",
)
def random_sample_k(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.random_sample(orders, "o_orderkey", 200)


@query(
    "head_percent_slice",
    """select doc_id, text as input_text, source as label from (
      select *, row_number() over (order by doc_id) as r, count(*) over () as n from documents)
    where r <= round_even(n * 0.1, 0)""",
)
def head_percent_slice(spark, sf_dir):
    renamed = table(spark, sf_dir, "documents").select("doc_id", "text", "source").withColumnsRenamed(
        {"text": "input_text", "source": "label"}
    )
    return sampling.head_percent(renamed, "doc_id", 10)


@query(
    "head_percent_repeated_ids",
    """select k, count(*) as n from (select k, row_number() over (order by k nulls first) as r, count(*) over () as n
      from (select case when l_orderkey % 4 = 0 then null else l_orderkey // 50 end as k from lineitem))
    where r <= round_even(n * 0.37, 0) group by k""",
)
def head_percent_repeated_ids(spark, sf_dir):
    """Many rows share an id or have none: the cut takes the exact number of rows."""
    key = F.when(F.col("l_orderkey") % 4 != 0, F.floor(F.col("l_orderkey") / 50))
    rows = table(spark, sf_dir, "lineitem").select(key.alias("k"))
    return sampling.head_percent(rows, "k", 37).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("page_by_id", "select doc_id, text from documents order by doc_id limit 25 offset 100")
def page_by_id(spark, sf_dir):
    return sampling.page_by_id(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 100, 25)


@query("page_by_id_deep", "select l_orderkey, n from (select l_orderkey, count(*) as n from lineitem group by l_orderkey) "
       "order by l_orderkey limit 25 offset 700")
def page_by_id_deep(spark, sf_dir):
    """A page far into the table, found through the ids alone."""
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return sampling.page_by_id(orders, "l_orderkey", 700, 25)


DISTRIBUTION = """d as (select source, lang, count(*) as number_of_papers from documents group by source, lang)"""


@query(
    "head_tail",
    f"""with {DISTRIBUTION}
    select 'head' as part, * from (select * from d order by number_of_papers desc, source, lang limit 5)
    union all
    select 'tail', * from (select * from d order by number_of_papers, source desc, lang desc limit 5)""",
)
def head_tail(spark, sf_dir):
    counts = stage(table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("number_of_papers")))
    head = counts.orderBy(F.desc("number_of_papers"), "source", "lang").limit(5)
    tail = counts.orderBy("number_of_papers", F.desc("source"), F.desc("lang")).limit(5)
    return head.select(F.lit("head").alias("part"), "*").unionByName(tail.select(F.lit("tail").alias("part"), "*"))


@query(
    "multi_key_sort_limit",
    """select o_orderkey, o_orderpriority, o_orderstatus, o_totalprice from orders
    order by o_orderpriority, o_orderstatus desc, o_totalprice desc, o_orderkey limit 50""",
)
def multi_key_sort_limit(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
        .orderBy(
            F.asc_nulls_last("o_orderpriority"),
            F.desc_nulls_last("o_orderstatus"),
            F.desc_nulls_last("o_totalprice"),
            F.asc_nulls_last("o_orderkey"),
        )
        .limit(50)
    )
