"""Anchors, topic vectors, reduction and clusters over the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.operators import clustering, mining
from papyrine.plans.registry import query, table
from papyrine.session import stage


def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


ANCHORS_SQL = """anchors as (select vec_id as a_id, embedding as a_vec from (select *, row_number() over
    (partition by label order by vec_id) as r from embeddings) where r = 1)"""


@query(
    "nearest_anchor",
    f"""with {ANCHORS_SQL}, d as (select e.vec_id, e.label, a.a_id,
        list_distance(e.embedding::double[], a.a_vec::double[]) as distance from embeddings e, anchors a),
    best as (select *, row_number() over (partition by vec_id order by distance, a_id) as r from d),
    ranked as (select vec_id, label, a_id as anchor, round(distance, 6) as distance,
      row_number() over (partition by label order by round(distance, 6), vec_id) as rank from best where r = 1)
    select * from ranked where rank <= 5""",
)
def nearest_anchor(spark, sf_dir):
    """Anchors: the first vector of each label."""
    vectors = _embeddings(spark, sf_dir)
    anchors = stage(vectors.groupBy("label").agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("a")).select("a.*"))
    nearest = mining.nearest_anchor(vectors, anchors, "vec_id", "embedding").withColumn("distance", F.round("distance", 6))
    return mining.top_per_group(nearest, "label", [F.asc("distance"), F.asc("vec_id")], 5)


TOPICS_SQL = """elements as (select label, unnest(range(64)) as pos, unnest(embedding::double[]) as x from embeddings),
means as (select label, pos, avg(x) as x from elements group by label, pos)"""


@query("topic_vectors", f"with {TOPICS_SQL} select label, pos, round(x, 6) as x from means")
def topic_vectors(spark, sf_dir):
    topics = mining.topic_vectors(_embeddings(spark, sf_dir), "label", "embedding")
    return topics.select("label", F.posexplode("embedding").alias("pos", "x")).withColumn("x", F.round("x", 6))


@query(
    "topic_search",
    f"""with {TOPICS_SQL}, v as (select label, list(x order by pos) as x from means group by label),
    q as (select embedding::double[] as x from embeddings order by vec_id limit 1)
    select v.label, round(list_cosine_similarity(v.x, q.x), 6) as score from v, q
    order by score desc, v.label limit 10""",
)
def topic_search(spark, sf_dir):
    vectors = _embeddings(spark, sf_dir)
    asked = vectors.orderBy("vec_id").limit(1).select("embedding").scalar()
    topics = mining.topic_vectors(vectors, "label", "embedding")
    return mining.topic_search(topics, "label", "embedding", asked).withColumn("score", F.round("score", 6))


@query("pca_embeddings")
def pca_embeddings(spark, sf_dir):
    return clustering.reduce_dimensions(_embeddings(spark, sf_dir), "embedding", 5)


@query("density_clusters")
def density_clusters(spark, sf_dir):
    """Reduced to five dimensions first; neighbours lie within the first component's deviation."""
    reduced = stage(clustering.reduce_dimensions(_embeddings(spark, sf_dir), "embedding", 5))
    eps = reduced.agg(F.stddev("pc1")).first()[0]
    return clustering.density_clusters(reduced, "vec_id", [f"pc{i}" for i in range(1, 6)], eps)


EPS, MIN_POINTS, MIN_SIZE = 0.02, 5, 15


@query(
    "density_clusters_plane",
    f"""with recursive points as (select vec_id, embedding[1]::double as x, embedding[2]::double as y from embeddings),
    near as (select a.vec_id as a, b.vec_id as b, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) as d
      from points a join points b on b.x between a.x - 2 * {EPS} and a.x + 2 * {EPS}
      where (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}::double * {EPS}::double),
    cores as (select a as id from near group by a having count(*) >= {MIN_POINTS}),
    edges as (select a, b from near where a in (from cores) and b in (from cores)),
    reach as (select id, id as other from cores union select r.id, e.b from reach r join edges e on r.other = e.a),
    labels as (select id, min(other) as label from reach group by id),
    members as (
      select id, label from labels
      union all
      select a, arg_min(label, struct_pack(d, b)) from near join labels on b = labels.id
        where a not in (from cores) group by a),
    sizes as (select label, count(*) as size from members group by label having count(*) >= {MIN_SIZE}),
    numbered as (select label, row_number() over (order by size desc, label) - 1 as cluster from sizes)
    select p.vec_id, coalesce(n.cluster, -1) as cluster from points p left join members m on m.id = p.vec_id
      left join numbered n on m.label = n.label""",
)
def density_clusters_plane(spark, sf_dir):
    """Over the first two coordinates, which SQL can follow."""
    plane = _embeddings(spark, sf_dir).select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(2)]
    )
    return clustering.density_clusters(plane, "vec_id", ["x0", "x1"], EPS, MIN_SIZE, MIN_POINTS)
