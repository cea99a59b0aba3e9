import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from papyrine.operators import clustering, evaluation, mining, sizing


def test_ctfidf_by_hand(spark):
    rows = spark.createDataFrame([("x", "The cat cat dog"), ("x", "cat"), ("y", "dog bird a")], "c string, t string")
    scores = {(r.c, r.term): r for r in mining.ctfidf(rows, "c", "t", ["the"]).collect()}
    assert set(scores) == {("x", "cat"), ("x", "dog"), ("y", "dog"), ("y", "bird")}
    assert scores[("x", "cat")].tf == 3 / 4 and scores[("x", "cat")].idf == math.log(3 / 3)
    assert scores[("y", "dog")].score == pytest.approx(1 / 2 * math.log(3 / 2))
    top = mining.top_terms(mining.ctfidf(rows, "c", "t", ["the"]), "c", 1).collect()
    assert {r.c: r.term for r in top} == {"x": "dog", "y": "bird"}


def test_class_documents_add_up(spark):
    rows = spark.range(25).select("id", F.lit("c").alias("c"), F.col("id").cast("string").alias("t"))
    pieces = mining.class_documents(rows, "c", "id", "t", ids_per_piece=10).orderBy("piece").collect()
    assert [p.documents for p in pieces] == [10, 10, 5]
    assert " ".join(p.class_text for p in pieces) == " ".join(map(str, range(25)))


def test_chunks(spark):
    rows = spark.createDataFrame([("Deep neural networks of the brain, and a (big) data set",)], "t string")
    found = rows.select(mining.chunk_candidates(F.col("t"), ["of", "the", "and", "a"])).first()[0]
    assert found == ["deep neural networks", "brain", "big", "data set"]
    assert rows.select(mining.chunk_candidates(F.col("t"), ["of", "the", "and", "a"], 2)).first()[0] == ["brain", "big", "data set"]


def test_chunks_of_any_length(spark):
    rows = spark.createDataFrame([("the slow deep neural network training run of a brain",)], "t string")
    found = rows.select(mining.chunk_candidates(F.col("t"), ["of", "the", "a"])).first()[0]
    assert found == ["slow deep neural network training run", "brain"]


def test_keyphrases_share_one_count(spark, tmp_path):
    spark.range(50).select("id", F.concat(F.lit("ab cd"), "id").alias("t")).write.parquet(str(tmp_path / "d"))
    phrases = mining.keyphrases(spark.read.parquet(str(tmp_path / "d")), "id", mining.word_candidates(F.col("t"), []), 1)
    assert phrases.count() == 50
    assert phrases.filter("id = 7").first().phrase == "cd7"


def test_keyphrases_of_frequent_words_meet_a_broadcast(spark, tmp_path, monkeypatch):
    rows = [(None if i % 9 == 0 else i % 40, " ".join(["common", "word"] * (i % 4) + [f"rare{i}", f"some{i % 5}"])) for i in range(60)]
    spark.createDataFrame(rows, "id int, t string").write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = mining.word_candidates(F.col("t"), [])
        whole = mining.keyphrases(frame, "id", words, 3)
        assert "BroadcastHashJoin" in whole._jdf.queryExecution().executedPlan().toString()
        found = sorted(map(str, whole.collect()))
        for bound in (0, 1, 4):  # none, or only the most frequent, are broadcast
            monkeypatch.setattr(sizing, "BROADCAST_ROWS", bound)
            assert sorted(map(str, mining.keyphrases(frame, "id", words, 3).collect())) == found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_least_similar_tries_all(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 6))) for _ in range(9)]
    grams = [mining._trigrams(w) for w in words]

    def cost(choice):
        return sum(len(grams[a] & grams[b]) / len(grams[a] | grams[b]) for a, b in itertools.combinations(choice, 2))

    best = min(itertools.combinations(range(9), 4), key=lambda c: (round(cost(c), 12), c))
    assert mining.least_similar(words, 4) == list(best)
    assert mining.least_similar(words, 9) == list(range(9)) and len(mining.least_similar(words, 1)) == 1


def test_similarities_of_all_pairs_at_once(spark):
    words = ["deep net", "deep nets", "abc", "abc", "x", ""]
    grams = [mining._trigrams(w) for w in words]
    assert mining._similarities(words).tolist() == [[len(a & b) / len(a | b) for b in grams] for a in grams]
    choices, steps = mining._choices(20, 5)
    # A choice adds its last place to a shorter one: four pairs each at the last step, not ten.
    assert len(choices) == 15504 and [len(pairs) for _, pairs in steps] == [1, 2, 3, 4]


def test_diversify_returns_all_when_asked(spark):
    rows = spark.createDataFrame([(1, f"w{i}", 1.0 - i / 10, i + 1) for i in range(4)], "d int, phrase string, score double, rank int")
    assert mining.diversify(rows, "d", 5, 20).count() == 4
    assert mining.diversify(rows, "d", 2, 20).count() == 2


def test_anchors(spark):
    items = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], "i int, v array<double>")
    anchors = spark.createDataFrame([(10, [0.0, 1.0]), (11, [3.0, 0.0])], "i int, v array<double>")
    found = {r.i: (r.anchor, r.distance) for r in mining.nearest_anchor(items, anchors, "i", "v").collect()}
    assert found[1] == (10, 1.0) and found[2] == (11, 4.0)
    many = spark.range(40).selectExpr("cast(id + 100 as int) as i", "array(id + 50.0d, id * 2.0d) as v").unionByName(anchors)
    found = {r.i: (r.anchor, r.distance) for r in mining.nearest_anchor(items, many, "i", "v", block_anchors=3).collect()}
    assert found[1] == (10, 1.0) and found[2] == (11, 4.0)
    assert mining.nearest_anchor(items, anchors.limit(0), "i", "v").filter("anchor is null").count() == 2


def test_topics(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (0, [3.0, 0.0]), (1, [0.0, 5.0])], "k int, v array<float>")
    vectors = mining.topic_vectors(rows, "k", "v")
    assert {r.k: r.v for r in vectors.collect()} == {0: [2.0, 0.0], 1: [0.0, 5.0]}
    best = mining.topic_search(vectors, "k", "v", F.array(F.lit(0.1), F.lit(1.0)), 1).first()
    assert best.k == 1 and best.score == pytest.approx(1 / math.sqrt(1.01))


def brute_force(points, eps, min_points, min_size):
    """Clusters as sets of ids, by all distances."""
    def square(a, b):
        return sum((u - v) * (u - v) for u, v in zip(points[a], points[b], strict=True))

    near = {a: [b for b in points if square(a, b) <= eps * eps] for a in points}
    cores = {a for a in points if len(near[a]) >= min_points}
    label = {}
    for start in sorted(cores):
        todo = [start] if start not in label else []
        while todo:
            a = todo.pop()
            if a not in label:
                label[a] = start
                todo += [b for b in near[a] if b in cores]
    groups = {}
    for a in points:
        around = [(square(a, b), b) for b in near[a] if b in cores]
        if a in cores or around:
            groups.setdefault(label[a if a in cores else min(around)[1]], set()).add(a)
    return {frozenset(g) for g in groups.values() if len(g) >= min_size}


@pytest.mark.parametrize("dimensions", [1, 2, 3, 5])
def test_clusters_against_brute_force(spark, dimensions):
    rng = random.Random(dimensions)
    # A third of the points on one spot, a chain, two clouds with a stray point between them, and scattered ones.
    points = {i: tuple(0.5 for _ in range(dimensions)) for i in range(90)}
    points |= {100 + i: (5 + i * 0.3, *[4.0] * (dimensions - 1)) for i in range(30)}
    for k, centre in enumerate((-10, -6)):
        points |= {200 + 50 * k + i: tuple(rng.gauss(centre * (j == 0), 0.35) for j in range(dimensions)) for i in range(45)}
    points[299] = (-8.0, *[0.0] * (dimensions - 1))
    points |= {300 + i: tuple(rng.uniform(-12, 12) for _ in range(dimensions)) for i in range(50)}
    axes = [f"x{i}" for i in range(dimensions)]
    rows = [(i, *p) for i, p in points.items()] + [(900, *[None] * dimensions), (901, *[float("nan")] * dimensions)]
    frame = spark.createDataFrame(rows, ", ".join(["id int", *[f"{a} double" for a in axes]]))
    found = clustering.density_clusters(frame, "id", axes, 1.0, 12, 6).collect()
    groups, noise = {}, set()
    for r in found:
        (noise.add(r.id) if r.cluster == -1 else groups.setdefault(r.cluster, set()).add(r.id))
    expected = brute_force(points, 1.0, 6, 12)
    assert {frozenset(g) for g in groups.values()} == expected and len(expected) >= 2
    assert noise == (set(points) | {900, 901}) - set().union(*expected)
    assert sorted(groups) == list(range(len(expected)))
    sizes = [len(groups[k]) for k in sorted(groups)]
    assert sizes == sorted(sizes, reverse=True)


def test_dense_neighbourhoods_are_not_paired(spark, monkeypatch):
    """Where cells of few points lie side by side, no step holds more than a few rows a point."""
    rng = random.Random(8)
    side = 1 / math.sqrt(3)
    frame = spark.createDataFrame([(i, *[rng.uniform(0, 6 * side) for _ in range(3)]) for i in range(760)], "id int, x double, y double, z double")
    held, stage = [], clustering.stage
    monkeypatch.setattr(clustering, "stage", lambda df: (out := stage(df), held.append(out.count()))[0])
    found = clustering.density_clusters(frame, "id", ["x", "y", "z"], 1.0, 15, 5).collect()
    assert {r.cluster for r in found} == {0}
    assert max(held) <= 10 * 760


def clustered(spark, points, eps, min_size, min_points):
    """Sets of ids by cluster number."""
    axes = [f"x{i}" for i in range(len(next(iter(points.values()))))]
    frame = spark.createDataFrame([(i, *p) for i, p in points.items()], ", ".join(["id int", *[f"{a} double" for a in axes]]))
    groups = {}
    for r in clustering.density_clusters(frame, "id", axes, eps, min_size, min_points).collect():
        groups.setdefault(r.cluster, set()).add(r.id)
    groups.pop(-1, None)
    return groups


@pytest.mark.parametrize("dimensions", [2, 5])
def test_crowded_cells_are_cut(spark, monkeypatch, dimensions):
    """Cells of many points that boxes do not decide: beside stray points, and in clusters a little nearer or farther than eps."""
    monkeypatch.setattr(clustering, "LOOK", 3)
    rng = random.Random(dimensions)
    rest = dimensions - 1
    points, ids = {}, itertools.count()
    # Walls of points; the second is 0.99, the third 1.01 from the one before.
    for at in (0.0, 1.19, 2.4):
        points |= {next(ids): (at + rng.choice((0, 0.2, rng.uniform(0, 0.2))), *[rng.uniform(0, 0.5) for _ in range(rest)]) for _ in range(60)}
        points |= {next(ids): (at + x, *[0.25] * rest) for x in (0, 0.2)}
    points |= {next(ids): (rng.uniform(3.2, 3.8), *[rng.uniform(-0.5, 1) for _ in range(rest)]) for _ in range(12)}
    points |= {next(ids): (rng.uniform(-1.2, -0.7), *[rng.uniform(-0.5, 1) for _ in range(rest)]) for _ in range(12)}
    expected = brute_force(points, 1.0, 6, 12)
    assert len(expected) == 2
    assert {frozenset(g) for g in clustered(spark, points, 1.0, 12, 6).values()} == expected


def test_clusters_take_few_jobs(spark):
    """Points at all distances, down to a millionth of a side: levels and rounds of them took over 200 jobs on a few hundred rows."""
    rng = random.Random(4)
    points = {i: (rng.gauss(0, 0.12), rng.gauss(0, 0.12)) for i in range(500)}
    points |= {500 + i: (points[i][0] + 0.02 + rng.uniform(-1e-6, 1e-6), points[i][1]) for i in range(100)}
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    groups = clustered(spark, points, 0.02, 15, 5)
    assert jobs() - before < 150
    assert {frozenset(g) for g in groups.values()} == brute_force(points, 0.02, 5, 15)


def test_components_in_rounds(spark, monkeypatch):
    """The same whether the edges fit the driver or not."""
    rng = random.Random(6)
    nodes = spark.createDataFrame([(i,) for i in range(60)], "node long")
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "src long, dst long")
    once = sorted(clustering.connected_components(nodes, edges).collect())
    monkeypatch.setattr(clustering, "DRIVER_EDGES", 0)
    assert sorted(clustering.connected_components(nodes, edges).collect()) == once
    assert len({r.label for r in once}) > 3 and all(r.label <= r.node for r in once)


def test_components(spark):
    nodes = spark.createDataFrame([(f"{i:02}",) for i in range(20)], "node string")
    chain = [(f"{i:02}", f"{i + 1:02}") for i in range(14)] + [("17", "18")]
    edges = spark.createDataFrame(chain + [(b, a) for a, b in chain], "src string, dst string")
    labels = {r.node: r.label for r in clustering.connected_components(nodes, edges).collect()}
    assert {labels[f"{i:02}"] for i in range(15)} == {"00"}
    assert labels["18"] == "17" and labels["19"] == "19" and labels["15"] == "15"


def test_principal_components_keep_variance(spark):
    rng = random.Random(2)
    rows = [(i, [x := rng.gauss(0, 5), 2 * x + rng.gauss(0, 0.1), rng.gauss(0, 0.1)]) for i in range(200)]
    reduced = clustering.reduce_dimensions(spark.createDataFrame(rows, "i int, v array<double>"), "v", 2)
    first, second = reduced.agg(F.variance("pc1"), F.variance("pc2")).first()
    assert first > 100 * second


def measures(spark, pairs):
    frame = spark.createDataFrame(pairs, "t int, p int")
    return evaluation.classification_metrics(frame, "t", "p").first()


def test_measures(spark):
    perfect = measures(spark, [(0, 0), (1, 1), (2, 2)])
    assert perfect.accuracy == 1.0 and perfect.matthews_correlation == pytest.approx(1.0)
    constant = measures(spark, [(0, 0), (1, 0), (1, 0)])
    assert constant.matthews_correlation == 0.0 and constant.accuracy == pytest.approx(1 / 3)
    # Counts tp=3 fn=1 fp=2 tn=4
    binary = measures(spark, [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4)
    assert binary.matthews_correlation == pytest.approx((3 * 4 - 2 * 1) / math.sqrt(5 * 4 * 6 * 5))
    assert binary.f1 == binary.precision == binary.recall == pytest.approx(0.7)


def test_argmax(spark):
    rows = spark.createDataFrame([([0.1, 0.7, 0.7],), ([2.0],)], "s array<double>")
    assert [r[0] for r in rows.select(evaluation.argmax(F.col("s"))).collect()] == [1, 0]


@pytest.mark.parametrize("algorithm", ["bayes", "logistic"])
def test_classifier_beats_the_majority(spark, algorithm):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        k = i % 2
        words = rng.choices(["alpha", "beta", "gamma"] if k else ["delta", "epsilon", "gamma"], k=8)
        rows.append((i, " ".join(words), k, "test" if i % 5 == 0 else "train"))
    split = spark.createDataFrame(rows, "id int, t string, k int, subset string")
    assert evaluation.evaluate_classifier(split, "id", "t", "k", algorithm=algorithm).first().accuracy > 0.9
    with pytest.raises(ValueError):
        evaluation.train_text_classifier(split, "t", "k", "forest")


def test_counted_bayes(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, rng.choices(words[4 * (i % 3) : 4 * (i % 3) + 6], k=rng.randrange(0, 7)), "abc"[i % 3]) for i in range(60)]
    train, test = rows[:40], [*rows[40:], (99, ["unseen"], "c"), (100, None, "a"), (101, ["w5", "unseen"], "b")]
    frames = [spark.createDataFrame(r, "id int, terms array<string>, k string") for r in (train, test)]
    model = evaluation.fit_counts(frames[0], "id", F.col("terms"), "k")
    found = {r.id: r.pred for r in evaluation.predict_counts(frames[1], "id", F.col("terms"), "k", model).collect()}
    vocabulary = {t for _, terms, _ in train for t in terms}
    wanted = {}
    for i, terms, _ in test:
        score = {}
        for k in "abc":
            own = [t for _, ts, label in train if label == k for t in ts]
            base = math.log(sum(label == k for *_, label in train) / len(train))
            score[k] = round(base + sum(math.log((own.count(t) + 1) / (len(own) + len(vocabulary))) for t in terms or [] if t in vocabulary), 9)
        wanted[i] = min(score, key=lambda k: (-score[k], k))
    assert found == wanted


def test_counted_bayes_meets_frequent_terms_in_place(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, rng.choices(words, [40 - j for j in range(30)], k=rng.randrange(0, 12)), "ab"[i % 2]) for i in range(80)]
    frame = spark.createDataFrame(rows, "id int, terms array<string>, k string")
    train, test = frame.filter("id < 50"), frame.filter("id >= 50")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = evaluation.fit_counts(train, "id", F.col("terms"), "k")
        whole = evaluation.predict_counts(test, "id", F.col("terms"), "k", model)
        found = sorted(map(tuple, whole.collect()))
        for bound in (0, 5):  # none, or only the most frequent, are broadcast
            monkeypatch.setattr(sizing, "BROADCAST_ROWS", bound)
            some = evaluation.predict_counts(test, "id", F.col("terms"), "k", model)
            assert sorted(map(tuple, some.collect())) == found
        # With more terms than may be broadcast in all, the most frequent still are.
        assert "BroadcastHashJoin" in some._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_both_fits_read_the_same_stored_counts(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(evaluation, "stage", lambda df, own=evaluation.stage: stored.append(df.columns) or own(df))
    rows = spark.createDataFrame([("alpha beta", 1.0), ("gamma delta", 0.0)] * 4, "t string, k double")
    model = evaluation.train_text_classifier(rows, "t", "k")
    assert stored == [["k", "_counts"]]
    assert [r.pred for r in evaluation.predict(model, rows.limit(2)).collect()] == [1, 0]
