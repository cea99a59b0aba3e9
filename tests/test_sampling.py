import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from papyrine.operators import labels, ranking, sampling
from papyrine.operators.ranking import seeded_hash


@pytest.fixture(scope="module")
def classes(spark):
    """Classes of 1, 2, 9, 10, 11, 13 rows, one without a name, and one with a third of all rows."""
    sizes = {"a": 1, "b": 2, "c": 9, "d": 10, "e": 11, "f": 13, None: 25, "hot": 3000, "rest": 5900}
    rows, number = [], 0
    for name, size in sizes.items():
        for _ in range(size):
            rows.append((number, name))
            number += 1
    return spark.createDataFrame(rows, "id bigint, c string").cache()


def ordered(seed):
    return Window.partitionBy("c").orderBy(seeded_hash("id", seed), "id")


def test_tiles_equal_ntile(classes):
    split = sampling.stratified_split(classes, "c", "id", seed=7)
    expected = classes.withColumn("bucket_10p", F.ntile(10).over(ordered(7)).cast("bigint"))
    assert split.count() == classes.count()
    assert split.select("id", "bucket_10p").exceptAll(expected.select("id", "bucket_10p")).isEmpty()
    counts = {(r.c, r.subset): r["count"] for r in split.groupBy("c", "subset").count().collect()}
    assert counts[("a", "test")] == 1 and ("a", "train") not in counts
    assert counts[("b", "test")] == counts[("b", "validation")] == 1
    assert counts[("hot", "train")] == 2400


@pytest.mark.parametrize("cap", [2, 10, 11, 12, 1000])
def test_cap_keeps_fewer_than_n(classes, cap):
    kept = sampling.cap_classes(classes, {"c": cap}, "id", seed=5)
    expected = classes.withColumn("r", F.row_number().over(ordered("5/c"))).filter(F.col("r") < cap)
    assert kept.count() == expected.count()
    assert kept.select("id").exceptAll(expected.select("id")).isEmpty()


def test_cap_counts_rows_of_repeated_ids(spark):
    rows = spark.createDataFrame([(i % 5, "x") for i in range(20)] + [(None, "x")] * 3 + [(1, "y")] * 9, "id int, c string")
    for cap in (2, 3, 7, 12, 20, 50):
        kept = {r.c: r["count"] for r in sampling.cap_classes(rows, {"c": cap}, "id").groupBy("c").count().collect()}
        assert kept == {"x": min(23, cap - 1), "y": min(9, cap - 1)}


def test_tiles_of_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(1, "x", n) for n in range(40)] + [(None, "x", 100)] + [(n, "x", 0) for n in range(9)],
                                 "id int, c string, t int")
    split = sampling.stratified_split(rows, "c", "id", seed=3)
    assert {r["count"] for r in split.groupBy("bucket_10p").count().collect()} == {5}
    tied = sampling.stratified_split(rows, "c", "id", seed=3, ties=["t"])
    order = Window.partitionBy("c").orderBy(F.coalesce(seeded_hash("id", 3), F.lit("")), "id", "t")
    expected = rows.withColumn("bucket_10p", F.ntile(10).over(order).cast("bigint"))
    columns = ["id", "t", "bucket_10p"]
    assert tied.select(columns).exceptAll(expected.select(columns)).isEmpty()
    one = sampling.stratified_split(spark.createDataFrame([(None, "x")] * 10, "id int, c string"), "c", "id")
    assert sorted(r.bucket_10p for r in one.collect()) == list(range(1, 11))


def test_caps_are_ranked_before_either_cut(spark):
    rows = spark.range(400).select("id", (F.col("id") % 4).alias("a"), (F.col("id") % 3).alias("b"))
    kept = sampling.cap_classes(rows, {"a": 31, "b": 41}, "id", min_count=5, min_col="a", count_name="n")
    a = F.row_number().over(Window.partitionBy("a").orderBy(seeded_hash("id", "42/a"), "id"))
    b = F.row_number().over(Window.partitionBy("b").orderBy(seeded_hash("id", "42/b"), "id"))
    expected = rows.withColumns({"x": a, "y": b}).filter("x < 31 and y < 41")
    expected = expected.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("a"))).filter("n > 5")
    assert kept.select("id", "n").exceptAll(expected.select("id", "n")).isEmpty()
    assert kept.count() == expected.count() > 0
    with pytest.raises(ValueError):
        sampling.cap_classes(rows, {"a": 1}, "id")


def test_split_does_not_depend_on_partitions(spark, classes):
    def tagged(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        rows = sampling.stratified_split(classes.repartition(partitions), "c", "id").select("id", "subset").collect()
        return sorted(map(tuple, rows))

    try:
        assert tagged(1) == tagged(8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_many_classes_without_broadcast(spark, classes, monkeypatch):
    expected = sorted(map(tuple, sampling.stratified_split(classes, "c", "id").select("id", "subset").collect()))
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ranking, "HOT_SHARE", 2)
    found = sorted(map(tuple, sampling.stratified_split(classes, "c", "id").select("id", "subset").collect()))
    assert found == expected


def test_wide_rows_are_not_shuffled_by_a_split(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(1000).select("id", (F.col("id") % 3).alias("c"), F.repeat(F.lit("x"), 100).alias("text")).write.parquet(path)
    split = sampling.stratified_split(spark.read.parquet(path), "c", "id")
    plan = split._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert "text" in plan and not any("text" in line for line in moved)
    wide = plan[plan.index("text") :]
    assert "SortMergeJoin" not in wide


@pytest.mark.parametrize("rows", [1, 99, 100, 101])
@pytest.mark.parametrize("percent", [1, 10, 100])
def test_head_percent(spark, rows, percent):
    ids = spark.range(rows).select((F.col("id") * 3).alias("id")).repartition(5)
    found = [r.id for r in sampling.head_percent(ids, "id", percent).orderBy("id").collect()]
    assert found == [3 * i for i in range(round(rows * percent / 100))]


def test_head_percent_of_null_and_repeated_ids(spark):
    ids = [None, None, *[0] * 3, 1, *[2] * 6, 3]
    frame = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id int, n int").repartition(4)
    for percent in (1, 8, 15, 30, 50, 77, 99):
        found = sampling.head_percent(frame, "id", percent).collect()
        wanted = sorted(ids, key=lambda i: (i is not None, i))[: round(len(ids) * percent / 100)]
        assert sorted((r.id for r in found), key=lambda i: (i is not None, i)) == wanted
        assert len({r.n for r in found}) == len(found)
    assert sampling.head_percent(frame.limit(0), "id", 50).collect() == []


def test_pages(spark):
    ids = spark.range(0, 500, 2).repartition(7)
    wanted = [r.id for r in sampling.page_by_id(ids, "id", 100, 5).collect()]
    assert wanted == [200, 202, 204, 206, 208]
    copies = spark.createDataFrame([(i,) for i in [None, None, 1, 2, 2, 2, 3]], "id int").repartition(3)
    assert [r.id for r in sampling.page_by_id(copies, "id", 1, 4).collect()] == [None, 1, 2, 2]
    assert [r.id for r in sampling.page_by_id(copies, "id", 4, 9).collect()] == [2, 2, 3]
    assert sampling.page_by_id(copies, "id", 7, 9).count() == 0
    assert [r.id for r in sampling.page_after(ids, "id", 198, 5).collect()] == wanted


def test_global_row_number(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k")).repartition(6)
    numbered = ranking.global_row_number(rows, [F.desc("k"), F.asc("id")], "n")
    expected = rows.withColumn("n", F.row_number().over(Window.orderBy(F.desc("k"), F.asc("id"))))
    assert numbered.select("id", F.col("n").cast("int")).exceptAll(expected.select("id", "n")).isEmpty()
    index = ranking.total_order_index(rows, [F.asc("id")], "i")
    assert [r.i for r in index.orderBy("id").limit(3).collect()] == [0, 1, 2]


def test_class_index_has_no_gaps(classes):
    index = labels.class_index(sampling.class_counts(classes, "c", "n"), ["c"], "n", "i").orderBy("i").collect()
    assert [r.i for r in index] == list(range(9))
    assert [r.c for r in index][:3] == ["rest", "hot", None]


def test_distribution_adds_up(classes):
    shares = labels.class_distribution(classes, ["c"], digits=9).collect()
    assert abs(sum(r.percent_of_papers for r in shares) - 100) < 1e-6
    assert sum(r.number_of_papers for r in shares) == classes.count()
