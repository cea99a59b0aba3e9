import pytest
from pyspark.sql import functions as F

from papyrine.operators import linkage, reports
from papyrine.operators.linkage import LinkKey

KEYS = [LinkKey("doi", "doi", "doi"), LinkKey("mag", "id", "mag")]


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [(1, "d1", None), (2, "", "20"), (3, None, "30"), (4, None, "40"), (5, "d5", "50"), (6, None, None), (7, "", None)],
        "work int, doi string, mag string",
    )
    right = spark.createDataFrame(
        [("10", "d1"), ("11", "d1"), ("20", ""), ("30", None), ("40", "d40"), ("50", "other"), ("60", None), ("61", "")],
        "id string, doi string",
    )
    return left, right


def pairs(frame):
    return sorted((r.work, r.linked_id, r.joined_on) for r in frame.select("work", "linked_id", "joined_on").collect())


def test_all_matches(sides):
    """NULL matches nothing, '' matches '', duplicates fan out, a link without DOI has no tag."""
    left, right = sides
    linked = linkage.link_with_fallback(left, right, KEYS, "work")
    expected = [(1, "10", "doi"), (1, "11", "doi"), (2, "20", "doi"), (2, "61", "doi"), (3, "30", None), (4, "40", "mag"),
                (5, "50", "mag"), (6, None, None), (7, "20", "doi"), (7, "61", "doi")]
    assert [p for p in pairs(linked.fillna("-", ["linked_id", "joined_on"]))] == [
        (w, i or "-", t or "-") for w, i, t in expected
    ]


def test_best_match_equals_join_then_dedup(sides):
    left, right = sides
    best = linkage.link_with_fallback(left, right, KEYS, "work", best=[F.col("id")])
    every = linkage.link_with_fallback(left, right, KEYS, "work")
    first = linkage.dedup_keep_first(every, "work", [F.asc("linked_id")])
    columns = ["work", "linked_id", "joined_on", "linked_doi", "doi_join_worked", "mag_join_worked"]
    assert best.select(*columns).exceptAll(first.select(*columns)).isEmpty()
    counts = {r.work: (r.doi_candidates, r.mag_candidates) for r in best.collect()}
    assert counts[1] == (2, 0) and counts[7] == (2, 0) and counts[4] == (0, 1) and counts[6] == (0, 0)


def test_strict_flag(sides):
    left, right = sides
    linked = linkage.link_with_fallback(left, right, KEYS, "work", strict_link_flag=True)
    assert linked.filter("work = 3").first().joined_on == "mag"


def test_dedup_orders_nulls_last(spark):
    rows = spark.createDataFrame([(1, None, 1), (1, "a", 2), (1, "b", 3), (2, None, 4)], "k int, v string, i int")
    kept = linkage.dedup_keep_first(rows, "k", [F.desc_nulls_last("v"), F.asc("i")])
    assert sorted(r.i for r in kept.collect()) == [3, 4]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "Final" in plan and "WindowGroupLimit" in plan


def test_crosstab_counts_pairs_without_making_them(spark):
    """One key with many rows on both sides."""
    left = spark.range(300).select(F.col("id").alias("w"), F.lit("x").alias("k"), F.lit(None).cast("string").alias("m"))
    right = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("k"))
    table = reports.coverage_crosstab(left, right, [("k", "k", "by_k"), ("m", "id", "by_m")], ["by_k", "by_m"], "w")
    rows = [(r.by_k, r.by_m, r.c_mill, r.p) for r in table.collect()]
    assert rows == [(1, 0, 0.06, 100.0)]


def test_merges(spark):
    merges = spark.createDataFrame([(f"W{a}", f"W{b}") for a, b in [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (9, 1), (8, 0)]],
                                   "id string, merge_into_id string")
    four = {r.id: r.merge_into_id_final for r in linkage.resolve_merges(linkage.merge_map(merges)).collect()}
    assert four[1] == 5 and four[9] == 4 and four[5] == 6 and four[8] == 0
    full = {r.id: r.merge_into_id_final for r in linkage.resolve_merges_fully(linkage.merge_map(merges)).collect()}
    assert full == {1: 6, 2: 6, 3: 6, 4: 6, 5: 6, 9: 6, 8: 0}


def test_merge_cycles_and_duplicates(spark):
    merges = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 5), (4, 6)], "id bigint, merge_into_id bigint")
    full = {r.id: r.merge_into_id_final for r in linkage.resolve_merges_fully(merges).collect()}
    assert full == {1: None, 2: None, 3: None, 4: 5}
    assert linkage.resolve_merges(merges).filter("id = 4").count() == 2


def test_wrong_prefix_raises(spark):
    bad = spark.createDataFrame([("X1", "W2")], "id string, merge_into_id string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        linkage.merge_map(bad).collect()
