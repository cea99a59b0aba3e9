"""The stages one after the other, each against its operator's definition by plain loops."""

import brute
import corpus_pipeline
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
        seen[name] = (docs.collect(), out.collect())
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    before, after = seen["exact_dedup"]
    assert len(after) == len({" ".join(r["text"].split()) for r in before})
    before, after = seen["near_dedup"]
    prints = [(r["doc_id"], brute.simhash(r["text"])) for r in before]
    assert {r["doc_id"] for r in after} == set(brute.near_components(prints))
    before, after = seen["passage_dedup"]
    wanted = {r[0]: r[1] - r[2] for r in brute.removed([(r["doc_id"], r["text"]) for r in before])}
    assert all(wanted[r["doc_id"]] - 6 <= len(r["text"].encode()) <= wanted[r["doc_id"]] for r in after)
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = seen["packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


@pytest.mark.parametrize("name", ["op2_host_rules", "op8_quotient_filters", "op10_licence_dice"])
def test_sql(spark, name):
    from compare import difference, duck

    assert difference(spark, duck(SF_DIR), SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_rows_without_id_are_documents_of_their_own(spark):
    from papyrine.llm import exact, simhash

    rng = __import__("random").Random(1)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(5)]
    rows = [(None, t) for t in texts[:3]] + [(None, texts[3]), (7, texts[3]), (3, texts[4]), (None, texts[4] + " "), (None, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = sorted((r.text, r.doc_id is None, r.doc_id) for r in simhash.deduplicate(frame).collect())
    # Rows alike in id and text stay together here; exact duplicates go in the stage before.
    assert left == sorted([(t, True, None) for t in [*texts[:3], texts[0]]] + [(texts[3], False, 7), (texts[4], False, 3)])
    spaced = [(5, "a b " + texts[0]), (5, "a  b " + texts[0]), (6, "a b\t" + texts[0]), (5, texts[1]), (5, texts[1]), (None, texts[2]), (None, texts[2] + " ")]
    frame = spark.createDataFrame(spaced, "doc_id long, text string").repartition(3)
    left = [(r.doc_id, " ".join(r.text.split())) for r in exact.deduplicate(frame).collect()]
    # A trailing blank is one blank more, so that the last two texts differ.
    wanted = [(5, "a b " + texts[0]), (5, texts[1]), (None, texts[2]), (None, texts[2])]
    assert sorted(left, key=repr) == sorted(wanted, key=repr)
