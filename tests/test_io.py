import pytest
from pyspark.sql import functions as F

from papyrine import session
from papyrine.operators import reduction
from papyrine.sources import readers, tables
from papyrine.streaming import incremental

LINES = [
    ('{"id":"https://openalex.org/W1","doi":"https://doi.org/10.1/a/b","ids":{"mag":7}}', "ok"),
    ('{"id":null,"title":"t"}', "ok"),
    ('{"title":"no id"}', "no_id"),
    ("not json", "unparsable"),
    ("", "unparsable"),
    ('{"id":"https://openalex.org/W2","primary_topic":null,"new_key":1}', "ok"),
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(i, v) for i, (v, _) in enumerate(LINES)], "i int, value string")


def test_status(lines):
    found = {r.i: r.status for r in reduction.parse_lines(lines).collect()}
    assert found == {i: s for i, (_, s) in enumerate(LINES)}


def test_json_is_parsed_once(spark, lines, tmp_path):
    lines.write.parquet(str(tmp_path / "l"))
    good, _ = reduction.split_records(reduction.parse_lines(spark.read.parquet(str(tmp_path / "l"))))
    plan = reduction.reduce_records(good)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_reduction(lines):
    good, rejects = reduction.split_records(reduction.parse_lines(lines))
    rows = {r.id_openalex_short: r for r in reduction.reduce_records(good).collect()}
    assert len(reduction.reduce_records(good).columns) == 25
    assert set(rows) == {"1", "2", None}
    assert (rows["1"].id_doi_short, rows["1"].id_mag, rows["1"].primary_topic_long_id) == ("10.1/a/b", "7", None)
    assert rejects.count() == 3


def test_audit(lines):
    found = {r.i: (r.status, r.unknown_keys) for r in reduction.audit_keys(lines, [*reduction.KNOWN_KEYS, "primary_topic"]).collect()}
    assert found[0] == ("ok", []) and found[3] == ("unparsable", None) and found[5] == ("unknown keys", ["new_key"])


def test_create_table(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    make = dict(database="papyrine_test", name="t", location=str(tmp_path / "db"))
    assert tables.create_table(one, **make) == "created"
    with pytest.raises(ValueError, match="already exists"):
        tables.create_table(two, **make)
    assert tables.create_table(two, **make, overwrite_strategy="ignore") == "ignored"
    assert spark.table("papyrine_test.t").count() == 1
    assert tables.create_table(two, **make, overwrite_strategy="overwrite") == "overwritten"
    assert tables.describe_table(spark, "papyrine_test.t")[1] == 2
    with pytest.raises(ValueError, match="unknown"):
        tables.create_table(two, **make, overwrite_strategy="replace")
    tables.drop_tables(spark, ["papyrine_test.t", "papyrine_test.never"])
    assert not spark.catalog.tableExists("papyrine_test.t")


def test_register_takes_paths_only(spark):
    with pytest.raises(ValueError):
        tables.register_inferred(spark, ("a", "b"), "db", "x_")


def test_bucketed_tables_join_in_place(spark, tmp_path):
    for name in ("l", "r"):
        tables.create_table(spark.range(1000), "papyrine_buckets", name, "overwrite", str(tmp_path / "b"), bucket_by=(4, "id"))
    with_hint = spark.table("papyrine_buckets.l").hint("merge").join(spark.table("papyrine_buckets.r"), "id")
    assert "Exchange" not in with_hint._jdf.queryExecution().executedPlan().toString()


def test_pairs(spark):
    rows = spark.createDataFrame([("t", None, 1, 2), (None, "a", 1, None)], "title string, abstract string, s int, k int")
    configs = tables.pair_configs(["title", "abstract"], {"subfield": "s", "topic": "k"})
    assert list(configs) == ["title_subfield", "title_topic", "abstract_subfield", "abstract_topic"]
    counts = {n: tables.text_label_pairs(rows, t, label).count() for n, (t, label) in configs.items()}
    assert counts == {"title_subfield": 1, "title_topic": 1, "abstract_subfield": 1, "abstract_topic": 0}


def raw(number):
    return f'{{"id":"https://openalex.org/W{number}"}}'


def write(spark, path, numbers, mode="append"):
    spark.createDataFrame([(raw(n),) for n in numbers], "value string").coalesce(1).write.mode(mode).text(path)


def test_stream_takes_each_part_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in "stc")
    write(spark, source, range(10))
    incremental.incremental_reduce(spark, source, target, checkpoint)
    incremental.incremental_reduce(spark, source, target, checkpoint)
    write(spark, source, range(10, 15))
    incremental.incremental_reduce(spark, source, target, checkpoint)
    found = sorted(int(r.id_openalex_short) for r in spark.read.parquet(target).collect())
    assert found == list(range(15))


def test_manifest(spark, tmp_path):
    source, target, manifest = (str(tmp_path / n) for n in "stm")
    write(spark, source, range(5))
    assert incremental.ingest_new_parts(spark, source, target, manifest, glob="part-*") == 1
    assert incremental.ingest_new_parts(spark, source, target, manifest, glob="part-*") == 0
    write(spark, source, range(5, 8))
    # A run that wrote its rows and died before it recorded them.
    spark.read.parquet(target).withColumn("ingest_run", F.lit("dead")).write.mode("append").parquet(target)
    assert incremental.ingest_new_parts(spark, source, target, manifest, glob="part-*") == 1
    rows = incremental.recorded_rows(spark, target, manifest)
    assert sorted(int(r.id_openalex_short) for r in rows.collect()) == list(range(8))
    assert incremental.ingest_new_parts(spark, source, target, manifest, force_overwrite=True, glob="part-*") == 2
    assert incremental.recorded_rows(spark, target, manifest).count() == 8


def test_full_run_that_dies_loses_nothing(spark, tmp_path):
    source, target, manifest, rejects = (str(tmp_path / n) for n in "stmr")
    write(spark, source, range(5))
    spark.createDataFrame([("no json",)], "value string").coalesce(1).write.mode("append").text(source)

    def ids():
        return sorted(int(r.id_openalex_short) for r in incremental.recorded_rows(spark, target, manifest).collect())

    def take(**options):
        return incremental.ingest_new_parts(spark, source, target, manifest, glob="part-*", **options)

    assert take(rejects=rejects) == 2 and ids() == list(range(5))
    assert [r.value for r in spark.read.parquet(rejects).select("value").collect()] == ["no json"]
    (tmp_path / "file").write_text("")
    with pytest.raises(Exception):  # noqa: B017  dies when it has written its rows: no folder can be made below a file
        incremental.ingest_new_parts(spark, source, target, str(tmp_path / "file" / "m"), force_overwrite=True, glob="part-*")
    assert spark.read.parquet(target).count() == 10
    assert ids() == list(range(5)) and take() == 0
    assert take(force_overwrite=True) == 2 and ids() == list(range(5)) and take() == 0


def test_file_range(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.range(4).repartition(4).write.parquet(path)
    names = readers.file_range(spark, path, 1, 3, "*.parquet")
    assert len(names) == 2 and names == sorted(names)


class Cluster:
    """What the folder choice asks of a session."""

    def __init__(self, configured=None, checkpoint_dir=None, master="spark://host:1"):
        self.values = {session.CHECKPOINT_CONF: configured}
        self.conf = self.sparkContext = self
        self.master, self.applicationId, self.checkpoint_dir = master, f"app-{id(self)}", checkpoint_dir

    def get(self, name, default=None):
        return self.values.get(name) or default

    def getCheckpointDir(self):
        return self.checkpoint_dir


def test_shared_folder_comes_from_the_session():
    assert session.shared_folder(Cluster("hdfs://shared/x")) == "hdfs://shared/x"
    assert session.scratch_path(Cluster("hdfs://shared/x/"), "raw").startswith("hdfs://shared/x/raw-")
    assert session.shared_folder(Cluster(checkpoint_dir="hdfs://set/by/code")) == "hdfs://set/by/code"
    with pytest.raises(RuntimeError):
        session.shared_folder(Cluster())
    local = Cluster(master="local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
