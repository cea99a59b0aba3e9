import random

from pyspark.sql import functions as F

from papyrine.functions import ids, licences, text
from papyrine.functions.headers import METHODOLOGY, classify_header


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


def test_ids(spark):
    assert one(spark, "https://openalex.org/W2079861989", ids.url_number) == "2079861989"
    assert one(spark, None, ids.url_number) is None
    assert one(spark, "https://openalex.org/subfields/1306", ids.url_last_segment) == "1306"
    assert one(spark, "https://doi.org/10.1/a/b", ids.url_path_id) == "10.1/a/b"
    assert one(spark, "10.1/a", ids.url_path_id) == ""
    assert one(spark, None, ids.url_path_id) is None
    assert one(spark, "W12", lambda c: ids.strip_prefix_id(c, "W")) == "12"
    assert one(spark, "X12", lambda c: ids.strip_prefix_id(c, "W")) == "ERROR: X12"
    assert one(spark, " \ta\tb \r\n", ids.clean_line) == "a\nb"


def test_presence(spark):
    rows = spark.createDataFrame([(None, None), ("", None), ("a", ""), (None, "b")], "a string, b string")
    found = [tuple(r) for r in rows.select(ids.present(F.col("a")), ids.present(F.col("a"), F.col("b")), ids.not_null(F.col("a"))).collect()]
    assert found == [(0, 0, 0), (0, 0, 1), (1, 1, 1), (0, 1, 0)]


def test_licences(spark):
    for url, code in licences.URL_CODES.items():
        assert one(spark, url, licences.preprint_licence) == code
    assert one(spark, None, licences.preprint_licence) is None
    assert one(spark, "http://x/", licences.preprint_licence) == "ArXiv: http://x/"
    assert len(licences.UNUSABLE) == 13 and len(licences.URL_CODES) == 9
    for licence in licences.UNUSABLE:
        assert one(spark, licence, licences.works_licence) is None
    assert one(spark, "pd", licences.works_licence) == "public-domain"
    assert one(spark, "CCBY", licences.works_licence) == "CCBY"
    assert one(spark, None, licences.works_licence) is None
    assert one(spark, "CCBYNCND", licences.reuse_flag) == 0
    assert one(spark, "gpl", licences.reuse_flag) == 1
    assert one(spark, None, licences.reuse_flag) == 0


HEADERS = [
    ("Methodology", None, -1), ("Methodology", 99, -1), ("Methodology", 100, 1),
    ("New methodology for bathing", 500, -2), ("Training methodology", 500, -3),
    ("Evaluation methodology", 500, -4), ("Our research methodology x", 500, 2),
    ("Methodology: x", 500, 3), ("X: methodology", 500, 4), ("Our proposed methodology in detail", 500, 5),
    ("The experimental methodology used", 500, 6), ("IV. Methodology", 500, 7),
    ("Methodology of everything", 500, None), ("Results", 500, None), (None, 500, None),
]


def test_headers(spark):
    assert len(METHODOLOGY) == len(set(METHODOLOGY)) == 134
    rows = spark.createDataFrame([(i, h, n) for i, (h, n, _) in enumerate(HEADERS)], "i int, h string, n bigint")
    coded = rows.select("i", classify_header(F.col("h"), F.length("h"), F.col("n")).alias("c")).collect()
    assert {r.i: r.c for r in coded} == {i: c for i, (_, _, c) in enumerate(HEADERS)}


def test_cut_is_python_slicing(spark):
    """Block-wise cutting, also across block borders, beyond the end and with wide characters."""
    rng = random.Random(1)
    body = "".join(rng.choice("aé漢😀 \n") for _ in range(3 * text.BLOCK + 17))
    spans = [(0, 0), (5, 5), (0, len(body)), (text.BLOCK - 1, text.BLOCK + 1), (text.BLOCK, 2 * text.BLOCK), (len(body) - 2, len(body) + 9), (len(body) + 5, len(body) + 9), (9, 4)]
    spans += [tuple(sorted(rng.sample(range(len(body)), 2))) for _ in range(200)]
    rows = spark.createDataFrame([(body, [list(s) for s in spans])], "t string, s array<array<int>>")
    cuts = rows.withColumn("b", text.blocks(F.col("t"))).select(F.transform("s", lambda s: text.cut(F.col("b"), s[0], s[1]))).first()[0]
    assert cuts == [body[a:b] for a, b in spans]


def test_strip_and_preview(spark):
    for value in ("", " ", "\t a b\n", "a", "\x0b\x0cx y\r", "x "):
        assert one(spark, value, text.strip) == value.strip(text.WHITE_SPACE)
    assert one(spark, "a" * 120 + "\nb", text.preview) == "a" * 100
    assert one(spark, "A b2 cd_e, ouè", text.tokens) == ["b2", "cd_e", "ouè"]


def test_words_of_any_script(spark):
    from papyrine.functions.text import tokens

    row = spark.createDataFrame([("Größe für naïve élève",)], "t string").select(tokens(F.col("t")).alias("w")).first()
    assert row["w"] == ["größe", "für", "naïve", "élève"]
