import json
import random

import pytest
from pyspark.sql import functions as F

from papyrine.operators import sections as ops

ARGS = ("id", "text", "h", "p")


def note(start, end, n=None):
    return {"start": str(start) if start % 2 else start, "end": end, "attributes": {"n": n}}


@pytest.fixture(scope="module")
def works(spark):
    rng, rows = random.Random(3), []
    for number in range(40):
        body = "".join(rng.choice("abc \né\t\\n") for _ in range(rng.randint(0, 600)))
        spans = []
        for _ in range(rng.randint(0, 12)):
            start = rng.randint(0, max(len(body), 1))
            spans.append((start, rng.randint(start, len(body) + 3)))
        spans = sorted(set(spans))  # ties between the types are decided, equal spans of one type are not
        headers = [s for s in spans if rng.random() < 0.3]
        paragraphs = [s for s in spans if s not in headers or rng.random() < 0.2]
        rows.append((number, body, json.dumps([note(*s, "1") for s in headers]), json.dumps([note(*s) for s in paragraphs])))
    rows += [(100, "x" * 300, None, json.dumps([note(0, 200)])), (101, "abc", "not json", "[]"), (102, "abc", "[]", None),
             (103, "H1 H2 text", json.dumps([note(0, 2), note(3, 5)]), json.dumps([note(6, 10)])),
             (104, "text H1", json.dumps([note(5, 7)]), json.dumps([note(0, 4)]))]
    return spark.createDataFrame(rows, "id bigint, text string, h string, p string").cache()


def test_section_text_is_the_slice(works):
    bodies = {r.id: r.text for r in works.collect()}
    sections = ops.sections_with_text(works, *ARGS).collect()
    assert sections
    for s in sections:
        assert s.section_text == bodies[s.work_id][s.section_start : s.section_end].strip(" \t\n\r\f\x0b")
        assert s.section_text_length == len(s.section_text)
    assert not {101, 102} & {s.work_id for s in sections}


def test_numbering(works):
    by_work = {}
    for s in ops.annotation_spans(works, "id", "h", "p").collect():
        by_work.setdefault(s.work_id, []).append(s)
    for spans in by_work.values():
        spans.sort(key=lambda s: s.section_index)
        assert [s.section_index for s in spans] == list(range(1, len(spans) + 1))
        places = [(s.section_start, s.section_end, s.section_type) for s in spans]
        assert places == sorted(places)
        for kind in ("header", "paragraph"):
            numbers = [s.section_type_index for s in spans if s.section_type == kind]
            assert numbers == list(range(1, len(numbers) + 1))


def test_texts_by_join_are_the_same(works):
    direct = ops.sections_with_text(works, *ARGS)
    joined = ops.section_texts(ops.annotation_spans(works, "id", "h", "p"), works, "id", "text")
    assert direct.exceptAll(joined.select(*direct.columns)).isEmpty()
    assert direct.count() == joined.count()


@pytest.mark.parametrize("compat", [False, True])
def test_chapters_in_row_equal_chapters_from_sections(works, compat):
    sections = ops.sections_with_text(works, *ARGS)
    stats = ops.section_stats(works.select("id"), sections, "id")
    grouped = ops.build_chapters(ops.sections_with_headers(sections, stats, "id"), compat)
    direct = ops.chapters_in_row(works, *ARGS, literal_compat=compat)

    def rows(frame):
        return sorted((tuple(r) for r in frame.select(*ops.CHAPTER).collect()), key=lambda r: r[:2])

    assert rows(direct) == rows(grouped)
    plan = direct._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_chapter_shapes(works):
    chapters = {(r.work_id, r.header_index): r for r in ops.chapters_in_row(works, *ARGS).collect()}
    assert not any(work == 100 for work, _ in chapters)  # no headers at all
    two = chapters[(103, 1)]
    assert (two.header_text, two.chapter_text, two.chapter_text_length, two.chapter_is_research_methodology) == ("H1", None, None, -1)
    assert chapters[(103, 2)].chapter_text == "text" and chapters[(103, 2)].section_indices == [2, 3]
    preface = chapters[(104, 0)]
    assert (preface.header_text, preface.chapter_text, preface.number_of_paragraphs_in_chapter) == (None, "text", 1)
    assert chapters[(104, 1)].header_text == "H1"


def test_every_section_is_in_one_chapter(works):
    spans = ops.annotation_spans(works, "id", "h", "p")
    with_headers = spans.filter("section_type = 'header'").select("work_id").distinct()
    expected = spans.join(with_headers, "work_id").select("work_id", "section_index")
    placed = ops.chapters_in_row(works, *ARGS).select("work_id", F.explode("section_indices").alias("section_index"))
    assert placed.exceptAll(expected).isEmpty() and expected.exceptAll(placed).isEmpty()


def test_stats_are_zero_filled(works):
    stats = {r.id: r for r in ops.section_stats(works.select("id"), ops.annotation_spans(works, "id", "h", "p"), "id").collect()}
    assert (stats[101].number_of_sections, stats[101].has_sections) == (0, 0)
    assert (stats[100].has_headers, stats[100].has_paragraphs, stats[100].number_of_paragraphs) == (0, 1, 1)
    assert len(stats) == works.count()


def test_literal_line_breaks(spark):
    work = spark.createDataFrame([(1, r"H a\nabla b", json.dumps([note(0, 1)]), json.dumps([note(2, 11)]))], "id bigint, text string, h string, p string")
    assert ops.chapters_in_row(work, *ARGS).first().chapter_text == r"a\nabla b"
    assert ops.chapters_in_row(work, *ARGS, literal_compat=True).first().chapter_text == "a\nabla b"


def test_rows_and_row_form_agree(spark):
    header = '[{"attributes":{"n":"1"},"start":0,"end":2}]'
    rows = [(1, "ab cd", header, '[{"start":"3","end":"5"}]'), (2, "x", None, None), (3, "yz", "[]", '[{"start":0,"end":2}]'), (4, "q", "[{", " ")]
    works = spark.createDataFrame(rows, "id int, t string, h string, p string")
    spans = ops.annotation_spans(works, "id", "h", "p")
    stats = ops.section_stats(works.select("id"), spans, "id")
    in_row = ops.section_stats_in_row(works, "h", "p").select(*stats.columns)
    assert sorted(stats.collect()) == sorted(in_row.collect())
    joined = ops.sections_with_headers(ops.sections_with_text(works, "id", "t", "h", "p"), stats, "id")
    direct = ops.sections_with_headers_in_row(works, "id", "t", "h", "p")
    assert joined.columns == direct.columns
    assert joined.collect() and sorted(map(str, joined.collect())) == sorted(map(str, direct.collect()))
    assert "Exchange" not in direct._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in ops.annotation_rejects(works, "id", "h", "p").collect()] == [(4, "header", "[{")]
