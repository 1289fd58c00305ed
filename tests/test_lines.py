"""The line table against the in-row functions, with documents cut anywhere."""

import random

import pytest
from pyspark.sql import functions as F

from rankloom.functions import patterns as P
from rankloom.functions import text as X
from rankloom.operators.lines import carried, joined_lines, line_projects, line_sections, line_table, section_texts
from rankloom.vocabulary import DEFAULT

ALIASES = {"skills": ("skills", "technical skills"), "projects": ("projects",)}


def documents(spark, count=12, seed=1):
    random.seed(seed)
    words = ["Skills:", "projects", "- Line scanner", "built a tool with java", "", "TECHNICAL SKILLS", "Stock System", "x y z."]
    rows = [(i, "\n".join(random.choices(words, k=random.randrange(0, 60)))) for i in range(count)]
    rows += [(100, ""), (101, None), (102, "\n".join(["body"] * 500 + ["Skills"] + ["under it"] * 700 + ["Projects"]))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def carried_plainly(lines):
    last, opened, out = {}, {}, []
    for doc, pos, line in sorted(lines):
        if line.isupper():
            last[doc], opened[doc] = line, opened.get(doc, 0) + 1
        out.append((doc, pos, last.get(doc), opened.get(doc, 0)))
    return out


@pytest.mark.parametrize("parts", [1, 5, 60])
def test_carry_reaches_over_parts(spark, parts):
    random.seed(parts)
    rows = [(random.choice([1, 1, 1, 2, 3]), i, random.choice(["A", "B", "x", "y", "z", "w"])) for i in range(400)]
    rows += [(None, 1, "A"), (4, 1, "x")]
    lines = spark.createDataFrame(rows, "doc_id long, pos int, line string").repartition(7)
    found = carried(lines, F.when(F.col("line").rlike("^[AB]$"), F.col("line")), parts=parts)
    got = sorted((r.doc_id, r.pos, r.label, r.opened) for r in found.collect())
    assert got == carried_plainly([r for r in rows if r[0] is not None])
    assert carried(lines.limit(0), F.lit("a"), parts=parts).count() == 0


@pytest.mark.parametrize("parts", [None, 40])
def test_sections_equal_the_in_row_form(spark, parts):
    docs = documents(spark)
    cut = docs.select("doc_id", X.sections(F.col("text"), ALIASES).alias("cut"))
    want = {
        (r.doc_id, name): r[name]
        for name in ALIASES
        for r in cut.where(X.has_section(F.col("cut"), name)).select("doc_id", X.section_text(F.col("cut"), name).alias(name)).collect()
    }
    got = section_texts(line_sections(line_table(docs), ALIASES, parts=parts))
    assert {(r.doc_id, r.section): r.text for r in got.collect()} == want and (102, "skills") in want


@pytest.mark.parametrize("parts", [None, 40])
def test_projects_equal_the_in_row_form(spark, parts):
    docs = documents(spark, 30, 5)
    section = X.section_or(X.sections(F.col("text"), DEFAULT.candidate_sections), "projects", F.lit(""))
    rows = docs.where("text IS NOT NULL").select("doc_id", P.projects(section).alias("p")).collect()
    want = {r.doc_id: [(p.name, p.description, p.technologies) for p in r.p] for r in rows if r.p}
    got = {}
    for r in sorted(line_projects(line_table(docs), parts=parts).collect(), key=lambda r: (r.doc_id, r.place)):
        got.setdefault(r.doc_id, []).append((r.name, r.description, r.technologies))
    assert got == want and len(want) > 10


def test_pages_of_a_document_in_order(spark):
    pages = spark.createDataFrame([("d", 2, "c\nd"), ("d", 1, "a\nSkills"), ("d", 3, None)], "doc_id string, page int, text string")
    lines = line_table(pages, place=("page",))
    found = line_sections(lines, ALIASES, order=("page", "pos"), parts=5)
    assert [r.line for r in found.orderBy("page", "pos").collect()] == ["Skills", "c", "d"]
    text = joined_lines(lines, ["doc_id"], ("page", "pos"), "\n").first().text
    assert text == "a\nSkills\nc\nd"
