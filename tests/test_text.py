"""Clean-up, keys, headers, sections and de-duplication on small fixtures."""

import pytest
from pyspark.sql import functions as F

from rankloom.functions import text as X
from rankloom.vocabulary import CANDIDATE_SECTIONS


def apply(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("raw", "cleaned"),
    [
        ("A\0B", "A B"),
        ("a \t b\n\n\n\nc", "a b\n\nc"),
        ("a\n \n \nb", "a\n\n\nb"),
        (" x \n y ", "x\ny"),
        ("a\r\nb\x1cc d\n", "a\nb\nc\nd"),
        ("", ""),
    ],
)
def test_clean_text(spark, raw, cleaned):
    assert apply(spark, X.clean_text, [raw]) == [cleaned]


def test_normalize_keeps_inner_spaces(spark):
    assert apply(spark, X.normalize_text, ["\xa0a  b\n\n\n\nc\0 "]) == ["a  b\n\nc"]


def test_collapse_whitespace(spark):
    assert apply(spark, X.collapse_whitespace, [" a\t\nb ", "", " \n"]) == ["a b", " ", " "]


def test_token_keys(spark):
    values = ["C++", "C#", "scikit-learn", "Power  BI", "Node.js", "--"]
    expected = ["c++", "c#", "scikit learn", "power bi", "node js", ""]
    assert apply(spark, X.token_key, values) == expected


def test_capitalize_keeps_the_rest(spark):
    assert apply(spark, X.capitalize_words, ["ada  mcDonald o'neil"]) == ["Ada McDonald O'neil"]


def test_headers(spark):
    lines = [
        "Skills:", "## Technical Skills", "WORK EXPERIENCE", "Skills (core)",
        "Education & Training", "",
    ]
    found = apply(spark, lambda c: X.section_name(c, CANDIDATE_SECTIONS), lines)
    assert found == ["skills", "skills", "experience", None, None, None]


def test_sections(spark):
    texts = [
        "intro\nSkills\na\nEducation\nb\nSkills\nc",
        "Skills\nEducation\nb",
        "no header at all",
    ]

    def both(c):
        cut = X.sections(c, CANDIDATE_SECTIONS)
        return F.concat_ws(
            "|",
            X.section_or(cut, "skills", F.lit("WHOLE")),
            X.section_or(cut, "education", F.lit("WHOLE")),
        )

    assert apply(spark, both, texts) == ["a\nc|b", "|b", "WHOLE|WHOLE"]


def test_distinct_keeps_first_spelling_and_order(spark):
    row = spark.sql("SELECT array('b', 'A', 'B', 'a', 'c', '--', 'C ') AS v").select(
        X.distinct_ignoring_case(F.col("v")), X.distinct_terms(F.col("v"))
    ).first()
    assert row[0] == ["b", "A", "c", "--", "C "]
    assert row[1] == ["b", "A", "c"]


def test_matching_and_missing_terms(spark):
    df = spark.sql("SELECT array('sql', 'Power-BI') AS have, array('Power BI', 'AWS', 'SQL') AS need")
    keys, need = X.term_keys(F.col("have")), X.keyed_terms(F.col("need"))
    row = df.select(X.matching_terms(keys, need), X.missing_terms(keys, need)).first()
    assert list(row) == [["Power BI", "SQL"], ["AWS"]]


def test_bind_is_not_inlined_into_loops(spark):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(5)).alias("v"))
    doubled = X.bind(F.transform("v", lambda x: x * 2), lambda d: F.transform(d, lambda x: x + F.size(d)))
    assert df.select(doubled.alias("x")).first().x == [7, 9, 11, 13, 15]


def test_blanks_collapse_in_one_evaluation(spark):
    texts = ["", " \n\u2003", " a\t\u00a0b\n", "a", "a\u2028", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(X.collapse_whitespace(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == [" ", " ", "a b", "a", "a", None]
    # A condition would have the text cut twice.
    assert "CASE" not in df._jdf.queryExecution().optimizedPlan().toString()
