"""Field extraction on literal texts."""

import pytest
from pyspark.sql import functions as F

from rankloom.functions import patterns as P
from rankloom.functions.dictionary import dictionary_terms, keyword_coverage
from rankloom.operators.records import parse_candidates, parse_jobs
from tests.test_text import apply

RESUME = """
    Lena van Brandt
    lena.brandt@harbour.example | (030) 5550 1177

    About
    Writes booking software; 7 years of experience with ships and ports.

    Technical Skills
    Java, PostgreSQL, Docker, Git, Deep Learning

    Academic Background
    B.Tech Naval Engineering, Delft College | 2012

    Licenses
    Google Cloud Engineer - Harbour Board, 2019

    Selected Projects
    Berth Planning Dashboard
    A Java front end over PostgreSQL for berth times

    Professional Experience
    Developer at Quayside Works 2016 - 2020
    Intern at Saltmarsh 2014 - 2016
    """

JOB = """
    Port Systems Developer

    Must have skills
    Java, Docker, Git, React

    Nice to have
    Azure, TypeScript

    Education requirements
    Bachelor degree in Shipping or Logistics

    Certification requirements
    Scrum certificate welcome

    Key responsibilities
    - Keep the berth plan running

    Minimum qualifications
    - 3+ years of writing booking software
    """


def documents(spark, *texts):
    return spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string"
    )


def test_candidate_record(spark):
    got = parse_candidates(documents(spark, RESUME), as_of_year=2026).first().asDict(True)
    assert got["name"] == "Lena Van Brandt"
    assert got["email"] == "lena.brandt@harbour.example"
    assert got["phone"] == "(030) 5550 1177"
    assert got["skills"] == ["Deep Learning", "Docker", "Git", "Java", "PostgreSQL"]
    assert got["education"] == [
        {"degree": "B.Tech Naval Engineering", "institution": "Delft College", "year": "2012"}
    ]
    assert got["certifications"] == [
        {"name": "Google Cloud Engineer", "issuer": "Harbour Board", "year": "2019"}
    ]
    assert got["projects"] == [
        {
            "name": "Berth Planning Dashboard",
            "description": "A Java front end over PostgreSQL for berth times",
            "technologies": ["Java", "PostgreSQL"],
        }
    ]
    assert got["years_of_experience"] == 7.0
    assert got["experience"] == [
        "Developer at Quayside Works 2016 - 2020", "Intern at Saltmarsh 2014 - 2016"
    ]


def test_job_record(spark):
    got = parse_jobs(documents(spark, JOB)).first().asDict(True)
    assert got["title"] == "Port Systems Developer"
    assert got["required_skills"] == ["Docker", "Git", "Java", "React"]
    assert got["preferred_skills"] == ["Azure", "TypeScript"]
    assert got["education"] == ["Bachelor degree in Shipping or Logistics"]
    assert got["years_of_experience"] == 3.0
    assert got["certifications"] == ["Scrum certificate welcome"]
    assert got["programming_languages"] == ["Java", "TypeScript"]
    assert got["frameworks"] == ["React"]
    assert got["tools"] == ["Azure", "Docker", "Git"]
    assert got["responsibilities"] == ["Keep the berth plan running"]
    assert got["qualifications"] == ["3+ years of writing booking software"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Ring +49 89 555 0142 today", "+49 89 555 0142"),
        ("(020) 7946 0958 | London", "(020) 7946 0958"),
        ("a 8.196.197.208 b", "8.196.197.208"),
        ("id 12345678901234567890", ""),
        ("x 555-1234 y", ""),
    ],
)
def test_phone(spark, text, expected):
    assert apply(spark, P.phone, [text]) == [expected]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("5 years of experience, 3.5 yrs experience", 5.0),
        ("4+ years of sea travel experience", 0.0),
        ("2015 - 2018; 2019 – Present", 7.0),
        ("2020 - 2018", 0.0),
        ("no years", 0.0),
    ],
)
def test_candidate_years(spark, text, expected):
    assert apply(spark, lambda c: P.candidate_years(c, 2026), [text]) == [expected]


def test_job_years(spark):
    assert apply(spark, P.job_years, ["4+ years of sea travel", "x"]) == [4.0, 0.0]


def test_year_needs_word_edges(spark):
    assert apply(spark, P.year_in, ["in 1999.", "a2020", "20201", "é2010", "3019 2005"]) == [
        "1999", "", "", "", "2005"
    ]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Built with Python.", []),
        ("Python, SQL", ["Python", "SQL"]),
        ("Python-based", []),
        ("C#/Java", ["Java"]),
        ("JavaScript", ["JavaScript"]),
        ("machine\nlearning, deep  learning", []),
        ("natural language processing and MACHINE LEARNING", ["Machine Learning", "Natural Language Processing"]),
        ("éJava", ["Java"]),
    ],
)
def test_dictionary_boundaries(spark, text, found):
    from rankloom.vocabulary import CANDIDATE_SKILLS

    assert apply(spark, lambda c: dictionary_terms(c, CANDIDATE_SKILLS), [text]) == [found]


def test_dictionary_terms_outside_the_class(spark):
    terms = ("CI/CD", "a  b", "Go")
    assert apply(spark, lambda c: dictionary_terms(c, terms), ["go ci/cd a  b", "xci/cd a b"]) == [
        ["CI/CD", "a  b", "Go"], []
    ]


def test_long_text_without_punctuation(spark):
    text = "plain words " * 30_000 + "deep learning"
    assert apply(spark, lambda c: dictionary_terms(c, ("Deep Learning", "SQL")), [text]) == [["Deep Learning"]]


def test_dictionary_equals_regular_expressions(spark, sf_dir):
    import re

    terms = ("the", "of the", "apache license", "version 2.0", "le", "de la", "that")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "text", dictionary_terms(F.col("text"), terms).alias("found")
    ).collect()
    edge = "[A-Za-z0-9+#.-]"
    for row in rows:
        lowered = row.text.lower()
        expected = [
            t for t in terms if re.search(rf"(?<!{edge}){re.escape(t)}(?!{edge})", lowered)
        ]
        assert row.found == expected


def test_keyword_coverage(spark):
    assert apply(spark, lambda c: keyword_coverage(c, ["SQL", "sql", "--", "Go"]), ["SQL"]) == [0.5]
    assert apply(spark, lambda c: keyword_coverage(c, []), ["SQL"]) == [0.0]


def test_names(spark):
    texts = [
        "Resume\njane  van dyke\nx",
        "jane@x.org\n555 123 45678\nSkills List\nMary-Ann O'Neil",
        "one two three four five",
    ] + ["x\n" * 8 + "Late Name"]
    assert apply(spark, P.person_name, texts) == ["Jane Van Dyke", "Mary-Ann O'Neil", "", ""]


def test_degrees_are_prefixes_in_resumes(spark):
    got = apply(spark, P.education, ["Member of the board\nMBA, Yale | 2001\nmba, Other"])[0]
    assert [(e.degree, e.institution, e.year) for e in got] == [
        ("Member of the board", "", ""), ("MBA", "Yale", "2001")
    ]


def test_job_degrees_are_words(spark):
    assert apply(spark, P.job_education, ["must be able. Ph.D. or B.E. x\nMember"]) == [
        ["be able", "Ph.D", "B.E"]
    ]


def test_certification_cues(spark):
    got = apply(spark, P.certifications, ["Certifications\nScrum | Alliance 2020\nawsome\nSCRUM | b"])[0]
    assert [(c.name, c.issuer, c.year) for c in got] == [("Scrum", "Alliance", "2020")]
    lines = apply(spark, P.job_certifications, ["Certification\n- Security+x, CISSP.\nsecurity+ only"])
    assert lines == [["Certification", "Security+x, CISSP"]]


def test_projects_headed_and_loose(spark):
    headed = "lost line without heading here ok now\nData Platform:\n- used AWS, SQL\nBig Idea\nmore text that goes on and on"
    loose = "we ran a pipeline with Python for years."
    got = apply(spark, P.projects, [headed, loose, ""])
    assert [(p.name, p.description, p.technologies) for p in got[0]] == [
        ("Data Platform", "used AWS, SQL", ["SQL", "AWS"]),
        ("Big Idea", "more text that goes on and on", []),
    ]
    assert [(p.name, p.description, p.technologies) for p in got[1]] == [(loose, "", ["Python"])]
    assert got[2] == []


def test_experience_lines(spark):
    text = "Experience\n- Lead at X\nlead at x\nteam 2019 – present\nleader of men"
    assert apply(spark, P.experience, [text]) == [["Lead at X", "team 2019 – present"]]


def test_title(spark):
    assert apply(spark, P.job_title, ["\nRequirements:\n - Head of Data: \nx", ""]) == ["Head of Data", ""]
