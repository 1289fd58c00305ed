"""Similarity, pair features, ranking, confidence and reviews."""

import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rankloom.functions import vectors as V
from rankloom.functions.dictionary import dictionary_terms
from rankloom.operators import review as R
from rankloom.operators.dictionary import match_dictionary
from rankloom.operators.features import pair_features
from rankloom.operators.joins import is_small, lookup_join
from rankloom.operators.labels import exact_holdout, fold, target_score, with_target
from rankloom.operators.pairs import assign, unknown_pairs
from rankloom.operators.ranking import (
    CONFIDENCE,
    SCORE,
    confidence,
    name_or_stem,
    rank_all,
    rank_top,
    rankings,
    round_half_even,
    score_by_formula,
)
from rankloom.operators.records import parse_jobs
from rankloom.operators.similarity import encode, pair_similarity, top_matches, vectorize, visited_postings
from rankloom.schemas import CANDIDATE_FIELDS, FEATURE_COLUMNS, ddl

PAIR_JOB = """
    Warehouse Developer

    Requirements
    Java, Docker, Git, Linux

    Nice to have
    React

    Education requirements
    Doctorate in any field

    Certification requirements
    Scrum certificate welcome

    Languages
    Java, Bash

    Libraries and frameworks
    React, Flask

    Platforms and tools
    Docker, Git, Jenkins, Linux

    Minimum qualifications
    - 8+ years of warehouse work
    """


@pytest.fixture(scope="module")
def one_pair(spark):
    candidates = spark.createDataFrame(
        [
            (
                "cv/w7.txt", "Otto Wendt", "otto@depot.example", "030 5550 1178",
                ["Java", "Docker", "React", "Excel"],
                [("Ph.D Logistics", "Depot College", "2004")], [],
                [("Scrum certificate welcome", "", "")],
                [("Shelf Scanner", "ran docker and linux boxes for java code", ["Java"])],
                6.0, "",
            )
        ],
        ddl(CANDIDATE_FIELDS),
    )
    jobs = parse_jobs(spark.createDataFrame([("jobs/j1.txt", PAIR_JOB)], "doc_id string, text string"))
    return candidates, jobs


def test_all_features_of_one_pair(spark, one_pair):
    candidates, jobs = one_pair
    given = spark.createDataFrame(
        [("cv/w7.txt", "jobs/j1.txt", 0.5)], "candidate_id string, job_id string, semantic_similarity double"
    )
    got = pair_features(assign(candidates, ["jobs/j1.txt"]), candidates, jobs, similarity=given)
    assert got.columns == ["candidate_id", "job_id", *FEATURE_COLUMNS]
    row = got.withColumn("target", target_score()).first().asDict()
    assert row["semantic_similarity"] == 0.5
    # Java, Docker and React of Java, Docker, Git, Linux and React.
    assert row["skill_match_percentage"] == 0.6
    assert row["experience_match_score"] == 0.75
    assert row["education_match_score"] == 1.0
    assert row["certification_match_score"] == 1.0
    # Java, Docker and Linux of the five skills, Flask and Jenkins.
    assert row["project_relevance_score"] == pytest.approx(3 / 7)
    assert row["programming_language_match"] == 0.5
    assert row["framework_match"] == 0.5
    assert row["tools_match"] == 0.25
    assert row["years_of_experience_difference"] == 2.0
    assert row["number_of_matching_skills"] == 2.0
    assert row["total_candidate_skills"] == 4.0
    assert row["target"] == pytest.approx(
        100 * (0.40 * 0.5 + 0.20 * 0.6 + 0.15 * 0.75 + 0.10 + 0.05 + 0.05 * 0.5 + 0.03 * 0.5 + 0.02 * 0.25)
    )


def test_pair_similarity_from_dense_vectors(spark, one_pair):
    candidates, jobs = one_pair
    mine = candidates.select("candidate_id", F.array(F.lit(3.0), F.lit(4.0)).alias("embedding"))
    theirs = jobs.select("job_id", F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"))
    pairs = assign(candidates, ["jobs/j1.txt"])
    similarity = pair_similarity(pairs, mine, theirs)
    assert similarity.first().semantic_similarity == pytest.approx(0.6)
    scored = pair_features(pairs, candidates, jobs, similarity=similarity).first()
    assert scored.semantic_similarity == pytest.approx(0.6)


def test_features_are_the_same_when_jobs_are_not_small(spark, sf_dir, monkeypatch):
    from rankloom.plans.market_queries import features

    small = features(spark, sf_dir).toPandas()
    monkeypatch.setattr("rankloom.operators.features.is_small", lambda *a, **k: False)
    shuffled = features(spark, sf_dir).toPandas()
    keys = ["candidate_id", "job_id"]
    assert len(small) > 500
    assert small.sort_values(keys).reset_index(drop=True).equals(
        shuffled.sort_values(keys).reset_index(drop=True)
    )


def test_texts_to_compare(spark, one_pair):
    candidates, jobs = one_pair
    text = candidates.select(V.candidate_text()).first()[0]
    assert text == (
        "Otto Wendt Java Docker React Excel Ph.D Logistics Depot College  "
        "Scrum certificate welcome  Shelf Scanner ran docker and linux boxes for java code Java 6.0"
    )
    job = jobs.select(V.job_text(), "raw_text").first()
    assert job[0].startswith("Warehouse Developer Docker Git Linux Java React Doctorate")
    assert " 8.0 Scrum certificate welcome " in job[0]
    assert job[0].endswith(job[1])


@pytest.mark.parametrize(
    ("a", "b", "cosine"),
    [
        ([1.0, 0.0], [0.5, 0.5], 0.70710678),
        ([1.0, 0.0], [-1.0, 0.0], 0.0),
        ([0.0, 0.0], [1.0, 2.0], 0.0),
        ([0.3, 0.4], [0.3, 0.4], 1.0),
    ],
)
def test_dense_cosine(spark, a, b, cosine):
    df = spark.createDataFrame([(a, b)], "a array<float>, b array<float>")
    assert df.select(V.dense_cosine(F.col("a"), F.col("b"))).first()[0] == pytest.approx(cosine)


def test_sparse_cosine_equals_counting(spark):
    df = spark.createDataFrame([("A b b c", "b C c d"), ("", "x")], "a string, b string")
    pair = df.select(
        V.sparse_cosine(V.term_map(F.col("a")), V.term_map(F.col("b"))).alias("s")
    ).collect()
    assert pair[0].s == pytest.approx((2 * 1 + 1 * 2) / (math.sqrt(6) * math.sqrt(6)))
    assert pair[1].s == 0.0


def test_encoder_is_normalised_and_gets_whole_texts(spark):
    def load():
        return lambda texts: np.array([[float(len(t)), 0.0, 3.0] for t in texts])

    df = spark.createDataFrame([("a  b\n c " * 500,), ("",)], "text string")
    got = [r.embedding for r in encode(df, "text", load).collect()]
    assert got[0][0] == pytest.approx(2999 / math.hypot(2999, 3))
    assert np.linalg.norm(got[1]) == pytest.approx(1.0)


def _vectors(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    candidates = vectorize(docs, "doc_id", "text").withColumnRenamed("doc_id", "candidate_id")
    profiles = vectorize(items, "item_id", "text").withColumnRenamed("item_id", "job_id")
    return candidates, profiles


def _plain_scores(candidates, profiles):
    """(job, candidate) -> score by counting, for all pairs."""
    def vectors(df, key):
        return {r[key]: {e["term"]: float(e["tf"]) for e in r["vector"]} for r in df.collect()}

    mine, theirs = vectors(candidates, "candidate_id"), vectors(profiles, "job_id")
    scores = {}
    for job, wanted in theirs.items():
        for candidate, held in mine.items():
            shared = held.keys() & wanted.keys()
            norms = math.sqrt(sum(v * v for v in held.values())) * math.sqrt(sum(v * v for v in wanted.values()))
            cosine = sum(held[t] * wanted[t] for t in shared) / norms if norms else 0.0
            coverage = len(shared) / len(wanted) if wanted else 0.0
            scores[job, candidate] = 100 * (0.40 * cosine + 0.20 * coverage)
    return scores


@pytest.mark.parametrize(("postings", "rows"), [(50, 60), (200, 8192), (200_000, 8192)])
def test_top_matches_equal_counting_in_any_tiles(spark, sf_dir, postings, rows):
    candidates, profiles = _vectors(spark, sf_dir)
    profiles = profiles.where("job_id < 12")
    want = _plain_scores(candidates, profiles)
    got = {(r.job_id, r.candidate_id): r for r in top_matches(candidates, profiles, 7, postings, rows).collect()}
    assert len(got) == 7 * 12
    for job in range(12):
        best = sorted((-round(s, 9), c) for (j, c), s in want.items() if j == job)[:7]
        mine = sorted((r["rank"], -round(r.score, 9), c) for (j, c), r in got.items() if j == job)
        assert [(s, c) for _, s, c in mine] == best


def test_top_matches_leave_out_postings(spark):
    """Heavy terms set a threshold that candidates with light ones alone cannot reach."""
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(["core"] * 9 * (i % 10 == 0) + [f"w{x}" for x in rng.integers(0, 60, 12)])) for i in range(800)]
    items = [(i, " ".join(["core"] * 9 + [f"w{x}" for x in rng.choice(60, 20, replace=False)])) for i in range(10)]
    candidates = vectorize(spark.createDataFrame(docs, "candidate_id long, text string"), "candidate_id", "text")
    profiles = vectorize(spark.createDataFrame(items, "job_id long, text string"), "job_id", "text")
    want = _plain_scores(candidates, profiles)
    got = {(r.job_id, r.candidate_id) for r in top_matches(candidates, profiles, 5).collect()}
    for job in range(10):
        best = sorted((-round(s, 9), c) for (j, c), s in want.items() if j == job)[:5]
        assert {c for j, c in got if j == job} == {c for _, c in best}
    visits = visited_postings(candidates, profiles, 5).first()
    assert 0 < visits.touched < 0.7 * visits.seen


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "date"])
def test_top_matches_keep_the_type_of_ids_and_fill_up(spark, kind):
    docs = spark.createDataFrame([(3, "b c"), (1, "z"), (2, "y"), (9, "")], "candidate_id long, text string")
    jobs = spark.createDataFrame([("2001-01-01" if kind == "date" else "7", "b")], "job_id string, text string")
    jobs = jobs.withColumn("job_id", F.col("job_id").cast(kind))
    got = top_matches(vectorize(docs, "candidate_id", "text"), vectorize(jobs, "job_id", "text"), 3)
    assert got.schema["job_id"].dataType == jobs.schema["job_id"].dataType
    assert [(r.candidate_id, r.score > 0) for r in got.orderBy("rank").collect()] == [(3, True), (1, False), (2, False)]


def test_top_matches_with_ties_and_short_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        docs = spark.createDataFrame([(i, "same text") for i in range(20)] + [(99, "")], "candidate_id long, text string")
        jobs = spark.createDataFrame([("j", "same words")], "job_id string, text string")
        got = top_matches(
            vectorize(docs.repartition(3), "candidate_id", "text"), vectorize(jobs, "job_id", "text"), 4
        )
        assert sorted((r["rank"], r.candidate_id) for r in got.collect()) == [(1, 0), (2, 1), (3, 2), (4, 3)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_dictionary_join_equals_the_in_row_form(spark, sf_dir):
    """Terms of any number of words, with characters outside the class, in any case."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = [(10_001, "Natural Language Processing, C/C++ and a  b ; x/y. D\\E (q)"), (10_002, "daily c/c++x natural language"), (10_003, None)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    terms = ["The", "of the", "mit license", "de la", "natural language processing", "c/c++", "daily", "a  b", "D\\E", "(q)", ";", "licensed under the apache license, version 2.0"]
    lexicon = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, n int")
    got = {(r.doc_id, r.term) for r in match_dictionary(docs, lexicon).collect()}
    rows = docs.select("doc_id", F.explode(dictionary_terms(F.coalesce("text", F.lit("")), terms)).alias("term"))
    assert got == {(r.doc_id, r.term) for r in rows.collect()}
    assert {t for d, t in got if d == 10_001} == {"natural language processing", "c/c++", "a  b", "D\\E", "(q)", ";"}
    assert len(got) > 100
    with pytest.raises(ValueError, match="more than 2"):
        match_dictionary(docs, lexicon, words=2)


def test_lookup_join_is_the_same_on_either_way(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    right = spark.range(7).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    expected = sorted(left.join(right, "k").select("k", "id", "v").collect())
    for small in (None, True, False):
        assert sorted(lookup_join(left, right, "k", small).select("k", "id", "v").collect()) == expected


def test_size_is_measured_on_narrow_rows(spark):
    """The limit that ends the measuring passes on sizes, not the rows themselves."""
    df = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    assert [f.name for f in df.select(size.alias("b")).limit(11).schema] == ["b"]


def test_unknown_ids_are_listed(spark, one_pair):
    candidates, jobs = one_pair
    pairs = spark.createDataFrame(
        [("cv/w7.txt", "jobs/j1.txt"), ("nobody", "jobs/j1.txt"), ("cv/w7.txt", "nowhere"), ("nobody", "nowhere")],
        "candidate_id string, job_id string",
    )
    got = sorted(tuple(r) for r in unknown_pairs(pairs, candidates, jobs).collect())
    assert got == [
        ("cv/w7.txt", "nowhere", "unknown job"),
        ("nobody", "jobs/j1.txt", "unknown candidate"),
        ("nobody", "nowhere", "unknown candidate"),
    ]
    assert pair_features(pairs, candidates, jobs).count() == 1


def test_is_small_measures_rows_and_bytes(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert is_small(df)
    assert not is_small(df, max_rows=9)
    assert not is_small(df, max_bytes=900)


@pytest.mark.parametrize(
    ("votes", "expected"),
    [([50.0, 50.0], 100.0), ([40.0, 60.0], 70.0), ([0.0, 100.0], 0.0), ([70.0, 74.0, 78.0], 90.2020410)],
)
def test_confidence(spark, votes, expected):
    df = spark.createDataFrame([(votes,)], "v array<double>")
    assert df.select(confidence(F.col("v"))).first()[0] == pytest.approx(expected)


def test_ranking_breaks_ties_by_confidence_then_id(spark):
    rows = [("j", "c", 80.0, 70.0), ("j", "d", 10.0, 99.0), ("j", "b", 80.0, 90.0), ("j", "a", 80.0, 70.0)]
    df = spark.createDataFrame(rows, f"job_id string, candidate_id string, {SCORE} double, {CONFIDENCE} double")
    expected = [("b", 1), ("a", 2), ("c", 3), ("d", 4)]
    for ranked in (rank_all(df), rank_top(df, 10)):
        assert [(r.candidate_id, r["rank"]) for r in ranked.orderBy("rank").collect()] == expected
    assert rank_top(df, 2).count() == 2


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_full_ranking_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 11).cast("string")).alias("job_id"),
        F.col("id").cast("string").alias("candidate_id"),
        F.when(F.col("id") % 2 == 0, F.lit(50.0)).otherwise((F.col("id") % 97).cast("double")).alias(SCORE),
        F.lit(75.0).alias(CONFIDENCE),
    )
    got = {(r.job_id, r.candidate_id): r["rank"] for r in rank_all(df, partitions).collect()}
    want = {(r.job_id, r.candidate_id): r["rank"] for r in rank_top(df, 5000).collect()}
    assert got == want


def test_top_ranking_prunes_before_the_exchange(spark):
    df = spark.range(10).select(
        (F.col("id") % 2).alias("job_id"), F.col("id").alias("candidate_id"), F.rand(1).alias(SCORE), F.rand(2).alias(CONFIDENCE)
    )
    assert rank_top(df, 3)._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_output_columns_and_rounding(spark):
    df = spark.createDataFrame(
        [("j", 1, "A", "cv/a.txt", 0.12345, 0.125), ("j", 2, "", "cv/b.c.txt", 0.5, 1.0)],
        f"job_id string, rank int, candidate_name string, candidate_id string, semantic_similarity double, {SCORE} double",
    )
    row, nameless = rankings(df).collect()
    assert nameless.candidate_name == "b.c"
    assert row.asDict() == {
        "job_id": "j", "rank": 1, "candidate_name": "A",
        "similarity_score": float(np.round(0.12345, 4)), "predicted_score": 0.12,
    }
    values = [0.5, 2.675, 1.005, 33.335, 0.285]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(round_half_even(F.col("v"), 2)).collect()
    assert [r[0] for r in got] == [float(np.round(v, 2)) for v in values]


def test_two_decimals_format_like_the_exact_binary_value(spark):
    values = [0.125, 2.675, 40.625, 0.0, 0.005, 99.995, 1.005, 100.0, 12.345, 54.995, 0.015, 7.285, 3.1]
    values += [float(x) for x in np.random.default_rng(3).uniform(0, 100, 400)]
    values += [i / 8 + j / 100 for i in range(40) for j in (0, 5)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(R.two_decimals(F.col("v"))).collect()]
    assert got == [f"{v:.2f}" for v in values]


def test_name_or_stem(spark):
    df = spark.createDataFrame(
        [("Ada", "f:/x/a.pdf"), ("", "f:/x/b.c.pdf"), ("", "plain"), ("", "d/.hidden")], "n string, p string"
    )
    got = [r[0] for r in df.select(name_or_stem(F.col("n"), F.col("p"))).collect()]
    assert got == ["Ada", "b.c", "plain", ".hidden"]


def test_bands(spark):
    scores = [39.99, 40.0, 54.99, 55.0, 64.99, 65.0, 69.99, 70.0, 79.99, 80.0, 84.99, 85.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = df.select(R.assessment(F.col("s")), R.interview(F.col("s"))).collect()
    assert [r[0].split()[0] for r in got] == (
        ["Poor"] + ["Weak"] * 2 + ["Moderate"] * 4 + ["Strong"] * 4 + ["Excellent"]
    )
    assert [r[1] for r in got] == (
        ["Not Recommended"] * 2 + ["Consider"] * 3 + ["Recommended"] * 4 + ["Highly Recommended"] * 3
    )
    labels = spark.createDataFrame([(0.75,), (0.5,), (0.4999,)], "v double").select(R.score_label(F.col("v")))
    assert [r[0] for r in labels.collect()] == ["high", "moderate", "low"]


def test_inline_and_bullet_lists(spark):
    df = spark.sql("SELECT array('a','b','c') AS x, array('a','b','c','d','e') AS y, CAST(array() AS array<string>) AS z")
    row = df.select(*[R.inline_list(F.col(c)) for c in "xyz"], *[R.bullet_list(F.col(c)) for c in "xz"]).first()
    assert list(row) == ["a, b, c", "a, b, c, and 2 more", "", "- a\n- b\n- c", "None"]


def test_review_of_one_pair(spark):
    values = {
        "candidate_id": "r", "job_id": "j", "candidate_name": "Otto Wendt", "job_title": "Warehouse Developer",
        "skill_keys": ["python", "sql"], SCORE: 82.5,
        "has_education": False, "has_certification": False, "has_language": False,
        "has_framework": False, "has_tool": False,
        "semantic_similarity": 0.75, "skill_match_percentage": 2 / 3, "experience_match_score": 1.0,
        "education_match_score": 0.0, "certification_match_score": 0.0, "project_relevance_score": 0.5,
        "programming_language_match": 1.0, "framework_match": 0.0, "tools_match": 0.0,
        "years_of_experience_difference": 1.0, "number_of_matching_skills": 2.0, "total_candidate_skills": 2.0,
    }
    terms = [("python", "Python"), ("sql", "SQL"), ("aws", "AWS")]
    keyed = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(t).alias("term")) for k, t in terms])
    df = spark.createDataFrame([Row(**values)]).withColumns({"job_required": keyed, "job_wanted": keyed})
    row = R.review(df).first()
    assert row.assessment == "Strong Match"
    assert row.interview == "Highly Recommended"
    assert row.strengths == [
        "Strong semantic similarity with the job description",
        "High experience match for the role",
        "Good programming language match",
    ]
    assert row.weaknesses == ["Missing required skills: AWS"]
    assert row.recommendations == [
        "Add AWS if you have hands-on experience.",
        "Highlight projects that directly use the role's key skills.",
        "Move the most relevant skills into a clear skills section.",
    ]
    assert row.summary.endswith("Matched skills include Python, SQL. The main gaps are AWS.")
    report = R.reports(df).first().report
    for part in (
        "Resume Review Report\n====", "Candidate Name\nOtto Wendt", "Job Title\nWarehouse Developer",
        "Overall Candidate Score\n82.50", "Overall Assessment\nStrong Match", "Section 1\nSummary",
        "Section 5\nMissing Skills\n- AWS", "Skill Match: 66.67%", "Interview Recommendation\nHighly Recommended\n",
    ):
        assert part in report
    bare = df.withColumns({"candidate_name": F.lit(""), "candidate_id": F.lit("f:/in/cv_17.txt"), "job_title": F.lit(""), "job_id": F.lit("jobs/depot.md")})
    assert "Candidate Name\ncv_17\n\nJob Title\ndepot\n" in R.reports(bare).first().report


def test_exact_holdout_is_exact_and_stable(spark):
    df = spark.range(1003).select(F.col("id").alias("k"))
    first = {r.k for r in exact_holdout(df, ["k"]).where("is_test").collect()}
    again = {r.k for r in exact_holdout(df.repartition(5), ["k"], cells=7).where("is_test").collect()}
    assert len(first) == 201
    assert first == again
    folds = df.select(fold(["k"]).alias("f")).groupBy("f").count().collect()
    assert sorted(r.f for r in folds) == [0, 1, 2, 3, 4]


def test_noisy_labels_stay_in_bounds(spark):
    base = spark.range(2000).select(
        F.col("id").cast("string").alias("candidate_id"), F.lit("j").alias("job_id"),
        *[(F.col("id") % 2).cast("double").alias(c) for c in FEATURE_COLUMNS],
    )
    noise = with_target(base).withColumn("e", F.col("target_candidate_score") - target_score())
    low = noise.where("semantic_similarity = 0").agg(F.min("target_candidate_score"), F.max("e")).first()
    assert low[0] == 0.0 and 2.0 < low[1] < 12.0
    halves = with_target(base.withColumn("semantic_similarity", F.lit(0.5))).withColumn(
        "e", F.col("target_candidate_score") - 100 * 0.2
    )
    spread = halves.where("skill_match_percentage = 0").agg(F.avg("e"), F.stddev_pop("e")).first()
    assert abs(spread[0]) < 0.3 and spread[1] == pytest.approx(2.0, abs=0.2)


def test_formula_score_has_fixed_confidence(spark):
    df = spark.createDataFrame([tuple([2.0] * 12)], FEATURE_COLUMNS)
    row = score_by_formula(df).first()
    assert row[SCORE] == 100.0 and row[CONFIDENCE] == 75.0
