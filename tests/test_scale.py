"""What moves and what is looked up, for the steps that must grow no faster than their input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from rankloom.functions import dictionary as D
from rankloom.functions import text as X
from rankloom.functions.vectors import dense_cosine
from rankloom.operators import dictionary as match
from rankloom.operators import similarity
from rankloom.operators.encoding import numbered
from rankloom.operators.lines import carried
from rankloom.plans import market, market_queries
from tests.test_queries import plan_of

TEXTS = ["The Apache License of the de la.", "les the,the of  the", "of the. the-", "", None, "xde la de la le"]
TERMS = ("Apache License", "The", "of the", "de la", "le")


def test_short_and_long_lists_find_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    short = [r[0] for r in df.select(D.dictionary_terms(F.col("text"), TERMS)).collect()]
    monkeypatch.setattr(D, "FEW_TERMS", 0)
    assert [r[0] for r in df.select(D.dictionary_terms(F.col("text"), TERMS)).collect()] == short
    monkeypatch.setattr(D, "STARTS", 0)
    assert [r[0] for r in df.select(D.dictionary_terms(F.col("text"), TERMS)).collect()] == short
    assert short == [["Apache License", "The", "of the"], ["The"], [], [], None, ["de la", "le"]]


def test_overlapping_phrases_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(D, "FEW_TERMS", 0)
    df = spark.createDataFrame([("a a a b, a b c",)], "text string")
    assert df.select(D.dictionary_terms(F.col("text"), ("A b c", "a a b", "c", "a a a", "b c d"))).first()[0] == ["A b c", "a a b", "c", "a a a"]


def test_term_classes_cut_no_text_into_runs(spark, sf_dir):
    assert "regexp_extract_all" not in plan_of(queries()["term_classes"](spark, sf_dir))


def test_long_lists_are_not_walked_for_every_text(spark):
    df = spark.createDataFrame([("t",)], "text string")
    terms = [f"word {i} Case" for i in range(2000)]
    plan = plan_of(df.select(D.dictionary_terms(F.col("text"), terms)))
    assert "array_intersect" not in plan


@pytest.mark.parametrize("rows", [0, 1000])
def test_lexicon_matches_are_the_same_on_either_way(spark, monkeypatch, rows):
    monkeypatch.setattr(match, "SET_ROWS", rows)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    lexicon = spark.createDataFrame([(t, i) for i, t in enumerate(TERMS)] + [("the", 9)], "term string, n int")
    got = {(r.doc_id, r.term, r.n) for r in match.match_dictionary(docs, lexicon).collect()}
    assert got == {(0, "Apache License", 0), (0, "The", 1), (0, "the", 9), (0, "of the", 2), (1, "The", 1), (1, "the", 9), (5, "de la", 3), (5, "le", 4)}


def test_tasks_emit_phrases_of_the_lexicon_alone():
    found = match.PhraseSet(["the", "of the", "never here"]).found("out of the  house, the of")
    assert sorted(found) == ["of the", "the"]


@pytest.mark.parametrize("small", [True, False])
def test_matched_and_missing_by_number_and_by_key(spark, monkeypatch, small):
    monkeypatch.setattr(market_queries, "is_small", lambda df: small)
    own = spark.createDataFrame([("1", ["b", "x", "a"]), ("2", [])], "candidate_id string, keys array<string>")
    asked = spark.createDataFrame([("j", ["A", "B", "C"], ["C", "A"]), ("k", [], [])], "job_id string, w array<string>, r array<string>")
    asked = asked.select("job_id", X.keyed_terms(F.col("w")).alias("wanted"), X.keyed_terms(F.col("r")).alias("required"))
    pairs = own.select("candidate_id").crossJoin(asked.select("job_id"))
    got = sorted(tuple(r) for r in market_queries.matched_and_missing_terms(pairs, own, asked).collect())
    assert got == [("1", "j", "A, B", "C", 3), ("1", "k", "", "", 0), ("2", "j", "", "C, A", 3), ("2", "k", "", "", 0)]


def test_numbers_keep_order_and_nulls(spark):
    df = spark.createDataFrame([(1, ["c", "q", "a"]), (2, None), (3, [])], "i int, t array<string>")
    assert [r.t for r in numbered(df, ["a", "b", "c"], ["t"]).orderBy("i").collect()] == [[2, 0], None, []]


def test_only_lines_that_tell_something_are_joined(spark, sf_dir):
    assert "GreaterThanOrEqual(l_quantity,25.0)" in plan_of(market.customer_facts(spark, sf_dir))


def test_dense_similarity_in_tiles_equals_the_join(spark, monkeypatch):
    monkeypatch.setattr(similarity, "TILE_CANDIDATES", 7)
    monkeypatch.setattr(similarity, "TILE_JOBS", 3)
    rng = np.random.default_rng(1)
    rows = [(str(i), rng.normal(size=5).tolist()) for i in range(30)]
    rows += [("1", [1.0] * 5), ("z", [0.0] * 5), ("n", None), ("h", [None] * 5), ("s", [1.0, 2.0]), (None, [1.0] * 5)]
    mine = spark.createDataFrame(rows, "candidate_id string, embedding array<double>")
    theirs = mine.withColumnRenamed("candidate_id", "job_id")
    pairs = mine.select("candidate_id").crossJoin(theirs.select("job_id")).distinct()
    plain = pairs.join(mine.withColumnRenamed("embedding", "m"), "candidate_id").join(theirs.withColumnRenamed("embedding", "t"), "job_id")
    plain = plain.select("candidate_id", "job_id", dense_cosine(F.col("m"), F.col("t")).alias("s"))
    found = similarity.pair_similarity(pairs, mine, theirs)
    order = lambda df: sorted((r[0], r[1], -1.0 if r[2] is None else r[2]) for r in df.collect())
    assert "FlatMapCoGroupsInArrow" in plan_of(found)
    got, expected = order(found), order(plain)
    assert len(got) == len(expected) and [g[:2] for g in got] == [e[:2] for e in expected]
    assert all(g[2] == pytest.approx(e[2]) for g, e in zip(got, expected, strict=True))


def test_lines_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(line):
        made.add(1)
        return line

    lines = spark.range(40).select(F.lit("d").alias("doc_id"), F.col("id").alias("pos"), F.col("id").cast("string").alias("line"))
    label = F.when(seen(F.col("line")) == "3", F.lit("three"))
    got = carried(lines, label, parts=3).orderBy("pos").collect()
    assert [r.label for r in got] == [None] * 3 + ["three"] * 37
    assert made.value == 40
