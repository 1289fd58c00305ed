"""Label model on known votes, held-out labels, and defined results."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rankloom.llm import quality as q
from rankloom.llm.queries import op1_quality_classifier
from rankloom.llm.words import text_bytes


def test_expectation_maximisation_finds_known_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(40_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.7])
    cast = np.where(rng.random((40_000, 5)) < right, good[:, None], ~good[:, None]) * 2
    cast = np.where(rng.random((40_000, 5)) < 0.2, q.ABSTAIN, cast)
    patterns, counts = np.unique(q.pattern(cast), return_counts=True)
    model = q.fit_label_model(patterns, counts, 5)
    assert abs(model.good - 0.8) < 0.03
    assert np.abs(model.rates[1, :, q.GOOD] - right).max() < 0.03
    assert np.abs(model.rates[0, :, q.BAD] - right).max() < 0.05
    assert ((model.posterior(cast) > 0.5) == good).mean() > 0.95


def test_query_agrees_with_labels_it_never_saw(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = op1_quality_classifier(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = got.join(labels, "doc_id").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_expectation_maximisation_equals_a_plain_one():
    """A few votes, with the same first guess and rounds, labeller by labeller."""
    rng = np.random.default_rng(4)
    cast = rng.integers(0, 3, (300, 4))
    patterns, counts = np.unique(q.pattern(cast), return_counts=True)
    model = q.fit_label_model(patterns, counts, 4, rounds=7)
    good = [1 / (1 + np.exp(-(0.25 * sum(v == q.GOOD for v in row) - 3.0 * sum(v == q.BAD for v in row) + 0.5))) for row in cast]
    for _ in range(7):
        rate = {}
        for k in (0, 1):
            for j in range(4):
                held = {v: 1 + sum((g if k else 1 - g) for g, row in zip(good, cast, strict=True) if row[j] == v) for v in (q.BAD, q.GOOD)}
                rate[k, j] = {v: n / sum(held.values()) for v, n in held.items()}
        share = sum(good) / len(good)
        good = []
        for row in cast:
            odds = np.log(share / (1 - share)) + sum(np.log(rate[1, j][v] / rate[0, j][v]) for j, v in enumerate(row) if v != q.ABSTAIN)
            good.append(1 / (1 + np.exp(-odds)))
    assert np.allclose(model.posterior(cast), good) and abs(model.good - share) < 1e-9


def test_the_scorer_decides_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = q.score_documents(docs).collect()
    assert all(r.keep == (r.score >= q.KEEP) for r in rows) and 0 < sum(r.keep for r in rows) < len(rows)
    scorer = q.Scorer(q.LabelModel(np.full((2, 12, 3), 0.5), 0.5), np.zeros(q.BUCKETS), float(np.log(q.KEEP / (1 - q.KEEP))))
    score = scorer.judge(pa.array(["a tie at the threshold", ""]))[1]
    assert abs(score[0] - q.KEEP) < 1e-12 and score[1] == 0


def test_tokens_equal_plain_tokens():
    texts = ["A b!  b\n\tCafé 12", "", "x", " %%% ", "b a"]
    data, offsets = text_bytes(pa.array(texts))
    t = q.tokens(data, offsets)
    assert np.diff(t.first).tolist() == [len(x.split()) for x in texts]
    words = [w for x in texts for w in x.split()]
    assert t.length.tolist() == [len(w.encode()) for w in words]
    plain = ["".join(c for c in w.lower() if c.isalpha()) for w in words]
    for i, a in enumerate(plain):
        for j, b in enumerate(plain):
            assert (t.word[i] == t.word[j]) == (a == b)


def test_defined_results_and_all_columns(spark):
    good = "the cat sat on the mat and looked at the dog, then it went to the house. "
    rows = [(i, good * (1 + i % 3) + f"It was day {i} of the year.") for i in range(60)]
    rows += [(100 + i, " | ".join(["buy", "now", "click"] * 20)) for i in range(15)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "z" * 300_000), (None, rows[0][1]), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("keep", F.lit("clash"))
    scores = {r.doc_id: r for r in q.score_documents(docs).collect()}
    assert not scores[200].keep and not scores[201].keep and not scores[202].keep and scores[200].score == 0
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(range(60)) <= set(ids) and ids.count(1) == 2 and None in ids
    assert not set(ids) & set(range(100, 115))
    assert q.score_documents(docs.limit(0)).count() == 0 and q.keep_good(docs.limit(0)).count() == 0
