"""The risk estimator, held-out accuracy on labels never learned from, and defined results."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankloom.llm import toxicity as t
from rankloom.llm.queries import op12_toxicity
from rankloom.llm.words import text_bytes


def area(score, label):
    """Chance that a toxic document scores higher than a clean one."""
    score, label = np.asarray(score), np.asarray(label)
    toxic, clean = score[label == 1], score[label == 0]
    return ((toxic[:, None] > clean).mean() + (toxic[:, None] >= clean).mean()) / 2


def test_held_out_rows_are_those_of_the_checksum(spark):
    got = {r.id: r.h for r in spark.range(50).select("id", t.held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}
    assert spark.sql("SELECT CAST(NULL AS BIGINT) id").select(t.held_out(F.col("id")).alias("h")).first().h is False


def test_query_ranks_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = op12_toxicity(spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert area([r.score for r in rows], [r.toxic for r in rows]) > 0.93
    clean = [r.predicted for r in rows if r.toxic == 0]
    toxic = [r.predicted for r in rows if r.toxic == 1]
    assert sum(clean) < 0.06 * len(clean) and sum(toxic) > 0.75 * len(toxic)


def synthetic(count, prior, seed):
    """Feature lists in which buckets 0 to 9 mark the positives."""
    rng = np.random.default_rng(seed)
    label = rng.random(count) < prior
    lists = []
    for toxic in label:
        noise = rng.integers(100, 3000, 40)
        lists.append(np.unique(np.concatenate([noise, rng.integers(0, 10, 3)] if toxic else [noise])).tolist())
    return pa.array(lists, pa.list_(pa.int32())), label


def test_unlabelled_positives_are_told_from_negatives():
    lists, label = synthetic(4000, 0.15, 1)
    positive, _ = synthetic(600, 1.1, 2)
    model = t.train(t.Rows.of(positive), t.Rows.of(lists), 0.15)
    rows = t.Rows.of(lists)
    score = t.logistic(model.logits(*rows.take(np.arange(4000)), 4000))
    assert area(score, label) > 0.99
    # Positives hide among the unlabelled, yet the scores are near the truth, not near the prior.
    assert score[label].mean() > 0.6 and score[~label].mean() < 0.1


def test_negative_risk_does_not_fall_below_zero():
    """Few positives and many features of chance: without the correction the fit runs away."""
    lists, _ = synthetic(300, 0.5, 3)
    positive, _ = synthetic(60, 1.1, 4)
    model = t.train(t.Rows.of(positive), t.Rows.of(lists), 0.5)
    u, p = t.Rows.of(lists), t.Rows.of(positive)
    zu, zp = (model.logits(*r.take(np.arange(len(r.sizes))), len(r.sizes)) for r in (u, p))
    assert np.logaddexp(0, zu).mean() - 0.5 * np.logaddexp(0, zp).mean() > -0.1


def test_features_equal_plain_features():
    texts = ["Word word wo x", "", "Ärger b", "word"]
    doc, bucket = t.features(*text_bytes(pa.array(texts)))
    found = [set(bucket[doc == i].tolist()) for i in range(4)]
    # "word" has its beginnings of 3, 4 and 5 bytes, the last two alike in bytes but not in length.
    assert len(found[3]) == 4 and found[3] <= found[0] and not found[1]
    assert len(found[0]) == 4 + 2 * 4


@pytest.mark.parametrize("toxic", [1, 0])
def test_defined_results(spark, toxic):
    rows = [(i, f"plain words about day {i} and the weather") for i in range(60)]
    rows += [(100 + i, f"you vile fool of day {i}") for i in range(30)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "z" * 300_000), (204, "vile fool " * 100_000), (None, rows[60][1]), (100, rows[60][1])]
    marks = [(i, 0) for i in range(40)] + [(100 + i, toxic) for i in range(30)] + [(100, 0), (None, 1), (3, None), (999, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash")).withColumn("positive", F.lit(1))
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int").withColumn("text", F.lit("clash"))
    model = t.fit(docs, labels)
    got = t.score_toxicity(docs, model)
    assert got.columns == ["doc_id", "score"] and got.count() == len(rows)
    found = got.collect()
    assert all(r.score is not None and 0 <= r.score <= 1 for r in found)
    if toxic:
        by_id = {r.doc_id: r.score for r in found}
        assert min(by_id[100 + i] for i in range(30)) > max(by_id[i] for i in range(60))
        assert by_id[200] == by_id[201] == by_id[202] and by_id[None] == by_id[100] == by_id[204] or by_id[204] > 0.3
    else:
        assert model is None and {r.score for r in found} == {0.0}
    assert t.score_toxicity(docs.limit(0), model).count() == 0
    assert t.fit(docs.limit(0), labels) is None and t.fit(docs, labels.limit(0)) is None


def test_a_fit_is_the_same_again(spark):
    rows = [(i, f"plain words about day {i}") for i in range(60)] + [(100 + i, f"you vile fool of day {i}") for i in range(30)]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows], "doc_id bigint, toxic int")
    fits = [t.fit(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(n), labels) for n in (1, 5)]
    assert np.array_equal(fits[0].weights, fits[1].weights) and fits[0].bias == fits[1].bias
