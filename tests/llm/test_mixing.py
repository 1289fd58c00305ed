"""Mixing against a plain classifier and plain projected gradient."""

import math

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from rankloom.llm import mixing
from rankloom.llm.queries import LANGUAGES, language_labels, op2_mixing_rates


def words_of(text):
    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())



def signed_bucket(word):
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    return (h - (1 << 64) if h >> 63 else h) % mixing.BUCKETS


def plain_posteriors(docs, labels, domains):
    counts = np.ones((mixing.BUCKETS, len(domains)))
    prior = np.ones(len(domains))
    for doc, domain in set(labels):
        for i, text in docs:
            if i == doc and domain in domains:
                k = domains.index(domain)
                prior[k] += 1
                for w in words_of(text):
                    counts[signed_bucket(w), k] += 1
    logs = np.log(counts / counts.sum(axis=0))
    base = np.log(prior / prior.sum())
    out = []
    for _, text in docs:
        words = words_of(text)
        scale = min(1.0, mixing.EVIDENCE / max(1, len(words)))
        s = base + scale * sum((logs[signed_bucket(w)] for w in words), np.zeros(len(domains)))
        e = np.exp(s - s.max())
        out.append(e / e.sum())
    return np.array(out)


def plain_rates(n, p, wanted, least, steps=mixing.STEPS):
    rate, present = np.ones(len(n)), n @ p
    for _ in range(steps):
        now = (n * rate) @ p
        if abs(now - wanted).max() <= mixing.TOLERANCE * wanted.sum():
            break
        rate = np.maximum(least, rate - p @ np.where(present > 0, (now - wanted) / np.where(present > 0, present, 1), 0))
    return rate


def test_query_equals_plain_version(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in table.collect()]
    labels = [tuple(r) for r in language_labels(table, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()]
    domains = list(LANGUAGES)
    p = plain_posteriors(docs, labels, domains)
    n = np.array([len((t or "").split()) for _, t in docs], float)
    wanted = n.sum() * np.array([LANGUAGES[d] for d in domains])
    rate = plain_rates(n, p, wanted, 0.0)
    got = {r.doc_id: r for r in op2_mixing_rates(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for (i, _), size, x, r in zip(docs, n, p, rate, strict=True):
        assert got[i].n_tokens == size
        assert [got[i][f"p_{d}"] for d in domains] == pytest.approx(x, abs=1e-6)
        assert got[i].rate == pytest.approx(r, abs=1e-5)
    assert (n * rate) @ p == pytest.approx(wanted, rel=1e-3)


def test_query_is_native(spark, sf_dir):
    plan = op2_mixing_rates(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("least", [0.0, 0.5])
def test_soft_members_and_unreachable_targets(spark, least):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.3, 0.5], 300)
    n = rng.integers(1, 50, 300)
    rows = [(i, i, 1, int(n[i]), p[i].tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id bigint, text_key bigint, copies bigint, n_tokens bigint, p array<double>")
    for targets in ({"a": 1.0, "b": 1.0, "c": 2.0}, {"a": 1.0, "b": 0.0, "c": 0.0}):
        budget = float(n.sum())
        moves, reached = mixing.fit_rates(table, targets, budget, least)
        wanted = budget * np.array(list(targets.values())) / sum(targets.values())
        rate = plain_rates(n.astype(float), p, wanted, least)
        got = [r[0] for r in table.orderBy("doc_id").select(mixing._rate(F.col("p"), moves, least)).collect()]
        assert got == pytest.approx(rate, abs=1e-6) and min(got) >= least
        assert [t for _, t in reached.values()] == pytest.approx((n * rate) @ p, rel=1e-6)


def test_copies_follow_rates(spark):
    texts = {"en": "the cat and the dog run", "fr": "le chat et le chien courent"}
    rows = [(i, f"{texts[l]} {i}", l) for i, l in enumerate(["en"] * 90 + ["fr"] * 10)]
    rows += [(200, None, "en"), (201, "", "fr"), (None, "le chat", None), (5, rows[5][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("mix_id", F.lit("clash"))
    labels = docs.select("doc_id", F.col("lang").alias("domain"))
    mixed = mixing.mix(docs, labels, {"en": 0.5, "fr": 0.5}, least_rate=1.0)
    assert mixed.columns == docs.columns
    got = mixed.collect()
    ids = [r.doc_id for r in got]
    assert set(ids) == {r[0] for r in rows}
    tokens = {l: sum(len((r.text or "").split()) for r in got if r.lang == l) for l in texts}
    assert abs(tokens["en"] / tokens["fr"] - 1) < 0.1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7), labels, {"en": 0.5, "fr": 0.5}, least_rate=1.0).collect()))


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, domain string")
    got = mixing.rates(docs, labels, {"x": 0.7, "y": 0.3}).collect()
    assert all(r.p == pytest.approx([0.5, 0.5]) and math.isfinite(r.rate) for r in got)
    assert mixing.rates(docs.limit(0), labels, {"x": 0.7, "y": 0.3}).count() == 0
    assert mixing.mix(docs.limit(0), labels, {"x": 1.0}).count() == 0
