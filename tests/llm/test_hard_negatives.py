"""Hard negatives against all pairs, feasible ranges, and defined results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import hard_negatives as hn
from rankloom.llm.queries import op13_hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, shift=False):
    """All pairs: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    good = []
    for v, e, label in rows:
        if v is None or e is None or label is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        good.append((v, [int(np.floor(256 * x)) for x in e], (label + 1) % 10 if shift and v % 7 == 0 else label))
    anchors = {}
    for v, e, label in sorted(good, key=lambda r: (r[0], r[2], r[1])):
        if v % 100 == 0:
            anchors.setdefault(v, (e, label))
    out = []
    for a, (q, label) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(q, e, strict=True)), v, other) for v, e, other in good if v != a and len(e) == len(q))
        for s, p, other in [r for r in scored if r[2] == label][:5]:
            hard = [r for r in scored if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, p, n, r[1], -s, -r[0]) for n, r in enumerate(hard, 1)]
    return sorted(out)


def vectors(count, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, 8))
    return [
        (i, (centres[i % labels] * 0.5 + rng.normal(size=8) * rng.choice([0.3, 1.0, 2.0])).tolist(), int(rng.integers(labels)))
        for i in range(count)
    ]


def test_query_equals_all_pairs(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want = plain([(r.vec_id, r.embedding, r.label) for r in data], True)
    got = sorted(map(tuple, op13_hard_negatives(spark, sf_dir).collect()))
    assert want and got == want


@pytest.mark.parametrize("tile_bytes", [8 * 8 * 300, hn.TILE_BYTES])
def test_tiles_and_buckets_equal_all_pairs(spark, monkeypatch, tile_bytes):
    monkeypatch.setattr(hn, "BUCKET", 64)
    rows = vectors(1500, 3)
    random.Random(1).shuffle(rows)
    data = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hn.mine(data, F.col("id") % 100 == 0, F.col("label"), tile_bytes=tile_bytes)
    want = plain(rows)
    assert len(want) > 200 and sorted(map(tuple, got.collect())) == want


def test_feasible_rows_hold_all_that_reach_the_cosine_and_few_others():
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(2000, 16)) * 300).astype(np.int64)
    rows[:200] = rng.normal(size=16) * 300 + rng.normal(size=(200, 16)) * 60
    lengths = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
    bucket = hn.Bucket(np.arange(2000), np.zeros(2000, int), rows, lengths)
    q = rows[0] / lengths[0]
    cosines = rows @ q / lengths
    for least in (0.2, 0.6, 0.9, 0.99):
        found = bucket.feasible(q, np.argsort(-np.abs(q))[: hn.FOCUS], least)
        assert set(np.flatnonzero(cosines >= least)) <= set(found.tolist())
    assert len(found) < 300


def test_buckets_are_skipped():
    rng = np.random.default_rng(6)
    rows = (rng.normal(size=(5000, 16)) * rng.choice([20, 100, 500], 5000)[:, None]).astype(np.int64)
    block = hn.Block(np.arange(5000), np.zeros(5000, int), rows, 256)
    best = hn.Best(5)
    block.visit(rows[3], best.least, lambda b: b.ids != 3, best.add)
    exact = rows @ rows[3]
    exact[3] = -(2**62)
    assert best.scores.tolist() == sorted(exact.tolist(), reverse=True)[:5]
    assert block.scored < 2500 and block.seen < 5000


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (None, [9.0, 9.0], 1), (1, [1.0, 0.9], 1), (1, [1.0, 0.9], 1), (2, None, 1),
        (3, [nan, 1.0], 2), (4, [inf, 1.0], 2), (5, [None, 1.0], 2), (6, [1.0, 0.85], 2), (6, [1.0, 0.85], 2), (8, [1.0, 0.9], 2),
        (9, [0.0, 0.0], 2), (10, [5.0, 5.0], None), (11, [1.0], 2), (100, [0.0, 0.0], 2), (200, [-1.0, -1.0], 4), (201, [1.0, 1.0], 4),
        (300, [1.0], 2), (400, [], 3), (401, [], 3), (402, [], 5),
    ]
    data = spark.createDataFrame(rows, SCHEMA).withColumn("ID", F.lit("clash")).withColumn("rank", F.lit(1))
    got = hn.mine(data, F.col("id") % 100 == 0, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(rows)
    assert hn.mine(data.limit(0), F.col("id") % 100 == 0, F.col("label")).count() == 0
    assert hn.mine(data.where("vec_id = 1"), F.col("id") % 100 == 0, F.col("label")).count() == 0


def test_huge_components_are_exact():
    rows = np.array([[2**40, 3], [2**62, 2**62], [-(2**62), -(2**62)]])
    assert hn.products(rows, np.array([2**20 + 1, 5])).tolist() == [2**60 + 2**40 + 15, hn.LONG, -hn.LONG - 1]
