"""Neighbour search against all inner products."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from check_queries import compare
from rankloom.llm.neighbours import Quantised, nearest, products, search_tile


def plain(rows, k):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    rows = [(i, v) for i, v in rows if i is not None and good(v)]
    scored = {}
    for q, a in rows:
        for i, b in rows:
            if q % 5 == 0 and i != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b, strict=True):
                    total += x * y
                scored.setdefault(q, []).append((-total, i))
    return sorted((q, r, i, -s) for q, x in scored.items() for r, (s, i) in enumerate(sorted(x)[:k], 1))


def found(df, k, **settings):
    return sorted(map(tuple, nearest(df, F.col("vec_id") % 5 == 0, k, **settings).collect()))


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, "op3_nearest_neighbours", sf_dir).startswith("ok")


@pytest.mark.parametrize("block_bytes", [1, 1 << 24])
def test_equals_all_pairs_with_ties_copies_and_odd_rows(spark, block_bytes):
    random.seed(6)
    rows = [(i, [random.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    rows += [(i, rows[10][1]) for i in range(600, 900)]  # a large group of equal vectors
    rows += [(i, [x * 10.0 ** random.randint(-30, 30) for x in rows[i % 50][1]]) for i in range(900, 960)]
    rows += [(960, None), (965, []), (970, [0.0] * 8), (975, [math.nan] + [1.0] * 7), (980, [math.inf] + [1.0] * 7)]
    rows += [(985, [None] + [1.0] * 7), (990, [1.0, 2.0]), (991, [3.0, 1.0]), (None, [1.0] * 8), (5, rows[5][1]), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash"))
    got = found(df, 7, block_bytes=block_bytes)
    want = plain(rows, 7)
    assert got == want


def test_fewer_candidates_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (5, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert found(df, 20) == [(0, 1, 1, 0.5), (0, 2, 5, 0.0), (5, 1, 1, 0.5), (5, 2, 0, 0.0)]
    assert found(df.limit(0), 20) == []


def test_bounds_hold_and_prune():
    random.seed(1)
    a = np.random.default_rng(1).normal(size=(400, 64))
    q = Quantised(a)
    near = products(q, q) * q.scale[:, None] * q.scale
    reach = q.error[:, None] * q.norm + (q.norm + q.error)[:, None] * q.error
    assert (np.abs(near - a @ a.T) <= reach + 1e-9).all()
    assert (reach < 0.05 * np.outer(q.norm, q.norm)).all()
    frame = pd.DataFrame({"id": np.arange(400), "vector": list(a)})
    heaps = search_tile(frame[:3], frame, 5)
    assert [[-i for _, i in h] for h in heaps] == [
        [i for i in np.lexsort((np.arange(400), -(a @ a[q]))) if i != q][:5] for q in range(3)
    ]
