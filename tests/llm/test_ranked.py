"""Ranked search against scoring every document, with the index's bounds and its edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import ranked
from rankloom.llm.queries import op11_ranked_search

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    """All of the contract, document by document."""
    counted = [(d, Counter(ws), len(ws)) for d, t in docs if (ws := words(t))]
    n_docs, n_words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for d, c, n in counted:
            m, score = 100 - 50 + (50 * n * n_docs) // n_words, 0
            for t in terms & c.keys():
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score:
                scored.append((-score, d is None, d or 0))
        out += [(item, r, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_query_equals_scoring_every_document(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert rows(op11_ranked_search(spark, sf_dir)) == plain(docs, items, 50)


def test_topics_with_first_thresholds_from_a_slice(spark, monkeypatch):
    monkeypatch.setattr(ranked, "SEED_DOCS", 300)
    random.seed(4)
    topics = [[f"t{t}x{i}" for i in range(30)] for t in range(20)]
    docs = []
    for i in range(2000):
        topic = random.choice(topics)
        docs.append((i, " ".join(random.choices(topic, k=random.randrange(5, 60)) + ["the"] * 3)))
    items = [(i, " ".join([*random.sample(random.choice(topics), 6), "the"])) for i in range(30)]
    data = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id int, text string")
    assert rows(ranked.rank_documents(data, asked, 10)) == plain(docs, items, 10)
    queries = ranked.build_queries(ranked.item_terms(asked).collect())
    counts = ranked.term_counts(data, queries)
    weights = ranked.corpus_weights(counts, len(queries.lengths))
    assert min(ranked._first_floors(counts, queries, weights, 10)) > 1


def test_blocks_are_skipped_and_nothing_is_lost():
    """Terms that all topics share: blocks of other topics than the query's are not scored."""
    rng = np.random.default_rng(2)
    edges, terms = [0], []
    for _ in range(4000):
        topic = rng.integers(20)
        mine = 10 + topic * 30 + rng.choice(30, 12, replace=False)
        terms.append(np.sort(np.concatenate([rng.choice(10, 3, replace=False), mine])))
        edges.append(edges[-1] + 15)
    terms = np.concatenate(terms)
    impacts = rng.integers(900, 1100, len(terms))
    queries = [np.append(np.arange(10), 10 + topic * 30 + np.arange(20)) for topic in range(20)]
    shard, counts = ranked.Shard(np.array(edges), terms, impacts, ranked.Together(queries, 610)), [0, 0]
    for query in queries:
        asked = np.isin(np.arange(610), query).astype(np.int64)
        exact = shard.score(np.arange(4000), asked)
        docs, scores = shard.search(query, 10, 1, counts)
        least = np.sort(exact)[-10]
        assert sorted(docs) == np.flatnonzero(exact >= least).tolist() and (exact[docs] == scores).all()
    assert 0 < counts[1] < 0.5 * counts[0]


def test_bounds_hold_for_every_document_of_a_block():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 12, 300)
    terms = np.concatenate([np.sort(rng.choice(40, n, replace=False)) for n in sizes])
    shard = ranked.Shard(np.append(0, np.cumsum(sizes)), terms, rng.integers(1, 1000, len(terms)), ranked.Together([np.arange(40)], 40))
    for term in range(40):
        blocks = shard.blocks(term)
        assert sorted(blocks.docs) == sorted(shard.posted[shard.lists[term] : shard.lists[term + 1]])
        assert len(blocks.starts) > 1
        asked = (rng.random(40) < 0.3).astype(np.int64)
        bounds, scores = blocks.bounds(asked), shard.score(blocks.docs, asked)
        for b, (begin, end) in enumerate(zip(blocks.edges[:-1], blocks.edges[1:], strict=True)):
            assert bounds[b] >= scores[begin:end].max()


@pytest.mark.parametrize("limit", [ranked.QUERY_BYTES, 100])
def test_defined_results(spark, limit):
    same = "alpha beta gamma"
    docs = [(1, None), (2, ""), (3, " ?!"), (4, same), (4, same), (None, same), (5, "Alpha ÄB " * 50_000), (6, "Äb only"), (0, same)]
    items = [(7, "ALPHA beta"), (7, "äb Äb"), (8, None), (9, "..."), (None, "gamma"), (10, "nowhere")]
    data = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit("clash")).withColumn("n", F.lit(0))
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("term", F.lit("clash"))
    got = ranked.rank_documents(data, asked, 5, limit=limit)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == plain(docs, items, 5)
    assert [r.doc_id for r in got.where("item_id IS NULL").orderBy("rank").collect()] == [0, 4, 4, None]
    assert ranked.rank_documents(data.limit(0), asked).count() == 0
    assert ranked.rank_documents(data, asked.limit(0)).count() == 0
