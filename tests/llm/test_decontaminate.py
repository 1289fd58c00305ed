"""Decontamination against a plain window search."""

import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_queries import compare
from rankloom.llm import decontaminate as d
from rankloom.llm.queries import op4_decontamination


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, n=10):
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        size = min(n, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(item)
    return len(words), len(hit), sorted(found)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "short item"),
    (3, None),
    (4, ""),
    (5, "Äpfel und Birnen, Äpfel und Birnen"),
    (5, "repeated id with another text of its own"),
    (None, "no id here"),
    (6, "short item"),
]
TEXTS = [
    (1, "xx one, two; three four five SIX seven eight nine ten yy"),
    (2, "one two three four five six seven eight nine xx ten"),
    (3, "a Short\nitem? short short item item"),
    (4, None),
    (5, ""),
    (6, "äpfel und birnen Äpfel und Birnen äpfel"),
    (7, "no id here"),
    (None, "one two three four five six seven eight nine ten eleven twelve short item"),
    (8, "w " * 60_000 + "short item"),
    (3, "a Short\nitem? short short item item"),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string").withColumn("n_hit", F.lit("clash")).repartition(2)
    return docs, spark.createDataFrame(ITEMS, "item_id int, text string")


@pytest.mark.parametrize("limit", [1 << 20, 300])
def test_equals_plain_search_in_one_slice_or_several(tables, limit):
    docs, items = tables
    known = [i for i in ITEMS if i[0] is not None]
    got = d.contamination(docs, items, limit=limit).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == sorted(
        ((i, *plain(t, known)) for i, t in TEXTS), key=repr
    )
    texts = {i: t for i, t in TEXTS}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert sum(len(words_of(raw[s.begin : s.end].decode())) for s in r.spans) == r.n_hit


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, "op4_decontamination", sf_dir).startswith("ok")


@pytest.mark.parametrize("limit", [1 << 20, 300])
def test_removal(tables, limit):
    docs, items = tables
    kept = d.remove_documents(docs, items, limit=limit)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7]
    cut = {r.doc_id: r.text for r in d.remove_spans(docs, items, limit=limit).collect()}
    assert cut[1] == "xx \n\u2026\n yy" and cut[4] is None and cut[2] == TEXTS[1][1]
    assert all(plain(t, [i for i in ITEMS if i[0] is not None])[1] == 0 for t in cut.values())


LONG = [f"w{i}" for i in range(160)]
OVERLAPPING = [(i, " ".join(LONG[12 * i : 12 * i + 20])) for i in range(8)]


@pytest.mark.parametrize("few", [d.FEW_TEXTS, 0])
def test_slices_change_nothing(spark, monkeypatch, few):
    """Overlapping items over one and many slices: the same documents stay, the same text is left."""
    monkeypatch.setattr(d, "FEW_TEXTS", few)
    rows = [(1, " ".join(LONG)), (1, " ".join(LONG)), (2, " ".join(LONG[90:])), (3, "clean"), (None, None), (4, " ".join(LONG[:40]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("hit_spans", F.lit("clash"))
    items = spark.createDataFrame(OVERLAPPING, "item_id int, text string")
    results = []
    for limit in (1 << 20, 2000, 500):
        rows = [sorted(map(repr, f(docs, items, share=s, limit=limit).collect())) for f in (d.remove_documents, d.remove_spans) for s in (0.0, 0.5, 1.0)]
        results.append([*rows, sorted(map(repr, d.contamination(docs, items, limit=limit).collect()))])
    assert len(d.slices(d.benchmark_windows(items), 500)) > 10
    assert results[0] == results[1] == results[2]
    hit = plain(" ".join(LONG), OVERLAPPING)[1]
    assert 0.5 < hit / 160 < 1 and not any("doc_id=1" in r for r in results[0][1]) and len(results[0][1]) == 3


def test_empty_tables(tables):
    docs, items = tables
    assert d.contamination(docs.limit(0), items).count() == 0
    clean = d.contamination(docs, items.limit(0)).collect()
    assert len(clean) == len(TEXTS) and all(r.n_hit == 0 and r["items"] == [] for r in clean)


def test_items_without_id_count_in_the_query_and_the_pipeline(spark, sf_dir, tables, tmp_path):
    docs, items = tables
    docs = docs.drop("n_hit").where("doc_id IS NOT NULL AND doc_id <> 8")
    for name in os.listdir(sf_dir):
        if name not in ("documents.parquet", "benchmark.parquet"):
            os.symlink(f"{sf_dir}/{name}", tmp_path / name)
    for name, rows in (("documents", docs), ("benchmark", items)):
        pq.write_table(rows.toArrow(), tmp_path / f"{name}.parquet")
    got = {r.doc_id: r for r in op4_decontamination(spark, str(tmp_path)).collect()}
    assert got[7].contaminated and got[7].n_hit == 3 and got[7].n_items == 1
    assert not got[2].contaminated and got[1].n_items == 1
    assert compare(spark, "op4_decontamination", str(tmp_path)).startswith("ok")
    assert 7 not in {r.doc_id for r in corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).collect()}
    found = d.contamination(docs, items, limit=300, unnamed=True).where("doc_id = 7").first()
    assert found.n_hit == 3 and found["items"] == [None]
