"""Every pipeline stage against a plain version on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from rankloom.llm import mixing
from rankloom.llm.queries import LANGUAGES, language_labels
from rankloom.llm.tables import written
from tests.llm.test_decontaminate import plain
from tests.llm.test_simhash import plain_classes, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """[(name, input rows, output)] of the whole pipeline."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), "stage")
        found.append((name, docs, out))
        docs = out
    return found


def test_stages_in_order_keep_the_columns(stages):
    assert [n for n, _, _ in stages] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination",
        "mixing sources to target weights", "token-ID / binary output",
    ]
    first = stages[0][1].columns
    assert all(out.columns == first for _, _, out in stages[:-1])


def test_quality_rejects_junk_only(spark, sf_dir, stages):
    _, before, after = stages[0]
    gone = {r.doc_id for r in before.select("doc_id").subtract(after.select("doc_id")).collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    junk = {d for d, q in quality.items() if q == 0}
    assert junk and not any(quality.get(d) == 1 for d in gone) and len(junk - gone) <= 0.2 * len(junk)


def test_near_copies_equal_all_pairs_of_fingerprints(stages):
    _, before, after = stages[1]
    classes = plain_classes([(r.doc_id, plain_fingerprint(r.text)) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({least for _, _, least in classes})
    assert after.count() < before.count()


def test_leaks_equal_plain_windows(spark, sf_dir, stages):
    _, before, after = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in before.collect() if plain(r.text, items)[1] == 0]
    assert sorted(r.doc_id for r in after.collect()) == sorted(clean)
    assert len(clean) < before.count()


def test_mixture_keeps_all_and_reaches_its_weights(spark, sf_dir, stages):
    _, before, after = stages[3]
    labels = language_labels(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rate = {r.doc_id: r.rate for r in mixing.rates(before, labels, LANGUAGES, least_rate=1.0).collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert set(copies) == set(rate)
    assert all(int(rate[d]) <= n <= int(rate[d]) + 1 for d, n in copies.items())
    tokens = Counter()
    for r in after.collect():
        tokens[r.lang] += len(r.text.split())
    assert all(abs(tokens[d] / sum(tokens.values()) - w) < 0.05 for d, w in LANGUAGES.items())


def test_shards_hold_every_document(stages):
    _, before, index = stages[4]
    rows = index.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {d for r in rows for d in r.doc_ids} == {r.doc_id for r in before.collect()}


def test_pipeline_query_runs_the_stages(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).columns == stages[-1][2].columns
