"""SimHash classes against all pairs, BK-tree searches, and the contract's fingerprints."""

import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from rankloom.llm import simhash
from rankloom.llm.queries import op10_simhash_near_dedup
from rankloom.llm.simhash import BKTree, Feature, exact_bands, keep_one, near_duplicates, near_links


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius=2):
    """Smallest id reachable, by comparing all pairs of fingerprints."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(enumerate(p for _, p in prints), 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((d, f"{p:016x}", least.get(root(i))) for i, (d, p) in enumerate(prints)), key=repr)


def test_query_equals_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, op10_simhash_near_dedup(spark, sf_dir).collect()), key=repr)
    assert got == plain_classes([(r.doc_id, plain_fingerprint(r.text)) for r in docs])


def test_hash_is_that_of_spark(spark):
    row = spark.sql("SELECT xxhash64('a bc déf') h").first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest("a bc déf".encode(), 42)


@pytest.mark.parametrize("shard", [2, 8, 1024])
def test_links_connect_what_all_pairs_connect(spark, shard):
    """Chains of one-bit steps and a cloud around one value, in shards cut to any size."""
    random.seed(5)
    centre = random.getrandbits(64)
    values = {centre}
    for _ in range(150):
        values.add(centre ^ sum(1 << b for b in random.sample(range(64), random.choice([1, 2, 3, 5]))))
    values |= {random.getrandbits(64) for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    nodes = spark.createDataFrame([([v],) for v in signed], "fp array<bigint>")
    links = near_links(nodes, exact_bands(2), 2, shard=shard).collect()
    assert all(((r.a[0] ^ r.b[0]) & (2**64 - 1)).bit_count() <= 2 for r in links)
    def classes(pairs):
        parent = {v: v for v in signed}
        def root(v):
            while parent[v] != v:
                v = parent[v]
            return v
        for a, b in pairs:
            parent[root(a)] = root(b)
        return len({root(v) for v in signed})
    near = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert classes((r.a[0], r.b[0]) for r in links) == classes(near)
    assert shard < 1024 or len(links) < 4 * len(signed)


def test_tree_finds_what_a_scan_finds():
    random.seed(1)
    values = [random.getrandbits(12) for _ in range(500)]
    tree = BKTree()
    for i, v in enumerate(values):
        tree.add(v, i)
    for q in values[:50]:
        assert sorted(tree.within(q, 2)) == [i for i, v in enumerate(values) if (q ^ v).bit_count() <= 2]


def test_odd_rows_have_defined_results(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "one"), (5, "x " * 50_000), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("clash"))
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=repr)
    assert len(got) == len(rows)
    assert {c for d, f, c in got if f == [0]} == {1}
    assert {c for d, f, c in got if d == 4} == {4}
    empty = near_duplicates(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "fp", "component_id"]


@pytest.mark.parametrize("few", [10**6, 0])
def test_keep_one_of_each_class(spark, monkeypatch, few):
    """Copies, small edits and repeated rows, with keys broadcast or shuffled."""
    monkeypatch.setattr(simhash, "FEW_KEYS", few)
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [random.choice(vocabulary) for _ in range(600)]
    rows = [(0, " ".join(base)), (1, " ".join(base))]
    for i in range(2, 30):
        copy = list(base)
        copy[random.randrange(600)] = f"new{i}"
        rows.append((i, " ".join(copy)))
    rows += [(i, " ".join(random.choice(vocabulary) for _ in range(200))) for i in range(100, 140)]
    rows += [(100, rows[30][1])] * 3 + [(None, "a text of its own"), (None, "a text of its own"), (None, None), (150, ""), (160, "  "), (160, "  ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept_id", F.lit(1)).withColumn("stays", F.lit(False)).withColumn("key_id", F.lit("x"))
    got = keep_one(docs)
    assert got.columns == docs.columns
    want = {c for _, _, c in plain_classes([(d, plain_fingerprint(t)) for d, t in rows])}
    ids = sorted((r.doc_id for r in got.collect()), key=repr)
    assert ids == sorted(want, key=repr) and 41 < len(ids) < 70
    assert keep_one(docs.limit(0)).count() == 0


def test_features_make_words_of_their_own():
    words = simhash.fingerprint(b"a b c d e f g", (Feature(2, 3, True),))
    assert len(set(words)) == 3
