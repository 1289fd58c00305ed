"""Token shards: permutation, exact round trip, resumed reads."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rankloom.llm import shards
from rankloom.llm.queries import RANKS

PATH = public_tokenizers.path(RANKS)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000, 4096, 4097, 100_003])
def test_permutation_is_a_bijection(size):
    slots = shards.permute(np.arange(size), size, 42)
    assert sorted(slots.tolist()) == list(range(size))
    again = shards.permute(np.arange(size)[::-1], size, 42)[::-1]
    assert (slots == again).all()
    if size > 100:
        assert (slots != shards.permute(np.arange(size), size, 43)).any()
        assert abs(np.corrcoef(np.arange(size), slots)[0, 1]) < 0.1


def encoder():
    with open(PATH, "rb") as file:
        return shards._encoder(file.read(), public_tokenizers.PATTERN)


def rebuilt(index, sequences):
    """{doc_id: [ids]} from the index rows and the records by slot."""
    ids = {}
    for row in index:
        tokens = sequences[row.slot][: row.n_tokens].tolist()
        for doc, begin, end in zip(row.doc_ids, row.starts, [*row.starts[1:], row.n_tokens]):
            ids.setdefault(doc, []).append((row.slot, tokens[begin:end]))
    return ids


@pytest.mark.parametrize("length", [8, 64])
def test_round_trip_and_resume(spark, tmp_path, length):
    texts = {i: f"Document {i} says: " + "word café 日本 \x00 " * (i % 37) for i in range(200)} | {500: None, 501: "", 502: "x" * 4000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").withColumn("slot", F.lit("clash")).repartition(3)
    path = f"file://{tmp_path}/out"
    index, layout = shards.write_shards(docs, path, PATH, public_tokenizers.PATTERN, length=length, shard_bytes=2000)
    rows = index.collect()
    assert sorted(r.slot for r in rows) == list(range(layout.sequences)) and layout.shards > 3
    read = shards.read_from(spark, path).collect()
    assert [s for s, _ in read] == list(range(layout.sequences))
    sequences = dict(read)
    tail = shards.read_from(spark, path, layout.sequences // 2 + 1).collect()
    assert [s for s, _ in tail] == list(range(layout.sequences // 2 + 1, layout.sequences))
    assert all((a == sequences[s]).all() for s, a in tail)
    # Pieces of a document lie in sequences of consecutive numbers.
    number = {int(s): i for i, s in enumerate(shards.permute(np.arange(layout.sequences), layout.sequences, layout.key))}
    tool = encoder()
    for doc, parts in rebuilt(rows, sequences).items():
        ids = [t for _, part in sorted(parts, key=lambda p: number[p[0]]) for t in part]
        assert ids == [*tool.encode_ordinary(texts[doc] or ""), shards.END]
    assert {d for r in rows for d in r.doc_ids} == set(texts)
    for r in rows:
        assert r.shard == r.slot // layout.per_shard and r.byte_offset == r.slot % layout.per_shard * layout.stride
    files = sorted((tmp_path / "out/shards").glob("part-*"))
    assert [f.stat().st_size for f in files[:-1]] == [layout.per_shard * layout.stride] * (layout.shards - 1)
    raw = np.frombuffer(files[1].read_bytes(), "<u2").reshape(-1, length + 1)
    assert (raw[0, :length] == sequences[layout.per_shard]).all() and (raw[:, length] == 0x0A0A).all()


def test_shards_are_read_by_number():
    files = [f"file:/x/part-{i:05d}-b0a1-c000.txt" for i in (0, 7, 99_998, 99_999, 100_000, 100_001, 1_000_000)]
    assert shards.in_shard_order(sorted(files)) == files and sorted(files) != files


def test_a_missing_shard_is_an_error(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * 50) for i in range(50)], "doc_id bigint, text string")
    _, layout = shards.write_shards(docs, f"file://{tmp_path}/a", PATH, public_tokenizers.PATTERN, length=64, shard_bytes=2000)
    assert layout.shards > 2
    next((tmp_path / "a/shards").glob("part-00001*")).unlink()
    with pytest.raises(ValueError, match="shard files"):
        shards.read_from(spark, f"file://{tmp_path}/a")


def test_repeated_and_missing_ids_and_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string").coalesce(1)
    index, layout = shards.write_shards(docs, f"file://{tmp_path}/a", PATH, public_tokenizers.PATTERN)
    assert [r.doc_ids for r in index.collect()] == [[1, 1, None]] and layout.sequences == 1
    index, layout = shards.write_shards(docs.limit(0), f"file://{tmp_path}/b", PATH, public_tokenizers.PATTERN)
    assert index.count() == 0 and layout.shards == 0
    assert shards.read_from(spark, f"file://{tmp_path}/b").collect() == []
