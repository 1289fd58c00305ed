"""Malformed records, incremental folder reads, and encoders loaded once a worker."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators.similarity import encode, hashing_encoder
from rankloom.sources.checked import changed_files, read_changed, read_checked
from rankloom.sources.files import manifest


def folder(tmp_path, name, **files):
    path = tmp_path / name
    path.mkdir()
    for file, text in files.items():
        (path / f"{file}.txt").write_text(text)
    return f"file://{path}"


@pytest.mark.parametrize(
    ("kind", "lines", "bad"),
    [
        ("csv", ["1,a,2.5", "x,a,1", "2,b", "3,c,1,9", "4,,1", ",d,1"], {"x,a,1": "malformed", "2,b": "malformed", "3,c,1,9": "malformed", ",d,1.0": "incomplete"}),
        ("json", ['{"i":1,"t":"a","v":2.5}', '{"i":"x"}', '{"i":2,', "[]", '{"t":"d"}', '{"i":4}'], {'{"i":"x"}': "malformed", '{"i":2,': "malformed", "[]": None, '{"t":"d"}': "incomplete"}),
    ],
)
def test_both_sides_of_a_read(spark, tmp_path, kind, lines, bad):
    path = folder(tmp_path, kind, one="\n".join(lines[:3]), two="\n".join(lines[3:]))
    accepted, rejects = read_checked(spark, path, "i int, t string, v double", kind, ("i",))
    assert accepted.columns == ["i", "t", "v"] and sorted(r.i for r in accepted.collect()) == [1, 4]
    # Counts that ask for no column judge the records alike.
    assert accepted.count() == 2 and rejects.select(F.lit(1)).count() == rejects.count()
    found = {r.record: r.reason for r in rejects.collect()}
    assert {k: v for k, v in found.items() if k in bad and bad[k]} == {k: v for k, v in bad.items() if v}
    assert {r.source.rsplit("/", 1)[1] for r in rejects.collect()} == {"one.txt", "two.txt"}


def test_only_changed_files_are_read(spark, tmp_path):
    path, manifests = folder(tmp_path, "in", a="one", b="two"), f"file://{tmp_path}/manifests"
    read = lambda: {r.doc_id.rsplit("/", 1)[1]: r.text for r in read_changed(spark, path, manifests).collect()}
    assert read() == {"a.txt": "one", "b.txt": "two"}
    assert read() == {}
    known = manifest(spark, path, "*.txt").collect()
    (tmp_path / "in/b.txt").write_text("two more")
    (tmp_path / "in/c.txt").write_text("three")
    (tmp_path / "in/e.txt").write_text("")
    (tmp_path / "in/d.txt").write_bytes(b"\xff\xfe caf\xe9")
    os.utime(tmp_path / "in/a.txt", (1, 1))
    assert read() == {"a.txt": "one", "b.txt": "two more", "c.txt": "three", "d.txt": None}
    assert read() == {} and len(known) == 2
    assert changed_files(spark, path, "*.txt", None).count() == 4


def test_an_encoder_is_loaded_once_a_worker(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        with open(log, "a") as file:
            file.write(f"{os.getpid()}\n")
        return hashing_encoder(16)

    df = spark.range(400).select(F.concat(F.lit("word "), F.col("id").cast("string")).alias("text")).repartition(24)
    for _ in range(2):
        rows = encode(df, "text", load, name="logged", kind="double").collect()
    pids = open(log).read().split()
    assert len(rows) == 400 and 1 <= len(pids) == len(set(pids)) <= 24
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-12 for r in rows)
