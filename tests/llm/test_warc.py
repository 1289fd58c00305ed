"""WARC round trips: payloads byte for byte, revisits, segments, odd rows."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from check_queries import compare
from rankloom.llm import warc


def test_query_equals_sql(spark, sf_dir):
    assert compare(spark, "op9_warc_round_trip", sf_dir).startswith("ok")


def awkward():
    random.seed(8)
    parts = ["\r\n\r\n", "\r\n", "\r", "\n", "WARC/1.1\r\n", "é", "Content-Length: 5\r\n\r\n", "x" * 40, "\x00", "日"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(150)]
    texts += ["y\r\n\r\n" * n for n in range(6)] + ["\r\n" * n for n in range(9)] + [None, "", "z" * 5000, "é\r\n" * 3000]
    return [(i, f"http://h/{i}", t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("segment", [7, 1000, warc.SEGMENT])
def test_payloads_come_back_byte_for_byte(spark, tmp_path, segment):
    pages = spark.createDataFrame(awkward(), "page_id bigint, url string, html string").repartition(3)
    path = warc.write_warc(warc.with_revisits(pages, least=1 << 40), f"file://{tmp_path}/a", segment)
    got = {}
    for r in sorted(warc.read_warc(spark, path).collect(), key=lambda r: (r.page_id, r.chunk)):
        body = got.setdefault(r.page_id, b"") + bytes(r.data)
        got[r.page_id] = body
        assert r.bytes_so_far == len(body) and r.digest_so_far == hashlib.sha1(body).hexdigest()
        assert len(r.data) <= segment and (not r.last or r.payload_bytes == len(body))
    assert got == {i: (t or "").encode() for i, _, t in awkward()}


def test_archives_are_valid_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://h/\r\nX: y", "body"), (2, None, "b" * 30)], "page_id bigint, url string, html string").coalesce(1)
    warc.write_warc(warc.with_revisits(pages), f"file://{tmp_path}/a", 20)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(tmp_path.glob("a/part-*")))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"\r\n\r\n")
    assert raw.count(b"WARC-Type: continuation") == 1 and b"WARC-Segment-Total-Length: " in raw
    assert b"WARC-Target-URI: http://h/%0D%0AX: y\r\n" in raw


def test_revisits_and_odd_rows(spark, tmp_path):
    long, other = "a" * 1000, "b" * 1000
    rows = [(1, long), (7, long), (3, long), (4, "short"), (5, "short"), (None, long), (6, None), (8, ""), (9, other), (9, other), (None, other * 2), (None, other * 2)]
    pages = spark.createDataFrame([(i, None, t) for i, t in rows], "page_id bigint, url string, html string").withColumn("kept", F.lit("clash"))
    path = warc.write_warc(warc.with_revisits(pages), f"file://{tmp_path}/a")
    got = sorted(map(tuple, warc.payload_summary(warc.read_warc(spark, path)).collect()), key=repr)
    def row(i, text, refers=None):
        body = (text or "").encode()
        return (i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers else "response", refers)
    refer = {1: 7, 3: 7}
    want = [row(i, t, 7 if i is None and t == long else refer.get(i)) for i, t in rows]
    assert got == sorted(want, key=repr)


def plain_records(raw):
    """A parser by the published grammar: version, named fields, a block of the given length, two breaks."""
    at, out = 0, []
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].split(b"\r\n")
        fields = dict(line.decode().split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        block = raw[end + 4 : end + 4 + size]
        at = end + 4 + size
        assert version == b"WARC/1.1" and raw[at : at + 4] == b"\r\n\r\n"
        at += 4
        out.append((fields, block))
    return out


def test_records_have_what_the_format_asks_for(spark, tmp_path):
    rows = [(1, "http://h/1", "a" * 1500), (2, "http://h/2", "a" * 1500), (3, None, None), (4, "http://h/4", "é" * 900)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    warc.write_warc(warc.with_revisits(pages), f"file://{tmp_path}/a", 700, "2024-05-06T07:08:09Z")
    records = plain_records(b"".join(gzip.decompress(p.read_bytes()) for p in sorted(tmp_path.glob("a/part-*"))))
    bodies = {}
    for fields, block in records:
        assert {"WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length"} <= set(fields) and fields["WARC-Date"] == "2024-05-06T07:08:09Z"
        assert fields["WARC-Block-Digest"] == "sha1:" + hashlib.sha1(block).hexdigest()
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Profile"].startswith("http://netpreserve.org/warc/1.1/revisit/") and not block
        elif fields["WARC-Type"] == "response":
            assert fields["Content-Type"] == "application/http; msgtype=response"
            head, _, body = block.partition(b"\r\n\r\n")
            assert head.startswith(b"HTTP/1.1 200 OK")
            bodies[fields["WARC-Record-ID"]] = body
        else:
            bodies[fields["WARC-Segment-Origin-ID"]] += block
    assert bodies == {f"<urn:page:{i}>": (t or "").encode() for i, _, t in rows if i != 1}


def test_a_flipped_byte_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://h", "first " * 50), (2, "http://h", "second " * 50)], "page_id bigint, url string, html string").coalesce(1)
    warc.write_warc(warc.with_revisits(pages), f"file://{tmp_path}/a")
    file = next(tmp_path.glob("a/part-*"))
    raw = gzip.decompress(file.read_bytes())
    (tmp_path / "b").mkdir()
    (tmp_path / "b/part-0.txt.gz").write_bytes(gzip.compress(raw.replace(b"second second", b"sfcond second", 1)))
    assert warc.payload_summary(warc.read_warc(spark, f"file://{tmp_path}/a")).count() == 2
    with pytest.raises(Exception, match="digest"):
        warc.payload_summary(warc.read_warc(spark, f"file://{tmp_path}/b")).collect()


def test_a_revisit_is_resolved_by_what_is_read_back(spark, tmp_path):
    body = "a" * 1000
    pages = spark.createDataFrame([(1, None, body), (7, None, body)], "page_id bigint, url string, html string")
    chunks = warc.read_warc(spark, warc.write_warc(warc.with_revisits(pages), f"file://{tmp_path}/a"))
    digest = hashlib.sha1(body.encode()).hexdigest()
    assert sorted(map(tuple, warc.payload_summary(chunks).collect())) == [(1, 1000, digest, "revisit", 7), (7, 1000, digest, "response", None)]
    alone = warc.payload_summary(chunks.where("page_id = 1")).collect()
    assert [tuple(r) for r in alone] == [(1, None, None, "revisit", 7)]


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    path = warc.write_warc(warc.with_revisits(pages), f"file://{tmp_path}/a")
    assert warc.payload_summary(warc.read_warc(spark, path)).count() == 0
