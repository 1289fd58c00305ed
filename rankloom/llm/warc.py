"""WARC archives as a chunked record table.

Writing: each page is a record; its payload leaves the row in segments of ``SEGMENT`` bytes, the
first as a ``response`` record, the others as ``continuation`` records, so nothing after the page
row itself holds a whole payload. Every record is a text line ended by CR LF CR LF, written and
committed by Spark's own writer to any file system.

Reading: the archives become rows (record, segment, chunk, bytes, running length and digest). Each
file is read in order by one task as pieces between CR LF CR LF; a small reader follows the
declared lengths, hands payload on as it comes and carries the digest along. No step holds more
than a segment, whatever the record's size.

Payloads of at least ``LEAST_SHARED`` bytes that are equal are stored once, under the largest key;
the others are ``revisit`` records that name it. Equality is that of length, SHA-1 and a second
64-bit hash. Defined results: a null payload is empty; a null key or URL is written as an empty
header and read as null; rows that share the largest key are each a response; payloads of any length
are cut into segments; an empty table is an archive without records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.tables import written
from rankloom.operators.joins import is_small, lookup_join

END = b"\r\n\r\n"
SEGMENT = 1 << 20
LEAST_SHARED = 1000
#: Fixed values of the format.
VERSION = b"WARC/1.1"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Date of records whose pages have none.
EPOCH = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEY = "urn:page:"

RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, segment int, chunk int, data binary, bytes_so_far bigint, digest_so_far string, last boolean, payload_bytes bigint, payload_digest string"


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, payload, size, digest, refers_to): the rows to write.

    Only keys and digests are grouped. The table of shared digests is written and measured: a small
    one is broadcast, so that payloads are not shuffled; beyond the bound it meets them in an
    equi-join in which adaptive execution splits a digest that many pages share.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload"), "check": F.xxhash64("payload")})
    same = ["digest", "check", "size"]
    groups = rows.where(F.col("size") >= least).groupBy(*same)
    shared = groups.agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1 AND kept IS NOT NULL")
    found = lookup_join(rows, written(shared.drop("n"), "shared"), same, how="left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    return found.select("page_id", "url", "payload", "size", "digest", refers.alias("refers_to"))


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION] + [f"{name}: {value}".encode() for name, value in fields if value is not None]
    return b"\r\n".join(lines) + END


def _clean(url: str | None) -> str | None:
    """Control characters of a URL would break the header; they are percent-encoded."""
    if url is None:
        return None
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def records_of(page_id, url, payload: memoryview, size, digest, refers_to, segment: int, date: str = EPOCH) -> Iterator[bytes]:
    """The records of one page without their ends, one segment at a time."""
    key = "" if page_id is None else page_id
    common = [("WARC-Date", date), ("WARC-Target-URI", _clean(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", size)]
    if refers_to is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{_KEY}{key}>"), ("WARC-Refers-To", f"<{_KEY}{refers_to}>")]
        empty = f"sha1:{hashlib.sha1(b'').hexdigest()}"
        yield _header([*fields, *common, ("WARC-Profile", PROFILE), ("WARC-Block-Digest", empty), ("Content-Length", 0)])
        return
    count = max(1, -(-size // segment))
    for i in range(count):
        data = bytes(payload[i * segment : (i + 1) * segment])
        block = HTTP + data if i == 0 else data
        fields = [("WARC-Type", "response" if i == 0 else "continuation")]
        fields += [("WARC-Record-ID", f"<{_KEY}{key}>" if i == 0 else f"<{_KEY}{key}#{i + 1}>")]
        if i == 0:
            fields += [*common, ("Content-Type", "application/http; msgtype=response")]
        else:
            fields += [("WARC-Date", date), ("WARC-Segment-Origin-ID", f"<{_KEY}{key}>")]
        if count > 1:
            fields += [("WARC-Segment-Number", i + 1)]
            if i == count - 1:
                fields += [("WARC-Segment-Total-Length", size + len(HTTP))]
        fields += [("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"), ("Content-Length", len(block))]
        yield _header(fields) + block


def write_warc(rows: DataFrame, path: str, segment: int = SEGMENT, date: str = EPOCH) -> str:
    """Write the rows of ``with_revisits`` as compressed archives below ``path``, dated ``date``."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready, held = [], 0
            for i in range(batch.num_rows):
                page_id, url, _, size, digest, refers_to = (batch.column(j)[i].as_py() if j != 2 else None for j in range(6))
                payload = memoryview(batch.column(2)[i].as_buffer())
                for record in records_of(page_id, url, payload, size, digest, refers_to, segment, date):
                    ready.append(record)
                    held += len(record)
                    if held >= 4 * segment:
                        yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], names=["record"])
                        ready, held = [], 0
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(ready, pa.binary())], names=["record"])

    lines = rows.mapInArrow(segments, "record binary").select(F.col("record").cast("string").alias("value"))
    (
        lines.write.option("lineSep", END.decode())
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )
    return path


class RecordReader:
    """Follows archives as a stream of bytes and adds chunk rows to ``out``."""

    def __init__(self, out: list):
        self.out = out
        self.head = b""
        self.fields: dict[str, str] | None = None
        self.missing = 0
        self.tail = 0
        self.skip = 0
        self.page: dict = {}
        self.block = hashlib.sha1()

    def _key(self, name: str) -> int | None:
        text = self.fields.get(name, "").strip("<>").removeprefix(_KEY).partition("#")[0]
        return int(text) if text else None

    def feed(self, data: bytes) -> None:
        while data:
            if self.missing:
                block, data = data[: self.missing], data[self.missing :]
                self.missing -= len(block)
                self.block.update(block)
                self._payload(block)
                if not self.missing:
                    self._verify()
            elif self.tail:
                end, data = data[: self.tail], data[self.tail :]
                if END[-self.tail :][: len(end)] != end:
                    raise ValueError("a WARC record does not end where it says")
                self.tail -= len(end)
            else:
                self.head += data
                head, end, data = self.head.partition(END)
                if not end:
                    return
                self.head = b""
                # A file whose last payload ends in CR LF is cut two bytes early, which leaves an
                # end too many.
                if head:
                    self._begin(head)
                    self.tail = len(END)

    def between_records(self) -> bool:
        return not (self.missing or self.tail or self.head)

    def _begin(self, head: bytes) -> None:
        lines = head.split(b"\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
        self.fields = {}
        for line in lines[1:]:
            name, _, value = line.partition(b": ")
            self.fields[name.decode()] = value.decode()
        self.missing = int(self.fields["Content-Length"])
        kind = self.fields["WARC-Type"]
        if kind != "continuation":
            digest = self.fields["WARC-Payload-Digest"].removeprefix("sha1:")
            self.page = {
                "page_id": self._key("WARC-Record-ID"),
                "url": self.fields.get("WARC-Target-URI"),
                "record_type": kind,
                "refers_to": self._key("WARC-Refers-To"),
                "size": int(self.fields["X-Payload-Length"]),
                "digest": digest,
                "sha1": hashlib.sha1(),
                "bytes": 0,
                "chunk": 0,
            }
            self.skip = len(HTTP) if kind == "response" else 0
        self.block = hashlib.sha1()
        if not self.missing:
            self._verify()
        if kind == "revisit" or self.page["size"] == 0:
            self._row(b"", True)

    def _verify(self) -> None:
        """Every record's block has the digest of its header, a whole payload that of its first."""
        said = self.fields.get("WARC-Block-Digest", "")
        if said != f"sha1:{self.block.hexdigest()}":
            raise ValueError(f"the block of {self.fields['WARC-Record-ID']} does not have its digest")

    def _payload(self, data: bytes) -> None:
        cut = min(self.skip, len(data))
        self.skip -= cut
        if cut < len(data):
            data = data[cut:]
            self.page["sha1"].update(data)
            self.page["bytes"] += len(data)
            if self.page["bytes"] >= self.page["size"] and self.page["sha1"].hexdigest() != self.page["digest"]:
                raise ValueError(f"the payload of page {self.page['page_id']} does not have its digest")
            self._row(data, self.page["bytes"] == self.page["size"])

    def _row(self, data: bytes, last: bool) -> None:
        p = self.page
        whole = p["record_type"] == "revisit"
        segment = int(self.fields.get("WARC-Segment-Number", 1))
        self.out.append(
            (
                p["page_id"], p["url"], p["record_type"], p["refers_to"], segment, p["chunk"], data, p["bytes"],
                p["sha1"].hexdigest(), last,
                p["bytes"] if last and not whole else None,
                p["digest"] if whole else p["sha1"].hexdigest() if last else None,
            )
        )
        p["chunk"] += 1


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The chunk rows of all archives below ``path`` (see ``RECORDS``).

    ``digest_so_far`` and ``bytes_so_far`` run over a record's chunks; its last chunk also has the
    whole payload's length and digest. A revisit record is one empty last chunk with the digest that
    its header says. A block or payload without the digest of its header is an error.
    """
    pieces = spark.read.option("lineSep", END.decode()).text(path).select(F.col("value").cast("binary").alias("piece"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        reader = RecordReader(rows)
        held = 0
        for batch in batches:
            for value in batch.column(0):
                piece = value.as_py() + END
                reader.feed(piece)
                held += len(piece)
                if held >= 4 * SEGMENT:
                    yield _batch(rows)
                    rows.clear()
                    held = 0
        if not reader.between_records():
            raise ValueError("an archive ends inside a record")
        yield _batch(rows)

    return pieces.mapInArrow(chunks, RECORDS)


_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("segment", pa.int32()), ("chunk", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()),
        ("digest_so_far", pa.string()), ("last", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ]
)


def _batch(rows: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def payload_summary(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), one row for each record.

    Length and digest of a revisit are those of the response read back that it names; without one
    of the same digest in the archives they are null.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    records = written(chunks.where("last").select(*names), "records")
    revisits = records.where("record_type = 'revisit'")
    named = written(revisits.select(F.col("refers_to").alias("kept"), F.col("payload_digest").alias("kept_digest")).distinct(), "named")
    same = (F.col("page_id") == F.col("kept")) & (F.col("payload_digest") == F.col("kept_digest"))
    # One row for each response that revisits name: a few of the many records.
    small = is_small(named)
    wanted = F.broadcast(named) if small else named
    found = records.where("record_type = 'response'").join(wanted, same, "left_semi")
    heads = found.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("said")).agg(F.first("payload_bytes").alias("size"))
    asked = revisits.withColumnRenamed("payload_digest", "said").drop("payload_bytes")
    met = lookup_join(asked, heads, ["refers_to", "said"], small, "left")
    whole = met.select(
        "page_id", F.col("size").alias("payload_bytes"), F.when(F.col("size").isNotNull(), F.col("said")).alias("payload_digest"), "record_type", "refers_to"
    )
    return records.where("record_type <> 'revisit'").unionByName(whole)
