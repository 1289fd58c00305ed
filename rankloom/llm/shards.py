"""Token shards in training order.

Documents become token ids, each ended by END; a task packs its documents into sequences of
``length`` ids (its last one filled up with END). The sequences are written once; file number and
place give each a number from 0 to N - 1. A keyed Feistel network with cycle-walking permutes
these numbers: the result is the sequence's global slot. Slot // per_shard is its shard, a task of
its own, which sorts its slots and writes records of one fixed stride through Spark's text writer,
so any file system will do and a lost executor's shard is written again. Slot s stands in shard
s // per_shard at byte (s % per_shard) * stride; a reader resumes at any slot.

A record is ``length`` little-endian 16-bit ids and an end mark of two bytes. Defined results: a
null or empty text is a lone END; repeated rows each count; texts of any length run over as many
sequences as they need; an empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.tables import short_batches
from rankloom.session import scratch_path

LENGTH = 1024
SHARD_BYTES = 32 * 1024 * 1024
ROUNDS = 6
#: Files of the sequence table at most; one number for each of them reaches the driver.
FILES = 65_536
MARK = "\n\n"
END = 50_256
#: Payloads are compressed with a dictionary trained on about so many documents' sequences. It
#: only makes the written and shuffled rows smaller; the records don't depend on it.
DICTIONARY_DOCS = 2000
DICTIONARY_SEQUENCES = 4096
DICTIONARY_BYTES = 64 * 1024
LEVEL = 9


def permute(x: np.ndarray, size: int, key: int) -> np.ndarray:
    """The keyed bijection of 0..size-1 at the numbers ``x``."""
    if size <= 1:
        return x.copy()
    half = max(1, math.ceil((size - 1).bit_length() / 2))
    low = np.uint64((1 << half) - 1)
    keys = np.random.Generator(np.random.PCG64(key)).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)
    out = x.astype(np.uint64)
    walking = np.arange(len(out))
    # A number that lands beyond the domain is sent through again until it falls inside.
    while walking.size:
        left, right = out[walking] >> np.uint64(half), out[walking] & low
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(29)) & low)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """What a reader needs to know."""

    sequences: int
    length: int
    per_shard: int
    key: int

    @property
    def stride(self) -> int:
        return 2 * self.length + len(MARK)

    @property
    def shards(self) -> int:
        return math.ceil(self.sequences / self.per_shard)


_ENCODERS: list = []


def _encoder(ranks: bytes, pattern: str):
    """A tokenizer from its rank file, kept by the worker."""
    import tiktoken

    if not _ENCODERS or _ENCODERS[0] is not ranks:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        made = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        _ENCODERS[:] = [ranks, made]
    return _ENCODERS[1]


def payload_dictionary(docs: DataFrame, ranks: str, pattern: str, length: int = LENGTH, text: str = "text") -> bytes:
    """A compression dictionary from sequences of documents drawn by hash; empty for few rows."""
    share = min(1.0, DICTIONARY_DOCS / max(1, docs.count()))
    body = F.col(text).cast("string")
    drawn = docs.where(F.xxhash64(body, F.lit("dictionary")).cast("double") / F.lit(2.0**64) + 0.5 < share)
    plain = sequences(drawn.select(F.lit(0).alias("doc_id"), body.alias("text")), ranks, pattern, length)
    reader = zstandard.ZstdDecompressor()
    samples = [reader.decompress(r["payload"]) for r in plain.select("payload").limit(DICTIONARY_SEQUENCES).collect()]
    if len(samples) < 64 or sum(map(len, samples)) < 10 * DICTIONARY_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()


def sequences(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    length: int = LENGTH,
    doc_id: str = "doc_id",
    text: str = "text",
    dictionary: bytes = b"",
) -> DataFrame:
    """(n_tokens, doc_ids, starts, payload): packed sequences, payloads compressed.

    ``starts`` has the place in the sequence at which the part of each of ``doc_ids`` begins.
    ``ranks`` is the path of a rank file, read on the driver.
    """
    short_batches(docs.sparkSession)
    with open(ranks, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder, compressor = _encoder(shared.value, pattern), zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        schema = None
        rows: list[tuple] = []
        ids: list[int] = []
        owners: list[tuple] = []

        def row(tokens: list[int], parts: list[tuple]) -> tuple:
            filled = tokens + [END] * (length - len(tokens))
            payload = compressor.compress(np.array(filled, "<u2").tobytes())
            return len(tokens), [d for d, _ in parts], [s for _, s in parts], payload

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema, strict=True)], names=PACKED)

        for batch in batches:
            schema = [pa.int32(), pa.list_(batch.schema.field(0).type), pa.list_(pa.int32()), pa.binary()]
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                owners.append((key, len(ids)))
                ids += encoder.encode_ordinary(value.as_py() or "")
                ids.append(END)
                at = 0
                while len(ids) - at >= length:
                    parts = [(d, s) for d, s in owners if s < length]
                    rows.append(row(ids[at : at + length], parts))
                    # A document whose tokens go on is also the first of the next sequence.
                    open_ = [(d, s - length) for d, s in owners if s >= length]
                    owners = open_ if open_ and open_[0][1] == 0 or len(ids) - at == length else [(parts[-1][0], 0), *open_]
                    at += length
                del ids[:at]
                if len(rows) >= 512:
                    yield batch_of(rows)
                    rows = []
        if ids:
            rows.append(row(ids, owners))
        if rows:
            yield batch_of(rows)

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    key = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(pack, f"n_tokens int, doc_ids array<{key}>, starts array<int>, payload binary")


PACKED = ["n_tokens", "doc_ids", "starts", "payload"]


def _numbered(table: DataFrame) -> tuple[DataFrame, int]:
    """The written sequences with their number ``index``, and how many there are."""
    spark = table.sparkSession
    placed = table.select("*", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    name = F.col("_metadata.file_name")
    files = table.groupBy(name.alias("name"), F.xxhash64("_metadata.file_path").alias("file")).agg(F.count("*").alias("n")).orderBy("name").collect()
    begins, total = [], 0
    for f in files:
        begins.append((f["file"], total))
        total += f["n"]
    offsets = spark.createDataFrame(begins, "file bigint, begin bigint")
    # At most FILES rows of two numbers.
    return placed.join(F.broadcast(offsets), "file").withColumn("index", F.col("begin") + F.col("place")), total


def _slot(index: Column, size: int, key: int) -> Column:
    @F.pandas_udf("bigint")
    def slot(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), size, key))

    return slot(index)


def write_shards(
    docs: DataFrame,
    path: str,
    ranks: str,
    pattern: str,
    key: int = 42,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, Layout]:
    """Write shards and their layout below ``path``; returns the index and the layout.

    The index has one row for each sequence: slot, shard, byte_offset, n_tokens, doc_ids, starts.
    """
    spark = docs.sparkSession
    stored = scratch_path(spark, "sequences")
    # Payloads are compressed already.
    dictionary = payload_dictionary(docs, ranks, pattern, length, text)
    packed = sequences(docs, ranks, pattern, length, doc_id, text, dictionary).coalesce(FILES)
    packed.write.option("compression", "uncompressed").parquet(stored)
    numbered, total = _numbered(spark.read.schema(packed.schema).parquet(stored))
    layout = Layout(total, length, max(1, shard_bytes // (2 * length + len(MARK))), key)
    slot = _slot(F.col("index"), total, key)
    slotted = numbered.select("n_tokens", "doc_ids", "starts", "payload", slot.alias("slot"))
    if total:
        shard = F.floor(F.col("slot") / layout.per_shard).cast("int")
        dealt = slotted.select("slot", "payload").repartitionById(layout.shards, shard).sortWithinPartitions("slot")

        def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            reader = zstandard.ZstdDecompressor(dict_data=known)
            for batch in batches:
                raw = [reader.decompress(p.as_py()) for p in batch.column(1)]
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["record"])

        # The text writer puts bytes down as they are; the separator is the record's end mark.
        lines = dealt.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
        lines.write.option("lineSep", MARK).text(f"{path}/shards")
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.text(f"{path}/layout")
    index = slotted.select(
        "slot",
        F.floor(F.col("slot") / layout.per_shard).cast("int").alias("shard"),
        (F.col("slot") % layout.per_shard * layout.stride).alias("byte_offset"),
        "n_tokens",
        "doc_ids",
        "starts",
    )
    return index, layout


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{path}/layout").first()[0]))


def in_shard_order(files: list[str]) -> list[str]:
    """Shard files by number: names have five digits and more from 100,000 on, so text order is wrong."""
    return sorted(files, key=lambda f: int(re.search(r"part-(\d+)[^/]*$", f)[1]))


def read_from(spark: SparkSession, path: str, slot: int = 0):
    """An RDD of (slot, ids) from ``slot`` on, in training order; whole shards before it are not
    opened."""
    layout = read_layout(spark, path)
    files = []
    if layout.shards:
        files = in_shard_order(list(spark.read.format("binaryFile").load(f"{path}/shards").select("path").toPandas()["path"]))
    if len(files) != layout.shards:
        raise ValueError(f"{len(files)} shard files, {layout.shards} in the layout: {path}")
    parts = []
    for number in range(slot // layout.per_shard, layout.shards):
        begin = number * layout.per_shard
        records = spark.sparkContext.binaryRecords(files[number], layout.stride).zipWithIndex()
        parts.append(records.map(lambda r, b=begin: (b + r[1], np.frombuffer(r[0], "<u2")[: layout.length])))
    if not parts:
        return spark.sparkContext.emptyRDD()
    return spark.sparkContext.union(parts).filter(lambda r: r[0] >= slot)
