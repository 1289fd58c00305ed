"""SimHash near-duplicates with BK-trees over shards of fingerprints.

A fingerprint is one or more 64-bit words; a bit is 1 if it is set in over half of the hashes of
the text's shingles. Equal fingerprints are one node. Nodes are dealt into shards by bands of
bits: with ``radius + 1`` bands on a word, two words within the radius agree on at least one band
(pigeonhole), so no link is lost. Each shard's BK-tree (children keyed by their integer Hamming
distance to the parent) is searched along the edges within the radius; its links leave the task as
a spanning forest, never as all pairs. A shard of more than ``SHARD`` nodes is cut again by bands
of its remaining bits, and what is still larger into tiles: each of its trees meets every block of
its nodes in a task of its own. Fingerprints, links and components stay in tables.

Defined results: null, empty and blank texts have the zero fingerprint, which links like any
other; repeated rows share a fingerprint; null ids are ignored for a component's smallest id; texts of
any length are read whole; an empty table gives an empty result; other columns, whatever their names,
are passed on by ``keep_one`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.components import components
from rankloom.llm.tables import short_batches, unused, written
from rankloom.llm.words import mix

SEED = 42
SHARD = 1024
_STEP = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Feature:
    """Shingles of ``size`` words hashed into ``words`` 64-bit fingerprint words. ``distinct``:
    repeated shingles count once."""

    size: int
    words: int = 1
    distinct: bool = False


@dataclass(frozen=True)
class Band:
    """Bits of one fingerprint word that nodes of a shard share; ``parts`` cut large shards."""

    word: int
    mask: int
    parts: tuple[int, ...] = ()


def _masks(places: list[int], count: int) -> list[int]:
    edges = [round(i * len(places) / count) for i in range(count + 1)]
    return [sum(1 << p for p in places[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def exact_bands(radius: int, word: int = 0) -> list[Band]:
    """Bands that miss no pair within ``radius`` on one word, with parts that miss none either."""
    bands = []
    for mask in _masks(list(range(64)), radius + 1):
        rest = [p for p in range(64) if not mask >> p & 1]
        bands.append(Band(word, mask, tuple(_masks(rest, radius + 1))))
    return bands


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the lower-cased ``size``-word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    count = len(words) - size + 1
    if count <= 1:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[:count].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[b:e], SEED) for b, e in zip(begins, ends[size - 1 :].tolist(), strict=True)]
    return np.array(hashes, np.uint64)


def _word(hashes: np.ndarray) -> int:
    """Majority of each bit."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, features: tuple[Feature, ...]) -> list[int]:
    """The fingerprint words of a text, as signed 64-bit numbers."""
    words = []
    for feature in features:
        hashes = shingle_hashes(text, feature.size)
        if feature.distinct:
            hashes = np.unique(hashes)
        for i in range(feature.words):
            words.append(_word(mix(hashes + np.uint64(i * _STEP % (1 << 64))) if i else hashes))
    return words


CONTRACT = (Feature(3),)


def fingerprints(docs: DataFrame, features=CONTRACT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) for every document; ``fp`` is an array of 64-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Some rows at a time: their texts are Python objects meanwhile.
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                made = [fingerprint((t or "").encode(), features) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(made, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "fp"]
                )

    short_batches(docs.sparkSession)
    body = F.col(text).cast("string")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), _text_hash(body).alias("text_hash"), body.alias("text"))
    return narrow.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, text_hash bigint, fp array<bigint>")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


class BKTree:
    """Values by Hamming distance; each may stand for several items."""

    def __init__(self):
        self.root = None

    def add(self, value: int, item) -> None:
        if self.root is None:
            self.root = (value, [item], {})
            return
        node = self.root
        while distance := (value ^ node[0]).bit_count():
            child = node[2].get(distance)
            if child is None:
                node[2][distance] = (value, [item], {})
                return
            node = child
        node[1].append(item)

    def within(self, value: int, radius: int) -> Iterator:
        """Items of all values at most ``radius`` bits away."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            distance = (value ^ node[0]).bit_count()
            if distance <= radius:
                yield from node[1]
            children = node[2]
            if len(children) <= 2 * radius:
                stack += [c for d, c in children.items() if abs(d - distance) <= radius]
            else:
                stack += [children[d] for d in range(distance - radius, distance + radius + 1) if d in children]


def spanning_links(nodes: np.ndarray, word: int, radius: int, compared: slice, most: int) -> list[tuple[int, int]]:
    """Links (index, index) that connect what is linked among ``nodes``, an array of fingerprints.

    Two nodes are linked if ``word`` differs in at most ``radius`` bits and the words of
    ``compared`` together in at most ``most``.
    """
    unsigned = nodes.view(np.uint64)
    values = unsigned[:, word].tolist()
    whole = [int.from_bytes(row.tobytes(), "little") for row in unsigned[:, compared]]
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree, links = BKTree(), []
    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            if (a := root(i)) != (b := root(j)) and (whole[i] ^ whole[j]).bit_count() <= most:
                parent[a] = b
                links.append((i, j))
        tree.add(value, i)
    return links


def near_links(
    nodes: DataFrame,
    bands: list[Band],
    radius: int,
    compared: tuple[int, int] = (0, 1),
    most: int | None = None,
    shard: int = SHARD,
) -> DataFrame:
    """(a, b) links that connect near nodes; ``nodes`` has distinct fingerprints in ``fp``."""
    place = {band: i for i, band in enumerate(bands)}
    masked = [
        F.struct(F.lit(i).alias("band"), F.col("fp")[b.word].bitwiseAND(_signed(b.mask)).alias("bits"), F.lit(-1).alias("part"), F.lit(0).cast("long").alias("more"))
        for b, i in place.items()
    ]
    rows = nodes.select("fp", F.inline(F.array(*masked)))
    keys = ["band", "bits", "part", "more"]
    hot = _over(rows, keys, shard)
    groups = []
    if hot is not None:
        large = rows.join(hot, keys)
        rows = rows.join(hot, keys, "left_anti")
        if all(b.parts for b in bands):
            options = [
                F.when(
                    F.col("band") == i,
                    F.array(*[F.struct(F.lit(p).alias("part"), F.col("fp")[b.word].bitwiseAND(_signed(m)).alias("more")) for p, m in enumerate(b.parts)]),
                )
                for b, i in place.items()
            ]
            cut = large.select("fp", "band", "bits", F.inline(F.coalesce(*options)))
            hot = _over(cut, keys, shard)
            if hot is not None:
                groups.append(cut.join(hot, keys, "left_anti"))
                large = cut.join(hot, keys)
            else:
                groups.append(cut)
                large = None
        if large is not None:
            trees = F.ceil(F.col("n") / shard).cast("int")
            mine = F.pmod(F.xxhash64("fp"), trees).cast("int")
            others = large.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), trees - 1)))
            tiled = others.select("fp", *keys, F.least("mine", "other").alias("tile"), F.greatest("mine", "other").alias("tile2"))
            groups.append(tiled)
    shards = rows.groupBy(*keys).agg(F.collect_list("fp").alias("fps"))
    for group in groups:
        by = keys + [c for c in ("tile", "tile2") if c in group.columns]
        shards = shards.unionByName(group.groupBy(*by).agg(F.collect_list("fp").alias("fps")).select(*keys, "fps"))
    words = [b.word for b in bands]
    limit = radius if most is None else most
    columns = slice(*compared)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for band, fps in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                width = len(fps.values[0])
                flat = np.ascontiguousarray(fps.values.flatten().to_numpy()).reshape(-1, width)
                for i, j in spanning_links(flat, words[band], radius, columns, limit):
                    left.append(flat[i])
                    right.append(flat[j])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(left, kind), pa.array(right, kind)], names=["a", "b"])

    return shards.where(F.size("fps") > 1).select("band", "fps").mapInArrow(search, "a array<bigint>, b array<bigint>")


def _over(rows: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    counts = written(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > limit), "hot")
    return None if counts.isEmpty() else counts


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def near_classes(
    prints: DataFrame,
    bands: list[Band],
    radius: int,
    compared: tuple[int, int] = (0, 1),
    most: int | None = None,
    shard: int = SHARD,
) -> DataFrame:
    """(fp, first) for each fingerprint: ``first`` is the least (doc_id, text_hash) of its class."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = written(prints.groupBy("fp").agg(F.min(row).alias("first")), "nodes")
    linked = components(near_links(nodes.select("fp"), bands, radius, compared, most, shard))
    rooted = nodes.join(linked, nodes["fp"] == linked["node"]).select("fp", "first", "root")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    moved = rooted.join(least, "root").select("fp", "least")
    return nodes.join(moved, "fp", "left").select("fp", F.coalesce("least", "first").alias("first"))


def near_duplicates(docs: DataFrame, radius: int = 2, features=CONTRACT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): classes of fingerprints reachable by steps of at most ``radius``
    bits. Exact: bands come from ``exact_bands``."""
    prints = written(fingerprints(docs, features, doc_id, text), "fingerprints")
    classes = near_classes(prints, exact_bands(radius), radius)
    return prints.join(classes, "fp").select("doc_id", "fp", F.col("first")["doc_id"].alias("component_id"))


#: Keys of rows that go which are broadcast, at most; more are joined by a shuffle.
FEW_KEYS = 1_000_000


def keep_one(docs: DataFrame, radius: int = 2, features=CONTRACT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each class of ``near_duplicates``: that of the least
    doc_id, and of rows with equal id and text one.

    The classes come from fingerprints alone. Only keys of rows that go or are repeated, (id, hash
    of the text), meet the documents; texts are shuffled only if these are more than ``FEW_KEYS``.
    """
    prints = written(fingerprints(docs, features, doc_id, text), "fingerprints")
    first = F.col("first")
    stays = F.col("doc_id").eqNullSafe(first["doc_id"]) & (F.col("text_hash") == first["text_hash"])
    classes = near_classes(prints, exact_bands(radius), radius)
    rows = prints.join(classes, "fp").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.bool_or(stays).alias("stays"))
    odd = written(rows.where("NOT stays OR n > 1"), "odd-keys")
    key, digest = unused(docs, "key_id"), unused(docs, "key_hash")
    odd = odd.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest), F.col("stays").alias("stays"))
    if odd.limit(FEW_KEYS + 1).count() <= FEW_KEYS:
        odd = F.broadcast(odd)
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(key)) & (_text_hash(F.col(f"`{text}`").cast("string")) == F.col(digest))
    repeated = docs.join(odd.where("stays"), same, "left_semi").withColumn(digest, _text_hash(F.col(f"`{text}`").cast("string")))
    return docs.join(odd, same, "left_anti").unionByName(repeated.dropDuplicates([doc_id, digest]).drop(digest))
