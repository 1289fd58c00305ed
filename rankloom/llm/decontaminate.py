"""Benchmark decontamination with a broadcast set of normalised test n-grams.

The items' windows are collected behind a check of their bytes and broadcast as sorted hashes;
each task scans the word windows of its texts, verifies every hash hit on the words themselves,
and reports or removes the hit spans, without a shuffle of the documents. A test set beyond
``INDEX_BYTES`` is cut into slices by window hash; each slice is one pass over the texts, and only
when all hits of a text are known is it judged or cut, so the results do not depend on the slices.

Defined results: a null or empty text has no words and no hits; an item without words takes no part;
an item without id takes none either unless ``unnamed`` is set: it is then hit as any other, and one
null among the items of a document stands for all items without id; an item of fewer than ``n``
words is one window; repeated items and documents count each for itself; with an empty benchmark nothing is hit; texts of any length are searched whole; an empty
table gives an empty result; other columns, whatever their names, are passed on or ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankloom.llm.words import HashSet, find_words, text_bytes, window_hashes, words_in
from rankloom.llm.tables import BATCH_ROWS, unused, written

WINDOW = 10
INDEX_BYTES = 48 * 1024 * 1024
OMITTED = "\n\u2026\n".encode()


@dataclass
class WindowIndex:
    """Windows of one length: their hash set, and for each hash its (words, item ids)."""

    n: int
    hashes: HashSet
    entries: list[dict[bytes, list]]


def benchmark_windows(
    items: DataFrame, n: int = WINDOW, item_id: str = "item_id", text: str = "text", unnamed: bool = False
) -> DataFrame:
    """Distinct (item_id, n, window) rows; ``window`` holds lower-cased words one space apart."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_in((value or "").encode())
                size = min(n, len(words))
                rows |= {(item, size, b" ".join(words[i : i + size])) for i in range(len(words) - size + 1) if size}
            ordered = sorted(rows, key=lambda r: (str(r[0]), r[1], r[2]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in ordered], batch.schema.field(0).type),
                    pa.array([r[1] for r in ordered], pa.int32()),
                    pa.array([r[2] for r in ordered], pa.binary()),
                ],
                names=["item_id", "n", "window"],
            )

    kind = items.schema[item_id].dataType.simpleString()
    chosen = items.where(F.col(item_id).isNotNull() | F.lit(unnamed)).select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(cut, f"item_id {kind}, n int, window binary").distinct()


def _in_order(ids) -> list:
    return sorted(ids, key=lambda i: (i is None, i if i is not None else 0))


def build_index(rows) -> list[WindowIndex]:
    """One index for each window length among collected (item_id, n, window) rows."""
    by_length: dict[int, dict[bytes, list]] = {}
    for row in rows:
        by_length.setdefault(row["n"], {}).setdefault(bytes(row["window"]), []).append(row["item_id"])
    made = []
    for n, windows in sorted(by_length.items()):
        texts = sorted(windows)
        data, offsets = text_bytes(pa.array([t.decode() for t in texts]))
        words = find_words(data, offsets)[2]
        hashes = window_hashes(words, n)[::n]
        members = HashSet(hashes)
        entries: list[dict[bytes, list]] = [{} for _ in members.values]
        for place, window in zip(np.searchsorted(members.values, hashes), texts, strict=True):
            entries[place][window] = _in_order(windows[window])
        made.append(WindowIndex(n, members, entries))
    return made


@dataclass
class Hits:
    """For each text: words, words hit, hit byte ranges, ids of the items hit."""

    n_words: np.ndarray
    n_hit: np.ndarray
    spans: list[list[tuple[int, int]]]
    items: list[list]


def scan_texts(column: pa.Array, index: list[WindowIndex], before: Hits | None = None) -> Hits:
    """Hits of one batch; ``before`` has those of earlier slices of the index."""
    data, offsets = text_bytes(column)
    begins, ends, hashes, first = find_words(data, offsets)
    docs = len(offsets) - 1
    owner = np.repeat(np.arange(docs), np.diff(first))
    cover = np.zeros(len(begins) + 1, np.int64)
    items: list[set] = [set(x) for x in before.items] if before else [set() for _ in range(docs)]
    for doc, spans in enumerate(before.spans) if before else ():
        for begin, end in spans:
            cover[np.searchsorted(begins, offsets[doc] + begin)] += 1
            cover[np.searchsorted(begins, offsets[doc] + end)] -= 1
    for part in index:
        places, members = part.hashes.find(window_hashes(hashes, part.n))
        inside = owner[places] == owner[places + part.n - 1] if places.size else np.zeros(0, bool)
        for at, member in zip(places[inside].tolist(), members[inside].tolist(), strict=True):
            found = b" ".join(words_in(data[begins[at] : ends[at + part.n - 1]].tobytes()))
            if found in part.entries[member]:
                cover[at] += 1
                cover[at + part.n] -= 1
                items[owner[at]].update(part.entries[member][found])
    hit = np.cumsum(cover[:-1]) > 0
    sums = np.concatenate([[0], np.cumsum(hit)])
    spans = [[] for _ in range(docs)]
    at = np.flatnonzero(hit)
    if at.size:
        breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner[at]) > 0)) + 1
        for run in np.split(at, breaks):
            doc = owner[run[0]]
            spans[doc].append((int(begins[run[0]] - offsets[doc]), int(ends[run[-1]] - offsets[doc])))
    return Hits(np.diff(first), sums[first[1:]] - sums[first[:-1]], spans, [_in_order(x) for x in items])


def slices(windows: DataFrame, limit: int = INDEX_BYTES) -> list[DataFrame]:
    """The windows in parts of about ``limit`` bytes each, as measured here."""
    size = windows.agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    parts = max(1, math.ceil(size / limit))
    part = F.pmod(F.xxhash64("window"), F.lit(parts))
    return [windows.where(part == i) for i in range(parts)]


#: Keys of hit texts that are broadcast, at most; more are joined by a shuffle.
FEW_TEXTS = 200_000
_SPANS = "array<struct<begin:bigint,end:bigint>>"
_SPANS_ARROW = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _text_key(text: Column) -> list[Column]:
    """128 bits that name a text; equal texts have equal hits."""
    return [F.xxhash64(text), F.xxhash64(F.lit("text"), text)]


def _span_array(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"begin": b, "end": e} for b, e in x] for x in spans], _SPANS_ARROW)


def _known(spans: pa.Array, items: pa.Array) -> Hits:
    pairs = [[(s["begin"], s["end"]) for s in x or ()] for x in spans.to_pylist()]
    return Hits(np.zeros(0), np.zeros(0), pairs, [x or [] for x in items.to_pylist()])


@dataclass
class Search:
    """How a scan gets its hits: from an index, or, beyond one slice, from columns of the rows."""

    docs: DataFrame
    columns: list[str]
    index: Broadcast | None

    def hits(self, texts: pa.Array, spans: pa.Array | None = None, items: pa.Array | None = None) -> Hits:
        return scan_texts(texts, self.index.value if self.index else [], None if spans is None else _known(spans, items))


def _search(docs: DataFrame, text: str, windows: DataFrame, items_sql: str, limit: int) -> Search:
    """One slice of windows is an index for the scan that decides. Several are searched one after
    another, each index released before the next; hit texts go to a table by key, and all their
    hits are joined to the documents, so that whatever is decided is decided once."""
    spark, body = docs.sparkSession, F.col(f"`{text}`").cast("string")
    parts = slices(windows, limit)
    if len(parts) == 1:
        return Search(docs, [], spark.sparkContext.broadcast(build_index(parts[0].collect())))
    items_type = to_arrow_type(windows.schema["item_id"].dataType)
    texts = docs.select(*[k.alias(f"key{i}") for i, k in enumerate(_text_key(body))], body.alias("text")).where("text IS NOT NULL")
    found = None
    for part in parts:
        index = spark.sparkContext.broadcast(build_index(part.collect()))

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = scan_texts(batch.column(2), index.value)
                columns = [batch.column(0), batch.column(1), _span_array(hits.spans), pa.array(hits.items, pa.list_(items_type))]
                yield pa.RecordBatch.from_arrays(columns, names=["key0", "key1", "spans", "items"]).filter(pa.array(hits.n_hit > 0))

        hit = texts.mapInArrow(scan, f"key0 bigint, key1 bigint, spans {_SPANS}, items {items_sql}")
        one = written(hit.groupBy("key0", "key1").agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "hits")
        found = one if found is None else found.unionByName(one)
        index.destroy()
    # At most one row a text and slice.
    every = lambda c: F.flatten(F.collect_list(c)).alias(c)
    merged = written(found.groupBy("key0", "key1").agg(every("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), "hits")
    names = [unused(docs, n) for n in ("hit_key0", "hit_key1", "hit_spans", "hit_items")]
    merged = merged.toDF(*names)
    if merged.limit(FEW_TEXTS + 1).count() <= FEW_TEXTS:
        merged = F.broadcast(merged)
    same = [k == F.col(n) for k, n in zip(_text_key(body), names[:2], strict=True)]
    return Search(docs.join(merged, same[0] & same[1], "left").drop(*names[:2]), names[2:], None)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    n: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    limit: int = INDEX_BYTES,
    unnamed: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) for every document.

    ``spans`` are (begin, end) byte ranges of the text that item windows cover; ``n_hit`` counts
    the words in them; ``items`` are the sorted ids of the items with windows in the text.
    """
    items_type = pa.list_(to_arrow_type(items.schema[item_id].dataType))
    items_sql = f"array<{items.schema[item_id].dataType.simpleString()}>"
    key_sql = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    search = _search(narrow, "text", benchmark_windows(items, n, item_id, item_text, unnamed), items_sql, limit)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                hits = search_hits(*batch.columns[1:])
                counts = [pa.array(hits.n_words, pa.int64()), pa.array(hits.n_hit, pa.int64())]
                columns = [batch.column(0), *counts, _span_array(hits.spans), pa.array(hits.items, items_type)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_hit", "spans", "items"])

    search_hits = _scanner(search)
    schema = f"doc_id {key_sql}, n_words bigint, n_hit bigint, spans {_SPANS}, items {items_sql}"
    return search.docs.mapInArrow(scan, schema)


def _scanner(search: Search):
    """The search without its DataFrame, which cannot go to tasks."""
    return Search(None, search.columns, search.index).hits


def remove_documents(docs: DataFrame, items: DataFrame, share: float = 0.0, n: int = WINDOW, **names) -> DataFrame:
    """``docs``, all columns, without the documents whose share of hit words is over ``share``."""
    return _apply(docs, items, n, share, False, **names)


def remove_spans(docs: DataFrame, items: DataFrame, share: float = 1.0, n: int = WINDOW, **names) -> DataFrame:
    """``docs``, all columns, with the hit spans cut out of the texts; documents whose share of
    hit words is over ``share`` go. ``OMITTED`` takes the place of a cut span; its ellipsis is a
    word, so no window forms across the cut."""
    return _apply(docs, items, n, share, True, **names)


def _apply(
    docs, items, n, share, cut, text="text", item_id="item_id", item_text="text", limit=INDEX_BYTES, unnamed=False
) -> DataFrame:
    items_sql = f"array<{items.schema[item_id].dataType.simpleString()}>"
    search = _search(docs, text, benchmark_windows(items, n, item_id, item_text, unnamed), items_sql, limit)
    scan, found = _scanner(search), search.docs
    body = F.col(f"`{text}`").cast("string")
    hit = [F.col(f"`{c}`") for c in search.columns]
    columns = [F.col(f"`{c}`") for c in docs.columns]

    if not cut:

        @F.arrow_udf("boolean")
        def stays(*given: pa.Array) -> pa.Array:
            kept = []
            for at in range(0, max(1, len(given[0])), BATCH_ROWS):
                hits = scan(*(g.slice(at, BATCH_ROWS) for g in given))
                kept.append(hits.n_hit <= share * hits.n_words)
            return pa.array(np.concatenate(kept))

        return found.where(stays(body, *hit)).select(*columns)
    place, schema, width = docs.columns.index(text), docs.schema, len(docs.columns)

    def cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                hits = scan(batch.column(place), *batch.columns[width:])
                own = pa.RecordBatch.from_arrays(batch.columns[:width], schema=pa.schema(list(batch.schema)[:width]))
                yield _cut_out(own, place, hits.spans).filter(pa.array(hits.n_hit <= share * hits.n_words))

    return found.mapInArrow(cutter, schema)


def _cut_out(batch: pa.RecordBatch, place: int, spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    if not any(spans):
        return batch
    values = batch.column(place).to_pylist()
    for i, cuts in enumerate(spans):
        if cuts:
            raw, kept, at = values[i].encode(), [], 0
            for begin, end in cuts:
                kept.append(raw[at:begin])
                at = end
            values[i] = OMITTED.join([*kept, raw[at:]]).decode()
    columns = [pa.array(values, batch.schema.field(j).type) if j == place else batch.column(j) for j in range(batch.num_columns)]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)
