"""Ranked lexical search over posting lists with geometric blocks.

Documents become sparse vectors of integer term impacts. Tasks index shards of them: each term's
posting list is clustered by document similarity into blocks, and a block stores the coordinatewise
maximum of its documents' vectors. The inner product of a query with that summary bounds the score
of every document in the block, so a block is skipped only when its bound is below what the query
already holds; every other block is scored in full. A query visits its terms by falling greatest
impact and stops when the terms left cannot lift a document over that threshold. The results equal
those of scoring every document.

What grows with the documents stays distributed: vectors are a written table, tasks emit at most
``k`` rows a query. The terms of the queries are broadcast; queries beyond ``QUERY_BYTES`` are cut
into slices, each a pass over the texts. The thresholds start at the k-th score of a slice of the
documents, which is a lower bound whatever the slice is and changes no result.

Scores: a term that ``df`` of the N documents with words hold weighs floor(1000 ln((2N+2)/(2df+1)));
its impact is that weight times (10^9 tf) div (1000 tf + 20 m), where m is 50 + (50 n N) div L for
a document of n of the L words. All but the logarithm is 64-bit integer.

Defined results: null or empty texts have no terms, neither match nor count for N; items sharing an
id ask as one with the union of their terms, so do those without id; repeated documents are ranked
each for itself; ties go to the smaller document id, no id comes last; texts of any length are read
whole; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.tables import written
from rankloom.llm.words import HashSet, find_words, text_bytes, words_in

#: Bytes of query terms that are broadcast at once.
QUERY_BYTES = 32 * 1024 * 1024
#: Documents of a block, about, and pivots of a shard, the most blocks of a posting list.
BLOCK, BLOCKS = 32, 64
#: Documents and postings of a shard, at most; a document is never cut.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 20
#: Documents in the slice that gives the first thresholds, about.
SEED_DOCS = 20_000
#: Texts and bytes that are cut into words at once.
PART_ROWS, PART_BYTES = 512, 1 << 20


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, term) rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                terms = sorted(set(words_in((value.as_py() or "").encode())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(terms), batch.schema.field(0).type), pa.array(terms, pa.binary())], names=["item_id", "term"]
                )

    narrow = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(cut, f"item_id {items.schema[item_id].dataType.simpleString()}, term binary").distinct()


@dataclass
class Queries:
    """The terms of some items: their hashes, byte lengths, and each item's term numbers."""

    ids: list
    terms: list[np.ndarray]
    known: HashSet
    lengths: np.ndarray


def build_queries(rows) -> Queries:
    """Queries of collected (item_id, term) rows."""
    words = sorted({bytes(r["term"]) for r in rows})
    data, offsets = text_bytes(pa.array([w.decode() for w in words], pa.string()))
    hashes = find_words(data, offsets)[2]
    known = HashSet(hashes)
    number = dict(zip(words, np.searchsorted(known.values, hashes).tolist(), strict=True))
    lengths = np.zeros(len(known.values), np.int64)
    by_item: dict = {}
    for word, place in number.items():
        lengths[place] = len(word)
    for r in rows:
        by_item.setdefault(r["item_id"], set()).add(number[bytes(r["term"])])
    ids = sorted(by_item, key=lambda i: (i is None, i if i is not None else 0))
    return Queries(ids, [np.array(sorted(by_item[i]), np.int64) for i in ids], known, lengths)


def text_parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of about ``PART_BYTES`` at a time."""
    for begin in range(0, len(column), PART_ROWS):
        data, offsets = text_bytes(column.slice(begin, PART_ROWS))
        starts = np.flatnonzero(np.diff(offsets[:-1] // PART_BYTES, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(offsets) - 1], strict=True):
            yield begin + a, begin + b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def term_counts(docs: DataFrame, queries: Queries, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs): words of each document, numbers and counts of the query terms in it."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lengths = shared.value.known, shared.value.lengths
        width = len(lengths)
        for batch in batches:
            for a, b, data, offsets in text_parts(batch.column(1)):
                begins, ends, hashes, first = find_words(data, offsets)
                owner = np.repeat(np.arange(b - a), np.diff(first))
                at, term = known.find(hashes)
                same = ends[at] - begins[at] == lengths[term]
                key, tf = np.unique(owner[at[same]] * width + term[same], return_counts=True)
                edges = pa.array(np.searchsorted(key, np.arange(b - a + 1) * width).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(first), pa.int64()),
                        pa.ListArray.from_arrays(edges, pa.array((key % max(width, 1)).astype(np.int32))),
                        pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(count, f"doc_id {kind}, n bigint, terms array<int>, tfs array<int>")


@dataclass
class Weights:
    """What the impacts need of all documents: N, L and the weight of each query term."""

    docs: int
    words: int
    weight: np.ndarray

    def impacts(self, n: np.ndarray, owner: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        m = 50 + (50 * n * self.docs) // max(1, self.words)
        tf = tfs.astype(np.int64)
        return self.weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[owner]))


def corpus_weights(counts: DataFrame, terms: int) -> Weights:
    """The statistics of a written ``term_counts`` table; one row for each query term is collected."""
    total = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    weight = np.zeros(terms, np.int64)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        weight[r["term"]] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * r["df"] + 1)))
    return Weights(total["docs"], total["words"], weight)


def spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, one range after the other, and where each range starts in them."""
    sizes = ends - begins
    starts = np.cumsum(sizes) - sizes
    return np.repeat(begins - starts, sizes) + np.arange(sizes.sum()), starts


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the consecutive parts that begin at ``starts``; parts may be empty."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[np.append(starts, len(values))])


@dataclass
class Blocks:
    """A posting list in blocks: documents block by block, and each block's maximum of every term."""

    docs: np.ndarray
    edges: np.ndarray
    terms: np.ndarray
    most: np.ndarray
    starts: np.ndarray

    def bounds(self, asked: np.ndarray) -> np.ndarray:
        return sums(self.most * asked[self.terms], self.starts)


class Together:
    """For each term, the terms that queries with it ask for: the coordinates its summaries need."""

    def __init__(self, queries: list[np.ndarray], width: int):
        self.queries, self.width = queries, width
        asked = np.concatenate([*queries, np.zeros(0, np.int64)])
        number = np.repeat(np.arange(len(queries)), [len(q) for q in queries])
        order = np.argsort(asked, kind="stable")
        self.number, self.edges = number[order], np.searchsorted(asked[order], np.arange(width + 1))

    def of(self, term: int) -> np.ndarray:
        mark = np.zeros(self.width, bool)
        for q in self.number[self.edges[term] : self.edges[term + 1]].tolist():
            mark[self.queries[q]] = True
        return mark


class Shard:
    """The index of some documents: vectors by document and posting lists by term, whose blocks are
    made when a query first visits the list.

    A list is clustered by the similarity of its documents to those pivots, evenly chosen documents
    of the shard, that hold the term as well.
    """

    def __init__(self, edges: np.ndarray, terms: np.ndarray, impacts: np.ndarray, together: Together):
        width = together.width
        self.edges, self.terms, self.impacts, self.together = edges, terms, impacts, together
        owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        order = np.argsort(terms, kind="stable")
        self.posted = owner[order]
        self.lists = np.searchsorted(terms[order], np.arange(width + 1))
        self.most = np.zeros(width, np.int64)
        held = np.flatnonzero(np.diff(self.lists))
        if held.size:
            self.most[held] = np.maximum.reduceat(impacts[order], self.lists[held])
        self.made: dict[int, Blocks] = {}
        self._similarities()

    def _similarities(self) -> None:
        """Inner products of all documents with the pivots, of length one, in parts of postings."""
        docs = len(self.edges) - 1
        pivots = np.unique(np.arange(BLOCKS) * docs // BLOCKS) if docs else np.zeros(0, np.int64)
        self.held = np.zeros((len(self.most), len(pivots)), bool)
        centre = np.zeros(self.held.shape, np.float32)
        at, starts = spans(self.edges[pivots], self.edges[pivots + 1])
        column = np.repeat(np.arange(len(pivots)), np.diff(np.append(starts, len(at))))
        centre[self.terms[at], column] = self.impacts[at]
        self.held[self.terms[at], column] = True
        centre /= np.maximum(np.sqrt((centre**2).sum(axis=0)), 1e-30)
        self.near = np.zeros((docs, len(pivots)), np.float32)
        begin = 0
        while begin < docs:
            end = max(begin + 1, int(np.searchsorted(self.edges, self.edges[begin] + (1 << 16), "right")) - 1)
            part = slice(self.edges[begin], self.edges[end])
            some = begin + np.flatnonzero(np.diff(self.edges[begin : end + 1]))
            if some.size:
                near = centre[self.terms[part]] * self.impacts[part].astype(np.float32)[:, None]
                self.near[some] = np.add.reduceat(near, self.edges[some] - self.edges[begin], axis=0)
            begin = end

    def _clusters(self, term: int, docs: np.ndarray) -> np.ndarray:
        count = -(-len(docs) // BLOCK)
        pivots = np.flatnonzero(self.held[term])[:count]
        if count == 1 or len(pivots) < 2:
            pivots = np.arange(min(count, self.near.shape[1]))
        return self.near[docs][:, pivots].argmax(axis=1)

    def blocks(self, term: int) -> Blocks:
        if term not in self.made:
            width = len(self.most)
            docs = self.posted[self.lists[term] : self.lists[term + 1]]
            block = self._clusters(term, docs)
            order = np.argsort(block, kind="stable")
            docs, block = docs[order], block[order]
            edges = np.flatnonzero(np.diff(block, prepend=-1))
            number = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(docs))))
            at, _ = spans(self.edges[docs], self.edges[docs + 1])
            needed = self.together.of(term)[self.terms[at]]
            key = (np.repeat(number, self.edges[docs + 1] - self.edges[docs]) * width)[needed]
            at = at[needed]
            key += self.terms[at]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            key, most = key[first], np.maximum.reduceat(self.impacts[at[order]], first)
            starts = np.searchsorted(key, np.arange(len(edges)) * width)
            self.made[term] = Blocks(docs, np.append(edges, len(docs)), key % width, most, starts)
        return self.made[term]

    def score(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        at, starts = spans(self.edges[docs], self.edges[docs + 1])
        return sums(self.impacts[at] * asked[self.terms[at]], starts)

    def search(self, query: np.ndarray, k: int, floor: int, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with all that may be among the ``k`` best of at least ``floor``;
        ``counts`` gets blocks seen and blocks scored added."""
        query = query[self.most[query] > 0]
        query = query[np.argsort(-self.most[query], kind="stable")]
        left = np.cumsum(self.most[query][::-1])[::-1]
        asked = np.zeros(len(self.most), np.int64)
        asked[query] = 1
        seen = np.zeros(len(self.edges) - 1, bool)
        docs, scores, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), max(1, floor)
        for term, rest in zip(query.tolist(), left.tolist(), strict=True):
            if rest < floor:
                break
            blocks = self.blocks(term)
            bound = blocks.bounds(asked)
            order = np.argsort(-bound, kind="stable")
            counts[0] += len(order)
            done, step = 0, 4
            while done < len(order):
                some = order[done : done + step]
                some = some[bound[some] >= floor]
                if not some.size:
                    break
                counts[1] += len(some)
                at, _ = spans(blocks.edges[some], blocks.edges[some + 1])
                new = blocks.docs[at]
                new = new[~seen[new]]
                seen[new] = True
                if new.size:
                    found = self.score(new, asked)
                    keep = found >= floor
                    docs, scores = np.append(docs, new[keep]), np.append(scores, found[keep])
                    if len(scores) >= k:
                        floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                        docs, scores = docs[scores >= floor], scores[scores >= floor]
                done, step = done + step, step * 2
        return docs, scores


def _shards(batches: Iterator[pa.RecordBatch], weights: Weights, together: Together) -> Iterator[tuple[pa.Array, Shard]]:
    """Documents with query terms, in shards of a bounded size."""

    def made(parts):
        ids = pa.concat_arrays([p.column(0) for p in parts])
        n = np.concatenate([p.column(1).to_numpy() for p in parts])
        sizes = np.concatenate([pc.list_value_length(p.column(2)).to_numpy() for p in parts]).astype(np.int64)
        terms = np.concatenate([p.column(2).flatten().to_numpy() for p in parts]).astype(np.int64)
        tfs = np.concatenate([p.column(3).flatten().to_numpy() for p in parts])
        owner = np.repeat(np.arange(len(n)), sizes)
        return ids, Shard(np.append(0, np.cumsum(sizes)), terms, weights.impacts(n, owner, terms, tfs), together)

    parts, docs, postings = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            size = pc.sum(pc.list_value_length(part.column(2))).as_py() or 0
            if parts and (docs + part.num_rows > SHARD_DOCS or postings + size > SHARD_POSTINGS):
                yield made(parts)
                parts, docs, postings = [], 0, 0
            parts.append(part)
            docs, postings = docs + part.num_rows, postings + size
    if parts:
        yield made(parts)


def _after(entry: tuple):
    score, doc = entry
    return -score, doc is None, doc if doc is not None else 0


def search_counts(counts: DataFrame, queries: Queries, weights: Weights, k: int, floors: list[int]) -> DataFrame:
    """(item, doc_id, score, seen, scored): the best of every task; ``item`` numbers the queries. The
    row without item has the numbers of blocks seen and scored."""
    shared = counts.sparkSession.sparkContext.broadcast((queries.terms, weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known, least = shared.value
        least, best, blocks, kind = list(least), [[] for _ in asked], [0, 0], None
        for ids, shard in _shards(batches, known, Together(asked, len(known.weight))):
            kind = ids.type
            place = np.empty(len(ids), np.int64)
            place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            for q, terms in enumerate(asked):
                docs, scores = shard.search(terms, k, least[q], blocks)
                if docs.size:
                    first = np.lexsort((place[docs], -scores))[:k]
                    new = zip(scores[first].tolist(), ids.take(pa.array(docs[first])).to_pylist(), strict=True)
                    best[q] = sorted([*best[q], *new], key=_after)[:k]
                    if len(best[q]) == k:
                        least[q] = max(least[q], best[q][-1][0])
        if kind is not None:
            rows = [(q, doc, score, 0, 0) for q, found in enumerate(best) for score, doc in found]
            columns = list(zip(*rows, (None, None, 0, *blocks), strict=True))
            kinds = [pa.int32(), kind, pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "doc_id", "score", "seen", "scored"]
            )

    kind = counts.schema["doc_id"].dataType.simpleString()
    held = counts.where(F.size("terms") > 0)
    return held.mapInArrow(run, f"item int, doc_id {kind}, score bigint, seen bigint, scored bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item, first within parts of the rows, then of these."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(32))
    in_part = Window.partitionBy("item", part).orderBy(*order)
    few = found.where("item IS NOT NULL").withColumn("rank", F.row_number().over(in_part)).where(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def _first_floors(counts: DataFrame, queries: Queries, weights: Weights, k: int) -> list[int]:
    """The k-th score of each item in a slice of the documents: never over that among all."""
    floors, slices = [1] * len(queries.ids), weights.docs // SEED_DOCS
    if slices > 1:
        some = counts.where(F.pmod(F.xxhash64("doc_id"), F.lit(slices)) == 0)
        found = _best(search_counts(some, queries, weights, k, floors), k)
        for r in found.where(F.col("rank") == k).select("item", "score").collect():
            floors[r["item"]] = r["score"]
    return floors


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    limit: int = QUERY_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score over 0."""
    spark = docs.sparkSession
    terms = written(item_terms(items, item_id, item_text), "item-terms")
    size = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    parts = max(1, math.ceil(size / limit))
    kind = items.schema[item_id].dataType.simpleString()
    found = None
    for part in range(parts):
        queries = build_queries(terms.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect())
        counts = written(term_counts(docs, queries, doc_id, text), "term-counts")
        weights = corpus_weights(counts, len(queries.lengths))
        floors = _first_floors(counts, queries, weights, k)
        best = _best(search_counts(counts, queries, weights, k, floors), k)
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"item int, item_id {kind}")
        named = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = named if found is None else found.unionByName(named)
    return found
