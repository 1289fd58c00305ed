"""Exact nearest neighbours by a block matrix join over int8 tiles.

Vectors are quantised to int8 with a scale of their own. Candidates and queries are cut into
blocks; every (query block, candidate block) pair is one tile, a task's unit of work. A tile's
integer products give each pair's inner product up to a bound from the quantisation errors:
``|ab - a'b'| <= |a - a'||b| + |a'||b - b'|``. Pairs whose upper bound reaches the query's best k
lower bounds so far are recomputed in double precision on the original vectors and enter the
query's heap; the tiles' heaps are merged by query. Nothing is left out, so recall is 1.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, neither does a row without id; vectors of different lengths never meet; a query's own id is
no candidate of it; repeated rows each count as candidates, query rows that share an id ask as one;
ties go to the smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of float64 vectors in a block of candidates, and of queries.
BLOCK_BYTES = 16 * 1024 * 1024
#: Candidates in a step of a tile.
STEP = 2048
QUERY_STEP = 512


class Quantised:
    """int8 codes with scales, and the bounds' norms; codes are kept as float32 for the product."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        peak = np.abs(vectors).max(axis=1)
        # The largest component maps to 127; tiny or huge vectors are scaled before they are squared.
        self.scale = peak / 127.0
        unit = vectors / peak[:, None]
        codes = np.rint(unit * 127.0)
        error = unit - codes / 127.0
        self.codes = codes.astype(np.float32)
        self.norm = peak * np.sqrt((unit**2).sum(axis=1))
        self.error = peak * np.sqrt((error**2).sum(axis=1)) * (1 + 1e-9)

    def take(self, rows: slice) -> Quantised:
        part = object.__new__(Quantised)
        for name, value in vars(self).items():
            setattr(part, name, value[rows])
        return part


def products(a: Quantised, b: Quantised) -> np.ndarray:
    """Integer products of all code pairs; exact, as slices of 1,024 components stay below 2^24."""
    total = np.zeros((len(a.codes), len(b.codes)))
    for at in range(0, a.codes.shape[1], 1024):
        total += a.codes[:, at : at + 1024] @ b.codes[:, at : at + 1024].T
    return total


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component on, whatever the row's place."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def search_tile(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> list[list[tuple[float, int]]]:
    """For each query its k best (score, -id) of the tile, best first."""
    candidates = candidates.sort_values("id")
    ids, query_ids = candidates["id"].to_numpy(), queries["id"].to_numpy()
    left, right = Quantised(np.stack(queries["vector"])), Quantised(np.stack(candidates["vector"]))
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    for begin in range(0, len(query_ids), QUERY_STEP):
        mine = slice(begin, begin + QUERY_STEP)
        a = left.take(mine)
        best = np.full((len(a.codes), k), -np.inf)
        for at in range(0, len(ids), STEP):
            b = right.take(slice(at, at + STEP))
            near = products(a, b) * a.scale[:, None] * b.scale
            reach = a.error[:, None] * b.norm + (a.norm + a.error)[:, None] * b.error
            reach += 1e-12 * (np.abs(near) + a.norm[:, None] * b.norm)
            own = query_ids[mine][:, None] == ids[at : at + STEP]
            lower = np.where(own, -np.inf, near - reach)
            best = np.concatenate([best, lower], axis=1)
            best = -np.partition(-best, k - 1, axis=1)[:, :k]
            rows, columns = np.nonzero(~own & (near + reach >= best.min(axis=1)[:, None]))
            for part in range(0, len(rows), 1 << 16):
                r, c = rows[part : part + (1 << 16)], columns[part : part + (1 << 16)]
                scores = inner(a.vectors[r], b.vectors[c])
                for query, score, other in zip((r + begin).tolist(), scores.tolist(), ids[c + at].tolist(), strict=True):
                    heap, entry = heaps[query], (score, -other)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
    return [sorted(h, reverse=True) for h in heaps]


def usable(vector: Column) -> Column:
    """Vectors that take part."""
    components = vector.cast("array<double>")
    bad = F.exists(components, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(components, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product with each query row."""
    rows = vectors.where(usable(F.col(embedding)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(embedding).cast("array<double>").alias("vector"),
        F.size(embedding).alias("size"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # One row for each vector length, so the block counts are known before anything is dealt.
    counts = rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).collect()
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = []
    for c in counts:
        rows_in_block = max(256, block_bytes // (8 * c["size"]))
        query_blocks = math.ceil(c["m"] / rows_in_block)
        # Small tables are still cut into as many tiles as there are tasks.
        blocks = max(math.ceil(c["n"] / rows_in_block), math.ceil(tasks / max(1, query_blocks)))
        grid.append((c["size"], min(blocks, math.ceil(c["n"] / 256)), max(1, query_blocks)))
    table = spark.createDataFrame(grid or [(0, 1, 1)], "size int, blocks int, query_blocks int")
    placed = rows.join(F.broadcast(table), "size")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    # New aliases on both sides: a cogroup of one table with itself needs columns told apart.
    named = [F.col(c).alias(c) for c in ("id", "vector", "size")]
    candidates = placed.select(
        *named, F.pmod(F.hash("id"), F.col("blocks")).alias("block"), every(F.col("query_blocks")).alias("query_block")
    )
    queries = placed.where("asks").select(
        *named,
        every(F.col("blocks")).alias("block"),
        F.pmod(F.xxhash64("id"), F.col("query_blocks")).cast("int").alias("query_block"),
    )
    keys = ["size", "block", "query_block"]

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "found": []})
        found = search_tile(left, right, k)
        return pd.DataFrame(
            {"query_id": left["id"].to_numpy(), "found": [[{"score": s, "vec_id": -i} for s, i in heap] for heap in found]}
        )

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for query, lists in zip(batch["query_id"], batch["lists"], strict=True):
                ordered = [[(-x["score"], x["vec_id"]) for x in one] for one in lists]
                for rank, (score, other) in enumerate(heapq.nsmallest(k, heapq.merge(*ordered)), 1):
                    out.append((query, rank, other, -score))
            yield pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])

    entry = "array<struct<score:double,vec_id:bigint>>"
    tiles = (
        queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(tile, f"query_id bigint, found {entry}")
    )
    # A list holds at most k entries; a query has one list for each candidate block.
    lists = tiles.groupBy("query_id").agg(F.collect_list("found").alias("lists"))
    return lists.mapInPandas(merged, "query_id bigint, rank int, vec_id bigint, score double")
