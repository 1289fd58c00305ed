"""Hard negatives by coordinate pruning over length buckets.

An anchor's positives are its best rows of the same label; its hard negatives are the best rows of
other labels whose score lies just below a positive's. Anchors and candidates meet in tiles, each
the work of one task. A tile sorts its candidates by length into buckets; a bucket holds, for every
coordinate, the order of its rows by that coordinate of their directions. For an anchor and a least
score, a bucket whose greatest length cannot reach it is skipped with all shorter ones. In others
the least cosine leaves an anchor's focus coordinates (its largest) a range of feasible values each:
with a = arccos(q_f) and b = arccos(cosine), p_f lies in [cos(a + b), cos(a - b)]. Rows within all
the ranges are scored exactly, and the least score rises with what is found. No row is lost, since
the bounds hold for every row.

Scores are inner products of floor(256 x) as integers: in doubles while these are exact, otherwise
in Python's integers.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no
part; vectors of different lengths never meet; rows sharing an anchor's id are no candidates of it,
and rows that share an anchor id ask as one, the least by label and vector; other repeated rows count
each for itself, as positives too; ties go to the smaller id; scores beyond 64 bits count as
the greatest or least of 64 bits; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.tables import written

#: Bytes of a tile's vectors on each side, at eight bytes a component.
TILE_BYTES = 16 * 1024 * 1024
#: Rows of a length bucket and focus coordinates of an anchor.
BUCKET, FOCUS = 1024, 4
#: Doubles hold integers below this exactly.
EXACT = 2**53
LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame, label: Column, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, label, vector, size) of the rows that take part; components are floor(256 x)."""
    parts = F.col(embedding).cast("array<double>")
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & label.isNotNull() & F.col(embedding).isNotNull()).where(~bad)
    return rows.select(
        F.col(vec_id).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform(parts, lambda x: F.floor(x * 256)).alias("vector"),
        F.size(embedding).alias("size"),
    )


def products(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows with one row."""
    peaks = [float(np.abs(x.astype(float)).max(initial=0)) for x in (rows, one)]
    if peaks[0] * peaks[1] * max(1, len(one)) < EXACT:
        return (rows.astype(float) @ one.astype(float)).astype(np.int64)
    asked = one.tolist()
    total = (sum(a * b for a, b in zip(row, asked, strict=True)) for row in rows.tolist())
    return np.array([min(max(t, -LONG - 1), LONG) for t in total], np.int64)


class Bucket:
    """Candidates of similar length with the order of their directions by every coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.longest = float(lengths.max())
        # Zero vectors have no direction; they score 0, which only a least score up to 0 lets in.
        unit = rows / np.maximum(lengths, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0)
        self.sorted = np.take_along_axis(unit, self.order, axis=0)

    def feasible(self, direction: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Rows whose direction may have this cosine or more with ``direction``."""
        b = math.acos(cosine) + 1e-7
        within = np.zeros(len(self.ids), np.int8)
        for f in focus.tolist():
            a = math.acos(min(1.0, max(-1.0, float(direction[f]))))
            low, high = math.cos(min(math.pi, a + b)) - 1e-9, math.cos(max(0.0, a - b)) + 1e-9
            column = self.sorted[:, f]
            begin, end = np.searchsorted(column, low, "left"), np.searchsorted(column, high, "right")
            within[self.order[begin:end, f]] += 1
        return np.flatnonzero(within == len(focus))


class Block:
    """The candidates of a tile in length buckets, longest first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, bucket: int = BUCKET):
        lengths = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
        order = np.lexsort((ids, -lengths))
        self.buckets = []
        for at in range(0, len(ids), bucket):
            some = order[at : at + bucket]
            self.buckets.append(Bucket(ids[some], labels[some], rows[some], lengths[some]))
        self.seen = self.scored = 0

    def visit(self, anchor: np.ndarray, least, wanted, take) -> None:
        """Give ``take`` the rows, (bucket, places, scores), that may score at least ``least()``;
        ``wanted`` chooses among the rows of a bucket."""
        length = float(np.sqrt((anchor.astype(float) ** 2).sum()))
        direction = anchor / max(length, 1e-300)
        focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        for bucket in self.buckets:
            floor = least()
            self.seen += len(bucket.ids)
            rows = None
            if floor > 0:
                reach = length * bucket.longest * (1 + 1e-9)
                if reach < floor:
                    break
                rows = bucket.feasible(direction, focus, floor / reach)
            chosen = wanted(bucket)
            rows = np.flatnonzero(chosen) if rows is None else rows[chosen[rows]]
            if rows.size:
                self.scored += len(rows)
                take(bucket.ids[rows], products(bucket.rows[rows], anchor))


class Best:
    """The ``k`` best (score, smaller id) pairs with a score from ``low`` to ``high``."""

    def __init__(self, k: int, low: int = -LONG - 1, high: int = LONG):
        self.k, self.low, self.high = k, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.least()) & (scores <= self.high)
        if inside.any():
            ids, scores = np.append(self.ids, ids[inside]), np.append(self.scores, scores[inside])
            # Scores are inverted bit by bit, which, unlike a minus, cannot overflow.
            first = np.lexsort((ids, ~scores))[: self.k]
            self.ids, self.scores = ids[first], scores[first]


def window(score: int) -> tuple[int, int] | None:
    """Least and greatest score of a positive's hard negatives: 80 % of its own, and its own."""
    return None if score < 0 else (-(-80 * score // 100), score)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().astype(np.int64).reshape(len(column), width)


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _block(candidates: pa.Table, width: int) -> Block:
    return Block(_ints(candidates, "id"), _ints(candidates, "label"), _matrix(candidates.column("vector"), width))


def tile_positives(anchors: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """(anchor_id, positive_id, score): each anchor's ``k`` best rows of its label in the tile."""
    width, found = anchors.column("size")[0].as_py(), []
    block = _block(candidates, width)
    for own, label, vector in zip(_ints(anchors, "id"), _ints(anchors, "label"), _matrix(anchors.column("vector"), width), strict=True):
        best = Best(k)
        block.visit(vector, best.least, lambda b: (b.labels == label) & (b.ids != own), best.add)  # noqa: B023
        found += [(int(own), i, s) for i, s in zip(best.ids.tolist(), best.scores.tolist(), strict=True)]
    return _rows(found, [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())])


def tile_negatives(anchors: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """(anchor_id, place, negative_id, score): for each of an anchor's positives, by its place, the
    ``k`` best rows of other labels in its window."""
    width, found = anchors.column("size")[0].as_py(), []
    block = _block(candidates, width)
    scores = anchors.column("scores").to_pylist()
    vectors = _matrix(anchors.column("vector"), width)
    for own, label, vector, asked in zip(_ints(anchors, "id"), _ints(anchors, "label"), vectors, scores, strict=True):
        lists = {i: Best(k, *bounds) for i, s in enumerate(asked) if (bounds := window(s)) is not None}
        if lists:

            def add(ids, values, lists=lists):
                for one in lists.values():
                    one.add(ids, values)

            least = lambda lists=lists: min(one.least() for one in lists.values())
            block.visit(vector, least, lambda b: (b.labels != label) & (b.ids != own), add)  # noqa: B023
            for place, one in lists.items():
                found += [(int(own), place, i, s) for i, s in zip(one.ids.tolist(), one.scores.tolist(), strict=True)]
    return _rows(found, [("anchor_id", pa.int64()), ("place", pa.int32()), ("negative_id", pa.int64()), ("score", pa.int64())])


def _rows(rows: list[tuple], fields: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(fields, columns, strict=True)})


def _dealt(rows: DataFrame, anchors: DataFrame, tile_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the tiles that they take part in: every block of one meets every block of
    the other among vectors of the same length."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One row for each vector length, so the block counts are known before anything is dealt.
    sizes = rows.groupBy("size").agg(F.count("*").alias("n")).join(anchors.groupBy("size").agg(F.count("*").alias("m")), "size").collect()
    grid = []
    for s in sizes:
        in_block = max(256, tile_bytes // (8 * max(1, s["size"])))
        anchor_blocks = math.ceil(s["m"] / in_block)
        # Small tables are still cut into as many tiles as there are tasks.
        blocks = max(math.ceil(s["n"] / in_block), math.ceil(tasks / anchor_blocks))
        grid.append((s["size"], max(1, min(blocks, math.ceil(s["n"] / 256))), anchor_blocks))
    table = F.broadcast(spark.createDataFrame(grid or [(-1, 1, 1)], "size int, blocks int, anchor_blocks int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    # By row number: rows that share an id, or are equal, do not meet in one block.
    number = rows.withColumn("number", F.monotonically_increasing_id())
    candidates = number.join(table, "size").select(
        "id", "label", "vector", "size", F.pmod(F.xxhash64("number"), "blocks").cast("int").alias("block"), every(F.col("anchor_blocks")).alias("anchor_block")
    )
    asking = anchors.join(table, "size").select(
        *anchors.columns, every(F.col("blocks")).alias("block"), F.pmod(F.xxhash64("id"), "anchor_blocks").cast("int").alias("anchor_block")
    )
    return asking, candidates


def _tiles(asking: DataFrame, candidates: DataFrame, work, k: int, schema: str) -> DataFrame:
    keys = ["size", "block", "anchor_block"]
    empty = {n: pa.array([], t) for n, t in ((c.split()[0], _KINDS[c.split()[1]]) for c in schema.split(", "))}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left, right, k) if left.num_rows and right.num_rows else pa.table(empty)

    return asking.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(run, schema)


_KINDS = {"bigint": pa.int64(), "int": pa.int32()}


def _first(found: DataFrame, by: list[str], other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), other)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hard
    negatives of each anchor and positive. ``is_anchor`` is over the column ``id``, ``label`` over
    those of ``vectors``."""
    rows = whole_vectors(vectors, label, vec_id, embedding)
    least = F.min(F.struct("label", "vector", "size")).alias("row")
    anchors = written(rows.where(is_anchor).groupBy("id").agg(least).select("id", "row.*"), "anchors")
    asking, candidates = _dealt(rows, anchors, tile_bytes)
    near = _tiles(asking, candidates, tile_positives, positives, "anchor_id bigint, positive_id bigint, score bigint")
    best = written(_first(near, ["anchor_id"], "positive_id", positives), "positives")
    # At most ``positives`` entries an anchor, in order.
    lists = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("p"))
    scores = F.transform("p", lambda e: e["score"]).alias("scores")
    asked = written(anchors.join(lists.withColumnRenamed("anchor_id", "id"), "id").select(*anchors.columns, scores), "anchors")
    asking, candidates = _dealt(rows, asked, tile_bytes)
    found = _tiles(asking, candidates, tile_negatives, negatives, "anchor_id bigint, place int, negative_id bigint, score bigint")
    hard = _first(found, ["anchor_id", "place"], "negative_id", negatives)
    named = best.select("anchor_id", (F.col("rank") - 1).alias("place"), "positive_id", F.col("score").alias("positive_score"))
    return hard.join(named, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )
