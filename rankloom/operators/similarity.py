"""Scoring many documents against many requirement profiles.

Profiles and candidates meet block by block in tiles, each the work of a task. A tile indexes its
candidates by term with the greatest share of each term, visits a profile's terms by falling greatest
score, and stops when the terms left cannot lift a candidate into the best ``k``; what may still be
among them is scored in full. So tiles leave out postings, never a match.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from rankloom.functions.vectors import squared_norm, term_vector
from rankloom.vocabulary import TARGET_WEIGHTS

#: Encoders by name, kept by a Python worker from task to task.
_ENCODERS: dict = {}

_COSINE_WEIGHT = TARGET_WEIGHTS["semantic_similarity"]
_COVERAGE_WEIGHT = TARGET_WEIGHTS["skill_match_percentage"]
#: Terms of the profiles and candidates of a tile, about.
POSTINGS, ROWS = 200_000, 8192


def vectorize(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, vector, norm2) rows with the default term-frequency vector."""
    vectors = df.select(id_column, term_vector(F.col(text_column)).alias("vector"))
    return vectors.withColumn("norm2", squared_norm(F.col("vector")))


def _loaded(name: str, load_encoder: Callable) -> Callable:
    # Tasks get this function by its name, so that all of a worker see the same dictionary.
    if name not in _ENCODERS:
        _ENCODERS[name] = load_encoder()
    return _ENCODERS[name]


def encode(
    df: DataFrame,
    text_column: str,
    load_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    output_column: str = "embedding",
    name: str = "encoder",
    kind: str = "float",
) -> DataFrame:
    """Add dense vectors from a user's encoder, loaded once per Python worker and ``name``.

    The encoder gets whole whitespace-collapsed texts; rows are L2-normalised. ``kind`` is that of
    the components, float or double.
    """
    from rankloom.functions.text import split_words

    number = np.float32 if kind == "float" else np.float64

    @F.pandas_udf(f"array<{kind}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _loaded(name, load_encoder)
        for texts in batches:
            raw = np.asarray(encoder(texts.tolist()), dtype=number)
            norms = np.linalg.norm(raw, axis=1, keepdims=True)
            unit = np.divide(raw, norms, out=np.zeros_like(raw), where=norms > 0)
            yield pd.Series(list(unit))

    # Spark does not find a Python function over ``collapse_whitespace`` of a conditional text.
    words = F.array_join(split_words(F.col(text_column)), " ")
    return df.withColumn(output_column, run(F.when(words == "", F.lit(" ")).otherwise(words)))


def hashing_encoder(dimensions: int = 64) -> Callable[[list[str]], np.ndarray]:
    """An encoder without a model: counts of words by the first four hex digits of their MD5."""
    places: dict[str, int] = {}

    def place(word: str) -> int:
        if len(places) > 1_000_000:
            places.clear()
        if word not in places:
            places[word] = int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % dimensions
        return places[word]

    def run(texts: list[str]) -> np.ndarray:
        rows = np.zeros((len(texts), dimensions))
        for row, text in zip(rows, texts, strict=True):
            found = [place(w) for w in re.findall("[a-z0-9]+", text.lower())]
            row += np.bincount(np.array(found, np.int64), minlength=dimensions)
        return rows

    return run


#: Vectors of either side, and pairs, that a tile of ``pair_similarity`` holds, about.
TILE_CANDIDATES, TILE_JOBS, TILE_PAIRS = 65_536, 131_072, 1_000_000


def _vector_rows(lists: pa.Array) -> list[np.ndarray | None]:
    """A vector for each list; None for one that is null or has a null component."""
    whole = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    ends = whole.offsets.to_numpy()
    flat = whole.values
    holes = np.concatenate([[0], np.cumsum(pc.is_null(flat).to_numpy(zero_copy_only=False))])
    values = pc.fill_null(flat.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
    bad = pc.is_null(whole).to_numpy(zero_copy_only=False) | (holes[ends[1:]] > holes[ends[:-1]])
    return [None if bad[i] else values[ends[i] : ends[i + 1]] for i in range(len(whole))]


def _ordered_dot(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Products of columns, summed in order as ``vectors.dense_dot`` does."""
    total = np.zeros(first.shape[1])
    for a, b in zip(first, second, strict=True):
        total = total + a * b
    return total


def tile_cosines(pairs: pa.Table, candidates: pa.Table, jobs: pa.Table) -> pa.Table:
    """Pairs of a tile with their cosines: each with every row of its ids, as a join has it."""
    mine, theirs = _vector_rows(candidates.column("vector")), _vector_rows(jobs.column("vector"))
    left = pd.DataFrame({"candidate_id": candidates.column("candidate_id").to_pandas(), "mine": np.arange(len(mine))})
    right = pd.DataFrame({"job_id": jobs.column("job_id").to_pandas(), "theirs": np.arange(len(theirs))})
    met = pairs.select(["candidate_id", "job_id"]).to_pandas().merge(left, "inner", "candidate_id").merge(right, "inner", "job_id")
    cosine = np.zeros(len(met))
    sizes = [np.array([-1 if v is None else len(v) for v in side], np.int64) for side in (mine, theirs)]
    norms = [np.zeros(len(side)) for side in (mine, theirs)]
    owners = [met["mine"].to_numpy(), met["theirs"].to_numpy()]
    with np.errstate(all="ignore"):
        parts = []
        for side, of, norm in zip((mine, theirs), sizes, norms, strict=True):
            # Vectors of one length, component by component.
            parts.append({})
            for size in set(of.tolist()) - {-1}:
                at = np.flatnonzero(of == size)
                columns = np.array([side[i] for i in at]).reshape(len(at), size).T.copy()
                norm[at] = _ordered_dot(columns, columns)
                parts[-1][size] = at, columns
        positive = ~(norms[0][owners[0]] <= 0) & ~(norms[1][owners[1]] <= 0)
        # As in Spark: what is no number or of different lengths counts as greatest.
        cosine[positive] = 1.0
        for size in set(parts[0]) & set(parts[1]):
            at = np.flatnonzero(positive & (sizes[0][owners[0]] == size) & (sizes[1][owners[1]] == size))
            rows = [np.searchsorted(part[size][0], owner[at]) for part, owner in zip(parts, owners, strict=True)]
            dot = np.zeros(len(at))
            for a, b in zip(parts[0][size][1], parts[1][size][1], strict=True):
                dot = dot + a[rows[0]] * b[rows[1]]
            found = dot / (np.sqrt(norms[0][owners[0][at]]) * np.sqrt(norms[1][owners[1][at]]))
            cosine[at] = np.where(np.isnan(found), 1.0, np.clip(found, 0.0, 1.0))
    ids = [pa.array(met[c], pairs.schema.field(c).type) for c in ("candidate_id", "job_id")]
    return pa.Table.from_arrays([*ids, pa.array(cosine)], names=["candidate_id", "job_id", "semantic_similarity"])


def pair_similarity(
    pairs: DataFrame, candidates: DataFrame, jobs: DataFrame, vector: str = "embedding"
) -> DataFrame:
    """(candidate_id, job_id, semantic_similarity) from tables of dense vectors.

    The table that ``features.pair_features`` takes as ``similarity``. Pairs travel by id alone:
    blocks of candidates and blocks of jobs meet in tiles, so that a vector moves once for each block
    of the other side and not with every pair. All three should be written tables; they are counted.
    """
    n_pairs, n_mine, n_theirs = pairs.count(), candidates.count(), jobs.count()
    theirs_in = max(1, math.ceil(n_theirs / TILE_JOBS))
    tiles = max(math.ceil(n_pairs / TILE_PAIRS), pairs.sparkSession.sparkContext.defaultParallelism)
    mine_in = max(1, math.ceil(n_mine / TILE_CANDIDATES), math.ceil(tiles / theirs_in))

    def block(key: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    ids = {c: pairs.schema[c].dataType for c in ("candidate_id", "job_id")}
    lists = F.col(vector).cast("array<double>").alias("vector")
    tiled = pairs.where("candidate_id IS NOT NULL AND job_id IS NOT NULL").select(
        block("candidate_id", mine_in).alias("a"), block("job_id", theirs_in).alias("b"), "candidate_id", "job_id"
    )

    def side(rows: DataFrame, key: str) -> DataFrame:
        keyed = rows.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast(ids[key]))
        placed = (block(key, mine_in).alias("a"), every(theirs_in).alias("b")) if key == "candidate_id" else (every(mine_in).alias("a"), block(key, theirs_in).alias("b"))
        return keyed.select(*placed, *[F.col(c) if c == key else F.lit(None).cast(t).alias(c) for c, t in ids.items()], lists)

    vectors = side(candidates, "candidate_id").unionByName(side(jobs, "job_id"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_mine = pc.is_valid(right.column("candidate_id"))
        return tile_cosines(left, right.filter(is_mine), right.filter(pc.invert(is_mine)))

    schema = StructType([*[StructField(c, t) for c, t in ids.items()], StructField("semantic_similarity", DoubleType())])
    return tiled.groupBy("a", "b").cogroup(vectors.groupBy("a", "b")).applyInArrow(run, schema)


def _flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """All values of the lists, and the list that each belongs to."""
    whole = lists.combine_chunks()
    sizes = pc.list_value_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
    return whole.flatten(), np.repeat(np.arange(len(whole)), sizes)


class TermIndex:
    """Postings of some candidates by term, (candidate, tf) in order of candidate, with the greatest
    share tf / |candidate| of each term. Terms are numbered by their place in ``terms``."""

    def __init__(self, candidates: pa.Table, terms: pa.Array):
        flat, owner = _flat(candidates.column("terms"))
        code = pc.fill_null(pc.index_in(flat, value_set=terms), -1).to_numpy().astype(np.int64)
        tf = _flat(candidates.column("tfs"))[0].to_numpy().astype(np.int64)
        known = code >= 0
        code, owner, tf = code[known], owner[known], tf[known]
        order = np.argsort(code, kind="stable")
        code, self.owner, self.tf = code[order], owner[order], tf[order]
        self.edges = np.searchsorted(code, np.arange(len(terms) + 1))
        self.norm2 = candidates.column("norm2").to_numpy().astype(float)
        self.share = self.tf / np.sqrt(self.norm2[self.owner])
        self.most = np.zeros(len(terms))
        held = np.flatnonzero(np.diff(self.edges))
        if held.size:
            self.most[held] = np.maximum.reduceat(self.share, self.edges[held])
        ids = candidates.column("candidate_id").combine_chunks()
        self.by_id = pc.sort_indices(ids).to_numpy().astype(np.int64)
        self.place = np.empty(len(ids), np.int64)
        self.place[self.by_id] = np.arange(len(ids))
        self.ids = ids
        self.seen = self.touched = 0

    def _hopeful(self, terms: np.ndarray, weights: np.ndarray, bonus: float, k: int) -> np.ndarray:
        """Candidates whose score may be among the ``k`` best, by terms of falling greatest score.

        Once the terms left add less than the k-th sum so far, no candidate without a sum can be
        among the best, nor one whose sum and what is left stay below it.
        """
        greatest = weights * self.most[terms] + bonus * (self.most[terms] > 0)
        order = np.argsort(-greatest, kind="stable")
        left = np.append(np.cumsum(greatest[order][::-1])[::-1], 0.0) * (1 + 1e-9) + 1e-12
        sums, least = np.zeros(len(self.ids)), 0.0
        for done, i in enumerate(order.tolist()):
            if left[done] < least:
                break
            part = slice(self.edges[terms[i]], self.edges[terms[i] + 1])
            sums[self.owner[part]] += weights[i] * self.share[part] + bonus
            self.touched += part.stop - part.start
            if len(sums) > k:
                least = float(np.partition(sums, len(sums) - k)[len(sums) - k])
        else:
            done = len(order)
        return np.flatnonzero((sums > 0) & (sums + left[done] >= least))

    def best(self, terms: np.ndarray, tfs: np.ndarray, norm2: float, k: int):
        """(candidates, shared, cosine, coverage, score) of the ``k`` best, in order."""
        self.seen += int((self.edges[terms + 1] - self.edges[terms]).sum())
        size = math.sqrt(norm2) if norm2 > 0 else 1.0
        hopeful = self._hopeful(terms, _COSINE_WEIGHT * tfs / size, _COVERAGE_WEIGHT / max(1, len(terms)), k)
        if len(hopeful) < k:
            # Candidates that share no term fill up the list.
            rest = self.by_id[~np.isin(self.by_id, hopeful)][: k - len(hopeful)]
            hopeful = np.sort(np.concatenate([hopeful, rest]))
        dot, shared = np.zeros(len(hopeful)), np.zeros(len(hopeful), np.int64)
        for t, tf in zip(terms.tolist(), tfs.tolist(), strict=True):
            owner = self.owner[self.edges[t] : self.edges[t + 1]]
            at = np.searchsorted(owner, hopeful)
            at[at == len(owner)] = 0
            found = owner[at] == hopeful if len(owner) else np.zeros(len(hopeful), bool)
            dot += np.where(found, self.tf[self.edges[t] : self.edges[t + 1]][at] * tf, 0) if len(owner) else 0
            shared += found
        scale = np.sqrt(self.norm2[hopeful]) * math.sqrt(norm2)
        cosine = np.clip(np.divide(dot, scale, out=np.zeros_like(dot), where=scale > 0), 0.0, 1.0)
        coverage = shared / max(len(terms), 1.0)
        score = np.clip(_COSINE_WEIGHT * cosine + _COVERAGE_WEIGHT * coverage, 0.0, 1.0) * 100.0
        first = np.lexsort((self.place[hopeful], -score))[:k]
        return hopeful[first], shared[first], cosine[first], coverage[first], score[first]


def search_tile(profiles: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The ``k`` best candidates of a tile for each of its profiles, and one row without job that has
    the numbers of postings that the profiles' terms have and that were visited."""
    flat, owner = _flat(profiles.column("terms"))
    terms = flat.unique()
    code = pc.index_in(flat, value_set=terms).to_numpy().astype(np.int64)
    tfs = _flat(profiles.column("tfs"))[0].to_numpy().astype(np.int64)
    edges = np.searchsorted(owner, np.arange(profiles.num_rows + 1))
    norm2 = profiles.column("norm2").to_numpy().astype(float)
    index, found = TermIndex(candidates, terms), []
    for job in range(profiles.num_rows):
        part = slice(edges[job], edges[job + 1])
        rows, *values = index.best(code[part], tfs[part], norm2[job], k)
        found.append((np.full(len(rows), job), rows, *values))
    job, rows, *values = (np.concatenate(x) for x in zip(*found, strict=True))
    names = ["shared", "cosine", "coverage", "score"]
    scored = pa.table(
        {
            "job_id": profiles.column("job_id").combine_chunks().take(pa.array(job)),
            "candidate_id": index.ids.take(pa.array(rows)),
            **dict(zip(names, map(pa.array, values), strict=True)),
            "seen": pa.nulls(len(rows), pa.int64()),
            "touched": pa.nulls(len(rows), pa.int64()),
        }
    )
    visits = [{"seen": index.seen, "touched": index.touched}]
    return pa.concat_tables([scored, pa.Table.from_pylist(visits, scored.schema)])


def match_tiles(candidates: DataFrame, profiles: DataFrame, k: int, postings: int = POSTINGS, rows: int = ROWS) -> DataFrame:
    """The best candidates of every tile: each block of profiles meets each block of candidates in a
    task of its own; neither side passes through the driver."""
    spark = candidates.sparkSession
    flat = lambda df, key: df.select(
        key, "norm2", F.transform("vector", lambda e: e["term"]).alias("terms"), F.transform("vector", lambda e: e["tf"].cast("int")).alias("tfs"),
        F.xxhash64(F.monotonically_increasing_id()).alias("number"),
    )
    named = profiles.where(F.col("job_id").isNotNull())
    size = named.agg(F.coalesce(F.sum(F.size("vector") + 1), F.lit(0))).first()[0]
    jobs = max(1, math.ceil(size / postings))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(math.ceil(candidates.count() / rows), math.ceil(tasks / jobs))
    block = lambda n: F.pmod("number", F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    mine = flat(candidates, "candidate_id").withColumn("block", block(blocks)).withColumn("job_block", every(jobs)).drop("number")
    theirs = flat(named, "job_id").withColumn("job_block", block(jobs)).withColumn("block", every(blocks)).drop("number")
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((profiles, "job_id"), (candidates, "candidate_id"))}
    schema = ", ".join(
        [*(f"{c} {t}" for c, t in kinds.items()), "shared long, cosine double, coverage double, score double, seen long, touched long"]
    )
    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        return search_tile(left, right, k).cast(empty.schema)

    keys = ["job_block", "block"]
    return theirs.groupBy(*keys).cogroup(mine.groupBy(*keys)).applyInArrow(run, schema)


def top_matches(candidates: DataFrame, profiles: DataFrame, k: int, postings: int = POSTINGS, rows: int = ROWS) -> DataFrame:
    """The ``k`` best candidates per profile by weak score, ties by candidate id.

    ``candidates`` (candidate_id, vector, norm2), ``profiles`` (job_id, vector, norm2). Candidates
    that share no term with a profile score 0 and fill its list if others are fewer than ``k``.
    """
    scored = match_tiles(candidates, profiles, k, postings, rows).where("job_id IS NOT NULL").drop("seen", "touched")
    order = Window.partitionBy("job_id").orderBy(F.col("score").desc(), F.col("candidate_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def visited_postings(candidates: DataFrame, profiles: DataFrame, k: int, **sizes) -> DataFrame:
    """(seen, touched): postings that the profiles' terms have, and how many of them were visited."""
    tiles = match_tiles(candidates, profiles, k, **sizes).where("job_id IS NULL")
    return tiles.agg(F.sum("seen").alias("seen"), F.sum("touched").alias("touched"))
