"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, texts of any kind the unlabelled ones. With the class
prior pi, the risk of a classifier is pi R_p+ + max(0, R_u- - pi R_p-): the loss of the negatives is
that of the unlabelled less what positives add to it. Where the difference falls below zero, which
means over-fitted, the step goes back up instead. Labels of clean documents serve to estimate
the prior, nothing else.

The sample is dealt into bags; each bag is a task that trains a linear NumPy classifier on hashed
words and word beginnings, and the mean of their weights scores every document in a scan without
a shuffle. The sample is bounded by ``POSITIVES`` and ``UNLABELLED``; the prior counts all labels.

Defined results: null or empty texts have no features and score what the bias says; texts of any
length are read whole; a document is confirmed toxic if any of its label rows says 1; rows without
id have no label and are not held out; repeated rows score alike; without a confirmed
toxic document everything scores 0; empty tables give an empty result; only id and text are read
from the documents, so other columns, whatever their names, change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.ranked import text_parts
from rankloom.llm.tables import written
from rankloom.llm.words import WORD_BYTES, find_words, mix

#: Most positives and unlabelled documents that classifiers are fitted on, about.
POSITIVES, UNLABELLED = 4000, 16_000
BAGS = 4
BUCKETS = 1 << 18
#: Features have a weight if this share of the positives has them, and this many times the share of
#: the unlabelled.
SUPPORT, LIFT = 0.02, 3.0
#: Bytes of the word beginnings that are features beside the word.
BEGINNINGS = (3, 4, 5)
STEPS, BATCH, RATE = 1500, 512, 0.05
#: Strength of the pull of weights to zero, a share of the rate.
SHRINK = 0.1
#: How far the negative risk may fall below zero, and the size of the step back.
BELOW, BACK = 0.0, 1.0
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the distinct features of some texts, in order of document."""
    begins, ends, hashes, first = find_words(data, offsets)
    docs = len(offsets) - 1
    owner = np.repeat(np.arange(docs, dtype=np.uint64), np.diff(first))
    # A word counts once a document; equal words of a document lie together after the sort.
    _, one = np.unique(mix(hashes + owner * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    begins, ends, owner, kinds = begins[one], ends[one], owner[one], [hashes[one]]
    padded = np.append(WORD_BYTES[data], np.zeros(8, np.uint8))
    start = np.zeros(len(begins), np.uint64)
    for i in range(max(BEGINNINGS)):
        inside = (begins + i < ends).astype(np.uint64)
        start |= padded[begins + i].astype(np.uint64) * inside << np.uint64(8 * i)
        if i + 1 in BEGINNINGS:
            kinds.append(mix(start + np.uint64(i + 1 << 56)))
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    flat = [(owner << np.uint64(32)) | (k >> shift) for k in kinds]
    key = np.unique(np.concatenate(flat))
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


@dataclass
class Linear:
    """One weight a bucket and the bias; the score is the logistic function of their sum."""

    weights: np.ndarray
    bias: float

    def logits(self, doc: np.ndarray, bucket: np.ndarray, docs: int) -> np.ndarray:
        return np.bincount(doc, self.weights[bucket], minlength=docs) + self.bias


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Rows:
    """Feature lists of documents, of which any rows can be taken."""

    def __init__(self, sizes: np.ndarray, values: np.ndarray):
        self.sizes, self.values = sizes, values
        self.edges = np.append(0, np.cumsum(sizes))

    @classmethod
    def of(cls, lists: pa.Array) -> Rows:
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        return cls(sizes, lists.flatten().to_numpy().astype(np.int64))

    def only(self, place: np.ndarray) -> Rows:
        """The features that have a place, by their places."""
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        kept = place[self.values] >= 0
        return Rows(np.bincount(owner[kept], minlength=len(self.sizes)), place[self.values[kept]])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[rows]
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(self.edges[rows] - starts, sizes) + np.arange(sizes.sum())
        return np.repeat(np.arange(len(rows)), sizes), self.values[at]


def train(positive: Rows, unlabelled: Rows, prior: float, seed: int = 0, steps: int = STEPS) -> Linear:
    """A linear classifier by Adam on the non-negative risk with the logistic loss."""
    rng = np.random.default_rng(seed)
    n_p, n_u = len(positive.sizes), len(unlabelled.sizes)
    # What few positives share, or unlabelled texts as well, says nothing of others.
    held, common = (np.bincount(r.values, minlength=BUCKETS) for r in (positive, unlabelled))
    used = np.flatnonzero((held >= max(2, SUPPORT * n_p)) & (held / n_p >= LIFT * common / n_u))
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    positive, unlabelled = positive.only(place), unlabelled.only(place)
    weights = np.append(np.zeros(len(used)), np.log(prior / (1 - prior)))
    mean, square = np.zeros(len(weights)), np.zeros(len(weights))
    for step in range(1, steps + 1):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * step / steps))
        p, u = rng.integers(0, n_p, BATCH), rng.integers(0, n_u, BATCH)
        (pd, pb), (ud, ub) = positive.take(p), unlabelled.take(u)
        zp = np.bincount(pd, weights[pb], minlength=BATCH) + weights[-1]
        zu = np.bincount(ud, weights[ub], minlength=BATCH) + weights[-1]
        sp, su = logistic(zp), logistic(zu)
        # Loss of calling z negative: log(1 + exp(z)), with the slope logistic(z).
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if negative >= -BELOW:
            # Slopes of pi R_p+ - pi R_p- together, and of R_u-.
            gp, gu = np.full(BATCH, -prior / BATCH), su / BATCH
        else:
            gp, gu = BACK * prior * sp / BATCH, -BACK * su / BATCH
        slope = np.bincount(np.concatenate([pb, ub]), np.concatenate([gp[pd], gu[ud]]), minlength=len(weights))
        slope[-1] = gp.sum() + gu.sum()
        mean += 0.1 * (slope - mean)
        square += 0.001 * (slope**2 - square)
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-6)
        weights[:-1] *= 1 - rate * SHRINK
    full = np.zeros(BUCKETS)
    full[used] = weights[:-1]
    return Linear(full, float(weights[-1]))


def encoded(docs: DataFrame) -> DataFrame:
    """The columns ``positive`` and ``bag`` of (text, positive, bag) rows with their ``buckets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_parts(batch.column(0)):
                doc, bucket = features(data, offsets)
                edges = pa.array(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(edges, pa.array(bucket.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), lists], names=["positive", "bag", "buckets"]
                )

    return docs.select("text", "positive", "bag").mapInArrow(run, "positive boolean, bag int, buckets array<int>")


def training_labels(labels: DataFrame, doc_id: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """(doc_id, toxic) of the documents whose labels may be learned from, one row each."""
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull() & ~held_out(F.col(doc_id)))
    return rows.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))


def _draw(key: Column, share: float, salt: str) -> Column:
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(key, F.lit(salt)).cast("double") / F.lit(2.0**64) + 0.5 < share


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    toxic: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    bags: int = BAGS,
) -> Linear | None:
    """The mean of the bags' classifiers; None without a confirmed toxic document.

    Positives go to every bag, an unlabelled document to one. Ids of the bounded sample of
    positives are broadcast, so texts are not shuffled but for the bounded sample's features.
    """
    known = training_labels(labels, label_id, toxic)
    seen = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    total = docs.count()
    if not seen["toxic"] or not total:
        return None
    prior = min(max(seen["toxic"] / seen["n"], 1e-4), 0.5)
    chosen = known.where((F.col("toxic") == 1) & _draw(F.col("doc_id"), positives / seen["toxic"], "positive"))
    chosen = chosen.select(F.col("doc_id").alias("chosen"))
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    body = body.where(F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    every_bag = F.explode(F.sequence(F.lit(0), F.lit(bags - 1))).alias("bag")
    confirmed = body.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("text", F.lit(True).alias("positive"), F.lit(-1).alias("bag"))
    key = F.xxhash64("doc_id", "text")
    drawn = body.where(_draw(key, unlabelled / total, "unlabelled"))
    others = drawn.select("text", F.lit(False).alias("positive"), F.pmod(key, F.lit(bags)).cast("int").alias("bag"))
    table = written(encoded(confirmed.unionByName(others)).coalesce(16), "toxicity")
    dealt = table.where("positive").select("positive", "buckets", every_bag).unionByName(table.where("NOT positive").select("positive", "buckets", "bag"))

    def learn(group: pa.Table) -> pa.Table:
        # Whatever order the rows arrive in, the same model comes out.
        lists = group.column("buckets").combine_chunks()
        sign = np.array([hash(tuple(x)) for x in lists.to_pylist()])
        is_positive = group.column("positive").to_numpy()
        order = np.lexsort((sign, is_positive))
        ours = order[is_positive[order]]
        model = train(
            Rows.of(lists.take(pa.array(ours))), Rows.of(lists.take(pa.array(order[~is_positive[order]]))), prior, int(group.column("bag")[0].as_py())
        ) if len(ours) and len(ours) < len(order) else None
        held = np.flatnonzero(model.weights) if model else np.zeros(0, np.int64)
        entry = {"buckets": held, "weights": model.weights[held] if model else np.zeros(0)}
        kinds = [("buckets", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64())), ("bias", pa.float64())]
        rows = [entry | {"bias": model.bias}] if model else []
        return pa.Table.from_pylist(rows, pa.schema(kinds))

    models = dealt.groupBy("bag").applyInArrow(learn, "buckets array<int>, weights array<double>, bias double").collect()
    if not models:
        return None
    weights = np.zeros(BUCKETS)
    for m in sorted(models, key=lambda m: m["bias"]):
        weights[np.array(m["buckets"], np.int64)] += np.array(m["weights"])
    return Linear(weights / len(models), sum(m["bias"] for m in models) / len(models))


def score_toxicity(docs: DataFrame, model: Linear | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every document, by a scan."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if shared.value is not None:
                for a, b, data, offsets in text_parts(batch.column(1)):
                    score[a:b] = logistic(shared.value.logits(*features(data, offsets), b - a))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")
