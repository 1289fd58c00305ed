"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Expectation
maximisation over the counts of vote patterns (at most 3 to the number of labellers, whatever the
corpus) estimates each labeller's behaviour towards good and bad documents and each pattern's
posterior. Those posteriors train a hashed linear scorer on a bounded sample of documents; the
scorer then judges every document by its words and their shapes, including texts on which the
labellers abstain or disagree.

Votes and features are array operations on an Arrow batch. Defined results: a null, empty or blank
text has no words, gets the score 0 and is rejected; repeated rows get equal scores; a score of
exactly ``KEEP`` stays; texts of any length are read whole, in parts of about a megabyte; an empty
table gives an empty result; other columns, whatever their names, are passed on or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.tables import short_batches, written
from rankloom.llm.words import WORD_BYTES, mix, text_bytes

#: Documents the scorer is fitted on, about; all documents count for the labellers and are scored.
SAMPLE = 20_000
BUCKETS = 1 << 14
ROUNDS = 100
STEPS = 60
RIDGE = 1e-3
#: Least score of a document that stays; the scorer alone decides.
KEEP = 0.4

BAD, ABSTAIN, GOOD = 0, 1, 2

#: Frequent short words of the corpus languages.
COMMON = (
    "the of and to in is that it for was on are with as be by at from this or an a have not "
    "der die das und ist ein eine zu den mit von für auf im nicht des dem als auch sich "
    "le la les de des et un une est que en du dans pour sur par pas au qui il "
    "el los las y en que un una es por con para del se no al su lo"
).split()

_LETTER, _UPPER, _DIGIT, _SPACE, _STOP, _ODD = 1, 2, 4, 8, 16, 32


def _kinds() -> np.ndarray:
    table = np.full(256, _ODD, np.uint8)
    table[0x61:0x7B] = _LETTER
    table[0x41:0x5B] = _LETTER | _UPPER
    table[0x80:] = _LETTER
    table[0x30:0x3A] = _DIGIT
    table[[9, 10, 11, 12, 13, 32]] = _SPACE
    table[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
    return table


KINDS = _kinds()


@dataclass
class Tokens:
    """White-space tokens of a batch: byte ranges, hash of the word in it, its shape, owner."""

    first: np.ndarray
    word: np.ndarray
    shape: np.ndarray
    length: np.ndarray
    sums: dict[int, np.ndarray]
    ends_stop: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    kinds = KINDS[data]
    inside = kinds != _SPACE
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    begins, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(begins, offsets)
    sums, shape = {}, np.zeros(len(begins), np.uint64)
    for kind in (_LETTER, _UPPER, _DIGIT, _STOP, _ODD):
        total = np.concatenate([[0], np.cumsum((kinds & kind) > 0)])
        sums[kind] = (total[ends] - total[begins]).astype(np.int64)
        # The shape has how many bytes of each kind there are, up to three.
        shape = shape * np.uint64(4) + np.minimum(sums[kind], 3).astype(np.uint64)
    low = np.where((kinds & _LETTER) > 0, WORD_BYTES[data], 0).astype(np.uint64)
    word = np.zeros(len(begins), np.uint64)
    if len(begins):
        place = np.arange(len(data), dtype=np.uint64)
        start = np.repeat(begins, np.diff(np.append(begins, len(data)))).astype(np.uint64)
        place = place[begins[0] :] - start
        scattered = mix(low[begins[0] :] * np.uint64(1 << 20) + place) * (low[begins[0] :] > 0)
        word = np.add.reduceat(scattered, begins - begins[0])
    ends_stop = (kinds[ends - 1] & _STOP) > 0
    return Tokens(first, mix(word), shape, ends - begins, sums, ends_stop)


def _word_hash(words) -> np.ndarray:
    data, offsets = text_bytes(pa.array(list(words)))
    return tokens(data, offsets).word


COMMON_HASHES = np.unique(_word_hash(COMMON))


def _shares(t: Tokens, docs: int) -> dict[str, np.ndarray]:
    count = np.diff(t.first)

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[t.first[1:]] - sums[t.first[:-1]]

    some = np.maximum(count, 1)
    size = np.maximum(total(t.length), 1)
    letters = np.maximum(total(t.sums[_LETTER]), 1)
    same = np.zeros(len(t.word), bool)
    same[1:] = (t.word[1:] == t.word[:-1]) & (t.shape[1:] == t.shape[:-1])
    starts = t.first[:-1][count > 0]
    same[starts] = False
    owner = np.repeat(np.arange(docs), count)
    keyed = mix(t.word + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, one, times = np.unique(keyed, return_index=True, return_counts=True)
    top, run = np.zeros(docs), np.zeros(docs)
    np.maximum.at(top, owner[one], times)
    heads = np.flatnonzero(~same)
    np.maximum.at(run, owner[heads], np.diff(np.append(heads, len(same))))
    at = np.minimum(np.searchsorted(COMMON_HASHES, t.word), len(COMMON_HASHES) - 1)
    return {
        "count": count,
        "odd": total(t.sums[_ODD]) / size,
        "bars": total((t.sums[_ODD] > 0) & (t.sums[_ODD] == t.length)) / some,
        "marred": total((t.sums[_ODD] > 0) & (t.sums[_ODD] < t.length)) / some,
        "upper": total(t.sums[_UPPER]) / letters,
        "digits": total(t.sums[_DIGIT]) / size,
        "letters": letters / size,
        "same": total(same) / some,
        "top": top / some,
        "run": run,
        "distinct": np.bincount(owner[one], minlength=docs) / some,
        "stops": total(t.ends_stop) / some,
        "length": total(t.length) / some,
        "common": total(COMMON_HASHES[at] == t.word) / some,
    }


def votes(t: Tokens, docs: int) -> np.ndarray:
    """(documents, labellers) votes of a batch."""
    s = _shares(t, docs)
    long = s["count"] >= 20

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))

    return np.stack(
        [
            vote(s["odd"] > 0.06, s["odd"] < 0.01),
            vote((s["bars"] > 0.1) & long, (s["bars"] < 0.01) & long),
            vote((s["upper"] > 0.4) & long, (s["upper"] < 0.1) & long),
            vote((s["marred"] > 0.3) & long, s["marred"] < 0.05),
            vote(((s["digits"] > 0.3) | (s["letters"] < 0.6)) & long, s["letters"] > 0.9),
            vote((s["same"] > 0.2) & long, (s["same"] < 0.05) & long),
            vote((s["distinct"] < 0.15) & long, (s["distinct"] > 0.25) & long),
            vote((s["top"] > 0.25) & long, (s["top"] < 0.15) & long),
            vote((s["run"] > 5) & long, (s["run"] < 3) & long),
            vote((s["stops"] < 0.01) & long, (s["stops"] > 0.03) & (s["stops"] < 0.4)),
            vote((s["length"] > 14) | (s["length"] < 2), (s["length"] > 3) & (s["length"] < 10)),
            vote((s["common"] < 0.02) & long, (s["common"] > 0.1) & long),
        ],
        axis=1,
    ).astype(np.int64)


LABELLERS = ("symbols", "bars", "capitals", "marred words", "letters", "repeats", "variety", "top word", "runs", "sentences", "lengths", "common words")


def pattern(v: np.ndarray) -> np.ndarray:
    """Vote patterns as numbers in base 3."""
    return v @ 3 ** np.arange(v.shape[1])


@dataclass
class LabelModel:
    """``rates[class, labeller, vote]`` of the votes cast and the share of good documents. To
    abstain says nothing either way."""

    rates: np.ndarray
    good: float

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        """Chance that documents with these votes, (documents, labellers), are good."""
        weights = np.zeros(self.rates.shape[1:])
        for v in (BAD, GOOD):
            weights[:, v] = np.log(self.rates[1, :, v] / self.rates[0, :, v])
        odds = np.log(self.good / (1 - self.good)) + weights[np.arange(cast.shape[1]), cast].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, labellers: int = len(LABELLERS), rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over distinct vote patterns and how often each occurs."""
    cast = patterns[:, None] // 3 ** np.arange(labellers) % 3
    weight = counts.astype(float)
    # A bad vote is rare and deliberate, so it weighs more in the first guess.
    lean = 0.25 * (cast == GOOD).sum(axis=1) - 3.0 * (cast == BAD).sum(axis=1) + 0.5
    good = 1 / (1 + np.exp(-lean))
    model = LabelModel(np.full((2, labellers, 3), 0.5), 0.5)
    for _ in range(rounds if len(patterns) else 0):
        for k, belief in ((0, 1 - good), (1, good)):
            held = weight * belief
            for v in (BAD, GOOD):
                model.rates[k, :, v] = (held[:, None] * (cast == v)).sum(axis=0) + 1
            model.rates[k] /= (model.rates[k, :, BAD] + model.rates[k, :, GOOD])[:, None]
        model.good = float(np.clip((weight * good).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        good = model.posterior(cast)
    return model


def features(t: Tokens, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value): shares of hashed words, shapes and word-after-itself marks, and
    a mark for the share of distinct words."""
    same = np.zeros(len(t.word), bool)
    same[1:] = t.word[1:] == t.word[:-1]
    owner = np.repeat(np.arange(docs), np.diff(t.first))
    same[1:] &= owner[1:] == owner[:-1]
    kinds = [t.word, mix(t.shape + np.uint64(1 << 40)), mix(same.astype(np.uint64) + np.uint64(1 << 41))]
    size = np.maximum(np.diff(t.first), 1)
    flat = np.concatenate([owner * BUCKETS + (k >> np.uint64(50)).astype(np.int64) for k in kinds])
    key, count = np.unique(flat, return_counts=True)
    doc = key // BUCKETS
    variety = np.where(np.diff(t.first) >= 20, np.floor(20 * _shares(t, docs)["distinct"]), 30).astype(np.uint64)
    marks = (mix(variety + np.uint64(1 << 42)) >> np.uint64(50)).astype(np.int64)
    found = np.concatenate([doc, np.arange(docs)]), np.concatenate([key % BUCKETS, marks])
    value = np.concatenate([np.sqrt(count / size[doc]), np.ones(docs)])
    order = np.argsort(found[0], kind="stable")
    return found[0][order], found[1][order], value[order]


def _score(doc, bucket, value, weights: np.ndarray, bias: float, docs: int) -> np.ndarray:
    total = np.bincount(doc, value * weights[bucket], minlength=docs) + bias
    return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _parts(column: pa.Array, size: int = 1 << 20, rows: int = 512) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """About a megabyte of texts at a time, which bounds the arrays over their bytes."""
    for begin in range(0, len(column), rows):
        data, offsets = text_bytes(column.slice(begin, rows))
        count = len(offsets) - 1
        starts = np.flatnonzero(np.diff(offsets[:-1] // size, prepend=-1))
        for a, b in zip(starts, [*starts[1:], count], strict=True):
            yield slice(begin + a, begin + b), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _patterns(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), np.int64)
    for rows, data, offsets in _parts(column):
        out[rows] = pattern(votes(tokens(data, offsets), len(offsets) - 1))
    return out


@dataclass
class Scorer:
    labels: LabelModel
    weights: np.ndarray
    bias: float

    def judge(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(posterior of the votes, score) of each text; texts without words score 0."""
        weak, score = np.zeros(len(column)), np.zeros(len(column))
        has_words = np.zeros(len(column), bool)
        for rows, data, offsets in _parts(column):
            t = tokens(data, offsets)
            docs = len(offsets) - 1
            weak[rows] = self.labels.posterior(votes(t, docs))
            score[rows] = _score(*features(t, docs), self.weights, self.bias, docs)
            has_words[rows] = np.diff(t.first) > 0
        return weak * has_words, score * has_words


def fit_labels(docs: DataFrame, text: str = "text") -> LabelModel:
    """The label model of all documents; one row for each vote pattern reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, count = np.unique(_patterns(batch.column(0)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count)], names=["pattern", "n"])

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "pattern bigint, n bigint")
    rows = found.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    return fit_label_model(np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows]))


def fit_scorer(docs: DataFrame, text: str = "text", sample: int = SAMPLE, steps: int = STEPS) -> Scorer:
    """Label model over all documents and the scorer fitted on about ``sample`` of them.

    The sample is drawn by a hash of the text. Its features are a written table; each step of the
    accelerated gradient descent is one job that returns a gradient for each of a few partitions.
    """
    spark = docs.sparkSession
    short_batches(spark)
    body = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    labels = fit_labels(docs, text)
    total = docs.count()
    share = min(1.0, sample / max(1, total))
    drawn = (F.xxhash64("text", F.lit("sample")).cast("double") / F.lit(2.0**64) + 0.5 < share) | F.lit(share == 1.0)
    known = spark.sparkContext.broadcast(labels)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in _parts(batch.column(0)):
                t, docs_here = tokens(data, offsets), len(offsets) - 1
                doc, bucket, value = features(t, docs_here)
                at = np.searchsorted(doc, np.arange(docs_here + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(known.value.posterior(votes(t, docs_here))),
                        pa.ListArray.from_arrays(at, pa.array(bucket.astype(np.int32))),
                        pa.ListArray.from_arrays(at, pa.array(value.astype(np.float32))),
                    ],
                    names=["p", "buckets", "shares"],
                )

    encoded = body.where(drawn).mapInArrow(encode, "p double, buckets array<int>, shares array<float>")
    table = written(encoded.coalesce(64), "features")

    def gradient_of(weights: np.ndarray, bias: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gradient, count = np.zeros(BUCKETS + 1), 0
            for batch in batches:
                p = batch.column(0).to_numpy()
                places = batch.column(1)
                bucket, value = places.flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(float)
                doc = np.repeat(np.arange(len(p)), pa.compute.list_value_length(places).to_numpy())
                off = _score(doc, bucket, value, weights, bias, len(p)) - p
                gradient[:-1] += np.bincount(bucket, value * off[doc], minlength=BUCKETS)
                gradient[-1] += off.sum()
                count += len(p)
            yield pa.RecordBatch.from_arrays([pa.array([gradient.tolist()]), pa.array([count], pa.int64())], names=["g", "n"])

        rows = table.mapInArrow(run, "g array<double>, n bigint").collect()
        n = max(1, sum(r["n"] for r in rows))
        return sum((np.array(r["g"]) for r in rows), np.zeros(BUCKETS + 1)) / n

    # Features of a document have a squared length of at most four, so one is a safe step.
    now, ahead, momentum = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), 1.0
    for _ in range(steps if total else 0):
        slope = gradient_of(ahead[:-1], float(ahead[-1]))
        slope[:-1] += RIDGE * ahead[:-1]
        after = ahead - slope
        faster = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = after + (momentum - 1) / faster * (after - now)
        now, momentum = after, faster
    return Scorer(labels, now[:-1], float(now[-1]))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, weak, score, keep) for every document."""
    scorer = docs.sparkSession.sparkContext.broadcast(fit_scorer(docs, text, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weak, score = scorer.value.judge(batch.column(1))
            columns = [batch.column(0), pa.array(weak), pa.array(score), pa.array(score >= KEEP)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "weak", "score", "keep"])

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    key = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {key}, weak double, score double, keep boolean")


def keep_good(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs``, all columns, without the documents that the scorer rejects."""
    scorer = docs.sparkSession.sparkContext.broadcast(fit_scorer(docs, text, sample))

    @F.arrow_udf("boolean")
    def stays(texts: pa.Array) -> pa.Array:
        return pa.array(scorer.value.judge(texts)[1] >= KEEP)

    return docs.where(stays(F.col(text).cast("string")))
