"""Mixing to target weights by soft domain membership, with DataFrame functions only.

A labelled table trains a naive Bayes classifier over hashed words (bounded sample, see
``SAMPLE``); it gives every document a posterior over the domains. Documents then get rates
``r >= least_rate`` so that the expected tokens of each domain, ``sum(n * p * r)``, come as near as
possible to the targets. Projected gradient solves these least squares: every step is one
aggregation over the narrow table (key, tokens, posterior), which returns one number for each
domain. Residuals are weighted by the domains' present shares and steps measured in tokens, which
makes 1 a safe step length. A document's rate is a function of its posterior and the steps' few
gradients, so no state is rewritten between steps.

Defined results: a null or empty text has no tokens, the prior as its posterior and, like any
document, a rate; a null label is no label; a document with several labels trains each; without
labelled documents all posteriors are even over the targets' domains; domains that no document can
belong to are left out of the fit; repeated rows each count; texts of any length are read whole; an
empty table gives an empty result; other columns, whatever their names, are passed on or ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.tables import unused, written

#: Labelled documents the classifier is fitted on, about; the rest only get posteriors.
SAMPLE = 20_000
BUCKETS = 8192
#: Words that count as independent evidence; longer texts do not get more certain than that.
EVIDENCE = 100
STEPS = 60
TOLERANCE = 1e-4

WORD = r"[^\p{L}\p{N}]+"


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD), lambda w: w != "")


def _buckets(docs: DataFrame, *others) -> DataFrame:
    """One row for each word, with the hash bucket it falls in."""
    words = docs.select(*others, F.explode(_words(F.col("text"))).alias("word"))
    return words.select(*others, F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket"))


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: list[str], sample: int = SAMPLE) -> DataFrame:
    """(bucket, w): log weights of each bucket in every domain, in the order of ``domains``; bucket
    -1 holds the log priors. ``labels`` has (doc_id, domain). At most BUCKETS + 1 rows."""
    known = labels.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).distinct()
    total = known.count()
    share = min(1.0, sample / max(1, total))
    # About ``sample`` narrow rows, whatever the table's size: the one side that is broadcast.
    fair = (F.xxhash64("doc_id", F.lit("sample")).cast("double") / F.lit(2.0**64) + 0.5) < share
    chosen = known.where(fair | F.lit(share == 1.0))
    training = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    prior = training.groupBy("domain").agg(F.count("*").alias("n")).select(F.lit(-1).alias("bucket"), "domain", "n")
    counts = _buckets(training, "domain").groupBy("bucket", "domain").agg(F.count("*").alias("n"))
    table = counts.unionByName(prior).groupBy("bucket").pivot("domain", domains).agg(F.sum("n"))
    table = written(table.na.fill(0), "counts")
    sums = table.where("bucket >= 0").agg(*[F.coalesce(F.sum(F.col(f"`{d}`")), F.lit(0)).alias(f"d{i}") for i, d in enumerate(domains)]).first()
    docs_in = table.where("bucket < 0").first()
    all_docs = sum(docs_in[d] for d in domains) if docs_in else 0
    rows = [
        F.when(
            F.col("bucket") < 0,
            F.log((F.coalesce(F.col(f"`{d}`"), F.lit(0)) + 1) / F.lit(float(all_docs + len(domains)))),
        ).otherwise(F.log((F.col(f"`{d}`") + 1) / F.lit(float(sums[i] + BUCKETS))))
        for i, d in enumerate(domains)
    ]
    every = docs.sparkSession.range(-1, BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    return written(every.join(table, "bucket", "left").na.fill(0).select("bucket", F.array(*rows).alias("w")), "weights")


def posteriors(docs: DataFrame, weights: DataFrame, domains: list[str]) -> DataFrame:
    """(doc_id, text_key, copies, n_tokens, p): one row for each distinct (doc_id, text)."""
    spaced = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")).cast("long")
    # A marker row keeps texts without words; it carries the tokens and counts the copies. All that
    # is computed once for each text stands below the explode.
    words = F.transform(_words(F.col("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    keyed = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), spaced.alias("n"), F.concat(F.array(F.lit(-1)), words).alias("buckets")
    )
    marked = keyed.select("doc_id", "text_key", "n", F.explode("buckets").alias("bucket"))
    logs = [F.sum(F.when(F.col("bucket") >= 0, F.col("w")[i])).alias(f"s{i}") for i in range(len(domains))]
    first = F.col("bucket") < 0
    summed = (
        marked.join(F.broadcast(weights), "bucket")
        .groupBy("doc_id", "text_key")
        .agg(F.count_if(first).alias("copies"), F.max("n").alias("n_tokens"), F.count_if(~first).alias("words"), *logs)
    )
    prior = weights.where("bucket < 0").first()["w"]
    scale = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) * F.col("copies") / F.greatest("words", F.lit(1))) / F.col("copies")
    scores = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) * scale + F.lit(float(prior[i])) for i in range(len(domains))]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    raised = summed.withColumn("e", F.transform(F.array(*scores), lambda s: F.exp(s - top)))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return raised.select("doc_id", "text_key", "copies", "n_tokens", F.transform("e", lambda x: x / total).alias("p"))


def _rate(p: Column, moves: list[list[float]], least: float) -> Column:
    """A document's rate after the moves; each move is a gradient, one number for each domain."""
    # Literal text keeps the plan small: the moves are a few numbers a step.
    steps = F.from_json(F.lit(json.dumps(moves)), "array<array<double>>")

    def move(r: Column, g: Column) -> Column:
        down = F.aggregate(F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(F.lit(least), r - down)

    return F.aggregate(steps, F.lit(1.0), move)


def fit_rates(
    table: DataFrame,
    targets: dict[str, float],
    budget: float | None = None,
    least_rate: float = 0.0,
    steps: int = STEPS,
    tolerance: float = TOLERANCE,
) -> tuple[list[list[float]], dict[str, tuple[float, float]]]:
    """(moves, {domain: (wanted, expected tokens)}) for the posterior table.

    ``budget``: tokens wanted in all; by default those there are, or with ``least_rate`` > 0 as
    many as let every domain reach its weight at that rate or above.
    """
    domains = list(targets)
    weight = sum(targets.values())
    n = F.col("n_tokens") * F.col("copies")

    def expected(moves: list[list[float]]) -> list[float]:
        rate = _rate(F.col("p"), moves, least_rate) if moves else F.lit(1.0)
        sums = table.select((n * rate).alias("x"), "p")
        row = sums.agg(*[F.sum(F.col("x") * F.col("p")[i]).alias(f"t{i}") for i in range(len(domains))]).first()
        return [float(x or 0.0) for x in row]

    present = expected([])
    total = sum(present)
    if budget is None:
        reach = [least_rate * s * weight / targets[d] for d, s in zip(domains, present, strict=True) if targets[d] > 0]
        budget = max([total if least_rate == 0 else 0.0, *reach]) if reach else total
    wanted = [budget * targets[d] / weight for d in domains]
    moves: list[list[float]] = []
    now = present
    for _ in range(steps):
        if max((abs(a - b) for a, b in zip(now, wanted, strict=True)), default=0.0) <= tolerance * max(budget, 1.0):
            break
        moves.append([(a - b) / s if s > 0 else 0.0 for a, b, s in zip(now, wanted, present, strict=True)])
        now = expected(moves)
    return moves, {d: (w, t) for d, w, t in zip(domains, wanted, now, strict=True)}


def rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    budget: float | None = None,
    least_rate: float = 0.0,
    sample: int = SAMPLE,
) -> DataFrame:
    """(doc_id, text_key, copies, n_tokens, p, rate) for each distinct (doc_id, text).

    ``docs`` has doc_id and text, ``labels`` (doc_id, domain), ``targets`` weights by domain.
    """
    domains = list(targets)
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    weights = fit_classifier(narrow, labels, domains, sample)
    table = written(posteriors(narrow, weights, domains), "posteriors")
    moves, _ = fit_rates(table, targets, budget, least_rate)
    return table.withColumn("rate", _rate(F.col("p"), moves, least_rate) if moves else F.lit(1.0))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], seed: int = 7, **settings) -> DataFrame:
    """``docs``, all columns, each row as often as its rate says.

    The whole part of a rate is certain; the rest is decided by a hash of the row's key, so a
    recomputed task decides alike.
    """
    rated = rates(docs, labels, targets, **settings)
    names = {n: unused(docs, n) for n in ("mix_id", "mix_key", "mix_rate", "mix_copy")}
    rated = rated.select(F.col("doc_id").alias(names["mix_id"]), F.col("text_key").alias(names["mix_key"]), F.col("rate").alias(names["mix_rate"]))
    same = F.col("doc_id").eqNullSafe(F.col(names["mix_id"])) & (text_key(F.col("text").cast("string")) == F.col(names["mix_key"]))
    chance = F.xxhash64(names["mix_id"], names["mix_key"], F.lit(seed)).cast("double") / F.lit(2.0**64) + 0.5
    rate = F.col(names["mix_rate"])
    copies = (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")
    found = docs.join(rated, same).withColumn(names["mix_copy"], copies).where(F.col(names["mix_copy"]) > 0)
    repeated = found.withColumn(names["mix_copy"], F.explode(F.sequence(F.lit(1), F.col(names["mix_copy"]))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
