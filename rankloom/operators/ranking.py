"""Score, sort and rank candidates per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.text import bind
from rankloom.operators.joins import lookup_join
from rankloom.operators.labels import target_score
from rankloom.session import materialize
from rankloom.vocabulary import CONFIDENCE_SPREAD_FACTOR, CONFIDENCE_WITHOUT_TREES

SCORE = "predicted_score"
CONFIDENCE = "confidence_estimate"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def clip_score(value: Column) -> Column:
    return F.greatest(F.least(value, F.lit(100.0)), F.lit(0.0))


def confidence(tree_predictions: Column) -> Column:
    """100 minus three population standard deviations of the tree predictions."""
    n = F.size(tree_predictions)
    total = F.aggregate(tree_predictions, F.lit(0.0), lambda acc, p: acc + p)
    def deviation(mean: Column) -> Column:
        squares = F.transform(
            tree_predictions, lambda p: (p - mean) * (p - mean)
        )
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s) / n)

    return clip_score(
        F.lit(100.0) - bind(total / n, deviation) * F.lit(CONFIDENCE_SPREAD_FACTOR)
    )


def score_by_formula(features: DataFrame, score: Column | None = None) -> DataFrame:
    """Score without a model: a Column expression, confidence fixed."""
    value = target_score() if score is None else score
    return features.withColumn(SCORE, clip_score(value)).withColumn(
        CONFIDENCE, F.lit(CONFIDENCE_WITHOUT_TREES)
    )


def _order() -> list[Column]:
    return [F.col(SCORE).desc(), F.col(CONFIDENCE).desc(), F.col("candidate_id").asc()]


def rank_top(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best per job; tasks drop all but ``k`` rows per job before the exchange."""
    window = Window.partitionBy("job_id").orderBy(*_order())
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def rank_all(scored: DataFrame, partitions: int | None = None) -> DataFrame:
    """Full ranking 1..n per job that never puts one job into one task.

    Give it only the columns that the ranking needs: its rows are written and sorted.

    Rows are range-partitioned on (job, order); a hot job is split among tasks
    since the candidate id is part of the range key. The rank is the position in
    the partition plus the sizes of the partitions before it. The sorted rows are
    checkpointed so that positions and sizes come from the same partitioning.
    """
    spark = scored.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("job_id").asc(), *_order()]
    # Written first: choosing the ranges samples the rows, which would compute them twice.
    placed = (
        materialize(scored).repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = (
        materialize(placed)
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    pieces = placed.groupBy("job_id", "_part").agg(
        F.count("*").alias("_n"), F.min("_row").alias("_first")
    )
    before = (
        Window.partitionBy("job_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = pieces.select(
        "job_id",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    ranked = lookup_join(placed, offsets, ["job_id", "_part"])
    return ranked.withColumn("rank", F.col("_row") + F.col("_shift")).drop(
        "_at", "_part", "_row", "_shift"
    )


def name_or_stem(name: Column, path: Column) -> Column:
    """The parsed name, else the file name without its last suffix."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)/*$", 1), r"(?<=.)\.[^.]*$", "")
    return F.coalesce(F.nullif(name, F.lit("")), stem)


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest integer with ties to even, scale back."""
    return F.rint(value * float(10**digits)) / float(10**digits)


def rankings(ranked: DataFrame, name: Column | None = None) -> DataFrame:
    """Output columns, similarity to 4 and score to 2 decimals, half-even.

    A candidate without a name is shown by the stem of its id, the file it came from.
    """
    shown = name_or_stem(F.col("candidate_name"), F.col("candidate_id")) if name is None else name
    return ranked.select(
        "job_id",
        "rank",
        shown.alias("candidate_name"),
        round_half_even(F.col("semantic_similarity"), 4).alias("similarity_score"),
        round_half_even(F.col(SCORE), 2).alias("predicted_score"),
    )
