"""Weak labels, reproducible noise, and hash-based splits.

Randomness comes from a hash of the row's key, so a rerun, a lost executor or
another partitioning gives the same rows the same values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.schemas import TARGET_COLUMN
from rankloom.vocabulary import LABEL_NOISE_SIGMA, TARGET_WEIGHTS

SEED = 42
_HEX = 13
_SPAN = float(16**_HEX)


def target_score() -> Column:
    """Weighted feature sum, clipped to [0, 1], on a 0-100 scale."""
    total = None
    for column, weight in TARGET_WEIGHTS.items():
        term = F.lit(weight) * F.col(column)
        total = term if total is None else total + term
    return F.greatest(F.least(total, F.lit(1.0)), F.lit(0.0)) * 100.0


def _keyed(keys, *salt) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys], *[F.lit(str(s)) for s in salt])


def uniform(keys, *salt) -> Column:
    """A number in (0, 1) that depends on the row's key only."""
    digits = F.substring(F.md5(_keyed(keys, *salt)), 1, _HEX)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(_SPAN)


def gaussian(keys, seed: int = SEED) -> Column:
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(keys, seed, "r")))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(keys, seed, "a"))


def with_target(
    features: DataFrame,
    keys=("candidate_id", "job_id"),
    sigma: float = LABEL_NOISE_SIGMA,
    seed: int = SEED,
) -> DataFrame:
    """Pair features -> training rows with the noisy weak label in [0, 100]."""
    noisy = target_score() + F.lit(sigma) * gaussian(keys, seed) if sigma else target_score()
    return features.withColumn(
        TARGET_COLUMN, F.greatest(F.least(noisy, F.lit(100.0)), F.lit(0.0))
    )


def fold(keys, folds: int = 5, seed: int = SEED) -> Column:
    """Fold number 0..folds-1 of a row."""
    return F.floor(uniform(keys, seed, "fold") * folds).cast("int")


def exact_holdout(
    df: DataFrame, keys, share: float = 0.20, seed: int = SEED, cells: int = 4096
) -> DataFrame:
    """Flag exactly ceil(share * n) rows as ``is_test``: those of smallest key hash.

    The greatest hash that is still flagged is found from the keys alone: the hash range is cut
    into cells, and only the cell with the boundary is sorted, about n / cells rows. The rows then
    compare with that one value in a single narrow pass. Keys tell rows apart.
    """
    order = F.struct(F.md5(_keyed(keys, seed, "split")).alias("hash"), *[F.col(k) for k in keys])
    cell = F.floor(F.conv(F.substring("order.hash", 1, 8), 16, 10).cast("double") / (2**32 / cells))
    keyed = df.select(order.alias("order")).withColumn("cell", cell.cast("int"))
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # At most ``cells`` rows reach these two single-partition windows.
    limits = keyed.groupBy("cell").count().select(
        "cell",
        (F.sum("count").over(upto) - F.col("count")).alias("below"),
        F.sum("count").over(upto).alias("upto"),
        F.ceil(F.sum("count").over(everything) * F.lit(share)).alias("wanted"),
    )
    boundary = limits.where((F.col("below") < F.col("wanted")) & (F.col("upto") >= F.col("wanted")))
    within = F.row_number().over(Window.partitionBy("cell").orderBy("order"))
    placed = keyed.join(F.broadcast(boundary), "cell").withColumn("at", F.col("below") + within)
    last = placed.where(F.col("at") == F.col("wanted")).select("order")
    return df.withColumn("is_test", F.coalesce(order <= last.scalar(), F.lit(False)))


def hash_holdout(df: DataFrame, keys, share: float = 0.20, seed: int = SEED) -> DataFrame:
    """Stateless split: about ``share`` of the rows, no exchange at all."""
    return df.withColumn("is_test", uniform(keys, seed, "split") < share)
