"""Joins whose second side may be of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.session import scratch_path

SMALL_ROWS = 20_000
SMALL_BYTES = 64 * 1024 * 1024


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: what is measured is what is joined."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Measure rows and bytes of ``df``; only the sizes of ``max_rows + 1`` rows are gathered."""
    size = F.octet_length(F.to_json(F.struct(*df.columns))).cast("long")
    sizes = df.select(size.alias("b")).limit(max_rows + 1)
    seen = sizes.agg(F.count("*").alias("n"), F.sum("b").alias("b")).first()
    return seen["n"] <= max_rows and (seen["b"] or 0) <= max_bytes


def lookup_join(
    left: DataFrame, right: DataFrame, key, small: bool | None = None, how: str = "inner"
) -> DataFrame:
    """Broadcast ``right`` when it is small, otherwise a plain equi-join by shuffle.

    In the latter adaptive execution splits hot keys of ``left`` by their measured bytes, however
    many rows that are and whatever their columns. ``small`` passes on a measurement already made;
    by default ``right`` is measured, so it should be a written table.
    """
    if is_small(right) if small is None else small:
        return left.join(F.broadcast(right), key, how)
    return left.join(right, key, how)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one split per core.

    For scans and checkpoints, whose partitions are known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
