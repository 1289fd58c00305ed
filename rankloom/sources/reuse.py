"""Datasets kept under a key made of what computes them and what they read.

A result is looked up by ``content_key``: the normalised plan of the query, its columns, and the
path, length and time of every input file. A changed query or a changed input gives another key, so
a stale dataset is never read; the same query on the same files finds the dataset of any earlier
session.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.sources.files import manifest

#: Longest field list that a plan's text may shorten; wide plans must be told apart in full.
_ALL_FIELDS = str(1_000_000)


def _plan_text(df: DataFrame) -> str:
    """The analysed plan with its column ids numbered from zero."""
    conf, name = df.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    before = conf.get(name, None)
    conf.set(name, _ALL_FIELDS)
    try:
        return df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        conf.set(name, before) if before is not None else conf.unset(name)


def inputs_digest(spark: SparkSession, inputs: list[str], glob: str = "*") -> str:
    """One digest of the files below all ``inputs``, whatever their order; no file is opened.

    An input without files is an error. The digest is a sum of 64-bit hashes, gathered in one row.
    """
    listed = None
    for path in inputs:
        one = manifest(spark, path, glob).select(F.lit(path).alias("input"), "path", "length", "modificationTime")
        listed = one if listed is None else listed.unionByName(one)
    if listed is None:
        return "none"
    hashed = [F.xxhash64(F.lit(salt), "input", "path", "length", "modificationTime").cast("decimal(38,0)") for salt in (1, 2)]
    row = listed.agg(F.count("*"), *[F.sum(h) for h in hashed]).first()
    return "/".join(map(str, row))


def content_key(df: DataFrame, inputs: list[str], version: str = "") -> str:
    """Key of the rows of ``df``, which reads the files below ``inputs``.

    ``version`` stands for what a plan does not show: the code of Python functions and the rows of
    tables made on the driver.
    """
    parts = [version, _plan_text(df), df.schema.json(), inputs_digest(df.sparkSession, inputs)]
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()


def _committed(spark: SparkSession, folder: str) -> str | None:
    """The attempt below ``folder`` that was committed first; Spark's success marker commits."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    markers = sorted((s.getModificationTime(), s.getPath().getParent().toString()) for s in found or [])
    return markers[0][1] if markers else None


def reuse_by_content(df: DataFrame, folder: str, inputs: list[str], version: str = "") -> tuple[DataFrame, bool]:
    """The rows of ``df``, read from ``folder`` if they were written there before, and whether they were built.

    Each writer has a folder of its own below the key, so two writers of the same key never touch
    each other's files, and a job that died half-way leaves an attempt without marker, which
    nobody reads. Whoever asks later reads the attempt that was committed first.
    """
    spark = df.sparkSession
    place = f"{folder.rstrip('/')}/{content_key(df, inputs, version)}"
    found = _committed(spark, place)
    if built := found is None:
        df.write.parquet(f"{place}/{uuid.uuid4().hex}")
        found = _committed(spark, place)
    return spark.read.parquet(found), built
