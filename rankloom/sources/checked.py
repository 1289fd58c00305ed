"""Tables read from text formats with the malformed records set aside, and folders read by what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.joins import written
from rankloom.sources.files import exists, manifest

_CORRUPT = "_corrupt_record"


def read_checked(
    spark: SparkSession, path: str, fields: str, kind: str, required: tuple[str, ...] = (), **options
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of a folder of CSV or JSON lines.

    ``fields`` is the schema as DDL. A record that does not fit it is rejected as malformed, one
    without a ``required`` value as incomplete; rejects are (source, record, reason). Both come from
    one judged table that is written, so they are complementary.
    """
    reader = spark.read.schema(f"{fields}, {_CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    # All columns are parsed, whichever are asked for, so that a record is judged the same each time.
    reader = reader.options(columnPruning=False, **options)
    rows = reader.csv(path) if kind == "csv" else reader.json(path)
    columns = [c for c in rows.columns if c != _CORRUPT]
    incomplete = F.lit(False)
    for c in required:
        incomplete = incomplete | F.col(c).isNull()
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed")).when(incomplete, F.lit("incomplete"))
    whole = F.to_csv(F.struct(*columns)) if kind == "csv" else F.to_json(F.struct(*columns))
    judged = written(
        rows.select(
            *columns,
            F.col("_metadata.file_path").alias("_source"),
            F.coalesce(F.col(_CORRUPT), whole).alias("_record"),
            reason.alias("_reason"),
        ),
        "checked",
    )
    rejects = judged.where("_reason IS NOT NULL")
    accepted = judged.where("_reason IS NULL").select(*columns)
    return accepted, rejects.select(F.col("_source").alias("source"), F.col("_record").alias("record"), F.col("_reason").alias("reason"))


def changed_files(spark: SparkSession, path: str, glob: str, known: DataFrame | None) -> DataFrame:
    """The manifest rows of files that are new or changed against ``known``, an earlier manifest."""
    listed = manifest(spark, path, glob)
    return listed if known is None else listed.join(known, ["path", "length", "modificationTime"], "left_anti")


def read_changed(spark: SparkSession, path: str, manifests: str, glob: str = "*.txt") -> DataFrame:
    """(doc_id, text) of the files that are new or changed since the last run, whose manifest is in the
    folder ``manifests``; the run's own manifest is added there as the next number. The text of a
    file that is not UTF-8 is null, which quarantine sets aside; Spark lists no files without bytes.

    Only paths come to the driver, which lists folders in any case; files that did not change are
    not opened.
    """
    run = 0
    while exists(spark, f"{manifests}/{run}/_SUCCESS"):
        run += 1
    known = spark.read.parquet(f"{manifests}/{run - 1}") if run else None
    listed = manifest(spark, path, glob)
    listed.write.mode("overwrite").parquet(f"{manifests}/{run}")
    paths = [r["path"] for r in changed_files(spark, path, glob, known).select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "doc_id string, text string")
    files = spark.read.format("binaryFile").load(paths)
    text = F.col("content").cast("string")
    return files.select(F.col("path").alias("doc_id"), F.when(F.is_valid_utf8(text), text).alias("text"))
