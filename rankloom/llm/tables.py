"""Small helpers for tables: written intermediates, unused column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows and bytes of text that go to a Python worker at once.
BATCH_ROWS = 500
BATCH_BYTES = 4 * 1024 * 1024


def short_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session, whose default of 10,000 rows can hold gigabytes of
    text; smaller settings stay as they are."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key, str(most + 1))
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
