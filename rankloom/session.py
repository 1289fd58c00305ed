"""Session settings for local runs and the shared scratch folder for jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session as used by tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rankloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Parsing costs far more per byte than a scan: keep small shuffles on all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, from ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master without that setting.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="rankloom-")
    context.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
