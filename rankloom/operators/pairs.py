"""Which candidates are scored for which job, as a table (candidate_id, job_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assign(candidates: DataFrame, job_ids) -> DataFrame:
    """All candidates for each listed job; a narrow step, linear per job."""
    listed = F.array(*[F.lit(j) for j in job_ids])
    return candidates.select("candidate_id", F.explode(listed).alias("job_id"))


def unknown_pairs(pairs: DataFrame, candidates: DataFrame, jobs: DataFrame) -> DataFrame:
    """Pairs that cannot be scored, with the reason: no such candidate, or no such job."""
    candidate = candidates.select("candidate_id").distinct().withColumn("_candidate", F.lit(True))
    job = jobs.select("job_id").distinct().withColumn("_job", F.lit(True))
    met = pairs.join(candidate, "candidate_id", "left").join(job, "job_id", "left")
    reason = F.when(F.col("_candidate").isNull(), F.lit("unknown candidate")).when(
        F.col("_job").isNull(), F.lit("unknown job")
    )
    rejects = met.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())
    return rejects.select("candidate_id", "job_id", "reject_reason")


def applications(events: DataFrame, candidate: str, job: str) -> DataFrame:
    """Distinct (candidate, job) pairs of an application or contact log.

    Rows without either id are dropped here and not left to the joins, so that all
    uses of the pairs share one exchange.
    """
    named = events.select(
        F.col(candidate).cast("string").alias("candidate_id"),
        F.col(job).cast("string").alias("job_id"),
    )
    return named.dropna().distinct()
