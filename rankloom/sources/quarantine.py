"""Set unusable documents aside with a reason and carry on with the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import strip


def with_reject_reason(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add ``reject_reason``; null means accepted."""
    reason = F.when(F.col(text).isNull(), F.lit("unreadable")).when(
        strip(F.replace(F.col(text), F.lit("\0"), F.lit(" "))) == "", F.lit("empty")
    )
    return documents.withColumn("reject_reason", reason)


def quarantine(documents: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects): two complementary filters on one pass expression."""
    judged = with_reject_reason(documents, text)
    accepted = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, judged.where(F.col("reject_reason").isNotNull())


def require_any(accepted: DataFrame, what: str = "documents") -> DataFrame:
    """Fail the whole job only when nothing is left to work on."""
    if accepted.isEmpty():
        raise ValueError(f"No valid {what} were found.")
    return accepted
