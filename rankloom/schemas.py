"""Row types shared by all jobs, and the column contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and their order must stay as they are for results to match.
FEATURE_COLUMNS = [
    "semantic_similarity",
    "skill_match_percentage",
    "experience_match_score",
    "education_match_score",
    "certification_match_score",
    "project_relevance_score",
    "programming_language_match",
    "framework_match",
    "tools_match",
    "years_of_experience_difference",
    "number_of_matching_skills",
    "total_candidate_skills",
]
TARGET_COLUMN = "target_candidate_score"

EDUCATION = "struct<degree:string,institution:string,year:string>"
CERTIFICATION = "struct<name:string,issuer:string,year:string>"
PROJECT = "struct<name:string,description:string,technologies:array<string>>"

CANDIDATE_FIELDS = {
    "candidate_id": "string",
    "name": "string",
    "email": "string",
    "phone": "string",
    "skills": "array<string>",
    "education": f"array<{EDUCATION}>",
    "experience": "array<string>",
    "certifications": f"array<{CERTIFICATION}>",
    "projects": f"array<{PROJECT}>",
    "years_of_experience": "double",
    "raw_text": "string",
}

JOB_FIELDS = {
    "job_id": "string",
    "title": "string",
    "required_skills": "array<string>",
    "preferred_skills": "array<string>",
    "education": "array<string>",
    "years_of_experience": "double",
    "certifications": "array<string>",
    "programming_languages": "array<string>",
    "frameworks": "array<string>",
    "tools": "array<string>",
    "responsibilities": "array<string>",
    "qualifications": "array<string>",
    "raw_text": "string",
}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


TRAINING_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in [*FEATURE_COLUMNS, TARGET_COLUMN]]
)


def require_columns(df: DataFrame, columns, what: str) -> DataFrame:
    """Fail before planning when ``df`` lacks a column the job needs."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} missing columns: {missing}")
    return df
