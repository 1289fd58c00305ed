"""Candidate and job records from raw text: one row in, one row out, no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import patterns as P
from rankloom.functions.dictionary import dictionary_terms
from rankloom.functions.text import normalize_text, section_or, sections
from rankloom.schemas import CANDIDATE_FIELDS, JOB_FIELDS
from rankloom.vocabulary import DEFAULT, Vocabulary


def parse_candidates(
    documents: DataFrame,
    vocabulary: Vocabulary = DEFAULT,
    as_of_year: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Documents -> candidate records. Empty documents belong in quarantine first."""
    raw = F.col("raw_text")
    cut = F.col("cut")
    normalized = documents.select(
        F.col(id_column).cast("string").alias("candidate_id"),
        normalize_text(F.col(text_column)).alias("raw_text"),
    )
    whole = normalized.withColumn("cut", sections(raw, vocabulary.candidate_sections))
    parts = whole.select(
        "candidate_id",
        "raw_text",
        section_or(cut, "education", raw).alias("education_text"),
        section_or(cut, "experience", raw).alias("experience_text"),
        section_or(cut, "certifications", raw).alias("certifications_text"),
        section_or(cut, "projects", F.lit("")).alias("projects_text"),
    )
    fields = {
        "candidate_id": F.col("candidate_id"),
        "name": P.person_name(raw, vocabulary),
        "email": P.email(raw),
        "phone": P.phone(raw),
        "skills": dictionary_terms(raw, vocabulary.candidate_skills),
        "education": P.education(F.col("education_text")),
        "experience": P.experience(F.col("experience_text"), vocabulary),
        "certifications": P.certifications(F.col("certifications_text"), vocabulary),
        "projects": P.projects(F.col("projects_text"), vocabulary),
        "years_of_experience": P.candidate_years(raw, as_of_year),
        "raw_text": raw,
    }
    return parts.select(*[fields[c].alias(c) for c in CANDIDATE_FIELDS])


def parse_jobs(
    documents: DataFrame,
    vocabulary: Vocabulary = DEFAULT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Documents -> requirement profiles.

    Languages, frameworks and tools are looked up in the whole text, not in the
    section of that name.
    """
    raw = F.col("raw_text")
    cut = F.col("cut")
    normalized = documents.select(
        F.col(id_column).cast("string").alias("job_id"),
        normalize_text(F.col(text_column)).alias("raw_text"),
    )
    whole = normalized.withColumn("cut", sections(raw, vocabulary.job_sections))
    parts = whole.select(
        "job_id",
        "raw_text",
        section_or(cut, "required_skills", raw).alias("required_text"),
        section_or(cut, "preferred_skills", F.lit("")).alias("preferred_text"),
        section_or(cut, "education", raw).alias("education_text"),
        section_or(cut, "certifications", raw).alias("certifications_text"),
        section_or(cut, "responsibilities", F.lit("")).alias("responsibilities_text"),
        section_or(cut, "qualifications", F.lit("")).alias("qualifications_text"),
    )
    fields = {
        "job_id": F.col("job_id"),
        "title": P.job_title(raw, vocabulary),
        "required_skills": dictionary_terms(F.col("required_text"), vocabulary.job_skills),
        "preferred_skills": dictionary_terms(F.col("preferred_text"), vocabulary.job_skills),
        "education": P.job_education(F.col("education_text")),
        "years_of_experience": P.job_years(raw),
        "certifications": P.job_certifications(F.col("certifications_text"), vocabulary),
        "programming_languages": dictionary_terms(raw, vocabulary.programming_languages),
        "frameworks": dictionary_terms(raw, vocabulary.frameworks),
        "tools": dictionary_terms(raw, vocabulary.tools),
        "responsibilities": P.bullets(F.col("responsibilities_text"), vocabulary),
        "qualifications": P.bullets(F.col("qualifications_text"), vocabulary),
        "raw_text": raw,
    }
    return parts.select(*[fields[c].alias(c) for c in JOB_FIELDS])
