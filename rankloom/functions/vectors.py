"""Vector columns: sparse term-frequency vectors and dense embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.bitsets import list_values

TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _count_terms(lists: pa.Array) -> pa.Array:
    """Distinct terms of each list in order, with their numbers; null for a null list."""
    flat, owner = list_values(lists)
    coded = flat.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    size = max(1, len(order))
    key, tf = np.unique(owner * size + place[coded.indices.to_numpy().astype(np.int64)], return_counts=True)
    entries = pa.StructArray.from_arrays(
        [coded.dictionary.take(pa.array(order[key % size])), pa.array(tf.astype(np.int32))], names=["term", "tf"]
    )
    ends = np.searchsorted(key // size, np.arange(len(lists) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), entries, mask=pc.is_null(lists))


def counted_terms(terms: Column) -> Column:
    """Sparse vector array<term, tf> of a list of terms, sorted by term."""

    @F.arrow_udf("array<struct<term:string,tf:int>>")
    def count(lists: pa.Array) -> pa.Array:
        return _count_terms(lists)

    return count(terms)


def term_vector(text: Column) -> Column:
    """Sparse vector array<term, tf>, sorted by term."""
    return counted_terms(tokens(text))


def term_map(text: Column) -> Column:
    """The same vector as map<term, tf>, the form for pairwise products."""
    return F.map_from_entries(term_vector(text))


def squared_norm(vector: Column) -> Column:
    return F.aggregate(
        vector, F.lit(0).cast("long"), lambda acc, e: acc + e["tf"].cast("long") * e["tf"]
    )


def map_squared_norm(vector: Column) -> Column:
    return F.aggregate(
        F.map_values(vector), F.lit(0).cast("long"), lambda acc, tf: acc + tf.cast("long") * tf
    )


def sparse_dot(first: Column, second: Column) -> Column:
    """Dot product of two term maps; both are read once, matched by hash."""
    products = F.map_zip_with(first, second, lambda _, a, b: a.cast("long") * b)
    return F.aggregate(
        F.map_values(products),
        F.lit(0).cast("long"),
        lambda acc, p: acc + F.coalesce(p, F.lit(0).cast("long")),
    )


def clipped_cosine(dot: Column, first_norm2: Column, second_norm2: Column) -> Column:
    """dot / (|a| |b|) clipped to [0, 1]; 0.0 when either vector is zero."""
    cosine = dot / (F.sqrt(first_norm2) * F.sqrt(second_norm2))
    return F.when(
        (first_norm2 > 0) & (second_norm2 > 0), F.greatest(F.least(cosine, F.lit(1.0)), F.lit(0.0))
    ).otherwise(F.lit(0.0))


def sparse_cosine(first: Column, second: Column) -> Column:
    return clipped_cosine(
        sparse_dot(first, second), map_squared_norm(first), map_squared_norm(second)
    )


def dense_dot(first: Column, second: Column) -> Column:
    products = F.zip_with(first, second, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def dense_cosine(first: Column, second: Column) -> Column:
    return clipped_cosine(
        dense_dot(first, second), dense_dot(first, first), dense_dot(second, second)
    )


def candidate_text(years: str = "years_of_experience") -> Column:
    """Raw text of a candidate row, or its fields joined when there is none."""
    projects = F.transform(
        "projects",
        lambda p: F.concat_ws(
            " ", p["name"], p["description"], F.array_join(p["technologies"], " ")
        ),
    )
    education = F.transform("education", lambda e: F.concat_ws(" ", e["degree"], e["institution"]))
    certified = F.transform("certifications", lambda c: F.concat_ws(" ", c["name"], c["issuer"]))
    joined = F.concat_ws(
        " ",
        "name",
        F.array_join("skills", " "),
        F.array_join(education, " "),
        F.array_join("experience", " "),
        F.array_join(certified, " "),
        F.array_join(projects, " "),
        F.col(years).cast("string"),
    )
    return F.when(F.col("raw_text") != "", F.col("raw_text")).otherwise(joined)


def job_text() -> Column:
    """All fields of a job row in schema order; the raw text is one of them."""
    lists = {
        "required_skills", "preferred_skills", "education", "certifications",
        "programming_languages", "frameworks", "tools", "responsibilities", "qualifications",
    }
    order = [
        "title", "required_skills", "preferred_skills", "education", "years_of_experience",
        "certifications", "programming_languages", "frameworks", "tools", "responsibilities",
        "qualifications", "raw_text",
    ]
    parts = [
        F.array_join(c, " ") if c in lists else F.col(c).cast("string") for c in order
    ]
    return F.concat_ws(" ", *parts)
