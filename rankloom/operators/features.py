"""The twelve pair features, computed in the joined row from words of bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.bitsets import PairProducts, pair_products, trimmed
from rankloom.functions.dictionary import phrases, runs
from rankloom.functions.text import bind, distinct_terms, keyed_terms, term_keys
from rankloom.functions.vectors import candidate_text, clipped_cosine, counted_terms, job_text, squared_norm, term_vector, tokens
from rankloom.operators.dictionary import match_dictionary
from rankloom.operators.encoding import HEAD, TermCodes, counted, digested, encode, term_codes, terms
from rankloom.operators.joins import is_small, lookup_join, written
from rankloom.schemas import FEATURE_COLUMNS
from rankloom.vocabulary import DEGREE_EQUIVALENTS, TERM_CHARS

_PLAIN = f"^[{TERM_CHARS}]+(?: [{TERM_CHARS}]+)*\\z"


def _mask(tests) -> Column:
    """Bits of the tests that hold."""
    total = F.lit(0)
    for i, test in enumerate(tests):
        total = total + F.when(test, F.lit(1 << i)).otherwise(F.lit(0))
    return total


def _degrees_named(text: Column) -> Column:
    return _mask(F.contains(text, F.lit(t)) for t in DEGREE_EQUIVALENTS)


def _degrees_accepted(text: Column) -> Column:
    def accepted(needles) -> Column:
        test = F.lit(False)
        for needle in needles:
            test = test | F.contains(text, F.lit(needle))
        return test

    return _mask(accepted(n) for n in DEGREE_EQUIVALENTS.values())


def education_match(named: Column, accepted: Column, required: Column) -> Column:
    matched = named.bitwiseAND(accepted) != 0
    return F.when((F.size(required) > 0) & matched, F.lit(1.0)).otherwise(F.lit(0.0))


def experience_match(candidate_years: Column, required_years: Column) -> Column:
    return F.when(required_years <= 0, F.lit(0.0)).otherwise(
        F.least(candidate_years / required_years, F.lit(1.0))
    )


def share(hits: Column, total: Column) -> Column:
    """Share of the required; 0.0 when nothing is required."""
    return F.when(total > 0, hits.cast("double") / total).otherwise(F.lit(0.0))


#: Numbers that tell rows of either side apart, as ``keep`` may ask for, if a side has them.
ROW_NUMBERS = ("candidate_row", "job_row")


def numbered_rows(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a written table with a number of ``ROW_NUMBERS`` for each row."""
    return written(rows.withColumn(name, F.monotonically_increasing_id()), name)


def _row_number(rows: DataFrame) -> list[Column]:
    return [F.col(c) for c in ROW_NUMBERS if c in rows.columns]


def _candidate_values(candidates: DataFrame) -> list[Column]:
    degrees = F.transform("education", lambda e: F.concat_ws(" ", e["degree"], e["institution"]))
    return [
        *_row_number(candidates),
        F.col("candidate_id"),
        F.col("name").alias("candidate_name"),
        F.size("skills").alias("skill_count"),
        term_keys(F.col("skills")).alias("skill_keys"),
        _degrees_named(F.lower(F.array_join(degrees, " "))).alias("degrees"),
        F.col("years_of_experience").alias("candidate_years"),
    ]


def _held() -> Column:
    return F.transform("certifications", lambda c: c["name"])


def _project_text() -> Column:
    words = F.transform(
        "projects",
        lambda p: F.concat_ws(" ", p["name"], p["description"], F.array_join(p["technologies"], " ")),
    )
    return F.lower(F.array_join(words, " "))


def candidate_profile(candidates: DataFrame, text: Column | None = None, vectors: bool = True, words: int = 1) -> DataFrame:
    """What scoring needs of a candidate: a few values and the terms of its lists, of the phrases
    of up to ``words`` words in its projects, and of its compared text."""
    text = candidate_text() if text is None else text
    base = candidates.select(
        *_candidate_values(candidates),
        term_keys(_held()).alias("held_keys"),
        _project_text().alias("project_text"),
        *([tokens(text).alias("text_terms")] if vectors else []),
    )
    found = bind(
        runs(F.col("project_text")),
        lambda ws: F.array_distinct(F.concat(*[phrases(ws, n) for n in range(1, words + 1)])),
    )
    return base.withColumn("project_keys", found)


#: How the columns of ``candidate_sources`` hold the terms of each kind.
SOURCE_FORMS = {"skill": "keyed", "certificate": "keyed", "project": "phrases", "text": "tokens"}


def candidate_sources(candidates: DataFrame, text: Column | None = None, vectors: bool = True) -> DataFrame:
    """The values of ``candidate_profile`` and in ``source_…``, by kind, what the terms are cut from."""
    text = candidate_text() if text is None else text
    base = candidates.select(
        *_candidate_values(candidates),
        F.col("skills").alias("source_skill"),
        _held().alias("source_certificate"),
        _project_text().alias("source_project"),
        *([text.alias("source_text")] if vectors else []),
    )
    if not vectors:
        return base
    whole = F.col("source_text")
    is_ascii = F.octet_length(whole) == F.char_length(whole)
    return base.withColumn(
        "source_text",
        F.struct(F.when(is_ascii, whole).alias("ascii"), F.when(~is_ascii, tokens(whole)).alias("tokens")),
    )


def candidate_terms(profile: DataFrame) -> DataFrame:
    """Profiles with a ``row`` number and their lists as one of ``terms``."""
    vectors = "text_terms" in profile.columns
    vector = [counted_terms(F.col("text_terms")).alias("candidate_vector")] if vectors else []
    base = profile.select(*[c for c in profile.columns if c != "text_terms"], *vector)
    lists = [
        terms("skills", "skill", F.col("skill_keys")),
        terms("held", "certificate", F.col("held_keys")),
        terms("projects", "project", F.col("project_keys")),
        *([counted("text", "text", F.col("candidate_vector"))] if vectors else []),
    ]
    norm2 = squared_norm(F.col("candidate_vector")) if vectors else F.lit(0).cast("long")
    return base.select(
        F.monotonically_increasing_id().alias("row"),
        *[c for c in base.columns if c not in ("held_keys", "project_keys", "candidate_vector")],
        norm2.alias("candidate_norm2"),
        F.concat(*lists).alias("terms"),
    )


#: The lists of a job and the kind of terms in each.
JOB_SLOTS = {
    "wanted": "skill",
    "required": "skill",
    "languages": "skill",
    "frameworks": "skill",
    "tools": "skill",
    "certificates": "certificate",
    "projects": "project",
}
KINDS = ("skill", "certificate", "project", "text")


def job_profile(jobs: DataFrame, text: Column | None = None, vectors: bool = True) -> DataFrame:
    every_skill = F.concat("required_skills", "preferred_skills")
    project_terms = distinct_terms(F.concat(every_skill, F.col("frameworks"), F.col("tools")))
    text = job_text() if text is None else text
    keys = {
        "wanted": term_keys(every_skill),
        "required": term_keys(F.col("required_skills")),
        "languages": term_keys(F.col("programming_languages")),
        "frameworks": term_keys(F.col("frameworks")),
        "tools": term_keys(F.col("tools")),
        "certificates": term_keys(F.col("certifications")),
        "projects": F.array_distinct(F.transform(project_terms, F.lower)),
    }
    base = jobs.select(
        *_row_number(jobs),
        "job_id",
        F.col("title").alias("job_title"),
        keyed_terms(every_skill).alias("job_wanted"),
        keyed_terms(F.col("required_skills")).alias("job_required"),
        F.col("education").alias("job_education"),
        _degrees_accepted(F.lower(F.array_join("education", " "))).alias("degrees_accepted"),
        F.col("years_of_experience").alias("required_years"),
        F.size(project_terms).alias("n_projects"),
        (F.size("education") > 0).alias("has_education"),
        (F.size("certifications") > 0).alias("has_certification"),
        (F.size("programming_languages") > 0).alias("has_language"),
        (F.size("frameworks") > 0).alias("has_framework"),
        (F.size("tools") > 0).alias("has_tool"),
        *[k.alias(f"keys_{slot}") for slot, k in keys.items()],
        *([term_vector(text).alias("job_vector")] if vectors else []),
    )
    lists = [terms(slot, kind, F.col(f"keys_{slot}")) for slot, kind in JOB_SLOTS.items()]
    if vectors:
        lists.append(counted("text", "text", F.col("job_vector")))
    norm2 = squared_norm(F.col("job_vector")) if vectors else F.lit(0).cast("long")
    sizes = [F.size(f"keys_{slot}").alias(f"n_{slot}") for slot in JOB_SLOTS if slot != "projects"]
    plain = [c for c in base.columns if not c.startswith("keys_") and c != "job_vector"]
    return base.select(F.monotonically_increasing_id().alias("row"), *plain, *sizes, norm2.alias("job_norm2"), F.concat(*lists).alias("terms"))


_PLAIN_COLUMNS = ("candidate_id", "skill_count", "degrees", "candidate_years")


def _slot(name: str) -> Column:
    """A list of an encoded row, empty if none of its terms is known."""
    none = F.lit(None).cast("struct<bits:array<bigint>,numbers:array<bigint>,counts:array<int>>")
    value = F.coalesce(F.element_at("slots", name), none)
    long, short = F.array().cast("array<bigint>"), F.array().cast("array<int>")
    return F.struct(
        F.coalesce(value["bits"], long).alias("bits"),
        F.coalesce(value["numbers"], long).alias("numbers"),
        F.coalesce(value["counts"], short).alias("counts"),
    )


def _words(bits: Column, kind: str, codes: TermCodes) -> Column:
    """Words of bits as many as the kind has."""
    return F.concat(bits, F.array_repeat(F.lit(0).cast("long"), F.lit(codes.words.get(kind, 0)) - F.size(bits)))


def _encoded_jobs(jobs: DataFrame, codes: TermCodes, keep: list[str]) -> DataFrame:
    """Jobs with the words of all lists, list after list, the numbers and counts of rare terms, and
    how many of these each list has."""
    plain = [c for c in jobs.columns if c not in ("row", "terms", "job_wanted", "job_required", "job_title")]
    rows = jobs.join(encode(jobs.select("row", "terms"), codes), "row", "left")
    parts = rows.select("*", *[_slot(s).alias(f"_{s}") for s in (*JOB_SLOTS, "text")])
    lists = [_words(F.col(f"_{s}")["bits"], kind, codes) for s, kind in JOB_SLOTS.items()]
    return parts.select(
        *plain,
        *[c for c in keep if c in jobs.columns and c not in plain],
        trimmed(F.concat(*lists, F.col("_text")["bits"])).alias("job_bits"),
        F.concat(*[F.col(f"_{s}")["numbers"] for s in (*JOB_SLOTS, "text")]).alias("job_numbers"),
        F.concat(*[F.col(f"_{s}")["counts"] for s in (*JOB_SLOTS, "text")]).alias("job_counts"),
        F.array(*[F.size(F.col(f"_{s}")["numbers"]) for s in (*JOB_SLOTS, "text")]).alias("job_sizes"),
    )


def _encoded_candidates(candidates: DataFrame, codes: TermCodes, odd: DataFrame | None, keep: list[str]) -> DataFrame:
    """Candidates with one array of words, kind after kind, and one list of rare terms."""
    entries = candidates.select("row", "terms")
    if odd is not None:
        found = match_dictionary(candidates, odd, id_column="row", text_column="project_text").groupBy("row").agg(F.collect_set("term").alias("odd"))
        more = terms("projects", "project", F.coalesce("odd", F.array().cast("array<string>")))
        entries = written(entries.join(found, "row", "left").select("row", F.concat("terms", more).alias("terms")), "terms")
    rows = candidates.drop("terms").join(encode(entries, codes), "row", "left")
    slots = ["skills", "held", "projects", "text"]
    parts = rows.select("*", *[_slot(s).alias(f"_{s}") for s in slots])

    def words(slot: str, kind: str) -> Column:
        bits = F.col(f"_{slot}")["bits"]
        return bits if kind == KINDS[-1] else _words(bits, kind, codes)

    plain = [*_PLAIN_COLUMNS, "candidate_norm2"]
    return parts.select(
        *plain,
        *[c for c in keep if c in candidates.columns and c not in plain],
        trimmed(F.concat(*[words(s, k) for s, k in zip(slots, KINDS, strict=True)])).alias("bits"),
        F.concat(*[F.col(f"_{s}")["numbers"] for s in slots]).alias("numbers"),
        F.concat(*[F.col(f"_{s}")["counts"] for s in slots]).alias("counts"),
    )


def with_facts(rows: DataFrame, candidates: DataFrame, jobs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Pair rows that kept both ``ROW_NUMBERS`` with ``columns`` of their sides, which have these numbers.

    For a few pairs out of many: all others travel and are sorted without these columns.
    """
    mine = candidate_sources(candidates, vectors=False)
    theirs = job_profile(jobs, vectors=False)
    mine = mine.select("candidate_row", *[c for c in columns if c in mine.columns])
    theirs = theirs.select("job_row", *[c for c in columns if c in theirs.columns])
    return rows.join(mine, "candidate_row").join(theirs, "job_row")


def join_pairs(
    pairs: DataFrame, candidates: DataFrame, jobs: DataFrame, small_jobs: bool | None = None
) -> DataFrame:
    """Pair rows with both prepared sides; pairs of unknown ids have none (``unknown_pairs``).

    ``jobs`` is written once, so that what is measured is what is broadcast. Candidates meet their
    pairs in one exchange on candidate_id, in which adaptive execution splits hot candidates.
    """
    jobs = written(jobs, "jobs")
    small = is_small(jobs) if small_jobs is None else small_jobs
    return lookup_join(pairs.join(candidates, "candidate_id"), jobs, "job_id", small)


def pair_rows(
    pairs: DataFrame,
    candidates: DataFrame,
    jobs: DataFrame,
    candidate_text: Column | None = None,
    job_text: Column | None = None,
    vectors: bool = True,
    keep: tuple[str, ...] = (),
    small_jobs: bool | None = None,
    head: int = HEAD,
) -> tuple[DataFrame, TermCodes]:
    """Pair rows with both sides' digests, and the codes of their terms.

    A candidate's digest is a few numbers, words of bits and the numbers of rare terms: no text,
    phrase or map goes to the pairs, whichever way the jobs are joined. ``keep`` adds columns.
    """
    asked = written(job_profile(jobs, job_text, vectors), "jobs")
    codes = term_codes(asked, head)
    is_plain, is_project = F.col("term").rlike(_PLAIN), F.col("kind") == "project"
    facts = codes.codes.where(is_project).agg(
        F.max(F.when(is_plain, F.size(F.split("term", " ")))).alias("words"), F.bool_or(~is_plain).alias("odd")
    ).first()
    sources = candidate_sources(candidates, candidate_text, vectors)
    kept = [c for c in keep if c in sources.columns and c not in _PLAIN_COLUMNS]
    asked_lists = {k: f"source_{k}" for k in KINDS if f"source_{k}" in sources.columns}
    # Where the vocabulary is small, in one narrow pass over the candidates.
    digests = None if facts["odd"] else digested(
        sources.select(*_PLAIN_COLUMNS, *kept, *asked_lists.values()), codes, asked_lists, "text", SOURCE_FORMS
    )
    if digests is not None:
        digests = digests.withColumnRenamed("norm2", "candidate_norm2")
    else:
        profile = candidate_profile(candidates, candidate_text, vectors, facts["words"] or 1)
        # Written first: Spark does not find a Python function over a conditional text.
        mine = written(candidate_terms(written(profile, "profiles")), "candidates")
        odd = codes.codes.where(is_project & ~is_plain).select("term") if facts["odd"] else None
        digests = _encoded_candidates(mine, codes, odd, list(keep))
    return join_pairs(pairs, digests, _encoded_jobs(asked, codes, list(keep)), small_jobs), codes


def pair_features(
    pairs: DataFrame,
    candidates: DataFrame,
    jobs: DataFrame,
    candidate_text: Column | None = None,
    job_text: Column | None = None,
    similarity: DataFrame | None = None,
    keep: tuple[str, ...] = (),
    small_jobs: bool | None = None,
    head: int = HEAD,
) -> DataFrame:
    """(candidate_id, job_id) pairs -> twelve features.

    ``similarity`` (candidate_id, job_id, semantic_similarity) replaces the
    default term-frequency cosine of the whole texts; ``keep`` names further columns of the joined
    row to pass on, such as ``candidate_name``; ``small_jobs`` tells whether jobs are broadcast,
    which is measured if not given.
    """
    own_vectors = similarity is None
    pairs = pairs.select("candidate_id", "job_id")
    if not own_vectors:
        # Pairs get theirs while they are narrow.
        pairs = pairs.join(similarity, ["candidate_id", "job_id"], "left")
    rows, codes = pair_rows(pairs, candidates, jobs, candidate_text, job_text, own_vectors, keep, small_jobs, head)
    starts, slots, at = codes.offsets(KINDS), [], 0
    for kind in JOB_SLOTS.values():
        slots.append((starts[kind], at, codes.words.get(kind, 0)))
        at += codes.words.get(kind, 0)
    products = PairProducts(slots, (starts["text"], at, codes.words.get("text", 0)))
    sides = ["bits", "numbers", "counts", "job_bits", "job_numbers", "job_counts", "job_sizes"]
    rows = rows.withColumn("_found", pair_products(products, list(JOB_SLOTS), *map(F.col, sides))).drop(*sides)

    def hits(slot: str) -> Column:
        return F.col("_found")[slot]

    if own_vectors:
        cosine = clipped_cosine(F.col("_found")["dot"], F.col("candidate_norm2"), F.col("job_norm2"))
    else:
        cosine = F.coalesce("semantic_similarity", F.lit(0.0))
    ratio = lambda slot: share(hits(slot), F.col(f"n_{slot}"))
    years, wanted_years = F.col("candidate_years"), F.col("required_years")
    features = {
        "semantic_similarity": cosine,
        "skill_match_percentage": ratio("wanted"),
        "experience_match_score": experience_match(years, wanted_years),
        "education_match_score": education_match(F.col("degrees"), F.col("degrees_accepted"), F.col("job_education")),
        "certification_match_score": ratio("certificates"),
        "project_relevance_score": ratio("projects"),
        "programming_language_match": ratio("languages"),
        "framework_match": ratio("frameworks"),
        "tools_match": ratio("tools"),
        "years_of_experience_difference": F.abs(years - wanted_years),
        "number_of_matching_skills": hits("required").cast("double"),
        "total_candidate_skills": F.col("skill_count").cast("double"),
    }
    return rows.select("candidate_id", "job_id", *[features[c].alias(c) for c in FEATURE_COLUMNS], *keep)
