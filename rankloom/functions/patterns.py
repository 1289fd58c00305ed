"""Field extraction from candidate and job texts, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.dictionary import dictionary_terms
from rankloom.functions.text import (
    any_word,
    bind,
    capitalize_words,
    distinct_ignoring_case,
    first_by_key,
    keep_only,
    meaningful_lines,
    raw_lines,
    regex,
    section_name,
    spans,
    strip,
)
from rankloom.vocabulary import (
    CANDIDATE_DEGREE,
    CANDIDATE_YEARS,
    DEFAULT,
    EMAIL,
    FIELD_EDGES,
    INSTITUTION_BREAK,
    ISSUER_BREAK,
    JOB_DEGREE,
    JOB_YEARS,
    NAME_WORD,
    PHONE,
    PHONE_EDGES,
    YEAR,
    YEAR_RANGE,
    Vocabulary,
)

_YEAR = regex(YEAR)


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _first(items: Column) -> Column:
    return F.coalesce(F.get(items, F.lit(0)), F.lit(""))


def _is_header(line: Column, aliases: dict) -> Column:
    return section_name(line, aliases).isNotNull()


def year_in(line: Column) -> Column:
    return F.regexp_extract(line, _YEAR, 0)


def email(text: Column) -> Column:
    """First e-mail address in lower case, else the empty string."""
    found = F.lower(F.regexp_extract(text, regex(EMAIL), 0))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(F.lit(""))


def phone(text: Column) -> Column:
    """First phone-like run with 10 to 15 digits, else the empty string."""
    tidy = F.transform(
        _all(text, regex(PHONE)),
        lambda p: strip(F.regexp_replace(p, regex(r"\s+"), " "), PHONE_EDGES),
    )

    def digits(p: Column) -> Column:
        return F.length(F.regexp_replace(p, r"\P{Nd}", ""))

    return _first(F.filter(tidy, lambda p: digits(p).between(10, 15)))


def looks_like_name(value: Column, blocked=DEFAULT.not_a_name) -> Column:
    """Two to four words of letters, none of them blocked."""
    word = NAME_WORD
    shape = f"^{word}(?: +{word}){{1,3}}\\z"
    return value.rlike(shape) & ~value.rlike(f"(?i)(?:^| )(?:{'|'.join(blocked)})(?: |\\z)")


def person_name(text: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    """First of the top eight lines that has the shape of a person's name."""

    def name(line: Column, letters: Column) -> Column:
        contact = line.rlike(regex(EMAIL)) | line.rlike(regex(PHONE))
        return F.when(looks_like_name(letters, vocabulary.not_a_name) & ~contact, letters)

    names = F.transform(
        F.slice(raw_lines(text), 1, 8),
        lambda l: bind(
            F.trim(keep_only(l, "A-Za-z .'-")), lambda v: name(l, v)
        ),
    )
    return capitalize_words(_first(F.array_compact(names)))


def institution(line: Column, degree: Column) -> Column:
    """What remains of an education line once degree and years are removed."""
    rest = F.regexp_replace(F.replace(line, degree, F.lit("")), _YEAR, "")
    parts = F.transform(F.split(rest, regex(INSTITUTION_BREAK)), lambda p: strip(p, FIELD_EDGES))
    return _first(F.filter(parts, lambda p: p != ""))


def education(text: Column) -> Column:
    """One record per line that names a degree; distinct on the degree."""
    pattern = regex(CANDIDATE_DEGREE, ignore_case=True)

    def record(line: Column) -> Column:
        return bind(
            strip(F.regexp_extract(line, pattern, 0), FIELD_EDGES),
            lambda degree: F.struct(
                degree.alias("degree"),
                institution(line, degree).alias("institution"),
                year_in(line).alias("year"),
            ),
        )

    lines = F.filter(meaningful_lines(text), lambda l: l.rlike(pattern))
    return first_by_key(F.transform(lines, record), lambda e: F.lower(e["degree"]))


def experience(text: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    """Lines with a role word or a year range; section headers skipped."""
    role = any_word(vocabulary.role_words)
    period = regex(YEAR_RANGE, ignore_case=True)
    lines = F.filter(
        meaningful_lines(text),
        lambda l: (l.rlike(role) | l.rlike(period))
        & ~_is_header(l, vocabulary.candidate_sections),
    )
    return distinct_ignoring_case(lines)


def certifications(text: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    """Cue-word lines as name / issuer / year; distinct on the name."""
    cue = any_word(vocabulary.candidate_certification_cues)

    def record(line: Column) -> Column:
        bare = strip(F.regexp_replace(line, _YEAR, ""), FIELD_EDGES)
        parts = F.transform(
            F.split(bare, regex(ISSUER_BREAK), 2), lambda p: strip(p, FIELD_EDGES)
        )
        return bind(
            parts,
            lambda ps: F.struct(
                _first(ps).alias("name"),
                F.coalesce(F.get(ps, F.lit(1)), F.lit("")).alias("issuer"),
                year_in(line).alias("year"),
            ),
        )

    lines = F.filter(
        meaningful_lines(text),
        lambda l: l.rlike(cue) & ~_is_header(l, vocabulary.candidate_sections),
    )
    return first_by_key(F.transform(lines, record), lambda c: F.lower(c["name"]))


def is_project_heading(line: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    def by_words(ws: Column) -> Column:
        long_words = F.filter(ws, lambda w: F.length(w) > 2)
        titled = (F.size(long_words) > 0) & F.forall(long_words, lambda w: w.rlike("^[A-Z]"))
        return F.when(F.size(ws).between(2, 6), titled).otherwise(F.endswith(line, F.lit(":")))

    return (
        F.when(F.length(line) > 90, False)
        .when(F.endswith(line, F.lit(".")), False)
        .when(line.rlike(any_word(vocabulary.project_heading_cues)), True)
        .otherwise(bind(_all(line, NAME_WORD), by_words))
    )


def projects(text: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    """Heading lines open a project, the lines below describe it.

    Without any project, every cue-word line counts as one.
    """

    def record(name: Column, description: Column) -> Column:
        return F.struct(
            strip(name, " -:").alias("name"),
            description.alias("description"),
            dictionary_terms(
                F.concat_ws(" ", name, description), vocabulary.candidate_skills
            ).alias("technologies"),
        )

    def collect(lines: Column) -> Column:
        content = F.filter(lines, lambda l: ~_is_header(l, vocabulary.candidate_sections))
        groups = spans(
            content, lambda l: F.when(is_project_heading(l, vocabulary), strip(l, " -:"))
        )
        headed = F.transform(
            F.filter(groups, lambda g: g["label"] != ""),
            lambda g: record(g["label"], strip(F.array_join(g["body"], " "))),
        )
        cue = any_word(vocabulary.project_line_cues)
        loose = F.transform(
            F.filter(lines, lambda l: l.rlike(cue)), lambda l: record(l, F.lit(""))
        )
        return bind(headed, lambda hs: F.when(F.size(hs) > 0, hs).otherwise(loose))

    found = bind(meaningful_lines(text), collect)
    return first_by_key(found, lambda p: F.lower(p["name"]))


def _largest(numbers: Column) -> Column:
    return F.array_max(F.transform(numbers, lambda n: n.try_cast("double")))


def candidate_years(text: Column, as_of_year: int | None = None) -> Column:
    """Largest stated years, else the longest year range, else 0.0.

    ``as_of_year`` is what "present" stands for; the current year by default.
    """
    now = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    period = regex(YEAR_RANGE, ignore_case=True)

    def length(start: Column, end: Column) -> Column:
        until = F.when(F.lower(end) == "present", now).otherwise(end.try_cast("int"))
        return (until - start.try_cast("int")).cast("double")

    lengths = F.zip_with(_all(text, period, 1), _all(text, period, 2), length)
    longest = F.array_max(F.filter(lengths, lambda y: y >= 0))
    stated = _largest(_all(text, regex(CANDIDATE_YEARS, ignore_case=True), 1))
    return F.coalesce(stated, longest, F.lit(0.0))


def job_title(text: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    """First meaningful line that is not a section header."""
    lines = F.filter(
        meaningful_lines(text), lambda l: ~_is_header(l, vocabulary.job_sections)
    )
    return strip(_first(lines), " -:")


def job_education(text: Column) -> Column:
    phrases = _all(text, regex(JOB_DEGREE, ignore_case=True))
    return distinct_ignoring_case(F.transform(phrases, lambda p: strip(p, " -,.")))


def job_years(text: Column) -> Column:
    stated = _largest(_all(text, regex(JOB_YEARS, ignore_case=True), 1))
    return F.coalesce(stated, F.lit(0.0))


def job_certifications(text: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    """Whole cue-word lines; headers are not skipped."""
    cue = any_word(vocabulary.job_certification_cues)
    lines = F.filter(meaningful_lines(text), lambda l: l.rlike(cue))
    return distinct_ignoring_case(F.transform(lines, lambda l: strip(l, " -,.")))


def bullets(text: Column, vocabulary: Vocabulary = DEFAULT) -> Column:
    return F.filter(
        meaningful_lines(text), lambda l: ~_is_header(l, vocabulary.job_sections)
    )
