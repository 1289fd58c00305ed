"""Queries over the text tables: clean-up, lines, sections, patterns, terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions import patterns as P
from rankloom.functions import text as X
from rankloom.functions.dictionary import dictionary_terms, keyword_coverage, runs
from rankloom.functions.vectors import dense_cosine, term_vector
from rankloom.operators.dictionary import match_dictionary
from rankloom.operators.joins import lookup_join, spread, written
from rankloom.operators.lines import line_sections, line_table, section_texts
from rankloom.operators.similarity import top_matches, vectorize
from rankloom.plans.catalog import query
from rankloom.plans.market import table
from rankloom.session import scratch_path
from rankloom.sources.checked import read_changed, read_checked
from rankloom.sources.files import assemble_pages, clean_documents
from rankloom.sources.quarantine import quarantine
from rankloom.sources.reuse import reuse_by_content

# Recurring lines of the documents, used as section headers.
LICENSE_SECTIONS = {
    "apache": ("licensed under the apache license version",),
    "mit": ("released under the mit license",),
    "gnu": ("this work is licensed under the gnu general public license version",),
    "reserved": ("all rights reserved",),
}
# Single words, phrases and a term that a full stop keeps from matching.
DOCUMENT_TERMS = (
    "The", "of the", "Apache License", "MIT License", "GNU General Public License",
    "All rights", "attion to", "version 2.0", "der", "die", "que le", "de la", "and",
)
TERM_CLASSES = {
    "license": ("Apache License", "MIT License", "GNU General Public License"),
    "english": ("The", "and", "of the"),
    "german": ("der", "die", "und"),
    "french": ("de la", "le", "les"),
}

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LINES = f"""
lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS raw
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
),
meaningful AS (
  SELECT doc_id, pos, trim(raw, ' -' || chr(9)) AS line FROM lines
  WHERE trim(raw, ' -' || chr(9)) <> ''
)"""
_KEY = "trim(regexp_replace(lower({0}), '[^a-z0-9+#]+', ' ', 'g'))"
_HEADER = "trim(regexp_replace(lower({0}), '[^a-z ]', '', 'g'))"
_ALIASES = "aliases(alias, section) AS (VALUES " + ", ".join(
    f"('{a}', '{s}')" for s, names in LICENSE_SECTIONS.items() for a in names
) + ")"
_NORMALIZED = f"trim(regexp_replace(text, '\\n{{3,}}', chr(10) || chr(10), 'g'), {_WS})"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _occurs(term: str) -> str:
    escaped = term.lower().replace(".", "\\.").replace("+", "\\+").replace("#", "\\#")
    edge = "[^a-z0-9+#.-]"
    return f"regexp_matches(lower(text), '(^|{edge}){escaped}($|{edge})')"


@query(
    "B1",
    f"""
WITH spaced AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '[ \\t]+', ' ', 'g'),
                                 '\\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM pages)
SELECT page_id, trim(array_to_string(list_transform(string_split(t, chr(10)),
       lambda l: trim(l, {_WS})), chr(10)), {_WS}) AS text
FROM spaced""",
)
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text")))
    return clean_documents(pages)


@query("B2", f"SELECT doc_id, {_NORMALIZED} AS text FROM documents")
def normalized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", X.normalize_text(F.col("text")).alias("text"))


@query(
    "B3",
    f"""WITH {_LINES}
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos, line FROM meaningful""",
)
def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = documents(spark, sf_dir).select(
        "doc_id", F.posexplode(X.meaningful_lines(F.col("text"))).alias("pos", "line")
    )
    return lines.select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "line")


@query(
    "B4",
    """
SELECT doc_id, CASE WHEN t = '' THEN ' ' ELSE t END AS text
FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)""",
)
def collapsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", X.collapse_whitespace(F.col("text")).alias("text")
    )


@query("B5", f"SELECT doc_id, {_KEY.format('text')} AS token_key FROM documents")
def token_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", X.token_key(F.col("text")).alias("token_key"))


@query(
    "B6",
    """
SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(p_name, ' '),
       lambda w: w <> ''), lambda w: upper(w[1:1]) || w[2:]), ' ') AS title
FROM part""",
)
def part_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", X.capitalize_words(F.col("p_name")).alias("title"))


@query(
    "B7",
    f"""WITH {_LINES}, {_ALIASES}
SELECT doc_id, pos, section FROM lines JOIN aliases ON {_HEADER.format('raw')} = alias""",
)
def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = documents(spark, sf_dir).select(
        "doc_id", F.posexplode(X.raw_lines(F.col("text"))).alias("pos", "raw")
    )
    named = lines.withColumn("section", X.section_name(F.col("raw"), LICENSE_SECTIONS))
    return named.where("section IS NOT NULL").select(
        "doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "section"
    )


_SECTIONS = f"""{_LINES}, {_ALIASES},
marked AS (
  SELECT doc_id, pos, raw, section FROM lines LEFT JOIN aliases ON {_HEADER.format('raw')} = alias),
placed AS (
  SELECT doc_id, pos, raw, section IS NOT NULL AS is_header,
         last_value(section IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
  FROM marked),
section_texts AS (
  SELECT doc_id, section,
         trim(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT is_header), ''), {_WS}) AS text
  FROM placed WHERE section IS NOT NULL GROUP BY doc_id, section)"""


@query("B8", f"WITH {_SECTIONS} SELECT doc_id, section, text FROM section_texts")
def license_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = documents(spark, sf_dir).select(
        "doc_id", X.sections(F.col("text"), LICENSE_SECTIONS).alias("cut")
    )
    names = F.array_distinct(F.transform("cut", lambda s: s["label"]))
    each = cut.withColumn("section", F.explode(names))
    text = F.coalesce(
        *[
            F.when(F.col("section") == n, X.section_text(F.col("cut"), n))
            for n in LICENSE_SECTIONS
        ]
    )
    return each.select("doc_id", "section", text.alias("text"))


@query("B8", f"WITH {_SECTIONS} SELECT doc_id, section, text FROM section_texts")
def license_sections_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the line table, cut into 64 parts wherever documents end."""
    lines = line_table(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return section_texts(line_sections(lines, LICENSE_SECTIONS, parts=64))


@query(
    "A3 B8",
    f"""WITH {_ALIASES},
lines AS (
  SELECT source, doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS raw
  FROM (SELECT source, doc_id, string_split(text, chr(10)) AS ls FROM documents)),
marked AS (
  SELECT source, doc_id, pos, raw, section FROM lines LEFT JOIN aliases ON {_HEADER.format('raw')} = alias),
placed AS (
  SELECT source, doc_id, pos, raw, section IS NOT NULL AS is_header,
    last_value(section IGNORE NULLS) OVER w AS section, count(section) OVER w AS opened
  FROM marked WINDOW w AS (PARTITION BY source ORDER BY doc_id, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT source, opened, any_value(section) AS section, count(*) FILTER (NOT is_header) AS n_lines,
  CAST(coalesce(sum(length(raw)) FILTER (NOT is_header), 0) AS BIGINT) AS n_chars,
  arg_max(doc_id, (doc_id, pos)) AS last_doc, arg_max(raw, (doc_id, pos)) AS last_line
FROM placed WHERE section IS NOT NULL AND source IS NOT NULL GROUP BY source, opened""",
)
def source_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of a source, in order of doc_id, as one document that no row or task holds."""
    order = ("doc_id", "pos")
    lines = line_table(table(spark, sf_dir, "documents"), "source", place=("doc_id",))
    found = line_sections(lines, LICENSE_SECTIONS, "source", order, parts=128)
    body, place = F.col("own").isNull(), F.struct(*order)
    return found.groupBy("source", "opened").agg(
        F.first("label").alias("section"),
        F.count_if(body).alias("n_lines"),
        F.coalesce(F.sum(F.when(body, F.char_length("line"))), F.lit(0)).cast("long").alias("n_chars"),
        F.max_by("doc_id", place).alias("last_doc"),
        F.max_by("line", place).alias("last_line"),
    )


@query(
    "B9",
    f"""WITH {_SECTIONS}
SELECT d.doc_id, coalesce(s.text, d.text) AS apache_or_whole, coalesce(m.text, '') AS mit_or_empty
FROM documents d
LEFT JOIN section_texts s ON s.doc_id = d.doc_id AND s.section = 'apache'
LEFT JOIN section_texts m ON m.doc_id = d.doc_id AND m.section = 'mit'""",
)
def section_or_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = documents(spark, sf_dir).withColumn("cut", X.sections(F.col("text"), LICENSE_SECTIONS))
    return cut.select(
        "doc_id",
        X.section_or(F.col("cut"), "apache", F.col("text")).alias("apache_or_whole"),
        X.section_or(F.col("cut"), "mit", F.lit("")).alias("mit_or_empty"),
    )


_EMAIL = "[\\p{L}\\p{N}_.+-]+@[\\p{L}\\p{N}_-]+\\.[\\p{L}\\p{N}_.-]+"
_PHONE = "\\(?\\+?[0-9][0-9\\s().-]{7,}[0-9]"
_NAME_WORD = "[A-Za-z][A-Za-z''.-]*"


@query("C1", f"SELECT doc_id, lower(regexp_extract(text, '{_EMAIL}')) AS email FROM documents")
def document_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", P.email(F.col("text")).alias("email"))


@query(
    "C2",
    f"""
SELECT doc_id, coalesce(list_filter(list_transform(regexp_extract_all(text, '{_PHONE}'),
         lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'), ' |,;')),
         lambda p: length(regexp_replace(p, '[^0-9]', '', 'g')) BETWEEN 10 AND 15)[1], '') AS phone
FROM documents""",
)
def document_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", P.phone(F.col("text")).alias("phone"))


@query(
    "C4",
    f"""WITH {_LINES},
letters AS (
  SELECT doc_id, pos, raw, trim(regexp_replace(raw, '[^A-Za-z .''-]', '', 'g')) AS v
  FROM lines WHERE pos <= 8),
names AS (
  SELECT doc_id, arg_min(v, pos) AS v FROM letters
  WHERE regexp_full_match(v, '{_NAME_WORD}( +{_NAME_WORD}){{1,3}}')
    AND NOT regexp_matches(lower(v), '(^| )(resume|curriculum|email|phone|skills|education)( |$)')
    AND NOT regexp_matches(raw, '{_EMAIL}') AND NOT regexp_matches(raw, '{_PHONE}')
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(array_to_string(list_transform(list_filter(string_split(v, ' '),
       lambda w: w <> ''), lambda w: upper(w[1:1]) || w[2:]), ' '), '') AS name
FROM documents d LEFT JOIN names USING (doc_id)""",
)
def document_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", P.person_name(F.col("text")).alias("name"))


@query(
    "C13 C17",
    f"""WITH {_LINES}, {_ALIASES},
content AS (
  SELECT doc_id, pos, line FROM meaningful LEFT JOIN aliases ON {_HEADER.format('line')} = alias
  WHERE alias IS NULL)
SELECT doc_id, trim(arg_min(line, pos), ' -:') AS title, count(*) AS n_lines,
       string_agg(line, '|' ORDER BY pos) AS content
FROM content GROUP BY doc_id""",
)
def document_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title line and content lines under the license-line vocabulary."""
    from dataclasses import replace

    from rankloom.vocabulary import DEFAULT

    vocabulary = replace(DEFAULT, job_sections=LICENSE_SECTIONS)
    rows = documents(spark, sf_dir).select(
        "doc_id",
        P.job_title(F.col("text"), vocabulary).alias("title"),
        P.bullets(F.col("text"), vocabulary).alias("lines"),
    )
    return rows.where(F.size("lines") > 0).select(
        "doc_id",
        "title",
        F.size("lines").cast("long").alias("n_lines"),
        F.array_join("lines", "|").alias("content"),
    )


@query(
    "D1",
    "SELECT doc_id, ord, term FROM documents, (VALUES "
    + ", ".join(f"({i}, '{t}')" for i, t in enumerate(DOCUMENT_TERMS))
    + ") AS terms(ord, term) WHERE CASE ord "
    + " ".join(f"WHEN {i} THEN {_occurs(t)}" for i, t in enumerate(DOCUMENT_TERMS))
    + " END",
)
def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of a fixed dictionary per document, with their dictionary position."""
    found = documents(spark, sf_dir).select(
        "doc_id", F.explode(dictionary_terms(F.col("text"), DOCUMENT_TERMS)).alias("term")
    )
    position = F.array_position(F.array(*[F.lit(t) for t in DOCUMENT_TERMS]), F.col("term")) - 1
    return found.select("doc_id", position.cast("int").alias("ord"), "term")


_CLASS_CASES = " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS category, "
    + " + ".join(f"CASE WHEN {_occurs(t)} THEN 1 ELSE 0 END" for t in terms)
    + " AS n_terms FROM documents"
    for c, terms in TERM_CLASSES.items()
)


@query("D2", f"SELECT * FROM ({_CLASS_CASES}) WHERE n_terms > 0")
def term_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of matched terms per document and dictionary class."""
    counts = F.array(
        *[
            F.struct(
                F.lit(c).alias("category"),
                F.size(dictionary_terms(F.col("text"), terms)).alias("n_terms"),
            )
            for c, terms in TERM_CLASSES.items()
        ]
    )
    rows = documents(spark, sf_dir).select("doc_id", F.explode(counts).alias("c"))
    return rows.select("doc_id", "c.category", "c.n_terms").where("n_terms > 0")


@query(
    "D3",
    "SELECT doc_id, round(("
    + " + ".join(f"CASE WHEN {_occurs(t)} THEN 1 ELSE 0 END" for t in DOCUMENT_TERMS)
    + f") / {len(DOCUMENT_TERMS)}.0::DOUBLE, 9) AS coverage FROM documents",
)
def term_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    coverage = keyword_coverage(F.col("text"), DOCUMENT_TERMS)
    return documents(spark, sf_dir).select("doc_id", F.round(coverage, 9).alias("coverage"))


_RUNS = (
    "string_split(regexp_replace(lower({0}), '[^a-z0-9+#. -]', '  ', 'g'), ' ')"
)


@query(
    "D1",
    f"""
WITH item_words AS (SELECT unnest({_RUNS.format('text')}) AS w FROM benchmark),
item_pairs AS (
  SELECT unnest(list_transform(range(1, len(ws)), lambda i: [ws[i], ws[i + 1]])) AS p
  FROM (SELECT {_RUNS.format('text')} AS ws FROM benchmark)),
lexicon AS (
  SELECT DISTINCT w AS term FROM item_words WHERE w <> ''
  UNION
  SELECT DISTINCT p[1] || ' ' || p[2] FROM item_pairs WHERE p[1] <> '' AND p[2] <> ''),
found AS (
  SELECT doc_id, unnest(ws) AS phrase FROM (SELECT doc_id, {_RUNS.format('text')} AS ws FROM documents)
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))
  FROM (SELECT doc_id, {_RUNS.format('text')} AS ws FROM documents))
SELECT DISTINCT doc_id, term FROM found JOIN lexicon ON phrase = term""",
)
def benchmark_term_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of a table-sized lexicon: all words and word pairs of the profiles."""
    words = table(spark, sf_dir, "benchmark").select(runs(F.col("text")).alias("ws"))
    single = words.select(F.explode("ws").alias("term")).where("term <> ''")
    pairs = words.select(
        F.explode(
            F.transform("ws", lambda w, i: F.struct(w.alias("a"), i.alias("i")))
        ).alias("first"),
        "ws",
    ).select(F.col("first.a").alias("a"), F.get("ws", F.col("first.i") + 1).alias("b"))
    double = pairs.where("a <> '' AND b <> ''").select(F.concat_ws(" ", "a", "b").alias("term"))
    lexicon = single.unionByName(double).distinct()
    return match_dictionary(documents(spark, sf_dir), lexicon)


@query(
    "D4",
    f"""WITH {_LINES},
firsts AS (
  SELECT doc_id, min(pos) AS pos, arg_min(line, pos) AS line FROM meaningful
  GROUP BY doc_id, lower(line))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos, line FROM firsts""",
)
def distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = X.distinct_ignoring_case(X.meaningful_lines(F.col("text")))
    rows = documents(spark, sf_dir).select("doc_id", F.posexplode(unique).alias("pos", "line"))
    return rows.select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "line")


@query(
    "D6",
    f"""WITH {_LINES},
firsts AS (
  SELECT doc_id, min(pos) AS pos, arg_min(line, pos) AS line FROM meaningful
  WHERE {_KEY.format('line')} <> '' GROUP BY doc_id, {_KEY.format('line')})
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos, line FROM firsts""",
)
def distinct_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = X.distinct_terms(X.meaningful_lines(F.col("text")))
    rows = documents(spark, sf_dir).select("doc_id", F.posexplode(unique).alias("pos", "line"))
    return rows.select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "line")


_TOKENS = "unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))"


@query(
    "F3",
    f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TOKENS} AS term FROM documents) "
    "GROUP BY doc_id, term",
)
def term_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select(
        "doc_id", F.explode(term_vector(F.col("text"))).alias("e")
    )
    return rows.select("doc_id", "e.term", F.col("e.tf").cast("long").alias("tf"))


@query(
    "F4 I5",
    """
WITH cells AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x
  FROM embeddings),
centroid AS (SELECT label, i, avg(x) AS c FROM cells GROUP BY label, i),
scored AS (
  SELECT label, vec_id, greatest(0.0, least(1.0, sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))))) AS cosine
  FROM cells JOIN centroid USING (label, i) GROUP BY label, vec_id)
SELECT label, vec_id, round(cosine, 6) AS cosine,
       row_number() OVER (PARTITION BY label ORDER BY round(cosine, 6) DESC, vec_id) AS rank
FROM scored""",
)
def centroid_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense cosine of each vector with its label's mean vector, ranked per label."""
    from rankloom.operators.ranking import CONFIDENCE, SCORE, rank_all

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    means = (
        vectors.select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("c"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("i", "c"))).alias("cells"))
        .select("label", F.transform("cells", lambda c: c["c"]).alias("centroid"))
    )
    scored = lookup_join(vectors, means, "label").select(
        F.col("label").alias("job_id"),
        F.col("vec_id").alias("candidate_id"),
        F.round(dense_cosine(F.col("embedding"), F.col("centroid")), 6).alias(SCORE),
        F.lit(0.0).alias(CONFIDENCE),
    )
    return rank_all(scored).select(
        F.col("job_id").alias("label"),
        F.col("candidate_id").alias("vec_id"),
        F.col(SCORE).alias("cosine"),
        F.col("rank").cast("long").alias("rank"),
    )


_ODD_WORDS = r"""
words AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '\p{L}+'))) AS term FROM documents),
lexicon AS (SELECT term FROM words WHERE regexp_matches(term, '[^\x00-\x7F]') GROUP BY term
  ORDER BY count(*) DESC, term LIMIT 5000),
lowered AS MATERIALIZED (SELECT doc_id, lower(text) AS low FROM documents),
near AS MATERIALIZED (SELECT doc_id, low, term FROM lowered JOIN lexicon ON contains(low, term))"""


@query(
    "D1",
    f"""WITH {_ODD_WORDS}
SELECT doc_id, term FROM near
WHERE regexp_matches(low, '(^|[^a-z0-9+#.-])' || term || '([^a-z0-9+#.-]|$)')""",
)
def odd_term_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5,000 words with letters beyond ASCII that most documents hold, wherever they match."""
    docs = documents(spark, sf_dir)
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    odd = docs.select(F.explode(words).alias("term")).where(F.col("term").rlike(r"[^\x00-\x7F]"))
    lexicon = odd.groupBy("term").count().orderBy(F.col("count").desc(), "term").limit(5000)
    return match_dictionary(docs, written(lexicon.select("term"), "lexicon")).select("doc_id", "term")


@query(
    "F3 F4 F5 D3 H1 I1 I5",
    f"""
WITH dt AS (SELECT doc_id, term, count(*) AS tf FROM
              (SELECT doc_id, {_TOKENS} AS term FROM documents) GROUP BY doc_id, term),
it AS (SELECT item_id, term, count(*) AS tf FROM
              (SELECT item_id, {_TOKENS} AS term FROM benchmark) GROUP BY item_id, term),
dn AS (SELECT doc_id, sum(tf * tf) AS n FROM dt GROUP BY doc_id),
jn AS (SELECT item_id, sum(tf * tf) AS n, count(*) AS terms FROM it GROUP BY item_id),
sums AS (SELECT item_id, doc_id, sum(dt.tf * it.tf) AS dot, count(*) AS shared
         FROM dt JOIN it USING (term) GROUP BY item_id, doc_id),
scored AS (
  SELECT item_id, doc_id, shared, dot / (sqrt(dn.n) * sqrt(jn.n)) AS cosine,
         shared::DOUBLE / jn.terms AS coverage
  FROM sums JOIN dn USING (doc_id) JOIN jn USING (item_id)),
ranked AS (
  SELECT *, 0.40::DOUBLE * cosine + 0.20::DOUBLE * coverage AS s,
         row_number() OVER (PARTITION BY item_id
           ORDER BY 0.40::DOUBLE * cosine + 0.20::DOUBLE * coverage DESC, doc_id) AS rank
  FROM scored)
SELECT item_id, rank, doc_id, shared, round(cosine, 9) AS cosine, round(coverage, 9) AS coverage,
       round(least(greatest(s, 0.0), 1.0) * 100.0, 6) AS score
FROM ranked WHERE rank <= 5""",
)
def profile_top_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best documents for each benchmark profile by weak score."""
    candidates = vectorize(documents(spark, sf_dir), "doc_id", "text")
    profiles = vectorize(table(spark, sf_dir, "benchmark"), "item_id", "text")
    best = top_matches(
        candidates.withColumnRenamed("doc_id", "candidate_id"),
        profiles.withColumnRenamed("item_id", "job_id"),
        k=5,
    )
    return best.select(
        F.col("job_id").alias("item_id"),
        F.col("rank").cast("long").alias("rank"),
        F.col("candidate_id").alias("doc_id"),
        "shared",
        F.round("cosine", 9).alias("cosine"),
        F.round("coverage", 9).alias("coverage"),
        F.round("score", 6).alias("score"),
    )


@query(
    "A3",
    """
SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
)
def assembled_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return assemble_pages(turns, "conv_id", "turn", "text")


@query(
    "A4",
    """
SELECT doc_id, reason, n FROM (
  SELECT d.doc_id, length(d.text) AS n,
         CASE WHEN l.quality IS NULL THEN 'unreadable' WHEN l.quality = 0 THEN 'empty'
              ELSE 'accepted' END AS reason
  FROM documents d LEFT JOIN labels l USING (doc_id))""",
)
def quarantined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled texts are withheld (null), low-quality ones blanked; both sides of the split."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = documents(spark, sf_dir).join(labels, "doc_id", "left").select(
        "doc_id",
        F.length("text").cast("long").alias("n"),
        F.when(F.col("quality") == 1, F.col("text"))
        .when(F.col("quality") == 0, F.lit(" \n\t\0"))
        .alias("text"),
    )
    accepted, rejects = quarantine(rows)
    sides = accepted.withColumn("reject_reason", F.lit("accepted")).unionByName(rejects)
    return sides.select("doc_id", F.col("reject_reason").alias("reason"), "n")


@query(
    "E6",
    f"""
SELECT kind, id, {_KEY.format('text')} AS token_key FROM (
  SELECT 'document' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'profile', item_id, text FROM benchmark
  UNION ALL SELECT 'turn', conv_id * 1000 + turn, text FROM conversations)""",
)
def united_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text table out of three sources."""
    turns = table(spark, sf_dir, "conversations")
    parts = [
        table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"),
        table(spark, sf_dir, "benchmark").select(F.lit("profile").alias("kind"), F.col("item_id").alias("id"), "text"),
        turns.select(F.lit("turn").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"),
    ]
    united = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return united.select("kind", "id", X.token_key(F.col("text")).alias("token_key"))


# --- files ----------------------------------------------------------------------


def _spoilt_lines(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Order lines as CSV or JSON text; every 7th is cut, every 11th has a word for the quantity, every
    13th lacks it, by order and line number."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("o"), F.col("l_linenumber").cast("string").alias("n"),
        F.col("l_quantity").cast("int").cast("string").alias("q"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
    )
    number = F.when(F.col("k") % 11 == 0, F.lit("many")).when(F.col("k") % 13 == 0, F.lit("" if kind == "csv" else "null")).otherwise(F.col("q"))
    if kind == "csv":
        whole, cut = F.concat_ws(",", "o", "n", number), F.concat_ws(",", "o", "n")
    else:
        head = F.concat(F.lit('{"o":'), "o", F.lit(',"n":'), "n", F.lit(',"q":'))
        value = F.when(number == "many", F.lit('"many"')).otherwise(number)
        whole, cut = F.concat(head, value, F.lit("}")), head
    path = scratch_path(spark, f"spoilt-{kind}")
    rows.select(F.when(F.col("k") % 7 == 0, cut).otherwise(whole).alias("value")).write.text(path)
    return path


def _both_sides(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    path = _spoilt_lines(spark, sf_dir, kind)
    accepted, rejects = read_checked(spark, path, "o bigint, n int, q int", kind, ("q",))
    fine = accepted.select(F.concat_ws(",", "o", "n", "q").alias("record"), F.lit("accepted").alias("reason"))
    from_there = F.col("source").contains(path.rsplit("/", 1)[1])
    return fine.unionByName(rejects.where(from_there).select("record", "reason"))


def _spoilt_sql(record: str, cut: str, missing: str) -> str:
    return f"""
WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, l_quantity::INT AS q, l_orderkey * 8 + l_linenumber AS k FROM lineitem)
SELECT CASE WHEN k % 7 = 0 THEN {cut} WHEN k % 11 = 0 THEN {record} WHEN k % 13 = 0 THEN {missing}
    ELSE o || ',' || n || ',' || q END AS record,
  CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN 'malformed' WHEN k % 13 = 0 THEN 'incomplete' ELSE 'accepted' END AS reason
FROM l"""


@query("A4 A5", _spoilt_sql("o || ',' || n || ',many'", "o || ',' || n", "o || ',' || n || ','"))
def checked_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with broken rows, read into what fits and what does not."""
    return _both_sides(spark, sf_dir, "csv")


_JSON = "'{\"o\":' || o || ',\"n\":' || n || "


@query("A4 A9", _spoilt_sql(_JSON + "',\"q\":\"many\"}'", _JSON + "',\"q\":'", _JSON + "'}'"))
def checked_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with broken rows, read into what fits and what does not."""
    return _both_sides(spark, sf_dir, "json")


def _write_rosters(folder: str, rows: DataFrame) -> None:
    """One text file for each nation and segment, in order of customer; others stay as they are."""
    ordered = rows.repartition("nation", "segment").sortWithinPartitions("nation", "segment", "c_custkey")
    files = ordered.select("nation", "segment", "value")
    files.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("nation", "segment").text(folder)


@query(
    "A1 A2",
    """
WITH r AS (
  SELECT 1 AS run, c_nationkey AS nation, c_mktsegment AS segment, c_custkey, c_name AS line FROM customer
  UNION ALL
  SELECT 2, c_nationkey, c_mktsegment, c_custkey, c_name || ' again' FROM customer WHERE c_nationkey % 3 = 0)
SELECT run, nation::INT AS nation, segment, md5(string_agg(line, chr(10) ORDER BY c_custkey) || chr(10)) AS text_md5, count(*) AS n_lines
FROM r GROUP BY run, nation, segment""",
)
def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rosters as files; a second run reads only those that were written anew."""
    folder, manifests = scratch_path(spark, "rosters"), scratch_path(spark, "manifests")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_custkey", F.col("c_name").alias("value")
    )
    runs = []
    for run in (1, 2):
        if run == 2:
            rows = rows.where(F.col("nation") % 3 == 0).withColumn("value", F.concat_ws(" ", "value", F.lit("again")))
        _write_rosters(folder, rows)
        read = read_changed(spark, folder, manifests)
        part = lambda name, kind: F.regexp_extract("doc_id", f"{name}=([^/]+)", 1).cast(kind).alias(name)
        # Read before the next run writes files anew.
        runs.append(
            written(
                read.select(
                    F.lit(run).alias("run"), part("nation", "int"), part("segment", "string"), F.md5("text").alias("text_md5"),
                    F.regexp_count("text", F.lit("\n")).cast("long").alias("n_lines"),
                ),
                "run",
            )
        )
    return runs[0].unionByName(runs[1])


@query(
    "A12",
    """
WITH r AS (
  SELECT 1 AS run, true AS built, c_nationkey AS nation, c_acctbal FROM customer
  UNION ALL SELECT 2, false, c_nationkey, c_acctbal FROM customer
  UNION ALL SELECT 3, true, c_nationkey, c_acctbal FROM customer
  UNION ALL SELECT 3, true, s_nationkey, s_acctbal FROM supplier
  UNION ALL SELECT 4, true, c_nationkey, c_acctbal FROM customer WHERE c_acctbal >= 0
  UNION ALL SELECT 4, true, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal >= 0)
SELECT run, built, nation::INT AS nation, count(*) AS n, round(max(c_acctbal), 2) AS most
FROM r GROUP BY run, built, nation""",
)
def reused_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset by content: built, reused, built again for more files, built again for another filter."""
    accounts, kept = scratch_path(spark, "accounts"), scratch_path(spark, "kept")

    def rows(name: str, short: str) -> DataFrame:
        columns = [F.col(f"{short}_nationkey").cast("int").alias("nation"), F.col(f"{short}_acctbal").cast("double").alias("balance")]
        return table(spark, sf_dir, name).select(*columns)

    def per_nation(least: float | None = None) -> tuple[DataFrame, bool]:
        read = spark.read.parquet(accounts)
        read = read if least is None else read.where(F.col("balance") >= least)
        result = read.groupBy("nation").agg(F.count("*").alias("n"), F.round(F.max("balance"), 2).alias("most"))
        return reuse_by_content(result, kept, [accounts])

    rows("customer", "c").write.parquet(accounts)
    runs = [per_nation(), per_nation()]
    rows("supplier", "s").write.mode("append").parquet(accounts)
    runs += [per_nation(), per_nation(0.0)]
    marked = [df.select(F.lit(i).alias("run"), F.lit(built).alias("built"), "*") for i, (df, built) in enumerate(runs, 1)]
    return reduce(DataFrame.unionByName, marked)
