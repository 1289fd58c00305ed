"""Queries over the rendered market: records, pairs, features, ranking, review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.functions import text as X
from rankloom.functions.vectors import candidate_text, job_text
from rankloom.operators import forest
from rankloom.operators.encoding import numbered
from rankloom.operators.features import ROW_NUMBERS, join_pairs, numbered_rows, pair_features, with_facts
from rankloom.operators.joins import is_small, written
from rankloom.operators.lines import line_projects, line_table
from rankloom.operators.labels import exact_holdout, fold, hash_holdout, target_score, with_target
from rankloom.operators.pairs import unknown_pairs
from rankloom.operators.ranking import (
    CONFIDENCE,
    SCORE,
    confidence,
    name_or_stem,
    rank_all,
    rank_top,
    rankings,
    round_half_even,
    score_by_formula,
)
from rankloom.operators.records import parse_candidates, parse_jobs
from rankloom.operators.review import (
    REVIEW_COLUMNS,
    assessment,
    interview,
    reports,
    review,
    score_label,
)
from rankloom.operators.similarity import encode, hashing_encoder, pair_similarity
from rankloom.plans.catalog import query
from rankloom.plans.market import (
    AS_OF_YEAR,
    candidate_documents,
    job_documents,
    market_applications,
    table,
    vocabulary,
)
from rankloom.plans.market_truth import (
    DEGREE,
    FACTS,
    NAME,
    PROJECTS,
    REGION_DEGREE,
    SHOWN,
    features as truth,
)
from rankloom.schemas import CANDIDATE_FIELDS, FEATURE_COLUMNS, TARGET_COLUMN
from rankloom.plans.jobs import train_model
from rankloom.session import scratch_path, shared_dir
from rankloom.sources.files import (
    exists,
    from_record,
    read_training,
    reuse_or_create,
    to_record,
    write_csv,
    write_reports,
)

_PAIR = ("candidate_id", "job_id")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_candidates(candidate_documents(spark, sf_dir), vocabulary(spark, sf_dir), AS_OF_YEAR)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_jobs(job_documents(spark, sf_dir), vocabulary(spark, sf_dir))


def features(
    spark: SparkSession, sf_dir: str, pairs: DataFrame | None = None, keep: tuple[str, ...] = (), **settings
) -> DataFrame:
    """Features of the pairs; what is compared are the whole texts of both sides."""
    pairs = market_applications(spark, sf_dir) if pairs is None else pairs
    return pair_features(pairs, candidates(spark, sf_dir), jobs(spark, sf_dir), keep=keep, **settings)


def _rounded_score(df: DataFrame) -> DataFrame:
    return df.withColumn(SCORE, F.round(SCORE, 6))


def _rounded(columns, digits: int = 6) -> list[Column]:
    return [F.round(c, digits).alias(c) for c in columns]


def _sql_rounded(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


# --- records -----------------------------------------------------------------


@query(
    "C1 C2 C4",
    f"""WITH {FACTS}
SELECT c::VARCHAR AS candidate_id, {NAME} AS name, 'customer' || c || '@example.com' AS email,
       '+' || (c_nationkey + 10) || ' 555 ' || lpad(c::VARCHAR, 7, '0') AS phone
FROM cust JOIN customer ON c_custkey = c""",
)
def candidate_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("candidate_id", "name", "email", "phone")


@query(
    "D1 D4 G12",
    f"""WITH {FACTS}
SELECT cust.c::VARCHAR AS candidate_id, coalesce(string_agg(skill, ', ' ORDER BY t, b), '') AS skills
FROM cust LEFT JOIN cs USING (c) GROUP BY cust.c""",
)
def candidate_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir)
    return rows.select("candidate_id", F.array_join("skills", ", ").alias("skills"))


@query(
    "C3 C5 C6 D5",
    f"""WITH {FACTS}
SELECT cust.c::VARCHAR AS candidate_id, {DEGREE} AS degree, n_name || ' College' AS institution,
       coalesce((SELECT min(year(o_orderdate)) FROM orders WHERE o_custkey = cust.c)::VARCHAR, '') AS year
FROM cust""",
)
def candidate_education(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir).select("candidate_id", F.explode("education").alias("e"))
    return rows.select("candidate_id", "e.degree", "e.institution", "e.year")


@query(
    "C7",
    f"""WITH {FACTS}
SELECT c::VARCHAR AS candidate_id, string_agg('Engineer on ' || priority || ' orders ' || a || ' - ' ||
         CASE WHEN z = 2001 THEN 'Present' ELSE z::VARCHAR END, '|' ORDER BY priority) AS experience
FROM periods GROUP BY c""",
)
def candidate_experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = X.bind(F.col("experience"), lambda e: F.when(F.size(e) > 0, F.array_join(e, "|")))
    return _told(candidates(spark, sf_dir), told, "experience")


def _told(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Candidates with a value. A plain filter would move below the records and parse them twice."""
    found = rows.select("candidate_id", F.explode_outer(F.array(value)).alias(name))
    return found.where(F.col(name).isNotNull())


@query(
    "C3 C8 D5",
    f"""WITH {FACTS}
SELECT c::VARCHAR AS candidate_id, 'Certified ' || brand || ' handler' AS name,
       'Board ' || region AS issuer, year::VARCHAR AS year
FROM cb JOIN cust USING (c)""",
)
def candidate_certifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Not ``explode``: Spark adds a filter to it that parses the records twice.
    rows = candidates(spark, sf_dir).select("candidate_id", F.explode_outer("certifications").alias("c"))
    return rows.where(F.col("c").isNotNull()).select("candidate_id", "c.name", "c.issuer", "c.year")


def _project_text() -> Column:
    lines = F.transform(
        "projects",
        lambda p: F.concat_ws(
            ":", p["name"], p["description"], F.array_join(p["technologies"], ", ")
        ),
    )
    return F.array_join(lines, "|")


@query(
    "C9 C10 D1",
    f"""WITH {FACTS}, {PROJECTS}
SELECT c::VARCHAR AS candidate_id, projects FROM projects""",
)
def candidate_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir).where(F.size("projects") > 0)
    return rows.select("candidate_id", _project_text().alias("projects"))


@query(
    "B8 C9 C10 C17",
    f"""WITH {FACTS}, {PROJECTS}
SELECT c::VARCHAR AS candidate_id, projects FROM projects""",
)
def candidate_projects_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the line table, whose parts end in the middle of documents."""
    lines = line_table(candidate_documents(spark, sf_dir))
    found = line_projects(lines, vocabulary(spark, sf_dir), parts=97)
    told = F.concat_ws(":", "name", "description", F.array_join("technologies", ", "))
    rows = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", told.alias("told")))).alias("p"))
    text = F.array_join(F.transform("p", lambda e: e["told"]), "|")
    return rows.select(F.col("doc_id").alias("candidate_id"), text.alias("projects"))


@query(
    "C11 C12",
    f"WITH {FACTS} SELECT c::VARCHAR AS candidate_id, years AS years_of_experience FROM cy",
)
def candidate_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("candidate_id", "years_of_experience")


_RECORD_SQL = f"""WITH {FACTS}, {PROJECTS}
SELECT cust.c::VARCHAR AS candidate_id, {NAME} AS name, 'customer' || cust.c || '@example.com' AS email,
       (SELECT count(*) FROM cs WHERE cs.c = cust.c) AS n_skills, {DEGREE} AS degree,
       (SELECT count(*) FROM cb WHERE cb.c = cust.c) AS n_certifications,
       (SELECT count(*) FROM periods WHERE periods.c = cust.c) AS n_experience,
       coalesce(projects, '') AS projects, years AS years_of_experience
FROM cust JOIN cy USING (c) LEFT JOIN projects USING (c)"""


def _record_summary(rows: DataFrame) -> DataFrame:
    return rows.select(
        "candidate_id",
        "name",
        "email",
        F.size("skills").cast("long").alias("n_skills"),
        F.get("education", F.lit(0))["degree"].alias("degree"),
        F.size("certifications").cast("long").alias("n_certifications"),
        F.size("experience").cast("long").alias("n_experience"),
        _project_text().alias("projects"),
        "years_of_experience",
    )


@query("C18", _RECORD_SQL)
def candidate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record_summary(candidates(spark, sf_dir))


@query("A8 A9", _RECORD_SQL)
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested candidate records to JSON text and back."""
    return _record_summary(from_record(to_record(candidates(spark, sf_dir)), CANDIDATE_FIELDS))


@query(
    "C13 C14 C15 C16 C17 C19 D2",
    f"""WITH {FACTS},
both_lists AS (SELECT DISTINCT s, t, b, skill FROM (FROM jr UNION ALL FROM jp))
SELECT supp.s::VARCHAR AS job_id, s_name AS title,
  coalesce((SELECT string_agg(skill, ', ' ORDER BY t, b) FROM jr WHERE jr.s = supp.s), '') AS required,
  coalesce((SELECT string_agg(skill, ', ' ORDER BY t, b) FROM jp WHERE jp.s = supp.s), '') AS preferred,
  {REGION_DEGREE} AS education, jy.years AS years_of_experience,
  coalesce((SELECT string_agg('Certified ' || brand || ' handler', '|' ORDER BY b) FROM jb
            WHERE jb.s = supp.s), '') AS certifications,
  coalesce((SELECT string_agg(skill, ', ' ORDER BY t, b) FROM both_lists x
            WHERE x.s = supp.s AND t IN ('ECONOMY', 'LARGE')), '') AS languages,
  coalesce((SELECT string_agg(skill, ', ' ORDER BY t, b) FROM both_lists x
            WHERE x.s = supp.s AND t IN ('MEDIUM', 'PROMO')), '') AS frameworks,
  coalesce((SELECT string_agg(skill, ', ' ORDER BY t, b) FROM both_lists x
            WHERE x.s = supp.s AND t IN ('SMALL', 'STANDARD')), '') AS tools,
  'Serve the ' || n_name || ' market|Ship on time' AS responsibilities,
  jy.years::INT || '+ years of supply work' AS qualifications
FROM supp JOIN jy USING (s)""",
)
def job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).select(
        "job_id",
        "title",
        F.array_join("required_skills", ", ").alias("required"),
        F.array_join("preferred_skills", ", ").alias("preferred"),
        F.array_join("education", "|").alias("education"),
        "years_of_experience",
        F.array_join("certifications", "|").alias("certifications"),
        F.array_join("programming_languages", ", ").alias("languages"),
        F.array_join("frameworks", ", ").alias("frameworks"),
        F.array_join("tools", ", ").alias("tools"),
        F.array_join("responsibilities", "|").alias("responsibilities"),
        F.array_join("qualifications", "|").alias("qualifications"),
    )


# --- pairs and sets -------------------------------------------------------------


@query("E1", f"WITH {FACTS} SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id FROM pairs")
def application_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_applications(spark, sf_dir)


@query(
    "E3 E4 E5",
    f"""WITH {FACTS},
have AS (SELECT c, list(skill) AS skills FROM cs GROUP BY c),
need AS (SELECT s, list(skill ORDER BY t, b) AS skills FROM jr GROUP BY s),
every AS (SELECT s, list(skill ORDER BY first_list, t, b) AS skills
          FROM (SELECT s, skill, t, b, min(l) AS first_list
                FROM (SELECT *, 1 AS l FROM jr UNION ALL SELECT *, 2 FROM jp) GROUP BY s, skill, t, b)
          GROUP BY s)
SELECT p.c::VARCHAR AS candidate_id, p.s::VARCHAR AS job_id,
  array_to_string(list_filter(coalesce(every.skills, []), lambda x: list_contains(coalesce(have.skills, []), x)), ', ') AS matched,
  array_to_string(list_filter(coalesce(need.skills, []), lambda x: NOT list_contains(coalesce(have.skills, []), x)), ', ') AS missing,
  len(coalesce(every.skills, [])) AS n_wanted
FROM pairs p LEFT JOIN have USING (c) LEFT JOIN need USING (s) LEFT JOIN every USING (s)""",
)
def matched_and_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched skills of required-then-preferred, missing required skills."""
    wanted = F.concat("required_skills", "preferred_skills")
    asked = jobs(spark, sf_dir).select(
        "job_id",
        X.keyed_terms(wanted).alias("wanted"),
        X.keyed_terms(F.col("required_skills")).alias("required"),
    )
    own = candidates(spark, sf_dir).select("candidate_id", X.term_keys(F.col("skills")).alias("keys"))
    return matched_and_missing_terms(market_applications(spark, sf_dir), own, asked)


def matched_and_missing_terms(pairs: DataFrame, own: DataFrame, asked: DataFrame) -> DataFrame:
    """Pairs of candidates with ``keys`` and jobs with keyed terms ``wanted`` and ``required``, which are
    among the wanted. Pairs carry keys by number if the jobs' keys are few."""
    asked = written(asked, "jobs")
    every = written(asked.select(F.explode("wanted.key").alias("key")).distinct(), "vocabulary")
    parts = asked.select(
        "job_id",
        *[F.col(f"{c}.{f}").alias(f"{c}_{f}s") for c in ("wanted", "required") for f in ("key", "term")],
    )
    if is_small(every):
        # Measured small.
        vocabulary = [r["key"] for r in every.orderBy("key").collect()]
        own = numbered(own, vocabulary, ["keys"])
        parts = numbered(parts, vocabulary, ["wanted_keys", "required_keys"])
    rows = join_pairs(pairs, own, parts)

    def told(terms: str, keys: str, keep) -> Column:
        # One set of shared keys for each pair, which is short; terms stand at the places of their keys.
        shared = F.array_intersect("wanted_keys", "keys")
        kept = X.bind(shared, lambda s: F.filter(F.col(terms), lambda _, i: keep(s, F.get(F.col(keys), i))))
        return F.array_join(kept, ", ")

    return rows.select(
        *_PAIR,
        told("wanted_terms", "wanted_keys", F.array_contains).alias("matched"),
        told("required_terms", "required_keys", lambda s, key: ~F.array_contains(s, key)).alias("missing"),
        F.size("wanted_terms").cast("long").alias("n_wanted"),
    )


_TOP_JOB = "(SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1)"
_ONE_JOB = f"(SELECT c_custkey AS c, {_TOP_JOB} AS s FROM customer)"


def _best_paid_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    top = supplier.orderBy(F.col("s_acctbal").desc(), "s_suppkey").limit(1)
    return top.select(F.col("s_suppkey").cast("string").alias("job_id"))


@query(
    "A7 E2 I4 I5 I6 I7 I8 I9",
    truth(_ONE_JOB)
    + f"""
SELECT s::VARCHAR AS job_id, rank, {SHOWN} AS candidate_name,
  round_even(semantic_similarity * 10000, 0) / 10000 AS similarity_score, round_even(round(score, 6) * 100, 0) / 100 AS predicted_score
FROM ranked JOIN cust USING (c)""",
)
def single_job_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers for one job, fully ranked, written as CSV and read back."""
    everyone = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("candidate_id"))
    job = _best_paid_job(spark, sf_dir).scalar()
    rows = features(spark, sf_dir, everyone.withColumn("job_id", job), keep=("candidate_name",))
    scored = _rounded_score(score_by_formula(rows))
    needed = scored.select(*_PAIR, "candidate_name", "semantic_similarity", SCORE, CONFIDENCE)
    path = write_csv(rankings(rank_all(needed)), scratch_path(spark, "rankings"))
    schema = "job_id string, rank long, candidate_name string, similarity_score double, predicted_score double"
    return spark.read.schema(schema).option("header", True).csv(path)


# --- features, labels, evaluation -----------------------------------------------


@query(
    "E7 G1 G2 G3 G4 G5 G6 G7 G8 G9 G10 G11 G12 H9 F5",
    truth()
    + f" SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, {_sql_rounded(FEATURE_COLUMNS)} FROM feat",
)
def application_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).select(*_PAIR, *_rounded(FEATURE_COLUMNS))


@query(
    "E7 G1 G2 G3 G4 G5 G6 G7 G8 G9 G10 G11 G12",
    truth()
    + f" SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, {_sql_rounded(FEATURE_COLUMNS)} FROM feat",
)
def application_features_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with jobs joined by shuffle and all but 64 terms of each kind listed by number."""
    return features(spark, sf_dir, small_jobs=False, head=64).select(*_PAIR, *_rounded(FEATURE_COLUMNS))


_PLACE = "('0x' || substr(md5(term), 1, 4))::BIGINT % 64"


@query(
    "F3 F5 G1 K1",
    truth()
    + f""",
cd AS (SELECT c, {_PLACE} AS d, sum(tf) AS v FROM ct GROUP BY ALL),
jd AS (SELECT s, {_PLACE} AS d, sum(tf) AS v FROM jt GROUP BY ALL),
cl AS (SELECT c, sqrt(sum(v * v)) AS n FROM cd GROUP BY c),
jl AS (SELECT s, sqrt(sum(v * v)) AS n FROM jd GROUP BY s),
near AS (SELECT c, s, sum(cd.v * jd.v) / any_value(cl.n * jl.n) AS cosine
  FROM pairs JOIN cd USING (c) JOIN jd USING (s, d) JOIN cl USING (c) JOIN jl USING (s) GROUP BY c, s)
SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, round(least(coalesce(cosine, 0), 1.0), 6) AS semantic_similarity,
  round(skill_match_percentage, 6) AS skill_match_percentage
FROM feat LEFT JOIN near USING (c, s)""",
)
def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with similarities from an encoder: vectors of both sides are written and meet in tiles."""
    mine, theirs = candidates(spark, sf_dir), jobs(spark, sf_dir)
    vectors = [
        written(encode(rows.select(key, text.alias("text")), "text", hashing_encoder, kind="double").drop("text"), "vectors")
        for rows, key, text in ((mine, "candidate_id", candidate_text()), (theirs, "job_id", job_text()))
    ]
    pairs = written(market_applications(spark, sf_dir), "pairs")
    rows = pair_features(pairs, mine, theirs, similarity=pair_similarity(pairs, *vectors))
    return rows.select(*_PAIR, *_rounded(["semantic_similarity", "skill_match_percentage"]))


@query(
    "H1",
    truth()
    + " SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, round(score, 6) AS target FROM scored",
)
def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir)
    return rows.select(*_PAIR, F.round(target_score(), 6).alias("target"))


def _sql_uniform(*salt: str) -> str:
    key = "c::VARCHAR || '|' || s::VARCHAR || '" + "".join(f"|{x}" for x in salt) + "'"
    return f"((('0x' || substr(md5({key}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


_SQL_NOISE = (
    f"2.0 * sqrt(-2.0 * ln({_sql_uniform('42', 'r')})) * cos(2 * pi() * {_sql_uniform('42', 'a')})"
)


@query(
    "H2",
    truth()
    + f""" SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id,
  round(greatest(least(score + {_SQL_NOISE}, 100.0), 0.0), 6) AS target_candidate_score FROM scored""",
)
def noisy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_target(features(spark, sf_dir))
    return rows.select(*_PAIR, F.round(TARGET_COLUMN, 6).alias(TARGET_COLUMN))


@query(
    "H3",
    f"""WITH {FACTS},
n AS (SELECT ceil(count(*) * 0.20) AS wanted FROM pairs)
SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id,
  row_number() OVER (ORDER BY md5(c::VARCHAR || '|' || s::VARCHAR || '|42|split')) <= wanted AS is_test
FROM pairs, n""",
)
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_holdout(market_applications(spark, sf_dir), _PAIR)


@query(
    "H3 H6",
    f"""WITH {FACTS}
SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, {_sql_uniform('42', 'split')} < 0.2 AS is_test,
  floor({_sql_uniform('42', 'fold')} * 5)::INT AS fold
FROM pairs""",
)
def hash_split_and_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = market_applications(spark, sf_dir)
    return hash_holdout(pairs, _PAIR).withColumn("fold", fold(_PAIR))


@query(
    "H5 H10",
    truth()
    + f""",
e AS (SELECT greatest(least(score + {_SQL_NOISE}, 100.0), 0.0) AS y, score AS p FROM scored)
SELECT round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2_score FROM e""",
)
def formula_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of the noise-free formula against the noisy labels."""
    rows = score_by_formula(with_target(features(spark, sf_dir)))
    metrics = forest.error_metrics(rows, TARGET_COLUMN, SCORE)
    return metrics.select(*_rounded(["mae", "rmse", "r2_score"]))


@query(
    "A5 A6",
    truth()
    + f" SELECT {_sql_rounded(FEATURE_COLUMNS)}, round(score, 6) AS target_candidate_score FROM scored",
)
def training_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows written as CSV and read with the fixed schema."""
    rows = with_target(features(spark, sf_dir), sigma=0.0).drop(*_PAIR)
    path = write_csv(rows, scratch_path(spark, "training-csv"))
    columns = [*FEATURE_COLUMNS, TARGET_COLUMN]
    return read_training(spark, path).select(*_rounded(columns))


def _run_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A path shared by the queries of one application on one data set."""
    data = sf_dir.strip("/").replace("/", "_")
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-{data}-{name}"


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy training rows, built by the first query that needs them."""
    path = _run_path(spark, sf_dir, "training")
    return reuse_or_create(spark, path, lambda: with_target(features(spark, sf_dir)))


def _trained(spark: SparkSession, sf_dir: str):
    """(model, metrics) of the default forest with five folds, by the first query that needs it.

    Fits, hold-out and folds are over all pairs. The metrics are written last, so their marker stands
    for a whole model.
    """
    path = _run_path(spark, sf_dir, "model")
    if not exists(spark, f"{path}-metrics/_SUCCESS"):
        _, metrics = train_model(_training(spark, sf_dir), path, labelled=True, most=forest.FIT_ROWS)
        metrics.write.mode("overwrite").parquet(f"{path}-metrics")
    return forest.load_model(path), spark.read.parquet(f"{path}-metrics")


@query("A11 A12 H3 H4 H5 H6 H10")
def forest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out errors and five-fold RMSE of the default forest on the noisy labels."""
    return _trained(spark, sf_dir)[1]


@query("H6", "SELECT 5::BIGINT AS n_fields, true AS errors_in_order, true AS beats_the_mean")
def forest_metrics_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must be true of the five training metrics."""
    metrics = _trained(spark, sf_dir)[1]
    return metrics.select(
        F.lit(len(metrics.columns)).cast("long").alias("n_fields"),
        ((F.col("mae") > 0) & (F.col("mae") <= F.col("rmse")) & (F.col("cross_validation_rmse_std") >= 0)).alias("errors_in_order"),
        ((F.col("r2_score") > 0) & (F.col("cross_validation_rmse_mean") > 0)).alias("beats_the_mean"),
    )


@query("H7")
def forest_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.importances(spark, _trained(spark, sf_dir)[0])


@query("H7", "SELECT 12::BIGINT AS n, 1.0::DOUBLE AS total, 1.0::DOUBLE AS most")
def forest_importances_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances sum to one and are scaled to the greatest."""
    found = forest.importances(spark, _trained(spark, sf_dir)[0])
    return found.agg(
        F.count("*").alias("n"), F.round(F.sum("importance"), 9).alias("total"), F.max("relative").alias("most")
    )


@query("A11 E8 I1 I2 I4 I5 I9 K2")
def forest_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every application with the saved forest and keep ten per job."""
    best = rank_top(_forest_scores(spark, sf_dir), 10)
    return best.select("job_id", "rank", "candidate_id", SCORE, CONFIDENCE)


def _forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = forest.predict(_trained(spark, sf_dir)[0], _training(spark, sf_dir))
    return scored.select(*_PAIR, SCORE, CONFIDENCE)


@query(
    "E8 I1 I2 I4 I5",
    f"""WITH {FACTS}
SELECT s::VARCHAR AS job_id, count(*) AS n, count(*) AS last_rank, true AS dense, true AS in_bounds,
  true AS in_order
FROM pairs GROUP BY s""",
)
def forest_ranking_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every application is ranked once by the forest, without gaps, in order of its score."""
    ranked = rank_all(_forest_scores(spark, sf_dir))
    within = F.col(SCORE).between(0, 100) & F.col(CONFIDENCE).between(0, 100)
    before = F.lag(SCORE).over(Window.partitionBy("job_id").orderBy("rank"))
    marked = ranked.withColumn("in_order", F.coalesce(before >= F.col(SCORE), F.lit(True)))
    return marked.groupBy("job_id").agg(
        F.count("*").alias("n"),
        F.max("rank").cast("long").alias("last_rank"),
        (F.count_distinct("rank") == F.count("*")).alias("dense"),
        F.bool_and(within).alias("in_bounds"),
        F.bool_and("in_order").alias("in_order"),
    )


@query(
    "A11",
    f"""WITH {FACTS}
SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, true AS same_score, true AS same_confidence FROM pairs""",
)
def reloaded_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every application scored by a fitted forest and by the same forest saved and loaded again.

    The first scores come from the fitted model itself, the second from the loaded one's flat nodes.
    """
    rows = _training(spark, sf_dir)
    model = forest.regressor(trees=20, depth=8).fit(forest.fit_rows(rows, _PAIR, forest.FIT_ROWS))
    loaded = forest.load_model(forest.save_model(model, scratch_path(spark, "model")))
    direct = model.transform(forest.assemble(rows)).drop("features")
    both = forest.predict(loaded, direct)
    # A forest scores with the mean of its trees; its spread is that of the fitted model's votes.
    flat = forest.predict(model, direct).select(*_PAIR, F.col(CONFIDENCE).alias("_fitted"))
    return both.join(flat, list(_PAIR)).select(
        *_PAIR,
        (F.abs(F.col("prediction") - F.col(SCORE)) < 1e-9).alias("same_score"),
        (F.col("_fitted") == F.col(CONFIDENCE)).alias("same_confidence"),
    )


# --- ranking --------------------------------------------------------------------


@query(
    "I1 I3 I4 I5 I7 I9",
    truth()
    + """
SELECT s::VARCHAR AS job_id, rank, c::VARCHAR AS candidate_id,
  round_even(semantic_similarity * 10000, 0) / 10000 AS similarity_score, round(score, 6) AS score,
  75.0::DOUBLE AS confidence
FROM ranked WHERE rank <= 10""",
)
def top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best applicants per job."""
    best = rank_top(_rounded_score(score_by_formula(features(spark, sf_dir))), 10)
    return best.select(
        "job_id",
        F.col("rank").cast("long").alias("rank"),
        "candidate_id",
        round_half_even(F.col("semantic_similarity"), 4).alias("similarity_score"),
        F.col(SCORE).alias("score"),
        F.col(CONFIDENCE).alias("confidence"),
    )


@query(
    "I4 I5",
    truth()
    + " SELECT s::VARCHAR AS job_id, rank, c::VARCHAR AS candidate_id, round(score, 6) AS score FROM ranked",
)
def full_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every applicant of every job, range-partitioned so that no job fills one task."""
    scored = _rounded_score(score_by_formula(features(spark, sf_dir)))
    ranked = rank_all(scored.select(*_PAIR, SCORE, CONFIDENCE))
    return ranked.select(
        "job_id", F.col("rank").cast("long").alias("rank"), "candidate_id", F.col(SCORE).alias("score")
    )


@query(
    "I2",
    """
SELECT l_orderkey, round(greatest(least(100.0 - 3.0 * stddev_pop(l_quantity), 100.0), 0.0), 6) AS confidence
FROM lineitem GROUP BY l_orderkey""",
)
def spread_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The confidence rule on arrays from the data: quantities of an order as votes."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    votes = lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list("l_quantity")).alias("votes")
    )
    return votes.select("l_orderkey", F.round(confidence(F.col("votes")), 6).alias("confidence"))


@query(
    "I8",
    f"""WITH {FACTS}
SELECT c::VARCHAR AS candidate_id, CASE WHEN seg = 'HOUSEHOLD' THEN c_name ELSE seg || ' NATION' END AS shown
FROM cust""",
)
def shown_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed name, else the stem of the file the text came from."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("candidate_id"),
        F.concat(F.lit("file:/resumes/"), "c_name", F.lit(".pdf")).alias("path"),
    )
    rows = candidates(spark, sf_dir).select("candidate_id", "name").join(customer, "candidate_id")
    return rows.select("candidate_id", name_or_stem(F.col("name"), F.col("path")).alias("shown"))


# --- review ---------------------------------------------------------------------


@query(
    "J1 J2 J3",
    """
SELECT o_orderkey,
  CASE WHEN v >= 85 THEN 'Excellent Match' WHEN v >= 70 THEN 'Strong Match'
       WHEN v >= 55 THEN 'Moderate Match' WHEN v >= 40 THEN 'Weak Match' ELSE 'Poor Match' END AS assessment,
  CASE WHEN v >= 80 THEN 'Highly Recommended' WHEN v >= 65 THEN 'Recommended'
       WHEN v >= 50 THEN 'Consider' ELSE 'Not Recommended' END AS interview,
  CASE WHEN v >= 75 THEN 'high' WHEN v >= 50 THEN 'moderate' ELSE 'low' END AS label
FROM (SELECT o_orderkey, floor(o_totalprice / 5000) AS v FROM orders)""",
)
def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of whole-number scores, which hit every boundary."""
    value = F.floor(F.col("o_totalprice") / 5000).cast("double")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("v"))
    return rows.select(
        "o_orderkey",
        assessment(F.col("v")).alias("assessment"),
        interview(F.col("v")).alias("interview"),
        score_label(F.col("v") / 100).alias("label"),
    )


_INLINE = (
    "CASE WHEN len({0}) <= 3 THEN array_to_string({0}, ', ') "
    "ELSE array_to_string({0}[1:3], ', ') || ', and ' || (len({0}) - 3) || ' more' END"
)
_MISSING = _INLINE.format("missing")
_REVIEW_SQL = f""",
have AS (SELECT c, list(skill) AS skills FROM cs GROUP BY c),
need AS (SELECT s, list(skill ORDER BY t, b) AS skills FROM jr GROUP BY s),
every AS (SELECT s, list(skill ORDER BY first_list, t, b) AS skills
          FROM (SELECT s, skill, t, b, min(l) AS first_list
                FROM (SELECT *, 1 AS l FROM jr UNION ALL SELECT *, 2 FROM jp) GROUP BY s, skill, t, b)
          GROUP BY s),
sets AS (
  SELECT r.*, round(score, 6) AS sc,
    list_filter(coalesce(every.skills, []), lambda x: list_contains(coalesce(have.skills, []), x)) AS matched,
    list_filter(coalesce(need.skills, []), lambda x: NOT list_contains(coalesce(have.skills, []), x)) AS missing
  FROM {{rows}} r LEFT JOIN have USING (c) LEFT JOIN need USING (s) LEFT JOIN every USING (s)),
ruled AS (
  SELECT *,
    CASE WHEN sc >= 85 THEN 'Excellent Match' WHEN sc >= 70 THEN 'Strong Match'
         WHEN sc >= 55 THEN 'Moderate Match' WHEN sc >= 40 THEN 'Weak Match' ELSE 'Poor Match' END AS assessment,
    CASE WHEN sc >= 80 THEN 'Highly Recommended' WHEN sc >= 65 THEN 'Recommended'
         WHEN sc >= 50 THEN 'Consider' ELSE 'Not Recommended' END AS interview,
    list_filter([
      CASE WHEN semantic_similarity >= 0.75 THEN 'Strong semantic similarity with the job description'
           WHEN semantic_similarity >= 0.65 THEN 'Good semantic similarity with the job description' END,
      CASE WHEN skill_match_percentage >= 0.70 THEN 'Strong match against required and preferred skills' END,
      CASE WHEN experience_match_score >= 0.80 THEN 'High experience match for the role' END,
      CASE WHEN education_match_score >= 0.80 THEN 'Relevant education for the role' END,
      CASE WHEN certification_match_score >= 0.80 THEN 'Relevant certifications are present' END,
      CASE WHEN project_relevance_score >= 0.60 THEN 'Relevant projects align with job requirements' END,
      CASE WHEN programming_language_match >= 0.70 THEN 'Good programming language match' END,
      CASE WHEN framework_match >= 0.70 THEN 'Good framework match' END,
      CASE WHEN tools_match >= 0.70 THEN 'Good tools and platform match' END], lambda x: x IS NOT NULL) AS strengths,
    list_filter([
      CASE WHEN len(missing) > 0 THEN 'Missing required skills: ' || {_MISSING} END,
      CASE WHEN skill_match_percentage < 0.50 THEN 'Overall skill match is low' END,
      CASE WHEN experience_match_score < 0.70 THEN 'Experience match is below the role requirement' END,
      CASE WHEN has_education AND education_match_score < 0.50 THEN 'Education alignment is limited or not clearly stated' END,
      CASE WHEN has_certification AND certification_match_score = 0 THEN 'Relevant certification match was not identified' END,
      CASE WHEN has_language AND programming_language_match < 0.50 THEN 'Programming language match is limited' END,
      CASE WHEN has_framework AND framework_match = 0 THEN 'Framework experience is missing or not clearly stated' END,
      CASE WHEN has_tool AND tools_match = 0 THEN 'Tools or cloud technology match is missing' END,
      CASE WHEN project_relevance_score < 0.40 THEN 'Project relevance to the role is limited' END], lambda x: x IS NOT NULL) AS weaknesses,
    list_concat(list_transform(missing, lambda x: 'Add ' || x || ' if you have hands-on experience.'), list_filter([
      CASE WHEN project_relevance_score < 0.60 THEN 'Highlight projects that directly use the role''s key skills.' END,
      CASE WHEN has_tool AND tools_match < 0.50 THEN 'Mention relevant tools, cloud platforms, and deployment work.' END,
      CASE WHEN has_framework AND framework_match < 0.50 THEN 'Add framework experience that matches the job description.' END,
      CASE WHEN has_language AND programming_language_match < 0.50 THEN 'Emphasize programming languages requested by the role.' END,
      CASE WHEN experience_match_score < 0.80 THEN 'Clarify total years of relevant experience.' END,
      CASE WHEN semantic_similarity < 0.65 THEN 'Align resume wording more closely with the job requirements.' END,
      CASE WHEN skill_match_percentage < 0.70 THEN 'Move the most relevant skills into a clear skills section.' END], lambda x: x IS NOT NULL)) AS recommendations
  FROM sets),
told AS (
  SELECT *, array_to_string(list_filter([
    'The candidate is a ' || lower(assessment) || ' with an overall score of ' || printf('%.2f', sc) || '.',
    'Semantic similarity is ' || CASE WHEN semantic_similarity >= 0.75 THEN 'high'
      WHEN semantic_similarity >= 0.50 THEN 'moderate' ELSE 'low' END || ' at '
      || printf('%.2f%%', semantic_similarity * 100) || ', and skill match is '
      || printf('%.2f%%', skill_match_percentage * 100) || '.',
    CASE WHEN len(matched) > 0 THEN 'Matched skills include ' || {_INLINE.format('matched')} || '.' END,
    CASE WHEN len(missing) > 0 THEN 'The main gaps are ' || {_MISSING} || '.'
         ELSE 'No required skill gaps were identified from the parsed data.' END], lambda x: x IS NOT NULL), ' ') AS summary
  FROM ruled)"""


def _reviewable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_score(score_by_formula(features(spark, sf_dir, keep=REVIEW_COLUMNS)))


@query(
    "J1 J2 J4 J5 J6 J8 J12",
    truth()
    + _REVIEW_SQL.replace("{rows}", "scored")
    + """
SELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, assessment, interview,
  array_to_string(strengths, '|') AS strengths, array_to_string(weaknesses, '|') AS weaknesses,
  array_to_string(recommendations, '|') AS recommendations
FROM told""",
)
def review_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule outcomes of every application."""
    lists = ["strengths", "weaknesses", "recommendations"]
    return review(_reviewable(spark, sf_dir)).select(
        *_PAIR, "assessment", "interview", *[F.array_join(c, "|").alias(c) for c in lists]
    )


_BULLETS = (
    "CASE WHEN len({0}) = 0 THEN 'None' "
    "ELSE '- ' || array_to_string({0}, chr(10) || '- ') END"
)
_REPORT_PARTS = [
    "'Resume Review Report' || chr(10) || repeat('=', 57)",
    "'Candidate Name' || chr(10) || " + SHOWN,
    "'Job Title' || chr(10) || s_name",
    "'Overall Candidate Score' || chr(10) || printf('%.2f', sc)",
    "'Overall Assessment' || chr(10) || assessment",
    "repeat('=', 57)",
    "'Section 1' || chr(10) || 'Summary' || chr(10) || summary",
    "'Section 2' || chr(10) || 'Strengths' || chr(10) || " + _BULLETS.format("strengths"),
    "'Section 3' || chr(10) || 'Weaknesses' || chr(10) || " + _BULLETS.format("weaknesses"),
    "'Section 4' || chr(10) || 'Matched Skills' || chr(10) || " + _BULLETS.format("matched"),
    "'Section 5' || chr(10) || 'Missing Skills' || chr(10) || " + _BULLETS.format("missing"),
    "'Section 6' || chr(10) || 'Detailed Scores' || chr(10) || "
    + " || chr(10) || ".join(
        f"'{title}: ' || printf('%.2f%%', {column} * 100)"
        for title, column in (
            ("Semantic Similarity", "semantic_similarity"),
            ("Skill Match", "skill_match_percentage"),
            ("Experience Match", "experience_match_score"),
            ("Education Match", "education_match_score"),
            ("Certification Match", "certification_match_score"),
            ("Programming Languages", "programming_language_match"),
            ("Frameworks", "framework_match"),
            ("Tools", "tools_match"),
            ("Project Relevance", "project_relevance_score"),
        )
    ),
    "'Section 7' || chr(10) || 'Recommendations' || chr(10) || " + _BULLETS.format("recommendations"),
    "'Section 8' || chr(10) || 'Interview Recommendation' || chr(10) || interview",
]


@query(
    "A10 I8 J7 J9 J10 J11 J13",
    truth()
    + _REVIEW_SQL.replace("{rows}", "(SELECT * FROM ranked WHERE rank <= 3)")
    + "\nSELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, "
    + "concat_ws(chr(10) || chr(10), "
    + ", ".join(_REPORT_PARTS)
    + ") || chr(10) AS report FROM told JOIN (SELECT c, seg FROM cust) USING (c) "
    "JOIN (SELECT s, s_name FROM supp) USING (s)",
)
def top_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full review reports of the three best applicants per job, written and read back.

    Pairs are ranked while they are narrow; only the best get what their reports tell.
    """
    mine = numbered_rows(candidates(spark, sf_dir).drop("email", "phone"), "candidate_row")
    theirs = numbered_rows(jobs(spark, sf_dir), "job_row")
    rows = pair_features(market_applications(spark, sf_dir), mine, theirs, keep=ROW_NUMBERS)
    best = written(rank_top(_rounded_score(score_by_formula(rows)), 3), "best")
    path = write_reports(reports(with_facts(best, mine, theirs, REVIEW_COLUMNS)), scratch_path(spark, "reports"))
    return spark.read.parquet(path)


@query(
    "A10 I8 J7 J9 J10 J11 J13",
    truth()
    + _REVIEW_SQL.replace("{rows}", "scored")
    + "\nSELECT c::VARCHAR AS candidate_id, s::VARCHAR AS job_id, md5("
    + "concat_ws(chr(10) || chr(10), "
    + ", ".join(_REPORT_PARTS)
    + ") || chr(10)) AS report_md5 FROM told JOIN (SELECT c, seg FROM cust) USING (c) "
    "JOIN (SELECT s, s_name FROM supp) USING (s)",
)
def all_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of every application, by its digest."""
    return reports(_reviewable(spark, sf_dir)).select(*_PAIR, F.md5("report").alias("report_md5"))


@query(
    "E2",
    f"""WITH {FACTS}
SELECT CASE WHEN c % 3 = 0 THEN 'x' ELSE '' END || c AS candidate_id, CASE WHEN s % 5 = 0 THEN 'x' ELSE '' END || s AS job_id,
  CASE WHEN c % 3 = 0 THEN 'unknown candidate' ELSE 'unknown job' END AS reject_reason
FROM pairs WHERE c % 3 = 0 OR s % 5 = 0""",
)
def rejected_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications whose ids were spoilt on the way are listed with the reason."""
    spoilt = lambda c, n: F.when(F.col(c).cast("long") % n == 0, F.concat(F.lit("x"), c)).otherwise(F.col(c))
    pairs = market_applications(spark, sf_dir).select(spoilt("candidate_id", 3).alias("candidate_id"), spoilt("job_id", 5).alias("job_id"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("candidate_id"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("job_id"))
    return unknown_pairs(pairs, customers, suppliers)


_JOINED_SQL = f"""WITH {FACTS},
both_lists AS (SELECT DISTINCT s, t, b, skill FROM (FROM jr UNION ALL FROM jp)),
worked AS (
  SELECT c, status, string_agg(skill, ', ' ORDER BY t, b) AS names, string_agg(skill, ' ' ORDER BY t, b) AS tech
  FROM cp GROUP BY c, status),
told AS (
  SELECT st.c, string_agg(CASE WHEN seg = 'FURNITURE'
      THEN 'Ran the ' || st.status || ' pipeline with ' || coalesce(names, '') || ' for us. '
      ELSE 'Pipeline ' || st.status || ' ' || coalesce('worked on ' || names, '') END
    || ' ' || coalesce(tech, ''), ' ' ORDER BY st.status) AS text
  FROM (SELECT DISTINCT o_custkey AS c, o_orderstatus AS status FROM orders) st
  JOIN cust USING (c) LEFT JOIN worked w ON w.c = st.c AND w.status = st.status GROUP BY st.c)
SELECT 'candidate' AS kind, cust.c::VARCHAR AS id, concat_ws(' ', {NAME},
    coalesce((SELECT string_agg(skill, ' ' ORDER BY t, b) FROM cs WHERE cs.c = cust.c), ''),
    {DEGREE} || ' ' || n_name || ' College',
    coalesce((SELECT string_agg('Engineer on ' || priority || ' orders ' || a || ' - ' ||
      CASE WHEN z = 2001 THEN 'Present' ELSE z::VARCHAR END, ' ' ORDER BY priority)
      FROM periods WHERE periods.c = cust.c), ''),
    coalesce((SELECT string_agg('Certified ' || brand || ' handler Board ' || region, ' ' ORDER BY b)
      FROM cb WHERE cb.c = cust.c), ''),
    coalesce(told.text, ''), cy.years::VARCHAR) AS text
FROM cust JOIN cy USING (c) LEFT JOIN told USING (c)
UNION ALL
SELECT 'job', supp.s::VARCHAR, concat_ws(' ', s_name,
    coalesce((SELECT string_agg(skill, ' ' ORDER BY t, b) FROM jr WHERE jr.s = supp.s), ''),
    coalesce((SELECT string_agg(skill, ' ' ORDER BY t, b) FROM jp WHERE jp.s = supp.s), ''),
    {REGION_DEGREE}, jy.years::VARCHAR,
    coalesce((SELECT string_agg('Certified ' || brand || ' handler', ' ' ORDER BY b) FROM jb WHERE jb.s = supp.s), ''),
    coalesce((SELECT string_agg(skill, ' ' ORDER BY t, b) FROM both_lists x WHERE x.s = supp.s AND t IN ('ECONOMY', 'LARGE')), ''),
    coalesce((SELECT string_agg(skill, ' ' ORDER BY t, b) FROM both_lists x WHERE x.s = supp.s AND t IN ('MEDIUM', 'PROMO')), ''),
    coalesce((SELECT string_agg(skill, ' ' ORDER BY t, b) FROM both_lists x WHERE x.s = supp.s AND t IN ('SMALL', 'STANDARD')), ''),
    'Serve the ' || n_name || ' market Ship on time', jy.years::INT || '+ years of supply work', '')
FROM supp JOIN jy USING (s)"""


@query("F1 F2", _JOINED_SQL)
def joined_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compared texts of records that have lost their raw text: all fields joined."""
    blank = F.lit("")
    mine = candidates(spark, sf_dir).withColumn("raw_text", blank).select(
        F.lit("candidate").alias("kind"), F.col("candidate_id").alias("id"), candidate_text().alias("text")
    )
    theirs = jobs(spark, sf_dir).withColumn("raw_text", blank).select(
        F.lit("job").alias("kind"), F.col("job_id").alias("id"), job_text().alias("text")
    )
    return mine.unionByName(theirs)


@query("F1 F2")
def market_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand for candidates and jobs when they are compared."""
    mine = candidates(spark, sf_dir).select(
        F.lit("candidate").alias("kind"), F.col("candidate_id").alias("id"), candidate_text().alias("text")
    )
    theirs = jobs(spark, sf_dir).select(
        F.lit("job").alias("kind"), F.col("job_id").alias("id"), job_text().alias("text")
    )
    return mine.unionByName(theirs)
