"""Files, quarantine, training and the end-to-end jobs."""

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from rankloom.operators import forest
from rankloom.operators.labels import exact_holdout, fold, with_target
from rankloom.operators.pairs import assign
from rankloom.operators.ranking import CONFIDENCE, SCORE, confidence, rank_all
from rankloom.operators.records import parse_candidates, parse_jobs
from rankloom.plans import market_queries
from rankloom.plans.jobs import predict_candidates, review_pairs, verify_features
from rankloom.schemas import FEATURE_COLUMNS, TARGET_COLUMN, require_columns
from rankloom.session import scratch_path
from rankloom.sources import files
from rankloom.sources.quarantine import quarantine, require_any
from tests.test_patterns import JOB, RESUME

SHORT = "Bob Smith\nbob@x.org\n3 years of experience\nSkills\nJava, Docker"


@pytest.fixture(scope="module")
def texts(spark):
    resumes = [("r1", RESUME), ("r2", SHORT), ("r3", " \n"), ("r4", None)]
    jobs = [("j1", JOB), ("j2", "Java Developer\nRequirements\nJava")]
    schema = "doc_id string, text string"
    return spark.createDataFrame(resumes, schema), spark.createDataFrame(jobs, schema)


def test_quarantine_splits_and_names_the_reason(spark, texts):
    accepted, rejects = quarantine(texts[0])
    assert sorted(r.doc_id for r in accepted.collect()) == ["r1", "r2"]
    assert {r.doc_id: r.reject_reason for r in rejects.collect()} == {"r3": "empty", "r4": "unreadable"}
    with pytest.raises(ValueError, match="No valid resumes"):
        require_any(accepted.where("false"), "resumes")


def test_predict_ranks_readable_resumes(spark, texts):
    rows = predict_candidates(*texts, "j1", as_of_year=2026).orderBy("rank").collect()
    assert [(r["rank"], r.candidate_name) for r in rows] == [(1, "Lena Van Brandt"), (2, "Bob Smith")]
    assert rows[0].predicted_score > rows[1].predicted_score
    with pytest.raises(FileNotFoundError, match="Job description not found"):
        predict_candidates(*texts, "nope")
    empty = texts[1].unionByName(spark.createDataFrame([("j3", " \n")], "doc_id string, text string"))
    with pytest.raises(ValueError, match="empty: j3"):
        predict_candidates(texts[0], empty, "j3")
    with pytest.raises(ValueError, match="empty: j3"):
        verify_features(texts[0], empty, ["j1", "j3"])


def test_nameless_resumes_are_shown_by_their_file(spark, texts):
    nameless = spark.createDataFrame([("file:/x/cv_17.txt", "x@y.org\nSkills\nJava")], "doc_id string, text string")
    assert predict_candidates(nameless, texts[1], "j2").first().candidate_name == "cv_17"


def test_verify_scores_every_resume_for_listed_jobs(spark, texts):
    got = verify_features(*texts, ["j1", "j2"])
    assert got.columns[2:] == FEATURE_COLUMNS
    assert got.count() == 4


def test_review_has_one_report_per_pair(spark, texts):
    candidates = parse_candidates(quarantine(texts[0])[0], as_of_year=2026)
    jobs = parse_jobs(texts[1])
    got = {r.candidate_id: r.report for r in review_pairs(assign(candidates, ["j2"]), candidates, jobs).collect()}
    assert "Job Title\nJava Developer" in got["r2"]
    assert "Section 5\nMissing Skills\nNone" in got["r2"]
    assert "Section 5\nMissing Skills\nNone" in got["r1"]


def test_whole_files_and_manifest(spark, tmp_path):
    (tmp_path / "b.txt").write_text("zwei\nZeilen é", encoding="utf-8")
    (tmp_path / "a.txt").write_text("eins", encoding="utf-8")
    (tmp_path / "c.pdf").write_bytes(b"x")
    got = {r.doc_id.rsplit("/", 1)[1]: r.text for r in files.read_texts(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "eins", "b.txt": "zwei\nZeilen é"}
    listed = files.manifest(spark, str(tmp_path), "*.txt")
    assert [r.path.rsplit("/", 1)[1] for r in listed.collect()] == ["a.txt", "b.txt"]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    with pytest.raises(FileNotFoundError):
        files.manifest(spark, str(tmp_path), "*.doc")


def test_pages_are_joined_in_order(spark):
    pages = spark.createDataFrame([("d", 2, "two"), ("d", 1, "one"), ("d", 10, "ten")], "doc_id string, page_no int, text string")
    assert files.assemble_pages(pages).first().text == "one\ntwo\nten"


def test_records_and_reports_round_trip(spark, texts, tmp_path):
    candidates = parse_candidates(quarantine(texts[0])[0], as_of_year=2026)
    path = files.write_records(candidates, str(tmp_path / "candidates"))
    assert sorted(files.read_candidates(spark, path).collect()) == sorted(candidates.collect())
    jobs = parse_jobs(texts[1])
    path = files.write_records(jobs, str(tmp_path / "jobs"))
    assert sorted(files.read_jobs(spark, path).collect()) == sorted(jobs.collect())
    reports = spark.createDataFrame([("r", "j", "a\nb\n")], "candidate_id string, job_id string, report string")
    assert spark.read.parquet(files.write_reports(reports, str(tmp_path / "reports"))).collect() == reports.collect()


def test_rankings_csv(spark, tmp_path, capsys):
    rows = spark.createDataFrame([("j", 1, "A, B", 0.5, 50.0)], "job_id string, rank int, candidate_name string, similarity_score double, predicted_score double")
    files.write_rankings(rows, str(tmp_path / "out"))
    back = spark.read.option("header", True).schema(rows.schema).csv(str(tmp_path / "out"))
    assert back.collect() == rows.collect()
    assert "A, B" in capsys.readouterr().out


def test_reuse_or_create_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert files.reuse_or_create(spark, str(tmp_path / "data"), build).count() == 3
    assert len(calls) == 1


def test_column_contract(spark):
    with pytest.raises(ValueError, match="missing columns: .*tools_match"):
        require_columns(spark.range(1), FEATURE_COLUMNS, "Feature vectors")
    with pytest.raises(ValueError, match=TARGET_COLUMN):
        forest.train(spark.createDataFrame([tuple([1.0] * 12)], FEATURE_COLUMNS))


@pytest.fixture(scope="module")
def trained(spark):
    columns = [
        (F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(c))), 1, 6), 16, 10).cast("double") / 16**6).alias(c)
        for c in FEATURE_COLUMNS
    ]
    rows = spark.range(400).select(F.col("id").cast("string").alias("candidate_id"), F.lit("j").alias("job_id"), *columns)
    training = with_target(rows)
    model, metrics = forest.train(training, trees=10, depth=5, folds=2)
    return training, model, metrics


def test_training_metrics(trained):
    row = trained[2].first().asDict()
    assert set(row) == {"mae", "rmse", "r2_score", "cross_validation_rmse_mean", "cross_validation_rmse_std"}
    assert 0 < row["mae"] <= row["rmse"] < 15 and row["r2_score"] > 0.3
    assert row["cross_validation_rmse_mean"] > 0 and row["cross_validation_rmse_std"] >= 0


def test_importances_are_sorted_and_scaled(spark, trained):
    rows = forest.importances(spark, trained[1]).collect()
    assert [r.feature for r in rows][0] == "semantic_similarity"
    assert rows[0].relative == 1.0 and len(rows) == 12
    assert sum(r.importance for r in rows) == pytest.approx(1.0)


def test_importances_equal_the_gains_of_the_saved_nodes(spark, trained):
    path = forest.save_model(trained[1], scratch_path(spark, "model"))
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    total = dict.fromkeys(range(12), 0.0)
    for tree in {n.treeID for n in nodes}:
        gains = dict.fromkeys(range(12), 0.0)
        for n in nodes:
            if n.treeID == tree and n.leftChild >= 0:
                gains[n.split.featureIndex] += n.gain * n.impurityStats[0]
        for f, gain in gains.items():
            total[f] += gain / sum(gains.values())
    found = {r.feature: r.importance for r in forest.importances(spark, trained[1]).collect()}
    for f, name in enumerate(FEATURE_COLUMNS):
        assert found[name] == pytest.approx(total[f] / sum(total.values()), abs=1e-9)


def test_fold_errors_equal_single_fits(trained):
    training, keys = trained[0], ("candidate_id", "job_id")
    rows = training.withColumn("fold", fold(keys, 3)).cache()
    errors = []
    for i in range(3):
        model = forest.regressor(5, 4).fit(forest.assemble(rows.where(F.col("fold") != i)))
        tested = model.transform(forest.assemble(rows.where(F.col("fold") == i))).collect()
        errors.append((sum((r[TARGET_COLUMN] - r.prediction) ** 2 for r in tested) / len(tested)) ** 0.5)
    mean, deviation = forest.cross_validate(training, keys, 3, 5, 4)
    # Rows reach the fits in another order, so bootstrap draws differ a little.
    assert mean == pytest.approx(sum(errors) / 3, rel=0.1) and deviation < 2


def test_model_scores_and_reloads(spark, trained):
    training, model, _ = trained
    loaded = forest.load_model(forest.save_model(model, scratch_path(spark, "model")))
    scored = forest.predict(loaded, training)
    bounds = scored.agg(F.min(SCORE), F.max(SCORE), F.min(CONFIDENCE), F.max(CONFIDENCE)).first()
    assert all(0 <= v <= 100 for v in bounds)
    direct = {r.candidate_id: r.prediction for r in model.transform(forest.assemble(training)).collect()}
    assert all(r[SCORE] == pytest.approx(direct[r.candidate_id]) for r in scored.collect())
    ranks = sorted(r["rank"] for r in rank_all(scored).collect())
    assert ranks == list(range(1, 401))
    with pytest.raises(FileNotFoundError, match="model not found"):
        forest.load_model(scratch_path(spark, "missing"))


def test_model_without_trees_has_the_fixed_confidence(spark, trained):
    training, _, _ = trained
    model = LinearRegression(featuresCol="features", labelCol=TARGET_COLUMN).fit(forest.assemble(training))
    got = {r.candidate_id: r for r in forest.predict(model, training).collect()}
    direct = {r.candidate_id: r.prediction for r in model.transform(forest.assemble(training)).collect()}
    assert all(r[CONFIDENCE] == 75.0 and r[SCORE] == pytest.approx(min(100, max(0, direct[i]))) for i, r in got.items())


def test_fit_rows_are_bounded_and_stable(trained):
    training, _, _ = trained
    keys = ("candidate_id", "job_id")
    assert forest.bounded(training, keys, 1000).count() == 400
    some = forest.bounded(training, keys, 100)
    assert 60 < some.count() < 140 and sorted(some.collect()) == sorted(forest.bounded(training.repartition(7), keys, 100).collect())


def test_bounded_fits_are_measured_on_all_rows(trained, monkeypatch):
    training, keys = trained[0], ("candidate_id", "job_id")
    measured, drawn = [], []
    errors, bounded = forest.error_metrics, forest.bounded
    monkeypatch.setattr(forest, "error_metrics", lambda df, *a, **b: measured.append(df.count()) or errors(df, *a, **b))
    monkeypatch.setattr(forest, "bounded", lambda *a: drawn.append(bounded(*a)) or drawn[-1])
    model, metrics = forest.train(training, trees=5, depth=4, folds=2, most=100)
    assert measured[0] == 80 and len(measured) == 3 and sum(measured[1:]) == 400
    assert len(drawn) == 3 and all(60 < df.count() < 140 for df in drawn)
    held_out = exact_holdout(training, keys).where("is_test")
    expected = errors(model.transform(forest.assemble(held_out))).first()
    assert all(metrics.first()[k] == pytest.approx(expected[k]) for k in ("mae", "rmse", "r2_score"))


def test_query_trains_on_all_pairs(spark, monkeypatch):
    given = []
    monkeypatch.setattr(market_queries, "_run_path", lambda spark, sf_dir, name: scratch_path(spark, name))
    monkeypatch.setattr(market_queries, "_training", lambda spark, sf_dir: spark.range(20_000).selectExpr("id AS candidate_id", "id AS job_id"))

    def train(rows, path, **settings):
        given.append((rows.count(), settings["most"]))
        raise InterruptedError

    monkeypatch.setattr(market_queries, "train_model", train)
    with pytest.raises(InterruptedError):
        market_queries._trained(spark, "none")
    assert given == [(20_000, forest.FIT_ROWS)]


def test_fits_of_the_queries_see_all_rows(trained, monkeypatch):
    training, keys = trained[0], ("candidate_id", "job_id")
    seen = []

    class Counting:
        def fit(self, rows):
            seen.append(rows.count())
            return trained[1]

    wide = training.crossJoin(training.sparkSession.range(60).select(F.col("id").cast("string").alias("n")))
    wide = wide.withColumn("candidate_id", F.concat_ws("-", "candidate_id", "n")).drop("n")
    monkeypatch.setattr(forest, "regressor", lambda *a, **b: Counting())
    forest.train(wide, keys, folds=2, most=forest.FIT_ROWS)
    # 80 % of 24,000 rows, then all rows outside of each fold.
    assert sorted(seen)[-1] == 19_200 and sum(seen) == 19_200 + 24_000


def test_confidence_uses_single_trees(spark, trained):
    training, model, _ = trained
    rows = forest.assemble(training).limit(20)
    votes = rows
    for i, tree in enumerate(model.trees):
        votes = tree.setPredictionCol(f"t{i}").transform(votes)
    expected = votes.select("candidate_id", confidence(F.array(*[f"t{i}" for i in range(10)])).alias("c"))
    got = {r.candidate_id: r[CONFIDENCE] for r in forest.predict(model, training).collect()}
    assert all(got[r.candidate_id] == pytest.approx(r.c) for r in expected.collect())
