"""Registered queries against their check SQL on the smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare
from rankloom.plans import text_queries
from rankloom.plans.catalog import REGISTRY

TEXT = [n for n, e in REGISTRY.items() if e.run.__module__ == text_queries.__name__]
MARKET = [
    "candidate_contacts", "candidate_education", "candidate_certifications", "candidate_projects",
    "candidate_years", "job_records", "matched_and_missing", "single_job_ranking",
    "application_features", "application_features_shuffled", "encoded_features", "candidate_projects_by_line",
    "noisy_labels", "holdout_split", "full_ranking", "top_reports",
]


@pytest.mark.parametrize("name", TEXT + MARKET)
def test_query_equals_check_sql(spark, sf_dir, name):
    assert compare(spark, name, sf_dir).startswith("ok")


def test_entry_ranks_five_documents_per_profile(spark):
    ranks = [r["rank"] for r in entry(spark).collect()]
    assert set(ranks) == {1, 2, 3, 4, 5}


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["document_lines", "license_sections", "term_frequencies", "document_terms", "distinct_lines"])
def test_in_row_operators_need_no_exchange_on_keys(spark, sf_dir, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    assert "hashpartitioning" not in plan and "Python" not in plan


def test_features_broadcast_jobs_and_have_no_cross_join(spark, sf_dir):
    plan = plan_of(queries()["application_features"](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan and "Python" not in plan
