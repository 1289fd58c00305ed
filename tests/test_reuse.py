"""Datasets reused by content."""

import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from check_queries import compare
from rankloom.sources.reuse import content_key, inputs_digest, reuse_by_content


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "input")
    spark.range(100).select("id", (F.col("id") % 7).alias("part")).write.parquet(path)
    return path


def counted(spark, path, column="part"):
    return spark.read.parquet(path).groupBy(column).count()


def test_same_query_and_files_are_built_once(spark, table, tmp_path):
    folder = str(tmp_path / "kept")
    assert [reuse_by_content(counted(spark, table), folder, [table])[1] for _ in range(3)] == [True, False, False]
    rows, built = reuse_by_content(counted(spark.newSession(), table), folder, [table])
    assert not built and rows.count() == 7


def test_changed_input_query_or_version_builds_anew(spark, table, tmp_path):
    folder = str(tmp_path / "kept")
    reuse_by_content(counted(spark, table), folder, [table])
    assert reuse_by_content(counted(spark, table, "id"), folder, [table])[1]
    assert reuse_by_content(counted(spark, table), folder, [table], version="2")[1]
    spark.range(100, 150).select("id", F.lit(9).cast("long").alias("part")).write.mode("append").parquet(table)
    rows, built = reuse_by_content(counted(spark, table), folder, [table])
    assert built and rows.count() == 8


def test_literals_and_late_columns_of_wide_plans_change_the_key(spark):
    wide = spark.range(1).select(*[F.lit(i).alias(f"c{i}") for i in range(60)])
    other = spark.range(1).select(*[F.lit(i + (i == 59)).alias(f"c{i}") for i in range(60)])
    keys = {content_key(df, []) for df in (wide, other, wide.select("c1"), wide.select("c2"))}
    assert len(keys) == 4
    assert content_key(wide, []) == content_key(wide, [])


def test_session_setting_is_as_before(spark):
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    content_key(spark.range(1), [])
    assert spark.conf.get("spark.sql.debug.maxToStringFields") == before


def test_unfinished_attempts_are_not_read(spark, table, tmp_path):
    folder = str(tmp_path / "kept")
    key = content_key(counted(spark, table), [table])
    spark.range(3).write.parquet(f"{folder}/{key}/dead")
    os.remove(f"{folder}/{key}/dead/_SUCCESS")
    rows, built = reuse_by_content(counted(spark, table), folder, [table])
    assert built and rows.columns == ["part", "count"]


def test_two_writers_leave_whole_datasets(spark, table, tmp_path):
    folder = str(tmp_path / "kept")
    with ThreadPoolExecutor(2) as pool:
        both = list(pool.map(lambda _: reuse_by_content(counted(spark, table), folder, [table])[0].collect(), range(2)))
    assert sorted(both[0]) == sorted(both[1]) and len(both[0]) == 7
    assert all(spark.read.parquet(p).count() == 7 for p in glob.glob(f"{folder}/*/*"))
    assert not reuse_by_content(counted(spark, table), folder, [table])[1]


def test_missing_input_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        inputs_digest(spark, [str(tmp_path / "empty")])


def test_query_rebuilds_changed_inputs_only(spark, sf_dir):
    assert compare(spark, "reused_dataset", sf_dir).startswith("ok")
