"""Line dedup against SQL, and its defined results."""

from pyspark.sql import functions as F

from check_queries import compare
from rankloom.llm import lines


def run(spark, rows, **settings):
    pages = spark.createDataFrame(rows, "page_id int, url string, text string").withColumn("host", F.lit("given")).repartition(3)
    found = lines.drop_boilerplate(pages, lines.host(F.col("url")), F.col("text"), **settings)
    assert found.columns == ["page_id", "url", "text", "host", "host_", "n_lines", "n_dropped", "kept_text"]
    return {r.page_id: (r.host_, r.n_lines, r.n_dropped, r.kept_text) for r in found.collect()}


def test_query_equals_sql(spark):
    assert compare(spark, "op5_line_dedup", "/root/testdata/sf0.01").startswith("ok")


def test_query_is_native(spark, sf_dir):
    from rankloom.llm.queries import op5_line_dedup

    plan = op5_line_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_ratio_is_relative_to_the_host(spark):
    rows = [(i, f"http://A.example/{i}", f"menu\nbody {i}\nrare\n menu \t") for i in range(8)]
    rows += [(10 + i, f"https://u@b.example:80/{i}", "menu\n" * (i < 2) + f"body {i}") for i in range(8)]
    rows += [(30, None, "menu\nbody"), (31, "no url", "menu"), (32, "http://a.example/x", None), (33, "http://a.example/y", " \n\t\n")]
    got = run(spark, rows, ratio=0.5, least=3)
    assert got[0] == ("a.example", 4, 3, "body 0")
    assert got[10] == ("b.example", 2, 0, "menu\nbody 0")
    assert got[30] == (None, 2, 0, "menu\nbody") and got[31] == (None, 1, 0, "menu")
    assert got[32] == got[33] == ("a.example", 0, 0, "")


def test_ratio_is_exceeded_and_pages_count_once(spark):
    rows = [(i, "http://h/", "half\n" * 5 + f"own {i}") for i in range(3)] + [(i, "http://h/", f"own {i}") for i in range(3, 6)]
    assert all(n == 0 for _, _, n, _ in run(spark, rows, ratio=0.5, least=3).values())
    assert run(spark, rows, ratio=0.49, least=3)[0][2] == 5
    assert all(n == 0 for _, _, n, _ in run(spark, rows, ratio=0.1, least=4).values())


def test_empty_table(spark):
    assert run(spark, []) == {}
