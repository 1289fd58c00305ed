"""Candidate and job documents rendered from the relational tables.

The order tables hold no documents with sections, degrees, years or skill lists.
These jobs write one candidate text per customer and one requirement text per
supplier, so that parsing, pairing and scoring run over whole tables and grow
with them. A skill is a product line: part type and brand. Customers apply to
the suppliers that shipped to them.

Quantities stand for how well a skill is known or how much it is wanted: a line
of an order makes a skill from 25 pieces, a project from 45; a supplier prefers
what it ships by 48 and requires what it ships by 49 or more. All rows are read;
the levels only decide what a text says.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.pairs import applications
from rankloom.vocabulary import DEFAULT, Vocabulary

#: Product lines that a lexicon may have at most; they are part of every parsing plan.
MOST_LINES = 5000
DEGREE_BY_SEGMENT = {
    "AUTOMOBILE": "Ph.D",
    "BUILDING": "Master's",
    "FURNITURE": "B.Sc",
    "HOUSEHOLD": "MBA",
    "MACHINERY": "B.Tech",
}
DEGREE_BY_REGION = {
    0: "Doctorate required",
    1: "Master's degree in any field",
    2: "Bachelor level or above",
    3: "degree in any field",
}
LAST_YEAR = 2001
AS_OF_YEAR = 2003


def vocabulary(spark: SparkSession, sf_dir: str) -> Vocabulary:
    """The product lines of ``part`` as skills, in the order type, brand number.

    The types in dictionary order are dealt to languages, frameworks and tools by thirds.
    """
    rows = table(spark, sf_dir, "part").select(_skill_order().alias("s")).distinct()
    lines = [r["s"] for r in rows.where(F.col("s.skill").isNotNull()).limit(MOST_LINES + 1).collect()]
    if len(lines) > MOST_LINES:
        raise ValueError(f"more than {MOST_LINES} product lines")
    lines.sort(key=lambda s: (s["t"], s["b"]))
    types = sorted({s["t"] for s in lines})
    third = {t: 3 * i // len(types) for i, t in enumerate(types)}
    kinds = [tuple(s["skill"] for s in lines if third[s["t"]] == k) for k in range(3)]
    every = tuple(s["skill"] for s in lines)
    return replace(
        DEFAULT,
        candidate_skills=every,
        job_skills=every,
        programming_languages=kinds[0],
        frameworks=kinds[1],
        tools=kinds[2],
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _skill_order() -> Column:
    """Sortable skill: type, brand number, then the skill itself."""
    number = F.substring("p_brand", 7, 10).cast("int")
    skill = F.concat_ws(" ", "p_type", "p_brand")
    return F.struct(F.col("p_type").alias("t"), number.alias("b"), skill.alias("skill"))


def _collected(value: Column, condition: Column) -> Column:
    """Sorted distinct values of the rows that fulfil the condition."""
    return F.sort_array(F.collect_set(F.when(condition, value)))


def _named(skills: Column) -> Column:
    return F.array_join(F.transform(skills, lambda s: s["skill"]), ", ")


def _bullets(items: Column) -> Column:
    """Bullet lines, null when there are none, so that no line is written."""
    lines = F.transform(items, lambda i: F.concat(F.lit("- "), i))
    return F.when(F.size(items) > 0, F.array_join(lines, "\n"))


def _choice(key: Column, values: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def customer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders: bounded sets, combined before their exchange.

    What orders tell is taken from orders alone, and of the lines only those that tell anything go
    to the joins.
    """
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 25).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", F.year("l_shipdate").alias("shipped")
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    owners = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    rows = owners.join(lineitem.join(part, "l_partkey"), "l_orderkey").withColumn("skill", _skill_order())
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48)
    project = F.struct(F.col("o_orderstatus").alias("status"), F.col("skill").alias("skill"))
    certified = F.struct(
        F.col("skill.b").alias("b"), F.col("p_brand").alias("brand"), F.col("shipped").alias("year")
    )
    shipped = rows.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        _collected(F.col("skill"), F.col("l_quantity") >= 25).alias("skills"),
        _collected(project, F.col("l_quantity") >= 45).alias("projects"),
        _collected(certified, returned).alias("certified"),
    )
    period = F.struct(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year"))
    ordered = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sort_array(F.collect_set("o_orderstatus")).alias("statuses"),
        F.sort_array(F.collect_set(period)).alias("periods"),
        F.min(F.year("o_orderdate")).alias("first_year"),
    )
    sets = [F.coalesce(c, F.array().cast(shipped.schema[c].dataType)).alias(c) for c in ("skills", "projects", "certified")]
    return ordered.join(shipped, "c_custkey", "left").select("c_custkey", *sets, "statuses", "periods", "first_year")


def _experience_lines(periods: Column) -> Column:
    def line(priority: Column, ps: Column) -> Column:
        years = F.transform(F.filter(ps, lambda p: p["priority"] == priority), lambda p: p["year"])
        last = F.array_max(years)
        return F.concat(
            F.lit("Engineer on "),
            priority,
            F.lit(" orders "),
            F.array_min(years).cast("string"),
            F.lit(" - "),
            F.when(last == LAST_YEAR, F.lit("Present")).otherwise(last.cast("string")),
        )

    names = F.array_distinct(F.transform(periods, lambda p: p["priority"]))
    return F.transform(names, lambda n: line(n, periods))


def _certificate_lines(certified: Column, region: Column) -> Column:
    brands = F.array_distinct(F.transform(certified, lambda c: F.struct(c["b"], c["brand"])))

    def line(brand: Column) -> Column:
        same = F.filter(certified, lambda c: c["brand"] == brand["brand"])
        return F.concat(
            F.lit("Certified "),
            brand["brand"],
            F.lit(" handler - Board "),
            region.cast("string"),
            F.lit(", "),
            F.array_max(F.transform(same, lambda c: c["year"])).cast("string"),
        )

    return F.transform(brands, line)


def _project_lines(projects: Column, statuses: Column, loose: Column) -> Column:
    """A heading and a description per order status, or one plain sentence each."""

    def lines(status: Column) -> Column:
        mine = F.transform(
            F.filter(projects, lambda p: p["status"] == status), lambda p: p["skill"]
        )
        described = F.when(F.size(mine) > 0, F.concat(F.lit("worked on "), _named(mine)))
        headed = F.concat_ws("\n", F.concat(F.lit("Pipeline "), status), described)
        sentence = F.concat(
            F.lit("Ran the "), status, F.lit(" pipeline with "), _named(mine), F.lit(" for us.")
        )
        return F.when(loose, sentence).otherwise(headed)

    return F.transform(statuses, lines)


def candidate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): one text per customer."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    customer = table(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey")
    rows = customer.join(customer_facts(spark, sf_dir), "c_custkey", "left")
    empty = F.array().cast("array<string>")
    segment, country = F.col("c_mktsegment"), F.col("n_name")
    active = F.array_distinct(F.transform("periods", lambda p: p["year"]))
    years = F.coalesce(F.size(active), F.lit(0)).cast("string")
    text = F.concat_ws(
        "\n",
        F.when(segment == "HOUSEHOLD", segment).otherwise(F.concat_ws(" ", segment, country)),
        F.concat(
            F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@example.com | +"),
            (F.col("c_nationkey") + 10).cast("string"), F.lit(" 555 "),
            F.lpad(F.col("c_custkey").cast("string"), 7, "0"),
        ),
        F.lit(""),
        F.when(
            F.col("c_acctbal") >= 0,
            F.concat(F.lit("Profile: "), years, F.lit(" years of experience in supply")),
        ).otherwise(F.lit("Profile: open to new work in supply")),
        F.lit("Open for talks about all kinds of supply work"),
        F.lit(""),
        F.concat(F.lit("Based in "), country, F.lit(" with the sales desk of the region")),
        F.lit("Technical Skills:"),
        F.concat(F.lit("- "), F.coalesce(_named(F.col("skills")), F.lit(""))),
        F.lit("\nWork Experience"),
        _bullets(_experience_lines(F.col("periods"))),
        F.lit("\nEducation"),
        F.concat_ws(
            ", ",
            F.concat_ws(" in ", _choice(segment, DEGREE_BY_SEGMENT), segment),
            F.concat(country, F.lit(" College")),
            F.col("first_year").cast("string"),
        ),
        F.lit("\nCertifications"),
        _bullets(_certificate_lines(F.col("certified"), F.col("n_regionkey"))),
        F.lit("\nProjects"),
        F.array_join(
            F.coalesce(
                _project_lines(F.col("projects"), F.col("statuses"), segment == "FURNITURE"), empty
            ),
            "\n",
        ),
    )
    return rows.select(F.col("c_custkey").cast("string").alias("doc_id"), text.alias("text"))


def supplier_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Other lines are named in no text, nor is a supplier that has no row here.
    lineitem = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 48).select(
        "l_suppkey", "l_partkey", "l_quantity", "l_returnflag"
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    rows = lineitem.join(part, "l_partkey")
    rows = rows.withColumn("skill", _skill_order())
    brand = F.struct(F.col("skill.b").alias("b"), F.col("p_brand").alias("brand"))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)
    return rows.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        _collected(F.col("skill"), F.col("l_quantity") >= 49).alias("required"),
        _collected(F.col("skill"), F.col("l_quantity") == 48).alias("preferred"),
        _collected(brand, returned).alias("brands"),
    )


def job_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): one text per supplier."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey"
    )
    supplier = table(spark, sf_dir, "supplier").join(F.broadcast(nation), "s_nationkey")
    rows = supplier.join(supplier_facts(spark, sf_dir), "s_suppkey", "left")
    degree = _choice(F.col("n_regionkey"), DEGREE_BY_REGION)
    certificates = F.transform(
        "brands", lambda b: F.concat(F.lit("Certified "), b["brand"], F.lit(" handler"))
    )
    years = F.greatest(F.floor(F.col("s_acctbal") / 2000), F.lit(0)).cast("string")
    text = F.concat_ws(
        "\n",
        "s_name",
        F.lit("\nRequired Skills"),
        F.concat(F.lit("- "), F.coalesce(_named(F.col("required")), F.lit(""))),
        F.lit("\nNice to have"),
        F.concat(F.lit("- "), F.coalesce(_named(F.col("preferred")), F.lit(""))),
        F.concat(F.lit("\nEducation\n- "), degree),
        F.lit("\nCertifications"),
        _bullets(certificates),
        F.lit("\nResponsibilities"),
        F.concat(F.lit("- Serve the "), F.col("n_name"), F.lit(" market")),
        F.lit("- Ship on time"),
        F.lit("\nMinimum Qualifications"),
        F.concat(F.lit("- "), years, F.lit("+ years of supply work")),
    )
    return rows.select(F.col("s_suppkey").cast("string").alias("doc_id"), text.alias("text"))


def market_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (candidate_id, job_id): customer and supplier that traded."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return applications(orders.join(lineitem, "l_orderkey"), "o_custkey", "l_suppkey")
