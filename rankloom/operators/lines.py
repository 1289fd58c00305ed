"""Documents as a table of lines, for documents that are larger than a row.

A line belongs to the last labelled line above it. The table is cut into parts by document and place,
whatever the documents' sizes; each part finds the labels in itself, and a carry scan hands the last
label and the number of labels so far from part to part of a document: one narrow row for each part
that a document reaches into. No task holds a document.

Lines without a document id belong to no document and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.dictionary import dictionary_terms
from rankloom.functions.patterns import any_word, is_project_heading
from rankloom.functions.text import raw_lines, section_name, strip
from rankloom.operators.joins import written
from rankloom.vocabulary import DEFAULT, Vocabulary

#: Lines of a part, about.
PART_LINES = 200_000


def line_table(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", place: tuple[str, ...] = ()) -> DataFrame:
    """(id, place, pos, line): the lines of texts in order. Rows of one id are one document, in the
    order of the ``place`` columns, such as a page number."""
    return documents.select(id_column, *place, F.posexplode(raw_lines(F.col(text_column))).alias("pos", "line"))


def carried(lines: DataFrame, label: Column, key: str = "doc_id", order: tuple[str, ...] = ("pos",), parts: int | None = None) -> DataFrame:
    """``lines`` with ``own`` label, ``label`` of the last labelled line down to this one, and
    ``opened``, the number of labelled lines down to this one."""
    marked = lines.where(F.col(key).isNotNull()).withColumn("own", label)
    # Ranges are cut by a pass of their own, which is not to make the lines again.
    marked = written(marked, "marked")
    parts = max(1, marked.count() // PART_LINES) if parts is None else parts
    dealt = marked.repartitionByRange(parts, key, *order)
    # Written with their numbers, parts stay the same whatever is computed again.
    rows = written(dealt.withColumn("part", F.spark_partition_id()), "lines")
    so_far = Window.partitionBy("part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = rows.withColumn("here", F.last("own", ignorenulls=True).over(so_far)).withColumn("count", F.count("own").over(so_far))
    place = F.when(F.col("own").isNotNull(), F.struct(*order))
    ends = rows.groupBy("part", key).agg(F.max_by("own", place).alias("end"), F.count("own").alias("n"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(key, "part", F.last("end", ignorenulls=True).over(before).alias("carry"), F.sum("n").over(before).alias("carry_n"))
    full = within.join(handed.where(F.col("carry_n") > 0), ["part", key], "left")
    return full.select(
        *lines.columns,
        "own",
        F.coalesce("here", "carry").alias("label"),
        (F.col("count") + F.coalesce("carry_n", F.lit(0))).alias("opened"),
    )


def line_sections(lines: DataFrame, aliases: dict, key: str = "doc_id", order: tuple[str, ...] = ("pos",), parts: int | None = None) -> DataFrame:
    """Lines under a section header, with ``label``, the section, ``opened``, the number of its
    header, and ``own``, which is null but for the header itself."""
    found = carried(lines, section_name(F.col("line"), aliases), key, order, parts)
    return found.where("label IS NOT NULL")


def joined_lines(rows: DataFrame, by: list[str], order: tuple[str, ...], between: str, blanks: str | None = None) -> DataFrame:
    """(by, text): the ``line`` values of each group joined in order; a group's text must fit in a row."""
    entry = F.when(F.col("line").isNotNull(), F.struct(*order, "line"))
    lists = rows.groupBy(*by).agg(F.sort_array(F.collect_list(entry)).alias("lines"))
    text = F.array_join(F.transform("lines", lambda e: e["line"]), between)
    return lists.select(*by, (strip(text) if blanks is None else strip(text, blanks)).alias("text"))


def section_texts(sections: DataFrame, key: str = "doc_id", order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """(key, section, text) of ``line_sections``; a header without lines has an empty text."""
    bodies = sections.withColumn("line", F.when(F.col("own").isNull(), F.col("line"))).withColumn("section", F.col("label"))
    return joined_lines(bodies, [key, "section"], order, "\n")


def line_projects(
    lines: DataFrame, vocabulary: Vocabulary = DEFAULT, key: str = "doc_id", order: tuple[str, ...] = ("pos",), parts: int | None = None
) -> DataFrame:
    """(key, place, name, description, technologies): the projects of each document in the order
    of ``place``, as ``patterns.projects`` finds them in the section's text."""
    body = line_sections(lines, vocabulary.candidate_sections, key, order, parts)
    body = body.where((F.col("label") == "projects") & F.col("own").isNull()).select(*lines.columns)
    content = body.withColumn("line", strip(F.col("line"), " -\t")).where(F.col("line") != "")
    heading = F.when(is_project_heading(F.col("line"), vocabulary), strip(F.col("line"), " -:"))
    groups = carried(content, heading, key, order, parts).where(F.col("label") != "")
    lines_of = groups.withColumn("line", F.when(F.col("own").isNull(), F.col("line")))
    names = groups.where("own IS NOT NULL").select(key, "opened", F.col("own").alias("name"))
    headed = names.join(joined_lines(lines_of, [key, "opened"], order, " "), [key, "opened"])
    headed = headed.select(key, F.struct(F.col("opened").cast("long").alias("at"), *[F.lit(0).cast("long").alias(c) for c in order]).alias("place"), "name", F.col("text").alias("description"))
    cued = content.where(F.col("line").rlike(any_word(vocabulary.project_line_cues)))
    loose = cued.join(headed.select(key).distinct(), key, "left_anti").select(
        key,
        F.struct(F.lit(0).cast("long").alias("at"), *[F.col(c).cast("long").alias(c) for c in order]).alias("place"),
        strip(F.col("line"), " -:").alias("name"),
        F.lit("").alias("description"),
        F.col("line").alias("whole"),
    )
    every = headed.withColumn("whole", F.col("name")).unionByName(loose)
    first = Window.partitionBy(key, F.lower("name")).orderBy("place")
    kept = every.withColumn("copy", F.row_number().over(first)).where(F.col("copy") == 1)
    skills = dictionary_terms(F.concat_ws(" ", "whole", "description"), vocabulary.candidate_skills)
    return kept.select(key, "place", "name", "description", skills.alias("technologies"))
