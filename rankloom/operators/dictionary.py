"""Dictionary matching as a join, for lexicons that live in tables."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.dictionary import phrases, runs
from rankloom.functions.text import bind
from rankloom.operators.joins import is_small, lookup_join, written
from rankloom.vocabulary import TERM_CHARS

_PLAIN = rf"^[{TERM_CHARS}]+(?: [{TERM_CHARS}]+)*\z"


def text_phrases(documents: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """Distinct (id, phrase) rows of 1..``words`` runs, built inside each row."""
    found = bind(
        runs(F.col(text_column)),
        lambda ws: F.array_distinct(F.concat(*[phrases(ws, n) for n in range(1, words + 1)])),
    )
    return documents.select(id_column, F.explode(found).alias("phrase"))


#: Phrases that tasks look up in a set of their own, at most; more are joined.
SET_ROWS, SET_BYTES = 200_000, 16 * 1024 * 1024
#: Runs one space apart, of a lower-cased text.
_CHAIN = re.compile("[a-z0-9+#.-]+(?: [a-z0-9+#.-]+)*")


class PhraseSet:
    """Phrases by their words, looked up in whole texts."""

    def __init__(self, phrases: list[str]):
        self.known: dict[int, set] = {}
        for phrase in phrases:
            words = tuple(phrase.split(" "))
            self.known.setdefault(len(words), set()).add(words)

    def found(self, text: str) -> list[str]:
        """The distinct known phrases of a lower-cased text."""
        hits: set[tuple[str, ...]] = set()
        for chain in _CHAIN.findall(text):
            words = chain.split(" ")
            for n, known in self.known.items():
                hits |= known.intersection(zip(*[words[k:] for k in range(n)], strict=False))
        return [" ".join(h) for h in hits]


def known_phrases(documents: DataFrame, phrases: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The (id, phrase) rows of ``text_phrases`` that are among few ``phrases``: others make no rows."""
    # Measured small by the caller.
    known = documents.sparkSession.sparkContext.broadcast(PhraseSet([r["phrase"] for r in phrases.collect()]))

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else known.value.found(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return documents.select(id_column, F.explode(run(F.lower(F.col(text_column)))).alias("phrase"))


#: Characters of the pieces by which odd terms are found.
GRAM = 3


def grams(text: Column, sizes) -> Column:
    """Distinct pieces of ``sizes`` characters of a lower-cased text."""
    sizes = list(sizes)

    def pieces(text: str) -> list[str]:
        return list({text[i : i + n] for n in sizes for i in range(len(text) - n + 1)})

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else pieces(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return run(F.lower(text))


def term_pattern(term: Column) -> Column:
    """Regular expression for a whole term; every character but letters and digits is escaped."""
    escaped = F.regexp_replace(F.lower(term), r"([^\p{L}\p{N}])", r"\\$1")
    return F.concat(F.lit(f"(?<![{TERM_CHARS}])"), escaped, F.lit(f"(?![{TERM_CHARS}])"))


def match_dictionary(
    documents: DataFrame,
    lexicon: DataFrame,
    words: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, term + the lexicon's other columns) for each lexicon term in a text.

    Terms of term characters and single spaces equal a phrase of the text and are joined on it, after
    a look-up in the task that holds the text if they are few;
    ``words`` is their greatest number of words and is measured if not given. Any other term meets
    the texts that hold its rarest piece of ``GRAM`` characters, and a pattern decides. Both are plain
    equi-joins:
    adaptive execution broadcasts a small lexicon and splits a term that many documents hold.
    """
    keyed = lexicon.where(F.col("term").isNotNull()).withColumn("phrase", F.lower("term"))
    plain = keyed.where(F.col("phrase").rlike(_PLAIN))
    odd = keyed.where(~F.col("phrase").rlike(_PLAIN) & (F.col("phrase") != ""))
    facts = keyed.agg(
        F.max(F.when(F.col("phrase").rlike(_PLAIN), F.size(F.split("phrase", " ")))).alias("words"),
        F.coalesce(F.bool_or(~F.col("phrase").rlike(_PLAIN) & (F.col("phrase") != "")), F.lit(False)).alias("odd"),
    ).first()
    longest = facts["words"] or 1
    if words is not None and words < longest:
        raise ValueError(f"the lexicon has terms of {longest} words, more than {words}")
    wanted = written(plain.select("phrase").distinct(), "phrases")
    if is_small(wanted, SET_ROWS, SET_BYTES):
        met = known_phrases(documents, wanted, id_column, text_column)
    else:
        met = text_phrases(documents, longest, id_column, text_column)
    found = met.join(plain, "phrase").drop("phrase")
    if not facts["odd"]:
        return found
    return found.unionByName(_odd_matches(documents, odd, id_column, text_column))


def rarest_grams(documents: DataFrame, odd: DataFrame, sizes, text_column: str) -> DataFrame:
    """(phrase, gram): for each phrase that may occur its piece that the fewest documents hold."""
    size = F.least(F.char_length("phrase"), F.lit(GRAM))
    pieces = F.coalesce(*[F.when(size == n, grams(F.col("phrase"), [n])) for n in sizes])
    own = odd.select("phrase").distinct().select("phrase", F.explode(pieces).alias("gram"))
    held = documents.select(F.explode(grams(F.col(text_column), sizes)).alias("gram"))
    wanted = written(own.select("gram").distinct(), "grams")
    counts = written(lookup_join(held, wanted, "gram").groupBy("gram").agg(F.count("*").alias("n")), "grams")
    # A phrase with a piece that no document holds occurs nowhere.
    rated = own.join(counts, "gram", "left").groupBy("phrase").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("least"))
    return rated.where(F.col("least.n") > 0).select("phrase", F.col("least.gram").alias("gram"))


def _odd_matches(documents: DataFrame, odd: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Matches of terms that are no phrases: a document that holds a term holds its rarest piece.

    The pattern is tested where the text is; with a lexicon too large to broadcast, each document's
    terms are gathered by id and its text is fetched once.
    """
    lengths = F.least(F.char_length("phrase"), F.lit(GRAM))
    sizes = sorted(r[0] for r in odd.select(lengths).distinct().collect())
    keys = written(rarest_grams(documents, odd, sizes, text_column), "keys")
    texts = documents.select(F.col(id_column).alias("_id"), F.lower(text_column).alias("_lowered"))
    held = F.explode(grams(F.col("_lowered"), sizes)).alias("gram")
    if is_small(keys):
        near = texts.select("_id", "_lowered", held).join(F.broadcast(keys), "gram")
    else:
        found = texts.select("_id", held).join(keys, "gram").groupBy("_id").agg(F.collect_set("phrase").alias("_phrases"))
        met = texts.join(found.withColumnRenamed("_id", "_found"), F.col("_id").eqNullSafe(F.col("_found")))
        near = met.select("_id", "_lowered", F.explode("_phrases").alias("phrase"))
    checked = near.where(F.regexp_like("_lowered", term_pattern(F.col("phrase")))).select("_id", "phrase").distinct()
    return lookup_join(checked, odd, "phrase").drop("phrase").withColumnRenamed("_id", id_column)
