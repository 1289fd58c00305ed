"""Terms as bits and numbers against plain counting."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.functions.bitsets import bit_dot, listed_dot, shared_bits, shared_numbers, trimmed
from rankloom.operators import encoding as E
from rankloom.operators.features import pair_rows
from rankloom.operators.pairs import assign
from rankloom.plans.market_queries import candidates, features, jobs
from rankloom.plans.market import market_applications


def rows(spark, lists):
    entry = [(i, [("s", "word", t, n) for t, n in c.items()]) for i, c in enumerate(lists)]
    return E.written(spark.createDataFrame(entry, f"row long, terms {E.TERMS}"), "rows")


@pytest.mark.parametrize("head", [4096, 64, 3])
def test_products_and_shares_equal_counting(spark, head):
    random.seed(head)
    words = [f"w{i}" for i in range(200)]
    lists = [Counter(random.choices(words, weights=range(200, 0, -1), k=random.choice([0, 1, 30, 900]))) for _ in range(20)]
    others = [Counter(random.choices(words + ["none"], k=random.choice([0, 5, 300]))) for _ in range(10)]
    asked = rows(spark, lists)
    codes = E.term_codes(asked, head)
    used = sum(len(c) > 0 for c in lists)
    assert codes.words["word"] == -(-min(head, len({t for c in lists for t in c})) // 64) and used
    left, right = E.encode(rows(spark, others), codes), E.encode(asked, codes)
    pairs = left.select(F.col("row").alias("a"), F.col("slots")["s"].alias("x")).crossJoin(right.select(F.col("row").alias("b"), F.col("slots")["s"].alias("y")))
    x, y = F.col("x"), F.col("y")
    shared = shared_bits(x["bits"], 0, y["bits"]) + shared_numbers(x["numbers"], y["numbers"])
    dot = bit_dot(x["bits"], 0, y["bits"], codes.words["word"]) + listed_dot(x["numbers"], x["counts"], y["numbers"], y["counts"])
    # Bits of planes above the first say how often, so shares are counted on lists of ones.
    ones = lambda c: Counter(dict.fromkeys(c, 1))
    got = {(r.a, r.b): r.dot for r in pairs.select("a", "b", dot.alias("dot")).collect()}
    want = {(i, j): sum(a[t] * b[t] for t in a) for i, a in enumerate(others) for j, b in enumerate(lists)}
    assert {p: got.get(p, 0) for p in want} == want
    left, right = E.encode(rows(spark, map(ones, others)), codes), E.encode(rows(spark, map(ones, lists)), codes)
    pairs = left.select(F.col("row").alias("a"), F.col("slots")["s"].alias("x")).crossJoin(right.select(F.col("row").alias("b"), F.col("slots")["s"].alias("y")))
    got = {(r.a, r.b): r.n for r in pairs.select("a", "b", shared.alias("n")).collect()}
    assert {p: got.get(p, 0) for p in want} == {(i, j): len(a.keys() & b.keys()) for i, a in enumerate(others) for j, b in enumerate(lists)}


def test_words_without_bits_at_the_end_go(spark):
    df = spark.createDataFrame([([1, 0, 5, 0, 0],), ([0, 0],), ([],)], "b array<long>")
    assert [r[0] for r in df.select(trimmed(F.col("b"))).collect()] == [[1, 0, 5], [], []]


def test_pairs_carry_no_text_and_few_bytes(spark, sf_dir):
    """What goes to the pairs, which is what their exchange by job has to move."""
    pairs, mine, theirs = market_applications(spark, sf_dir), candidates(spark, sf_dir), jobs(spark, sf_dir)
    found, _ = pair_rows(pairs, mine, theirs, small_jobs=False)
    digest = [c for c in ("skill_count", "degrees", "candidate_years", "candidate_norm2", "bits", "numbers", "counts") if c in found.columns]
    kinds = {found.schema[c].dataType.simpleString() for c in digest}
    assert len(digest) == 7 and "string" not in " ".join(kinds)
    numbers = F.size("bits") + F.size("numbers") + F.size("counts") + 4
    assert found.agg(F.max(numbers * 8)).first()[0] < 500
    # One large pair list: bytes are those of the compressed exchange.
    path = E.written(found.select("candidate_id", "job_id", *digest), "digests").inputFiles()
    import os

    assert sum(os.path.getsize(p.removeprefix("file://")) for p in path) / found.count() < 200


def test_no_candidate_shares_a_term(spark, sf_dir):
    pairs = assign(candidates(spark, sf_dir).limit(3), ["nowhere"])
    assert features(spark, sf_dir, pairs).count() == 0


@pytest.mark.parametrize("head", [4096, 64, 3])
def test_digests_and_pair_products_equal_counting(spark, head):
    """One pass over many rows and many pairs: bits, numbers of rare terms, counts, nulls."""
    import pyarrow as pa

    from rankloom.functions.bitsets import PairProducts

    random.seed(head)
    words = [f"w{i}" for i in range(200)]
    asked = [random.choices(words, weights=range(200, 0, -1), k=k) for k in (0, 1, 30, 900)]
    terms = [[("l", "list", t, 1) for t in set(a)] + [("c", "count", t, n) for t, n in Counter(a).items()] for a in asked]
    right = E.written(spark.createDataFrame(list(enumerate(terms)), f"row long, terms {E.TERMS}"), "rows")
    codes = E.term_codes(right, head)
    texts = [None, [], *[random.choices(words + ["none"], k=k) for k in (1, 40, 700)]]
    left = spark.createDataFrame([(i, None if t is None else sorted(set(t)), t) for i, t in enumerate(texts)], "id long, l array<string>, c array<string>")
    mine = {r.id: r for r in E.digested(left, codes, {"list": "l", "count": "c"}, "count").collect()}
    theirs = {r["row"]: r.slots for r in E.encode(right, codes).collect()}
    none = {"bits": [], "numbers": [], "counts": []}
    width = codes.words["list"]
    products = PairProducts([(0, 0, width)], (width, width, codes.words["count"]))
    pairs = [(mine[i], theirs.get(j, {"l": none, "c": none}), t or [], a) for i, t in enumerate(texts) for j, a in enumerate(asked)]
    columns = [pa.array(v, pa.list_(k)) for v, k in (
        ([m.bits for m, *_ in pairs], pa.int64()), ([m.numbers for m, *_ in pairs], pa.int64()), ([m.counts for m, *_ in pairs], pa.int32()),
        ([s["l"]["bits"] + [0] * (width - len(s["l"]["bits"])) + s["c"]["bits"] for _, s, *_ in pairs], pa.int64()),
        ([s["l"]["numbers"] + s["c"]["numbers"] for _, s, *_ in pairs], pa.int64()),
        ([s["l"]["counts"] + s["c"]["counts"] for _, s, *_ in pairs], pa.int32()),
        ([[len(s["l"]["numbers"]), len(s["c"]["numbers"])] for _, s, *_ in pairs], pa.int32()),
    )]
    shared, dot = products(*columns)
    assert shared.tolist() == [len(set(t) & set(a)) for *_, t, a in pairs]
    assert dot.tolist() == [sum(n * Counter(a)[w] for w, n in Counter(t).items()) for *_, t, a in pairs]
    assert [mine[i].norm2 for i in range(len(texts))] == [sum(n * n for n in Counter(t or []).values()) for t in texts]


def test_digests_of_texts_equal_those_of_their_lists(spark):
    """Terms cut from texts in the digesting pass are those that the expressions cut."""
    from rankloom.functions.dictionary import phrases, runs
    from rankloom.functions.text import term_keys
    from rankloom.functions.vectors import tokens
    from rankloom.operators.features import SOURCE_FORMS

    texts = [None, "", "Go go GO! c++ 3 go", "İstanbul ½ Σας go Ⅷ naïve", "big data tools. Big  data", "\u212aotlin x"]
    lists = [None, [], ["C++", "c++ ", "!", "Big Data"], ["\u212aotlin", "go", None], ["tools", "Tools."], ["x"]]
    known = {"skill": ["c++", "big data", "kotlin", "go", "tools"], "certificate": ["go"],
             "project": ["big data", "data tools", "go", "x", "3 go"], "text": ["go", "istanbul", "½", "na", "naïve", "3", "kotlin", "ⅷ"]}
    asked = [(0, [(k, k, t, 1) for k, ts in known.items() for t in ts])]
    for head in (4096, 1):
        codes = E.term_codes(E.written(spark.createDataFrame(asked, f"row long, terms {E.TERMS}"), "rows"), head)
        rows = spark.createDataFrame(list(zip(range(6), lists, texts, strict=True)), "id long, l array<string>, t string")
        keys, lowered, whole = term_keys(F.col("l")), F.lower("t"), F.col("t")
        pieces = F.array_distinct(F.concat(phrases(runs(lowered), 1), phrases(runs(lowered), 2)))
        plain = rows.select("id", *[c.alias(k) for k, c in zip(known, (keys, keys, pieces, tokens(whole)), strict=True)])
        is_ascii = F.octet_length(whole) == F.char_length(whole)
        text = F.struct(F.when(is_ascii, whole).alias("ascii"), F.when(~is_ascii, tokens(whole)).alias("tokens"))
        sources = rows.select("id", *[c.alias(k) for k, c in zip(known, (F.col("l"), F.col("l"), lowered, text), strict=True)])
        columns = {k: k for k in known}
        expected = sorted(E.digested(plain, codes, columns, "text").collect())
        assert sorted(E.digested(sources, codes, columns, "text", SOURCE_FORMS).collect()) == expected


def test_best_pairs_get_their_facts_after_the_ranking(spark):
    """Rows with the same id keep their own facts, and what is ranked carries none."""
    from rankloom.operators.features import ROW_NUMBERS, numbered_rows, pair_features, with_facts
    from rankloom.operators.ranking import rank_top, score_by_formula
    from rankloom.operators.records import parse_candidates, parse_jobs
    from rankloom.operators.review import REVIEW_COLUMNS, reports

    resumes = [("a", "Ann Lee\nSkills\nJava, Docker"), ("a", "Ann Lee\nSkills\nPython"), ("b", "Bob Ray\nSkills\nSQL"), (None, "x")]
    texts = [("j", "Developer\nRequirements\nJava, SQL"), ("k", "Tester\nRequirements\nPython")]
    schema = "doc_id string, text string"
    mine = parse_candidates(spark.createDataFrame(resumes, schema), as_of_year=2026)
    theirs = parse_jobs(spark.createDataFrame(texts, schema))
    pairs = spark.createDataFrame([(c, j) for c in ("a", "b", None) for j in ("j", "k")], "candidate_id string, job_id string")
    wide = reports(rank_top(score_by_formula(pair_features(pairs, mine, theirs, keep=REVIEW_COLUMNS)), 2)).collect()
    mine, theirs = numbered_rows(mine, "candidate_row"), numbered_rows(theirs, "job_row")
    best = rank_top(score_by_formula(pair_features(pairs, mine, theirs, keep=ROW_NUMBERS)), 2)
    assert not set(REVIEW_COLUMNS) & set(best.columns)
    found = reports(with_facts(best, mine, theirs, REVIEW_COLUMNS)).collect()
    assert len(found) == 4 and sorted(found) == sorted(wide)
