"""License places against a plain search, and aligned notices."""

import random
import re

from pyspark.sql import functions as F

from rankloom.llm.licenses import BASE, NOTICES, scan_licenses
from rankloom.llm.queries import op8_license_scan


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text):
    words, places = words_of(text), []
    for t in BASE:
        wanted = t.words.split()
        places += [(t.label, i) for i in range(len(words) - len(wanted) + 1) if words[i : i + len(wanted)] == wanted]
    return words, places


def test_query_equals_plain_search(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op8_license_scan(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        words, places = plain(docs[r.doc_id])
        at = [p for _, p in places]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert r.base_labels == ",".join(sorted({label for label, _ in places}))
        assert {label for label, _ in places} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert any(r.base_labels for r in got)


def test_random_phrases_across_texts_and_cases(spark):
    random.seed(2)
    parts = ["CC", "by", "cc-by", "General", "public", "LICENSE", "all", "rights.", "reserved", "é", "x9", "\n"]
    rows = [(i, " ".join(random.choice(parts) for _ in range(random.randint(0, 40)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for r in scan_licenses(docs).collect():
        words, places = plain(dict(rows)[r.doc_id])
        assert r.n_words == len(words)
        assert sorted((p.label, p.word) for p in r.base_places) == sorted(places)


def test_notice_is_found_with_words_changed(spark):
    mit = NOTICES[1].words.split()
    changed = mit[:10] + ["some", "person"] + mit[12:]
    rows = [
        (1, "Copyright 2020.\n" + " ".join(mit).upper() + ", and so on"),
        (2, "intro " + " ".join(changed)),
        (3, "permission to obtain a copy of this software and files"),
        (4, "Licensed under the Apache License, Version 2.0."),
    ]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [(n.label, n.word, n.share) for n in got[1].notices] == [("mit", 2, 1.0)]
    assert [n.label for n in got[2].notices] == ["mit"] and 0.6 <= got[2].notices[0].share < 1
    assert got[3].notices == []
    assert [n.label for n in got[4].notices] == ["apache-2.0"]


def every_place(text, least=0.6):
    """All alignments of all notices, by trying each place."""
    words, found = words_of(text), []
    for t in NOTICES:
        wanted = t.words.split()
        for start in range(-len(wanted) + 1, len(words)):
            same = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(wanted)]
            phrases = [m.split() for m in t.mandatory]
            places = [next(i for i in range(len(wanted)) if wanted[i : i + len(m)] == m) for m in phrases]
            whole = any(all(same[p : p + len(m)]) for p, m in zip(places, phrases, strict=True))
            if whole and sum(same) >= least * len(wanted):
                found.append((t.label, max(0, start), sum(same) / len(wanted)))
    return sorted(found)


def test_notices_equal_trying_every_place(spark):
    random.seed(5)
    rows = []
    for i in range(160):
        words = []
        for t in random.choices(NOTICES, k=random.randint(0, 3)):
            part = t.words.split()
            for _ in range(random.randint(0, len(part) // 2)):
                part[random.randrange(len(part))] = random.choice(["x", "the", "software", random.choice(part)])
            cut = random.choice([0, 0, 0, random.randint(0, 4)])
            words += random.choices(["the", "of", "license", "z"], k=random.randint(0, 3)) + part[cut:]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    found = 0
    for r in scan_licenses(docs).collect():
        got = sorted((n.label, n.word, round(n.share, 9)) for n in r.notices)
        assert got == [(label, word, round(share, 9)) for label, word, share in every_place(dict(rows)[r.doc_id])]
        found += len(got)
    assert found > 100


def test_an_end_of_one_text_is_not_taken_for_the_next(spark):
    tail = "anything permission is"
    mit = NOTICES[1].words.split()
    rows = [(i, text) for i in range(20) for text in (tail, " ".join(mit[2:]))]
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: [(n.label, n.word) for n in r.notices] for r in scan_licenses(docs).collect()}
    assert all(got[n] == ([("mit", 0)] if n % 2 else []) for n in range(40))


def test_texts_are_told_apart(spark):
    texts = [t for t in NOTICES if len(t.words.split()) > 30]
    docs = spark.createDataFrame([(i, f"Copyright 2024. {t.words}") for i, t in enumerate(texts)], "doc_id bigint, text string")
    for r in scan_licenses(docs).collect():
        whole = {n.label for n in r.notices if n.share == 1.0 and n.word == 2}
        long = {n.label for n in r.notices} & {t.label for t in texts}
        assert texts[r.doc_id].label in whole and long == {texts[r.doc_id].label}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a " * 200_000 + "cc by"), (None, "cc by cc by"), (4, "cc by"), (4, "cc by")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("notices", F.lit(0))
    got = sorted(((r.doc_id, r.n_words, [p.word for p in r.base_places]) for r in scan_licenses(docs).collect()), key=repr)
    assert got == sorted(
        [(1, 0, []), (2, 0, []), (3, 200_002, [200_000]), (None, 4, [0, 2]), (4, 2, [0]), (4, 2, [0])], key=repr
    )
    assert scan_licenses(docs.limit(0)).count() == 0
