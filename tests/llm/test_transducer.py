"""Token counts against the tokenizer library itself."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from rankloom.llm import transducer
from rankloom.llm.queries import TOKENIZER, op7_token_counts

PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer(transducer.load_pieces(PATH))


def equal(machine, library, texts):
    assert machine.count(pa.array(texts, pa.string())).tolist() == [len(library.encode(t or "")) for t in texts]


def test_query_equals_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op7_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        i: (len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in texts.items()
    }


def test_white_space_and_unknown_characters(machine, library):
    equal(machine, library, [None, "", " ", "  ", "\n\t\r", "▁x ▁▁", "\x00", "<s> </s> <unk> <0x41>", "   x", "ﬁ Á é"])
    equal(machine, library, [f"{' ' * k}word{' ' * (k // 2)}{c}z" for k in range(70) for c in ("", "☃", "𓀀", "é")])


def test_random_pieces_and_letters(machine, library):
    random.seed(4)
    pieces = sorted(machine.scores)
    equal(machine, library, ["".join(random.choices(pieces, k=random.randint(1, 12))).replace("▁", " ") for _ in range(2000)])
    equal(machine, library, ["".join(random.choices("abcdehinorst", k=random.randint(1, 60))) for _ in range(2000)])
    points = [*range(1, 0x250), *range(0x4E00, 0x4E80), *range(0x1F600, 0x1F620), *range(0x3040, 0x30FF)]
    equal(machine, library, ["".join(map(chr, random.choices(points, k=random.randint(1, 80)))) for _ in range(2000)])


def test_long_words_compose_chunks(machine, library, monkeypatch):
    """Texts without white space: every chunk's entry state comes from the chunks before it."""
    texts = ["a" * 30_000, "ab" * 9_000, "日本語テキスト" * 3000, "=" * 20_000, "0123456789" * 900, "the" * 5000 + " x" * 5000]
    equal(machine, library, texts)
    monkeypatch.setattr(transducer, "CHUNK", 7)
    equal(machine, library, [t[:700] for t in texts] + ["one two  three   four\nfive"])


def test_random_texts_in_short_chunks(machine, library, monkeypatch):
    monkeypatch.setattr(transducer, "CHUNK", 5)
    random.seed(8)
    pieces = sorted(machine.scores)
    texts = ["".join(random.choices(pieces, k=random.randint(1, 40))).replace("▁", random.choice(["", " "])) for _ in range(400)]
    equal(machine, library, texts)


def test_prefix_scan_equals_one_after_another():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64):
        to, more = rng.integers(0, 4, (n, 4)), rng.integers(0, 9, (n, 4))
        first = np.maximum.accumulate(np.where(rng.random(n) < 0.15, np.arange(n), 0))
        reached, added = transducer.prefix_scan(to, more, first)
        for r in range(n):
            for c in range(4):
                column, total = c, 0
                for i in range(first[r], r + 1):
                    column, total = to[i, column], total + more[i, column]
                assert (reached[r, c], added[r, c]) == (column, total)


def test_tables_made_anew_give_the_same_counts(machine, library, monkeypatch):
    monkeypatch.setattr(transducer, "MOST_PAGES", 1)
    for _ in range(2):
        equal(machine, library, ["once more", "with feeling"])


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "x y " * 40_000), (None, "a b"), (4, "a b"), (4, "a b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_tokens", F.lit("clash"))
    got = sorted((tuple(r) for r in transducer.token_counts(docs, PATH).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows), key=repr)
    assert transducer.token_counts(docs.limit(0), PATH).count() == 0
