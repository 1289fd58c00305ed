"""Term lists of rows as bits and numbers over the vocabulary of one side.

Rows carry ``terms``: array<struct<slot, kind, term, tf>>. The terms of the side that asks make a
vocabulary for each kind; terms that it lacks cannot be shared and are left out. The ``HEAD`` most
frequent terms of a kind get bits, the others are listed by number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from rankloom.functions.bitsets import flat_words, list_values, trimmed
from rankloom.operators.dictionary import PhraseSet
from rankloom.operators.joins import is_small, lookup_join, written

#: Terms of a kind that get bits, at most.
HEAD = 4096
TERMS = "array<struct<slot:string,kind:string,term:string,tf:int>>"


def terms(slot: str, kind: str, values: Column) -> Column:
    """The entries of a list of distinct terms."""
    return F.transform(
        values, lambda t: F.struct(F.lit(slot).alias("slot"), F.lit(kind).alias("kind"), t.alias("term"), F.lit(1).alias("tf"))
    )


def counted(slot: str, kind: str, vector: Column) -> Column:
    """The entries of a term vector."""
    return F.transform(
        vector, lambda e: F.struct(F.lit(slot).alias("slot"), F.lit(kind).alias("kind"), e["term"].alias("term"), e["tf"].cast("int").alias("tf"))
    )


@dataclass
class TermCodes:
    """The written vocabulary (kind, term, number, bit), and words that each kind's bits take."""

    codes: DataFrame
    words: dict[str, int]

    def offsets(self, kinds) -> dict[str, int]:
        """Where each kind begins if the words of all follow one another."""
        found, at = {}, 0
        for kind in kinds:
            found[kind] = at
            at += self.words.get(kind, 0)
        return found


def term_codes(rows: DataFrame, head: int = HEAD) -> TermCodes:
    """The vocabulary of the ``terms`` of written rows."""
    entries = rows.select(F.explode("terms").alias("e")).groupBy("e.kind", "e.term").agg(F.count("*").alias("n"))
    numbered = written(entries.withColumn("number", F.monotonically_increasing_id()), "vocabulary")
    frequent = Window.partitionBy("kind").orderBy(F.col("n").desc(), "term")
    first = numbered.withColumn("place", F.row_number().over(frequent)).where(F.col("place") <= head)
    bits = first.select("kind", "term", (F.col("place") - 1).alias("bit"))
    # At most ``head`` rows of a few kinds.
    codes = written(numbered.drop("n").join(F.broadcast(bits), ["kind", "term"], "left"), "vocabulary")
    sizes = codes.groupBy("kind").agg(F.max("bit").alias("last")).collect()
    return TermCodes(codes, {r["kind"]: r["last"] // 64 + 1 for r in sizes})


def encode(rows: DataFrame, codes: TermCodes) -> DataFrame:
    """(row, slots): for every ``row`` with known terms a map from slot to
    struct<bits, numbers, counts>; ``rows`` is a written table with distinct values in ``row``."""
    most = rows.agg(F.max(F.array_max(F.transform("terms", lambda e: e["tf"])))).first()[0] or 1
    planes = int(most).bit_length()
    entries = rows.select("row", F.explode("terms").alias("e")).select("row", "e.*")
    known = lookup_join(entries, codes.codes, ["kind", "term"]).repartition("row")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % 64)
    digit = lambda p: F.bit_or(F.when(F.col("tf").bitwiseAND(F.lit(1 << p)) != 0, mask))
    zero = F.lit(0).cast("long")
    word = F.coalesce(F.floor(F.col("bit") / 64).cast("int"), F.lit(-1))
    groups = known.groupBy("row", "slot", "kind", word.alias("word")).agg(
        F.array(*[F.coalesce(digit(p), zero) for p in range(planes)]).alias("planes"),
        F.sort_array(F.collect_list(F.when(F.col("bit").isNull(), F.struct("number", "tf")))).alias("listed"),
        F.max(F.col("tf")).alias("most"),
    )
    width = F.coalesce(*[F.when(F.col("kind") == k, F.lit(n)) for k, n in codes.words.items()], F.lit(1))
    slots = groups.groupBy("row", "slot", "kind").agg(
        F.collect_list(F.when(F.col("word") >= 0, F.struct("word", "planes"))).alias("groups"),
        F.flatten(F.collect_list("listed")).alias("listed"),
        F.max(F.when(F.col("word") >= 0, F.col("most"))).alias("most"),
    )
    used = F.coalesce(F.length(F.bin(F.col("most").cast("long"))), F.lit(1))
    value = F.struct(
        trimmed(flat_words(F.col("groups"), width, used)).alias("bits"),
        F.transform("listed", lambda e: e["number"]).alias("numbers"),
        F.transform("listed", lambda e: e["tf"]).alias("counts"),
    )
    coded = slots.select("row", "slot", value.alias("value"))
    return coded.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "value"))).alias("slots"))


#: A digest of the lists of a row: words of bits, kind after kind, numbers of rare terms with their
#: counts, and the squared norm of the counted list.
DIGEST = "bits array<bigint>, numbers array<bigint>, counts array<int>, norm2 bigint"


_KEY, _ASCII_TOKEN = re.compile("[a-z0-9+#]+"), re.compile("[a-z0-9]+")


def key_lists(lists: pa.Array) -> pa.Array:
    """The distinct token keys of lists of terms, as ``term_keys`` has them but for their order."""
    flat, owner = list_values(lists)
    coded = flat.dictionary_encode()
    # A batch has few different terms.
    keys = [" ".join(_KEY.findall(t.lower())) for t in coded.dictionary.to_pylist()]
    every = pa.array(sorted(set(keys) - {""}), pa.string())
    place = pc.fill_null(pc.index_in(pa.array(keys, pa.string()), value_set=every), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at, size = place[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)], max(1, len(every))
    distinct = np.unique(owner[at >= 0].astype(np.int64) * size + at[at >= 0])
    ends = np.searchsorted(distinct // size, np.arange(len(lists) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), every.take(pa.array(distinct % size)))


def token_lists(texts: pa.Array) -> pa.Array:
    """The tokens of texts of ASCII characters alone."""
    found = [None if t is None else _ASCII_TOKEN.findall(t.lower()) for t in texts.to_pylist()]
    return pa.array(found, pa.list_(pa.string()))


class Digester:
    """Digests of many rows at once, over a vocabulary small enough to broadcast.

    A kind's column holds the terms of its list if ``forms`` has nothing else: terms yet to be keyed
    (``keyed``), a lower-cased text in which plain terms are phrases (``phrases``), or a struct of an
    ASCII text, or else the tokens of another one (``tokens``).
    """

    def __init__(
        self, codes: TermCodes, kinds: tuple[str, ...], counted: str | None = None, forms: dict[str, str] | None = None
    ):
        # Measured small by the caller.
        rows = codes.codes.select("kind", "term", "number", "bit").collect()
        self.kinds, self.counted, self.words = kinds, counted, [codes.words.get(k, 0) for k in kinds]
        self.known = {}
        for kind in kinds:
            mine = [r for r in rows if r["kind"] == kind]
            bits = np.array([-1 if r["bit"] is None else r["bit"] for r in mine], np.int64)
            self.known[kind] = [r["term"] for r in mine], bits, np.array([r["number"] for r in mine], np.int64)
        self.forms = forms or {}
        self.phrases = {k: PhraseSet(self.known[k][0]) for k, form in self.forms.items() if form == "phrases"}

    def _lists(self, kind: str, column: pa.Array) -> list[pa.Array]:
        """The lists of terms that a kind's column stands for; a row has terms in one of them."""
        form = self.forms.get(kind)
        if form == "keyed":
            return [key_lists(column)]
        if form == "tokens":
            ascii_text, other = column.flatten()
            return [token_lists(ascii_text), other]
        if form == "phrases":
            found = [None if t is None else self.phrases[kind].found(t) for t in column.to_pylist()]
            return [pa.array(found, pa.list_(pa.string()))]
        return [column]

    def _entries(self, kind: str, terms: pa.Array) -> tuple[np.ndarray, ...]:
        """(row, place in the vocabulary, tf) of the known terms, and each row's squared norm."""
        flat, owner = list_values(terms)
        flat = flat.dictionary_encode()
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        ids, owner = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), owner.astype(np.int64)
        size = max(1, len(flat.dictionary))
        key = owner * size + ids
        tf = np.ones(len(key), np.int64)
        norm2 = np.zeros(len(terms), np.int64)
        if kind == self.counted:
            key, tf = np.unique(key, return_counts=True)
            owner, ids = key // size, key % size
            np.add.at(norm2, owner, tf * tf)
        place = pc.fill_null(pc.index_in(flat.dictionary, value_set=pa.array(self.known[kind][0], flat.dictionary.type)), -1)
        place = place.to_numpy(zero_copy_only=False).astype(np.int64)[ids]
        return owner[place >= 0], place[place >= 0], tf[place >= 0], norm2

    def __call__(self, *lists: pa.Array) -> pa.StructArray:
        n, offset, norm2 = len(lists[0]), 0, np.zeros(len(lists[0]), np.int64)
        set_bits, rare = [], []
        for kind, words, column in zip(self.kinds, self.words, lists, strict=True):
            *parts, squares = zip(*[self._entries(kind, terms) for terms in self._lists(kind, column)], strict=True)
            row, place, tf = map(np.concatenate, parts)
            norm2 += sum(squares)
            bit, number = self.known[kind][1][place], self.known[kind][2][place]
            has = bit >= 0
            mask = np.left_shift(np.uint64(1), (bit[has] % 64).astype(np.uint64))
            for plane in range(int(tf[has].max(initial=0)).bit_length()):
                one = (tf[has] >> plane) & 1 == 1
                set_bits.append((row[has][one], offset + plane * words + bit[has][one] // 64, mask[one]))
            order = np.lexsort((number[~has], row[~has]))
            rare.append((row[~has][order], number[~has][order], tf[~has][order]))
            offset += words
        row, word, mask = (np.concatenate(x) for x in zip(*set_bits, strict=True)) if set_bits else (np.zeros(0, np.int64),) * 3
        sizes = np.zeros(n, np.int64)
        np.maximum.at(sizes, row, word + 1)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        bits = np.zeros(starts[-1], np.uint64)
        np.bitwise_or.at(bits, starts[row] + word, mask.astype(np.uint64))
        row, number, tf = (np.concatenate(x) for x in zip(*rare, strict=True))
        # Kind after kind within a row, as the bits are.
        order = np.argsort(row, kind="stable")
        ends = pa.array(np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32))
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(bits.view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(number[order], pa.int64())),
                pa.ListArray.from_arrays(ends, pa.array(tf[order].astype(np.int32))),
                pa.array(norm2),
            ],
            names=["bits", "numbers", "counts", "norm2"],
        )


def digested(
    rows: DataFrame, codes: TermCodes, lists: dict[str, str], counted: str | None = None, forms: dict[str, str] | None = None
) -> DataFrame | None:
    """``rows`` with the columns of a ``DIGEST`` in place of their columns ``lists``, by kind; None if
    the vocabulary is too large to broadcast.

    Columns are array<string> or of the ``forms`` of a ``Digester``. Terms of a list are distinct but
    for those of the kind ``counted``, which are counted here.
    """
    if not is_small(codes.codes):
        return None
    shared = rows.sparkSession.sparkContext.broadcast(Digester(codes, tuple(lists), counted, forms))
    plain = [f for f in rows.schema if f.name not in lists.values()]
    names = [f.name for f in plain]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value(*[batch.column(c) for c in lists.values()])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *found.flatten()], names=[*names, *(f.name for f in found.type)])

    return rows.mapInArrow(run, StructType([*plain, *StructType.fromDDL(DIGEST)]))


def numbered(rows: DataFrame, vocabulary: list[str], columns: list[str]) -> DataFrame:
    """``rows`` with places in ``vocabulary`` in place of the terms of its array<string> ``columns``, in
    their order; terms that are not in it are left out, null lists stay null."""
    schema = StructType([StructField(f.name, ArrayType(IntegerType())) if f.name in columns else f for f in rows.schema])
    known = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def places(lists: pa.Array, every: pa.Array) -> pa.Array:
        flat, owner = list_values(lists)
        place = pc.index_in(flat, value_set=every.cast(flat.type))
        owner = owner[pc.is_valid(place).to_numpy(zero_copy_only=False)]
        ends = np.searchsorted(owner, np.arange(len(lists) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), place.drop_null(), mask=pc.is_null(lists))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = pa.array(known.value, pa.string())
        for batch in batches:
            found = [places(batch.column(f.name), every) if f.name in columns else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(found, names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)
