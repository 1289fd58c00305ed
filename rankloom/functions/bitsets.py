"""Sets and counts of dictionary-encoded terms as bits, so that a row carries a few longs.

A vocabulary's frequent terms have a bit each, 64 to a word; a count is cut into its binary digits,
one plane of words for each digit, and a product of counts is a sum of shifted bit counts. Rarer
terms are listed by number. Words at the end that are zero are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def _shift(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by.cast("int"))


def _word(bits: Column, at: Column) -> Column:
    return F.coalesce(F.get(bits, at.cast("int")), F.lit(0).cast("long"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)


def flat_words(groups: Column, words: Column, planes: Column) -> Column:
    """array<struct<word, planes: array<long>>> of one set -> its words plane by plane."""

    def one(k: Column) -> Column:
        mine = F.filter(groups, lambda g: g["word"] == k % words)
        return _word(F.get(mine, F.lit(0))["planes"], F.floor(k / words))

    return F.transform(F.sequence(F.lit(0), words * planes - 1), one)


def trimmed(bits: Column) -> Column:
    """Without the zero words at the end."""
    ends = F.transform(bits, lambda x, i: F.when(x != 0, i + 1).otherwise(F.lit(0)))
    return F.slice(bits, F.lit(1), F.coalesce(F.array_max(ends), F.lit(0)))


def shared_bits(bits: Column, offset: int, others: Column) -> Column:
    """How many terms ``others`` has in common with the words of ``bits`` from ``offset`` on."""
    return _total(F.transform(others, lambda x, i: F.bit_count(x.bitwiseAND(_word(bits, i + offset))).cast("long")))


def shared_numbers(numbers: Column, others: Column) -> Column:
    return F.when(F.size(others) > 0, F.size(F.array_intersect(others, numbers))).otherwise(F.lit(0))


def bit_dot(bits: Column, offset: int, others: Column, words: int) -> Column:
    """Sum of products of the counts in the planes of ``bits`` from ``offset`` on and of ``others``."""
    if not words:
        return F.lit(0).cast("long")

    def row(x: Column, k: Column) -> Column:
        digit, word = F.floor(k / words), k % words
        planes = F.sequence(F.lit(0), F.floor((F.size(others) - 1 - word) / words).cast("int"))
        products = F.transform(
            planes, lambda j: _shift(F.bit_count(x.bitwiseAND(_word(others, j * words + word))).cast("long"), digit + j)
        )
        return F.when((x != 0) & (F.size(others) > word), _total(products)).otherwise(F.lit(0).cast("long"))

    mine = F.slice(bits, F.lit(offset + 1), F.greatest(F.size(bits) - offset, F.lit(0)))
    return _total(F.transform(mine, row))


def listed_dot(numbers: Column, counts: Column, other_numbers: Column, other_counts: Column) -> Column:
    """Sum of products of the counts of numbers that both lists have."""

    def count(ns: Column, cs: Column, n: Column) -> Column:
        return F.get(cs, (F.array_position(ns, n) - 1).cast("int")).cast("long")

    common = F.array_intersect(other_numbers, numbers)
    products = F.transform(common, lambda n: count(numbers, counts, n) * count(other_numbers, other_counts, n))
    return F.when(F.size(other_numbers) > 0, _total(products)).otherwise(F.lit(0).cast("long"))


def list_values(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All values of the lists, and the row of each; null lists are empty, null values are left out."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat, owner = lists.flatten(), np.repeat(np.arange(len(lists)), sizes)
    if flat.null_count:
        owner, flat = owner[pc.is_valid(flat).to_numpy(zero_copy_only=False)], flat.drop_null()
    return flat, owner


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of numbers as rows, filled up with zeros."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rows = np.zeros((len(lists), max(1, int(sizes.max(initial=0)))), np.int64)
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return rows


def _part(rows: np.ndarray, start: int, size: int) -> np.ndarray:
    return rows[:, start : start + size]


def _shared(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    size = min(mine.shape[1], theirs.shape[1])
    return np.bitwise_count((mine[:, :size] & theirs[:, :size]).view(np.uint64)).sum(axis=1, dtype=np.int64)


#: Pairs that a step holds as rows of words.
PAIR_ROWS = 2048


class PairProducts:
    """Shares and the product of counts of both sides of many pairs at once.

    ``slots`` are (first word of the kind on the left, first word on the right, words) of the right
    side's lists; ``product`` is the same for the counted lists. The last of the right side's
    ``sizes`` is that of its counted list.
    """

    def __init__(self, slots: list[tuple[int, int, int]], product: tuple[int, int, int] | None):
        self.slots, self.product = slots, product

    def _listed(self, numbers, counts, others, other_counts, sizes, found, dot):
        """Adds what the numbers of rare terms have in common."""
        n, lists = len(numbers), len(self.slots) + (self.product is not None)
        mine, row = list_values(numbers)
        theirs, other = list_values(others)
        if not len(mine) or not len(theirs):
            return
        mine, theirs = mine.to_numpy().astype(np.int64), theirs.to_numpy().astype(np.int64)
        slot = np.repeat(np.tile(np.arange(lists), n), sizes.flatten().to_numpy())
        every = np.unique(theirs)
        place = np.minimum(np.searchsorted(every, mine), len(every) - 1)
        known = np.flatnonzero(every[place] == mine)
        key = row[known] * len(every) + place[known]
        order = np.argsort(key, kind="stable")
        key, known = key[order], known[order]
        wanted = other * len(every) + np.searchsorted(every, theirs)
        at = np.minimum(np.searchsorted(key, wanted), max(0, len(key) - 1))
        hit = key[at] == wanted if len(key) else np.zeros(len(wanted), bool)
        for s in range(len(self.slots)):
            found[s] += np.bincount(other[hit & (slot == s)], minlength=n)
        if self.product is not None:
            hit &= slot == len(self.slots)
            tf = list_values(counts)[0].to_numpy().astype(np.int64)[known[at[hit]]] if hit.any() else np.zeros(0, np.int64)
            np.add.at(dot, other[hit], tf * list_values(other_counts)[0].to_numpy().astype(np.int64)[hit])

    def _step(self, bits, numbers, counts, others, other_numbers, other_counts, sizes) -> list[np.ndarray]:
        mine, theirs = _matrix(bits), _matrix(others)
        found = [_shared(_part(mine, left, words), _part(theirs, right, words)) for left, right, words in self.slots]
        dot = np.zeros(len(bits), np.int64)
        if self.product is not None and (words := self.product[2]):
            left, right, _ = self.product
            for i, first in enumerate(range(left, mine.shape[1], words)):
                for j, second in enumerate(range(right, theirs.shape[1], words)):
                    dot += _shared(_part(mine, first, words), _part(theirs, second, words)) << (i + j)
        self._listed(numbers, counts, other_numbers, other_counts, sizes, found, dot)
        return [*found, dot]

    def __call__(self, *columns: pa.Array) -> list[np.ndarray]:
        steps = range(0, len(columns[0]), PAIR_ROWS)
        parts = [self._step(*[c.slice(at, PAIR_ROWS) for c in columns]) for at in steps]
        empty = [np.zeros(0, np.int64)] * (len(self.slots) + 1)
        return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else empty


def pair_products(products: PairProducts, names: list[str], *columns: Column) -> Column:
    """Struct of the shares of the slots by name, and ``dot``; ``columns`` are bits, numbers and
    counts of the left side, the same of the right side, and the right side's ``sizes``."""

    @F.arrow_udf("struct<" + ", ".join(f"{n}: bigint" for n in [*names, "dot"]) + ">")
    def run(*arrays: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(v) for v in products(*arrays)], names=[*names, "dot"])

    return run(*columns)
