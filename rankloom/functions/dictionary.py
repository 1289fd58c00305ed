"""In-row dictionary matching for term lists known when the plan is built.

A term matches when neither neighbour is one of ``TERM_CHARS``. For terms made
of those characters and single spaces this equals: the term is a whole run of
such characters, or a sequence of runs one space apart. So the text is cut into
runs once and looked up by hash, at a cost that does not grow with the number of
terms times the length of the text. Other terms use a regular expression, and so
do the terms of a short list, for which that is faster.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.text import bind, constant_array, constant_map
from rankloom.vocabulary import TERM_CHARS

_PLAIN_TERM = re.compile(rf"[{TERM_CHARS}]+(?: [{TERM_CHARS}]+)*")


def unique_terms(terms) -> dict[str, str]:
    """Lower-cased term -> first spelling, in dictionary order."""
    spellings: dict[str, str] = {}
    for term in terms:
        spellings.setdefault(term.lower(), term)
    return spellings


# Runs one space apart. Possessive, so that Java matches it without recursion.
_CHAIN = "[a-z0-9+#.-]++(?: [a-z0-9+#.-]++)*+"


def runs(text: Column) -> Column:
    """Runs of term characters. An empty element marks where a phrase must stop."""
    chains = F.regexp_extract_all(F.lower(text), F.lit(_CHAIN), F.lit(0))
    stop = F.array(F.lit(""))
    return F.flatten(F.transform(chains, lambda c: F.concat(F.split(c, " "), stop)))


def phrases(words: Column, n: int, starts=None) -> Column:
    """The ``n``-run phrases of a text, optionally only those with a given start."""

    def phrase(ws: Column, w: Column, i: Column) -> Column:
        wanted = (w != "") if starts is None else w.isin(*starts)
        return F.when(wanted, F.array_join(F.slice(ws, i + 1, n), " "))

    every = bind(words, lambda ws: F.transform(ws, lambda w, i: phrase(ws, w, i)))
    return F.filter(every, lambda p: p.isNotNull())


#: Terms up to which each is looked for by itself; more are looked up by hash.
FEW_TERMS = 16


def _few(lowered: Column, terms) -> Column:
    """The lower-cased terms that occur in a lower-cased text, each tested by itself."""
    edge = f"[{TERM_CHARS}]"

    def occurs(text: Column, term: str) -> Column:
        # Most texts lack a term altogether, which takes no pattern.
        return F.contains(text, F.lit(term)) & text.rlike(rf"(?<!{edge})\Q{term}\E(?!{edge})")

    def found(text: Column) -> Column:
        return F.when(text.isNotNull(), F.array_compact(F.array(*[F.when(occurs(text, t), F.lit(t)) for t in terms])))

    return bind(lowered, found)


def _places(words: Column, places: dict[str, int]) -> Column:
    """Places of those of ``words`` that are plain terms, by their CRC: as many buckets as terms."""
    buckets = [""] * len(places)
    for term, at in places.items():
        # Plain terms have no control characters.
        buckets[zlib.crc32(term.encode()) % len(places)] += f"\x1e{term}\x1d{at}"
    size = F.lit(len(buckets))

    def place(word: Column) -> Column:
        bucket = F.get(constant_array(buckets), (F.crc32(word.cast("binary")) % size).cast("int"))
        rest = F.split_part(bucket, F.concat(F.lit("\x1e"), word, F.lit("\x1d")), F.lit(2))
        return F.split_part(rest, F.lit("\x1e"), F.lit(1)).try_cast("int")

    return F.filter(F.transform(words, place), lambda at: at.isNotNull())


#: Different first words up to which phrases are found by them; with more, all phrases are looked up.
STARTS = 64


def _phrases_from(lowered: Column, n: int, starts: set[str]) -> Column:
    """The ``n``-run phrases of a lower-cased text that begin with one of ``starts``.

    The pattern looks ahead and passes one run, so phrases that overlap are all found.
    """
    run = "[a-z0-9+#.-]++"
    first = "|".join(rf"\Q{s}\E" for s in sorted(starts)) if len(starts) <= STARTS else run
    pattern = rf"(?<![a-z0-9+#.-])(?=((?:{first})(?: {run}){{{n - 1}}})){run}"
    return F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1))


def _many(text: Column, terms: dict[str, int]) -> Column:
    """Places, as given in ``terms``, of the plain terms among the phrases of a text."""
    starts_by_length: dict[int, set[str]] = {}
    for term in terms:
        words = term.split(" ")
        starts_by_length.setdefault(len(words), set()).add(words[0])

    def occurring(lowered: Column) -> Column:
        found = [
            F.split(lowered, "[^a-z0-9+#.-]+") if n == 1 else _phrases_from(lowered, n, starts)
            for n, starts in sorted(starts_by_length.items())
        ]
        return F.array_distinct(F.concat(*found))

    return _places(bind(F.lower(text), occurring), terms)


def dictionary_terms(text: Column, terms) -> Column:
    """Dictionary terms that occur in ``text``, in dictionary order."""
    spellings = unique_terms(terms)
    if not spellings:
        return F.array().cast("array<string>")
    every = list(spellings)
    plain = {t: i for i, t in enumerate(every) if _PLAIN_TERM.fullmatch(t)}
    if len(spellings) <= FEW_TERMS:
        found = _few(F.lower(text), every)
        if all(k == v for k, v in spellings.items()):
            return found
        respelled = {k: v for k, v in spellings.items() if k != v}
        return F.transform(found, lambda t: F.coalesce(F.element_at(constant_map(respelled), t), t))
    places = _many(text, plain) if plain else F.when(text.isNotNull(), F.array().cast("array<int>"))
    odd = [t for t in every if t not in plain]
    if odd:
        place = {t: i for i, t in enumerate(every)}
        lowered = F.lower(text)
        edge = f"[{TERM_CHARS}]"
        tests = [F.when(lowered.rlike(rf"(?<!{edge})\Q{t}\E(?!{edge})"), F.lit(place[t])) for t in odd]
        places = F.concat(places, F.array_compact(F.array(*tests)))
    # Phrases are distinct, so places are.
    return F.transform(F.sort_array(places), lambda at: F.get(constant_array(spellings.values()), at))


def keyword_coverage(text: Column, terms) -> Column:
    """Share of the distinct terms that occur in ``text``; 0.0 without terms."""
    distinct = {}
    for term in terms:
        key = re.sub(r"[^a-z0-9+#]+", " ", term.lower()).strip()
        if key:
            distinct.setdefault(key, term)
    if not distinct:
        return F.lit(0.0)
    kept = list(distinct.values())
    return F.size(dictionary_terms(text, kept)).cast("double") / F.lit(len(kept))
