"""License scan over a positional rare-token index.

Templates are licence texts and notices. The index holds the inverse document frequency of their
words over all scanned documents. In each file the licence words it holds are taken by falling
frequency weight: of a template with *n* words, of which ``least`` must stand at their places, the
file's rarest are looked up until fewer than ``agree`` of them cannot be missed by any alignment that
counts. Every place of such a word gives an offset (place in the text minus place in the template);
offsets on which ``agree`` words meet are intersected with the template's other words, and an
alignment counts if the share holds and one of the template's mandatory phrases stands in it word for
word. A file that lacks too many of a template's words is not looked up at all. Phrase templates (no
mandatory phrase but the whole template) need all their words. The result is that of trying every
template at every place.

All steps are array operations on a short Arrow batch; documents are never shuffled. Defined results: a
null or empty text has no words, no labels and score 0; repeated rows count each for itself; two
templates at one place are both reported; an alignment that begins before its text (its first words
are cut off) begins at word 0; texts of any length are read whole and stay in one row, whose words
are arrays of about 30 times its bytes; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.tables import short_batches
from rankloom.llm.words import WORD_BYTES, HashSet, find_words, text_bytes


@dataclass(frozen=True)
class Template:
    """A licence wording; with no ``mandatory`` phrases the whole wording is mandatory."""

    label: str
    words: str
    mandatory: tuple[str, ...] = ()


#: Fixed values of the query's contract.
BASE = (
    Template("cc-by", "cc by"),
    Template("gpl", "general public license"),
    Template("reserved", "all rights reserved"),
)

#: Openings of common licence notices and whole licence texts, in words, under their usual short names.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files",
        ("permission is hereby granted", "associated documentation files"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "gpl-notice",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
        ("gnu general public license", "redistribute it and or modify it"),
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template(
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-notice",
        "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission to use copy modify and",)),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions the above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " software the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no"
        " event shall the authors or copyright holders be liable for any claim damages or other liability whether in"
        " an action of contract tort or otherwise arising from out of or in connection with the software or the use"
        " or other dealings in the software",
        ("merge publish distribute sublicense and or sell copies", "this permission notice shall be included in all copies"),
    ),
    Template(
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies the"
        " software is provided as is and the author disclaims all warranties with regard to this software including"
        " all implied warranties of merchantability and fitness in no event shall the author be liable for any"
        " special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data"
        " or profits whether in an action of contract negligence or other tortious action arising out of or in"
        " connection with the use or performance of this software",
        ("this permission notice appear in all copies", "the author disclaims all warranties"),
    ),
    Template(
        "bsd-2-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met 1 redistributions of source code must retain the above copyright notice"
        " this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the"
        " above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution this software is provided by the copyright holders and"
        " contributors as is and any express or implied warranties including but not limited to the implied"
        " warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the"
        " copyright holder or contributors be liable for any direct indirect incidental special exemplary or"
        " consequential damages including but not limited to procurement of substitute goods or services loss of use"
        " data or profits or business interruption however caused and on any theory of liability whether in contract"
        " strict liability or tort including negligence or otherwise arising in any way out of the use of this"
        " software even if advised of the possibility of such damage",
        ("materials provided with the distribution this software is provided",),
    ),
    Template(
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met 1 redistributions of source code must retain the above copyright notice"
        " this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the"
        " above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution 3 neither the name of the copyright holder nor the names of"
        " its contributors may be used to endorse or promote products derived from this software without specific"
        " prior written permission this software is provided by the copyright holders and contributors as is and any"
        " express or implied warranties including but not limited to the implied warranties of merchantability and"
        " fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be"
        " liable for any direct indirect incidental special exemplary or consequential damages including but not"
        " limited to procurement of substitute goods or services loss of use data or profits or business interruption"
        " however caused and on any theory of liability whether in contract strict liability or tort including"
        " negligence or otherwise arising in any way out of the use of this software even if advised of the"
        " possibility of such damage",
        ("to endorse or promote products derived from this software",),
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held"
        " liable for any damages arising from the use of this software permission is granted to anyone to use this"
        " software for any purpose including commercial applications and to alter it and redistribute it freely"
        " subject to the following restrictions 1 the origin of this software must not be misrepresented you must not"
        " claim that you wrote the original software if you use this software in a product an acknowledgment in the"
        " product documentation would be appreciated but is not required 2 altered source versions must be plainly"
        " marked as such and must not be misrepresented as being the original software 3 this notice may not be"
        " removed or altered from any source distribution",
        ("altered source versions must be plainly marked as such", "the origin of this software must not be misrepresented"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
        " use compile sell or distribute this software either in source code form or as a compiled binary for any"
        " purpose commercial or non commercial and by any means",
        ("free and unencumbered software released into the public domain",),
    ),
    Template(
        "gpl-notice-text",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your"
        " option any later version this program is distributed in the hope that it will be useful but without any"
        " warranty without even the implied warranty of merchantability or fitness for a particular purpose see the"
        " gnu general public license for more details",
        ("under the terms of the gnu general public license as published by the free software foundation",),
    ),
    Template(
        "apache-2.0-notice",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless"
        " required by applicable law or agreed to in writing software distributed under the license is distributed on"
        " an as is basis without warranties or conditions of any kind either express or implied see the license for"
        " the specific language governing permissions and limitations under the license",
        ("you may not use this file except in compliance with the license",),
    ),
)

#: Looked-up words that must agree on an offset (all of them where a template needs fewer).
AGREE = 4
#: Least share of a template's words that must stand at their places.
LEAST_MATCH = 0.6
#: Words of alignments that are compared at once.
COMPARED = 1 << 20


class LicenseIndex:
    """Word numbers and places of all templates, a template's places by falling weight of their words.

    ``frequency``: documents that hold a word.
    """

    def __init__(self, templates, frequency: dict[str, int], documents: int, agree: int = AGREE, least: float = LEAST_MATCH):
        self.templates = list(templates)
        vocabulary = sorted({w for t in templates for w in t.words.split()})
        data, offsets = text_bytes(pa.array(vocabulary))
        hashes = find_words(data, offsets)[2]
        self.members = HashSet(hashes)
        self.words = [b""] * len(vocabulary)
        number = {}
        for place, word in zip(np.searchsorted(self.members.values, hashes), vocabulary, strict=True):
            self.words[place] = word.encode()
            number[word] = int(place)
        self.idf = np.zeros(len(vocabulary))
        for word, i in number.items():
            self.idf[i] = math.log((documents + 1) / (frequency.get(word, 0) + 1))
        self.numbers, self.rarest, self.mandatory, self.needed, self.agree = [], [], [], [], []
        for template in templates:
            numbers = np.array([number[w] for w in template.words.split()])
            needed = math.ceil(len(numbers) * least) if template.mandatory else len(numbers)
            self.numbers.append(numbers)
            self.rarest.append(np.lexsort((np.arange(len(numbers)), -self.idf[numbers])))
            self.mandatory.append([self._place(template, m) for m in template.mandatory] or [(0, len(numbers))])
            self.needed.append(needed)
            self.agree.append(min(agree, needed))

    @staticmethod
    def _place(template: Template, phrase: str) -> tuple[int, int]:
        words, wanted = template.words.split(), phrase.split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                return i, len(wanted)
        raise ValueError(f"{phrase!r} does not stand in the template {template.label}")


@dataclass
class Places:
    """Alignments: text number, template number, first word in the text, share of words matched."""

    text: np.ndarray
    template: np.ndarray
    begin: np.ndarray
    share: np.ndarray
    n_words: np.ndarray


def _licence_words(data, begins, ends, hashes, index: LicenseIndex) -> tuple[np.ndarray, np.ndarray]:
    """Places of licence words among all words, by place, and their numbers; letters are compared."""
    at, member = index.members.find(hashes)
    right = np.zeros(len(at), bool)
    for word, mine in _by_number(member):
        letters = np.frombuffer(index.words[word], np.uint8)
        mine = mine[ends[at[mine]] - begins[at[mine]] == len(letters)]
        same = np.ones(len(mine), bool)
        for i, letter in enumerate(letters):
            same &= WORD_BYTES[data[begins[at[mine]] + i]] == letter
        right[mine[same]] = True
    return at[right], member[right]


def _by_number(member: np.ndarray):
    """(number, places that hold it, rising) for every number that occurs."""
    order = np.argsort(member, kind="stable")
    numbers, begin = np.unique(member[order], return_index=True)
    return zip(numbers.tolist(), np.split(order, begin[1:]), strict=False) if len(order) else ()


def _looked_up(present: np.ndarray, index: LicenseIndex, t: int) -> np.ndarray:
    """(files, places by falling weight): which of a template's places each file looks up.

    An alignment that counts misses at most ``n - needed`` places, those of absent words among
    them, so it holds at least ``agree`` of the first ``n - needed + agree - absent`` present ones.
    """
    n, needed = len(index.numbers[t]), index.needed[t]
    held = present[:, index.numbers[t][index.rarest[t]]]
    absent = n - held.sum(axis=1)
    wanted = np.where(absent <= n - needed, n - needed + index.agree[t] - absent, 0)
    return held & (np.cumsum(held, axis=1) <= wanted[:, None])


def align(column: pa.Array, index: LicenseIndex) -> Places:
    """All verified alignments of one batch."""
    data, offsets = text_bytes(column)
    begins, ends, hashes, first = find_words(data, offsets)
    docs = len(offsets) - 1
    owner = np.repeat(np.arange(docs), np.diff(first))
    at, member = _licence_words(data, begins, ends, hashes, index)
    occurrences = dict(_by_number(member))
    present = np.zeros((docs, len(index.words)), bool)
    present[owner[at], member] = True
    found = [[], [], [], []]
    # A vote names the file and the offset, which is negative where a text begins inside a template.
    longest = max((len(n) for n in index.numbers), default=0)
    span = len(owner) + longest
    for t, numbers in enumerate(index.numbers):
        chosen = _looked_up(present, index, t)
        votes = [np.zeros(0, np.int64)]
        for rank in np.flatnonzero(chosen.any(axis=0)):
            place = index.rarest[t][rank]
            here = at[occurrences[int(numbers[place])]]
            here = here[chosen[owner[here], rank]]
            votes.append(owner[here] * span + here - place + longest)
        offers, agreed = np.unique(np.concatenate(votes), return_counts=True)
        offers = offers[agreed >= index.agree[t]]
        step = max(1, COMPARED // len(numbers))
        for part in np.split(offers, np.arange(step, len(offers), step)):
            text, starts = part // span, part % span - longest
            places = starts[:, None] + np.arange(len(numbers))
            near = np.minimum(np.searchsorted(at, places), max(0, len(at) - 1))
            matched = (at[near] == places) & (member[near] == numbers) if len(at) else np.zeros(places.shape, bool)
            # Words of other texts don't count.
            matched &= (places >= first[text][:, None]) & (places < first[text + 1][:, None])
            verified = np.zeros(len(starts), bool)
            for begin, size in index.mandatory[t]:
                verified |= matched[:, begin : begin + size].all(axis=1)
            good = verified & (matched.sum(axis=1) >= index.needed[t])
            first_word = np.maximum(starts - first[text], 0)
            for out, values in zip(found, (text, np.full(len(starts), t), first_word, matched.mean(axis=1)), strict=True):
                out.append(values[good])
    merged = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]
    order = np.lexsort((merged[2], merged[1], merged[0]))
    return Places(*(m[order] for m in merged), np.diff(first))


def document_frequencies(docs: DataFrame, templates, text: str = "text") -> tuple[dict[str, int], int]:
    """How many documents hold each template word, over all documents, and how many there are."""
    index = LicenseIndex(templates, {}, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(len(index.words), np.int64), 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            _, _, hashes, first = find_words(data, offsets)
            at, member = index.members.find(hashes)
            owner = np.searchsorted(first, at, "right") - 1
            pairs = np.unique(owner * len(index.words) + member)
            held += np.bincount(pairs % len(index.words), minlength=len(index.words))
            total += batch.num_rows
        words = [w.decode() for w in index.words] + [""]
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array([*held.tolist(), total], pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word string, n bigint")
    # One row for each template word.
    found = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found, found.pop("", 0)


def scan_licenses(
    docs: DataFrame,
    base=BASE,
    notices=NOTICES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, base_places, notices) for every document.

    ``base_places``: (label, word) of each place of a base phrase; ``notices``: (label, word, share)
    of each aligned notice, words counted from 0.
    """
    templates = (*base, *notices)
    short_batches(docs.sparkSession)
    frequency, total = document_frequencies(docs, templates, text)
    index = docs.sparkSession.sparkContext.broadcast(LicenseIndex(templates, frequency, total))
    base_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    notice_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("share", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = align(batch.column(1), index.value)
            of_base: list[list] = [[] for _ in range(batch.num_rows)]
            of_notice: list[list] = [[] for _ in range(batch.num_rows)]
            for doc, t, word, share in zip(
                places.text.tolist(), places.template.tolist(), places.begin.tolist(), places.share.tolist(), strict=True
            ):
                row = {"label": templates[t].label, "word": word}
                if t < len(base):
                    of_base[doc].append(row)
                else:
                    of_notice[doc].append(row | {"share": share})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places.n_words, pa.int64()), pa.array(of_base, base_type), pa.array(of_notice, notice_type)],
                names=["doc_id", "n_words", "base_places", "notices"],
            )

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    key = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(
        scan,
        f"doc_id {key}, n_words bigint, base_places array<struct<label:string,word:bigint>>,"
        " notices array<struct<label:string,word:bigint,share:double>>",
    )
