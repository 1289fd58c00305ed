"""Token counts by a finite-state transducer compiled from a byte-fallback BPE piece list.

Merge rules prefer the best-scored piece, so the encoding of a prefix ends in exactly one piece
``t`` that may follow the last piece of the prefix without ``t``; ``a`` may be followed by ``b`` if
the encoding of their two texts together is ``a, b``. What later characters can change lies within
the pieces that are still open, so a state holds, for each open piece start, its place in the piece
trie, the piece before it and the tokens since. States and transitions are made when a text first
needs them; a transition carries the change in the number of tokens.

White space: a run's pieces merge after all others, leftmost first, with a period of ``PERIOD``;
run states carry that count. A character without a piece is counted by its bytes.

Texts of a batch are cut into chunks that advance together, one character a step, through flat
tables. A chunk that begins at white space has a constant state map. The maps of other chunks hold
the states that can reach them, with exits and token changes, and compose through a segmented prefix
scan over all texts of the batch, which is exact whatever the chunk borders.

Defined results: a null or empty text has no tokens; repeated rows count each for itself; texts of any
length are counted whole, in one task, whose arrays take about 20 times the bytes of the longest text; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.words import text_bytes

SPACE = "▁"
PERIOD = 16
PAGE = 64
CHUNK = 2048
LANES = 2048
#: Tables are made anew beyond this many pages (about 1 KB each with their states).
MOST_PAGES = 250_000


@dataclass(frozen=True)
class Pieces:
    """Normal pieces with their scores; ``runs`` are those of white space only."""

    scores: dict[str, float]
    runs: frozenset[int]


def load_pieces(path: str) -> Pieces:
    """Read a model and make sure that the transducer's premises hold for it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, runs = {}, set()
    for i in range(model.vocab_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        if model.is_unused(i) or SPACE in piece.lstrip(SPACE) or piece.startswith(SPACE * 2) and piece.strip(SPACE):
            raise ValueError(f"piece {piece!r} is not supported")
        if set(piece) == {SPACE}:
            runs.add(len(piece))
        else:
            scores[piece] = model.get_score(i)
    probe = "  ﬁ Á \t\x00x"
    if model.decode(model.encode(probe)) != probe or len(set(scores.values())) < len(scores):
        raise ValueError("the model changes its input or has tied scores")
    if any(merge(list(p), scores.get) != [p] for p in scores):
        raise ValueError("some pieces are never made")
    if any(model.get_score(model.piece_to_id(SPACE * n)) >= min(scores.values()) for n in runs):
        raise ValueError("white-space pieces must merge last")
    return Pieces(scores, frozenset(runs))


def merge(symbols: list[str], scores) -> list[str]:
    """Merge best-scored neighbours, leftmost first among equals, until none fit."""
    symbols = list(symbols)
    while True:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            score = scores(symbols[i] + symbols[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            return symbols
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


class Transducer:
    """States, transitions and their flat tables; grows as texts need it."""

    def __init__(self, pieces: Pieces):
        self.scores = pieces.scores
        self.run_tokens = [len(merge([SPACE] * n, lambda p: 0 if len(p) in pieces.runs else None)) for n in range(4 * PERIOD + 1)]
        if any(self.run_tokens[n] != n // PERIOD + self.run_tokens[n % PERIOD] for n in range(len(self.run_tokens))):
            raise ValueError("white-space runs don't have the expected period")
        self.children: list[dict[str, int]] = [{}]
        self.piece_at: list[str | None] = [None]
        for piece in [SPACE, *sorted(pieces.scores)]:
            node = 0
            for c in piece:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.piece_at.append(None)
                node = self.children[node][c]
            self.piece_at[node] = piece
        known = sorted(c for c in self.children[0] if c != SPACE)
        #: Classes: 0 white space, 1-4 unknown by bytes, then the pieces' characters.
        self.characters = [SPACE, "", "", "", "", *known]
        self.class_of = np.full(0x110000, 4, np.uint16)
        for size, end in ((3, 0x10000), (2, 0x800), (1, 0x80)):
            self.class_of[:end] = size
        self.class_of[[ord(c) for c in known]] = np.arange(5, 5 + len(known))
        self.class_of[[ord(" "), ord(SPACE)]] = 0
        self.width = -(-len(self.characters) // PAGE)
        self.follows: dict[tuple[str, str], bool] = {}
        self.edges: dict[str, tuple[list, list]] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.pages = np.zeros((1024, self.width), np.int32)
        self.next = np.full((1024, PAGE), -1, np.int32)
        self.delta = np.zeros((1024, PAGE), np.int8)
        self.used = 1
        self.follows.clear()
        self.hard = self._state((0, ((0, None, 0),)))
        self.start = self._state(self._run(1))

    def _run(self, n: int) -> tuple:
        """The state after a run of ``n`` white-space characters."""
        since = self.run_tokens[n] - self.run_tokens[n - 1]
        return (n, ((self.children[0][SPACE], None, since), (0, SPACE, 0)))

    def _state(self, key: tuple) -> int:
        if key not in self.states:
            self.states[key] = len(self.keys)
            self.keys.append(key)
            if len(self.keys) > len(self.pages):
                self.pages = np.vstack([self.pages, np.zeros((len(self.pages) // 2, self.width), np.int32)])
        return self.states[key]

    def _may_follow(self, a: str | None, b: str) -> bool:
        if a is None:
            return True
        if (a, b) not in self.follows:
            self.follows[a, b] = self._stay_apart(self._edges(a)[1], self._edges(b)[0])
        return self.follows[a, b]

    def _edges(self, piece: str) -> tuple[list, list]:
        """How a piece's first and last symbol grow while its own characters merge: for each its
        texts in turn, with the score of the merge that ends it."""
        if piece not in self.edges:
            symbols, first, last = list(piece), [], []
            while len(symbols) > 1:
                score, at = max(
                    (self.scores[m], -i) for i in range(len(symbols) - 1) if (m := symbols[i] + symbols[i + 1]) in self.scores
                )
                at = -at
                if at == 0:
                    first.append((symbols[0], score))
                if at == len(symbols) - 2:
                    last.append((symbols[-1], score))
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            end = (piece, float("-inf"))
            self.edges[piece] = ([*first, end], [*last, end])
        return self.edges[piece]

    def _stay_apart(self, left: list, right: list) -> bool:
        """Whether no merge crosses the border between two pieces that merge side by side."""
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = left[i], right[j]
            score = self.scores.get(a + b)
            if score is not None and score > a_ends and score >= b_ends:
                return False
            if a_ends == b_ends == float("-inf"):
                return True
            if a_ends >= b_ends:
                i += 1
            else:
                j += 1

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, tokens more) of one transition, from the definition."""
        run, entries = self.keys[state]
        if symbol == 0:
            n = run % PERIOD + 1
            more = self.run_tokens[run % PERIOD + 1] - self.run_tokens[run % PERIOD] if run else 1
            if run == PERIOD:
                more = 1
            return self._state(self._run(n)), more
        if symbol < 5:
            return self.hard, symbol
        c = self.characters[symbol]
        reached = [(self.children[n][c], b, s) for n, b, s in entries if c in self.children[n]]
        fitting = [(self.piece_at[n], s) for n, b, s in reached if self.piece_at[n] and self._may_follow(b, self.piece_at[n])]
        if len(fitting) != 1:
            raise ValueError(f"{len(fitting)} pieces fit after {entries}")
        piece, since = fitting[0]
        more = 1 - since
        moved = tuple((n, b, s + more) for n, b, s in reached if self.children[n])
        return self._state((0, (*moved, (0, piece, 0)))), more

    def _fill(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Make the transitions that lanes lack."""
        for state, symbol in set(zip(states.tolist(), symbols.tolist(), strict=True)):
            target, more = self.step(state, symbol)
            if not (page := self.pages[state, symbol // PAGE]):
                if self.used == len(self.next):
                    more_pages = len(self.next) // 2
                    self.next = np.vstack([self.next, np.full((more_pages, PAGE), -1, np.int32)])
                    self.delta = np.vstack([self.delta, np.zeros((more_pages, PAGE), np.int8)])
                page = self.pages[state, symbol // PAGE] = self.used
                self.used += 1
            self.next[page, symbol % PAGE] = target
            self.delta[page, symbol % PAGE] = more

    def run(self, symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray, states: np.ndarray):
        """(exit states, token changes) of the chunks ``symbols[begin:end]`` from given states."""
        exits, totals = states.astype(np.int64), np.zeros(len(begins), np.int64)
        order = np.argsort(begins - ends, kind="stable")
        for at in range(0, len(order), LANES):
            mine = order[at : at + LANES]
            lengths = (ends - begins)[mine]
            longest = int(lengths[0]) if len(lengths) else 0
            lanes = np.zeros((longest, len(mine)), np.uint16)
            for i, (begin, length) in enumerate(zip(begins[mine].tolist(), lengths.tolist(), strict=True)):
                lanes[:length, i] = symbols[begin : begin + length]
            active = np.searchsorted(-lengths, -np.arange(longest), "left")
            now, count = exits[mine], np.zeros(len(mine), np.int64)
            for t in range(longest):
                n = int(active[t])
                s, c = now[:n], lanes[t, :n].astype(np.int64)
                page = self.pages[s, c // PAGE]
                to = self.next[page, c % PAGE]
                if (missing := to < 0).any():
                    self._fill(s[missing], c[missing])
                    page = self.pages[s, c // PAGE]
                    to = self.next[page, c % PAGE]
                count[:n] += self.delta[page, c % PAGE]
                now[:n] = to
            exits[mine], totals[mine] = now, count
        return exits, totals

    def count(self, column) -> np.ndarray:
        """Tokens of each text of an Arrow string column; null and empty texts have none."""
        if self.used > MOST_PAGES:
            self.clear()
        data, offsets = text_bytes(column)
        counts = np.zeros(len(offsets) - 1, np.int64)
        # Some megabytes at a time bound the arrays; a longer text is a part of its own.
        part = np.flatnonzero(np.diff(offsets[:-1] // (4 << 20), prepend=-1)) if len(counts) else []
        for a, b in zip(part, [*part[1:], len(counts)], strict=True):
            counts[a:b] = self._count(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        return counts

    def _count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        symbols = self.class_of[points]
        letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        edges = letters[offsets]
        begins, known = self._chunks(symbols, edges)
        ends = np.append(begins[1:], len(symbols))
        owner = np.searchsorted(edges, begins, "right") - 1
        first = begins == edges[owner]
        states = np.where(first, self.start, self.hard)
        sure = np.flatnonzero(first | known)
        exits, totals = np.full(len(begins), -1), np.zeros(len(begins), np.int64)
        exits[sure], totals[sure] = self.run(symbols, begins[sure], ends[sure], states[sure])
        self._compose(symbols, begins, ends, exits, totals, np.flatnonzero(~(first | known)))
        # The white space put before every text that is not empty is a token.
        counts = (np.diff(edges) > 0).astype(np.int64)
        np.add.at(counts, owner, totals)
        return counts

    @staticmethod
    def _chunks(symbols: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins of the chunks, and whether a begin is white space after something else."""
        cuts = np.flatnonzero((symbols[1:] == 0) & (symbols[:-1] != 0)) + 1
        begins, known = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if a == b:
                continue
            begins.append(np.array([a]))
            known.append(np.array([False]))
            wished = np.arange(a + CHUNK, b, CHUNK)
            if not len(wished):
                continue
            near = np.searchsorted(cuts, wished)
            found = cuts[np.minimum(near, len(cuts) - 1)] if len(cuts) else np.full(len(wished), -1)
            fits = (near < len(cuts)) & (found < np.minimum(wished + CHUNK // 2, b))
            begins.append(np.where(fits, found, wished))
            known.append(fits)
        if not begins:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        return np.concatenate(begins), np.concatenate(known)

    def _compose(self, symbols, begins, ends, exits, totals, unknown: np.ndarray) -> None:
        """Exits and totals of the chunks that begin inside a word, from a prefix scan of state maps."""
        if not len(unknown):
            return
        maps = self._maps(symbols, begins, ends, exits, unknown)
        # A run of such chunks follows a chunk whose exit is known; its first row is the row ``first``.
        row = np.arange(len(unknown))
        first = np.maximum.accumulate(np.where(np.diff(unknown, prepend=-2) != 1, row, 0))
        columns = [{state: i for i, state in enumerate(one)} for one in maps]
        width = max(map(len, maps))
        state, to, more = (np.zeros((len(maps), width), np.int64) for _ in range(3))
        for r, one in enumerate(maps):
            state[r, : len(one)] = [target for target, _ in one.values()]
            more[r, : len(one)] = [n for _, n in one.values()]
            if r + 1 < len(maps) and first[r + 1] != r + 1:
                to[r, : len(one)] = [columns[r + 1][target] for target, _ in one.values()]
        entry = np.array([columns[f][int(exits[unknown[f] - 1])] for f in first.tolist()])
        to, more = prefix_scan(to, more, first)
        later = row > first
        column = np.where(later, to[row - 1, entry], entry)
        exits[unknown] = state[row, column]
        totals[unknown] = more[row, entry] - np.where(later, more[row - 1, entry], 0)

    def _maps(self, symbols, begins, ends, exits, unknown: np.ndarray) -> list[dict[int, tuple[int, int]]]:
        """(exit, token change) of each chunk for every state in which it may be entered.

        All chunks first run from the guessed state and from known exits side by side; whatever
        state a chunk then leaves in is an entry of the next one. Exits soon cease to depend on
        entries, so few states are added.
        """
        maps: dict[int, dict[int, tuple[int, int]]] = {int(i): {} for i in unknown}
        asked = {(i, self.hard) for i in maps} | {(i, int(exits[i - 1])) for i in maps if exits[i - 1] >= 0}
        while asked:
            pairs = np.array(sorted(asked), np.int64)
            after, more = self.run(symbols, begins[pairs[:, 0]], ends[pairs[:, 0]], pairs[:, 1])
            asked = set()
            for i, s, target, n in zip(*pairs.T.tolist(), after.tolist(), more.tolist(), strict=True):
                maps[i][s] = (target, n)
                if i + 1 in maps:
                    asked.add((i + 1, target))
            asked = {(i, s) for i, s in asked if s not in maps[i]}
        return list(maps.values())


def prefix_scan(to: np.ndarray, more: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maps of rows ``first[r]`` to ``r`` one after another, for all rows in logarithmically many rounds.

    Row ``r`` maps column ``c`` to column ``to[r, c]`` of the next row and adds ``more[r, c]``.
    """
    row, reach = np.arange(len(to)), 1
    while len(rows := row[row - reach >= first]):
        before = to[rows - reach]
        added = more[rows - reach] + np.take_along_axis(more[rows], before, 1)
        moved = np.take_along_axis(to[rows], before, 1)
        to, more = to.copy(), more.copy()
        to[rows], more[rows] = moved, added
        reach *= 2
    return to, more


#: The compiled transducer of a Python worker, kept from task to task.
_COMPILED: list[Transducer] = []


def token_counts(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every document, whole texts; null counts as empty.

    The model file is read on the driver only; its pieces are broadcast.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _COMPILED or _COMPILED[0].scores is not pieces.value.scores:
            _COMPILED[:] = [Transducer(pieces.value)]
        machine = _COMPILED[0]
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            counts = [pa.array(np.diff(offsets), pa.int64()), pa.array(machine.count(batch.column(1)), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts], names=["doc_id", "n_bytes", "n_tokens"])

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    key = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {key}, n_bytes bigint, n_tokens bigint")
