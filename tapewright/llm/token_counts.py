"""Exact token counts by finite-state tokenizer compilation (byte-level BPE).

The tokenizer's rules are compiled into two deterministic transducers.

* `Splitter` reads classes of code points and marks where the tokenizer's pre-tokens begin. It has twelve states
  and looks back one place where the tokenizer's pattern looks ahead. A block of texts is cut into chunks that
  run side by side; the map from each possible entry state to the exit state of a chunk is composed over all
  chunks by a parallel prefix scan, which gives every chunk its entry state. Maps whose states have met (usual
  after a few places) go on as one lane.
* `MergeCounter` reads the bytes of a pre-token. A state holds, for each suffix that may still grow into a token,
  the last token before that suffix and the tokens counted there; a transition is annotated with the tokens that
  it adds to the count (it may take tokens back, when a merge swallows them; the sum is exact after every byte).
  States and transitions are compiled as texts first need them and kept in a hash table of the worker. Distinct
  pre-tokens of a block run side by side. A long pre-token is cut into chunks that run side by side too: the map of
  a chunk takes the entry states that neighbours can reach to exit states and counts, and the maps are composed by
  the prefix scan. Runs of a chunk from another state end where they meet the first one, as all that follows is equal.

The counts are those of the tokenizers library without added special tokens; a special string inside a text is
one token, as the library treats it by default.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids are counted as rows of
their own. Empty tables give no rows. Texts of any length are counted whole. Further columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import blocks, byte_characters, held, joined

# Classes of code points: letters by their part in a contraction, digits, white space, apostrophe, other, end of text.
LETTER, ONE, TWO, DOUBLE, SECOND, DIGIT, BLANK, SPACE, QUOTE, OTHER, END = range(11)
START, IN_LETTERS, IN_DIGITS, IN_OTHER, ONE_BLANK, ONE_SPACE, BLANKS, SPACES, QUOTED, QUOTED_TWO, QUOTED_DOUBLE, CLOSED = range(12)
STATES = 12
#: The white space of Unicode.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
END_POINT = 0x110000
#: Places of a chunk, and after how many of them chunks whose states have met go on as one lane.
CHUNK, MEET = 512, 24
#: Chunks of long pre-tokens that are composed at a time, and rounds in which their maps may grow by one state each.
STRETCH, ROUNDS = 2048, 64


def _code_point_classes() -> np.ndarray:
    kind = np.full(END_POINT + 1, OTHER, np.uint8)
    first = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(END_POINT)], np.uint8)
    kind[:-1][first == ord("L")] = LETTER
    kind[:-1][first == ord("N")] = DIGIT
    kind[WHITE] = SPACE
    kind[0x20] = BLANK
    kind[ord("'")] = QUOTE
    for letters, c in (("stmd", ONE), ("rv", TWO), ("l", DOUBLE), ("e", SECOND)):
        kind[[ord(x) for x in letters]] = c
    kind[END_POINT] = END
    return kind


def _step(state: int, c: int) -> tuple[int, int]:
    """Next state and marks: 1, a pre-token begins here; 2, one began a place before."""
    letter, white = c <= SECOND, c in (BLANK, SPACE)
    fresh = {DIGIT: IN_DIGITS, BLANK: ONE_BLANK, SPACE: ONE_SPACE, QUOTE: QUOTED, OTHER: IN_OTHER, END: START}.get(c, IN_LETTERS)
    within = IN_OTHER if c == QUOTE else fresh  # an apostrophe after a blank opens no contraction
    if c == END or state in (START, CLOSED):
        late = 2 if state in (QUOTED_TWO, QUOTED_DOUBLE) else 0
        return fresh, 1 | late
    if state == IN_LETTERS:
        return (IN_LETTERS, 0) if letter else (fresh, 1)
    if state == IN_DIGITS:
        return (IN_DIGITS, 0) if c == DIGIT else (fresh, 1)
    if state == IN_OTHER:
        return (IN_OTHER, 0) if c in (OTHER, QUOTE) else (fresh, 1)
    if state in (ONE_BLANK, ONE_SPACE, BLANKS, SPACES):
        if white:
            return (BLANKS if c == BLANK else SPACES), 0
        late = 2 if state in (BLANKS, SPACES) else 0
        return (within, late) if state in (ONE_BLANK, BLANKS) else (fresh, 1 | late)
    if state == QUOTED:
        if c in (ONE, TWO, DOUBLE):
            return {ONE: CLOSED, TWO: QUOTED_TWO, DOUBLE: QUOTED_DOUBLE}[c], 0
        return (IN_OTHER, 0) if c in (OTHER, QUOTE) else (fresh, 1)
    if (state, c) in ((QUOTED_TWO, SECOND), (QUOTED_DOUBLE, DOUBLE)):
        return CLOSED, 0
    after, marks = _step(IN_LETTERS, c)
    return after, marks | 2


class Splitter:
    """The first transducer; see the module's text."""

    def __init__(self) -> None:
        self.kind = _code_point_classes()
        table = np.zeros((16, 16), np.uint8)  # state, class: next state in the high bits, marks in the low ones
        for s in range(STATES):
            for c in range(11):
                after, marks = _step(s, c)
                table[s, c] = after << 4 | marks
        self.table = table.ravel()

    def starts(self, points: np.ndarray) -> np.ndarray:
        """Whether a pre-token begins at each code point; END_POINT closes each text."""
        n = len(points)
        lanes = -(-n // CHUNK)
        kinds = np.full(lanes * CHUNK, END, np.uint8)
        kinds[:n] = self.kind[points]
        rows = np.ascontiguousarray(kinds.reshape(lanes, CHUNK).T)
        marks = np.empty((CHUNK, lanes), np.uint8)

        maps = np.tile(np.arange(STATES, dtype=np.uint8) << 4, (lanes, 1))
        for k in range(MEET):
            maps = self.table[maps | rows[k][:, None]] & 0xF0
        met = (maps == maps[:, :1]).all(axis=1)
        apart = np.flatnonzero(~met)
        state = maps[:, 0].copy()
        for k in range(MEET, CHUNK):
            marks[k] = self.table[state | rows[k]]
            state = marks[k] & 0xF0
        maps[met] = state[met][:, None]
        for k in range(MEET, CHUNK) if len(apart) else ():
            maps[apart] = self.table[maps[apart] | rows[k][apart][:, None]] & 0xF0

        upto = maps >> 4  # inclusive scan: state after chunks 0..k, for each state before chunk 0
        reach = 1
        while reach < lanes:
            upto[reach:] = np.take_along_axis(upto[reach:], upto[:-reach], axis=1)
            reach *= 2
        entry = np.concatenate(([START], upto[:-1, START])).astype(np.uint8) << 4

        state = entry
        for k in range(MEET):
            marks[k] = self.table[state | rows[k]]
            state = marks[k] & 0xF0
        state = state[apart]
        for k in range(MEET, CHUNK) if len(apart) else ():
            marks[k, apart] = self.table[state | rows[k][apart]]
            state = marks[k, apart] & 0xF0
        flat = marks.T.ravel()[:n]
        begins = (flat & 1).astype(bool)
        begins[:-1] |= (flat[1:] & 2).astype(bool)
        return begins


#: Rank of what is no merge.
NEVER = 1 << 60


class MergeCounter:
    """The second transducer, compiled on demand; see the module's text."""

    #: States kept at most; beyond that only those in use stay.
    MOST_STATES = 400_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        shown = {c: b for b, c in byte_characters().items()}
        as_bytes = lambda s: bytes(shown[c] for c in s)
        self.rank = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[as_bytes(a), as_bytes(b)] = r
        tokens = [bytes([b]) for b in range(256)] + [a + b for a, b in self.rank]
        self.child: dict[int, int] = {}
        self.token: list[bytes | None] = [None]
        for t in tokens:
            node = 0
            for b in t:
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(None)
                node = self.child[key]
            self.token[node] = t
        self.inner = {k >> 8 for k in self.child}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        made = {bytes([b]): -1 for b in range(256)}
        for (a, b), r in self.rank.items():
            made.setdefault(a + b, r)
        #: Whether no merge comes before those that make its parts, so that merging goes up in rank.
        self.upward = all(made.get(a, r) < r and made.get(b, r) < r for (a, b), r in self.rank.items())
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, int]] | None] = {}
        self.reset([])

    def merged(self, text: bytes) -> list[bytes]:
        """Merges by rank, as the tokenizer defines them: used to compile pairs of tokens."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(self.rank.get(p, NEVER) for p in zip(parts, parts[1:]))
            if best == NEVER:
                break
            parts = self._pass(parts, best)
        return parts

    def _pass(self, parts: list[bytes], rank: int) -> list[bytes]:
        """All merges of one rank, from the left."""
        i, out = 0, []
        while i < len(parts):
            if i + 1 < len(parts) and self.rank.get((parts[i], parts[i + 1])) == rank:
                out.append(parts[i] + parts[i + 1])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        return out

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]] | None:
        """The parts that stand at an end of a token (side 0: first, -1: last) while it is merged, each with the rank of the merge that
        takes it up; None if merging does not give the token."""
        if (token, side) not in self.edges:
            parts, found = [token[i : i + 1] for i in range(len(token))], []
            while len(parts) > 1:
                best = min(self.rank.get(p, NEVER) for p in zip(parts, parts[1:]))
                if best == NEVER:
                    break
                after = self._pass(parts, best)
                if after[side] != parts[side]:
                    found.append((parts[side], best))
                parts = after
            self.edges[token, side] = [*found, (token, NEVER)] if len(parts) == 1 else None
        return self.edges[token, side]

    def _apart(self, a: bytes, b: bytes) -> bool:
        """Whether no merge crosses the border of a + b. At each time the border has one part on either side; these merge if
        their rank comes before the merges that take them up, and at equal rank the left one of two merges comes first."""
        left, right = self._edge(a, -1), self._edge(b, 0)
        if left is None or right is None:
            return False
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            r = self.rank.get((x, y), NEVER)
            if r < x_until and r <= y_until and r < NEVER:
                return False
            if x_until == y_until == NEVER:
                return True
            i, j = i + (x_until <= y_until), j + (y_until <= x_until)

    def _fits(self, a: bytes | None, b: bytes) -> bool:
        """Whether token b can follow token a, that is, merging a + b gives a and b again."""
        if a is None:
            return self.merged(b) == [b] if len(b) > 1 else True
        if (a, b) not in self.fits:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            self.fits[a, b] = self._apart(a, b) if self.upward else self.merged(a + b) == [a, b]
        return self.fits[a, b]

    def reset(self, keep: list[tuple]) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.bits, self.filled = 16, 0
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        for s in [((0, None, 0),), *keep]:
            self._state(s)

    def _state(self, s: tuple) -> int:
        if s not in self.number:
            self.number[s] = len(self.states)
            self.states.append(s)
        return self.number[s]

    def _compile(self, key: int) -> int:
        """The transition of (state, byte): next state and tokens added."""
        byte = key & 255
        grown = [(self.child[v << 8 | byte], t, c) for v, t, c in self.states[key >> 8] if v << 8 | byte in self.child]
        last, added = next((self.token[v], c + 1) for v, t, c in grown if self.token[v] is not None and self._fits(t, self.token[v]))
        after = tuple((v, t, c - added) for v, t, c in grown if v in self.inner) + ((0, last, 0),)
        return self._state(after) << 16 | (added + 32768)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        if (self.filled + len(keys)) * 2 > len(self.keys):
            old = self.keys >= 0
            k, v = self.keys[old], self.values[old]
            while (self.filled + len(keys)) * 2 > 1 << self.bits:
                self.bits += 1
            self.keys, self.values, self.filled = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64), 0
            self._put(k, v)
        self.filled += len(keys)
        slot, mask = self._slot(keys), (1 << self.bits) - 1
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several on one free slot, the last one gets it
            got = self.keys[slot] == keys
            self.values[slot[got]] = values[got]
            keys, values, slot = keys[~got], values[~got], (slot[~got] + 1) & mask

    def _get(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys, -1 where a key is not compiled yet."""
        out, at = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        slot, mask = self._slot(keys), (1 << self.bits) - 1
        while len(at):
            found = self.keys[slot]
            hit = found == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            at, slot = at[on], (slot[on] + 1) & mask
        return out

    def _follow(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and added tokens of (state, byte), which are compiled where they are new."""
        got = self._get(keys)
        missing = got < 0
        if missing.any():
            new = np.unique(keys[missing])
            self._put(new, np.fromiter(map(self._compile, new.tolist()), np.int64, len(new)))
            got[missing] = self._get(keys[missing])
        return got >> 16, (got & 65535) - 32768

    def _renumber(self, *arrays: np.ndarray) -> None:
        """Drop all states but those in the arrays, which get the new numbers."""
        used, back = np.unique(np.concatenate(arrays), return_inverse=True)
        kept = [self.states[s] for s in used.tolist()]
        self.reset(kept)
        new = np.array([self.number[s] for s in kept], np.int64)[back]
        for a, part in zip(arrays, np.split(new, np.cumsum([len(a) for a in arrays])[:-1])):
            a[:] = part

    def counts(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of the pre-tokens data[start:start+size], all side by side."""
        out = np.empty(len(size), np.int64)
        many = size > 2 * CHUNK
        out[many] = self._long(data, start[many], size[many])
        out[~many] = self._short(data, start[~many], size[~many])
        return out

    def _short(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        state, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        live = len(order)
        for k in range(int(size[0]) if live else 0):
            live = int(np.searchsorted(-size, -k, side="left"))
            state[:live], added = self._follow(state[:live] << 8 | data[start[:live] + k])
            count[:live] += added
            if len(self.states) > self.MOST_STATES:
                self._renumber(state[:live])
        out = np.empty(len(order), np.int64)
        out[order] = count
        return out

    def _long(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of pre-tokens that are cut into chunks; the exit of one stretch of chunks is the entry of the next."""
        pieces = -(-size // CHUNK)
        of = np.repeat(np.arange(len(size)), pieces)
        rank = np.arange(len(of)) - (np.cumsum(pieces) - pieces)[of]
        at, length = start[of] + rank * CHUNK, np.minimum(CHUNK, size[of] - rank * CHUNK)
        each, entry = np.zeros(len(of), np.int64), 0
        for k in range(0, len(of), STRETCH):
            part = slice(k, k + STRETCH)
            entry, each[part] = self._stretch(data, at[part], length[part], rank[part] == 0, entry)
        return np.bincount(of, each, len(size)).astype(np.int64)

    def _stretch(self, data: np.ndarray, at: np.ndarray, length: np.ndarray, opens: np.ndarray, entry: int) -> tuple[int, np.ndarray]:
        """Exit state and tokens of each chunk, of which those in ``opens`` begin a pre-token."""
        n = len(at)
        closes = np.append(opens[1:], True)
        chunk, enter = np.arange(n), np.zeros(n, np.int64)  # rows of the maps; each chunk is run from the empty state first
        if not opens[0]:
            enter[0] = entry
        path, sums = np.full((CHUNK, n), -1, np.int32), np.zeros((CHUNK, n), np.int32)
        leave, count = enter.copy(), np.zeros(n, np.int64)

        def walk(rows: np.ndarray, first: bool) -> None:
            """Run rows through their chunks; all but the first ones end where they meet the first one of their chunk."""
            live, k = rows, 0
            while len(live := live[length[chunk[live]] > k]):
                c = chunk[live]
                leave[live], added = self._follow(leave[live] << 8 | data[at[c] + k])
                count[live] += added
                if first:
                    path[k, c], sums[k, c] = leave[live], count[live]
                else:
                    met = path[k, c] == leave[live]
                    count[live[met]] += count[c[met]] - sums[k, c[met]]
                    leave[live[met]] = leave[c[met]]
                    live = live[~met]
                if len(self.states) > self.MOST_STATES:
                    self._renumber(enter, leave)
                    path[:] = -1  # places passed before are met no more; such rows run to the chunk's end
                k += 1

        walk(chunk, True)
        fresh = chunk
        for _ in range(ROUNDS):
            on = fresh[~closes[chunk[fresh]]]
            asked = np.setdiff1d(chunk[on] + 1 << 32 | leave[on], chunk << 32 | enter)
            if not len(asked):
                return self._composed(n, closes, chunk, enter, leave, count)
            fresh = np.arange(len(chunk), len(chunk) + len(asked))
            chunk, enter = np.concatenate((chunk, asked >> 32)), np.concatenate((enter, asked & 0xFFFFFFFF))
            leave, count = np.concatenate((leave, asked & 0xFFFFFFFF)), np.concatenate((count, np.zeros(len(asked), np.int64)))
            walk(fresh, False)
        # states that never meet: each chunk from where the one before ended
        here, each = np.array([enter[0]]), np.zeros(n, np.int64)
        for c in range(n):
            for k in range(length[c]):
                here, added = self._follow(here << 8 | int(data[at[c] + k]))
                each[c] += added[0]
                if len(self.states) > self.MOST_STATES:
                    self._renumber(here)
            leaving = int(here[0])
            if closes[c]:
                here[:] = 0
        return leaving, each

    @staticmethod
    def _composed(n: int, closes: np.ndarray, chunk: np.ndarray, enter: np.ndarray, leave: np.ndarray, count: np.ndarray) -> tuple[int, np.ndarray]:
        """Compose the maps of chunks by an inclusive prefix scan over places of states; the first row of a chunk is place 0."""
        order = np.argsort(chunk, kind="stable")
        place = np.empty(len(chunk), np.int64)
        place[order] = np.arange(len(chunk)) - np.searchsorted(chunk[order], chunk[order])
        known = chunk << 32 | enter
        by_key = np.argsort(known)
        goes = np.zeros(len(chunk), np.int64)  # a chunk that ends a pre-token leads to the first row of the next
        on = np.flatnonzero(~closes[chunk] & (chunk < n - 1))
        goes[on] = place[by_key[np.searchsorted(known, chunk[on] + 1 << 32 | leave[on], sorter=by_key)]]
        width = int(place.max()) + 1
        upto, row = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64)
        upto[chunk, place], row[chunk, place] = goes, np.arange(len(chunk))
        reach = 1
        while reach < n:
            upto[reach:] = np.take_along_axis(upto[reach:], upto[:-reach], axis=1)
            reach *= 2
        real = row[np.arange(n), np.append(0, upto[:-1, 0])]
        return int(leave[real[-1]]), count[real]


class TokenCounter:
    def __init__(self, path: str):
        self.splitter, self.merges = Splitter(), MergeCounter(path)
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"].encode() for t in json.load(f)["added_tokens"]]
        self.plain_size = {s: int(self._segments(np.frombuffer(s, np.uint8), np.array([0, len(s)]))[0]) for s in self.special}

    def _segments(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Tokens of the texts data[cuts[i]:cuts[i+1]]."""
        if not len(data):
            return np.zeros(len(cuts) - 1, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = (data & 0xC0) != 0x80
        upto = np.concatenate(([0], np.cumsum(lead)))
        points = np.insert(points, upto[cuts[1:]], END_POINT)
        begins = self.splitter.starts(points)
        wide = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        wide[points == END_POINT] = 0
        at = (np.cumsum(wide) - wide)[begins]
        at = at[np.concatenate((at[1:] != at[:-1], [True]))]
        at = at[at < len(data)]
        edges = np.append(at, len(data))
        tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        words = tokens.dictionary
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        each = self.merges.counts(np.frombuffer(words.buffers()[2], np.uint8), offsets[:-1], np.diff(offsets))
        total = np.concatenate(([0], np.cumsum(each[tokens.indices.to_numpy()])))
        return np.diff(total[np.searchsorted(at, cuts)])

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text; a special string is a text of its own and counts as one token."""
        raw, inner, fix = data.tobytes(), [], []
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                doc = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(s) <= offsets[doc + 1]:
                    inner += [at, at + len(s)]
                    fix.append((doc, 1 - self.plain_size[s]))
                    at = raw.find(s, at + len(s))
                else:
                    at = raw.find(s, at + 1)
        if not inner:
            return self._segments(data, offsets)
        cuts = np.sort(np.concatenate((offsets, inner)))
        per = self._segments(data, cuts)
        total = np.concatenate(([0], np.cumsum(per)))
        out = np.diff(total[np.searchsorted(cuts, offsets)])
        for doc, more in fix:
            out[doc] += more
        return out


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per document: id_col, n_bytes, n_tokens, over_limit."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = held(("tokens", tokenizer), lambda: TokenCounter(tokenizer))
        for batch in batches:
            for block in blocks(batch, text_col, 3_000_000):
                data, offsets = joined(block.column(text_col))
                yield pa.RecordBatch.from_arrays([block.column(id_col), pa.array(np.diff(offsets)), pa.array(counter.counts(data, offsets))], [id_col, "n_bytes", "n_tokens"])

    return docs.select(id_col, text_col).mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
