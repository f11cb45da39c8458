"""Words of a block of texts as numpy arrays: used inside tasks, where Spark has dealt out the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that part words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z; all other bytes stay, so that UTF-8 stays valid.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240115))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.multiply.accumulate(np.full(64, _STEP, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and the offsets of each (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch | pa.Table, text: str, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes of text each; a longer text is a run of its own."""
    sizes = np.zeros(batch.num_rows, np.int64)
    if batch.num_rows:
        _, offsets = joined(batch.column(text))
        sizes = np.diff(offsets)
    run = (np.cumsum(sizes) - sizes) // size
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()


class Words:
    """Words of a block: ``data`` holds their bytes without white space, word i is data[at[i]:at[i+1]];
    ``per`` counts the words of each text and ``doc`` names the text of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, parting: np.ndarray = SPACE):
        solid = ~parting[data]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        full = np.flatnonzero(np.diff(offsets))
        first[offsets[full]] = solid[offsets[full]]
        last[offsets[full + 1] - 1] = solid[offsets[full + 1] - 1]
        start = np.flatnonzero(first)
        self.size = np.flatnonzero(last) + 1 - start
        self.start = start
        self.data = data[solid]
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        edges = np.searchsorted(start, offsets)
        self.per = np.diff(edges)
        self.edges = edges
        self.doc = np.repeat(np.arange(len(self.per)), self.per)

    def __len__(self) -> int:
        return len(self.size)

    def array(self) -> pa.Array:
        """The words as an Arrow array over the same bytes."""
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(self.at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data))])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, alike in every task and run."""
        global _powers
        if not len(self):
            return np.empty(0, np.uint64)
        if (most := int(self.size.max())) > len(_powers):
            _powers = np.multiply.accumulate(np.full(2 * most, _STEP, np.uint64))
        out = np.empty(len(self), np.uint64)
        # in runs of words of about a million bytes, which keeps the arrays by byte small
        edges = np.unique(np.concatenate((np.searchsorted(self.at[:-1], np.arange(0, len(self.data), 1 << 20)), [len(self)])))
        for a, b in zip(edges, edges[1:]):
            low, high, start = self.at[a], self.at[b], self.at[a:b] - self.at[a]
            place = np.arange(high - low) - np.repeat(start, self.size[a:b])
            out[a:b] = np.add.reduceat(_BYTE[self.data[low:high]] * _powers[place], start)
        return mix(out + self.size.astype(np.uint64))


_held: tuple[object, object] = (None, None)


def held(key: object, make):
    """What ``make`` gives, kept in this worker until another key is asked for: one table or model at a time."""
    global _held
    if _held[0] != key:
        _held = (None, None)
        _held = (key, make())
    return _held[1]


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1 ... (size[0] of them), start[1], ... as one index."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def byte_characters() -> dict[int, str]:
    """The visible characters that byte-level vocabularies write for bytes: printable Latin-1 stands for itself,
    the others follow from U+0100 in order."""
    plain = {b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}
