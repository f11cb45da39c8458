"""Best-fit packing of tokenised documents into sequences of a fixed length.

Hierarchical residual packing: each partition tokenises its documents, cuts those that are too long, packs the
pieces by best fit and emits its bins. Bins that are full or nearly so are final. The others go up a tree as
items of their own: few tasks with many underfull bins each pack them again by best fit, and so on until one task
holds the rest. The bins are dealt to tasks by chance and, every other round, beside bins that would fill them up;
where both ways together save less than a thousandth of the bins, tasks take twice as many, up to a bound of memory.
Only bins (id and fill) move; no text and no token id is shuffled.

Defined cases: a null or empty text is one piece that holds just the end id. Repeated rows, null ids and ties
are packed as rows of their own (ties by row order within a partition). An empty table gives no rows. Further
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Work, broadcast_if_small
from .text import Words, blocks, byte_characters, joined, ragged
from .text import held as kept

LIMIT = 4096
END_ID = 1
#: Bins with at most this many free places are final at once.
SLACK = 16
#: Underfull bins that one task packs again.
BINS_PER_TASK = 50_000
#: Where two rounds in a row, dealt in both ways, save less than this share of the underfull bins, tasks take twice as many
#: bins, up to so many times as many (2 million, some 300 MB).
LITTLE, WIDER = 0.001, 40
#: Pieces that a task packs at a time, so that a very large partition needs bounded memory.
PIECES_PER_RUN = 500_000


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: the bin and the offset of each item, and the fill of each bin.

    Open bins are kept by free places, and a bit set of the sizes in use finds the tightest one.
    """
    n = len(lengths)
    bins, offsets, fills = np.empty(n, np.int64), np.empty(n, np.int64), []
    by_free: dict[int, list[int]] = {}
    used = 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fitting = used >> size
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + size
            stack = by_free[free]
            b = stack.pop()
            if not stack:
                used ^= 1 << free
        else:
            free, b = limit, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, limit - free
        fills[b] += size
        if left := free - size:
            by_free.setdefault(left, []).append(b)
            used |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


#: Kinds of bytes: letters, digits (one a unit), other signs, and those that leave a word to the library.
LETTER, DIGIT, SIGN, ASK = 1, 2, 3, 4
_KIND = np.full(256, ASK, np.uint8)
_KIND[:128] = SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER
_KIND[48:58] = DIGIT
_KIND[[*range(32), 127, ord("'"), ord("|")]] = ASK  # control characters, contractions and special strings
_KIND[[0xC3, 0xC4, 0xC5]] = LETTER  # U+00C0 to U+017F
_ASKED = re.compile(rb"[\x00-\x1f\x7f'|\xc2\xc6-\xff]|\xc4\xb0")


def _units(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokenizer's words begin in the bytes of ``words``, and how many each text has.

    White-space words of plain Latin letters, digits and signs are cut where the kind changes, as the tokenizer's
    pattern cuts them; any other word stays whole.
    """
    data = words.data
    kind = _KIND[data]
    wide = np.flatnonzero(data == 0xC3)
    kind[wide[np.isin(data[wide + 1], (0x97, 0xB7))]] = SIGN
    wide = np.flatnonzero(data == 0xC4)
    kind[wide[data[wide + 1] == 0xB0]] = ASK
    rest = np.flatnonzero((data & 0xC0) == 0x80)
    kind[rest] = kind[rest - 1]
    begins = np.zeros(len(data), bool)
    if len(words):
        whole = np.repeat(np.maximum.reduceat(kind, words.at[:-1]) == ASK, words.size)
        begins[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & ~whole[1:] & ((data[1:] & 0xC0) != 0x80)
        begins[words.at[:-1]] = True
    start = np.flatnonzero(begins)
    return start, np.diff(np.searchsorted(start, words.at[words.edges]))


class WordIds:
    """Token ids of the tokenizer's words, remembered between blocks. White space parts these words, so a text's
    ids are those of its words one after another; the tests hold this against the library on whole texts."""

    #: A character that is one token by itself; words left to the library are encoded as one text with it between them.
    MARK = "\x01"
    #: Words and ids that are remembered at most; then the memory starts afresh.
    MOST_WORDS, MOST_IDS = 300_000, 2_000_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.shown = byte_characters()
        (self.mark,) = self._encode(self.MARK)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(1 << 20, np.uint32)
        self.start, self.size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.words = self.used = 0

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _add(self, words: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.words + len(sizes) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        rows = slice(self.words, self.words + len(sizes))
        self.size[rows], self.start[rows] = sizes, self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.known.update(zip(words, range(self.words, self.words + len(words))))
        self.words, self.used = self.words + len(sizes), self.used + len(flat)

    def _learn(self, words: list[bytes]) -> None:
        plain, asked, alone = [], [], []
        for w in words:
            (alone if self.MARK.encode() in w else asked if _ASKED.search(w) else plain).append(w)
        tokenize, shown = self.model.tokenize, self.shown
        lists = [[t.id for t in tokenize((w.lower().decode() if w.isascii() else w.decode().lower().encode().decode("latin-1").translate(shown)))] for w in plain]
        lists += [self._encode(w.decode()) for w in alone]
        self._add(plain + alone, np.fromiter((i for x in lists for i in x), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists)))
        for k in range(0, len(asked), 8192):
            some = asked[k : k + 8192]
            ids = np.array(self._encode(f" {self.MARK} ".join(w.decode() for w in some)), np.uint32)
            marks = np.flatnonzero(ids == self.mark)
            sizes = np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1
            self._add(some, np.delete(ids, marks), sizes)

    def of(self, words: pa.Array, end_id: int) -> tuple[np.ndarray, int]:
        """The place of each word in the memory, and that of the end id."""
        if self.words > self.MOST_WORDS or self.used > self.MOST_IDS:
            self.clear()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        end = b"\n" + str(end_id).encode()  # no word holds white space
        if end not in self.known:
            self._add([end], np.array([end_id], np.uint32), np.array([1]))
        places = list(map(self.known.get, distinct))
        if new := [w for w, p in zip(distinct, places) if p is None]:
            self._learn(new)
            places = list(map(self.known.__getitem__, distinct))
        return np.array(places, np.int64)[coded.indices.to_numpy()] if len(words) else np.empty(0, np.int64), self.known[end]


def _tokenised(batch: pa.RecordBatch, text: str, words_of: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, each followed by the end id, and their offsets."""
    words = Words(*joined(batch.column(text)))
    start, per = _units(words)
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, len(words.data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(words.data))])
    places, end = words_of.of(units, end_id)
    docs = len(per)
    slots = np.full(len(places) + docs, end, np.int64)
    slots[np.arange(len(places)) + np.repeat(np.arange(docs), per)] = places
    sizes = words_of.size[slots]
    ids = words_of.ids[ragged(words_of.start[slots], sizes)]
    ends = np.cumsum(sizes)[np.cumsum(per + 1) - 1]
    return ids, np.concatenate(([0], ends))


def cut_and_pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document with their place in a bin of their own partition.

    Columns: id_col, piece, start, length, ids_crc32, bin, offset, fill (of the bin).
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), *(T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("bin", T.LongType()), ("offset", T.LongType()), ("fill", T.LongType())))])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words_of = kept(("words", tokenizer), lambda: WordIds(tokenizer))
        base = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        count = 0

        def emit() -> pa.RecordBatch:
            nonlocal base
            ids = pa.concat_arrays([h[0] for h in held])
            piece, start, length, crc = (np.concatenate([h[k] for h in held]) for k in range(1, 5))
            bins, offsets, fills = best_fit(length, limit)
            out = pa.RecordBatch.from_arrays([ids, pa.array(piece, pa.int32()), *map(pa.array, (start, length, crc, bins + base, offsets, fills[bins]))], [id_col, "piece", "start", "length", "ids_crc32", "bin", "offset", "fill"])
            base += len(fills)
            held.clear()
            return out

        for batch in batches:
            for block in blocks(batch, text_col):
                ids, at = _tokenised(block, text_col, words_of, end_id)
                size = np.diff(at)
                pieces = -(-size // limit)
                row = np.repeat(np.arange(len(size)), pieces)
                piece = ragged(np.zeros(len(size), np.int64), pieces)
                start = piece * limit
                length = np.minimum(limit, size[row] - start)
                raw = memoryview(ids.astype("<u4").view(np.uint8))
                crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((at[row] + start).tolist(), (at[row] + start + length).tolist())), np.int64, len(row))
                held.append((block.column(id_col).take(pa.array(row)), piece, start, length, crc))
                count += len(row)
            if count >= PIECES_PER_RUN:
                yield emit()
                count = 0
        if held:
            yield emit()

    return docs.select(id_col, text_col).mapInArrow(pack, schema)


def pack_bins(bins: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One round: each partition packs its underfull bins (bin, fill) by best fit as items.

    Returns bin, into (the bin that takes it), shift (where it begins there) and fill (of the new bin).
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        names, fill = table["bin"].to_numpy(), table["fill"].to_numpy()
        order = np.argsort(names)
        names, fill = names[order], fill[order]
        bins, shift, fills = best_fit(fill, limit)
        into = np.empty(len(fills), np.int64)
        into[bins[shift == 0]] = names[shift == 0]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, (names, into[bins], shift, fills[bins]))), ["bin", "into", "shift", "fill"])

    return bins.select("bin", "fill").mapInArrow(pack, "bin long, into long, shift long, fill long")


def pack_sequences(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID, slack: int = SLACK, bins_per_task: int | None = None) -> DataFrame:
    """Pack all documents: id_col, piece, start, length, ids_crc32, sequence_id, offset."""
    work = Work(docs.sparkSession)
    pieces = work.stored(cut_and_pack(docs, tokenizer, id_col, text_col, limit, end_id), "pieces")
    level = work.stored(pieces.where(F.col("fill") < limit - slack).select("bin", "fill").distinct(), "underfull-0")
    moved: DataFrame | None = None
    left, step, saved, per_task = level.count(), 0, 1.0, bins_per_task or BINS_PER_TASK
    most = WIDER * per_task
    while left > 1:
        tasks = -(-left // per_task)
        step += 1
        # in turn by chance and with bins beside those that would fill them up
        dealt = level.repartition(tasks) if tasks == 1 or step % 2 else level.repartitionByRange(tasks, F.abs(F.col("fill") - limit // 2), "bin")
        round_ = work.stored(pack_bins(dealt, limit), f"moved-{step}")
        if moved is None:
            moved = round_.select("bin", "into", "shift")
        else:
            later = round_.select(F.col("bin").alias("_bin"), F.col("into").alias("_into"), F.col("shift").alias("_shift"))
            moved = moved.join(later, moved["into"] == later["_bin"], "left").select("bin", F.coalesce("_into", "into").alias("into"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift"))
            moved = work.stored(moved, f"all-moved-{step}")
        level = work.stored(round_.where(F.col("fill") < limit - slack).select(F.col("into").alias("bin"), "fill").distinct(), f"underfull-{step}")
        before, left = left, level.count()
        helped, saved = saved, 1 - left / before
        if tasks == 1 or (helped + saved < LITTLE and per_task >= most):
            break
        if helped + saved < LITTLE:
            per_task, saved = 2 * per_task, 1.0
    kept = [id_col, "piece", "start", "length", "ids_crc32"]
    if moved is None:
        return pieces.select(*kept, F.col("bin").alias("sequence_id"), "offset")
    moved = broadcast_if_small(work.stored(moved, "moved"))
    work.drop_but("pieces", "moved")
    return pieces.join(moved, "bin", "left").select(*kept, F.coalesce("into", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
