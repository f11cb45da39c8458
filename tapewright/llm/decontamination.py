"""Benchmark decontamination: windows of benchmark words looked up in all texts, hits verified, spans or documents removed.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is ten consecutive words of an item; an
item of fewer words, but not none, is one window. A word of a text is hit if it lies inside an occurrence of a window.

1. The distinct windows of all items are counted in bytes. Up to `MOST_GRAMS` they are sent to all workers as a table of
   sorted 64-bit hashes with their words. Each task hashes the windows of a block of texts by a rolling sum, looks
   them up through a bitmap, and compares the bytes of what is found. Nothing is shuffled.
2. Beyond that, workers get a bitmap of fixed size instead; windows that pass it become rows, which meet the table of
   windows in an equi-join on their words, and what is found is gathered by row. Both ways give equal results.

Defined cases: null texts and items have no words. Items that repeat an id are one item; an item whose id is null hits words but
is not listed. Repeated rows are scanned each on its own. An empty table gives no rows, no items no hits. Very long texts
are scanned whole. `clean` carries all columns, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Work, free_name
from .text import LOWER, SPACE, Words, blocks, held, joined, mix, ragged

WINDOW = 10
#: Bytes of windows that are sent to the workers.
MOST_GRAMS = 32_000_000
#: Bits of the bitmap that is sent instead, and of the parts it is made in.
BITMAP_BITS, PART_BITS = 28, 20
#: Bytes of text that a task looks at together.
BLOCK = 4_000_000

_PARTING = np.ones(256, bool)
_PARTING[48:58] = _PARTING[97:123] = _PARTING[128:] = False
_STEPS = np.multiply.accumulate(np.full(WINDOW + 1, 0xD6E8FEB86659FD93, np.uint64)) * np.uint64(2) + np.uint64(1)


def words_of(texts: pa.Array) -> Words:
    data, offsets = joined(texts)
    return Words(LOWER[data], offsets, _PARTING)


def window_hashes(words: Words, most: int = WINDOW) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first words, hashes) of all windows that lie in one text, for sizes up to ``most``."""
    h = words.hashes()
    left = words.edges[words.doc + 1] - np.arange(len(h)) if len(h) else np.empty(0, np.int64)
    total = np.zeros(len(h), np.uint64)
    for size in range(1, most + 1):
        if size > len(h):
            return
        total = total[: len(h) - size + 1] + h[size - 1 :] * _STEPS[size]
        first = np.flatnonzero(left[: len(total)] >= size)
        yield size, first, mix(total[first] + np.uint64(size))


def spaced(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words parted by one space each, and where each word begins; word i to j is [at[i], at[j + 1] - 1)."""
    out = np.full(len(words.data) + len(words), 32, np.uint8)
    out[np.arange(len(words.data)) + np.repeat(np.arange(len(words)), words.size)] = words.data
    return out, words.at + np.arange(len(words) + 1)


class Grams:
    """Windows of a benchmark: ``hash`` is sorted; entry k has ``size[k]`` words, data[at[k] : at[k + 1]], and the items
    item[items_at[k] : items_at[k + 1]], numbers of ``names``, which are in order as strings."""

    def __init__(self, grams: list[bytes], items: list[str | None], bits: int = 64):
        distinct = sorted(set(grams))
        number = {g: k for k, g in enumerate(distinct)}
        self.names = sorted({i for i in items if i is not None})
        place = {name: k for k, name in enumerate(self.names)}
        texts = pa.array(distinct, pa.large_binary())
        words = Words(*joined(texts), SPACE)
        self.mask = np.uint64((1 << bits) - 1)
        hashes = np.zeros(len(distinct), np.uint64)
        for size, first, h in window_hashes(words):
            whole = words.per[words.doc[first]] == size
            hashes[words.doc[first[whole]]] = h[whole] & self.mask
        order = np.argsort(hashes, kind="stable")
        self.hash, self.size = hashes[order], words.per[order]
        data, offsets = joined(texts.take(pa.array(order)))
        self.data, self.at = data.copy(), offsets.copy()
        self.sizes = np.unique(self.size)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pairs = sorted({(int(rank[number[g]]), place[i]) for g, i in zip(grams, items) if i is not None})
        self.item = np.array([i for _, i in pairs], np.int64)
        self.items_at = np.searchsorted(np.array([e for e, _ in pairs], np.int64), np.arange(len(order) + 1))
        # one place in 64 or fewer is taken
        self.shift = np.uint64(max(0, bits - max(10, int(np.ceil(np.log2(64 * max(1, len(order))))))))
        self.near = np.zeros(int(self.mask >> self.shift) + 1, bool)
        self.near[self.hash >> self.shift] = True

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first words, entries) of all windows that occur, each compared byte by byte."""
        firsts, entries = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        text, at = None, None
        for size, first, h in window_hashes(words, int(self.sizes[-1]) if len(self.sizes) else 0):
            if size not in self.sizes:
                continue
            h = h & self.mask
            maybe = self.near[h >> self.shift]
            first, h = first[maybe], h[maybe]
            entry = np.searchsorted(self.hash, h)
            while len(first):  # once, but for hashes that several windows share
                there = entry < len(self.hash)
                there[there] = self.hash[entry[there]] == h[there]
                first, h, entry = first[there], h[there], entry[there]
                if not len(first):
                    break
                if text is None:
                    text, at = spaced(words)
                same = self.size[entry] == size
                same[same] = self._equal(text, at[first[same]], at[first[same] + size] - 1, entry[same])
                firsts.append(first[same])
                entries.append(entry[same])
                first, h, entry = first[~same], h[~same], entry[~same] + 1
        return np.concatenate(firsts), np.concatenate(entries)

    def _equal(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, entry: np.ndarray, run: int = 50_000) -> np.ndarray:
        out = np.zeros(len(start), bool)
        for a in range(0, len(start), run):
            s, e, k = start[a : a + run], end[a : a + run], entry[a : a + run]
            n = e - s
            like = np.flatnonzero(n == self.at[k + 1] - self.at[k])
            differs = text[ragged(s[like], n[like])] != self.data[ragged(self.at[k[like]], n[like])]
            wrong = np.repeat(like, n[like])[differs]
            out[a + like] = True
            out[a + wrong] = False
        return out


def _runs(words: Words, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of hit words, none across texts: first words and ends."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + size, -1)
    hit = np.cumsum(change)[:-1] > 0
    begins, ends = hit.copy(), hit.copy()
    begins[1:] &= ~hit[:-1] | (words.doc[1:] != words.doc[:-1])
    ends[:-1] &= ~hit[1:] | (words.doc[1:] != words.doc[:-1])
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


_SPAN = "array<struct<first:int,words:int,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _lists(values: pa.Array, doc: np.ndarray, docs: int) -> pa.Array:
    """Values in order of their text as one list a text."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(docs + 1)), pa.int32()), values)


def _spans(words: Words, offsets: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    """Runs of hit words of each text: first word, words, and first and end byte in the text."""
    a, b = _runs(words, first, size)
    doc = words.doc[a]
    fields = (a - words.edges[doc], b - a, words.start[a] - offsets[doc], words.start[b - 1] + words.size[b - 1] - offsets[doc])
    return _lists(pa.StructArray.from_arrays([pa.array(f, pa.int32()) for f in fields], fields=list(_SPANS.value_type)), doc, len(words.per))


def item_windows(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """gram (words parted by a space), item (as text): distinct windows of the items."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", BLOCK):
                words = words_of(block.column("text"))
                if not len(words):
                    continue
                text, at = spaced(words)
                size = np.minimum(words.per[words.doc], WINDOW)
                first = np.flatnonzero(words.edges[words.doc + 1] - np.arange(len(words)) >= size)
                spans = zip(at[first].tolist(), (at[first + size[first]] - 1).tolist())
                data = text.tobytes()
                grams = pa.array([data[a:b] for a, b in spans], pa.binary())
                yield pa.RecordBatch.from_arrays([grams, block.column("item").take(pa.array(words.doc[first]))], ["gram", "item"])

    chosen = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(cut, "gram binary, item string").distinct()


def _scanned(docs: DataFrame, text_col: str, grams: Grams, names: tuple[str, str, str]) -> DataFrame:
    """Rows with n_words, spans and items, by the table of windows that every worker gets."""
    sent = docs.sparkSession.sparkContext.broadcast(grams)
    schema = T.StructType([*docs.schema, T.StructField(names[0], T.LongType()), T.StructField(names[1], T._parse_datatype_string(_SPAN)), T.StructField(names[2], T.ArrayType(T.StringType()))])
    text_at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            for block in blocks(batch, batch.schema.names[text_at], BLOCK):
                words = words_of(block.column(text_at))
                first, entry = table.occurrences(words)
                spans = _spans(words, joined(block.column(text_at))[1], first, table.size[entry])
                pairs = np.unique(np.stack([words.doc[first], entry]), axis=1)
                held_items = table.items_at[pairs[1] + 1] - table.items_at[pairs[1]]
                found = np.unique(np.stack([np.repeat(pairs[0], held_items), table.item[ragged(table.items_at[pairs[1]], held_items)]]), axis=1)
                listed = _lists(pa.array([table.names[i] for i in found[1].tolist()], pa.string()), found[0], block.num_rows)
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(words.per, pa.int64()), spans, listed], schema.names)

    return docs.mapInArrow(run, schema)


def _bitmap(grams: DataFrame, bits: int) -> list[tuple[int, bytes]]:
    """The bitmap of the hashes of all windows, in parts of fixed size: 2^bits bits in all, whatever the benchmark."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = Grams(batch.column("gram").to_pylist(), [])
            place = np.unique(table.hash >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place >> PART_BITS).astype(np.int32)), pa.array(place & ((1 << PART_BITS) - 1))], ["part", "place"])

    def build(table: pa.Table) -> pa.Table:
        taken = np.zeros(1 << PART_BITS, bool)
        taken[table["place"].to_numpy()] = True
        return pa.table({"part": table["part"].slice(0, 1), "taken": pa.array([np.packbits(taken).tobytes()], pa.binary())})

    places = grams.select("gram").mapInArrow(hashed, "part int, place long").distinct()
    return [(r["part"], bytes(r["taken"])) for r in places.groupBy("part").applyInArrow(build, "part int, taken binary").toLocalIterator()]


def _joined(docs: DataFrame, text_col: str, grams: DataFrame, names: tuple[str, str, str], work: Work, bits: int) -> DataFrame:
    """The same where the windows are too many to send: candidates that pass a bitmap are joined with the windows."""
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(grams, bits))
    row = free_name(docs, "row")
    maybe = free_name(docs, "maybe")
    schema = T.StructType([*docs.schema, T.StructField(names[0], T.LongType()), T.StructField(row, T.LongType()), T.StructField(maybe, T._parse_datatype_string("array<struct<first:int,words:int,start:int,end:int,gram:binary>>"))])
    text_at = docs.columns.index(text_col)
    kind = pa.struct([*_SPANS.value_type, pa.field("gram", pa.binary())])

    name = uuid.uuid4().hex  # of this bitmap, in workers that keep one

    def whole_bitmap() -> np.ndarray:
        whole = np.zeros(1 << (bits - 3), np.uint8)
        for part, taken in sent.value:
            whole[part << (PART_BITS - 3) : (part + 1) << (PART_BITS - 3)] = np.frombuffer(taken, np.uint8)
        return whole

    def is_taken(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
        place = (h >> np.uint64(64 - bits)).astype(np.int64)
        return (bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        bitmap = held(("decontamination", name), whole_bitmap)
        for batch in batches:
            for block in blocks(batch, batch.schema.names[text_at], BLOCK):
                words = words_of(block.column(text_at))
                offsets = joined(block.column(text_at))[1]
                text, at = spaced(words)
                data = text.tobytes()
                firsts, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for size, first, h in window_hashes(words):
                    first = first[is_taken(bitmap, h)]
                    firsts.append(first)
                    sizes.append(np.full(len(first), size))
                first, size = np.concatenate(firsts), np.concatenate(sizes)
                order = np.argsort(first, kind="stable")
                first, size = first[order], size[order]
                doc = words.doc[first]
                last = first + size - 1
                fields = [pa.array(f, pa.int32()) for f in (first - words.edges[doc], size, words.start[first] - offsets[doc], words.start[last] + words.size[last] - offsets[doc])]
                texts = pa.array([data[a:b] for a, b in zip(at[first].tolist(), (at[first + size] - 1).tolist())], pa.binary())
                found = _lists(pa.StructArray.from_arrays([*fields, texts], fields=list(kind)), doc, block.num_rows)
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(words.per, pa.int64()), pa.array(np.arange(number, number + block.num_rows)), found], schema.names)
                number += block.num_rows

    rows = work.stored(docs.mapInArrow(run, schema), "rows")
    asked = rows.select(row, F.explode(maybe).alias("_m")).select(F.col(row).alias("row"), "_m.*")
    hits = work.stored(asked.join(grams.select("gram").distinct(), "gram", "left_semi"), "hits")
    by_row = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "words", "start", "end"))).alias("hits"))
    # hits in order of their first word: one that begins in the run so far, or at its end, makes it longer
    last = lambda runs: F.element_at(runs, -1)
    goes_on = lambda runs, x: (F.size(runs) > 0) & (last(runs)["first"] + last(runs)["words"] >= x["first"])
    step = lambda runs, x: F.when(goes_on(runs, x), F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(_longer(last(runs), x)))).otherwise(F.concat(runs, F.array(x)))
    by_row = by_row.select(F.col("row").alias(row), F.aggregate("hits", F.array().cast(_SPAN), step).alias(names[1]))
    listed = hits.select("row", "gram").distinct().join(grams.where("item is not null"), "gram").groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_set("item")).alias(names[2]))
    met = rows.drop(maybe).join(by_row, row, "left").join(listed, row, "left")
    empty = lambda name, kind: F.coalesce(F.col(name), F.array().cast(kind)).alias(name)
    return met.select(*(F.col(f"`{c}`") for c in docs.columns), names[0], empty(names[1], _SPAN), empty(names[2], "array<string>"))


def _longer(run, x):
    """A run of words with an occurrence that begins in it or at its end."""
    end = F.greatest(run["first"] + run["words"], x["first"] + x["words"])
    return F.struct(run["first"].alias("first"), (end - run["first"]).alias("words"), run["start"].alias("start"), F.greatest(run["end"], x["end"]).alias("end"))


def _found(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text: str, names: tuple[str, str, str], most: int, bits: int) -> DataFrame:
    work = Work(docs.sparkSession)
    grams = work.stored(item_windows(items, item_col, item_text), "grams")
    size = grams.agg(F.sum(F.octet_length("gram") + F.coalesce(F.octet_length("item"), F.lit(0)) + 24)).first()[0] or 0
    if size > most:
        return _joined(docs, text_col, grams, names, work, bits)
    table = grams.toArrow()
    work.drop("grams")
    return _scanned(docs, text_col, Grams([bytes(g) for g in table["gram"].to_pylist()], table["item"].to_pylist()), names)


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = MOST_GRAMS, bits: int = BITMAP_BITS) -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, spans (runs of hit words: first word, words, start and end byte), items
    (ids, as text and in order, of the items with windows that occur)."""
    out = _found(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), items, "_text", item_col, item_text, ("n_words", "spans", "items"), most, bits)
    return out.select(F.col("_id").alias(id_col), "n_words", "spans", "items")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What `find` gives, as numbers: id_col, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    out = found.select(id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, items: DataFrame, remove: str = "documents", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = MOST_GRAMS, bits: int = BITMAP_BITS) -> DataFrame:
    """``docs`` without the documents that have a hit, or with the spans of hit words cut out of their texts."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans: {remove}")
    names = tuple(free_name(docs, n) for n in ("n_words", "spans", "items"))
    found = _found(docs, items, text_col, item_col, item_text, names, most, bits)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    if remove == "documents":
        return found.where(F.size(names[1]) == 0).select(*kept)
    raw = F.col(f"`{text_col}`").cast("binary")
    # what stands between the spans
    starts = F.concat(F.array(F.lit(0)), F.transform(names[1], lambda x: x["end"]))
    ends = F.concat(F.transform(names[1], lambda x: x["start"]), F.array(F.octet_length(raw)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.substring(raw, x["a"] + 1, x["b"] - x["a"]).cast("string"))
    text = F.when(F.size(names[1]) == 0, F.col(f"`{text_col}`")).otherwise(F.array_join(parts, ""))
    return found.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
