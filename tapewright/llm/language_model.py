"""Language-model scores from a log-frequency Bloom filter.

Model: bigrams over words `[^\\x20\\x09-\\x0D]+` (A-Z lower-cased) and one end token a text, mixed with the additive
unigram model p0(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)):

    p(w | h) = lambda_b c*(h, w) / c(h) + (1 - lambda_b) p0(w),    b = the binary order of c(h)

c* is the bigram's quantised count. All bigrams of the training texts are held in a log-frequency Bloom filter:
for level q = 1 + floor(log_1.5(c)) it stores the bigram with 1, 2, ... q, and a lookup asks for level 1, 2, ...
until an answer is no. The weights lambda_b maximise the likelihood of the training texts with each token's own
occurrence left out, from a histogram of p1 / p0 in eighths of an octave, as which the scores use it as well. A
count that leaves one out is quantised as any other: the filter stores a bigram with 0 if c - 1 has the level of c;
otherwise the level is one less, and none if c is 1.

How it runs:
1. Texts are read once and cut into blocks of bounded size. A block keeps its texts (compressed), its sorted distinct word
   hashes and its sorted bigram fingerprints with their training counts, both cut into key ranges (segments). Only
   ranges in which a block has keys become messages, so there are never more messages than keys: both grow with the text.
2. A task for each segment adds up the counts of all blocks. For words it answers every block with the exact
   counts of the words that the block asked for; nothing but these answers goes back. For bigrams it makes its
   part of the filter.
3. The filter is broadcast if its size is within `MOST_FILTER`. Beyond that, and from `TEXT_PER_FILTER` times as much text on
   without asking, the segments answer the blocks from their own part of the filter; results are the same.
4. Each block meets its answers and scores its texts.
Word counts are exact but for collisions of 64-bit hashes; a frequent word is one entry a block, never rows.

Texts whose crc32(id as text) mod 10 is 0 are held out of training. Defined cases: a null text is empty (one end
token). A null id counts as the empty text, which is held out. Repeated rows are rows of their own. Without any
training text N = V = 0 and all scores are 0. Empty tables give no rows. Further columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Work
from .text import LOWER, Words, blocks, joined, mix

BLOCK = 8_000_000
#: Text bytes for each segment, and the least number of segments (a power of two).
PER_SEGMENT, LEAST_SEGMENTS = 16_000_000, 64
#: Counts from which bigrams are held, the base of the levels, bits for each entry and probes.
LEAST, BASE, BITS, PROBES = 1, 1.5, 12, 6
#: Bytes of filter that are broadcast at most, and bytes of text for each of them beyond which the filter is taken to be larger
#: without being built for that.
MOST_FILTER, TEXT_PER_FILTER = 64_000_000, 8
#: Keys that are probed at once.
RUN = 1 << 16
FINGERPRINT = 40
ORDERS, BINS, MIDDLE = 40, 512, 256
END = np.uint64(0x5851F42D4C957F2D)
_LINK, _LEVEL = np.uint64(0x9E3779B97F4A7C15), 0xD1342543DE82EF95


def held_out(ids: list, of: int = 10) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % of == 0 for i in ids], bool)


def _pack(values: np.ndarray) -> bytes:
    """Integers by byte planes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _pack_keys(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as steps, with their counts."""
    return _pack(np.concatenate((np.diff(keys, prepend=np.uint64(0)), counts.astype(np.uint64))))


def _unpack_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = _unpack(data)
    n = len(both) // 2
    return np.cumsum(both[:n], dtype=np.uint64), both[n:].astype(np.int64)


def _segmented(keys: np.ndarray, counts: np.ndarray, width: int, segments: int) -> list[dict]:
    """Payloads of sorted keys of ``width`` bits for each segment that has any."""
    step = np.uint64(width - (segments.bit_length() - 1))
    full, first = np.unique(keys >> step, return_index=True)
    edges = np.append(first, len(keys))
    return [{"segment": int(s), "payload": _pack_keys(keys[a:b], counts[a:b])} for s, a, b in zip(full, edges, edges[1:])]


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs in training texts."""
    order = np.argsort(keys, kind="stable")
    keys, train = keys[order], train[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(train.astype(np.int64), first) if len(first) else np.empty(0, np.int64)


class Tokens:
    """Tokens of a block: key of each, text of each, and the fingerprint of each with the one before it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        texts = len(words.per)
        self.per = words.per + 1
        self.ends = np.cumsum(self.per)
        self.doc = np.repeat(np.arange(texts), self.per)
        self.key = np.full(len(words) + texts, END, np.uint64)
        self.key[np.arange(len(words)) + words.doc] = words.hashes()
        self.first = np.zeros(len(self.key), bool)
        self.first[self.ends - self.per] = True
        before = np.concatenate(([np.uint64(0)], self.key[:-1]))
        before[self.first] = 0
        self.pair = mix(before * _LINK + self.key) >> np.uint64(64 - FINGERPRINT)


class Filter:
    """A log-frequency Bloom filter in parts by key range."""

    def __init__(self, parts: list[bytes], segments: int):
        self.bits = np.array([8 * len(p) for p in parts], np.uint64)
        self.start = np.concatenate(([0], np.cumsum([len(p) for p in parts])))[:-1].astype(np.int64) * 8
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.shift = np.uint64(FINGERPRINT - (segments.bit_length() - 1))

    @staticmethod
    def places(keys: np.ndarray, level: int, bits: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
        one = mix(keys + np.uint64(level * _LEVEL & (1 << 64) - 1))
        two = mix(one) | np.uint64(1)
        for k in range(PROBES):
            yield (one + np.uint64(k) * two) % bits

    @classmethod
    def part(cls, keys: np.ndarray, counts: np.ndarray) -> bytes:
        """The part that holds the keys with their counts."""
        level = levels_of(counts)
        firm = (counts > LEAST) & (levels_of(counts - 1) == level)
        bits = max(64, -(-int(level.sum() + firm.sum()) * BITS // 64) * 64)
        out = np.zeros(bits, bool)
        for at in cls.places(keys[firm], 0, np.uint64(bits)):
            out[at] = True
        for q in range(1, int(level.max(initial=0)) + 1):
            for at in cls.places(keys[level >= q], q, np.uint64(bits)):
                out[at] = True
        return np.packbits(out, bitorder="little").tobytes()

    def holds(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Where the keys are stored with the level, by runs of `RUN` keys."""
        return np.concatenate([self._holds(keys[a : a + RUN], level) for a in range(0, max(1, len(keys)), RUN)])

    def _holds(self, keys: np.ndarray, level: int) -> np.ndarray:
        part = (keys >> self.shift).astype(np.int64)
        bits, start = self.bits[part], self.start[part]
        inside = np.flatnonzero(bits)
        for at in self.places(keys, level, np.maximum(bits, np.uint64(1))):
            at = at[inside].astype(np.int64) + start[inside]
            inside = inside[self.data[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]
            if not len(inside):
                break
        out = np.zeros(len(keys), bool)
        out[inside] = True
        return out

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels by repeated membership probes."""
        out = np.zeros(len(keys), np.int64)
        live, level = np.arange(len(keys)), 1
        while len(live):
            live = live[self.holds(keys[live], level)]
            out[live] = level
            level += 1
        return out

    def left_out(self, keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """The levels of counts less one, given those of the counts."""
        out = np.maximum(levels - 1, 0)
        some = np.flatnonzero(levels >= FIRM)
        out[some] += self.holds(keys[some], 0)
        return out


def levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, LEAST) / LEAST) / math.log(BASE) + 1e-9).astype(np.int64)


#: The least level of several whole counts.
FIRM = next(int(levels_of(np.array(c))) for c in range(LEAST + 1, 100) if levels_of(np.array(c)) == levels_of(np.array(c - 1)))


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the smallest whole one, so that no history's mass exceeds its count; 0 for level 0."""
    return np.where(levels > 0, np.ceil(LEAST * BASE ** (levels - 1.0) - 1e-6), 0.0)


def cut_in_blocks(docs: DataFrame, id_col: str, text_col: str, segments: int) -> DataFrame:
    """Blocks: block, ids, sizes and texts (compressed), and payloads of words and bigrams by segment."""
    id_type = docs.schema[id_col].dataType
    pieces = T.ArrayType(T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("payload", T.BinaryType())]))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("sizes", T.BinaryType()), T.StructField("texts", T.BinaryType()), T.StructField("words", pieces), T.StructField("pairs", pieces), T.StructField("counts", T.ArrayType(T.LongType()))])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in blocks(batch, text_col, BLOCK):
                data, offsets = joined(block.column(text_col))
                data = LOWER[data]
                ids = block.column(id_col)
                train = ~held_out(ids.to_pylist())
                tokens = Tokens(data, offsets)
                learns = train[tokens.doc]
                row = [number, ids.to_pylist(), _pack(np.diff(offsets)), zstandard.ZstdCompressor(level=3).compress(data.tobytes())]
                row += [_segmented(*_counted(tokens.key, learns), 64, segments), _segmented(*_counted(tokens.pair, learns), FINGERPRINT, segments)]
                row.append([int(learns.sum()), int(train.sum())])
                piece = pa.list_(pa.struct([("segment", pa.int32()), ("payload", pa.binary())]))
                kinds = (pa.int64(), pa.list_(ids.type), pa.binary(), pa.binary(), piece, piece, pa.list_(pa.int64()))
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], schema.names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def _sums(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of a segment with their sums, and where each payload's keys are among them."""
    read = [_unpack_keys(p) for p in payloads]
    keys, back = np.unique(np.concatenate([k for k, _ in read]), return_inverse=True)
    sums = np.bincount(back, np.concatenate([c for _, c in read]), minlength=len(keys)).astype(np.int64)
    return keys, sums, np.split(back, np.cumsum([len(k) for k, _ in read])[:-1])


def _messages(cut: DataFrame, kind: str) -> DataFrame:
    """One row for each block and segment: block, segment, payload."""
    return cut.select("block", F.explode(kind).alias("_piece")).select("block", "_piece.segment", "_piece.payload")


def word_answers(cut: DataFrame) -> DataFrame:
    """For each block and segment the training counts of the block's words: block, segment, answer, distinct.

    ``distinct`` is the number of distinct training words of the segment (on one row of each segment, else 0).
    """

    def answer(table: pa.Table) -> pa.Table:
        _, sums, places = _sums(table["payload"].to_pylist())
        distinct = [int((sums > 0).sum())] + [0] * (len(places) - 1)
        return pa.table({"block": table["block"], "segment": table["segment"], "answer": pa.array([_pack(sums[p]) for p in places], pa.binary()), "distinct": pa.array(distinct, pa.int64())})

    return _messages(cut, "words").groupBy("segment").applyInArrow(answer, "block long, segment int, answer binary, distinct long")


def filter_parts(cut: DataFrame) -> DataFrame:
    """The filter's part of each segment: segment, part."""

    def build(table: pa.Table) -> pa.Table:
        keys, sums, _ = _sums(table["payload"].to_pylist())
        held = sums >= LEAST
        return pa.table({"segment": pa.array([table["segment"][0].as_py()], pa.int32()), "part": pa.array([Filter.part(keys[held], sums[held])], pa.binary())})

    return _messages(cut, "pairs").drop("block").groupBy("segment").applyInArrow(build, "segment int, part binary")


def pair_answers(cut: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """The way beyond the broadcast: levels of each block's bigrams from the segment's own part of the filter, times 2,
    and 1 more where leaving one out takes a level. Parts that are there are used, others are built on the way."""

    def levels_in(part: bytes, keys: np.ndarray) -> np.ndarray:
        held = Filter([part], 1)
        held.shift = np.uint64(FINGERPRINT)
        found = held.levels(keys)
        return 2 * found + (found - held.left_out(keys, found))

    def told(table: pa.Table, levels: list[np.ndarray]) -> pa.Table:
        return pa.table({"block": table["block"], "segment": table["segment"], "answer": pa.array([_pack(x) for x in levels], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        keys, sums, places = _sums(table["payload"].to_pylist())
        held = sums >= LEAST
        found = levels_in(Filter.part(keys[held], sums[held]), keys)
        return told(table, [found[p] for p in places])

    def look_up(table: pa.Table, part: pa.Table) -> pa.Table:
        return told(table, [levels_in(part["part"][0].as_py(), _unpack_keys(x)[0]) for x in table["payload"].to_pylist()])

    asked, schema = _messages(cut, "pairs").groupBy("segment"), "block long, segment int, answer binary"
    return asked.applyInArrow(answer, schema) if parts is None else asked.cogroup(parts.groupBy("segment")).applyInArrow(look_up, schema)


def ratio(bins: np.ndarray) -> np.ndarray:
    """p1 / p0 that a bin stands for; bin 0 is 0."""
    return np.where(bins > 0, 2.0 ** ((bins - MIDDLE) / 8), 0.0)


def weights(histogram: np.ndarray) -> np.ndarray:
    """The mixing weight of each order of c(h) that maximises the likelihood, by expectation maximisation."""
    r = ratio(np.arange(BINS))
    weight = np.full(len(histogram), 0.5)
    total = np.maximum(histogram.sum(axis=1), 1)
    for _ in range(200):
        share = weight[:, None] * r / (1 - weight[:, None] + weight[:, None] * r)
        weight = np.clip((histogram * share).sum(axis=1) / total, 1e-6, 1 - 1e-6)
    return np.where(histogram.sum(axis=1) > 0, weight, 0.0)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_filter: int = MOST_FILTER) -> DataFrame:
    """One row per row: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    segments = max(LEAST_SEGMENTS, 1 << math.ceil(math.log2(max(1, size / PER_SEGMENT))))
    work = Work(spark)
    cut = work.stored(cut_in_blocks(docs, id_col, text_col, segments), "blocks")
    train_tokens, train_texts = (int(x or 0) for x in cut.agg(F.sum(F.col("counts")[0]), F.sum(F.col("counts")[1])).first())
    answers = work.stored(word_answers(cut), "word-answers")
    distinct = int(answers.agg(F.sum("distinct")).first()[0] or 0)
    sent, parts = None, None
    told = answers.select("block", "segment", "answer", F.lit(0).alias("kind"))
    if size <= TEXT_PER_FILTER * most_filter:
        parts = work.stored(filter_parts(cut), "filter")
        filter_size = int(parts.agg(F.sum(F.octet_length("part"))).first()[0] or 0)
    if parts is not None and filter_size <= most_filter:
        rows = {r["segment"]: r["part"] for r in parts.toLocalIterator()}
        sent = spark.sparkContext.broadcast(Filter([rows.pop(s, b"") for s in range(segments)], segments) if rows else None)
    else:
        told = told.union(pair_answers(cut, parts).select("block", "segment", "answer", F.lit(1)))
    id_type = docs.schema[id_col].dataType
    kinds = (("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("cells", T.BinaryType()), ("train", T.BinaryType()))
    schema = T.StructType([T.StructField(id_col, id_type), *(T.StructField(n, t) for n, t in kinds)])
    zero = 0.1 / (train_tokens + 0.1 * (distinct + 1))

    def meet(block: pa.Table, told: pa.Table) -> pa.Table:
        sizes = _unpack(block["sizes"][0].as_py()).astype(np.int64)
        ids = block["ids"][0].values
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(block["texts"][0].as_py()), np.uint8)
        tokens = Tokens(data, np.concatenate(([0], np.cumsum(sizes))))
        rows = sorted(zip(told["kind"].to_pylist(), told["segment"].to_pylist(), told["answer"].to_pylist()))
        told_of = lambda kind: np.concatenate([_unpack(a) for k, _, a in rows if k == kind]).astype(np.int64)
        _, back = np.unique(tokens.key, return_inverse=True)
        count = told_of(0)[back]
        if sent is not None:
            level = sent.value.levels(tokens.pair)
            less = sent.value.left_out(tokens.pair, level)
        else:
            _, back = np.unique(tokens.pair, return_inverse=True)
            level = told_of(1)[back]
            level, less = level >> 1, (level >> 1) - (level & 1)
        p0 = count * (zero * 10) + zero
        before = np.concatenate(([0], count[:-1]))
        before[tokens.first] = train_texts
        pair = np.minimum(count_of(level), np.minimum(before, count))
        held = held_out(ids.to_pylist())
        doc, texts = tokens.doc, len(sizes)

        def binned(pair: np.ndarray, before: np.ndarray) -> np.ndarray:
            with np.errstate(divide="ignore", invalid="ignore"):
                r = pair / np.maximum(before, 1) / p0
                bins = np.where(r > 0, np.clip(np.rint(8 * np.log2(r)) + MIDDLE, 1, BINS - 1), 0).astype(np.int64)
            return np.minimum(np.log2(before + 1.0).astype(np.int64), ORDERS - 1) * BINS + bins

        cells = binned(pair, before)
        own = ~held[doc]
        less = np.maximum(np.minimum(count_of(less), np.minimum(before, count) - 1), 0)
        left_out = np.bincount(binned(less, np.maximum(before - 1, 0))[own], minlength=ORDERS * BINS)
        spot, n = np.unique(doc * (ORDERS * BINS) + cells, return_counts=True)
        edges = np.searchsorted(spot, np.arange(texts + 1) * (ORDERS * BINS))
        spot = (spot % (ORDERS * BINS)).astype("<u2")
        packed = [np.concatenate((spot[a:b].view("<u1"), n[a:b].astype("<u4").view("<u1"))).tobytes() for a, b in zip(edges, edges[1:])]
        base = np.bincount(doc, np.log10(p0), minlength=texts)
        known = np.bincount(doc, count > 0, minlength=texts).astype(np.int64)
        train = [left_out.astype("<i8").tobytes()] + [None] * (texts - 1)
        return pa.table({id_col: ids, "held_out": pa.array(held), "n_tokens": pa.array(tokens.per.astype(np.int64)), "n_known": pa.array(known), "base_score": pa.array(base), "cells": pa.array(packed, pa.binary()), "train": pa.array(train, pa.binary())})

    met = cut.select("block", "ids", "sizes", "texts").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(meet, schema)
    met = work.stored(met, "met")
    work.drop_but("met")
    if sent is not None:
        sent.destroy()

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ORDERS * BINS, np.int64)
        for batch in batches:
            for x in batch.column("train"):
                total += np.frombuffer(x.as_buffer(), "<i8")
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["cell", "n"])

    histogram = np.zeros(ORDERS * BINS)
    for r in met.where("train is not null").select("train").mapInArrow(add_up, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        histogram[r["cell"]] = r["n"]
    weight = np.repeat(weights(histogram.reshape(ORDERS, BINS)), BINS)
    gain = np.log10(1 - weight + weight * np.tile(ratio(np.arange(BINS)), ORDERS))
    out = T.StructType([f for f in schema if f.name not in ("cells", "train")] + [T.StructField("gain", T.DoubleType())])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gains = []
            for x in batch.column("cells"):
                raw = np.frombuffer(x.as_buffer(), np.uint8)
                n = len(raw) // 6
                gains.append(float(gain[raw[: 2 * n].view("<u2")] @ raw[2 * n :].copy().view("<u4")))
            yield pa.RecordBatch.from_arrays([batch.column(f) for f in out.names[:-1]] + [pa.array(gains, pa.float64())], out.names)

    done = met.drop("train").mapInArrow(finish, out)
    return done.select(id_col, "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", (F.col("base_score") + F.col("gain")).alias("score"))
