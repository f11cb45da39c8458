"""Spelling variants: words that differ by one inserted, deleted or replaced character, through permuterm rotations.

Words are maximal runs of `[A-Za-z\\u00C0-\\u00FF]`, A-Z lower-cased, of at least 7 characters and 2 occurrences.
A word followed by a terminator has a rotation for each of its places. Turned so that the edited character is last, words that
differ in that character alone begin alike; and what stands before it is a whole rotation of the word without it. So all
neighbours of a word lie in groups of equal keys:

* each rotation without its last character (which is skipped), for replacements and for what is one character longer;
* each whole rotation, for the word that is one character shorter.

1. Tasks count the words of blocks of texts; counts are added before and after a shuffle.
2. Rotations of all words are dealt by key and sorted. A group has a word for each letter at most (91 in all), as the terminator
   tells the edited place. It is scanned once: a word's neighbours in it are counted, and the best two rows of the
   group tell each word its most frequent neighbour, so no pairs are listed. Two words that differ by one replacement
   share one group; a deletion within a run of equal letters is taken at the run's first letter only. So sums over groups count
   each neighbour once.
3. A word's form is its most frequent neighbour, if that is ten times as frequent; forms are followed to the end by joining
   the links with themselves. As counts rise tenfold, a handful of joins is enough for any table.

Defined cases: null texts have no words; a null id is an empty text in the key of an occurrence (see `spoiled`). Repeated rows
count as often as they come. Of neighbours alike in number the first in code-point order is taken. Empty tables give no
rows. Keys of over 64 characters are replaced by a 127-bit hash of them, so a run of any length has short rows. Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Work
from .text import LOWER, SPACE, Words, blocks, joined, ragged

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is this many times as frequent as the word.
TIMES = 10
#: One occurrence in so many loses a character.
SPOILED = 31
#: Marks the end of a word in its rotations; no letter.
END = "$"
#: The longest key that is written out.
LONG = 64

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Runs of letters of a block of texts, lower-cased, and the number of characters of each.

    U+00C0 to U+00FF are the characters whose first byte is 0xC3.
    """
    data = LOWER[data]
    lead = data == 0xC3
    letter = _LETTER[data] | lead
    letter[1:] |= lead[:-1]
    words = Words(np.where(letter, data, np.uint8(32)), offsets, SPACE)
    double = np.concatenate(([0], np.cumsum(words.data == 0xC3)))
    return words, words.size - (double[words.at[1:]] - double[words.at[:-1]])


def checksums(data: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each data[start : start + size], going on from a checksum before it."""
    out = np.empty(len(start), np.uint32)
    long = size > LONG
    for i in np.flatnonzero(long).tolist():
        out[i] = zlib.crc32(data[start[i] : start[i] + size[i]].tobytes(), int(before[i]))
    order = np.flatnonzero(~long)
    order = order[np.argsort(-size[order], kind="stable")]
    state, place, sizes = ~before[order].astype(np.uint32), start[order], size[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, "left"))  # words of more than k bytes stand first
        state[:n] = _CRC[(state[:n] ^ data[place[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = ~state
    return out


def spoiled(word: str, h: int) -> str:
    """What an occurrence counts as: where 31 divides h, without its character h % length."""
    k = h % len(word)
    return word if h % SPOILED else word[:k] + word[k + 1 :]


def word_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """word, n: words of at least 7 characters that occur twice or more, over all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", 4_000_000):
                words, length = runs(*joined(block.column("text")))
                ids = np.array([zlib.crc32(f"{'' if x is None else x}:".encode()) for x in block.column("id").to_pylist()], np.uint32)
                at = np.flatnonzero(length >= LEAST_LENGTH)
                if not len(at):
                    continue
                h = checksums(words.data, words.at[at], words.size[at], ids[words.doc[at]])
                loses = h % np.uint32(SPOILED) == 0
                texts = words.array()
                counts = pc.value_counts(texts.take(pa.array(at[~loses])))
                yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.binary()).cast(pa.string()), counts.field("counts")], ["word", "n"])
                left = [spoiled(w.decode(), x) for w, x in zip(texts.take(pa.array(at[loses])).to_pylist(), h[loses].tolist())]
                counts = pc.value_counts(pa.array([w for w in left if len(w) >= LEAST_LENGTH], pa.string()))
                yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1CE4E5B9


def rotation_keys(word: str) -> Iterator[tuple[str, str]]:
    """(key, edited character): rotations without their last character, then whole ones with an empty character.

    Keys of over 64 characters are hashes, whose sums follow from those of the word's beginnings and ends.
    """
    n = len(word)
    heads, powers = [0], [1]
    if n >= LONG:
        for c in word:
            heads.append((heads[-1] * _BASE + ord(c)) % _PRIME)
            powers.append(powers[-1] * _BASE % _PRIME)

    def key(tail_at: int, head: int) -> str:
        """word[tail_at:] + END + word[:head]."""
        if n - tail_at + 1 + head <= LONG:
            return word[tail_at:] + END + word[:head]
        tail = heads[n] - heads[tail_at] * powers[n - tail_at]
        return f"#{((tail * _BASE + ord(END)) * powers[head] + heads[head]) % _PRIME:x}/{n - tail_at + 1 + head}"

    for i in range(n):
        yield key(i + 1, i), word[i]
    for i in range(n + 1):
        yield key(i, i), ""


def name_of(word: str) -> str:
    """What rows of rotations call a word: itself, or its digest where it is long."""
    return word if len(word) <= LONG else "#" + hashlib.sha256(word.encode()).hexdigest()


def rotations(words: DataFrame) -> DataFrame:
    """key, edited, doubled (whether the character before the edited one is the same), word (its name), n."""

    def turn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                name, before = name_of(word), [False, *(a == b for a, b in zip(word, word[1:]))]
                rows += [(key, edited, i < len(word) and before[i], name, n) for i, (key, edited) in enumerate(rotation_keys(word))]
                if len(rows) >= 100_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.bool_(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["key", "edited", "doubled", "word", "n"])

    return words.mapInArrow(turn, "key string, edited string, doubled boolean, word string, n long")


def _near_in_group(rows: list[tuple[str, bool, str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """For (edited, doubled, word, n) of one key: word, near words in the group, and n and name of the best of them."""
    shorter = next((r for r in rows if not r[0]), None)
    same = [r for r in rows if r[0]]
    rank = lambda r: (-r[3], r[2])
    best = sorted(same, key=rank)[:2]
    for r in same:
        others = [x for x in best if x is not r][:1]
        near = len(same) - 1
        if shorter is not None and not r[1]:
            others.append(shorter)
            near += 1
        if near:
            top = min(others, key=rank)
            yield r[2], near, top[3], top[2]
    longer = [r for r in same if not r[1]]
    if shorter is not None and longer:
        top = min(longer, key=rank)
        yield shorter[2], len(longer), top[3], top[2]


def near_words(turned: DataFrame) -> DataFrame:
    """Sums over groups of equal keys: word, n_near, best (struct of less, which is -n, and word)."""
    columns = ["key", "edited", "doubled", "word", "n"]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch]).select(columns)
            table = table if rest is None else pa.concat_tables([rest, table])
            starts = _starts(table)
            rest = table.slice(starts[-1]) if len(starts) else None  # the last group may go on
            yield from _scanned(table, starts)
        if rest is not None:
            yield from _scanned(rest, np.array([0, len(rest)]))

    def _starts(table: pa.Table) -> np.ndarray:
        if not len(table):
            return np.empty(0, np.int64)
        key = table["key"].combine_chunks()
        new = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate(([0], np.flatnonzero(new) + 1))

    def _scanned(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = np.diff(edges)
        many = np.flatnonzero(size > 1)
        if not len(many):
            return
        held = table.take(pa.array(ragged(edges[:-1][many], size[many])))
        rows = list(zip(*(held[c].to_pylist() for c in columns[1:])))
        ends = np.cumsum(size[many]).tolist()
        found = [x for a, b in zip([0, *ends], ends) for x in _near_in_group(rows[a:b])]
        if found:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], ["word", "near", "best_n", "best"])

    dealt = turned.repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(scan, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))


def _roots(forms: DataFrame, most: int, work: Work) -> DataFrame:
    """word, root of all words with a form. Each form is ten times as frequent, so a chain has at most log10(most) links."""
    links = forms
    for k in range(math.ceil(math.log2(max(1.0, math.log(max(2, most), TIMES)))) + 1):
        onward = links.select(F.col("root").alias("_onward"), F.col("word").alias("_word"))
        links = work.stored(links.join(onward, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_onward", "root").alias("root")), f"roots-{k}")
    return links


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    work = Work(docs.sparkSession)
    words = work.stored(word_counts(docs, id_col, text_col), "words")
    near = work.stored(near_words(rotations(words)), "near").select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.less")).alias("best_n"))
    long = words.where(F.char_length("word") > LONG)
    if long.take(1):
        names = work.stored(long.select(F.concat(F.lit("#"), F.sha2("word", 256)).alias("name"), F.col("word").alias("full")), "names")
        of = lambda c: names.select(F.col("name").alias(f"_{c}"), F.col("full").alias(f"_full_{c}"))
        for c in ("word", "best"):
            near = near.join(of(c), F.col(c) == F.col(f"_{c}"), "left").withColumn(c, F.coalesce(f"_full_{c}", c)).drop(f"_{c}", f"_full_{c}")
    found = words.join(near, "word", "left")
    is_form = F.col("best_n") >= TIMES * F.col("n")
    found = found.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
    found = work.stored(found, "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    forms = found.where("form is not null").select("word", F.col("form").alias("root"))
    roots = _roots(forms, most, work)
    work.drop("words", "near", *(n for n in work.names if n == "names" or n.startswith("roots-") and n != work.names[-1]))
    out = found.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
