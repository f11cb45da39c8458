"""MinHash near-duplicates: DartMinHash signatures, banded join, exact check, connected classes.

Documents are sets of five-word shingles (words as `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; a text of fewer words
is one shingle). Two texts are linked when the Jaccard similarity of their shingle sets is 0.8 or more and they
share a band; 24 bands of 4 coordinates miss a pair at 0.8 with probability 3e-6, more similar ones far less.
Classes are the connected components of the links.

1. Texts with equal words are one text from the start, however many rows hold them.
2. In each band bucket every text is compared with one leader. A bucket of any size gives one pair a text; sums
   and minima are made before the shuffle. Links join components; only buckets whose texts are not yet in one component
   go on, with another leader and with components in place of texts.
3. What is left is settled within the buckets: each text outside a bucket's main component is held against all
   texts of the bucket, in blocks, by signature and then by its exact shingles, best first, until it is linked.
   So no pair that shares a bucket is left out, and pairs within a component are never listed.

Defined cases: null and empty texts have no words and are copies of each other. Ids may be null or repeat: rows are told
apart by a number of their own, a class is named by its smallest id (null if it has none) and keeps one row. An
empty table gives no rows. Very long texts are taken whole. Further columns are carried by `kept_rows`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dart_minhash
from .shared import Work, broadcast_if_small, free_name
from .text import LOWER, Words, blocks, joined, mix, ragged

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
#: Rounds of leaders before the rest is settled within the buckets.
ROUNDS = 2
#: Links that one task settles at most (3 MB); more go through rounds of stars.
FEW_EDGES = 200_000
#: Texts of a bucket that are compared as one block.
BLOCK = 256
#: Share of signature coordinates from which a pair is checked exactly within a bucket: 4.9 standard deviations below 0.8, so
#: that it loses a pair at 0.8 with probability 7e-7, less than the bands do.
AGREE = 0.6


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Shingle hashes of a block, the text of each, the hashes of its words, and the words."""
    words = Words(LOWER[data], offsets)
    each = words.hashes()
    sizes = np.maximum(words.per - (SHINGLE - 1), np.minimum(words.per, 1))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = ragged(words.edges[:-1], sizes)
    end = words.edges[1:][owner]
    out = np.zeros(len(first), np.uint64)
    for k in range(SHINGLE):
        at = first + k
        part = each[np.minimum(at, len(each) - 1)] if len(each) else np.zeros(len(at), np.uint64)
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + np.where(at < end, part, np.uint64(0)))
    return out, owner, each, words


def _digests(each: np.ndarray, words: Words) -> list[bytes]:
    """A 128-bit digest of the words of each text."""
    raw = memoryview(each.view(np.uint8)) if len(each) else memoryview(b"")
    return [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(words.edges[:-1].tolist(), words.edges[1:].tolist())]


def sketched(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """A row number, the digest of the words, band keys and a byte of each signature coordinate for every row."""
    kinds = {"row": T.LongType(), "same": T.BinaryType(), "bands": T.ArrayType(T.LongType()), "signature": T.BinaryType()}
    names = {k: free_name(docs, k) for k in kinds}
    source = docs if carry else docs.select(id_col, text_col)
    carried = [f for f in source.schema if carry or f.name == id_col]
    schema = T.StructType([T.StructField(names[k], t) for k, t in kinds.items()] + [T.StructField(f.name, f.dataType) for f in carried])
    text_at, keep = source.columns.index(text_col), [i for i, f in enumerate(source.schema) if f in carried]

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for block in blocks(batch, batch.schema.names[text_at]):
                shingle, owner, each, words = _shingles(*joined(block.column(text_at)))
                n = block.num_rows
                signature = dart_minhash.signatures(shingle, np.ones(len(shingle)), owner, n, BANDS * ROWS)
                keys = dart_minhash.bands(signature, ROWS).view(np.int64)
                full = words.per > 0
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(full * BANDS))), pa.int32()), pa.array(keys[full].ravel()))
                low = (signature & np.uint64(255)).astype(np.uint8)
                own = [pa.array(np.arange(number, number + n)), pa.array(_digests(each, words), pa.binary()), lists, pa.array([x.tobytes() for x in low], pa.binary())]
                number += n
                yield pa.RecordBatch.from_arrays(own + [block.column(i) for i in keep], [*names.values(), *(f.name for f in carried)])

    return source.mapInArrow(sketch, schema), names


def _sets(docs: DataFrame, text_col: str) -> DataFrame:
    """The distinct shingles of every text, sorted, as bytes: (same, shingles)."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text_col):
                shingle, owner, each, words = _shingles(*joined(block.column(text_col)))
                edges = np.searchsorted(owner, np.arange(block.num_rows + 1))
                yield pa.RecordBatch.from_arrays([pa.array(_digests(each, words), pa.binary()), pa.array([np.unique(shingle[a:b]).tobytes() for a, b in zip(edges, edges[1:])], pa.binary())], ["same", "shingles"])

    return docs.select(text_col).mapInArrow(sets, "same binary, shingles binary")


def _similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= similarity * (len(x) + len(y) - common) - 1e-9


def linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of pairs (a, label, b, main) of nodes and their labels those whose shingle sets are similar enough, as (label, main)."""
    both = pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a").join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b").select("label", "main", "x", "y")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity) for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["label", "main"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(check, "label long, main long")


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of all edges of a task by union and find: (node, label), label the smallest node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = [(x, root(x)) for x in parent]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found if r[0] != r[1]], pa.int64()) for k in (0, 1)], ["node", "label"])


def components(edges: DataFrame, few: int = FEW_EDGES, work: Work | None = None, name: str = "components") -> DataFrame:
    """Connected components: a stored table (node, label), label the smallest node of the component; nodes that are their
    own label are not listed.

    Rounds of alternating large and small stars, each written to the shared folder in place of the one before. At most
    ``few`` edges are settled in one task, with the same result.
    """
    work = work or Work(edges.sparkSession)
    edges = work.stored(edges.where("a <> b").select("a", "b").distinct(), f"{name}-stars-0")
    for step in range(64):
        if edges.count() <= few:
            out = work.stored(edges.coalesce(1).mapInArrow(_forest, "node long, label long"), name)
            work.drop(f"{name}-stars-{step}")
            return out
        if step:
            several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
            onward = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
            if not several.union(onward).take(1):
                return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        two_way = edges.union(edges.select("b", "a"))
        least = two_way.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = two_way.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(low, "a")
        edges = work.stored(small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(small.select("a", F.col("least").alias("b"))).where("a <> b").distinct(), f"{name}-stars-{step + 1}")
        work.drop(f"{name}-stars-{step}")
    raise RuntimeError("components have not settled in 64 rounds")


def _leaders(rows: DataFrame, seed: int) -> DataFrame:
    """Buckets with texts of several components: bucket, n, and the text with the smallest hash as leader with its label
    as main, which most often is the main component where one is large."""
    rank = F.xxhash64("node", "bucket", F.lit(seed))
    heads = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.min_by("node", rank).alias("leader"), F.min_by("label", rank).alias("main"))
    return heads.where("low <> high").select("bucket", "n", "leader", "main")


def _relabelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """Rows with the labels that a table (node, label) of merged components gives them."""
    new = broadcast_if_small(merged.select(F.col("node").alias("label"), F.col("label").alias("_label")))
    return rows.join(new, "label", "left").withColumn("label", F.coalesce("_label", "label")).drop("_label")


def _rest_of_buckets(rows: DataFrame, sets: DataFrame, similarity: float, work: Work | None = None) -> DataFrame:
    """Links (a, b) between components of bucket rows (bucket, node, same, signature, label); sets: (same, shingles)."""
    work = work or Work(rows.sparkSession)
    open_ = _leaders(rows, ROUNDS).select("bucket", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    held = work.stored(rows.join(open_, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "unsettled")
    asked = held.where("label <> main")
    # queries of block i meet the rows of block j; only blocks i that hold a query are made
    some = asked.select("bucket", F.col("block").alias("i")).distinct()
    every = held.join(some, "bucket").select("bucket", F.col("block").alias("j"), "i", "same", "signature", "label", F.lit(False).alias("asks"))
    queries = asked.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("bucket", "j", F.col("block").alias("i"), "same", "signature", "label", F.lit(True).alias("asks"))
    cells = every.unionByName(queries).join(sets, "same").groupBy("bucket", "i", "j").agg(F.collect_list(F.struct("asks", "shingles", "signature", "label")).alias("rows"))

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for cell in batch.column("rows"):
                rows = cell.values
                asks, label = (rows.field(k).to_numpy(zero_copy_only=False) for k in ("asks", "label"))
                shingles = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.field("shingles")]
                coordinates = np.frombuffer(b"".join(rows.field("signature").to_pylist()), np.uint8).reshape(len(label), -1)
                parent = {x: x for x in label.tolist()}

                def root(x: int, parent: dict[int, int] = parent) -> int:
                    while parent[x] != x:
                        parent[x] = x = parent[parent[x]]
                    return x

                held = np.flatnonzero(~asks)
                for q in np.flatnonzero(asks).tolist():
                    agree = (coordinates[held] == coordinates[q]).mean(axis=1)
                    near = np.flatnonzero((agree >= AGREE) & (label[held] != label[q]))
                    for m in held[near[np.argsort(-agree[near], kind="stable")]].tolist():
                        x, y = root(int(label[q])), root(int(label[m]))
                        if x != y and _similar(shingles[q], shingles[m], similarity):
                            parent[x] = y
                            links.append((int(label[q]), int(label[m])))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return cells.select("rows").mapInArrow(settle, "a long, b long")


def _merges(texts: DataFrame, docs: DataFrame, text_col: str, similarity: float, work: Work) -> list[DataFrame]:
    """Tables (node, label) of merged components, each in terms of the labels that those before it leave."""
    slots = texts.select("node", F.explode("bands").alias("bucket"))
    rank = F.xxhash64("node", "bucket", F.lit(0))
    heads = slots.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("node", rank).alias("leader")).where("n > 1")
    rows = work.stored(slots.join(heads.drop("n"), "bucket").select("bucket", "node", F.col("node").alias("label"), "leader", F.col("leader").alias("main")), "open-0")
    wanted = work.stored(rows.select("node").distinct().join(texts.select("node", "same"), "node"), "wanted")
    sets = work.stored(_sets(docs, text_col).join(broadcast_if_small(wanted), "same").groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")
    merged: list[DataFrame] = []
    for seed in range(ROUNDS):
        if seed:
            rows = work.stored(rows.join(_leaders(rows, seed).drop("n"), "bucket"), f"open-{seed}")
            work.drop(f"open-{seed - 1}")
        pairs = rows.where("label <> main").select(F.col("node").alias("a"), "label", F.col("leader").alias("b"), "main").distinct()
        found = linked(pairs, sets, similarity).select(F.col("label").alias("a"), F.col("main").alias("b"))
        merged.append(components(found, work=work, name=f"merged-{seed}"))
        rows = _relabelled(rows.select("bucket", "node", "label"), merged[-1])
    placed = rows.join(texts.select("node", "signature"), "node").select("bucket", "node", F.col("node").alias("same"), "signature", "label")
    more = _rest_of_buckets(placed, sets.select(F.col("node").alias("same"), "shingles"), similarity, work)
    return [*merged, components(more, work=work, name="merged-rest")]


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, carry: bool) -> tuple[DataFrame, dict[str, str], DataFrame, Work]:
    """The stored sketches, their column names, and a stored row per sketched row: (_row, _id, class_id, class_size, kept)."""
    work = Work(docs.sparkSession)
    sketches, names = sketched(docs, id_col, text_col, carry)
    sketches = work.stored(sketches, "sketches")
    rows = sketches.select(*(F.col(n).alias(k) for k, n in names.items()), F.col(f"`{id_col}`").alias("id"))
    texts = work.stored(rows.groupBy("same").agg(F.min("row").alias("node"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "texts")
    nodes = texts.select("same", F.col("node").alias("label"))
    for merged in _merges(texts, docs if not carry else sketches, text_col, similarity, work):
        nodes = _relabelled(nodes, merged)
    members = rows.groupBy("same").agg(F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    classes = work.stored(nodes.join(members, "same"), "classes")
    totals = classes.groupBy("label").agg(F.sum("n").alias("class_size"), F.min("first").alias("first"))
    by_text = classes.select("same", "label").join(totals, "label").select("same", F.col("first.id").alias("class_id"), "class_size", F.col("first.row").alias("first_row"))
    by_text = broadcast_if_small(work.stored(by_text, "by-text"))
    found = rows.select("row", "id", "same").join(by_text, "same").select(F.col("row").alias("_row"), F.col("id").alias("_id"), "class_id", "class_size", (F.col("row") == F.col("first_row")).alias("kept"))
    return sketches, names, work.stored(found, "found"), work


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: id_col, class_id, class_size, kept (one row of each class)."""
    _, _, found, work = _classes(docs, id_col, text_col, similarity, carry=False)
    work.drop_but("found")
    return found.select(F.col("_id").alias(id_col), "class_id", "class_size", "kept")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all columns of ``docs``."""
    sketches, names, found, work = _classes(docs, id_col, text_col, similarity, carry=True)
    work.drop_but("sketches", "found")
    stays = found.where("kept").select(F.col("_row").alias(names["row"]))
    rows = sketches.drop(*(n for k, n in names.items() if k != "row"))
    return rows.join(stays, names["row"]).select(*(F.col(f"`{c}`") for c in docs.columns))
