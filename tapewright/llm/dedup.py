"""Exact deduplication through an extendible-hash index on shared files.

1. Each task folds equal texts within a batch into one entry: its key (64 bits of the digest of the normalised
   text), the number of rows, their ids, and the row with the largest id. The entries are written to the shared
   folder; they are the index's pages.
2. Distinct keys are counted once by a prefix that is longer than needed. The directory begins with a few key bits; in
   each round the buckets with more distinct keys than a page holds are split by one more bit, and the directory
   doubles when a bucket has passed its depth. Copies of one key are left to chaining. It is a table like any
   other: no bucket, key or digest comes to the driver.
3. Keys with very many entries are folded first: groups of at most some hundred entries of a key, each in a task of its own,
   are compared and chained, and only the first entry of each chain goes on, in as many rounds as it takes.
4. Owner tasks get ranges of keys, cut between buckets, in key order (`repartitionById`). Entries with equal keys are
   compared byte for byte and chained where the texts differ, so a digest collision never merges two texts.
5. What an owner finds goes back to the entries by their number, and from there to the rows.

A group of copies of any size reaches its owner as a few hundred entries, not as rows. Texts are equal when
identical after lower-casing A-Z. The row with the largest id stays; a null id counts as less than any other.

Defined cases: a null text counts as empty. Of rows that repeat the largest id, exactly one is kept. If all ids
of a group are null, one of its rows stays and keep_id is null. Empty tables give no rows. Very long texts are
hashed and compared whole. Further columns are carried by `kept_rows` and may have any names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Work, broadcast_if_small, free_name
from .text import blocks

#: Distinct keys that a bucket holds before it is split.
PAGE = 20_000
#: Bits of the first directory, and bits by which keys are counted beyond those that equal buckets would need.
FIRST_BITS, SPARE_BITS = 7, 4
#: Entries of one key that an owner takes as they are, and that a task folds where a key has more.
MOST_ENTRIES = 500
#: Upper case to lower case for A-Z only.
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_ENTRY = ("key", "sha256", "entry", "n", "top", "top_at", "members")


def index_entries(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    """Entries of equal texts within batches, with the columns of the row that has the largest id.

    Returns the entries and the names under which the index keeps its own columns (none clashes with a column).
    """
    id_type = docs.schema[id_col].dataType
    names = {k: free_name(docs, k) for k in _ENTRY}
    kinds = dict(zip(_ENTRY, (T.LongType(), T.StringType(), T.LongType(), T.LongType(), id_type, T.IntegerType(), T.ArrayType(id_type))))
    schema = T.StructType([T.StructField(names[k], kinds[k]) for k in _ENTRY] + [T.StructField(f.name, f.dataType) for f in docs.schema])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in (block for batch in batches for block in blocks(batch, text_col, 16_000_000)):
            texts, ids = batch.column(text_col), batch.column(id_col).to_pylist()
            groups: dict[bytes, list[int]] = {}
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                norm = b"" if value is None else value.encode().translate(_LOWER)
                groups.setdefault(norm, []).append(i)
            if not groups:
                continue
            cols: dict[str, list] = {k: [] for k in _ENTRY}
            best = []
            for norm, rows in groups.items():
                digest = hashlib.sha256(norm).digest()
                at = max(range(len(rows)), key=lambda k: (ids[rows[k]] is not None, ids[rows[k]] if ids[rows[k]] is not None else 0, k))
                best.append(rows[at])
                for k, v in zip(_ENTRY, (int.from_bytes(digest[:8], "big", signed=True), digest.hex(), number, len(rows), ids[rows[at]], at, [ids[r] for r in rows])):
                    cols[k].append(v)
                number += 1
            top = batch.take(pa.array(best))
            id_arrow = batch.schema.field(id_col).type
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), id_arrow, pa.int32(), pa.list_(id_arrow))
            yield pa.RecordBatch.from_arrays([pa.array(cols[k], t) for k, t in zip(_ENTRY, kinds)] + top.columns, [names[k] for k in _ENTRY] + top.schema.names)

    return docs.mapInArrow(scan, schema), names


def directory(entries: DataFrame, key: str, page: int = PAGE, first_bits: int = FIRST_BITS, work: Work | None = None) -> DataFrame:
    """Slots of the directory that hold keys: (slot, bucket, bits), where bits is the depth of the whole directory and a
    bucket is named by its first slot.

    Copies of a key count once, as no split can part them. A slot that holds more than a page at the depth that equal
    buckets would need is counted again with longer prefixes. Rounds of splits are over this table of counts.
    """
    work = work or Work(entries.sparkSession)
    deep = max(first_bits, math.ceil(math.log2(max(1.0, entries.count() / page))) + SPARE_BITS)
    while True:
        counts = entries.select(F.shiftrightunsigned(F.col(key), 64 - deep).alias("slot"), F.col(key).alias("k"))
        counts = work.stored(counts.groupBy("slot").agg(F.count_distinct("k").alias("n")), f"counts-{deep}")
        if deep == 63 or not counts.where(F.col("n") > page).take(1):
            break
        deep = min(63, deep + SPARE_BITS)
    held, bits = counts.withColumn("depth", F.lit(first_bits)), first_bits
    while bits < deep:
        at = F.shiftright("slot", deep - bits).alias("prefix")
        full = held.where(F.col("depth") == bits).groupBy(at).agg(F.sum("n").alias("total")).where(F.col("total") > page)
        full = work.stored(full.select("prefix", F.lit(bits).alias("depth"), F.lit(True).alias("full")), f"full-{bits}")
        if not full.take(1):
            break
        split = held.withColumn("prefix", at).join(broadcast_if_small(full), ["prefix", "depth"], "left")
        bits += 1  # the directory doubles; each half of a full bucket has one bit more, the others keep theirs
        held = work.stored(split.select("slot", "n", (F.col("depth") + F.coalesce("full", F.lit(False)).cast("int")).alias("depth")), f"split-{bits}")
    first = F.expr(f"shiftleft(shiftright(slot, {deep} - depth), {deep} - depth)")
    return held.select("slot", first.alias("bucket"), F.lit(deep).alias("bits"))


def _chained(dealt: DataFrame, *group: str) -> DataFrame:
    """Each entry with the first entry of its chain among those of its group, which come one after another in a task:
    (entry, chain, n, top) and the columns of the group. Equal bytes, equal chain."""
    kept = ("entry", "n", "top", *group)
    schema = T.StructType([T.StructField("chain", T.LongType()), *(T.StructField(c, dealt.schema[c].dataType) for c in kept)])

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, texts = None, {}
        for batch in batches:
            chains = []
            values = batch.column("text")
            groups = zip(*(batch.column(c).to_pylist() for c in group))
            for i, (now, entry) in enumerate(zip(groups, batch.column("entry").to_pylist())):
                if now != last:
                    last, texts = now, {}
                value = values[i].as_py()
                norm = b"" if value is None else value.encode().translate(_LOWER)
                chains.append(texts.setdefault(norm, entry))  # the dict compares the bytes of texts with equal keys
            yield pa.RecordBatch.from_arrays([pa.array(chains, pa.int64()), *(batch.column(c) for c in kept)], ["chain", *kept])

    return dealt.mapInArrow(chain, schema)


def folded(rows: DataFrame, keys: DataFrame, most: int, work: Work) -> tuple[DataFrame, list[DataFrame]]:
    """Entries (key, entry, n, top, text) of which no key has more than ``most``, and tables (entry, chain) that lead those which
    were folded to the entry that stands for them, round by round. A round in which a key's entries do not become half as
    many, as its texts differ, is the last."""
    tables: list[DataFrame] = []
    while True:
        hot = work.stored(keys.where(F.col("entries") > most).select("key", F.ceil(F.col("entries") / most).cast("int").alias("groups")), f"hot-{len(tables)}")
        if not hot.take(1):
            return rows, tables
        grouped = rows.join(broadcast_if_small(hot), "key").withColumn("salt", F.pmod(F.xxhash64("entry"), F.col("groups")).cast("int"))
        dealt = grouped.repartition("key", "salt").sortWithinPartitions("key", "salt", "entry")
        links = work.stored(_chained(dealt.select("key", "salt", "entry", "n", "top", "text"), "key", "salt"), f"folded-{len(tables)}")
        away = links.where("entry <> chain").select("entry", "chain")
        tables.append(away)
        rows = rows.join(away.select("entry"), "entry", "left_anti")
        left = work.stored(links.where("entry = chain").groupBy("key").agg(F.count("*").alias("entries")), f"left-{len(tables)}")
        keys = left.join(hot, "key").where(F.col("entries") * 2 < F.col("groups") * most)


def owners(entries: DataFrame, names: dict[str, str], text_col: str, page: int, first_bits: int, work: Work | None = None, most: int | None = None) -> DataFrame:
    """Each entry with the first entry of its chain: (entry, chain, n, top). Equal bytes, equal chain."""
    spark, most = entries.sparkSession, most or MOST_ENTRIES
    work = work or Work(spark)
    keys = work.stored(entries.groupBy(F.col(names["key"]).alias("key")).agg(F.count("*").alias("entries")), "keys")
    slots = work.stored(directory(keys, "key", page, first_bits, work), "directory")
    bits = slots.agg(F.max("bits")).first()[0] or first_bits
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = entries.select(*(F.col(names[k]).alias(k) for k in ("key", "entry", "n", "top")), F.col(text_col).alias("text"))
    rest, tables = folded(rows, keys, most, work)
    # digest bits are even, so equal ranges of keys are equal shares
    owner = F.floor(F.col("bucket") * (tasks / 2.0**bits)).cast("int")
    dealt = (
        rest.withColumn("slot", F.shiftrightunsigned("key", 64 - bits))
        .join(broadcast_if_small(slots.select("slot", "bucket")), "slot")
        .drop("slot")
        .repartitionById(tasks, owner)
        .sortWithinPartitions("bucket", "key", "entry")
        .select("key", "entry", "n", "top", "text")
    )
    chains = _chained(dealt, "key").select("entry", "chain", "n", "top")
    if not tables:
        return chains
    found = work.stored(chains.select("entry", "chain"), "owned")
    for away in reversed(tables):
        found = found.union(away.join(found.select(F.col("entry").alias("chain"), F.col("chain").alias("_chain")), "chain").select("entry", F.col("_chain").alias("chain")))
    return rows.select("entry", "n", "top").join(found, "entry").select("entry", "chain", "n", "top")


def _decided(docs: DataFrame, id_col: str, text_col: str, page: int, first_bits: int) -> tuple[DataFrame, dict[str, str], DataFrame]:
    work = Work(docs.sparkSession)
    entries, names = index_entries(docs, id_col, text_col)
    entries = work.stored(entries, "index")
    links = work.stored(owners(entries, names, text_col, page, first_bits, work), "chains")
    work.drop_but("index", "chains")
    groups = links.groupBy("chain").agg(F.sum("n").alias("group_size"), F.max(F.struct("top", "entry")).alias("best"))
    found = links.join(groups, "chain").select(
        F.col("entry").alias(names["entry"]),
        F.col("best.top").alias("_keep_id"),
        F.col("group_size").alias("_group_size"),
        (F.col("entry") == F.col("best.entry")).alias("_stays"),
    )
    return entries, names, found


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page: int = PAGE, first_bits: int = FIRST_BITS) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    entries, names, found = _decided(docs.select(id_col, text_col), id_col, text_col, page, first_bits)
    own = {k: names[k] for k in ("entry", "members", "top_at", "sha256")}
    rows = entries.select(*own.values()).join(found, own["entry"])
    return rows.select(F.posexplode(own["members"]).alias("_at", "_id"), "_keep_id", "_group_size", "_stays", own["top_at"], own["sha256"]).select(
        F.col("_id").alias(id_col),
        F.col("_keep_id").alias("keep_id"),
        F.col("_group_size").alias("group_size"),
        (F.col("_stays") & (F.col("_at") == F.col(own["top_at"]))).alias("kept"),
        F.col(own["sha256"]).alias("text_sha256"),
    )


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page: int = PAGE, first_bits: int = FIRST_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    entries, names, found = _decided(docs, id_col, text_col, page, first_bits)
    stays = found.where("_stays").select(names["entry"])
    return entries.drop(*(names[k] for k in _ENTRY if k != "entry")).join(stays, names["entry"]).select(*(F.col(f"`{c}`") for c in docs.columns))
