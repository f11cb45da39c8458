import hashlib

from pyspark.sql import functions as F

from tapewright.llm import dedup, queries
from tapewright.llm.shared import Work


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(lower(text), []).append(doc_id)
    return groups


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    groups = brute(rows)
    want = {(i, max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids}
    assert {tuple(r) for r in queries.op6_exact_dedup(spark, sf).collect()} == want


def test_splits_copies_and_edge_cases(spark):
    rows = [(i, f"Text {i % 97}") for i in range(1000)] + [(2000 + i, "HOT copy") for i in range(500)]
    rows += [(3000, None), (3001, ""), (None, "only null ids"), (None, "ONLY null ids"), (4000, "Ä ö"), (4001, "ä ö"), (5000, "twice"), (5000, "twice"), (6000, "long " * 50000)]
    docs = spark.createDataFrame([(i, t, i, "k") for i, t in rows], "doc_id long, text string, entry long, KEY string").repartition(5)
    out = dedup.exact_duplicates(docs, page=8, first_bits=1).collect()
    groups = brute(rows)
    assert len(out) == len(rows)
    sizes = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = {}
    for r in out:
        ids = sizes[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
    assert set(kept.values()) == {1}
    stay = dedup.kept_rows(docs, page=8, first_bits=1)
    assert stay.columns == docs.columns
    assert sorted((lower(r["text"]), r["doc_id"] or -1) for r in stay.collect()) == sorted((t, max((i for i in ids if i is not None), default=-1)) for t, ids in groups.items())


def test_equal_keys_with_other_bytes_are_chained(spark):
    rows = [(1, 10, 1, 5, "a"), (1, 11, 2, 9, "b"), (1, 12, 1, 7, "A"), (2, 13, 1, 1, "a")]
    entries = spark.createDataFrame(rows, "key long, entry long, n long, top long, text string")
    names = {k: k for k in ("key", "entry", "n", "top")}
    got = {r["entry"]: r["chain"] for r in dedup.owners(entries, names, "text", 20, 2).collect()}
    assert got == {10: 10, 11: 11, 12: 10, 13: 13}


def test_directory_doubles_until_buckets_fit(spark):
    keys = [(i << 50,) for i in range(64)] + [(5 << 50,)] * 300
    found = dedup.directory(spark.createDataFrame(keys, "k long"), "k", page=4, first_bits=1).collect()
    assert max(r["bits"] for r in found) > 1
    bits = found[0]["bits"]
    per = {}
    for (k,) in set(keys):
        bucket = next(r["bucket"] for r in found if r["slot"] == k >> (64 - bits))
        per[bucket] = per.get(bucket, 0) + 1
    assert max(per.values()) <= 4


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.exact_duplicates(docs).collect() == [] and dedup.kept_rows(docs).collect() == []


def test_owners_get_ranges_of_keys(spark):
    rows = [(int.from_bytes(hashlib.sha256(str(i).encode()).digest()[:8], "big", signed=True), i, 1, i, str(i)) for i in range(400)]
    entries = spark.createDataFrame(rows, "key long, entry long, n long, top long, text string").repartition(3)
    names = {k: k for k in ("key", "entry", "n", "top")}
    dealt = dedup.owners(entries, names, "text", 10, 2).withColumn("task", F.spark_partition_id()).collect()
    key = {r[1]: r[0] % (1 << 64) for r in rows}
    spans = {}
    for r in dealt:
        spans.setdefault(r["task"], []).append(key[r["entry"]])
    edges = sorted((min(k), max(k)) for k in spans.values())
    assert len(edges) > 1 and all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


def test_entries_of_a_hot_key_are_folded_before_they_reach_their_owner(spark):
    """One text in each of 2,000 batches, another with the same key in a tenth of them, and many that occur once."""
    rows = [(7, i, 1, i, "Hot" if i % 10 else "other") for i in range(2000)] + [(8, 3000, 1, 1, "hot")]
    rows += [((i + 100) << 48, 4000 + i, 1, i, f"text {i}") for i in range(300)]
    entries = spark.createDataFrame(rows, "key long, entry long, n long, top long, text string").repartition(5)
    names = {k: k for k in ("key", "entry", "n", "top")}
    work = Work(spark)
    keys = entries.groupBy("key").agg(F.count("*").alias("entries"))
    rest, tables = dedup.folded(entries, keys, 20, work)
    assert rest.where("key = 7").count() <= 20 and len(tables) > 1 and rest.where("key <> 7").count() == 301
    for k in range(len(tables)):
        assert spark.read.parquet(f"{work.folder}/folded-{k}").groupBy("key", "salt").count().agg(F.max("count")).first()[0] <= 50
    got = {(r["entry"], r["n"], r["top"]): r["chain"] for r in dedup.owners(entries, names, "text", 20, 2, most=20).collect()}
    assert set(got) == {(e, n, top) for _, e, n, top, _ in rows}
    texts = {e: (k, t.lower()) for k, e, _, _, t in rows}
    groups = {}
    for (e, _, _), chain in got.items():
        groups.setdefault(chain, set()).add(texts[e])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(texts.values()))


def test_different_texts_under_one_hot_key_end_the_rounds(spark):
    rows = [(7, i, 1, i, f"text {i}") for i in range(300)]
    entries = spark.createDataFrame(rows, "key long, entry long, n long, top long, text string")
    got = dedup.owners(entries, {k: k for k in ("key", "entry", "n", "top")}, "text", 20, 2, most=10).collect()
    assert sorted((r["entry"], r["chain"]) for r in got) == [(i, i) for i in range(300)]


def test_folding_changes_no_result(spark, sf, monkeypatch):
    docs = queries.documents(spark, sf).select("doc_id", "text")
    docs = docs.union(docs.limit(40)).union(docs.limit(40)).repartition(16)
    want = sorted(map(tuple, dedup.exact_duplicates(docs).collect()))
    monkeypatch.setattr(dedup, "MOST_ENTRIES", 2)
    assert sorted(map(tuple, dedup.exact_duplicates(docs).collect())) == want
