import random

import numpy as np

from tapewright.llm import dart_minhash, near_dedup, queries
from tapewright.llm.text import LOWER  # noqa: F401


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, similarity=0.8):
    """Components of all pairs of texts."""
    texts = {}
    for i, (_, t) in enumerate(rows):
        texts.setdefault(shingles(t), []).append(i)
    sets = list(texts)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and common >= similarity * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                parent[root(i)] = root(j)
    classes = {}
    for i, s in enumerate(sets):
        classes.setdefault(root(i), []).extend(texts[s])
    return classes.values()


def same_classes(rows, out):
    want = {}
    for members in brute(rows):
        ids = [rows[m][0] for m in members]
        for m in members:
            want[rows[m][0]] = (min(ids), len(members))
    assert {r["doc_id"]: (r["class_id"], r["class_size"]) for r in out} == want
    assert sum(r["kept"] for r in out) == len(list(brute(rows)))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    items = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    x, y = rng.random(300) * 3, rng.random(300) * 3
    s = dart_minhash.signatures(np.concatenate((items, items)), np.concatenate((x, y)), np.repeat([0, 1], 300), 2, 2000)
    assert abs((s[0] == s[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum()) < 0.05
    alone = dart_minhash.signatures(items, y, np.zeros(300, int), 1, 2000)
    assert (alone[0] == s[1]).all()


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    same_classes(rows, queries.op7_minhash_near_dedup(spark, sf).collect())


def test_planted_copies_and_edge_cases(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows = []
    for family in range(6):
        base = [word() for _ in range(120)]
        for copy in range(12):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + k, " ".join([word() for _ in range(100)] + passage)) for k in range(30)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "one two"), (1004, "One Two"), (1005, "one two three"), (1006, "long words " * 3000)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, same string, ROW long, bands int").repartition(6)
    same_classes(rows, near_dedup.near_duplicates(docs).collect())
    stay = near_dedup.kept_rows(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len(list(brute(rows)))


def test_rows_outside_the_main_component_meet_all_rows(spark):
    """A bucket of many texts whose leader is not similar to two texts that are similar to each other."""
    sig = lambda k: bytes([k] * 96)
    rows = [(1, n, bytes([n % 251, n // 251]), sig(n % 200 if n < 600 else 255), n if n >= 600 else 0) for n in range(602)]
    cells = spark.createDataFrame(rows, "bucket long, node long, same binary, signature binary, label long")
    shingles = lambda n: np.arange(600 if n >= 600 else n, (600 if n >= 600 else n) + 10, dtype=np.uint64).tobytes()
    sets = spark.createDataFrame([(r[2], shingles(r[1])) for r in rows], "same binary, shingles binary")
    got = {tuple(sorted((r["a"], r["b"]))) for r in near_dedup._rest_of_buckets(cells, sets, 0.8).collect()}
    assert got == {(600, 601)}


def test_a_chain_is_one_class_and_loose_relatives_are_not(spark):
    """Texts where each is similar to its neighbours only, and texts with half of their words in common."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 100])) for i in range(40)]
    rows += [(100 + i, " ".join([f"common{k}" for k in range(70)] + [f"own{i}x{k}" for k in range(25)])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same_classes(rows, near_dedup.near_duplicates(docs).collect())


def test_null_and_repeated_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "A b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "other words here now and then")], "doc_id long, text string")
    out = near_dedup.near_duplicates(docs).collect()
    assert sorted((r["class_id"], r["class_size"], r["kept"]) for r in out) == [(3, 4, False)] * 3 + [(3, 4, True), (4, 1, True)]
    assert near_dedup.kept_rows(docs).count() == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(empty).collect() == [] and near_dedup.kept_rows(empty).collect() == []


def test_components_in_one_task_and_by_stars(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(90)] + [(1000, 1001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for x in parent if root(x) != x}
    table = spark.createDataFrame(edges, "a long, b long")
    for few in (0, 1_000_000):
        found = near_dedup.components(table, few=few).collect()
        assert len(found) == len(want) and {r["node"]: r["label"] for r in found} == want
    assert near_dedup.components(table.limit(0), few=0).collect() == []
