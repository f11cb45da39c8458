import re
from collections import defaultdict

from tapewright.llm import mixing, queries


def waterfill(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        w = sum(weight[s] for s in open_)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in open_ if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_and_taken_words(spark, sf):
    docs = queries.documents(spark, sf).collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    sizes = defaultdict(int)
    for d in size:
        sizes[source[d]] += size[d]
    want = waterfill(sizes)
    rows = queries.op5_source_mixing(spark, sf).collect()
    assert rows and len(rows) == len(docs)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert r.taken <= 3 * r["size"]
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert {tuple(r) for r in rows} == {tuple(r) for r in queries.op5_source_mixing(spark, sf).collect()}


def test_hot_source_nulls_ties_and_rows(spark):
    rows = [(i, "w " * (1 + i % 7), "hot") for i in range(600)] + [(i, "w " * 5, f"s{i % 5}") for i in range(600, 700)]
    rows += [(700, None, None), (701, "a b c", None), (702, "", "zero"), (None, "x y", "s1"), (5, "w " * 6, "hot"), (5, "w " * 6, "hot")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, mix_id int, COPIES int")
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(rows)
    per = defaultdict(int)
    for r in mixed:
        per[r.source] += r.taken
    targets = {r.source: r.target for r in mixed}
    assert all(abs(per[s] - targets[s]) <= 4 for s in targets)
    assert targets["zero"] == 0 and abs(targets[None] - 9) < 1e-9
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r["copies"] for r in mixed)


def test_target_falls_among_many_rows_without_an_id(spark):
    rows = [(None, "w " * 3 + f"t{i % 50}", "a", i) for i in range(900)] + [(i, "w " * 5, "a", i) for i in range(100)] + [(i, "w " * 9, "b", i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, nr int").repartition(5, "nr")
    for seed in "ab":
        mixed = mixing.mix(docs, seed=seed).collect()
        per, target = defaultdict(int), {r.source: r.target for r in mixed}
        for r in mixed:
            per[r.source] += r.taken
        assert len(mixed) == len(rows) and all(abs(per[s] - target[s]) <= 5 for s in target)
        out = mixing.mixed_rows(docs, seed=seed).collect()
        words = defaultdict(int)
        for r in out:
            words[r.source] += len(r.text.split())
        assert words == {s: n for s, n in per.items() if n}
        assert sorted(map(str, out)) == sorted(map(str, mixing.mixed_rows(docs, seed=seed).collect()))
        times = defaultdict(int)
        for r in out:
            times[r.source, r.doc_id, r.nr] += 1
        assert all(abs(n - target[s] / sum(len(t.split()) for _, t, x, _ in rows if x == s)) < 1 for (s, *_), n in times.items())


def test_cut_is_the_one_of_a_whole_sort(spark, sf, monkeypatch):
    """Few and wide buckets give what many give."""
    want = {tuple(r) for r in queries.op5_source_mixing(spark, sf).collect()}
    monkeypatch.setattr(mixing, "BUCKETS", 8)
    monkeypatch.setattr(mixing, "SPAN", 2)
    assert {tuple(r) for r in queries.op5_source_mixing(spark, sf).collect()} == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).collect() == [] and mixing.mixed_rows(docs).collect() == []
