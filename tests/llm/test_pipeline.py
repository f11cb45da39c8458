import os
import re
import threading
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tapewright.llm import shared, toxicity

from .test_dedup import lower
from .test_near_dedup import brute as near_classes


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    rows = docs.collect()

    def apply(name, rows):
        out = stages[name](spark, spark.createDataFrame(rows, docs.schema).repartition(3), sf)
        return out, [tuple(r) for r in out.collect()]

    out, kept = apply("toxicity", rows)
    assert out.columns == columns
    scored = toxicity.score(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    clean = {r.doc_id for r in scored if r.predicted == 0}
    assert {r[0] for r in kept} == clean and len(kept) == len(clean)
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert sum(label.get(r[0]) == 0 for r in kept) >= 0.95 * sum(t == 0 for t in label.values())

    rows, (out, kept) = kept, apply("exact_dedup", kept)
    largest = {}
    for r in rows:
        key = lower(r[1])
        largest[key] = max(largest.get(key, -1), r[0])
    assert out.columns == columns and sorted(r[0] for r in kept) == sorted(largest.values())
    assert set(kept) <= set(rows)

    rows, (out, kept) = kept, apply("near_dedup", kept)
    classes = [{rows[m][0] for m in members} for members in near_classes([(r[0], r[1]) for r in rows])]
    ids = {r[0] for r in kept}
    assert out.columns == columns and len(kept) == len(classes) and all(len(c & ids) == 1 for c in classes)

    rows, (out, kept) = kept, apply("mixing", kept)
    copies = Counter(kept)
    assert out.columns == columns and set(copies) <= set(rows) and max(copies.values()) <= 3
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    size, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        size[r[3]] += words(r)
    for r, n in copies.items():
        taken[r[3]] += n * words(r)
    assert abs(sum(taken.values()) / sum(size.values()) - 1) < 0.05

    rows, (_, pieces) = kept, apply("packing", kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    length = {r: len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in set(rows)}
    bins = defaultdict(list)
    for p in pieces:
        bins[p[5]].append((p[6], p[3]))
    assert sum(n for places in bins.values() for _, n in places) == sum(length[r] for r in rows)
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(bins) <= -(-sum(length[r] for r in rows) // 4096) + 2


def test_registered(spark):
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {q if q == "pipeline" else q.split("_")[0] + "_" for q in __spark_entry__.queries()}


def test_stages_on_nulls_repeats_clashing_columns_and_empty_tables(spark):
    sf = "/root/testdata/sf0.001"
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    rows = [(1, "same text here", "en", "a"), (2, "SAME text here", "en", None), (2, "SAME text here", "en", None), (None, None, None, None), (None, "", None, "a"), (5, long, "en", "a"), (6, long + " tail", "de", "b"), (7, "one two three four five six seven", "en", "b")]
    extra = "row long, key string, predicted int, bin long, same string, _id int"
    docs = spark.createDataFrame([(*r, 1, "k", 0, 3, "s", 9) for r in rows], f"doc_id long, text string, lang string, source string, {extra}").repartition(3)
    want = {"toxicity": 8, "exact_dedup": 5, "near_dedup": 4}  # nulls and empty texts are one, so are the copies; the long ones are near copies
    for name, stage in corpus_pipeline.STAGES[:-1]:
        none = stage(spark, docs.limit(0), sf)
        assert none.columns == docs.columns and none.collect() == []
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        kept = out.collect()
        if name in want:
            assert len(kept) == want[name], name
        assert {tuple(r) for r in kept} <= {(*r, 1, "k", 0, 3, "s", 9) for r in rows}
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs.limit(0), sf).collect() == []
    pieces = stage(spark, docs, sf).collect()
    assert sum(p["piece"] == 0 for p in pieces) == len(rows) and max(p["piece"] for p in pieces) > 10


def test_a_run_leaves_only_its_result(spark, tmp_path):
    with shared.collecting() as made:
        out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    path = spark._jvm.org.apache.hadoop.fs.Path
    there = [f for f in made if path(f).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(f))]
    assert len(there) == 1


def test_stages_without_a_write_in_between(spark):
    """All five, one on another's result; and two runs at a time, neither of which removes what the other reads."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    pieces = lambda df: sorted(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in df.collect())
    got = pieces(docs)
    with ThreadPoolExecutor(2) as pool:
        runs = list(pool.map(lambda _: pieces(corpus_pipeline.run(spark, sf)), range(2)))
    assert got and runs == [got, got]


def test_a_stage_removes_what_earlier_ones_left_once_it_is_not_read(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    deduped = stages["exact_dedup"](spark, docs, sf)
    left = [f for at, f in corpus_pipeline._left[spark.sparkContext.applicationId, sf, threading.get_ident()] if at == 1]
    there = lambda f: os.path.exists(f.split(":", 1)[-1])
    assert left and all(map(there, left)) and shared.folders_read(docs) == [f"file:{sf}/documents.parquet"]
    stages["near_dedup"](spark, deduped, sf)
    assert any(map(there, left))
    deduped.write.parquet(str(tmp_path / "kept"))
    stages["mixing"](spark, spark.read.parquet(str(tmp_path / "kept")), sf)
    assert not any(map(there, left))
