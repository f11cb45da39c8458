import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tapewright.llm import packing, queries

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, limit):
    """Brute force: the library on whole texts, cut and laid out again."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    bins = defaultdict(list)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // limit)))
        for r in own:
            part = ids[r["piece"] * limit : (r["piece"] + 1) * limit]
            assert (r["start"], r["length"]) == (r["piece"] * limit, len(part))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins), sum(r["length"] for r in rows)


def test_query_against_the_library(spark, sf):
    docs = queries.documents(spark, sf)
    rows = queries.op1_best_fit_packing(spark, sf).collect()
    bins, total = check(rows, {r.doc_id: r.text for r in docs.collect()}, 4096)
    assert bins <= -(-total // 4096) + 2


def test_edge_cases_and_residual_rounds(spark):
    rng = random.Random(3)
    texts = {i: " ".join("abcdefgh"[rng.randrange(8)] * rng.randrange(1, 9) for _ in range(rng.randrange(60))) for i in range(200)}
    texts |= {900: None, 901: "", 902: " \t\n", 903: "it's  I'LL can't Straße 12 İstanbul é <|endoftext|> x\x1cy", 904: "word " * 500, 905: "x" * 3000, 906: "a\x01b \x01 c\x01\x01", 907: "Ünï-cödé×÷Ÿ12a3 ŁÓDŹ… x²y ½ ﬁ Å e\u0301 a.b,c(d)5% \x7f\x1d <|x|> a|b don't 's x''re İi ǅ 中文字 ٣٤", 908: "the <|startoftext|>the end<|endoftext|>"}
    docs = spark.createDataFrame([(k, v, "t", 1, 2) for k, v in texts.items()], "doc_id long, text string, bin string, fill int, piece int").repartition(7)
    rows = packing.pack_sequences(docs, TOKENIZER, limit=64, slack=1).collect()
    bins, total = check(rows, texts, 64)
    assert bins <= -(-total // 64) * 1.05 + 2


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_sequences(docs, TOKENIZER).collect() == []
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c")], "doc_id long, text string")
    rows = packing.pack_sequences(docs, TOKENIZER).collect()
    assert len(rows) == 3 and sorted(r["offset"] for r in rows if r["sequence_id"] == rows[0]["sequence_id"])[0] == 0


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fills = packing.best_fit(np.array([6, 5, 4, 4, 1]), 10)
    assert bins[0] == bins[2] and bins[1] == bins[3] == bins[4]
    assert sorted(fills) == [10, 10]


def test_few_bins_a_task_still_pack_well(spark):
    """Rounds of several tasks, by chance and by fill, with places that are moved again and again."""
    docs = queries.documents(spark, "/root/testdata/sf0.01").repartition(6)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for bins_per_task in (8, 50, 50_000):
        rows = packing.pack_sequences(docs, TOKENIZER, bins_per_task=bins_per_task).collect()
        if bins_per_task == 8:
            bins, total = check(rows, texts, 4096)
        bins = len({r["sequence_id"] for r in rows})
        assert sum(r["length"] for r in rows) == total and bins <= -(-total // 4096) * 1.01 + 1
