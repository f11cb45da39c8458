import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tapewright.llm import decontamination, queries
from tapewright.llm.decontamination import Grams

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = re.findall(WORD, lower(text))
        for i in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item_id)
    sizes = {len(g) for g in windows}
    out = []
    for doc_id, text in docs:
        w = re.findall(WORD, lower(text))
        hit, found = set(), set()
        for s in sizes:
            for i in range(len(w) - s + 1):
                ids = windows.get(tuple(w[i : i + s]))
                if ids is not None:
                    hit |= set(range(i, i + s))
                    found |= {str(x) for x in ids if x is not None}
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def got(found):
    return sorted((tuple(r) for r in decontamination.digest(found).collect()), key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


def made(seed=1):
    """Few words, so that windows overlap, repeat and share hashes; items of one to thirty words."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "cc", "é", "7", "ße"])
    text = lambda n: "".join(word() + rng.choice([" ", "\n", "-", "_. "]) for _ in range(n))
    items = [(i, text(rng.choice([3, 5, 9, 10, 11, 14, 30]))) for i in range(40)]
    docs = [(i, text(rng.randrange(60)) + (rng.choice(items)[1].upper().replace("É", "é") if i % 3 == 0 else "") + text(rng.randrange(9))) for i in range(80)]
    return docs, items


@pytest.mark.parametrize("most", [decontamination.MOST_GRAMS, 0])
def test_both_ways_against_brute_force(spark, most):
    docs, items = made()
    items += [(7, "wholly another text of item seven"), (None, "a cc é 7 7 a"), (50, ""), (51, None), (52, "?!"), (8, items[8][1])]
    docs += [(None, items[3][1]), (1, docs[1][1]), (200, None), (201, ""), (202, "... -- ?")]
    want = brute(docs, items)
    d, i = frames(spark, docs, items)
    assert got(decontamination.find(d, i, most=most, bits=20)) == want and any(r[-1] for r in want) and not all(r[-1] for r in want)


@pytest.mark.parametrize("most", [decontamination.MOST_GRAMS, 0])
def test_empty_tables_and_long_text(spark, most):
    docs, items = made(2)
    d, i = frames(spark, docs, items)
    assert got(decontamination.find(d.limit(0), i, most=most, bits=20)) == []
    assert got(decontamination.find(d, i.limit(0), most=most, bits=20)) == brute(docs, [])
    long = [(1, "zz " * 400_000 + items[0][1] + " yy" * 400_000)]
    d, i = frames(spark, long, [(1, "one two three four five six seven eight nine ten zz"), items[0]])
    assert got(decontamination.find(d, i, most=most, bits=20)) == brute(long, [(1, "one two three four five six seven eight nine ten zz"), items[0]])


def test_hashes_that_several_windows_share():
    """Six bits for some hundred windows: every lookup meets others, and the bytes decide."""
    import pyarrow as pa

    docs, items = made(3)
    grams, names = [], []
    for item_id, text in items:
        w = re.findall(WORD, lower(text))
        for i in range(len(w) - min(10, len(w)) + 1 if w else 0):
            grams.append(" ".join(w[i : i + 10]).encode())
            names.append(str(item_id))
    words = decontamination.words_of(pa.array([t for _, t in docs]))
    few, all_ = Grams(grams, names, bits=6), Grams(grams, names)
    read = lambda g: {(int(a), bytes(g.data[g.at[e] : g.at[e + 1]])) for a, e in zip(*g.occurrences(words))}
    assert read(few) == read(all_) and read(all_)


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in queries.op12_benchmark_decontamination(spark, sf).collect()), key=repr)
    assert rows == brute(docs, items)


@pytest.mark.parametrize("most", [decontamination.MOST_GRAMS, 0])
def test_cleaning(spark, most):
    item = "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf"
    docs = [(1, f"Davor, {item.upper().replace('Ü', 'ü').replace('Ö', 'ö')}! Danach."), (2, "nichts davon"), (3, None), (4, f"{item} {item}"), (5, f"x {item}; y; {item} z")]
    d, i = frames(spark, docs, [(9, item)])
    for name in ("n_words", "spans", "items", "row", "maybe", "_text"):
        d = d.withColumn(name, F.lit("mine"))
    kept = decontamination.clean(d, i, "documents", most=most, bits=20)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {2, 3} and {r.spans for r in kept.collect()} == {"mine"}
    cut = decontamination.clean(d, i, "spans", most=most, bits=20)
    assert cut.columns == d.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Davor, ! Danach.", 2: "nichts davon", 3: None, 4: "", 5: "x ; y;  z"}
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in decontamination.find(d, i, most=most, bits=20).collect()}
    assert spans[4] == [(0, 24, 0, 2 * len(item.encode()) + 1)] and len(spans[5]) == 2 and spans[2] == []
