import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tapewright.llm import queries, spelling
from tapewright.llm.text import joined

SCHEMA = "doc_id long, text string"


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            k = h % len(w)
            w = w if h % 31 else w[:k] + w[k + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def edits(w, letters):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    return (out | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}) - {w}


def brute(rows):
    """Every edit of every word, looked up."""
    words = counted(rows)
    letters = {c for w in words for c in w}
    near = {w: edits(w, letters) & words.keys() for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def as_set(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def variants(spark, rows):
    return as_set(spelling.variants(spark.createDataFrame(rows, SCHEMA).repartition(3)))


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    got = as_set(queries.op11_spelling_variants(spark, sf))
    assert got == brute(rows) and any(r[1] for r in got)


def test_random_words_of_few_letters(spark):
    """Runs of equal letters, many neighbours, and words that both replace and shorten one another."""
    rng = random.Random(5)
    pool = ["".join(rng.choices("abé", [6, 3, 1], k=rng.randrange(6, 11))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(pool, [1 + 40 * (k % 17 == 0) for k in range(len(pool))], k=60))) for i in range(80)]
    got = variants(spark, rows)
    assert got == brute(rows) and any(r[4] > 5 for r in got) and any(r[1] for r in got)


def test_chains_of_forms(spark):
    words = [("aaaaaaab", 2), ("aaaaaabb", 40), ("aaaaabbb", 600), ("aaaabbbb", 9000), ("bbbbbbbbb", 30)]
    rows = [(i, w) for i, w in enumerate(w for w, n in words for _ in range(n))]
    got = variants(spark, rows)
    assert got == brute(rows)
    assert {r[2] for r in got if r[0] in ("aaaaaaab", "aaaaaabb", "aaaaabbb")} == {"aaaabbbb"}


def test_keys_skip_the_edited_character(spark):
    w = "tabletop"
    keys = list(spelling.rotation_keys(w))
    assert keys[2] == ("letop$ta", "b") and keys[len(w)] == ("tabletop$", "") and keys[len(w) + 3] == ("letop$tab", "")
    assert ("letop$ta", "") in spelling.rotation_keys("taletop")
    # words beyond the length that is written out: the same neighbours by hashes
    long = "".join(random.Random(1).choices("abcd", k=80))
    of = lambda x: {k for k, c in spelling.rotation_keys(x)}
    assert of(long) & of(long[:40] + "z" + long[41:]) and of(long) & of(long[:7] + long[8:]) and not of(long) & of(long[:7] + long[9:])


def test_long_runs_and_edges(spark):
    a = "".join(random.Random(2).choices("abcdef", k=64))
    long = "q" * 5 + "".join(random.Random(3).choices("xyz", k=700))
    texts = [a, a + "z", a[:9] + "y" + a[10:], a[:-1] + "zz", long, long[:100] + long[101:], long[:50] + "w" + long[51:]]
    rows = [(3 * i + k, f"{t}, 1 {t.upper() if t is a else t}") for i in range(2) for k, t in enumerate(texts)] + [(None, "É" + a + " É" + a), (5, None), (6, ""), (7, "short wörd ñandúes ñandúes")]
    assert variants(spark, rows + rows[:3]) == brute(rows + rows[:3])


def test_checksums_and_runs():
    import pyarrow as pa

    texts = ["Ab÷cd ÀÉxĀy", "", None, "ÿ", "no-Go"]
    words, length = spelling.runs(*joined(pa.array(texts)))
    assert [w.decode() for w in words.array().to_pylist()] == ["ab÷cd", "ÀÉx", "y", "ÿ", "no", "go"] and length.tolist() == [5, 3, 1, 1, 2, 2]
    ids = np.array([zlib.crc32(b"12:")] * len(words), np.uint32)
    got = spelling.checksums(words.data, words.at[:-1], words.size, ids)
    assert got.tolist() == [zlib.crc32("12:".encode() + w) for w in words.array().to_pylist()]


def test_empty_table_and_clashing_columns(spark):
    assert variants(spark, []) == set()
    rows = [(i, "friendly " * 12 + "freindly frendly") for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("word", "n", "key", "form", "root", "id"):
        docs = docs.withColumn(name, F.lit("x"))
    assert as_set(spelling.variants(docs)) == brute(rows)
