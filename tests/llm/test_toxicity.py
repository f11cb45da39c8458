import random
import zlib

import numpy as np
import pyarrow as pa

from tapewright.llm import queries, toxicity
from tapewright.llm.text import joined


def texts(n, seed, bad=("grobnak", "vilesk", "muddler")):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    out, toxic = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 150))]
        if toxic_now := i % 4 == 0:
            for _ in range(rng.randrange(2, 5)):
                text[rng.randrange(len(text))] = rng.choice(bad) + rng.choice(["", "s", "ing", "er", rng.choice("xyz") * 2])
        out.append(" ".join(text))
        toxic.append(toxic_now)
    return out, np.array(toxic)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = toxicity.Network(4, 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    vectors = rng.standard_normal((6, toxicity.WORD + toxicity.CHAR))
    vectors[-1] = 0
    index = rng.integers(0, 5, (7, 9))
    index[2, 5:] = -1
    index[3, 1:] = -1
    label, weight = rng.integers(0, 2, 7).astype(float), rng.random(7) + 0.5
    grads, d_vectors, _ = net.gradients(vectors, index, label, weight)
    loss = lambda: net.gradients(vectors, index, label, weight)[2]
    for name, g in [*grads.items(), ("vectors", d_vectors)]:
        where = vectors if name == "vectors" else net.p[name]
        for at in [tuple(rng.integers(0, s) for s in where.shape) for _ in range(6)]:
            if name == "vectors" and at[0] == 5:
                continue
            old, step = where[at], 1e-3
            where[at] = old + step
            up = loss()
            where[at] = old - step
            slope = (up - loss()) / (2 * step)
            where[at] = old
            assert abs(slope - g[at]) < 1e-3 + 0.02 * abs(slope), (name, at)


def test_windows_cover_every_word_and_overlap():
    sizes = [0, 1, 31, 32, 33, 56, 57, 500]
    data, offsets = joined(pa.array([" ".join(["w"] * n) for n in sizes]))
    inputs = toxicity.Inputs(data, offsets)
    begin, size, doc = inputs.windows()
    for d, n in enumerate(sizes):
        own = sorted(zip(begin[doc == d] - inputs.words.edges[d], size[doc == d]))
        assert bool(own) == bool(n)
        if n:
            assert own[0][0] == 0 and own[-1][0] + own[-1][1] == n and all(b < a + s for (a, s), (b, _) in zip(own, own[1:]))
    # around a chosen window every word begins one: with all chosen, every 32 words of a text are a window that is read
    near, _, owner = inputs.windows_near(begin, doc, np.ones(len(begin), bool))
    for d, n in enumerate(sizes):
        starts = {*(begin[doc == d] - inputs.words.edges[d]).tolist(), *(near[owner == d] - inputs.words.edges[d]).tolist()}
        assert starts == ({0} if 0 < n < 32 else set(range(n - 31)))
    one = np.arange(len(begin)) == np.flatnonzero(doc == 7)[5]
    near, size, owner = inputs.windows_near(begin, doc, one)
    assert set(owner) == {7} and set(size) == {32} and set(near - begin[one]) == {*range(-23, 0), *range(1, 24)}


def test_a_phrase_across_the_edge_of_windows_is_found():
    """A text whose toxic words lie half in one window and half in the next is as toxic as if they lay in one."""
    train, label = texts(600, 1)
    model = toxicity.train(pa.array(train), label)
    clean = " ".join(t for t, x in zip(train, label) if not x).split()
    at = [k for k in range(0, len(clean) - 300, 301) if model.scores(*joined(pa.array([" ".join(clean[k : k + 300])])))[0] < 0.5][:20]
    planted = [" ".join(clean[k : k + p] + ["grobnak", "vilesker"] + clean[k + p : k + 300]) for k in at for p in range(100, 148)]
    found = (model.scores(*joined(pa.array(planted))) >= 0.5).reshape(len(at), 48)
    assert found.mean(axis=0).min() >= 0.95


def test_no_key_of_a_vocabulary_is_lost():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        keys = np.concatenate((keys, keys[: n // 10] ^ np.uint64(1 << 62)))  # that fall into the same slots
        keys = rng.permutation(np.unique(keys))
        vocabulary = toxicity.Vocabulary(keys)
        assert (vocabulary(keys) == np.arange(len(keys)) + 1).all() and vocabulary.size == len(keys) + 1
        others = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        assert (vocabulary(others[~np.isin(others, keys)]) == 0).all()


def plain_logit(model, words):
    """One window, word by word, with nothing but loops and dot products."""
    net = model.network
    vectors = []
    for w in words:
        inputs = toxicity.Inputs(*joined(pa.array([w])))
        grams = model.grams(inputs.gram_keys)
        chars = sum((net.p["gram"][g].astype(float) for g in grams), np.zeros(toxicity.CHAR)) / np.sqrt(max(1, len(grams)))
        vectors.append(np.concatenate((net.p["word"][model.words(inputs.keys)[0]], chars)))
    h = toxicity.STATE
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    sides = []
    for side, order in enumerate((vectors, vectors[::-1])):
        state, states = np.zeros(h), []
        for v in order:
            x, u = v @ net.p["in"][side] + net.p["bias"][side], state @ net.p["over"][side]
            z, r = sigmoid(x[:h] + u[:h]), sigmoid(x[h : 2 * h] + u[h : 2 * h])
            state = z * state + (1 - z) * np.tanh(x[2 * h :] + r * u[2 * h :])
            states.append(state)
        sides.append(states if side == 0 else states[::-1])
    both = [np.concatenate(pair) for pair in zip(*sides)]
    weight = np.exp([s @ net.p["ask"] for s in both])
    return float(sum(w * s for w, s in zip(weight / weight.sum(), both)) @ net.p["out"] + net.p["rest"][0])


def test_scores_against_a_plain_loop():
    """Scores of whole texts against windows read one at a time, word by word, with every window in doubt."""
    train, label = texts(200, 5)
    model = toxicity.train(pa.array(train), label)
    some = [t for t in train[:10]] + ["", "one", " ".join(train[:2])]
    model.doubt = -np.inf
    got = model.scores(*joined(pa.array(some)))
    for t, score in zip(some, got):
        words = t.split()
        if not words:
            assert score == 0
            continue
        logits = [plain_logit(model, words[k : k + toxicity.WINDOW]) for k in range(max(1, len(words) - toxicity.WINDOW + 1))]
        chance = lambda x: 1 / (1 + np.exp(-(model.fit[0] * x + model.fit[1])))
        coarse = max(logits[k] for k in {*range(0, len(logits), toxicity.STRIDE), len(logits) - 1})
        # a text that is toxic by the windows 24 apart has the score of the highest of these
        assert abs(score - chance(coarse if chance(coarse) >= 0.5 else max(logits))) < 1e-3


def test_learns_and_reads_long_texts_to_their_end():
    train, label = texts(600, 1)
    model = toxicity.train(pa.array(train), label)
    held, want = texts(400, 1)[0][200:] + texts(200, 2)[0], None
    want = np.concatenate((texts(400, 1)[1][200:], texts(200, 2)[1]))
    got = model.scores(*joined(pa.array(held))) >= 0.5
    assert (got == want).mean() > 0.93
    clean = " ".join(t for t, x in zip(train, label) if not x)
    late = model.scores(*joined(pa.array([clean, clean + " grobnaks vilesker", "", None, "!!", "echo " * 900])))
    assert late[1] > late[0] and late[1] >= 0.5 and (late[2:5] == 0).all()


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op3_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert sum(p == t for p, t in held) / len(held) > 0.9


def test_training_is_bounded_in_bytes(spark, monkeypatch):
    """One text of many MB among the labelled ones is not learned from; the others are."""
    train, label = texts(80, 1)
    rows = [(i, t) for i, t in enumerate(train)] + [(1000, "grobnak " * 400_000), (1000, "a repeated id")]
    monkeypatch.setattr(toxicity, "MOST_BYTES", 2_000_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(x)) for i, x in enumerate(label)] + [(1000, 1)], "doc_id long, toxic int")
    model = toxicity.fitted(docs, labels)
    assert model is not None and len(model) < 5_000_000
    scores = {r.doc_id: r.score for r in toxicity.score(docs.where("doc_id < 1000"), labels, model=model).collect()}
    assert len(scores) == 80


def test_edge_cases(spark):
    docs = spark.createDataFrame([(None, None, 1), (2, "", 2), (2, "a b", 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    out = toxicity.score(docs, labels, carry=True)
    assert out.columns == ["doc_id", "text", "score", "held_out", "_score", "predicted"]
    assert [r["_score"] for r in out.collect()] == [0.0] * 3
    assert toxicity.score(docs.limit(0), labels.limit(0)).collect() == []


def test_held_out_recall_and_precision(spark):
    """On labelled rows that training has not seen; never calling a text toxic would have recall 0."""
    sf = "/root/testdata/sf0.1"
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op3_toxicity(spark, sf).collect() if r.held_out and label.get(r.doc_id) in (0, 1)]
    found = sum(r.predicted and label[r.doc_id] for r in rows)
    assert found >= 0.75 * sum(label[r.doc_id] for r in rows) and found >= 0.75 * sum(r.predicted for r in rows)
