"""Toxicity scores from a bidirectional gated recurrent network over words and characters, in numpy.

Words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased. The input of a word is its word vector
(words of the training sample that are not rare) and the sum of the vectors of its character n-grams of 3 to 5 bytes with
its ends marked, over the root of their number. Two gated recurrent layers read each window of 32 words forwards
and backwards; attention pools their states, and the pooled state gives the window's logit. A text has the score
of its highest window. Windows begin every 24 words, and the last one ends with the text, so all words of texts of any
length are read, in overlapping windows; in texts that are not toxic by these, around each window in doubt (higher than all
but a few of clean documents) those that begin at every word are read too. So a phrase that lies across the edge of two windows is whole in
one that is read, unless what each of the two holds of it looks as clean as clean texts do.

Training: labelled rows whose crc32(doc_id as text) mod 5 is not 0, of these at most `MOST_TOXIC` and `MOST_CLEAN`
documents and `MOST_BYTES` of text (by a hash of the id; an id that repeats gives one of its texts). One task trains on that bounded sample, which keeps the driver free of texts; the model
is a few MB and is broadcast. First windows of toxic documents are chosen by the log odds of their words and n-grams,
which also start the vectors; then by the network itself (the document is as toxic as its worst window). All
weights and vectors are trained by Adam. A logistic fit over documents, a fifth of which the network has
not seen, turns the highest logit into the score.

Defined cases: null and empty texts, and texts without words, have score 0. Ids may be null (held out, as their text is
empty) or repeat. If labels has no toxic or no clean row to learn from, every score is 0. Empty tables give no rows.
Further columns are not read; labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .language_model import held_out
from .shared import free_name, stored
from .text import LOWER, Words, blocks, held, joined, mix, ragged

#: Words of a window, and how far windows are apart.
WINDOW, STRIDE = 32, 24
#: Documents that training reads at most.
MOST_TOXIC, MOST_CLEAN = 1500, 2500
#: Bytes of text that training reads at most.
MOST_BYTES = 40_000_000
#: The share of windows of clean documents that are in doubt.
DOUBTFUL = 0.005
#: Width of word and character vectors, and of the state of each direction.
WORD, CHAR, STATE = 8, 8, 16
#: Windows that are read side by side, windows of a training step, and least number of steps.
LANES, BATCH, STEPS = 4096, 256, 240
HELD_OUT = 5
#: Documents of the training sample that a word must be in to have a vector; n-grams need twice as many.
LEAST = 3

#: Documents whose n-grams are counted at a time.
RUN = 100

PARTING = np.ones(256, bool)
PARTING[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _summed(rows: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of each index."""
    out = np.zeros((size, rows.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1]))) if len(index) else np.empty(0, np.int64)
    if len(first):
        out[index[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Vocabulary:
    """Numbers (from 1) of known distinct 64-bit keys; 0 for all others. A key whose slot is taken goes to the next free one."""

    def __init__(self, keys: np.ndarray):
        bits = max(10, int(len(keys) * 8).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.tag, self.number = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            slot = keys[left] + np.uint64(self.probes) & self.mask
            free = np.flatnonzero(self.number[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.tag[slot[placed]], self.number[slot[placed]] = keys[left[placed]], left[placed] + 1
            left, self.probes = np.delete(left, placed), self.probes + 1
        self.size = len(keys) + 1

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys), np.int32), np.arange(len(keys))
        for k in range(self.probes):
            slot = keys[left] + np.uint64(k) & self.mask
            number = self.number[slot]
            same = self.tag[slot] == keys[left]
            out[left[same]] = number[same]
            left = left[~same & (number > 0)]
            if not len(left):
                break
        return out


class Inputs:
    """Distinct words of a block: their hashes, and the keys of their n-grams with the word of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(LOWER[data], offsets, PARTING)
        each = self.words.hashes()
        self.keys, first, self.index = np.unique(each, return_index=True, return_inverse=True)
        size = self.words.size[first]
        at = np.concatenate(([0], np.cumsum(size + 2)))
        text = np.full(at[-1], ord("<"), np.uint64)
        text[at[1:] - 1] = ord(">")
        inner = ragged(at[:-1] + 1, size)
        text[inner] = self.words.data[ragged(self.words.at[first], size)]
        owner = np.repeat(np.arange(len(first)), size + 2)
        grams, owners = [], []
        for n in (3, 4, 5):
            if len(text) >= n:
                key = np.full(len(text) - n + 1, n << 40, np.uint64)
                for k in range(n):
                    key |= text[k : len(text) - n + 1 + k] << np.uint64(8 * k)
                whole = owner[: len(key)] == owner[n - 1 :]
                grams.append(mix(key[whole]))
                owners.append(owner[: len(key)][whole])
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(owner, kind="stable")
        self.gram_owner = owner[order]
        self.gram_keys = np.concatenate(grams)[order] if grams else np.empty(0, np.uint64)
        self.gram_count = np.bincount(self.gram_owner, minlength=len(first))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words, and text of each window."""
        per = self.words.per
        count = np.where(per > 0, np.maximum(1, -(-(per - WINDOW) // STRIDE) + 1), 0)
        doc = np.repeat(np.arange(len(per)), count)
        begin = np.minimum(ragged(np.zeros(len(per), np.int64), count) * STRIDE, np.maximum(0, per[doc] - WINDOW))
        return self.words.edges[:-1][doc] + begin, np.minimum(WINDOW, per[doc]), doc

    def windows_near(self, begin: np.ndarray, doc: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whole windows that begin at any word nearer to a chosen window than the next one is, other than the given ones."""
        at, text = begin[chosen], doc[chosen]
        first, last = self.words.edges[:-1][text], self.words.edges[1:][text] - WINDOW
        low, high = np.maximum(first, at - STRIDE + 1), np.minimum(last, at + STRIDE - 1)
        found = np.unique(ragged(low, np.maximum(0, high - low + 1)))
        found = found[~np.isin(found, begin)]
        return found, np.full(len(found), WINDOW), self.words.doc[found]


class Network:
    def __init__(self, words: int, grams: int, seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        d, h = WORD + CHAR, STATE
        self.p = {
            "word": normal(words, WORD, scale=0.05), "gram": normal(grams, CHAR, scale=0.05),
            "in": normal(2, d, 3 * h, scale=1 / np.sqrt(d)), "bias": np.zeros((2, 3 * h), np.float32), "over": normal(2, h, 3 * h, scale=1 / np.sqrt(h)),
            "ask": normal(2 * h, scale=0.3), "out": normal(2 * h, scale=0.3), "rest": np.zeros(1, np.float32),
        }
        self.p["word"][0] = self.p["gram"][0] = 0

    def vectors(self, word: np.ndarray, gram: np.ndarray, owner: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Inputs of distinct words; row -1 is that of a place without a word."""
        out = np.zeros((len(word) + 1, WORD + CHAR), np.float32)
        out[:-1, :WORD] = self.p["word"][word]
        if len(gram):
            full = np.flatnonzero(count)
            first = np.searchsorted(owner, full)
            out[full, WORD:] = np.add.reduceat(self.p["gram"][gram], first, axis=0) / np.sqrt(count[full])[:, None]
        return out

    def read(self, given: np.ndarray, index: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States (time, lane, 2H), attention (time, lane) and logits. given: (2, words + 1, 3H); index -1: no word."""
        lanes, h = len(index), STATE
        steps = index.shape[1]
        states = np.empty((steps, lanes, 2 * h), np.float32)
        there = index >= 0
        full = there.all()
        for side, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            state = np.zeros((lanes, h), np.float32)
            over = self.p["over"][side]
            for t in order:
                x, u = given[side][index[:, t]], state @ over
                gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
                z, r, inner = gates[:, :h], gates[:, h:], u[:, 2 * h :]
                n = np.tanh(x[:, 2 * h :] + r * inner)
                new = n + z * (state - n)
                if not full:
                    new = np.where(there[:, t, None], new, state)
                if keep is not None:
                    keep.append((side, t, state, z, r, inner, n))
                states[t, :, side * h : (side + 1) * h] = state = new
        scores = states @ self.p["ask"]
        if not full:
            scores = np.where(there.T, scores, np.float32(-1e9))
        attention = np.exp(scores - scores.max(axis=0))
        attention /= attention.sum(axis=0)
        pooled = np.einsum("tl,tlh->lh", attention, states)
        return states, attention, pooled @ self.p["out"] + self.p["rest"]

    def given(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([vectors @ self.p["in"][s] + self.p["bias"][s] for s in (0, 1)])

    def gradients(self, vectors: np.ndarray, index: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradients of the weighted cross entropy, those of the vectors, and the loss."""
        h, p, keep = STATE, self.p, []
        states, attention, logit = self.read(self.given(vectors), index, keep)
        chance = _sigmoid(logit)
        d_logit = ((chance - label) * weight / weight.sum()).astype(np.float32)
        pooled = np.einsum("tl,tlh->lh", attention, states)
        g = {k: np.zeros_like(p[k]) for k in ("in", "bias", "over")}
        g["out"], g["rest"] = d_logit @ pooled, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"]
        through = np.einsum("tlh,lh->tl", states, d_pooled)
        d_scores = attention * (through - (attention * through).sum(axis=0))
        g["ask"] = np.einsum("tl,tlh->h", d_scores, states)
        d_states = attention[:, :, None] * d_pooled + d_scores[:, :, None] * p["ask"]
        there = index >= 0
        d_inputs = np.empty((2, index.shape[1], len(index), 3 * h), np.float32)
        carry = None
        for side, t, before, z, r, inner, n in reversed(keep):
            if t == (index.shape[1] - 1 if side == 0 else 0):
                carry = np.zeros((len(index), h), np.float32)
            d = d_states[t, :, side * h : (side + 1) * h] + carry
            live = there[:, t, None]
            dz, dn = d * (before - n) * z * (1 - z), d * (1 - z) * (1 - n * n)
            dr, d_inner = dn * inner * r * (1 - r), dn * r
            d_x = np.where(live, np.concatenate((dz, dr, dn), axis=1), 0)
            d_u = np.where(live, np.concatenate((dz, dr, d_inner), axis=1), 0)
            carry = np.where(live, d * z, d) + d_u @ p["over"][side].T
            g["over"][side] += before.T @ d_u
            d_inputs[side, t] = d_x
        place = index.T.ravel() % len(vectors)  # -1, no word, is the last row
        d_given = np.stack([_summed(x.reshape(-1, 3 * h), place, len(vectors)) for x in d_inputs])
        d_given[:, -1] = 0
        d_vectors = np.zeros_like(vectors)
        for side in (0, 1):
            g["in"][side] = vectors.T @ d_given[side]
            g["bias"][side] = d_given[side].sum(axis=0)
            d_vectors += d_given[side] @ p["in"][side].T
        loss = float(-(weight * np.log(np.where(label > 0, chance, 1 - chance) + 1e-9)).sum() / weight.sum())
        return g, d_vectors, loss


class Model:
    """A network with its vocabularies and the fit that turns logits into scores."""

    network: Network
    words: Vocabulary
    grams: Vocabulary
    fit: tuple[float, float] = (1.0, 0.0)
    #: The logit from which a window is in doubt.
    doubt: float = np.inf

    def logits(self, inputs: Inputs, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        given = self.network.given(self.network.vectors(self.words(inputs.keys), self.grams(inputs.gram_keys), inputs.gram_owner, inputs.gram_count))
        out = np.empty(len(begin), np.float32)
        # short windows apart from whole ones, which need no masks
        order = np.argsort(size < WINDOW, kind="stable")
        place = np.arange(WINDOW)
        whole = int((size == WINDOW).sum())
        for a, b in [(k, min(whole, k + LANES)) for k in range(0, whole, LANES)] + [(k, min(len(order), k + LANES)) for k in range(whole, len(order), LANES)]:
            some = order[a:b]
            at = np.minimum(begin[some, None] + place, len(inputs.index) - 1)
            index = np.where(place < size[some, None], inputs.index[at], -1)
            out[some] = self.network.read(given, index)[2]
        return out

    def _look_closer(self, inputs: Inputs, highest: np.ndarray, begin: np.ndarray, doc: np.ndarray, doubtful: np.ndarray) -> None:
        """Raise the highest logits of texts to those of the windows around doubtful ones."""
        begin, size, doc = inputs.windows_near(begin, doc, doubtful)
        np.maximum.at(highest, doc, self.logits(inputs, begin, size).astype(np.float64))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        inputs = Inputs(data, offsets)
        highest = np.full(len(offsets) - 1, -np.inf)
        if len(inputs.words):
            begin, size, doc = inputs.windows()
            value = self.logits(inputs, begin, size)
            np.maximum.at(highest, doc, value.astype(np.float64))
            # a text that is toxic already needs no closer look
            self._look_closer(inputs, highest, begin, doc, (value >= self.doubt) & (self.fit[0] * highest[doc] + self.fit[1] < 0))
        with np.errstate(over="ignore"):
            return np.where(np.isfinite(highest), 1 / (1 + np.exp(-(self.fit[0] * np.where(np.isfinite(highest), highest, 0) + self.fit[1]))), 0.0)


def _telling(bad: np.ndarray, all_: np.ndarray, toxic: int, clean: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that at least ``least`` documents have, the most telling first, and their log odds."""
    odds = np.log((bad + 0.5) / (toxic + 1)) - np.log((all_ - bad + 0.5) / (clean + 1))
    found = np.flatnonzero(all_ >= least)
    found = found[np.argsort(-np.abs(odds[found]) * np.sqrt(all_[found]), kind="stable")]
    return found, np.clip(odds[found], -3, 8)


def train(texts: pa.Array, toxic: np.ndarray, odds: bool = True) -> Model:
    """Fit a model to labelled texts; see the module's text. Without ``odds`` vectors and first windows start by chance."""
    inputs = Inputs(*joined(texts))
    begin, size, doc = inputs.windows()
    docs = len(toxic)
    seen = np.arange(docs) % 5 != 4  # the others only serve the last fit
    word_doc = inputs.words.doc
    fit_words = seen[word_doc]
    model = Model()
    # documents with each word and each n-gram; n-grams in runs of pairs, so that memory stays small
    pairs = np.unique(word_doc[fit_words] * len(inputs.keys) + inputs.index[fit_words])
    word, its = pairs % len(inputs.keys), pairs // len(inputs.keys)
    totals = int((toxic & seen).sum()), int((~toxic & seen).sum())
    place, word_odds = _telling(np.bincount(word, toxic[its], minlength=len(inputs.keys)), np.bincount(word, minlength=len(inputs.keys)), *totals, LEAST)
    model_keys = inputs.keys[place]
    model.words = Vocabulary(model_keys)
    grams, number = np.unique(inputs.gram_keys, return_inverse=True)
    bad, all_ = np.zeros(len(grams)), np.zeros(len(grams), np.int64)
    gram_first, edges = np.searchsorted(inputs.gram_owner, np.arange(len(inputs.keys))), np.searchsorted(its, np.arange(0, docs + RUN, RUN))
    for a, b in zip(edges, edges[1:]):
        count = inputs.gram_count[word[a:b]]
        both = np.unique(np.repeat(its[a:b], count) * len(grams) + number[ragged(gram_first[word[a:b]], count)])
        all_ += np.bincount(both % len(grams), minlength=len(grams))
        bad += np.bincount(both % len(grams), toxic[both // len(grams)], minlength=len(grams))
    place, gram_odds = _telling(bad, all_, *totals, 2 * LEAST)
    grams = grams[place]
    model.grams = Vocabulary(grams)
    net = model.network = Network(len(model_keys) + 1, len(grams) + 1)
    if odds:
        net.p["word"][1:, 0], net.p["gram"][1:, 0] = word_odds / 3, gram_odds / 3

    word_ids, gram_ids = model.words(inputs.keys), model.grams(inputs.gram_keys)
    start = net.vectors(word_ids, gram_ids, inputs.gram_owner, inputs.gram_count)
    telling = np.maximum(0, start[:-1, 0] + start[:-1, WORD])[inputs.index]
    sums = np.concatenate(([0], np.cumsum(telling)))
    value = sums[begin + size] - sums[begin]
    rng = np.random.Generator(np.random.PCG64(11))
    if not odds:
        value = rng.random(len(begin))
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for turn in range(3):
        order = np.lexsort((-value, doc))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.searchsorted(doc, np.arange(docs))[doc[order]]
        chosen = seen[doc] & np.where(toxic[doc], rank == 0, (rank == 0) | (rng.random(len(doc)) < 3 / np.maximum(1, np.bincount(doc, minlength=docs)[doc])))
        chosen = np.flatnonzero(chosen)
        label = toxic[doc[chosen]].astype(np.float32)
        weight = np.where(label > 0, (label == 0).sum() / max(1, label.sum()), 1.0)
        weight = np.minimum(weight, 4.0).astype(np.float32)
        rounds = max(2, -(-STEPS // 3 * BATCH // max(1, len(chosen))))
        for _ in range(rounds):
            shuffled = rng.permutation(len(chosen))
            for k in range(0, len(chosen), BATCH):
                some = chosen[shuffled[k : k + BATCH]]
                place = np.arange(WINDOW)
                at = np.minimum(begin[some, None] + place, len(inputs.index) - 1)
                index = np.where(place < size[some, None], inputs.index[at], -1)
                used, back = np.unique(index[index >= 0], return_inverse=True)
                local = np.full(index.shape, -1)
                local[index >= 0] = back
                g_first, g_count = np.searchsorted(inputs.gram_owner, used), inputs.gram_count[used]
                gram, owner = gram_ids[ragged(g_first, g_count)], np.repeat(np.arange(len(used)), g_count)
                vectors = net.vectors(word_ids[used], gram, owner, g_count)
                grads, d_vectors, _ = net.gradients(vectors, local, label[shuffled[k : k + BATCH]], weight[shuffled[k : k + BATCH]])
                grads["word"] = _summed(d_vectors[:-1, :WORD], word_ids[used], len(net.p["word"]))
                grads["gram"] = _summed((d_vectors[:-1, WORD:] / np.sqrt(np.maximum(1, g_count))[:, None])[owner], gram, len(net.p["gram"]))
                grads["word"][0] = grads["gram"][0] = 0
                step += 1
                for name, g in grads.items():
                    m, v = state[name]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    net.p[name] -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        value = model.logits(inputs, begin, size).astype(np.float64)
    highest = np.full(docs, -np.inf)
    np.maximum.at(highest, doc, value)
    model.doubt = float(np.quantile(value[~toxic[doc]], 1 - DOUBTFUL))
    model._look_closer(inputs, highest, begin, doc, value >= model.doubt)
    has = np.isfinite(highest)
    model.fit = _logistic(highest[has], toxic[has], np.where(seen[has], 1.0, 4.0))
    model.doubt = min(model.doubt, -model.fit[1] / model.fit[0])  # no higher than where a text is called toxic
    return model


def _logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with a ridge on the slope so that separable data have a finite fit."""
    slope, rest = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + rest, -500, 500)))
        w = weight * p * (1 - p)
        g = np.array([(weight * (p - label) * x).sum() + 0.05 * slope, (weight * (p - label)).sum()])
        hess = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        change = np.linalg.solve(hess, g)
        change /= max(1.0, np.abs(change).max())
        slope, rest = max(1e-3, slope - change[0]), rest - change[1]
    return float(slope), float(rest)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> bytes | None:
    """A model from the labelled rows that are not held out, pickled; None if one of the classes is missing."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic")).where("_id is not null and _toxic in (0, 1)")
    known = known.where(F.crc32(F.col("_id").cast("string").cast("binary")) % HELD_OUT != 0).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    pick = lambda value, most: known.where(F.col("_toxic") == value).orderBy(F.xxhash64("_id"), "_id").limit(most)
    sample = stored(pick(1, MOST_TOXIC).union(pick(0, MOST_CLEAN)), "sample")
    if sample.select("_toxic").distinct().count() < 2:
        return None
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id").groupBy("_id").agg(F.max("_text").alias("_text"), F.max("_toxic").alias("_toxic"))
    rows = stored(rows, "texts")
    # a few thousand rows of ids and sizes are in one task here; texts are in one only as far as the bound goes
    so_far = F.sum(F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long")).over(Window.orderBy(F.xxhash64("_id"), "_id"))
    chosen = rows.select("_id", so_far.alias("_bytes")).where(F.col("_bytes") <= MOST_BYTES).select("_id")
    rows = rows.join(F.broadcast(chosen), "_id", "left_semi")

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        table = table.take(pa.array(np.argsort(np.array([str(x) for x in table["_id"].to_pylist()]), kind="stable")))
        toxic = table["_toxic"].to_numpy() == 1
        if toxic.all() or not toxic.any():
            return
        model = train(table["_text"].combine_chunks(), toxic)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.__dict__)], pa.binary())], ["model"])

    found = stored(rows.repartition(1).mapInArrow(fit, "model binary"), "model").collect()
    return bytes(found[0]["model"]) if found else None


def _loaded(data: bytes) -> Model:
    model = Model()
    model.__dict__.update(pickle.loads(data))
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", carry: bool = False, model: bytes | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col (with carry: all columns), held_out, score, predicted.

    With carry, the three columns get underscores before their names where columns of ``docs`` have these.
    """
    spark = docs.sparkSession
    model = model or fitted(docs, labels, id_col, text_col, label_col)
    sent = spark.sparkContext.broadcast(model)
    source = docs if carry else docs.select(id_col, text_col)
    carried = [f for f in source.schema if carry or f.name == id_col]
    names = [free_name(docs, n) if carry else n for n in ("held_out", "score", "predicted")]
    schema = T.StructType([*carried, *(T.StructField(n, t) for n, t in zip(names, (T.BooleanType(), T.DoubleType(), T.IntegerType())))])
    id_at, text_at = source.columns.index(id_col), source.columns.index(text_col)
    keep = [i for i, f in enumerate(source.schema) if f in carried]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("toxicity", hash(sent.value)), lambda: _loaded(sent.value)) if sent.value is not None else None
        for batch in batches:
            for block in blocks(batch, batch.schema.names[text_at], 2_000_000):
                scores = own.scores(*joined(block.column(text_at))) if own is not None else np.zeros(block.num_rows)
                aside = held_out(block.column(id_at).to_pylist(), HELD_OUT)
                yield pa.RecordBatch.from_arrays([block.column(i) for i in keep] + [pa.array(aside), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], schema.names)

    return source.mapInArrow(run, schema)
