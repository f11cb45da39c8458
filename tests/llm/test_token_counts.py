import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tapewright.llm import queries, token_counts
from tapewright.llm.text import joined

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counts(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_transducers_against_the_library(library):
    rng = random.Random(1)
    parts = ["a", "s", "t", "'", "re", "'s", "'re", "'ll", "'r", "'v", "'l", " ", "  ", "\n", "\t", "\x0b", "\x85", "1", "٣", "é", "中", "!", "…", " ", "　", "the", "ing", "<|endoftext|>", "<|", "endoftext", "😀", "́", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["x" * 5000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20000)), " " * 3000, "'" * 700, "", None]
    counter = token_counts.TokenCounter(PATH)
    assert counter.counts(*joined(pa.array(texts))).tolist() == counts(library, texts)


def test_states_beyond_the_bound_are_dropped(library):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeé ") for _ in range(300)) for _ in range(50)]
    counter = token_counts.TokenCounter(PATH)
    counter.merges.MOST_STATES = 100
    assert counter.counts(*joined(pa.array(texts))).tolist() == counts(library, texts)


def long_texts(rng):
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2500))
    words = "".join(rng.choice(["the", "token", "ing", "state", "é", "中"]) for _ in range(1000))
    return [letters, words, *(p * (2200 // len(p)) for p in ("x", "abc", "=", " ", "abcdefg", "-=", "é")), "a " + letters[:1500] + " b", letters[:1025]]


@pytest.mark.parametrize("chunk, stretch, rounds", [(512, 2048, 64), (7, 3, 64), (64, 5, 64), (37, 2048, 1)])
def test_long_pre_tokens_are_composed_of_chunks(library, monkeypatch, chunk, stretch, rounds):
    texts = long_texts(random.Random(3))
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts, "STRETCH", stretch)
    monkeypatch.setattr(token_counts, "ROUNDS", rounds)
    counter = token_counts.MergeCounter(PATH)
    data, offsets = joined(pa.array(texts))
    whole = [counter._short(data, offsets[k : k + 1], offsets[k + 1 : k + 2] - offsets[k : k + 1])[0] for k in range(len(texts))]
    assert counter._long(data, offsets[:-1], offsets[1:] - offsets[:-1]).tolist() == whole
    counter.MOST_STATES = 300  # states are dropped in the middle of chunks
    assert counter._long(data, offsets[:-1], offsets[1:] - offsets[:-1]).tolist() == whole


def test_a_megabyte_without_a_break(library):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["the", "and", "data", "count", "state"]) for _ in range(250_000)), "abc" * 333_333]
    assert token_counts.TokenCounter(PATH).counts(*joined(pa.array(texts))).tolist() == counts(library, texts)


def test_borders_against_merging():
    rng = random.Random(5)
    counter = token_counts.MergeCounter(PATH)
    assert counter.upward
    tokens = [a + b for a, b in rng.sample(sorted(counter.rank), 4000)] + [bytes([x]) * n for x in b"a -=." for n in (1, 2, 3, 4, 5, 8, 16)]
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(6000)] + [(a, b) for a in tokens[-35:] for b in tokens[-35:]]
    pairs = [(a, b) for a, b in pairs if counter.merged(a) == [a]]
    assert [counter._apart(a, b) for a, b in pairs] == [counter.merged(a + b) == [a, b] for a, b in pairs]


def test_special_strings_do_not_span_texts(library):
    texts = ["<|endof", "text|>", "<|endoftext|><|endoftext|>", "a <|endoftext|> b"]
    assert token_counts.TokenCounter(PATH).counts(*joined(pa.array(texts))).tolist() == counts(library, texts)


def test_query(spark, sf, library):
    docs = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    want = dict(zip(docs, counts(library, docs.values())))
    out = queries.op4_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in out} == {d: (len((docs[d] or "").encode()), n, n > 512) for d, n in want.items()}


def test_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, None, 1), (2, "", 2), (2, "a b", 3)], "doc_id long, text string, n_tokens int")
    assert sorted(r.n_tokens for r in token_counts.token_counts(docs, PATH).collect()) == [0, 0, 2]
    assert token_counts.token_counts(docs.limit(0), PATH).collect() == []
