import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopfloor.llm import bpe, queries
from llm_helpers import SF0001

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


TEXTS = ["", " ", "  \n\n x", "Hello world's 12,5 ünï 中文 😀\x1c\x85 end ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b",
         "x" * 5000, "ab " * 3000, "\r\n\t", "it's we'll I'd 'S", "​﻿ á"]


def test_agrees_with_the_library(library):
    own = bpe.vocabulary(PATH)
    rng = random.Random(3)
    alphabet = "ab 'stre\n\t\x0b\x85  é中😀1٣_-<|>"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(2000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids(own.encode(t)) == want, t
        assert own.decode(own.encode(t)) == library.decode(want, skip_special_tokens=False) == t


def test_every_code_point(library):
    own = bpe.vocabulary(PATH)
    points = [c for c in [*range(0x3100), *range(0x3100, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)}{chr(c)}x" for c in points]
    for t, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids(own.encode(t)) == want.ids, hex(ord(t[1]))


def test_merges_equal_naive_bpe():
    """The heap over a linked list against rescanning for the best pair."""
    own = bpe.vocabulary(PATH)

    def naive(data):
        out = [own.first[b] for b in data]
        while True:
            best = min(((own.merges[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in own.merges), default=None)
            if best is None:
                return out
            i = best[1]
            out[i:i + 2] = [own.merges[out[i], out[i + 1]][1]]

    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 30))).encode()
        assert own.merge(word) == naive(word)
    assert own.merge(b"aaaaaaaa") == naive(b"aaaaaaaa")


def test_word_tables_stay_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    own = bpe.ByteBPE(PATH)
    text = " ".join(f"word{i % 40}" for i in range(400))
    assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert len(own.known) <= 5 and len(own.older) <= 5


def test_decode_of_odd_ids():
    own = bpe.vocabulary(PATH)
    assert own.decode(b"") == ""
    assert own.decode(np.array([10**6], "<u4").tobytes()) == ""
    half = own.encode("😀")[:4]
    assert "�" in own.decode(half)


def test_operator_edge_cases(frame):
    df = frame([(1, None, "k"), (2, "", "k"), (3, "hi hi", "k"), (3, "hi hi", "k"), (None, "x" * 100_000, None)],
               "doc_id long, text string, n_tokens string")
    out = {}
    for r in bpe.decode(bpe.encode(df, PATH), PATH).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert [r.n_tokens for r in out[1]] == [0] and out[1][0].token_ids == b"" and out[1][0].decoded == ""
    assert len(out[3]) == 2 and out[3][0].decoded == "hi hi"
    assert out[None][0].decoded == "x" * 100_000 and out[None][0].n_tokens > 0
    empty = frame([], "doc_id long, text string")
    assert bpe.encode(empty, PATH).columns == ["doc_id", "text", "token_ids", "n_tokens"]
    assert bpe.encode(empty, PATH).collect() == []


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op1_bpe(spark, SF0001).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode(d.text, add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        back = library.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
