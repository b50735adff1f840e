import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import SF0001
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shopfloor.llm import align, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = "ab c  \n\té😀▁<s>|endoftext|>0123'sﬁ①\x00　 \x1c\x85​."


@pytest.fixture(scope="module")
def brute():
    """Both libraries over the whole text, and set intersection of the ends."""
    whole, pieces, pair = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), align.tokenizers(A, B)
    whole.encode_special_tokens = True

    def ends(strings):
        at = 0
        for s in strings:
            at += len(s)
            yield at

    def one(text):
        if not text:
            return 0, 0, "", []
        a, b = whole.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        bytes_a, bytes_b = [pair.strings[0][x] for x in a], [pair.strings[1][x] for x in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return 0, 0, "", []
        of_a, of_b = list(ends(bytes_a)), list(ends(bytes_b))
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(of_a) & set(of_b)):
            n, m = of_a.index(cut) + 1, of_b.index(cut) + 1
            groups.append(",".join(map(str, a[i:n])) + "|" + ",".join(map(str, b[j:m])))
            links.append((a[n - 1], b[m - 1]))
            i, j = n, m
        return len(a), len(b), ";".join(groups), links

    return one


def expected(texts, brute):
    found = [brute(t) for t in texts]
    counts = Counter(x for f in found for x in f[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(s.encode()).hexdigest() if n_a else "") for n_a, n_b, s, links in found]


def test_query_against_both_libraries(spark, brute):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in queries.op11_alignment(spark, SF0001).collect()}
    want = dict(zip([d.doc_id for d in docs], expected([d.text for d in docs], brute)))
    assert got == want


def test_odd_texts(spark, frame, brute):
    rng = random.Random(3)
    texts = [None, "", " ", "  ", "a ", "a  ", " a", "\n", "a\n  b", "<|endoftext|> x", "<s>", "▁", "x" * 40_000, "a b " * 9_000,
             *("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 30))) for _ in range(300)), "twice", "twice"]
    df = frame([(k, t, 7, "x") for k, t in enumerate(texts)], "id int, text string, n_a int, links string")
    got = align.align(df, A, B, groups="groups").collect()
    want = [brute(t) for t in texts]
    assert {r.id: (r.n_a, r.n_b, r.groups, [(x >> 32, x & (1 << 32) - 1) for x in r.links]) for r in got} == dict(enumerate(want))
    assert df.sparkSession.createDataFrame(got).columns == ["id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "groups"]


def test_counts_by_broadcast_and_by_shuffle_agree(spark, frame, brute, monkeypatch):
    texts = ["the cat sat on the mat", "the cat", "the cat", "unlikely thing", None, ""] * 3
    df = frame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    for heavy in (0, 8, 1 << 20):
        monkeypatch.setattr(align, "HEAVY", heavy)
        got = {r.id: (r.n_best, r.count_sum) for r in align.rate_links(align.align(df, A, B).cache(), "id").collect()}
        assert got == {k: x[4:6] for k, x in enumerate(expected(texts, brute)) if x[0]}


def test_empty_table(spark, frame):
    none = align.align(frame([], "id int, text string"), A, B)
    assert none.count() == 0 and align.rate_links(none, "id").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([1, 1, 1, 2, 3]), min_size=1, max_size=60), st.lists(st.integers(1, 9), max_size=30))
def test_common_ends_is_the_intersection(sizes, drops):
    import numpy as np
    a = np.cumsum(sizes)
    b = np.unique(np.append(np.setdiff1d(a, np.cumsum(drops)), a[-1]))
    b = np.unique(np.append(b, [x for x in np.cumsum(drops) if x < a[-1]]))
    x, y = align.common_ends(a, b)
    assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
