"""Byte-level BPE against the tiktoken library and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import bpe, queries

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    import tiktoken
    with open(public.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(public.path(bpe.RANKS))


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return bpe.Encoder(vocabulary, public.PATTERN)


def test_pairs_are_found_and_others_are_not(vocabulary):
    rng = np.random.default_rng(1)
    size = len(vocabulary.lengths)
    a, b = rng.integers(0, size, 20_000), rng.integers(0, size, 20_000)
    tokens = {i: t for t, i in vocabulary.ranks.items()}
    some = [(vocabulary.ranks[t[:1]], vocabulary.ranks[t[1:]], i) for t, i in list(vocabulary.ranks.items())[::7]
            if len(t) > 1 and t[1:] in vocabulary.ranks]
    a, b = np.append(a, [x[0] for x in some]), np.append(b, [x[1] for x in some])
    want = [vocabulary.ranks.get(tokens[x] + tokens[y], bpe.NONE) for x, y in zip(a.tolist(), b.tolist())]
    assert vocabulary.pairs(a.astype(np.int32), b.astype(np.int32)).tolist() == want
    assert vocabulary.pairs(np.array([-1, 5]), np.array([5, -1])).tolist() == [bpe.NONE] * 2


def slow(vocabulary, piece):
    """One merge at a time: the leftmost pair of least rank."""
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        ranks = [vocabulary.ranks.get(parts[i] + parts[i + 1], 1 << 40) for i in range(len(parts) - 1)]
        at = min(range(len(ranks)), key=ranks.__getitem__)
        if ranks[at] == 1 << 40:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [vocabulary.ranks[p] for p in parts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.binary(min_size=2, max_size=90), st.text("ab ñ漢e", min_size=2, max_size=60).map(str.encode)),
                min_size=1, max_size=12))
def test_matrix_rows_and_long_rows_merge_like_one_at_a_time(vocabulary, pieces):
    pieces = sorted(pieces, key=len)
    ids, sizes, _ = vocabulary.merge_rows(pieces)
    want = [slow(vocabulary, p) for p in pieces]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert [vocabulary.merge_long(p).tolist() for p in pieces] == want


def test_long_pieces(vocabulary, encoder, library):
    rng = random.Random(3)
    texts = ["a" * 5000, "ab" * 4001, "".join(rng.choices("etaoinshrdlu", k=6000)), "漢字仮名交文" * 700, "=" * 3001,
             " " * 4097, "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüß", k=30_000)), "x" + "ab" * 300 + "ba" * 300]
    assert vocabulary.ordered
    ids, counts = encoder(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]


def test_vocabulary_without_rising_ranks():
    """A token whose parts rank above it: long rows must not merge many pairs at once."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"ca": 258}
    odd = bpe.Vocabulary(ranks)
    assert not odd.ordered
    for piece in (b"abcabcab" * 100, b"caabcab" * 90):
        assert odd.merge_long(piece).tolist() == slow(odd, piece)
        assert odd.merge_rows([piece])[0].tolist() == slow(odd, piece)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=80), min_size=1, max_size=5))
def test_any_text(encoder, library, texts):
    ids, counts = encoder(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]


SPACES = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\u2003", "\r\n", " \n", "\u200b"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*SPACES, "a", "bc", "1", "'s", "'", "ñ", "漢", "!", "?!", "_", "'ll", "\u0301"]), max_size=25).map("".join))
def test_white_space_of_all_kinds(encoder, library, text):
    assert encoder([text])[0].tolist() == library.encode_ordinary(text)


def test_forgets_when_full(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for text in ("one two three four five", "five six seven eight nine", "ten eleven twelve one two"):
        assert encoder([text])[0].tolist() == library.encode_ordinary(text)


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_op13_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op13_bpe(spark, sf).collect()}
    assert got == {d.doc_id: expected(library, d.text) for d in docs}


def test_odd_documents(spark, odd_docs, no_docs, library):
    got = bpe.digest(odd_docs.withColumn("ids", odd_docs.n_chars).withColumn("decoded", odd_docs.n_chars)).collect()
    want = [(d.doc_id, *expected(library, d.text)) for d in odd_docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe.digest(no_docs).collect() == []


def test_decode_of_unknown_ids(spark):
    rows = spark.createDataFrame([(1, [256, 300]), (2, [1 << 20]), (3, [-1]), (4, [5, None]), (5, None), (6, [])],
                                 "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows).collect()}
    assert got[1] is not None and got[6] == b"" and got[2] is got[3] is got[4] is got[5] is None
    assert bpe.decode(rows.where("doc_id < 0")).collect() == []


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 10)
    assert list(bpe._slices([3, 3, 3, 3, 50, 1])) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    assert list(bpe._slices([])) == [] and list(bpe._slices([0, 0])) == [(0, 2)]
