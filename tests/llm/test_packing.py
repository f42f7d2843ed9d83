import zlib

import numpy as np
import public_tokenizers as public
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hearth.llm import packing
from tests.conftest import SF001

WHOLE = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
WHOLE.encode_special_tokens = True
ENCODE = packing.Encoder()


def ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sté ¿0 \t\n\x0b\x1c\x1f\x85\xa0\xad .,&漢 Ω", max_size=30))
def test_encoder_gives_the_tokenizers_ids(text):
    assert ENCODE(text) == np.array(ids(text)[:-1], "<u4").tobytes()


@given(st.integers(1, 20_000))
def test_cut_is_whole_and_within_capacity(n):
    parts = packing.cut(n)
    assert sum(parts) == n and all(0 < p <= 2048 for p in parts)


def check(docs):
    rows = docs.collect()
    pieces = packing.pack(docs, emit_ids=True).collect()
    want = sorted(((r.doc_id, tuple(ids(r.text))) for r in rows), key=str)
    made, seqs = [], {}
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for (doc, total), ps in by_doc.items():
        starts = sorted(ps, key=lambda p: p.start)
        if len([1 for d, t in want if d == doc and len(t) == total]) == 1:
            made.append((doc, tuple(i for p in starts for i in p.ids)))
    singles = [w for w in want if sum(1 for d, t in want if d == w[0] and len(t) == len(w[1])) == 1]
    assert sorted(made, key=str) == singles
    assert sum(p.length for p in pieces) == sum(len(t) for _, t in want)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return pieces, seqs


def test_sf_round_trip_and_padding(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").coalesce(1)
    pieces, seqs = check(docs)
    used = sum(p.length for p in pieces)
    assert used / (2048 * len(seqs)) > 0.97


def test_odd_rows(spark, odd_docs, no_docs):
    check(odd_docs)
    assert packing.pack(no_docs).count() == 0
    again = packing.pack(odd_docs).collect()
    assert again == packing.pack(odd_docs).collect()


def test_added_tokens_have_the_ids_of_the_tokenizer_as_loaded():
    loaded = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    assert loaded.get_added_tokens_decoder()
    for token in (t.content for t in loaded.get_added_tokens_decoder().values()):
        for text in (token, f"one {token} two", f" {token}{token}\n", f"漢 {token} é"):
            want = loaded.encode(text, add_special_tokens=False).ids
            assert ENCODE(text) == np.array(want, "<u4").tobytes()


def test_new_words_of_a_text_are_encoded_in_one_call():
    """Ids as of the tokenizer, words over the limit forgotten; a call a text, not a call a word."""
    encode = packing.Encoder()
    loaded = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    words = [f"{a}{i}{b}" for i in range(150) for a, b in (("Word", "s,"), ("(", ")\nnext"), ("d'", "'ll"), ("é\xa0", "ß"), ("", "x" * 70))]
    calls = []

    class Counted:
        def __init__(self, ranked):
            self.encode_ordinary = lambda text: calls.append(text) or ranked.encode_ordinary(text)

    encode.ranked = Counted(encode.ranked)
    odd = ["", " ", "one", "one two ", " one two", "one  two", "one \ntwo", "one\t two", "one two\n", "a\n\nb c", "a \x1c b"]
    for text in (" ".join(words), " ".join(words[::-1]), *odd, *(f"{words[7]} {x} {words[9]}" for x in odd)):
        before = len(calls)
        assert encode(text) == np.array(loaded.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(calls) - before <= 3
    assert encode.known and max(map(len, encode.known)) <= 64 and "" not in encode.known
