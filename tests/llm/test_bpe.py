"""Operator 11 against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tabulaire.llm.bpe import Merges, coder, encode_documents
from tabulaire.llm.common import tokenizer_path

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def library(name):
    t = Tokenizer.from_file(tokenizer_path(name))
    t.no_truncation()
    t.no_padding()
    return t


def expected(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)


TEXTS = [
    None,
    "",
    " \n\t ",
    "The quick  brown fox's 12,345 jumps — \"over\" it; l'été, Größe, Straße.",
    "<|endoftext|> <|startoftext|>a<|endoftext|>",
    "東京🎉 İstanbul ﬁ ſ x́ \x00\x1c\x85   ∑Σς ไทยไม่มีช่องว่าง",
    "x" * 5000 + " " + "ab" * 3000 + "!" * 700,
    "internationalisation" * 40,
]


@pytest.mark.parametrize("name", FILES)
def test_library(name):
    t, own = library(name), coder(tokenizer_path(name))
    for text in TEXTS:
        ids, decoded = expected(t, text)
        assert own.encode(text) == ids
        assert own.decoded(ids).decode() == decoded
        assert own.digest(ids) == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("name", FILES)
def test_random_texts(name):
    t, own = library(name), coder(tokenizer_path(name))

    @given(st.text(st.characters(codec="utf-8"), max_size=300) | st.text("abthein ' s\n1", max_size=300))
    @settings(max_examples=150, deadline=None)
    def same(text):
        ids, decoded = expected(t, text)
        assert own.encode(text) == ids
        assert own.decoded(ids).decode() == decoded

    same()


def naive(word, rank, made):
    """Of all adjacent pairs the one of least rank, the leftmost of these, again and again."""
    while True:
        best = min(((rank[p], i) for i, p in enumerate(zip(word, word[1:], strict=False)) if p in rank), default=None)
        if best is None:
            return word
        r, i = best
        word = [*word[:i], made[r], *word[i + 2 :]]


def test_scan_and_heap_agree_with_the_plain_search():
    rng = random.Random(4)
    for _ in range(300):
        own = Merges.__new__(Merges)
        pairs = [(rng.randrange(12), rng.randrange(12)) for _ in range(25)]
        own.rank = {p: r for r, p in reversed(list(enumerate(pairs)))}
        own.made = [rng.randrange(12) for _ in pairs]  # joined parts may take part in merges of lower rank
        word = [rng.randrange(4) for _ in range(rng.randrange(1, 60))]
        plain = naive(list(word), own.rank, own.made)
        assert own.scan(list(word)) == plain == own.heap(list(word))


def test_table(spark, odd):
    t = library(FILES[0])
    rows = encode_documents(odd, whole=True).collect()
    given_ = odd.select("doc_id", "text").collect()
    shape = lambda i, ids, decoded: (str(i), len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids), r.decoded) for r in rows) == sorted(shape(r.doc_id, *expected(t, r.text)) for r in given_)


def test_empty_table(none):
    out = encode_documents(none)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert out.collect() == []


def test_all_documents(spark):
    t = library(FILES[0])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in encode_documents(docs).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        ids, decoded = expected(t, text)
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
