import json
import zlib
from collections import Counter, defaultdict
from unittest import mock

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tabulaire.llm.common import keep, tokenizer_path
from tabulaire.llm import pretokens
from tabulaire.llm.packing import CapacityTree, best_fit_decreasing, encode, merged_in_order, pack, pack_documents
from tabulaire.llm.pretokens import BYTE_LEVEL_SPLIT
from tabulaire.llm.tokens import frequent_lengths, splitter, token_counts
from tests.llm.conftest import ODD

WORD_PATH, BYTE_PATH = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
WORD, BYTE = Tokenizer.from_file(WORD_PATH), Tokenizer.from_file(BYTE_PATH)
ids_of = lambda t, text: t.encode(text or "", add_special_tokens=False).ids


def test_counts_are_the_librarys(odd, none):
    got = sorted(map(tuple, token_counts(odd).collect()), key=str)
    expected = [(i, len((t or "").encode()), n := len(ids_of(WORD, t)), n > 2048) for i, t, _ in ODD]
    assert got == sorted(expected, key=str)
    assert token_counts(none).collect() == []


ANY = st.one_of(
    st.characters(max_codepoint=0x250),
    st.sampled_from(" '\n\tsredvmlltaeA1,.-’“”—…€"),
    st.characters(codec="utf-8"),
    st.sampled_from("Σςİßǅﬁ①Ⅷ½٣字。漢、かカ한글，\u0301\u0307\u200b\u2028\u3000\u00a0\ufeffаяЖ🎉👩\u200d🚀"),
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", " the ", "it's ", "I’ll"]),
)


@settings(max_examples=600, deadline=None)
@given(st.lists(ANY, max_size=30).map("".join), st.integers(1, 12))
def test_texts_split_as_the_library_does(text, most):
    """In any script, with special strings, and cut into parts of a few characters."""
    with mock.patch.object(pretokens, "PART", most), mock.patch.object(pretokens.parts, "__defaults__", (most,)):
        for t, s in ((WORD, splitter(WORD_PATH)), (BYTE, splitter(BYTE_PATH, BYTE_LEVEL_SPLIT, False))):
            got = []
            for special, pieces, own in s.split(text):
                got += [special] if special is not None else [i for w in pieces for i in ids_of(t, w)] if own is None else [x.id for w in own for x in t.model.tokenize(w)]
            assert got == ids_of(t, text)
        assert np.frombuffer(encode(text, BYTE_PATH), "<u4").tolist() == ids_of(BYTE, text)


def test_long_texts_are_split_in_parts():
    text = ("It’s fine — yes, “really”. Привет, мир! 東京は、大きい。 " * 9000)[:400_000] + "x" * 150_000 + " <|endoftext|> end"
    sizes = [len(p) for p in pretokens.parts(text)]
    assert sum(sizes) == len(text) and max(sizes) < 300_000 and len(sizes) >= 4
    for t, path, pattern in ((WORD, WORD_PATH, None), (BYTE, BYTE_PATH, BYTE_LEVEL_SPLIT)):
        s = splitter(path) if pattern is None else splitter(path, pattern, False)
        assert sum(1 if special is not None else len([x for w in own for x in t.model.tokenize(w)]) if own else sum(len(ids_of(t, w)) for w in pieces) for special, pieces, own in s.split(text)) == len(ids_of(t, text))


def test_caches_are_bounded_by_bytes():
    cache = pretokens.Cache(len, len, 1000)
    assert cache.all_of([f"w{i}" for i in range(50)] + ["x" * 300], None) == [2] * 10 + [3] * 40 + [300]
    assert 0 < len(cache) < 10 and "x" * 300 not in cache
    assert cache.all_of(["w1", "zz"], ["w1", "zzz"]) == [2, 3]


def test_summaries_hold_no_long_pretokens(spark):
    docs = spark.createDataFrame([("abc " * 50 + "x" * 5000 + " " + "y" * 300,)] * 20, "text string")
    words, lengths = json.loads(zlib.decompress(frequent_lengths(docs, WORD_PATH)))
    assert words == ["abc"] and lengths == [len(ids_of(WORD, "abc"))]


def test_merges_are_in_order(tmp_path):
    assert merged_in_order(BYTE_PATH)
    for vocab, merges, ok in (({"a": 0, "b": 1, "ab": 2, "aab": 3}, [["a", "b"], ["a", "ab"]], True), ({"a": 0, "b": 1, "ab": 3, "ba": 2}, [["a", "b"], ["b", "a"]], False), ({"a": 0, "ab": 1, "b": 2}, ["a b"], False)):
        (tmp_path / "t.json").write_text(json.dumps({"model": {"vocab": vocab, "merges": merges}}))
        assert merged_in_order(str(tmp_path / "t.json")) == ok


def check_sequences(rows, capacity):
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def test_packs_whole_documents(odd, none):
    rows = pack_documents(odd, capacity=64, with_ids=True).collect()
    check_sequences(rows, 64)
    got = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        got[r.doc_id].append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for doc_id, text, _ in ODD:
        ids, parts = ids_of(BYTE, text) + [2], sorted(got[doc_id])
        copies = sum(o[0] == doc_id for o in ODD)
        assert len(parts) == copies * -(-len(ids) // 64)
        joined = [p for i, p in enumerate(parts) if i % copies == 0]
        assert sum((p[2] for p in joined), []) == ids and all(len(p[2]) == 64 for p in joined[1:])
        assert [p[1] for p in joined] == np.r_[0, np.cumsum([len(p[2]) for p in joined])[:-1]].tolist()
    assert pack_documents(none).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_equals_a_plain_search(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets = best_fit_decreasing(lengths, 20)
    free: list[int] = []
    for n, b, o in zip(lengths, bins, offsets, strict=True):
        fits = [f for f in free if f >= n]
        if b == len(free):
            assert not fits
            free.append(20)
        assert free[b] == (min(fits) if fits else 20) and o == 20 - free[b]
        free[b] -= n


def test_tree_finds_the_tightest():
    tree = CapacityTree(16)
    for free in (3, 9, 16, 9):
        tree.put(free, free)
    assert [tree.take(4), tree.take(9), tree.take(10), tree.take(4), tree.take(0), tree.take(0)] == [(9, 9), (9, 9), (16, 16), None, (3, 3), None]


def test_equal_pieces_are_dealt_over_all_groups(spark):
    pieces = keep(spark.range(20_000).selectExpr("cast(null as long) as doc_id", "0 as piece", "0L as start", "7L as length", "1L as ids_crc32"), "pieces")
    rows = pack(pieces, 64, group=1000).collect()
    groups = Counter(r.sequence_id >> 40 for r in rows)
    assert len(rows) == 20_000 and len(groups) == 20 and max(groups.values()) < 1400
    assert check_sequences(rows, 64) <= 20_000 // 9 + 21


def test_packs_tightly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack_documents(docs).collect()
    assert check_sequences(rows, 1024) <= -(-sum(r.length for r in rows) // 1024) + 2
