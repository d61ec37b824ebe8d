"""Operator 11: byte-pair encoding of whole texts, and decoding of what it gave.

Merges are done here, from the merge list of a public tokenizer's file. A short
pre-token is a contiguous array of part boundaries with the rank of the merge
across each: the least rank is found by a scan, its boundary is deleted, and
the ranks to both sides are looked up anew. That is quadratic, so pre-tokens of
more than ``SHORT`` bytes keep their boundaries in a linked list and the ranks
in a heap. Either way merges happen by rank, then from the left, as the library
does them. Workers remember the ids of pre-tokens up to a bound in bytes. Map
only: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_arrow, only, small_batches, tokenizer_path
from .packing import _alphabet
from .pretokens import BYTE_LEVEL_SPLIT, WORD_END_SPLIT, Cache
from .tokens import splitter

SHORT = 128  #: bytes of a pre-token whose ranks are scanned
CACHED = 48_000_000  #: bytes of a worker's cache at most
STEP = 1 << 16  #: ids that are decoded at once
NEVER = 1 << 62  #: the rank of parts that no merge joins

_coders: dict = {}


class Merges:
    """The merges of a tokenizer file, by the ids of the parts that they join."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        to = _alphabet()
        self.byte_of = to
        inner, last = {b: vocab.get(c) for c, b in to.items()}, {b: vocab.get(c + suffix) for c, b in to.items()}
        if None in inner.values() or None in last.values():
            raise ValueError("the vocabulary lacks a byte, so texts would lose it")
        self.inner, self.last = [inner[b] for b in range(256)], [last[b] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for merge in merges:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.rank.setdefault((vocab[left], vocab[right]), len(self.made))
            self.made.append(vocab[left + right])

    def encode(self, word: bytes) -> list[int]:
        """The ids of a pre-token."""
        if not word:
            return []
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        return self.scan(ids) if len(ids) <= SHORT else self.heap(ids)

    def scan(self, ids: list[int]) -> list[int]:
        """Joins parts in place: ``ids[i]`` is the part from boundary i, ``ranks[i]`` the merge across boundary i + 1."""
        of, made = self.rank.get, self.made
        ranks = [of(pair, NEVER) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            ids[i] = made[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = of((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = of((ids[i], ids[i + 1]), NEVER)
        return ids

    def heap(self, ids: list[int]) -> list[int]:
        """The same over a linked list of parts; a merge whose parts have changed since is passed over."""
        of, made, n = self.rank.get, self.made, len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := of((ids[i], ids[i + 1]), NEVER)) != NEVER]
        heapq.heapify(queue)
        while queue:
            r, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = made[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := of((ids[a], ids[b]), NEVER)) != NEVER:
                    heapq.heappush(queue, (r, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]


class Coder:
    """Texts to ids and ids to texts, as the tokenizer at ``path`` has it, without added special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        kind = (file.get("decoder") or {}).get("type")
        if model["type"] != "BPE" or kind not in (None, "ByteLevel"):
            raise ValueError(f"not a byte-pair tokenizer that is decoded by joining its tokens: {path}")
        suffix = model.get("end_of_word_suffix") or ""
        self.splitter = splitter(path, *((WORD_END_SPLIT, True) if suffix else (BYTE_LEVEL_SPLIT, False)))
        self.merges = Merges(model["vocab"], model["merges"], suffix)
        ids = lambda w: np.array(self.merges.encode(w), "<u4").tobytes()
        to = self.merges.byte_of
        self.cache = Cache(lambda w: ids(w.encode()), lambda w: ids(bytes(map(to.__getitem__, w))), CACHED)
        words = model["vocab"] | {t["content"]: t["id"] for t in file["added_tokens"]}
        # without a decoder tokens are joined by blanks as they stand, else their letters stand for bytes
        self.gap = b"" if kind else b" "
        self.words = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            whole = all(c in to for c in word) if kind else False
            self.words[i] = bytes(map(to.__getitem__, word)) if whole else word.encode()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian uint32."""
        out = bytearray()
        for special, pieces, own in self.splitter.split(text or ""):
            out += np.array([special], "<u4").tobytes() if special is not None else b"".join(self.cache.all_of(pieces, own))
        return bytes(out)

    def decode(self, ids: bytes) -> Iterator[bytes]:
        """The decoded text, in steps of UTF-8 (bytes that are no UTF-8 stay as they are)."""
        for at in range(0, len(ids), 4 * STEP):
            words = self.gap.join(map(self.words.__getitem__, np.frombuffer(ids[at : at + 4 * STEP], "<u4").tolist()))
            yield self.gap + words if at else words

    def decoded(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8, as the library gives it: what is no UTF-8 becomes U+FFFD."""
        return b"".join(self.decode(ids)).decode("utf-8", "replace").encode()

    def digest(self, ids: bytes) -> str:
        """SHA-256 of ``decoded``; tokens joined by blanks are UTF-8 at every step, so nothing is held whole."""
        if not self.gap:
            return hashlib.sha256(self.decoded(ids)).hexdigest()
        sha = hashlib.sha256()
        for step in self.decode(ids):
            sha.update(step)
        return sha.hexdigest()


def coder(path: str) -> Coder:
    """The coder of the tokenizer at ``path``, one a process."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def _run(path: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in small_batches(batches, "text"):
            ids = [own.encode(t) for t in batch.column("text").to_pylist()]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([own.digest(x) for x in ids], pa.string()),
            }
            if whole:
                columns |= {"ids": pa.array(ids, pa.binary()), "decoded": pa.array([own.decoded(x).decode() for x in ids], pa.string())}
            yield pa.record_batch(columns)

    return run


def encode_documents(docs: DataFrame, path: str | None = None, *, whole: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (of little-endian uint32 ids), decoded_sha256 (of UTF-8).

    ``whole`` adds ids (binary) and decoded (the text that they stand for).
    Every row is kept, repeated ones too, each with its own result. A null or
    empty text has no tokens and decodes to an empty text; a null doc_id stays
    null; an empty table gives an empty result; other columns of ``docs``,
    whatever their names, are ignored. Special strings in texts are one id each,
    as the library has it. Texts of any length are encoded whole, part by part.
    """
    bounded_arrow(docs.sparkSession)
    rows = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * whole
    return rows.mapInArrow(_run(path or tokenizer_path("word_bpe_49k.json"), whole), schema)
