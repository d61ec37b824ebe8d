"""Operator 8: best-fit packing of tokenized documents into sequences of fixed length.

Documents become pieces in one map-side pass; only their lengths travel. Pieces
of a full sequence need no packing. The others are dealt by hash into groups
of about ``GROUP`` pieces, and each group is packed best-fit decreasing: pieces
by falling length, each into the tightest bin that holds it, found by a segment
tree over remaining capacities in logarithmic time. A group leaves about one
sequence partly empty, so groups cost next to nothing against one global run.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_arrow, keep, only, small_batches, tokenizer_path
from .pretokens import BYTE_LEVEL_SPLIT, Cache
from .tokens import splitter

GROUP = 65_536  #: pieces that one task packs, on average
CACHED = 24_000_000  #: bytes of a worker's cache at most

_caches: dict = {}


class CapacityTree:
    """Open bins by remaining capacity: a segment tree of counts over 0..capacity, bins stacked at the leaves."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, free: int, by: int) -> None:
        i = free + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, free: int, bin_: int) -> None:
        self.bins[free].append(bin_)
        self._add(free, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The tightest open bin with at least ``length`` left, as (free, bin), taken out; None if there is none."""
        count, i = self.count, length + self.leaves
        while not count[i]:
            while i & 1:  # a right child: nothing further right below this parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        free = i - self.leaves
        self._add(free, -1)
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; ``lengths`` in falling order, each from 1 to ``capacity``."""
    tree, bins, offsets, opened = CapacityTree(capacity), [], [], 0
    for n in lengths:
        free, bin_ = tree.take(n) or (capacity, opened)
        opened += bin_ == opened
        bins.append(bin_)
        offsets.append(capacity - free)
        if free > n:
            tree.put(free - n, bin_)
    return bins, offsets


def _alphabet() -> dict[str, int]:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, others for U+0100 onwards, in order."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


def merged_in_order(path: str) -> bool:
    """Whether ids are the bytes and then the merges in their order, each token from one merge: ids alone then say how to merge."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    return sorted(i for w, i in model["vocab"].items() if len(w) > 1) == made and all(a < b for a, b in pairwise(made)) and max(i for w, i in model["vocab"].items() if len(w) == 1) < made[0]


def piece_encoder(path: str):
    """Pre-token to little-endian uint32 ids. The same merges from the same file, by a faster library if it is there and they are in order."""
    t = splitter(path, BYTE_LEVEL_SPLIT, False).tokenizer
    slow = lambda w: np.array(t.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
    try:
        import tiktoken

        if not merged_in_order(path):
            return slow
        to, special = _alphabet(), set(splitter(path).specials)
        ranks = {bytes(to[c] for c in w): i for w, i in t.get_vocab(with_added_tokens=False).items() if w not in special}
        encoding = tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    except (ImportError, KeyError):
        return slow
    return lambda w: np.array(encoding.encode_ordinary(w), "<u4").tobytes()


def encode(text: str | None, path: str) -> bytes:
    """The library's ids of a whole text, as little-endian uint32; texts are split and encoded part by part."""
    s = splitter(path, BYTE_LEVEL_SPLIT, False)
    if path not in _caches:
        model = s.tokenizer.model
        _caches[path] = Cache(piece_encoder(path), lambda w: np.array([x.id for x in model.tokenize(w)], "<u4").tobytes(), CACHED)
    cache, out = _caches[path], bytearray()
    for special, pieces, own in s.split(text or ""):
        out += np.array([special], "<u4").tobytes() if special is not None else b"".join(cache.all_of(pieces, own))
    return bytes(out)


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows: list[list] = [[] for _ in range(5 + with_ids)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text, path) + end
                n = len(ids) // 4
                start, stop = 0, n % capacity or capacity
                for piece in range(-(-n // capacity)):
                    part = ids[4 * start : 4 * stop]
                    for row, value in zip(rows, (doc_id, piece, start, stop - start, zlib.crc32(part), part), strict=False):
                        row.append(value)
                    start, stop = stop, stop + capacity
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.record_batch([pa.array(r, k) for r, k in zip(rows, kinds, strict=False)], names=names[: len(rows)])

    return run


def _pack(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit_decreasing(rows.column("length").to_pylist(), capacity)
        first = TaskContext.get().partitionId() << 40
        rows = rows.append_column("sequence_id", pa.array(np.array(bins, np.int64) + first)).append_column("offset", pa.array(offsets, pa.int64()))
        yield from rows.to_batches(max_chunksize=16_384)

    return run


def pack(pieces: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """``pieces`` (with doc_id, piece, length, ids_crc32) plus sequence_id and offset.

    ``pieces`` should be a written table: it is counted, then read again, and
    its rows are dealt by their numbers too, so that equal pieces are in all groups.
    """
    whole, part = pieces.where(F.col("length") == capacity), pieces.where(F.col("length") < capacity)
    groups = max(1, round(part.count() / group))
    dealt = part.withColumn("_row", F.monotonically_increasing_id()).repartition(groups, F.xxhash64("doc_id", "piece", "ids_crc32", "_row")).drop("_row")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    packed = dealt.mapInArrow(_pack(capacity), schema)
    return whole.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).unionByName(packed)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = 1024, end_id: int = 2, *, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, little-endian uint32, if asked for).

    A document is its text's ids and ``end_id``; only longer ones than
    ``capacity`` are cut, the first piece taking the remainder. Sequences are
    gapless from offset 0 and hold ``capacity`` tokens at most. A null or empty
    text is the end id alone; repeated rows are packed once each; a null doc_id
    stays null; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_arrow(spark)
    rows = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    cut = rows.mapInArrow(_cut(path or tokenizer_path("byte_bpe_50k.json"), capacity, end_id, with_ids), "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
    return pack(keep(cut, "pieces"), capacity)
