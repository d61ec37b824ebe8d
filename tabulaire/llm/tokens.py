"""Operator 1: token counts by a map-side two-tier lookup.

Tier one is a broadcast table of the corpus's frequent pre-tokens and their
lengths in tokens; tier two is a cache in each Python worker that encodes what
tier one lacks with the tokenizer library. Both tiers only remember what the
library says, so counts are the library's whatever they hold; texts in any script
go through them. No pre-token is ever shuffled: the frequent table is merged from one bounded summary (heavy
hitters with an error bound) per partition, over all documents.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_arrow, only, small_batches, tokenizer_path
from .pretokens import LONGEST, WORD_END_SPLIT, Cache, Splitter

SUMMARY = 4096  #: counters a partition's summary keeps
FREQUENT = 16_384  #: entries of the broadcast table at most (about 0.3 MB), of ``LONGEST`` characters at most
CACHED = 64_000_000  #: bytes of a worker's cache at most

_splitters: dict = {}
_caches: dict = {}


def splitter(path: str, pattern=WORD_END_SPLIT, lower: bool = True) -> Splitter:
    """The splitter of the tokenizer at ``path``, one a process."""
    if path not in _splitters:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _splitters[path] = Splitter(t, pattern, lower)
    return _splitters[path]


def _trim(counts: Counter, most: int) -> Counter:
    """A mergeable heavy-hitter summary: takes the (most+1)-th count from all and keeps what is left."""
    if len(counts) <= most:
        return counts
    cut = counts.most_common(most + 1)[-1][1]
    return Counter({k: n - cut for k, n in counts.items() if n > cut})


def _summarise(path: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path).split
        counts: Counter = Counter()
        for batch in small_batches(batches, "text"):
            for text in batch.column("text").to_pylist():
                for _, pieces, _ in split(text or ""):
                    # what caches do not remember has no place in the table either, so both are bounded in bytes
                    counts.update(pieces if max(map(len, pieces), default=0) <= LONGEST else [p for p in pieces if len(p) <= LONGEST])
                    if len(counts) > 16 * most:
                        counts = _trim(counts, most)
        packed = zlib.compress(json.dumps(_trim(counts, most)).encode())
        yield pa.record_batch([pa.array([packed], pa.binary())], names=["summary"])

    return run


def frequent_lengths(docs: DataFrame, path: str, summary: int = SUMMARY, most: int = FREQUENT) -> bytes:
    """Lengths in tokens of the corpus's most frequent pre-tokens, compressed; ``most`` entries at most."""
    rows = docs.select("text").mapInArrow(_summarise(path, summary), "summary binary").rdd
    unpack = lambda b: Counter(json.loads(zlib.decompress(b)))
    pack = lambda c: zlib.compress(json.dumps(c).encode())
    merged = rows.map(lambda r: bytes(r[0])).treeReduce(lambda a, b: pack(_trim(unpack(a) + unpack(b), most)), depth=3)
    t = splitter(path).tokenizer
    words = [w for w, _ in unpack(merged).most_common(most)]
    lengths = [len(e.ids) for e in t.encode_batch(words, add_special_tokens=False)]
    return zlib.compress(json.dumps([words, lengths]).encode())


def _count(path: str, frequent, limit: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = splitter(path)
        t = s.tokenizer
        if path not in _caches or _caches[path][0] != frequent.value:
            # a worker that serves another broadcast starts anew, so its memory stays bounded
            words, lengths = json.loads(zlib.decompress(frequent.value))
            _caches[path] = frequent.value, Cache(lambda w: len(t.encode(w, add_special_tokens=False).ids), lambda w: len(t.model.tokenize(w)), CACHED, zip(words, lengths))
        cache = _caches[path][1]
        for batch in small_batches(batches, "text"):
            counts = [sum(1 if special is not None else sum(cache.all_of(pieces, own)) for special, pieces, own in s.split(text or "")) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())], schema=schema)

    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Every row is kept, repeated ones too. A null or empty text has 0 bytes and
    0 tokens; a null doc_id stays null; an empty table gives an empty result;
    other columns of ``docs``, whatever their names, are ignored. Special
    strings in texts count as the library counts them by default. Very long
    texts are split and counted part by part.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path("word_bpe_49k.json")
    bounded_arrow(spark)
    rows = only(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    frequent = spark.sparkContext.broadcast(frequent_lengths(rows, path) if rows.rdd.getNumPartitions() else zlib.compress(b"[[], []]"))
    return rows.mapInArrow(_count(path, frequent, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
