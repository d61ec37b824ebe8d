"""Words, hashed and sampled: what the near-duplicate join and the classifiers share.

A word is a run of letters, digits and non-ASCII characters, A-Z lower-cased.
Texts are hashed as whole arrays of bytes, never word by word in Python.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import bounded_arrow, small_batches

#: UTF-8 bytes of a word, after lower-casing.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_LOW = np.array([b if WORD.match(bytes([b]).lower()) else 0 for b in bytes(range(256)).lower()], np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_SPAN = 1 << 16
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.r_[np.uint64(1), np.full(_SPAN, _ODD)], dtype=np.uint64)
    _BACK = np.cumprod(np.r_[np.uint64(1), np.full(_SPAN, np.uint64(pow(int(_ODD), -1, 2**64)))], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(raw: np.ndarray) -> Iterator[np.ndarray]:
    """``raw`` in parts of less than ``_SPAN`` bytes that end between words (or, where a word is over 4096 bytes, inside it: its hash is carried on)."""
    at = 0
    while len(raw) - at >= _SPAN:
        part = raw[at : at + _SPAN - 1]
        gaps = np.flatnonzero(_LOW[part[-4096:]] == 0)
        stop = at + (_SPAN - 1 - min(4096, len(part)) + int(gaps[-1]) + 1 if len(gaps) else _SPAN - 1)
        yield raw[at:stop]
        at = stop
    yield raw[at:]


def _sums(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and stop in ``part``, the sums that hash them, and the running total of the bytes."""
    low = _LOW[part]
    edge = np.flatnonzero(np.diff(np.r_[0, low != 0, 0].astype(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    total = np.r_[np.uint64(0), np.cumsum(low * _POWER[: len(low)], dtype=np.uint64)]
    return starts, stops, (total[stops] - total[starts]) * _BACK[starts], total


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text, in order; a word of any length, wherever it stands, has one hash."""
    sums, sizes = [], []
    begun, size = 0, 0  # sum and bytes of the word that the last part ended in
    with np.errstate(over="ignore"):
        for part in _spans(np.frombuffer(raw, np.uint8)):
            starts, stops, own, _ = _sums(part)
            n = (stops - starts).astype(np.uint64)
            if size:
                if len(starts) and not starts[0]:
                    own[0] = (begun + pow(int(_ODD), size, 1 << 64) * int(own[0])) % (1 << 64)
                    n[0] += np.uint64(size)
                else:
                    own, n = np.r_[np.uint64(begun), own], np.r_[np.uint64(size), n]
                begun = size = 0
            if len(raw) >= _SPAN and len(stops) and stops[-1] == len(part):
                begun, size = int(own[-1]), int(n[-1])
                own, n = own[:-1], n[:-1]
            sums.append(own)
            sizes.append(n)
        if size:
            sums.append(np.array([begun], np.uint64))
            sizes.append(np.array([size], np.uint64))
        own, n = (sums[0], sizes[0]) if len(sums) == 1 else (np.concatenate(sums), np.concatenate(sizes))
        return mix(own + n)


def to_bytes(text: str | None) -> bytes:
    return text.encode() if text else b""


def labelled_sample(docs: DataFrame, labels: DataFrame, most_rows: int, seed: str, most_chars: int = 16_000_000) -> list[tuple[str, object]]:
    """A bounded training sample of (text, value): ``most_rows`` rows at most in equal shares for each value, about ``most_chars`` characters.

    ``labels`` has (doc_id, value) and is all that is counted and drawn from:
    each value's ids of the smallest hashes, so a fair draw that is
    the same at any partitioning. Every value is in the sample; of more values than
    ``most_rows`` the most frequent are, with a warning. Texts are then fetched for the
    drawn ids alone. The draw ends with the first text that goes beyond the characters (texts
    longer than all of them are passed over), so it favours no length. Null values, ids and texts take no part.
    An id is drawn once however often it is labelled (with the least of its values that
    may be drawn), and stands for one of its texts, the one of the smallest hash; so both bounds
    hold for any tables, and no more than about the rows asked for are collected.
    """
    spark = docs.sparkSession
    labels = labels.where("doc_id is not null and value is not null").withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
    found = labels.groupBy("value").agg(F.count(F.lit(1)).alias("count"), F.approx_count_distinct("h", 0.05).alias("ids")).orderBy(F.desc("count"), "value").limit(most_rows + 1).collect()
    if len(found) > most_rows:
        warnings.warn(f"more than {most_rows} label values: only the most frequent are learned", stacklevel=2)
    counts = {r.value: r.ids for r in sorted(found[:most_rows], key=lambda r: r.value)}
    if not counts:
        return []
    share = max(1, most_rows // len(counts))
    # hashes are uniform, so this many of the smallest hold the share's ids and few more, even if there are a third fewer than estimated
    parts = {v: min(1.0, 1.5 * (share + 6 * share**0.5 + 6) / n) for v, n in counts.items()}
    bounds = spark.createDataFrame([(v, min(2**63 - 1, int(p * 2**64) - 2**63)) for v, p in parts.items()], T.StructType([labels.schema["value"], T.StructField("bound", T.LongType())]))
    near = labels.join(F.broadcast(bounds), "value").where("h <= bound").groupBy("h", "doc_id").agg(F.min("value").alias("value"))
    drawn: dict = {}
    taken: dict = dict.fromkeys(counts, 0)
    for r in sorted(near.collect()):
        if taken[r.value] < share:
            drawn[r.doc_id] = r.value
            taken[r.value] += 1
    rows = docs.select("doc_id", "text").where("text is not null").withColumn("t", F.xxhash64("text"))
    ids = F.broadcast(spark.createDataFrame([(k,) for k in drawn], "doc_id long"))
    own = rows.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("t", F.length("text").alias("n"))).alias("own"))
    rank = {k: i for i, k in enumerate(drawn)}
    sizes = sorted((rank[r.doc_id], r.own.n, r.own.t, r.doc_id) for r in own.collect())
    total, fits = 0, []
    for _, n, t, k in sizes:
        if n > most_chars:
            continue
        total += n
        if total > most_chars:
            break
        fits.append((k, t))
    if not fits:
        return []
    chosen = F.broadcast(spark.createDataFrame(fits, "doc_id long, t long"))
    texts = rows.join(chosen, ["doc_id", "t"], "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return [(text, drawn[k]) for _, k, text in sorted((rank[r.doc_id], r.doc_id, r.text) for r in texts.collect())]


def score_rows(rows: DataFrame, score, schema: str, kinds: dict[str, pa.DataType]) -> DataFrame:
    """``rows`` (doc_id, held_out, text) to doc_id, held_out and what ``score(texts)`` returns by name, text by whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            got = score(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), *[pa.array(got[k], t) for k, t in kinds.items()]], names=["doc_id", "held_out", *kinds])

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id long, held_out boolean, {schema}")


def keep_rows(docs: DataFrame, keep) -> DataFrame:
    """The rows of ``docs``, all columns, for which ``keep(texts)`` says so, text by whole text; nothing is shuffled."""
    bounded_arrow(docs.sparkSession)
    at = docs.columns.index("text")
    # mapInArrow resolves columns by unquoted names, so they pass through it by number
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, f"c{at}"):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
