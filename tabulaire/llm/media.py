"""Operator 6: media columns with content-defined chunks.

A payload is cut where a rolling gear hash of its last bytes meets a mask, so
equal passages give equal chunks wherever they stand. A task keeps each
distinct chunk it meets once, compressed, in a pack file. Spark joins then
give every digest one place (the smallest of those it was written to), and an
ordered list of places reconstructs each medium, whose digest is verified.

Only digests, places and lists are shuffled, never payload bytes; digests that
very many media share are joined with a salt.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from .common import bounded_arrow, hot_join, hot_keys, keep, only, shared_path, small_batches

UNIT = 192  #: payloads are padded to a positive multiple
PAD = b" "
LEAST, AVERAGE, MOST = 1024, 4096, 16_384  #: bytes of a chunk (the last may be shorter)
WINDOW = 32  #: bytes that the gear hash looks back
ROLL = 1 << 30  #: bytes of a pack after which a task begins the next
SEEN = 200_000  #: digests a task remembers as written; beyond, a repeated chunk may be written again
SLICE = 4_000_000  #: bytes hashed at once
READ = 8 << 20  #: bytes of neighbouring chunks that are read at once
MAGIC = b"CDC1"

_GEAR = np.random.default_rng(1).integers(0, 2**32, 256, np.uint32)


def gear(raw: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the last ``WINDOW`` bytes: h = 2h + gear[b], all places at once by doubling."""
    h = _GEAR[raw]
    step = 1
    while step < WINDOW:
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint32(step)
        h, step = longer, 2 * step
    return h


def cuts(payload: bytes, least: int = LEAST, average: int = AVERAGE, most: int = MOST) -> list[int]:
    """Ends of the chunks of a payload."""
    raw, shift = np.frombuffer(payload, np.uint8), np.uint32(32 - (average.bit_length() - 1))
    marks = []
    for at in range(0, len(raw), SLICE):
        back = min(at, WINDOW - 1)
        h = gear(raw[at - back : at + SLICE])[back:]
        marks.append(np.flatnonzero(h >> shift == 0) + at + 1)
    marks = np.concatenate(marks) if marks else np.zeros(0, np.int64)
    ends, start, i = [], 0, 0
    while len(raw) - start > least:
        i = int(np.searchsorted(marks, start + least))
        end = min(int(marks[i]) if i < len(marks) else len(raw), start + most, len(raw))
        ends.append(end)
        start = end
    if start < len(raw):
        ends.append(len(raw))
    return ends


def padded(raw: bytes) -> bytes:
    return raw + PAD * ((-len(raw)) % UNIT if raw else UNIT)


def recipe(n_bytes: int, chunks: list[tuple[bytes, int]]) -> bytes:
    """The stored form of a medium: magic, unpadded length, and each chunk's SHA-256 and length in order."""
    return MAGIC + n_bytes.to_bytes(8, "little") + b"".join(d + n.to_bytes(4, "little") for d, n in chunks)


def parts(stored: bytes) -> tuple[int, list[tuple[bytes, int]]]:
    if stored[:4] != MAGIC:
        raise ValueError("not a chunk list")
    return int.from_bytes(stored[4:12], "little"), [(stored[i : i + 32], int.from_bytes(stored[i + 32 : i + 36], "little")) for i in range(12, len(stored), 36)]


def _compress(chunk: bytes) -> bytes:
    return zlib.compress(chunk, 1)


def _write(root: str):
    schema = pa.schema([("doc_id", pa.int64()), ("media", pa.binary()), ("fresh", pa.list_(pa.struct([("digest", pa.binary()), ("pack", pa.string()), ("offset", pa.int64()), ("size", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        out, name, at, seen = None, "", 0, set()
        for batch in small_batches(batches, "raw"):
            media, fresh = [], []
            for raw in batch.column("raw").to_pylist():
                payload, start, chunks, new = padded(raw), 0, [], []
                for end in cuts(payload):
                    chunk = payload[start:end]
                    digest = hashlib.sha256(chunk).digest()
                    chunks.append((digest, end - start))
                    start = end
                    if digest in seen:
                        continue
                    if len(seen) < SEEN:
                        seen.add(digest)
                    if out is None or at > ROLL:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.pack", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    data = _compress(chunk)
                    out.write(data)
                    new.append({"digest": digest, "pack": name, "offset": at, "size": len(data)})
                    at += len(data)
                media.append(recipe(len(raw), chunks))
                fresh.append(new)
            yield pa.record_batch([batch.column("doc_id"), pa.array(media, pa.binary()), pa.array(fresh, schema.field("fresh").type)], schema=schema)
        if out is not None:
            out.close()

    return run


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(m, i, d) for m, stored in zip(batch.column("medium").to_pylist(), batch.column("media").to_pylist(), strict=True) for i, (d, _) in enumerate(parts(stored)[1])]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["medium", "position", "digest"])


def feature_of(samples: bytes) -> str:
    """Whole-number features of 8-bit samples: mean and standard deviation in hundredths, crossings of 128 and distinct values."""
    x = np.frombuffer(samples, np.uint8)
    mean = int(x.sum(dtype=np.int64)) * 100 // len(x)
    spread = int((x.astype(np.int64) ** 2).sum()) * 10_000 // len(x) - mean * mean
    high = x >= 128
    return f"mean={mean};sd={int(max(spread, 0) ** 0.5)};crossings={int((high[1:] != high[:-1]).sum())};values={len(np.unique(x))}"


def reads(places: list[dict], most: int = READ) -> Iterator[tuple[str, int, int, list[int]]]:
    """(pack, offset, size, places by number) of each read that a list of chunks takes: chunks that lie side by side in a pack are read at once, up to ``most`` bytes."""
    run: tuple[str, int, int, list[int]] | None = None
    for i in sorted(range(len(places)), key=lambda i: (places[i]["pack"], places[i]["offset"])):
        pack, offset, size = places[i]["pack"], places[i]["offset"], places[i]["size"]
        if run and run[0] == pack and offset <= run[1] + run[2] and offset + size - run[1] <= max(most, run[2]):
            run = (pack, run[1], max(run[2], offset + size - run[1]), [*run[3], i])
        else:
            if run:
                yield run
            run = (pack, offset, size, [i])
    if run:
        yield run


def _read(root: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        files: dict = {}
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "stored_bytes")}
            payloads = []
            for doc_id, stored, places in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), batch.column("places").to_pylist(), strict=True):
                n_bytes, chunks = parts(stored)
                places = sorted(places, key=lambda p: p["position"])
                read, sizes = [b""] * len(chunks), {}
                if len(places) != len(chunks):
                    raise ValueError(f"{len(chunks) - len(places)} chunks have no place")
                for pack, offset, size, own in reads(places):
                    if pack not in files:
                        if len(files) >= 64:
                            files.pop(next(iter(files))).close()
                        files[pack] = store.open_input_file(f"{base}/{pack}")
                    files[pack].seek(offset)
                    raw = files[pack].read(size)
                    for i in own:
                        (digest, length), at = chunks[i], places[i]["offset"] - offset
                        chunk = zlib.decompress(raw[at : at + places[i]["size"]])
                        if len(chunk) != length or hashlib.sha256(chunk).digest() != digest:
                            raise ValueError(f"damaged chunk {digest.hex()}")
                        read[i] = chunk
                        sizes[digest] = places[i]["size"]
                payload = b"".join(read)
                for column, value in zip(rows.values(), (doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(payload), len(stored) + sum(sizes.values())), strict=True):
                    column.append(value)
                if with_payload:
                    payloads.append(payload)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.record_batch([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)] + [pa.array(payloads, pa.binary())] * with_payload, names=[*rows, *["payload"] * with_payload])

    return run


def store_media(docs: DataFrame, root: str | None = None, *, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """Writes the packs; the table of media has medium (a row id), doc_id, media (the stored chunk list) and places (position, pack, offset, size).

    A null text is an empty payload. Rows that repeat are media of their own
    whose chunks are shared.
    """
    spark = docs.sparkSession
    bounded_arrow(spark, 256)
    root = root or shared_path(spark, "packs")
    rows = only(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")).alias("raw"))
    store, base = fs.FileSystem.from_uri(root)
    store.create_dir(base, recursive=True)
    written = rows.mapInArrow(_write(root), "doc_id long, media binary, fresh array<struct<digest: binary, pack: string, offset: bigint, size: int>>")
    written = keep(written.withColumn("medium", F.monotonically_increasing_id()), "media")
    # one place a digest: the smallest, whichever tasks wrote it
    chunks = written.select(F.explode("fresh").alias("c")).groupBy("c.digest").agg(F.min(F.struct("c.pack", "c.offset", "c.size")).alias("place"))
    wanted = written.select("medium", "media").mapInArrow(_list, "medium long, position int, digest binary")
    hot = hot_keys(wanted, "digest", wanted.count())
    placed = hot_join(wanted, chunks, "digest", ["medium", "position"], hot).select("medium", F.struct("position", "place.pack", "place.offset", "place.size").alias("p"))
    lists = placed.groupBy("medium").agg(F.collect_list("p").alias("places"))
    return written.select("medium", "doc_id", "media").join(lists, "medium"), root


def read_media(media: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """Reconstructs and verifies the media of ``store_media``: doc_id, sizes and digests of payload and stored form, feature, stored_bytes (the chunk list and its distinct chunks as compressed)."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, stored_bytes long"
    return media.select("doc_id", "media", "places").mapInArrow(_read(root, with_payload), schema + ", payload binary" * with_payload)


def media_round_trip(docs: DataFrame) -> DataFrame:
    """Stores every text of ``docs`` (doc_id, text) as 8-bit samples and reads it back.

    Per row: doc_id, n_bytes (UTF-8), payload_bytes, payload_sha256, tail_crc32
    (last 16 bytes), media_bytes and media_sha256 (the stored chunk list),
    feature, stored_bytes (the chunk list and the compressed chunks that it
    names, each once, whether or not other media share them). Null and empty texts are one unit of padding; a null doc_id stays
    null; repeated rows are kept; an empty table gives an empty result; other
    columns are ignored.
    """
    return read_media(*store_media(docs))
