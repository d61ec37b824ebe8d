"""Operator 3: WARC archives with a two-level capture index.

Writing: payloads are staged first, each as a run of deflate blocks in a pack of
the task that read it, and a row of a few words stays for each page. Of records
with equal payloads the smallest page_id is the response and the others are
revisits of it; that is found out on those rows alone. Records are then written pack by pack, one gzip
member each, in archives of up to ``ROLL`` bytes: the staged blocks go between
those of the headers as they are. So no payload is ever shuffled, however many
digests repeat, and none is compressed twice.

Index: every capture's key (reversed host, path, page) sorted over shards; each
shard file holds compressed blocks of ``BLOCK`` lines and, at its end, a sparse
directory with one entry a block. Reading: keys are binary-searched in the list
of shards, in a shard's directory and in a block, and the record is a range
read of its archive; a revisit's payload is that of the capture it names.

Files are written under unique names, and only the names that a successful task
returns are used, so a task that is run again does no harm.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from .common import bounded_arrow, forget, hot_join, keep, often, only, shared_path, small_batches

ROLL = 1 << 30  #: bytes of an archive after which a task begins the next
BLOCK = 1024  #: index lines in a compressed block
SHARDS = 4096  #: index shards at most: their first keys are what the readers are given
OPEN = 32  #: archives, blocks and directories a reading task keeps
DATE = "2024-01-01T00:00:00Z"
URN = "urn:page:"
SEEN = 200_000  #: digests a task remembers as staged; beyond, a repeated payload may be staged again
PART = 128 << 20  #: bytes of staged payloads that a task makes records of, about
CHECKED = 4096  #: responses that a reading task remembers as checked


class Recent(OrderedDict):
    """A cache of the ``most`` things used last."""

    def __init__(self, most: int = OPEN):
        super().__init__()
        self.most = most

    def get_or(self, key, make):
        if key not in self:
            self[key] = make()
            if len(self) > self.most:
                self.popitem(last=False)
        self.move_to_end(key)
        return self[key]


def surt(url: str | None) -> str:
    """Reversed host, ``)``, and the rest: keys of a domain sort together."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return quote(url or "", safe="/:?=&%")
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, _, port = quote(rest[:cut].lower(), safe=":@[]%").partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + quote(rest[cut:], safe="/:?=&%#")


def capture_key(url: str | None, page_id: int | None) -> str:
    return f"{surt(url)} {'-' if page_id is None else f'{page_id + 2**63:020d}'}"


def base32(hex_sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_sha1)).decode()


def record_head(url: str | None, page_id: int | None, length: int, digest: str, first: int | None = None, first_key: str = "") -> bytes:
    """All of a WARC record before its payload of ``length`` bytes: a response, or (``first``: the response's page, ``first_key``: its capture key) a revisit, which ends there."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    named = "" if page_id is None else str(page_id)
    lines = ["WARC/1.0", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <{URN}{named}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if first is not None:
        lines += [f"WARC-Refers-To: <{URN}{first}>", f"Refers-To-Capture: {first_key}", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (length if first is None else 0)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def deflate(data: bytes, last: bool = False) -> bytes:
    """Whole bytes of deflate blocks, which others may follow unless they are the ``last``."""
    c = zlib.compressobj(4, zlib.DEFLATED, -15)
    return c.compress(data) + c.flush(zlib.Z_FINISH if last else zlib.Z_FULL_FLUSH)


def member(head: bytes, payload: bytes, blocks: bytes) -> bytes:
    """The gzip member of a record, from its head and its payload, which ``blocks`` has deflated."""
    end = b"\r\n\r\n"
    crc = zlib.crc32(end, zlib.crc32(payload, zlib.crc32(head)))
    size = (len(head) + len(payload) + len(end)) & 0xFFFFFFFF
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + deflate(head) + blocks + deflate(end, True) + struct.pack("<II", crc, size)


def parse(member: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, the payload's full length and the stored payload (empty for a revisit) of a gzipped record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    return fields, length, payload


class Rolling:
    """Files of about ``ROLL`` bytes under unique names, one open at a time."""

    def __init__(self, root: str, ending: str):
        self.store, self.base = fs.FileSystem.from_uri(root)
        self.ending, self.out, self.name, self.at = ending, None, "", 0

    def write(self, data: bytes) -> tuple[str, int, int]:
        """Where ``data`` now is: name, offset, length."""
        if self.out is None or self.at > ROLL:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}{self.ending}", 0
            self.out = self.store.open_output_stream(f"{self.base}/{self.name}", compression=None)
        self.out.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


_STAGED = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("sha1", pa.string()), ("bytes", pa.int64()), ("pack", pa.string()), ("start", pa.int64()), ("size", pa.int64())])


def _stage(root: str):
    """Rows (page_id, url, payload, sha1) to where their payloads are staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs, seen = Rolling(root, ".pack"), {}
        for batch in small_batches(batches, "payload"):
            rows = []
            for page_id, url, payload, sha1 in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1")], strict=True):
                place = seen.get(sha1) or packs.write(deflate(payload))
                if len(seen) < SEEN:
                    seen[sha1] = place
                rows.append((capture_key(url, page_id), page_id, url, sha1, len(payload), *place))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _STAGED, strict=True)], schema=_STAGED)
        packs.close()

    return run


def _write(packs: str, root: str):
    """Staged rows, in the order of their packs, to the places of their records."""
    names = ("key", "page_id", "url", "sha1", "bytes", "pack", "start", "size", "refers_to", "refers_to_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(packs)
        archives, files = Rolling(root, ".warc.gz"), Recent()
        for batch in batches:
            places = []
            for _, page_id, url, sha1, length, pack, start, size, first, first_key in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                payload, blocks = b"", b""
                if first is None:
                    f = files.get_or(pack, lambda: store.open_input_file(f"{base}/{pack}"))  # noqa: B023
                    f.seek(start)
                    blocks = f.read(size)
                    payload = zlib.decompressobj(-15).decompress(blocks)
                    if hashlib.sha1(payload).hexdigest() != sha1:
                        raise ValueError(f"damaged payload of page {page_id}")
                places.append(archives.write(member(record_head(url, page_id, length, base32(sha1), first, first_key), payload, blocks)))
            name, at, n = zip(*places, strict=True) if places else ((), (), ())
            yield pa.record_batch([batch.column("key"), pa.array(name, pa.string()), pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["key", "archive", "offset", "length"])
        archives.close()

    return run


def _index(root: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        name, out, at, lines, directory, last, n = f"{uuid.uuid4().hex}.idx", None, 0, [], [], "", 0

        def flush() -> int:
            data = zlib.compress(json.dumps(lines).encode())
            out.write(data)
            directory.append((lines[0][0], at, len(data)))
            return at + len(data)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("key", "archive", "offset", "length")], strict=True):
                out = out or store.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(row)
                last, n = row[0], n + 1
                if len(lines) == block:
                    at = flush()
                    lines = []
        if out is None:
            return
        if lines:
            at = flush()
        data = zlib.compress(json.dumps(directory).encode())
        out.write(data + struct.pack("<qq", at, len(data)))
        out.close()
        row = {"shard": name, "first_key": directory[0][0], "last_key": last, "blocks": len(directory), "captures": n}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("shard", pa.string()), ("first_key", pa.string()), ("last_key", pa.string()), ("blocks", pa.int64()), ("captures", pa.int64())]))

    return run


class CaptureIndex:
    """Lookups of capture keys: shards, then a shard's block directory, then a block, each by binary search."""

    def __init__(self, root: str, shards: list[tuple[str, str]]):
        self.store, self.base = fs.FileSystem.from_uri(root)
        self.firsts, self.shards = [s[0] for s in shards], [s[1] for s in shards]
        self.directories, self.blocks, self.archives = Recent(), Recent(), Recent()

    def _directory(self, shard: str):
        f = self.store.open_input_file(f"{self.base}/{shard}")
        f.seek(f.size() - 16)
        at, n = struct.unpack("<qq", f.read(16))
        f.seek(at)
        entries = json.loads(zlib.decompress(f.read(n)))
        return f, [e[0] for e in entries], entries

    def _block(self, f, at: int, n: int):
        f.seek(at)
        lines = json.loads(zlib.decompress(f.read(n)))
        return [x[0] for x in lines], lines

    def lookup(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of every capture of ``key``."""
        s = bisect.bisect_right(self.firsts, key) - 1
        if s < 0:
            return
        f, firsts, entries = self.directories.get_or(self.shards[s], lambda: self._directory(self.shards[s]))
        b = max(bisect.bisect_left(firsts, key) - 1, 0)
        while b < len(entries) and firsts[b] <= key:
            keys, lines = self.blocks.get_or((self.shards[s], b), lambda: self._block(f, *entries[b][1:]))  # noqa: B023
            for i in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key)):
                yield tuple(lines[i][1:])
            b += 1

    def fetch(self, archive: str, offset: int, length: int) -> bytes:
        f = self.archives.get_or(archive, lambda: self.store.open_input_file(f"{self.base}/{archive}"))
        f.seek(offset)
        return f.read(length)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix(f"<{URN}").removesuffix(">")
    return int(number) if number else None


def _checked(index: CaptureIndex, place: tuple[str, int, int]) -> tuple[dict[str, str], int, bytes]:
    """The record at ``place``, its payload (if it is a response) held against length and digest."""
    fields, length, payload = parse(index.fetch(*place))
    if fields["WARC-Type"] == "response" and (len(payload) != length or f"sha1:{base32(hashlib.sha1(payload).hexdigest())}" != fields["WARC-Payload-Digest"]):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, length, payload


def _original(index: CaptureIndex, fields: dict[str, str], length: int, with_payload: bool) -> tuple[int, bytes]:
    """A checked length, and the payload, of the response that a revisit names."""
    for place in index.lookup(fields["Refers-To-Capture"]):
        found, n, payload = _checked(index, place)
        if found["WARC-Type"] == "response" and (n, found["WARC-Payload-Digest"]) == (length, fields["WARC-Payload-Digest"]):
            return n, payload if with_payload else b""
    raise ValueError(f"revisit {fields['WARC-Record-ID']} without its response")


def _read(root: str, shards: list[tuple[str, str]], with_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, originals = CaptureIndex(root, shards), Recent(OPEN if with_payload else CHECKED)
        for batch in batches:
            rows, held = [], 0
            for key in batch.column("key").to_pylist():
                for place in index.lookup(key):
                    fields, length, payload = _checked(index, place)
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "revisit":
                        length, payload = originals.get_or((fields["Refers-To-Capture"], digest), lambda: _original(index, fields, length, with_payload))  # noqa: B023
                    rows.append({"page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": _page(fields.get("WARC-Refers-To"))} | ({"payload": payload} if with_payload else {}))
                    held += length * with_payload
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


@dataclass
class Archives:
    """What was written: the folder, a table of captures (key, archive, offset, length) and one of index shards."""

    root: str
    captures: DataFrame
    shards: DataFrame

    def read(self, keys: DataFrame, with_payload: bool = False) -> DataFrame:
        """The records of ``keys`` (key, from ``capture_key``), each distinct key looked up once; a revisit has the payload of its response."""
        listed = sorted((r.first_key, r.shard) for r in self.shards.select("first_key", "shard").collect())
        wanted = keys.select("key").distinct()
        dealt = wanted.repartitionByRange(16 * max(1, len(listed)), "key").sortWithinPartitions("key")
        names = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        return dealt.mapInArrow(_read(self.root, listed, with_payload), names + ", payload binary" * with_payload)


def keys_of(pages: DataFrame) -> DataFrame:
    """Capture keys of rows of (page_id, url)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([pa.array(list(map(capture_key, b.column("url").to_pylist(), b.column("page_id").to_pylist())), pa.string())], names=["key"])

    return pages.select("page_id", "url").mapInArrow(run, "key string")


def write_archives(pages: DataFrame, root: str | None = None, least: int = 0, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> Archives:
    """Writes a WARC record per row of ``pages`` and indexes the captures.

    Payloads are the html in UTF-8; null html is an empty payload. Of rows with
    equal payloads of at least ``least`` bytes, those of the smallest page_id
    are responses and the others revisits (a null page_id comes after all
    others; rows that repeat the smallest page_id are each a response). A null
    or odd url is archived all the same. An empty table makes no files. Other
    columns are ignored.
    """
    spark = pages.sparkSession
    bounded_arrow(spark, 256)
    root, packs = root or shared_path(spark, "warc"), shared_path(spark, "staged")
    for path in (root, packs):
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
    rows = only(pages, page_id=page_id, url=url, html=html).select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    staged = keep(rows.mapInArrow(_stage(packs), "key string, page_id long, url string, sha1 string, bytes long, pack string, start long, size long"), "staged-rows")
    # the smallest page_id of each repeated digest, and that page's capture key; null ids come last
    once = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "key"))).alias("least")
    firsts = staged.where(F.col("bytes") >= least).groupBy("sha1").agg(once, F.count("*").alias("n")).where("n > 1 and least is not null")
    firsts = keep(firsts.select("sha1", "n", F.col("least.page_id").alias("first"), F.col("least.key").alias("first_key")), "payloads")
    n_rows, total = staged.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    hot = firsts.where(F.col("n") >= often(n_rows)).select("sha1")
    joined = hot_join(staged, firsts.drop("n"), "sha1", ["key"], hot, "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("bytes") >= least)
    joined = joined.withColumns({"refers_to": F.when(again, F.col("first")), "refers_to_key": F.when(again, F.col("first_key"))}).drop("first", "first_key")
    parts = max(1, -(-total // PART), min(spark.sparkContext.defaultParallelism, total >> 20))
    captures = keep(joined.repartition(parts, "pack").sortWithinPartitions("pack", "start").mapInArrow(_write(packs, root), "key string, archive string, offset long, length long"), "captures")
    store, base = fs.FileSystem.from_uri(packs)
    store.delete_dir(base)
    forget(staged)
    forget(firsts)
    n = min(SHARDS, max(1, captures.count() // (16 * BLOCK)))
    by_key = captures.repartitionByRange(n, "key").sortWithinPartitions("key", "archive", "offset")
    shards = keep(by_key.mapInArrow(_index(root, BLOCK), "shard string, first_key string, last_key string, blocks long, captures long"), "index")
    return Archives(root, captures, shards)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Archives every row of ``pages``, then reads every capture back through the index.

    Per record: page_id, payload_bytes, payload_digest (bare base32 SHA-1 of the
    full payload), record_type and refers_to.
    """
    archives = write_archives(pages)
    return archives.read(keys_of(only(pages, page_id="page_id", url="url").withColumn("page_id", F.col("page_id").cast("long"))))


def sql() -> str:
    """The same rows from the table itself; base 32 is spelled out, five bits a character."""
    bits = "array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(sha1, i, 1) AS INT)), 4, '0')), '')"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha1 FROM pages),
b AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, {bits} AS bits, min(page_id) OVER (PARTITION BY sha1) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(0, 5), lambda k: CAST(substr(bits, CAST(j * 5 + k + 1 AS INT), 1) AS INT) * CAST(power(2, 4 - k) AS INT))) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b"""
