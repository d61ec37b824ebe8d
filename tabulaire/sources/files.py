"""Bytes on any file system that Spark reaches: parts joined to one object, ranges, streams and copies, none of them held whole."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import SparkSession

BUFFER = 4 << 20  #: bytes that are on their way at once


def at(spark: SparkSession, path: str):
    """The file system of ``path``, and the path there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_stream(spark: SparkSession, path: str, chunks: Iterable[bytes]) -> int:
    """Writes chunks one after the other, replacing what is there once all of them are written; the bytes written."""
    fs, to = at(spark, path)
    temporary = at(spark, f"{path}.writing")[1]
    out, total = fs.create(temporary, True), 0
    try:
        for chunk in chunks:
            for i in range(0, len(chunk), BUFFER):
                out.write(bytearray(chunk[i : i + BUFFER]))
            total += len(chunk)
    except BaseException:
        out.close()
        fs.delete(temporary, False)
        raise
    out.close()
    _put(fs, temporary, to, path)
    return total


def _put(fs, temporary, to, path: str) -> None:
    fs.delete(to, True)
    if not fs.rename(temporary, to):
        raise OSError(f"cannot write {path}")


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = at(spark, path)
    return int(fs.getFileStatus(p).getLen())


def read_range(spark: SparkSession, path: str, offset: int, length: int) -> bytes:
    """``length`` bytes from ``offset`` on, fewer at the end of the object."""
    return b"".join(read_stream(spark, path, offset=offset, length=length))


def read_stream(spark: SparkSession, path: str, chunk: int = BUFFER, *, offset: int = 0, length: int | None = None) -> Iterator[bytes]:
    """The bytes of an object (or a range of them) in chunks; no more than one of them is held."""
    fs, p = at(spark, path)
    left = max(0, int(fs.getFileStatus(p).getLen()) - offset)
    left = left if length is None else min(left, length)
    source = fs.open(p)
    try:
        source.seek(offset) if left else None
        while left:
            n = min(chunk, left)
            yield bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source, n))
            left -= n
    finally:
        source.close()


def copy_object(spark: SparkSession, source: str, target: str) -> int:
    """Copies an object of any size from stream to stream in the JVM, replacing what is there; its bytes."""
    (from_fs, a), (to_fs, b) = at(spark, source), at(spark, target)
    temporary = at(spark, f"{target}.writing")[1]
    jvm = spark._jvm
    taken, out = from_fs.open(a), to_fs.create(temporary, True)
    try:
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(taken, out, BUFFER, False)
    finally:
        taken.close()
        out.close()
    _put(to_fs, temporary, b, target)
    return int(to_fs.getFileStatus(b).getLen())


def copy_objects(spark: SparkSession, pairs: Iterable[tuple[str, str]], at_once: int = 8) -> list[int]:
    """``copy_object`` of many (source, target) pairs, ``at_once`` at a time; the first failure is raised when the others are done."""
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(copy_object, spark, a, b) for a, b in pairs]]


def join_parts(spark: SparkSession, folder: str, path: str, head: bytes = b"") -> None:
    """Makes the parts of ``folder``, in the order of their names and after ``head``, the object ``path``; the folder is gone afterwards.

    A file system that can join files without reading them does (``concat``), else
    they are streamed one after the other in the JVM; no part passes through
    Python or is held in memory.
    """
    fs, source = at(spark, folder)
    to, temporary = at(spark, path)[1], at(spark, f"{folder}/_joined")[1]
    parts = sorted((s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-") and s.getLen()), key=lambda p: p.getName())
    out = fs.create(temporary, True)
    out.write(bytearray(head))
    out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    array = gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, p in enumerate(parts):
        array[i] = p
    joined = not parts
    if parts and head:  # some file systems join to a file with content only
        try:
            fs.concat(temporary, array)
            joined = True
        except UnsupportedOperationException:
            pass
    if not joined:
        out = fs.create(temporary, True)
        out.write(bytearray(head))
        for p in parts:
            taken = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(taken, out, BUFFER, False)
            finally:
                taken.close()
        out.close()
    _put(fs, temporary, to, path)
    fs.delete(source, True)
