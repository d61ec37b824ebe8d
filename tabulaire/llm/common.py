"""Helpers that several operators share: shared storage, column clashes, bounded batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that one numpy or tokenizer step works on at a time.
STEP_BYTES = 2_000_000


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a session on one machine (as in tests) leaves it unset a fresh folder
    is made and set, so later calls of the same session use it too; on a cluster
    that is an error, for no folder of one machine would be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tabulaire-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/tabulaire/{name}-{uuid.uuid4().hex[:12]}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and rereads it.

    This cuts lineage: a lost executor costs a reread, never a recomputation,
    and non-deterministic columns (row ids) hold still from here on.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._kept_at = path
    return kept


def forget(kept: DataFrame) -> None:
    """Deletes a table that ``keep`` wrote, once what was made of it is written itself."""
    spark = kept.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(kept._kept_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named columns of ``df``, renamed; others, however named, are left behind.

    ``only(df, id="doc_id")`` has the single column ``id``. Names are quoted,
    so dots in other columns do no harm.
    """
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in columns.items()])


def fold_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``, without copying."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = total = 0
        for i, n in enumerate(sizes):
            if i > at and total + n > most:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += n
        if at < batch.num_rows:
            yield batch.slice(at)


def bounded_arrow(spark: SparkSession, rows: int = 1024) -> None:
    """Caps rows per Arrow batch, so that a run of very long texts stays within a worker's memory.

    The cap stays in the session: results are lazy, and are planned with it when they are asked for.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer files are; each operator takes the path as a parameter."""
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join("/opt/tokenizers", name)
    return public_tokenizers.path(name)


def often(total: int) -> int:
    """A key with so many of ``total`` rows is dealt over several tasks; no more than 50,000 keys can have them."""
    return max(10_000, total // 50_000 + 1)


def hot_keys(rows: DataFrame, on: str, total: int) -> DataFrame:
    """Keys that ``often`` of ``rows`` (of which there are ``total``) have. Counting is partial before it is shuffled."""
    return rows.groupBy(on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often(total)).select(on)


def hot_join(left: DataFrame, right: DataFrame, on: str, spread: list[str], hot: DataFrame, how: str = "inner", salts: int = 64) -> DataFrame:
    """Joins on ``on`` and deals only the ``hot`` keys (from ``hot_keys``, so few enough to broadcast) over ``salts`` tasks.

    ``right`` has one row a key; its rows are repeated for hot keys alone.
    """
    marks = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    dealt = left.join(marks, on, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0)).drop("_hot")
    last = F.when(F.col("_hot"), salts - 1).otherwise(0)
    copies = right.join(marks, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_hot")
    return dealt.join(copies.hint("merge"), [on, "_salt"], how).drop("_salt")


SIEVE_BITS = 1 << 27  #: of a sieve at most (16 MB); a full one lets all rows pass


class Sieve:
    """A test of 64-bit hashes: a Bloom filter that is broadcast, for columns (by call) and arrays (by ``passes``)."""

    def __init__(self, shared, bits: int):
        self.shared, self.bits, self._marks = shared, bits, None

    def __getstate__(self):
        return {"shared": self.shared, "bits": self.bits, "_marks": None}

    def places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        h = h.astype(np.int64).view(np.uint64)
        for by in (0, 21, 37):
            yield ((h >> np.uint64(by)) & np.uint64(self.bits - 1)).astype(np.int64)

    def passes(self, h: np.ndarray) -> np.ndarray:
        if self._marks is None:
            self._marks = np.frombuffer(zlib.decompress(self.shared.value), np.uint8)
        ok = np.ones(len(h), bool)
        for at in self.places(h):
            ok &= (self._marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return ok

    def __call__(self, h: Column) -> Column:
        def test(x: pa.Array) -> pa.Array:
            return pa.array(self.passes(x.to_numpy(zero_copy_only=False)), pa.bool_())

        return F.arrow_udf(test, "boolean")(h)


def sieve(keys: DataFrame) -> Sieve:
    """A test that every key of ``keys`` (key, not null) passes, and few other hashes.

    Its size follows the number of keys and is bounded. It spares rows a join
    that goes on to decide, so it may let any row pass but never holds one back.
    """
    spark = keys.sparkSession
    bits = min(SIEVE_BITS, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    places = Sieve(None, bits).places

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for at in places(batch.column("key").to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(marks, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        yield pa.record_batch([pa.array([zlib.compress(marks.tobytes(), 1)], pa.binary())], names=["marks"])

    unpack = lambda b: np.frombuffer(zlib.decompress(b), np.uint8)
    parts = keys.select("key").mapInArrow(mark, "marks binary").rdd.map(lambda r: bytes(r[0]))
    empty = zlib.compress(bytes(bits // 8))
    return Sieve(spark.sparkContext.broadcast(parts.treeReduce(lambda a, b: zlib.compress((unpack(a) | unpack(b)).tobytes(), 1), depth=3) if parts.getNumPartitions() else empty), bits)
