"""Operator 13: vectors compressed to a byte a part, by codebooks that Lloyd's rounds refine.

Vectors become whole numbers and are cut into equal parts, each with a codebook
of its own. Assignments are written with the vectors; a round reads them, assigns
anew, and shuffles only what changed: for each part whose entry changed a minus
to the sums of its old entry and a plus to those of the new one, added up inside
each task first. The running sums are exact whole numbers, ``PARTS * ENTRIES``
of them at most, so codebooks are small whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import forget, hot_join, hot_keys, keep, only

PARTS = 16
ENTRIES = 64
ROUNDS = 2
FACTOR = 256
LARGEST = 1 << 24  #: of a whole number; squared distances and sums of rows then fit 64 bits
FEW = 10_000  #: label totals that may be broadcast
_SCHEMA = "vec_id long, label string, x array<int>, codes binary, before binary"


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) to (vec_id, label, x): floor(256 * component), without vectors that are null or hold null, NaN or infinite components.

    The only check of sizes: a component of ``LARGEST / 256`` or more is an error, since nothing exact could be said of its distances.
    """
    value = F.col("embedding").cast("array<double>")
    sound = value.isNotNull() & F.coalesce(F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    number = lambda v: F.when(F.abs(v * FACTOR) < LARGEST, F.floor(v * FACTOR)).otherwise(F.raise_error(F.lit("a component is too large to be quantised"))).cast("int")
    return vectors.where(sound).select("vec_id", "label", F.transform(value, number).alias("x"))


def _rows(column: pa.Array) -> np.ndarray:
    """A list column as a matrix; rows of differing lengths are an error."""
    sizes = set(column.value_lengths().to_pylist())
    if len(sizes) != 1:
        raise ValueError(f"vectors of differing lengths: {sorted(sizes)[:5]}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), sizes.pop())


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    if x.shape[1] % parts:
        raise ValueError(f"vectors of {x.shape[1]} components cannot be cut into {parts} equal parts")
    return x.reshape(len(x), parts, x.shape[1] // parts)


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``x`` (rows, parts, width) and part: the nearest entry of ``books`` (parts, entries, width), ties to the lower index, and its squared distance."""
    codes, errors = np.empty(x.shape[:2], np.uint8), np.empty(x.shape[:2], np.int64)
    for p in range(x.shape[1]):
        far = ((x[:, p, None, :] - books[p][None]) ** 2).sum(2)
        codes[:, p] = far.argmin(1)
        errors[:, p] = np.take_along_axis(far, codes[:, p, None].astype(np.int64), 1)[:, 0]
    return codes, errors


def _assign(books, parts: int):
    """Vectors with their codes under ``books``; what they had before is kept beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                codes, _ = nearest(_cut(_rows(batch.column("x")), parts), books.value)
                yield pa.record_batch([batch.column("vec_id"), batch.column("label"), batch.column("x"), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column("codes")], names=["vec_id", "label", "x", "codes", "before"])

    return run


def _deltas(parts: int, entries: int):
    """Per task and entry one row at most: what its changed parts add to the entry's sums and count, old entries less, new ones more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = counts = None
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                batch = whole.slice(at, 8192)
                x = _cut(_rows(batch.column("x")), parts)
                if sums is None:
                    sums, counts = np.zeros((parts, entries, x.shape[2]), np.int64), np.zeros((parts, entries), np.int64)
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(x), parts)
                old = batch.column("before").to_pylist()
                known = np.array([b is not None for b in old])
                before = np.frombuffer(b"".join(b if b is not None else bytes(parts) for b in old), np.uint8).reshape(len(x), parts)
                row, part = np.nonzero((codes != before) | ~known[:, None])
                moved = x[row, part]
                np.add.at(sums, (part, codes[row, part]), moved)
                np.add.at(counts, (part, codes[row, part]), 1)
                left = known[row]
                np.subtract.at(sums, (part[left], before[row, part][left]), moved[left])
                np.subtract.at(counts, (part[left], before[row, part][left]), 1)
        if sums is not None:
            part, entry = np.nonzero(counts.astype(bool) | sums.any(2))
            yield pa.record_batch([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    return run


def _coded(books, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                codes, errors = nearest(_cut(_rows(batch.column("x")), parts), books.value)
                yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors.sum(1), pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The parts of the ``entries`` rows of the smallest ids (null last; of equal ids the lesser vectors first); None if there are no rows."""
    found = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    if not found:
        return None
    if len({len(r.x) for r in found}) > 1:
        raise ValueError("vectors of differing lengths")
    return np.ascontiguousarray(_cut(np.array([r.x for r in found], np.int64).reshape(len(found), -1), parts).transpose(1, 0, 2))


def learn(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """Rows (of ``whole_numbers``) with their last assignments, as a table of ``keep``, and the codebooks after ``rounds`` rounds."""
    spark = rows.sparkSession
    at = keep(rows.selectExpr("vec_id", "label", "x", "cast(null as binary) codes"), "vectors")
    books = first_books(at, parts, entries)
    if books is None:
        return at, None
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        assigned = keep(at.select("vec_id", "label", "x", "codes").mapInArrow(_assign(shared, parts), _SCHEMA), "vectors")
        forget(at)
        at = assigned
        changed = at.where("before is null or codes <> before").select("x", "codes", "before")
        deltas = changed.mapInArrow(_deltas(parts, books.shape[1]), "part int, entry int, n long, sums array<long>")
        width = books.shape[2]
        added = deltas.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
        for r in added.collect():  # an entry of a codebook each
            counts[r.part, r.entry] += r.n
            sums[r.part, r.entry] += np.array(r.sums, np.int64)
        used = counts > 0
        books = books.copy()
        books[used] = sums[used] // counts[used][:, None]
    return at, books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Per vector that is kept: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold a null, NaN or infinite component are left
    out. ``code`` is the index of each part's entry, two hex digits each;
    ``error`` the squared distances to the entries, ``label_error`` their sum over
    all vectors of the same label, those without one together. A codebook has
    as many entries as there are vectors, ``entries`` at most (256 or fewer).

    Repeated rows are kept and count once each. Of equal vec_ids the lesser
    vectors come first in the first codebooks, null ids last; vec_id stays null.
    Vectors of differing lengths, or of a length that ``parts`` does not divide,
    are an error, as are components of 65,536 or more; vectors without
    components have the code of as many zeros. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = vectors.sparkSession
    if not 0 < entries <= 256:
        raise ValueError(f"a code is a byte: from 1 to 256 entries, not {entries}")
    rows = only(vectors, vec_id=vec_id, embedding=embedding, label=label).withColumns({"vec_id": F.col("vec_id").cast("long"), "label": F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))})
    at, books = learn(whole_numbers(rows), parts, entries, rounds)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = keep(at.select("vec_id", "label", "x").mapInArrow(_coded(spark.sparkContext.broadcast(books), parts), "vec_id long, label string, code string, error long"), "codes")
    forget(at)
    totals = keep(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    n, all_rows = totals.agg(F.count(F.lit(1)), F.sum("n")).first()
    totals_ = totals.select("label", "label_error")
    if n <= FEW:
        joined = coded.join(F.broadcast(totals_), "label")
    else:
        joined = hot_join(coded, totals_, "label", ["vec_id", "code"], hot_keys(coded, "label", all_rows))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``compress`` over ``embeddings``."""
    assign = "SELECT r, p, x, e, d FROM (SELECT a.r, a.p, a.x, b.e, list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM cut a JOIN {books} b ON a.p = b.p) QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1"
    text = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS r, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)),
cut AS (SELECT r, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS x FROM kept, range({parts}) AS t(p)),
b0 AS (SELECT p, r - 1 AS e, x FROM cut WHERE r <= {entries})"""
    for i in range(rounds):
        text += f""",
a{i} AS ({assign.format(books=f"b{i}")}),
s{i} AS (SELECT p, e, list(v ORDER BY j) AS x FROM (SELECT p, e, j, (s - ((s % n) + n) % n) // n AS v FROM (SELECT p, e, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n FROM a{i}, range(1, 1 + (SELECT max(len(x)) FROM cut)) AS t(j) GROUP BY p, e, j)) GROUP BY p, e),
b{i + 1} AS (SELECT b.p, b.e, coalesce(s.x, b.x) AS x FROM b{i} b LEFT JOIN s{i} s ON b.p = s.p AND b.e = s.e)"""
    return (
        text
        + f""",
last AS ({assign.format(books=f"b{rounds}")}),
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""
    )
