"""Wide tables as matrices: all features of a row in one array, worked on by numpy in Arrow batches.

A table of twenty thousand columns takes Spark longer to plan than to run, so
its features are one column here, ``values``, and plans are as small as those of a
table of two columns. A feature without a value is NaN inside a batch and
null outside. Fits are states (``plans.state``) of one row a feature and task, so they
merge like any others; transforms, norms and filters are maps without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabulaire.functions.columns import named, numeric_columns, value_of
from tabulaire.operators.design import NOT_FOUND
from tabulaire.operators.normalizers import MISSING_VALUES, NORMS
from tabulaire.operators.scalers import EPS, Fitted, MaxAbs, MinMax, Robust, Scaler, Standard
from tabulaire.plans.state import SCHEMA as STATE, merged
from tabulaire.sources.delimited import _MISSING, _shown, cells_of, infer_wide, separator_of, wide_header
from tabulaire.sources.files import join_parts
from tabulaire.sources.records import records

VALUES = "values"
CELLS = 4_000_000  #: of a matrix that numpy works on at a time
HELD = 16_000_000  #: values of a block of features that one task sorts for exact quantiles

Block = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Matrix:
    """``rows`` has the other columns and ``values``, an array of doubles aligned with ``names``."""

    rows: DataFrame
    names: list[str]

    @property
    def others(self) -> list[str]:
        return [c for c in self.rows.columns if c != VALUES]

    def unpacked(self) -> DataFrame:
        """A column a feature, after the others."""
        return self.rows.select(*[named(c) for c in self.others], *[F.get(VALUES, F.lit(i)).alias(n) for i, n in enumerate(self.names)])


def pack(df: DataFrame, columns: Iterable[str] | None = None) -> Matrix:
    """The number columns of ``df`` (or those that are named) as a matrix, the others beside it."""
    names = numeric_columns(df, columns)
    others = [c for c in df.columns if c not in set(names)]
    if VALUES in others:
        raise ValueError(f"a column that stays beside the matrix is called {VALUES}")
    return Matrix(df.select(*[named(c) for c in others], F.array(*[value_of(c) for c in names]).alias(VALUES)), names)


def _cells(column: pa.Array, width: int) -> np.ndarray:
    """A batch's values as (rows, features), missing ones NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != width * len(column):
        raise ValueError(f"a row has not {width} values")
    return flat.reshape(len(column), width)


def _listed(x: np.ndarray) -> pa.Array:
    flat = x.reshape(-1)
    offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32) if x.shape[1] else np.zeros(len(x) + 1, np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.float64(), mask=np.isnan(flat)))


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    most = max(1, CELLS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


def _mapped(matrix: Matrix, block: Block, names: list[str] | None = None) -> Matrix:
    """Each row's values through ``block``, which may not change the number of rows."""
    width, at = len(matrix.names), matrix.rows.columns.index(VALUES)
    # mapInArrow resolves columns by unquoted names, so they pass through it by number
    plain = matrix.rows.toDF(*[f"c{i}" for i in range(len(matrix.rows.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, width):
            yield batch.set_column(at, batch.schema.field(at).with_type(pa.list_(pa.float64())), _listed(block(_cells(batch.column(at), width))))

    return Matrix(plain.mapInArrow(run, plain.schema).toDF(*matrix.rows.columns), names or matrix.names)


def matrix_state(matrix: Matrix) -> DataFrame:
    """The state of each feature, a row for each task, and one of no rows; ``plans.state.merged`` adds them up."""
    names, width = matrix.names, len(matrix.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n, mean, m2 = 0, np.zeros(width), np.zeros(width), np.zeros(width)
        low, high, bad = np.full(width, np.inf), np.full(width, -np.inf), np.zeros(width, bool)
        for batch in _slices(batches, width):
            x = _cells(batch.column(0), width)
            there = ~np.isnan(x)
            k = there.sum(0)
            rows += len(x)
            with np.errstate(invalid="ignore", divide="ignore"):
                bad |= np.isinf(x).any(0)
                own = np.where(k > 0, np.where(there, x, 0).sum(0) / np.maximum(k, 1), 0)
                square = (np.where(there, x - own, 0) ** 2).sum(0)
                both = np.maximum(n + k, 1)
                m2 += square + (own - mean) ** 2 * n * k / both
                mean += (own - mean) * k / both
                n += k
                low, high = np.fmin(low, np.fmin.reduce(x, 0, initial=np.inf)), np.fmax(high, np.fmax.reduce(x, 0, initial=-np.inf))
        some = n == 0
        number = lambda v: pa.array(v, pa.float64(), mask=some)
        columns = [pa.array(names), pa.array(np.full(width, rows), pa.int64()), pa.array(n.astype(np.int64)), number(mean), number(m2), number(low), number(high), number(np.maximum(np.abs(low), np.abs(high))), pa.array(bad), pa.nulls(width, pa.binary())]
        yield pa.record_batch(columns, names=[c.split()[0] for c in STATE.split(", ")])

    # a table may have no tasks at all, and has its features all the same
    nothing = matrix.rows.sparkSession.createDataFrame([(n, 0, 0, False) for n in names], "column_name string, rows long, n long, infinite boolean")
    return matrix.rows.select(VALUES).mapInArrow(run, STATE).unionByName(nothing, allowMissingColumns=True)


def matrix_quantiles(matrix: Matrix, odds: list[float], rows: int) -> dict[int, list[float | None]]:
    """Exact interpolated quantiles of each feature, by its place.

    Features are dealt in blocks that hold ``HELD`` values together, and each block is
    sorted in a task of its own; of a table of more rows than that, use ``plans.stats.quantiles``.
    """
    width = len(matrix.names)
    if rows > HELD:
        raise ValueError(f"more than {HELD} rows: take quantiles of the columns themselves")
    wide = max(1, min(width, HELD // max(1, rows), 512))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, width):
            x = _cells(batch.column(0), width)
            blocks = range(0, width, wide)
            yield pa.record_batch([pa.array([b // wide for b in blocks], pa.int32()), pa.array([np.ascontiguousarray(x[:, b : b + wide]).tobytes() for b in blocks], pa.binary())], names=["block", "cells"])

    def sort(key: tuple, table: pa.Table) -> pa.Table:
        first = key[0].as_py() * wide
        own = min(wide, width - first)
        x = np.sort(np.concatenate([np.frombuffer(c, np.float64).reshape(-1, own) for c in table.column("cells").to_pylist()]), axis=0)  # NaN last
        n = (~np.isnan(x)).sum(0)
        found = []
        for p in odds:
            at = p * np.maximum(n - 1, 0)
            lower = np.floor(at).astype(int)
            a, b = x[lower, np.arange(own)], x[np.minimum(lower + 1, np.maximum(n - 1, 0)), np.arange(own)]
            found.append(np.where(n > 0, a + (b - a) * (at - lower), np.nan))
        q = np.stack(found, 1)
        return pa.table({"at": pa.array(first + np.arange(own), pa.int32()), "q": _listed(q)})

    found = matrix.rows.select(VALUES).mapInArrow(cut, "block int, cells binary").groupBy("block").applyInArrow(sort, "at int, q array<double>")
    return {r["at"]: list(r["q"]) for r in found.collect()}


def fit_matrix(matrix: Matrix, scaler: Scaler) -> Fitted:
    """What ``scaler`` learns of all features: one scan, of the robust scaler two."""
    if not isinstance(scaler, Robust):
        return scaler.finish(merged(matrix_state(matrix)), matrix.names)
    plain = MaxAbs().finish(merged(matrix_state(matrix)), matrix.names)
    q = matrix_quantiles(matrix, scaler.odds, plain.rows) if plain.rows else {}
    center = [q[i][1] if i in q else None for i in range(len(matrix.names))]
    scale = [None if v is None or v[0] is None else (1.0 if v[2] - v[0] < 10 * EPS else v[2] - v[0]) / scaler.adjust for v in (q.get(i) for i in range(len(matrix.names)))]
    return replace(plain, values=scaler.kept({"center": center, "scale": scale}))


def _vector(values: list[float | None]) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in values], float)


def scale_matrix(matrix: Matrix, scaler: Scaler, fitted: Fitted | None = None) -> Matrix:
    """The scaled matrix; fitted on itself if no fit is given. Infinite values are an error."""
    fitted = fitted or fit_matrix(matrix, scaler)
    if fitted.columns != matrix.names:
        raise ValueError("the fit is of other features")
    shift, scale, add = None, None, None
    if isinstance(scaler, Standard):
        shift, scale = _vector(fitted.values["mean"]) if scaler.with_mean else None, _vector(fitted.values["scale"]) if scaler.with_std else None
    elif isinstance(scaler, Robust):
        shift, scale = _vector(fitted.values["center"]) if scaler.with_centering else None, _vector(fitted.values["scale"]) if scaler.with_scaling else None
    elif isinstance(scaler, MinMax):
        scale, add = _vector(fitted.values["scale"]), _vector(fitted.values["min_adjustment"])
    else:
        scale = _vector(fitted.values["scale"])
    clip = tuple(map(float, scaler.feature_range)) if isinstance(scaler, MinMax) and scaler.clip else None
    shared = matrix.rows.sparkSession.sparkContext.broadcast((shift, scale, add))

    def block(x: np.ndarray) -> np.ndarray:
        shift, scale, add = shared.value
        if np.isinf(x).any():
            raise ValueError("Input contains infinity.")
        if add is not None:
            x = x * scale + add
            return np.clip(x, *clip) if clip else x
        x = x if shift is None else x - shift
        return x if scale is None else x / scale

    return _mapped(matrix, block)


def check_complete_matrix(matrix: Matrix, norm: str) -> int:
    """The number of rows; raises a ValueError that names the features with missing values, before anything is written."""
    seen = MaxAbs().finish(merged(matrix_state(matrix)), matrix.names)
    if short := [c for c, n in zip(matrix.names, seen.counts, strict=True) if n < seen.rows]:
        raise ValueError(MISSING_VALUES.format(norm=norm, columns=short))
    return seen.rows


def normalize_matrix(matrix: Matrix, norm: str) -> Matrix:
    """Rows divided by their norm; rows of zeros stay, a missing value is an error."""
    if norm not in NORMS:
        raise ValueError(f"norm must be one of {NORMS}: {norm!r}")
    names = matrix.names

    def block(x: np.ndarray) -> np.ndarray:
        if np.isnan(x).any():
            raise ValueError(MISSING_VALUES.format(norm=norm, columns=[names[i] for i in np.flatnonzero(np.isnan(x).any(0))[:20]]))
        if np.isinf(x).any():
            raise ValueError("Input contains infinity.")
        size = np.sqrt((x * x).sum(1)) if norm == "l2" else np.abs(x).sum(1) if norm == "l1" else np.abs(x).max(1, initial=0)
        return x / np.where(size < 10 * EPS, 1.0, size)[:, None]

    return _mapped(matrix, block)


def complete_rows(matrix: Matrix) -> Matrix:
    """Rows with a value for every feature and in every other column."""
    full = F.forall(VALUES, lambda v: v.isNotNull() & ~F.isnan(v))
    return replace(matrix, rows=matrix.rows.na.drop("any").where(full))


def chosen_features(matrix: Matrix, features: Iterable[str]) -> Matrix:
    """The features asked for, each once, in the order they were asked for."""
    wanted, places = list(dict.fromkeys(features)), {n: i for i, n in enumerate(matrix.names)}
    if absent := [f for f in wanted if f not in places]:
        raise ValueError(NOT_FOUND.format(names=", ".join(absent)))
    at = [places[f] for f in wanted]
    return _mapped(matrix, lambda x: x[:, at], wanted)


def _numbers(cells: list[str], names: list[str]) -> list[float]:
    try:
        return list(map(float, cells))
    except ValueError:
        out = []
        for cell, name in zip(cells, names, strict=True):
            try:
                out.append(float("nan") if cell in _MISSING else float(cell))
            except ValueError:
                raise ValueError(f"feature {name!r} is not numeric: {cell!r}") from None
        return out


def read_matrix(spark: SparkSession, path: str, keys: Iterable[str] | None = None) -> Matrix:
    """CSV or TSV as a matrix: ``keys`` are its text columns, all others features of numbers.

    Without ``keys`` all columns that are not numbers are, found by one scan for
    types. Else the header alone is read here. Rows are split and converted in
    Arrow batches, by every task a part of the file; no column but the keys is
    ever one of Spark's. The header is one line.
    """
    separator, names = separator_of(path), wide_header(spark, path)
    if keys is None:
        keys = [n for n, kind in infer_wide(spark, path, names).items() if not isinstance(kind, T.NumericType)]
    wanted = list(keys)
    if absent := [k for k in wanted if k not in names]:
        raise ValueError(NOT_FOUND.format(names=", ".join(absent)))
    beside, inside = [names.index(k) for k in wanted], [i for i, n in enumerate(names) if n not in set(wanted)]
    features, width = [names[i] for i in inside], len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, width):
            rows = [cells_of(value, separator, width) for value in batch.column(0).to_pylist()]
            x = np.array([_numbers([r[i] for i in inside], features) for r in rows], float).reshape(len(rows), len(features))
            yield pa.record_batch([*[pa.array([None if r[i] in _MISSING else r[i] for r in rows], pa.string()) for i in beside], _listed(x)], names=[f"c{i}" for i in range(len(beside) + 1)])

    schema = ", ".join([f"c{i} string" for i in range(len(beside))] + [f"c{len(beside)} array<double>"])
    return Matrix(records(spark, path, separator).select("value").mapInArrow(run, schema).toDF(*wanted, VALUES), features)


def write_matrix(matrix: Matrix, path: str) -> str:
    """One CSV or TSV file, other columns first; written by all tasks and joined by the file system."""
    separator = separator_of(path)
    others = [f for f in matrix.rows.schema if f.name != VALUES]
    cells = F.array_join(F.transform(VALUES, lambda v: F.coalesce(v.cast("string"), F.lit(""))), separator)
    options = {"sep": separator, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    beside = [F.to_csv(F.struct(*[_shown(f).alias(f"c{i}") for i, f in enumerate(others)]), options)] if others else []
    matrix.rows.select(F.concat_ws(separator, *beside, cells).alias("value")).write.mode("overwrite").text(f"{path}.parts")
    quoted = lambda n: '"' + n.replace('"', '""') + '"' if any(x in n for x in (separator, '"', "\n", "\r")) or not n else n
    join_parts(matrix.rows.sparkSession, f"{path}.parts", path, (separator.join(map(quoted, [*matrix.others, *matrix.names])) + "\n").encode())
    return path
