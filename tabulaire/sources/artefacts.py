"""Fitted scalers as a typed table: a row a column, readable by any engine, and refused where it does not fit.

Nothing is pickled, so nothing is run when a fit is loaded. Each row names the
format, the method, its flags and a hash of all that says what the numbers
mean; a table that was cut, mixed with another or changed is refused.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulaire.functions.columns import numeric_columns
from tabulaire.operators.scalers import METHODS, Fitted, Scaler

FORMAT = 1  #: raised when columns of the table change their meaning
SCHEMA = "format int, method string, flags string, fingerprint string, rows long, position int, column_name string, n long, learned map<string,double>"


def fingerprint(method: str, flags: str, rows: int, columns: list[str], learned: list[dict]) -> str:
    """A hash of everything that the table says."""
    said = json.dumps([FORMAT, method, flags, rows, [[c, {k: None if v is None else float(v).hex() for k, v in sorted(m.items())}] for c, m in zip(columns, learned, strict=True)]])
    return hashlib.sha256(said.encode()).hexdigest()


def save_fit(spark: SparkSession, scaler: Scaler, fitted: Fitted, path: str) -> str:
    """Writes a fit as a Parquet table of one file."""
    (method,) = [m for m, kind in METHODS.items() if type(scaler) is kind]
    flags = json.dumps(scaler.flags, sort_keys=True)
    learned = [{k: None if v[i] is None else float(v[i]) for k, v in fitted.values.items() if v} for i in range(len(fitted.columns))]
    mark = fingerprint(method, flags, fitted.rows, fitted.columns, learned)
    rows = [(FORMAT, method, flags, mark, fitted.rows, i, c, fitted.counts[i], learned[i]) for i, c in enumerate(fitted.columns)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_fit(spark: SparkSession, path: str, df: DataFrame | None = None) -> tuple[Scaler, Fitted]:
    """The scaler and the fit of ``save_fit``; ValueError if the table is of another format, incomplete or changed, or does not fit ``df``."""
    rows = sorted(spark.read.schema(SCHEMA).parquet(path).collect(), key=lambda r: (r.position is None, r.position))
    if not rows:
        raise ValueError(f"no fit at {path}")
    first = rows[0]
    if first.format != FORMAT:
        raise ValueError(f"a fit of format {first.format}, not {FORMAT}")
    columns, learned = [r.column_name for r in rows], [r.learned for r in rows]
    if first.method not in METHODS or [r.position for r in rows] != list(range(len(rows))) or {r.fingerprint for r in rows} != {fingerprint(first.method, first.flags, first.rows, columns, learned)}:
        raise ValueError(f"the fit at {path} is incomplete or was changed")
    flags = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(first.flags).items()}
    scaler = METHODS[first.method](columns, **flags)
    names = scaler.learned_from(lambda name: F.lit(None).cast("double"))
    fitted = Fitted(columns, first.rows, [r.n for r in rows], scaler.kept({k: [m.get(k) for m in learned] for k in names}))
    if df is not None:
        numeric_columns(df, columns)
    return scaler, fitted
