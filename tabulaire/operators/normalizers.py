"""Row norms: each row divided by its L1, L2 or largest absolute value over the chosen columns.

Nothing is aggregated or shuffled. A row of zeros stays as it is; a missing
value among the chosen columns is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tabulaire.functions.columns import finite, numeric_columns, replaced, value_of
from tabulaire.operators.scalers import EPS
from tabulaire.plans.stats import WIDE, column_stats

NORMS = ("l1", "l2", "max")


def row_norm(values: list[Column], norm: str, wide: int = WIDE) -> Column:
    """The norm of a row; over many columns a fold over an array, so that the plan stays flat."""
    zero = F.lit(0.0)
    part = (lambda x: x * x) if norm == "l2" else F.abs
    join = F.greatest if norm == "max" else (lambda a, b: a + b)
    total = reduce(join, [part(v) for v in values]) if len(values) <= wide else F.aggregate(F.array(*values), zero, lambda a, x: join(a, part(x)))
    return F.sqrt(total) if norm == "l2" else total


#: Fixed value: what the error says of columns with missing values.
MISSING_VALUES = "{norm} normalization cannot process missing values. Columns containing NaN: {columns}. Apply missing-value preprocessing first."


def check_complete(df: DataFrame, columns: list[str], norm: str, wide: int = WIDE) -> int:
    """The number of rows; raises a ValueError that names the columns with missing values, before anything is written."""
    stats = column_stats(df, columns, {}, wide)
    if short := [c for c in columns if stats[c]["n"] < stats[""]["rows"]]:
        raise ValueError(MISSING_VALUES.format(norm=norm, columns=short))
    return stats[""]["rows"]


def normalize(df: DataFrame, norm: str, columns: list[str] | None = None, *, check: bool = False, wide: int = WIDE) -> DataFrame:
    """``df`` with the chosen columns divided by their row's norm, as doubles.

    A missing value fails the job when its row is reached; ``check`` scans for
    missing values first and raises before any row is returned.
    """
    if norm not in NORMS:
        raise ValueError(f"norm must be one of {NORMS}: {norm!r}")
    chosen = numeric_columns(df, columns)
    if check:
        check_complete(df, chosen, norm, wide)
    size = row_norm([finite(c) for c in chosen], norm, wide)
    missing = reduce(lambda a, b: a | b, [value_of(c).isNull() for c in chosen]) if len(chosen) <= wide else F.exists(F.array(*[value_of(c) for c in chosen]), F.isnull)
    said = F.raise_error(F.lit(f"{norm} normalization cannot process missing values in columns {chosen[:20]}")).cast("double")
    size = F.when(missing, said).otherwise(F.when(size < 10 * EPS, 1.0).otherwise(size))
    # the norm is computed once a row, under a name that no column has
    name = "norm"
    while name in df.columns:
        name += "_"
    sized = df.select("*", size.alias(name))
    return replaced(sized, {c: value_of(c) / F.col(name) for c in chosen}).drop(name)
