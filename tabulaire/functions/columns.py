"""Choosing, checking and preparing the columns of a sample-by-feature table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Settings that the results rely on; ANSI mode stays on, every division is guarded.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.caseSensitive": "true", "spark.sql.adaptive.enabled": "true"}


#: What errors say of the columns asked for.
NO_NUMBERS = "Dataset contains no numeric columns."
ABSENT = "Columns not found in dataset: {names}"
TEXTUAL = "Columns are not numeric: {names}"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def named(column: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """The columns to work on: those asked for, checked, or else every number column in table order.

    Booleans count as numbers when asked for by name but are never chosen on
    their own; an empty list asks for nothing and means the same as None.
    """
    wanted = list(columns or ())
    kinds = {f.name: f.dataType for f in df.schema}
    if not wanted:
        wanted = [name for name, kind in kinds.items() if isinstance(kind, T.NumericType)]
        if not wanted:
            raise ValueError(NO_NUMBERS)
        return wanted
    if absent := [name for name in wanted if name not in kinds]:
        raise ValueError(ABSENT.format(names=absent))
    if textual := [name for name in wanted if not isinstance(kinds[name], (T.NumericType, T.BooleanType))]:
        raise ValueError(TEXTUAL.format(names=textual))
    return list(dict.fromkeys(wanted))


def value_of(column: str) -> Column:
    """The column as a double, NaN as null: aggregates then skip it and results keep it missing."""
    return F.nanvl(named(column).cast("double"), F.lit(None).cast("double"))


def is_infinite(value: Column) -> Column:
    return F.abs(value) == F.lit(float("inf"))


def finite(column: str) -> Column:
    """``value_of`` that fails on an infinite value, when such a row is reached."""
    value = value_of(column)
    said = F.raise_error(F.lit(f"Input contains infinity in column {column!r}.")).cast("double")
    return F.when(is_infinite(value), said).otherwise(value)


def replaced(df: DataFrame, new: dict[str, Column], columns: Iterable[str] | None = None) -> DataFrame:
    """``df`` (or ``columns`` of it) with some columns computed anew in one projection; order and other columns stay."""
    return df.select(*[new[c].alias(c) if c in new else named(c) for c in (df.columns if columns is None else columns)])
