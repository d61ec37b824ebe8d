"""Complete-case filtering, and the eleven operator names under which it is offered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabulaire.functions.columns import named

#: The operators that are this filter.
FILTERS = (
    "retain_complete_samples",
    "retain_common_samples_across_layers",
    "assign_class_labels",
    "detect_classification_type",
    "extract_subtype_labels",
    "annotate",
    "remove_low_variance",
    "remove_no_signal",
    "select_correlation",
    "select_top_features",
    "data_extraction",
)


def has_value(df: DataFrame) -> list[Column]:
    """Per column whether a row has a value there; NaN is none."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return [named(c).isNotNull() & ~F.isnan(named(c)) if c in floats else named(c).isNotNull() for c in df.columns]


def complete_cases(df: DataFrame) -> DataFrame:
    """Rows with a value in every column, text included; NaN is no value. Null tests reach the scan."""
    return df.where(reduce(lambda a, b: a & b, has_value(df))) if df.columns else df


def sample_counts(df: DataFrame) -> DataFrame:
    """One row: rows_processed, rows_retained and rows_removed of the complete-case filter, in one aggregate."""
    kept = reduce(lambda a, b: a & b, has_value(df), F.lit(True))
    counts = df.agg(F.count(F.lit(1)).alias("rows_processed"), F.count_if(kept).alias("rows_retained"))
    return counts.withColumn("rows_removed", F.col("rows_processed") - F.col("rows_retained"))


def missing_by_column(df: DataFrame) -> DataFrame:
    """A row a column: column_name, samples, missing and any_missing, from one aggregate."""
    tests = has_value(df)
    counts = df.agg(F.count(F.lit(1)).alias("samples"), F.array(*[F.count_if(~t) for t in tests]).alias("missing"))
    rows = counts.select("samples", F.posexplode("missing").alias("at", "missing"))
    name = F.element_at(F.array(*map(F.lit, df.columns)), F.col("at") + 1)
    return rows.select(name.alias("column_name"), "samples", "missing", (F.col("missing") > 0).alias("any_missing"))
