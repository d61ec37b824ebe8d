"""One way in for every format: the extension names the reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .delimited import extension_of, read_delimited


def read_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """Parquet for ``.parquet``, else delimited text."""
    return spark.read.parquet(path) if extension_of(path) == ".parquet" else read_delimited(spark, path, **options)
