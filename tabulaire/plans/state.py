"""Fits in parts: what is known of columns so far, as a small table that can be stored, merged and gone on with.

A state has a row a column: rows, n, mean, m2 (squared deviations from the
mean), low, high, top (largest absolute value), infinite, and a quantile
sketch if asked for. States of parts merge by one grouping with partial
aggregation, in any order and number, so files, days or micro-batches may be
fitted apart. A folder of states has a subfolder a part; a part that is written
again replaces itself, so a batch that is run twice counts once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabulaire.functions.columns import numeric_columns
from tabulaire.plans.stats import WIDE, summary

SKETCH = 1024  #: the accuracy of a state's sketch: ranks within 0.3 % of the values in 99 of 100 columns
FORMAT = 1  #: raised when a state's columns change their meaning

SCHEMA = "column_name string, rows long, n long, mean double, m2 double, low double, high double, top double, infinite boolean, sketch binary"


def partial_state(df: DataFrame, columns: Iterable[str] | None = None, *, sketch: int | None = None, wide: int = WIDE) -> DataFrame:
    """The state of the number columns of ``df``, or those that are named; a lazy plan with one aggregate.

    Missing values are skipped, infinite ones noted. ``sketch`` is the accuracy
    of a quantile sketch (None: none).
    """
    names = numeric_columns(df, columns)
    wanted = {"mean": F.avg, "variance": F.var_pop, "low": F.min, "high": F.max, "top": lambda x: F.max(F.abs(x))}
    if sketch:
        wanted["sketch"] = lambda x: F.kll_sketch_agg_double(x, F.lit(sketch))
    one = summary(df, names, wanted, wide)
    name = F.element_at(F.array(*map(F.lit, names)), F.col("at") + 1)
    # a stacked table without rows has an empty list: its columns are still named
    found = F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.struct(i.alias("at"), F.get("found", i).alias("f")))
    rows = one.select("rows", F.inline(found))
    n = F.coalesce(F.col("f.n"), F.lit(0)).cast("long")
    return rows.select(
        name.alias("column_name"), "rows", n.alias("n"), F.col("f.mean").alias("mean"), (F.col("f.variance") * F.col("f.n")).alias("m2"), F.col("f.low").alias("low"), F.col("f.high").alias("high"), F.col("f.top").alias("top"),
        F.coalesce(F.col("f.bad"), F.lit(False)).alias("infinite"), (F.when(n > 0, F.col("f.sketch")) if sketch else F.lit(None).cast("binary")).alias("sketch"),
    )


def merged(states: DataFrame) -> DataFrame:
    """States of any number of parts as one, a row a column.

    Deviations are moved to the common mean by what each part's own mean differs from it, so nothing cancels.
    """
    means = states.groupBy("column_name").agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("whole"))
    # a row a column, small beside the states: Spark broadcasts it if it is below its own bound
    moved = states.join(means, "column_name").withColumn("m2", F.col("m2") + F.col("n") * (F.col("mean") - F.col("whole")) * (F.col("mean") - F.col("whole")))
    return moved.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max("whole").alias("mean"), F.sum("m2").alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("top").alias("top"),
        F.bool_or("infinite").alias("infinite"), F.when(F.count("sketch") > 0, F.kll_merge_agg_double("sketch")).alias("sketch"),
    )


def statistics(state: DataFrame) -> DataFrame:
    """A merged state with what scalers learn from: variance and, from a sketch, ``q(odds)`` by ``sketched_quantiles``."""
    return state.withColumn("variance", F.when(F.col("n") > 0, F.col("m2") / F.nullif("n", F.lit(0))))


def sketched_quantiles(state: DataFrame, odds: Iterable[float]) -> DataFrame:
    """A merged state with ``q``: quantiles to the accuracy of its sketch (exact where a column has fewer values than that)."""
    points = F.array(*[F.lit(float(p)) for p in odds])
    q: Column = F.when((F.col("n") > 0) & F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", points))
    return statistics(state).withColumn("q", q)


def save_part(state: DataFrame, folder: str, part: str) -> str:
    """Writes a part's state to its own subfolder, replacing what an earlier run of the same part left."""
    path = f"{folder.rstrip('/')}/part={part}"
    state.select(F.lit(FORMAT).alias("format"), "*").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_parts(spark: SparkSession, folder: str) -> DataFrame:
    """All parts' states; refused if one was written in another format."""
    schema = f"format int, {SCHEMA}, part string"
    states = spark.read.schema(schema).parquet(folder)
    said = F.raise_error(F.concat(F.lit("a state of another format: "), F.col("format").cast("string")))
    return states.where(F.when(F.col("format") == FORMAT, F.lit(True)).otherwise(said.cast("boolean"))).select(*[c.split()[0] for c in SCHEMA.split(", ")])


def resume(spark: SparkSession, folder: str) -> DataFrame:
    """What all parts of a folder add up to."""
    return merged(load_parts(spark, folder))
