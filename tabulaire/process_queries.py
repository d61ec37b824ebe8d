"""Queries that go through files, stored artefacts, requests and reports, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulaire.operators import MinMax, Robust, Standard, missing_by_column, sample_counts, standardize
from tabulaire.operators.matrix import Matrix, normalize_matrix, read_matrix, scale_matrix, write_matrix
from tabulaire.operators.scalers import Scaler
from tabulaire.pipeline import handle
from tabulaire.plans.state import partial_state, resume, save_part
from tabulaire.plans.stats import quantiles
from tabulaire.report import Report
from tabulaire.requests import ENVELOPES
from tabulaire.sources import read_header, read_table, write_delimited
from tabulaire.sources.files import at, copy_objects, read_stream, size_of
from tabulaire.sources.storage import create_container, in_background, load_model, save_model
from tabulaire.streaming import fit_stream


@dataclass(frozen=True)
class Made:
    """A query that is more than a plan over one table."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or a local one where a session on one machine has none.

    What is read from it later is there as long as the session; then the folder goes.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = f"{(root or 'file://' + tempfile.mkdtemp(prefix='tabulaire-')).rstrip('/')}/tabulaire/{uuid.uuid4().hex}"
    create_container(spark, folder)
    fs, path = at(spark, folder)
    fs.deleteOnExit(path)
    return folder


def forget(spark: SparkSession, folder: str) -> None:
    """Deletes a scratch folder that nothing reads any more."""
    fs, path = at(spark, folder)
    fs.delete(path, True)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, a fifth of their sizes missing."""
    return _table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("p_size"))


def _through(table: str, file: str, single: bool) -> Callable[[SparkSession, str], DataFrame]:
    """A table written as delimited text and read back, types inferred."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch(spark)}/{file}"
        write_delimited(_table(spark, sf_dir, table), path, single=single)
        return read_table(spark, path)

    return run


def _header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/part.tsv"
    write_delimited(_table(spark, sf_dir, "part").limit(0), path)
    return spark.createDataFrame(list(enumerate(read_header(spark, path))), "position int, feature string")


def _blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as one object that many tasks wrote, copied without waiting, its bytes counted by ranges, and read back."""
    root = scratch(spark)
    write_delimited(_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").repartition(4), f"{root}/customers.csv")
    copies = in_background(copy_objects, spark, [(f"{root}/customers.csv", f"{root}/copy-{i}.csv") for i in range(3)])
    sizes = copies.result()
    ranged = sum(map(len, read_stream(spark, f"{root}/copy-1.csv", 1 << 16)))
    if {*sizes, ranged} != {size_of(spark, f"{root}/customers.csv")}:
        raise OSError("a copy differs from its source")
    return read_table(spark, f"{root}/copy-2.csv")


def _quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, line breaks and all, as one CSV file that is read by all tasks."""
    path = f"{scratch(spark)}/documents.csv"
    write_delimited(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return read_table(spark, path)


def _numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written by many tasks to one file, and read with the numbers of their rows."""
    path = f"{scratch(spark)}/orders.tsv"
    write_delimited(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), path)
    return read_table(spark, path, preserve_order=True).withColumnRenamed("_row", "position")


def _in_parts(scaler: Scaler, table: str, key: str) -> Callable[[SparkSession, str], DataFrame]:
    """A fit on three parts of a table, one of them run twice, stored and resumed; then applied to all of it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df, folder = _table(spark, sf_dir, table).select(key, *scaler.columns), scratch(spark)
        for part in (0, 1, 2, 1):
            save_part(partial_state(df.where(F.col(key) % 3 == part), scaler.columns), folder, f"{part}")
        fitted = scaler.finish(resume(spark, folder))
        forget(spark, folder)
        return scaler.transform(df, fitted).withColumns({c: F.round(c, 6) + 0.0 for c in scaler.columns})

    return run


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fit on a stream of events, batch by batch, applied to the table."""
    folder, df = scratch(spark), _table(spark, sf_dir, "events").select("event_id", "value")
    # streams read folders: a table that is one file is found in the one above it
    fs, path = at(spark, f"{sf_dir}/events.parquet")
    where, which = (f"{sf_dir}/events.parquet", "*.parquet") if fs.getFileStatus(path).isDirectory() else (sf_dir, "events.parquet")
    source = spark.readStream.schema(_table(spark, sf_dir, "events").schema).option("pathGlobFilter", which).parquet(where)
    fit_stream(source, f"{folder}/state", ["value"]).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    scaler = Standard(["value"])
    return scaler.transform(df, scaler.finish(resume(spark, f"{folder}/state"))).withColumn("value", F.round("value", 6) + 0.0)


def _sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles by the three scans that large tables take, a row a column."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    one = quantiles(_table(spark, sf_dir, "lineitem"), columns, [0.1, 0.5, 0.9], small=False)
    rows = one.select(F.explode(F.arrays_zip(F.array(*map(F.lit, columns)).alias("column_name"), "found")).alias("z")).select("z.column_name", "z.found.q")
    return rows.select("column_name", *[(F.round(F.col("q")[i], 6) + 0.0).alias(f"q{p}") for i, p in enumerate((10, 50, 90))])


_FEATURES = [f"e{i}" for i in range(64)]


def _embeddings(spark: SparkSession, sf_dir: str) -> Matrix:
    return Matrix(_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("values")), _FEATURES)


def _matrix(work: Callable[[Matrix], Matrix]) -> Callable[[SparkSession, str], DataFrame]:
    """Embeddings as a matrix of 64 features, put to work; a row a vector and feature."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = work(_embeddings(spark, sf_dir)).rows
        return rows.select("vec_id", F.posexplode("values").alias("feature", "value")).withColumn("value", F.round("value", 6) + 0.0)

    return run


def _matrix_file(matrix: Matrix) -> Matrix:
    """Through a file of as many columns, ids as text."""
    path = f"{scratch(matrix.rows.sparkSession)}/embeddings.csv"
    write_matrix(matrix, path)
    back = read_matrix(matrix.rows.sparkSession, path, ["vec_id"])
    return Matrix(back.rows.withColumn("vec_id", F.col("vec_id").cast("long")), back.names)


def _features_sql(expression: str, source: str = "v") -> str:
    """``expression`` of x over (vec_id, feature, x)."""
    return f"WITH v AS (SELECT vec_id, CAST(i - 1 AS INT) AS feature, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, range(1, 65) AS t(i)) SELECT vec_id, feature, round({expression}, 6) + 0.0 AS value FROM {source}"


def _stored_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted scaler, saved and loaded, then applied."""
    df = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    scaler = Standard(["s_acctbal"])
    stored, fitted = load_model(spark, save_model(spark, scratch(spark), "q", (scaler, scaler.fit(df)), "scaler", "standard-scaler"))
    return stored.transform(df, fitted).withColumn("s_acctbal", F.round("s_acctbal", 6) + 0.0)


#: Columns with missing values, put in where a key is a multiple of a number.
Gaps = dict[str, tuple[str, int]]


def _asked(spark: SparkSession, sf_dir: str, process: str, table: str, parameters: dict, gaps: Gaps | None = None) -> Report:
    """The report of a process, asked for in JSON, on a table or on a copy of it with ``gaps``."""
    types, folder = ENVELOPES[process], scratch(spark)
    words = types.asked.split("_")
    request = {"datasetId": table, words[0] + "".join(w.title() for w in words[1:]): parameters, "inputBlob": {"root": sf_dir, "fileName": f"{table}.parquet"}}
    if gaps:
        df = _table(spark, sf_dir, table)
        df.withColumns({c: F.when(F.col(k) % m != 0, F.col(c)) for c, (k, m) in gaps.items()}).write.parquet(f"{folder}/{table}.parquet")
        request["inputBlob"]["root"] = folder
    if process != "feature_extraction":
        request["outputBlob"] = {"root": folder, "fileName": "out", "extension": "parquet"}
    response = handle(spark, process, request)
    forget(spark, folder)
    if response.error:
        raise RuntimeError(response.error.message)
    return getattr(response, types.answered)


def _by_column(process: str, table: str, parameters: dict, fields: list[str], also: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    """A report's lists as rows, one a column, with ``also`` the numbers that hold for all."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _asked(spark, sf_dir, process, table, parameters).to_dataframe(spark).select("info.*")
        rows = rows.select(F.explode(F.arrays_zip(F.col("numeric_columns").alias("column_name"), *fields)).alias("z"), *[F.col(a) for a in also])
        return rows.select("z.column_name", *[(F.round(f"z.{f}", 6) + 0.0).alias(f) for f in fields], *also)

    return run


def _info(process: str, table: str, parameters: dict, fields: list[str], gaps: Gaps | None = None) -> Callable[[SparkSession, str], DataFrame]:
    """One row: fields of a report, lists joined by commas."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _asked(spark, sf_dir, process, table, parameters, gaps).to_dataframe(spark).select("info.*")
        kinds = dict(rows.dtypes)
        return rows.select(*[(F.array_join(f, ",") if kinds[f].startswith("array") else F.col(f)).alias(f) for f in fields])

    return run


def _columns_sql(table: str, columns: list[str], fields: dict[str, str], also: dict[str, str]) -> str:
    one = lambda c: f"SELECT '{c}' AS column_name, {', '.join(f'round({e.format(x=c)}, 6) + 0.0 AS {f}' for f, e in fields.items())}, {', '.join(f'{e.format(x=c)} AS {f}' for f, e in also.items())} FROM {table}"
    return " UNION ALL ".join(map(one, columns))


_SUPPLIER = ["s_suppkey", "s_nationkey", "s_acctbal"]
_GAP = "CASE WHEN p_partkey % 5 <> 0 THEN p_size END"
_COUNTS = ["rows_processed", "rows_retained", "rows_removed"]


def _kept_sql(table: str, gaps: Gaps) -> str:
    full = " AND ".join(f"{k} % {m} <> 0" for k, m in gaps.values())
    return f"SELECT count(*) AS rows_processed, count(*) FILTER ({full}) AS rows_retained, count(*) - count(*) FILTER ({full}) AS rows_removed FROM {table}"


def _filtered(process: str, table: str, gaps: Gaps) -> Made:
    return Made(_info(process, table, {}, _COUNTS, gaps), _kept_sql(table, gaps))



QUERIES: dict[str, Made] = {
    "delimited_parts": Made(_through("customer", "customer.csv", False), "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"),
    "delimited_whole": Made(_through("supplier", "supplier.tsv", True), "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier"),
    "delimited_header": Made(_header, "SELECT CAST(row_number() OVER () - 1 AS INT) AS position, column_name AS feature FROM (DESCRIBE part)"),
    "delimited_quoted": Made(_quoted, "SELECT doc_id, text, lang FROM documents"),
    "delimited_row_numbers": Made(_numbered_rows, "SELECT o_orderkey, o_totalprice, row_number() OVER () - 1 AS position FROM orders"),
    "stored_blob": Made(_blob, "SELECT c_custkey, c_name, c_acctbal FROM customer"),
    "incremental_standard": Made(
        _in_parts(Standard(["o_totalprice"]), "orders", "o_orderkey"),
        "SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) + 0.0 AS o_totalprice FROM orders",
    ),
    "incremental_min_max": Made(
        _in_parts(MinMax(["p_size", "p_retailprice"]), "part", "p_partkey"),
        "SELECT p_partkey, " + ", ".join(f"round(({c} - min({c}) OVER ()) * 1.0 / (max({c}) OVER () - min({c}) OVER ()), 6) + 0.0 AS {c}" for c in ("p_size", "p_retailprice")) + " FROM part",
    ),
    "incremental_stream": Made(_streamed, "SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) + 0.0 AS value FROM events"),
    "sketched_quantiles": Made(
        _sketched,
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, " + ", ".join(f"round(quantile_cont({c}, {p / 100}), 6) + 0.0 AS q{p}" for p in (10, 50, 90)) + " FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    ),
    "matrix_standard": Made(_matrix(lambda m: scale_matrix(m, Standard())), _features_sql("(x - avg(x) OVER (PARTITION BY feature)) / stddev_pop(x) OVER (PARTITION BY feature)")),
    "matrix_robust": Made(
        _matrix(lambda m: scale_matrix(m, Robust())),
        _features_sql("(x - q50) / (q75 - q25)", "(SELECT *, quantile_cont(x, 0.25) OVER w AS q25, quantile_cont(x, 0.5) OVER w AS q50, quantile_cont(x, 0.75) OVER w AS q75 FROM v WINDOW w AS (PARTITION BY feature))"),
    ),
    "matrix_l2": Made(_matrix(lambda m: normalize_matrix(m, "l2")), _features_sql("x / sqrt(sum(x * x) OVER (PARTITION BY vec_id))")),
    "matrix_file": Made(_matrix(lambda m: scale_matrix(_matrix_file(m), MinMax())), _features_sql("(x - min(x) OVER (PARTITION BY feature)) / (max(x) OVER (PARTITION BY feature) - min(x) OVER (PARTITION BY feature))")),
    "stored_scaler": Made(_stored_scaler, "SELECT s_suppkey, round((s_acctbal - avg(s_acctbal) OVER ()) / stddev_pop(s_acctbal) OVER (), 6) + 0.0 AS s_acctbal FROM supplier"),
    "chosen_number_columns": Made(
        lambda spark, sf_dir: standardize(_table(spark, sf_dir, "supplier"), "min_max").withColumns({c: F.round(c, 6) + 0.0 for c in _SUPPLIER}),
        "SELECT s_name, " + ", ".join(f"round(({c} - min({c}) OVER ()) * 1.0 / (max({c}) OVER () - min({c}) OVER ()), 6) + 0.0 AS {c}" for c in _SUPPLIER) + " FROM supplier",
    ),
    "boolean_by_name": Made(
        lambda spark, sf_dir: standardize(_table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") > 25).alias("large")), "max_abs", ["large"]),
        "SELECT p_partkey, CASE WHEN p_size > 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS large FROM part",
    ),
    "missing_by_column": Made(
        lambda spark, sf_dir: missing_by_column(_with_gaps(spark, sf_dir)),
        f"SELECT 'p_partkey' AS column_name, count(*) AS samples, CAST(0 AS BIGINT) AS missing, false AS any_missing FROM part UNION ALL SELECT 'p_name', count(*), 0, false FROM part UNION ALL SELECT 'p_size', count(*), count(*) - count({_GAP}), count(*) > count({_GAP}) FROM part",
    ),
    "sample_counts": Made(
        lambda spark, sf_dir: sample_counts(_with_gaps(spark, sf_dir)),
        f"SELECT count(*) AS rows_processed, count({_GAP}) AS rows_retained, count(*) - count({_GAP}) AS rows_removed FROM part",
    ),
    "report_standard": Made(
        _by_column("standard_standardization", "supplier", {"numericColumns": ["s_acctbal", "s_nationkey"]}, ["mean", "variance", "scale"], ["rows_processed"]),
        _columns_sql("supplier", ["s_acctbal", "s_nationkey"], {"mean": "avg({x})", "variance": "var_pop({x})", "scale": "stddev_pop({x})"}, {"rows_processed": "count(*)"}),
    ),
    "report_min_max": Made(
        _by_column("min_max_standardization", "part", {"numericColumns": ["p_size", "p_retailprice"], "featureRange": [0, 2]}, ["min_adjustment", "scale", "data_min", "data_max", "data_range"], ["samples_seen"]),
        _columns_sql("part", ["p_size", "p_retailprice"], {"min_adjustment": "-min({x}) * 2.0 / (max({x}) - min({x}))", "scale": "2.0 / (max({x}) - min({x}))", "data_min": "min({x})", "data_max": "max({x})", "data_range": "max({x}) - min({x})"}, {"samples_seen": "count(*)"}),
    ),
    "report_max_abs": Made(
        _by_column("max_abs_standardization", "customer", {"numericColumns": ["c_acctbal"]}, ["max_abs", "scale"], ["samples_seen"]),
        _columns_sql("customer", ["c_acctbal"], {"max_abs": "max(abs({x}))", "scale": "max(abs({x}))"}, {"samples_seen": "count(*)"}),
    ),
    "report_robust": Made(
        _by_column("robust_standardization", "orders", {"numericColumns": ["o_totalprice"]}, ["center", "scale"], ["n_features_in", "rows_processed"]),
        _columns_sql("orders", ["o_totalprice"], {"center": "quantile_cont({x}, 0.5)", "scale": "quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)"}, {"n_features_in": "CAST(1 AS BIGINT)", "rows_processed": "count(*)"}),
    ),
    "report_norm": Made(
        _info("l2_normalization", "supplier", {"numericColumns": ["s_acctbal", "s_nationkey"], "chunkSize": 7}, ["norm", "numeric_columns", "numeric_column_count", "rows_processed", "transform_chunks_processed", "chunk_size"]),
        "SELECT 'l2' AS norm, 's_acctbal,s_nationkey' AS numeric_columns, CAST(2 AS BIGINT) AS numeric_column_count, count(*) AS rows_processed, (count(*) + 6) // 7 AS transform_chunks_processed, CAST(7 AS BIGINT) AS chunk_size FROM supplier",
    ),
    "report_sample_selection": _filtered("retain_complete_samples", "nation", {"n_name": ("n_nationkey", 4)}),
    "report_class_labels": _filtered("assign_class_labels", "labels", {"quality": ("doc_id", 5), "toxic": ("doc_id", 3)}),
    "report_feature_selection": _filtered("remove_no_signal", "customer", {"c_mktsegment": ("c_custkey", 6), "c_acctbal": ("c_custkey", 7)}),
    "report_matrix_extraction": _filtered("data_extraction", "pages", {"url": ("page_id", 3)}),
    "report_feature_matrix": Made(
        _info("create_defined_feature_matrix", "part", {"definedFeatures": ["p_size", "p_partkey", "p_size"]}, ["requested_features", "selected_features", "missing_features", "selected_feature_count", "samples_processed"]),
        "SELECT 'p_size,p_partkey' AS requested_features, 'p_size,p_partkey' AS selected_features, '' AS missing_features, CAST(2 AS BIGINT) AS selected_feature_count, count(*) AS samples_processed FROM part",
    ),
    "report_feature_extraction": Made(
        _info("feature_extraction", "part", {"excludedColumns": ["p_name", "zz", "aa"]}, ["feature_names", "feature_count", "total_column_count", "excluded_columns", "missing_excluded_columns"]),
        "SELECT string_agg(column_name, ',' ORDER BY i) FILTER (column_name <> 'p_name') AS feature_names, count(*) - 1 AS feature_count, count(*) AS total_column_count, 'p_name' AS excluded_columns, 'aa,zz' AS missing_excluded_columns FROM (SELECT column_name, row_number() OVER () AS i FROM (DESCRIBE part))",
    ),
}
