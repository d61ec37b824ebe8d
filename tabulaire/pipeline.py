"""Processes by name: read a table, run one operator, write the result, report what was done.

A table is read once for its types (delimited text only), once for what has to
be known of all rows (fits and checks for missing values), and once to be
transformed and written; rows are counted while they are written.
"""

from __future__ import annotations

from collections.abc import Mapping
from time import perf_counter
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tabulaire.functions.columns import NO_NUMBERS, configure, numeric_columns
from tabulaire.operators import MaxAbs, MinMax, Robust, Standard, complete_cases, feature_listing, normalize, select_features
from tabulaire.operators.matrix import Matrix, check_complete_matrix, fit_matrix, normalize_matrix, read_matrix, scale_matrix, write_matrix
from tabulaire.operators.normalizers import check_complete
from tabulaire.report import Error, FeatureExtractionInfo, FeatureMatrixInfo, FileInfo, FilterInfo, NormInfo, Report, StorageLocation
from tabulaire.requests import ENVELOPES, PROCESSES, FamilyRequest, FamilyResponse
from tabulaire.sources.delimited import SEPARATORS, extension_of, read_header, wide_header, write_delimited
from tabulaire.sources.tables import read_table
from tabulaire.tools import elapsed_ms, get_trace_id, parse_experiment_id, utc_now

#: Process to its step's name and scaler.
SCALERS = {
    "standard_standardization": ("standard_scaler", Standard),
    "min_max_standardization": ("min_max_scaler", MinMax),
    "max_abs_standardization": ("max_abs_scaler", MaxAbs),
    "robust_standardization": ("robust_scaler", Robust),
}
WIDE_FILE = 1000  #: more columns than this are read as a matrix
NORMALIZERS = {"l1_normalization": "l1", "l2_normalization": "l2", "max_normalization": "max"}


def _file(spark: SparkSession, path: str) -> FileInfo:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return FileInfo(path, path.rpartition("/")[2], extension_of(path), int(size))


def _chunks(rows: int, size: int) -> int:
    return -(-rows // size)


def output_path(process: str, source: str, target: StorageLocation) -> str:
    """Scalers and norms write the format they read; filters and projections convert to the output's own extension."""
    if process in SCALERS or process in NORMALIZERS:
        extension = extension_of(source)
    else:
        extension = "." + (target.extension or extension_of(target.path) or extension_of(source)).lstrip(".").lower()
    if extension not in (*SEPARATORS, ".parquet"):
        raise ValueError(f"Unsupported output extension: {extension}")
    base = target.path[: -len(extension_of(target.path))] if extension_of(target.path) in (*SEPARATORS, ".parquet") else target.path
    return base + extension


def _write(df: DataFrame, path: str, single: bool) -> None:
    if extension_of(path) == ".parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        write_delimited(df, path, single=single)


def _as_matrix(spark: SparkSession, process: str, source: str, out: str, request: Any, single: bool) -> Matrix | None:
    """The table as a matrix, where it is a file of very many columns, texts before numbers, and all numbers are worked on; else None."""
    if process not in SCALERS and process not in NORMALIZERS or extension_of(source) not in SEPARATORS or not single:
        return None
    if len(names := wide_header(spark, source)) <= WIDE_FILE:
        return None
    matrix = read_matrix(spark, source)
    if not matrix.names:
        raise ValueError(NO_NUMBERS)
    whole = [*matrix.others, *matrix.names] == names
    return matrix if whole and (request.numeric_columns or matrix.names) == matrix.names else None


def run(spark: SparkSession, process: str, source: str, target: StorageLocation | None = None, parameters: Mapping[str, Any] | None = None, *, single: bool = True) -> Report:
    """Runs one process on the table at ``source``; raises ValueError before anything is written if the request is wrong.

    ``single`` makes delimited output one file, without it a folder of parts; all
    tasks write in either case.
    """
    if process not in PROCESSES:
        raise ValueError(f"unknown process: {process}")
    configure(spark)
    types = ENVELOPES[process]
    request = types.parameters.of(parameters or {})
    report = types.report(process)
    if process == "feature_extraction":
        with report.step("extract_feature_names"):
            names = spark.read.parquet(source).columns if extension_of(source) == ".parquet" else read_header(spark, source)
            found = feature_listing(names, request.excluded_columns)
        return report.finish(FeatureExtractionInfo(found.feature_names, found.feature_count, found.total_column_count, found.excluded_columns, found.excluded_column_count, found.missing_excluded_columns))
    if target is None:
        raise ValueError("an output location is needed")
    out = output_path(process, source, target)
    matrix = None
    with report.step("download") as said:
        matrix = _as_matrix(spark, process, source, out, request, single)
        df = matrix.rows if matrix else read_table(spark, source)
        report.input_file = _file(spark, source)
        said.append(f"Read {report.input_file.size_bytes} bytes.")
    # counts of the rows that a job reads and writes, taken while it runs
    read, written = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    info = None
    if process in SCALERS:
        step, kind = SCALERS[process]
        flags = {k: v for k, v in vars(request).items() if k not in ("numeric_columns", "chunk_size", "copy")}
        scaler = kind(request.numeric_columns, **flags)
        with report.step(f"{step}_fit") as said:
            fitted = fit_matrix(matrix, scaler) if matrix else scaler.fit(df)
            said.append(f"Fitted on {fitted.rows} rows.")
        with report.step(f"{step}_transform"):
            result = scale_matrix(matrix, scaler, fitted) if matrix else scaler.transform(df, fitted)
        chunks = _chunks(fitted.rows, request.chunk_size)
        info = PROCESSES[process][2](numeric_columns=fitted.columns, numeric_column_count=len(fitted.columns), rows_processed=fitted.rows, transform_chunks_processed=chunks, chunk_size=request.chunk_size, fit_chunks_processed=chunks, **flags, **scaler.learned(fitted))
    elif process in NORMALIZERS:
        norm = NORMALIZERS[process]
        with report.step(process):
            columns = matrix.names if matrix else numeric_columns(df, request.numeric_columns)
            rows = check_complete_matrix(matrix, norm) if matrix else check_complete(df, columns, norm)
            result = normalize_matrix(matrix, norm) if matrix else normalize(df, norm, columns)
        info = NormInfo(columns, len(columns), rows, _chunks(rows, request.chunk_size), request.chunk_size, norm)
    elif process == "create_defined_feature_matrix":
        with report.step("select_defined_features"):
            result = select_features(df, request.defined_features).observe(read, count)
    else:
        with report.step("retain_complete_samples"):
            result = complete_cases(df.observe(read, count)).observe(written, count)
    with report.step("upload") as said:
        write_matrix(result, out) if matrix else _write(result, out, single)
        report.output_file = _file(spark, out)
        said.append(f"Wrote {report.output_file.size_bytes} bytes.")
    if process == "create_defined_feature_matrix":
        wanted = list(dict.fromkeys(request.defined_features))
        info = FeatureMatrixInfo(wanted, result.columns, [], len(wanted), len(result.columns), 0, read.get["rows"])
    elif info is None:
        rows, kept = read.get["rows"], written.get["rows"]
        info = FilterInfo(rows, kept, rows - kept)
        next(s for s in report.steps if s.step == "retain_complete_samples").message = f"Processed {rows} samples, retained {kept}, removed {rows - kept}."
    return report.finish(info)


def handle(spark: SparkSession, process: str, request: FamilyRequest | Mapping[str, Any], headers: Mapping[str, str] | None = None) -> FamilyResponse:
    """Runs a process as its request (a record, or the JSON object of one) says.

    The response is of the process's own type in any case; what is wrong with
    the request is an ``Error`` with status 400, whatever else goes wrong one
    with 500, and either has no process request and response.
    """
    started, asked_at = perf_counter(), utc_now()
    if process not in PROCESSES:
        raise ValueError(f"unknown process: {process}")
    types = ENVELOPES[process]
    body = request if isinstance(request, Mapping) else {}
    ids = {"experiment_id": parse_experiment_id(body), "trace_id": get_trace_id(headers or {})}
    given = None
    try:
        given = types.request.of({k: v for k, v in body.items() if k != "experimentId"}) if isinstance(request, Mapping) else request
        parameters = getattr(given, types.asked)
        report = run(spark, process, given.input_blob.path, given.output_blob, vars(parameters), single=given.single_file)
    except Exception as e:
        status = 400 if isinstance(e, ValueError) else 500
        known = {"dataset_id": given.dataset_id, "requested_by": given.requested_by, "requested_at": given.requested_at, "request_metadata": given.request_metadata} if given else {"dataset_id": str(body.get("datasetId", "")), "requested_at": asked_at}
        return types.response(**ids, **known, success=False, status_code=status, message="failed", time_consumed_ms=elapsed_ms(started), error=Error(type(e).__name__, str(e)))
    return types.response(
        **ids, dataset_id=given.dataset_id, requested_by=given.requested_by, requested_at=given.requested_at, request_metadata=given.request_metadata, input_blob=given.input_blob, output_blob=given.output_blob,
        success=True, status_code=200, message="completed", time_consumed_ms=elapsed_ms(started), **{types.asked: parameters, types.answered: report},
    )
