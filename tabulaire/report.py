"""Typed reports of what a process did, as records, JSON and a DataFrame of one row."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, make_dataclass
from datetime import datetime
from time import perf_counter
from typing import Any, Self

from pyspark.sql import DataFrame, SparkSession

from tabulaire.records import Record, snake
from tabulaire.tools import utc_now


@dataclass
class StorageLocation(Record):
    """Where a table is: ``root`` is any URI Spark reads, such as abfss://container@account.host."""

    root: str
    file_name: str
    directory: str = ""
    extension: str | None = None

    def __post_init__(self) -> None:
        if not self.root.strip() or not self.file_name.strip():
            raise ValueError("root and file_name must not be empty")

    @property
    def path(self) -> str:
        name = self.file_name if not self.extension else f"{self.file_name}.{self.extension.lstrip('.')}"
        return "/".join(p for p in (self.root.rstrip("/"), self.directory.strip("/"), name) if p)


@dataclass
class Step(Record):
    step: str
    started_at: datetime
    completed_at: datetime
    duration_ms: float
    message: str | None = None


@dataclass
class FileInfo(Record):
    path: str
    file_name: str
    extension: str
    size_bytes: int
    size_mb: float = 0.0

    def __post_init__(self) -> None:
        self.size_mb = self.size_bytes / 1024 / 1024


@dataclass
class Metadata(Record):
    """What a caller says of itself; names that are no fields go to ``additional_data``."""

    application: str | None = None
    version: str = "1.0"
    additional_data: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def of(cls, given: Mapping[str, Any]) -> Self:
        more = {k: v for k, v in given.items() if snake(k) not in cls.kinds()}
        record = super().of({k: v for k, v in given.items() if k not in more})
        record.additional_data = more | record.additional_data
        return record


@dataclass
class Error(Record):
    code: str
    message: str
    details: str | None = None


@dataclass
class ColumnInfo(Record):
    """What scalers and norms have in common. Chunks are counted as a reader of ``chunk_size`` rows would."""

    numeric_columns: list[str]
    numeric_column_count: int
    rows_processed: int
    transform_chunks_processed: int
    chunk_size: int


@dataclass
class StandardInfo(ColumnInfo):
    fit_chunks_processed: int
    with_mean: bool
    with_std: bool
    mean: list[float | None]
    variance: list[float | None]
    scale: list[float | None]
    samples_seen: int | list[int] | None


@dataclass
class MinMaxInfo(ColumnInfo):
    fit_chunks_processed: int
    feature_range: tuple[float, float]
    clip: bool
    min_adjustment: list[float | None]
    scale: list[float | None]
    data_min: list[float | None]
    data_max: list[float | None]
    data_range: list[float | None]
    samples_seen: int


@dataclass
class MaxAbsInfo(ColumnInfo):
    fit_chunks_processed: int
    clip: bool
    max_abs: list[float | None]
    scale: list[float | None]
    samples_seen: int


@dataclass
class RobustInfo(ColumnInfo):
    fit_chunks_processed: int
    with_centering: bool
    with_scaling: bool
    quantile_range: tuple[float, float]
    unit_variance: bool
    center: list[float | None] | None
    scale: list[float | None] | None
    n_features_in: int


@dataclass
class NormInfo(ColumnInfo):
    norm: str


@dataclass
class FilterInfo(Record):
    rows_processed: int
    rows_retained: int
    rows_removed: int


@dataclass
class FeatureMatrixInfo(Record):
    requested_features: list[str]
    selected_features: list[str]
    missing_features: list[str]
    requested_feature_count: int
    selected_feature_count: int
    missing_feature_count: int
    samples_processed: int


@dataclass
class FeatureExtractionInfo(Record):
    feature_names: list[str]
    feature_count: int
    total_column_count: int
    excluded_columns: list[str]
    excluded_column_count: int
    missing_excluded_columns: list[str]


@dataclass
class Report(Record):
    """Steps, files and (typed by the process, see ``report_of``) what it found."""

    process: str
    success: bool = False
    started_at: datetime = field(default_factory=utc_now)
    completed_at: datetime | None = None
    total_duration_ms: float = 0.0
    input_file: FileInfo | None = None
    output_file: FileInfo | None = None
    steps: list[Step] = field(default_factory=list)
    info: Record | None = None

    @contextmanager
    def step(self, name: str) -> Iterator[list[str]]:
        """Times a block; what it appends to the list it is given becomes the step's message."""
        said: list[str] = []
        started, at = utc_now(), perf_counter()
        yield said
        self.steps.append(Step(name, started, utc_now(), (perf_counter() - at) * 1000, " ".join(said) or None))

    def finish(self, info: Record) -> Self:
        self.success, self.completed_at, self.info = True, utc_now(), info
        self.total_duration_ms = (self.completed_at - self.started_at).total_seconds() * 1000
        return self

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        """One row; steps are an array of structs, files and info structs of typed fields."""
        return spark.createDataFrame([self.row()], self.schema())


def report_of(name: str, info: type[Record]) -> type[Report]:
    """The report type whose info is of type ``info``."""
    return make_dataclass(name, [("info", info | None, field(default=None))], bases=(Report,))
