"""Requests and responses: parameters of every process, and the envelopes of the seven families.

``copy`` and ``chunkSize`` are accepted, checked and reported, and change
nothing: Spark has partitions instead of chunks. An envelope differs by process
in the types of its parameters and report alone, so the envelopes are made from
the table of processes (see ``envelopes``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, make_dataclass
from datetime import datetime

from tabulaire.records import Record
from tabulaire.report import (
    Error,
    FeatureExtractionInfo,
    FeatureMatrixInfo,
    FilterInfo,
    MaxAbsInfo,
    Metadata,
    MinMaxInfo,
    NormInfo,
    Report,
    RobustInfo,
    StandardInfo,
    StorageLocation,
    report_of,
)
from tabulaire.tools import utc_now


@dataclass
class ColumnRequest(Record):
    numeric_columns: list[str] | None = None
    chunk_size: int = 100_000
    copy: bool = True

    def __post_init__(self) -> None:
        if self.chunk_size <= 0:
            raise ValueError("chunkSize must be greater than 0")


@dataclass
class StandardRequest(ColumnRequest):
    with_mean: bool = True
    with_std: bool = True


@dataclass
class MinMaxRequest(ColumnRequest):
    feature_range: tuple[float, float] = (0.0, 1.0)
    clip: bool = False

    def __post_init__(self) -> None:
        super().__post_init__()
        low, high = self.feature_range = tuple(map(float, self.feature_range))
        if not low < high:
            raise ValueError("featureRange minimum must be less than its maximum")


@dataclass
class MaxAbsRequest(ColumnRequest):
    clip: bool = False


@dataclass
class RobustRequest(ColumnRequest):
    with_centering: bool = True
    with_scaling: bool = True
    quantile_range: tuple[float, float] = (25.0, 75.0)
    unit_variance: bool = False

    def __post_init__(self) -> None:
        super().__post_init__()
        low, high = self.quantile_range = tuple(map(float, self.quantile_range))
        if not 0 < low < high < 100:
            raise ValueError("quantileRange must satisfy 0 < low < high < 100")


@dataclass
class FilterRequest(Record):
    """The complete-case filters take no parameters."""


@dataclass
class FeatureMatrixRequest(Record):
    defined_features: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.defined_features:
            raise ValueError("definedFeatures must not be empty")


@dataclass
class FeatureExtractionRequest(Record):
    excluded_columns: list[str] = field(default_factory=list)


@dataclass(kw_only=True)
class FamilyRequest(Record):
    """What every request says; a family's requests add ``<family>_process_request``. No output is written by header listings."""

    dataset_id: str
    input_blob: StorageLocation
    output_blob: StorageLocation | None = None
    requested_by: str | None = None
    requested_at: datetime = field(default_factory=utc_now)
    request_metadata: Metadata | None = None
    #: Whether delimited output is one file or a folder of parts.
    single_file: bool = True

    def __post_init__(self) -> None:
        if not self.dataset_id:
            raise ValueError("datasetId must not be empty")


@dataclass(kw_only=True)
class FamilyResponse(Record):
    """What every response says; a family's responses add ``<family>_process_request`` and ``<family>_process_response``, null in errors."""

    dataset_id: str
    experiment_id: str
    trace_id: str
    success: bool
    status_code: int
    message: str
    time_consumed_ms: float
    requested_by: str | None = None
    requested_at: datetime = field(default_factory=utc_now)
    completed_at: datetime = field(default_factory=utc_now)
    input_blob: StorageLocation | None = None
    output_blob: StorageLocation | None = None
    request_metadata: Metadata | None = None
    response_metadata: Metadata | None = None
    error: Error | None = None

    def __post_init__(self) -> None:
        if not 100 <= self.status_code <= 599:
            raise ValueError("statusCode must be from 100 to 599")
        if self.time_consumed_ms < 0:
            raise ValueError("timeConsumedMs must not be negative")
        if self.success != (self.error is None):
            raise ValueError("a response has an error if and only if it has no success")


#: Process to its family, parameters and what it reports; filters are added by name.
PROCESSES: dict[str, tuple[str, type[Record], type[Record]]] = {
    "standard_standardization": ("standardization", StandardRequest, StandardInfo),
    "min_max_standardization": ("standardization", MinMaxRequest, MinMaxInfo),
    "max_abs_standardization": ("standardization", MaxAbsRequest, MaxAbsInfo),
    "robust_standardization": ("standardization", RobustRequest, RobustInfo),
    **{f"{norm}_normalization": ("normalization", ColumnRequest, NormInfo) for norm in ("l1", "l2", "max")},
    **dict.fromkeys(("retain_complete_samples", "retain_common_samples_across_layers"), ("sample_selection", FilterRequest, FilterInfo)),
    **dict.fromkeys(("assign_class_labels", "detect_classification_type", "extract_subtype_labels"), ("class_labels", FilterRequest, FilterInfo)),
    **dict.fromkeys(("annotate", "remove_low_variance", "remove_no_signal", "select_correlation", "select_top_features"), ("feature_selection", FilterRequest, FilterInfo)),
    "data_extraction": ("matrix_extraction", FilterRequest, FilterInfo),
    "create_defined_feature_matrix": ("design_matrix", FeatureMatrixRequest, FeatureMatrixInfo),
    "feature_extraction": ("design_matrix", FeatureExtractionRequest, FeatureExtractionInfo),
}


@dataclass(frozen=True)
class Envelopes:
    """The types that go with a process."""

    family: str
    parameters: type[Record]
    report: type[Report]
    request: type[FamilyRequest]
    response: type[FamilyResponse]

    @property
    def asked(self) -> str:
        return f"{self.family}_process_request"

    @property
    def answered(self) -> str:
        return f"{self.family}_process_response"


def envelopes(process: str) -> Envelopes:
    family, parameters, info = PROCESSES[process]
    name = "".join(part.title() for part in process.split("_"))
    report = report_of(f"{name}Report", info)
    asked = f"{family}_process_request"
    request = make_dataclass(f"{name}Request", [(asked, parameters)], bases=(FamilyRequest,), kw_only=True)
    answers = [(asked, parameters | None, field(default=None)), (f"{family}_process_response", report | None, field(default=None))]
    return Envelopes(family, parameters, report, request, make_dataclass(f"{name}Response", answers, bases=(FamilyResponse,), kw_only=True))


ENVELOPES: dict[str, Envelopes] = {process: envelopes(process) for process in PROCESSES}
#: Families and their processes.
FAMILIES: dict[str, tuple[str, ...]] = {f: tuple(p for p, (own, _, _) in PROCESSES.items() if own == f) for f in dict.fromkeys(f for f, _, _ in PROCESSES.values())}
