import json
import uuid

import pytest

from tabulaire import tools
from tabulaire.operators import FILTERS
from tabulaire.pipeline import NORMALIZERS, SCALERS, handle, run
from tabulaire.report import Metadata, MinMaxInfo, StorageLocation
from tabulaire.requests import ENVELOPES, FAMILIES, PROCESSES, ColumnRequest, MinMaxRequest, RobustRequest
from tabulaire.sources import read_table
from tabulaire.sources.storage import create_container, download, in_background, load_model, model_metadata, save_model, upload

TEXT = "sample_id,g1,g2,label\ns1,1,4,A\ns2,3,3,B\ns3,,1,A\n"


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "layer.csv"
    path.write_text(TEXT)
    return str(path)


def test_twenty_processes():
    assert len(PROCESSES) == 20 and len(FAMILIES) == 7 and sum(map(len, FAMILIES.values())) == 20
    assert {p for ps in FAMILIES.values() for p in ps} == set(PROCESSES) == set(SCALERS) | set(NORMALIZERS) | set(FILTERS) | {"create_defined_feature_matrix", "feature_extraction"}


#: What each scaler has seen of columns with 2 and 3 values in 3 rows; robust does not say.
SEEN = {"standard_standardization": [2, 3], "min_max_standardization": 3, "max_abs_standardization": 3}


@pytest.mark.parametrize("process", SCALERS)
def test_scalers(spark, source, tmp_path, process):
    report = run(spark, process, source, StorageLocation(str(tmp_path), "out", extension="tsv"), {"numericColumns": ["g1", "g2"], "chunkSize": 2})
    assert [s.step for s in report.steps] == ["download", f"{SCALERS[process][0]}_fit", f"{SCALERS[process][0]}_transform", "upload"]
    assert report.output_file.path.endswith("out.csv"), "scalers write the format they read"
    assert getattr(report.info, "samples_seen", None) == SEEN.get(process) and report.info.fit_chunks_processed == 2
    assert getattr(report.info, "n_features_in", 2) == 2
    back = read_table(spark, report.output_file.path)
    assert back.columns == ["sample_id", "g1", "g2", "label"] and back.count() == 3
    row = report.to_dataframe(spark).first()
    assert row.steps[0].step == "download" and row.info.numeric_columns == ["g1", "g2"] and row.info.rows_processed == 3
    assert all(s.duration_ms >= 0 for s in report.steps) and report.total_duration_ms > 0 and report.success


def test_reports_are_typed(spark, source, tmp_path):
    report = run(spark, "min_max_standardization", source, StorageLocation(str(tmp_path), "out.csv"), {"numericColumns": ["g1", "g2"], "featureRange": [0, 2]})
    frame = report.to_dataframe(spark)
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema["info"].dataType}
    assert kinds["data_min"] == "array<double>" and kinds["samples_seen"] == "bigint" and kinds["feature_range"] == "array<double>" and kinds["clip"] == "boolean"
    assert frame.first().info.data_max == [3.0, 4.0] and frame.first().input_file.size_bytes > 0
    robust = run(spark, "robust_standardization", source, StorageLocation(str(tmp_path), "out.csv"), {"numericColumns": ["g2"], "withCentering": False})
    assert robust.info.center is None and robust.to_dataframe(spark).first().info.center is None
    standard = run(spark, "standard_standardization", source, StorageLocation(str(tmp_path), "out.csv"), {"numericColumns": ["g2"]})
    assert standard.info.samples_seen == 3 and standard.to_dataframe(spark).first().info.samples_seen == [3]
    assert isinstance(report.info, MinMaxInfo)


@pytest.mark.parametrize("process", NORMALIZERS)
def test_normalizers(spark, source, tmp_path, process):
    target = StorageLocation(str(tmp_path), "out.csv")
    with pytest.raises(ValueError, match="g1"):
        run(spark, process, source, target)
    assert not (tmp_path / "out.csv").exists()
    report = run(spark, process, source, target, {"numericColumns": ["g2"]})
    assert [s.step for s in report.steps] == ["download", process, "upload"] and report.info.rows_processed == 3


@pytest.mark.parametrize("process", FILTERS)
def test_filters_convert_formats(spark, source, tmp_path, process):
    report = run(spark, process, source, StorageLocation(str(tmp_path), "out", extension="TSV"))
    assert (tmp_path / "out.tsv").read_text().splitlines() == ["sample_id\tg1\tg2\tlabel", "s1\t1.0\t4\tA", "s2\t3.0\t3\tB"]
    assert report.info.to_json() == {"rowsProcessed": 3, "rowsRetained": 2, "rowsRemoved": 1}
    assert "removed 1" in next(s for s in report.steps if s.step == "retain_complete_samples").message
    with pytest.raises(ValueError, match="unknown fields"):
        run(spark, process, source, StorageLocation(str(tmp_path), "out.tsv"), {"threshold": 1})


def test_design_matrix(spark, source, tmp_path):
    report = run(spark, "create_defined_feature_matrix", source, StorageLocation(str(tmp_path), "m.csv"), {"definedFeatures": ["g2", "sample_id", "g2"]})
    assert read_table(spark, str(tmp_path / "m.csv")).columns == ["g2", "sample_id"] and report.info.missing_features == [] and report.info.samples_processed == 3
    with pytest.raises(ValueError):
        run(spark, "create_defined_feature_matrix", source, StorageLocation(str(tmp_path), "m.csv"), {"definedFeatures": []})
    info = run(spark, "feature_extraction", source, parameters={"excludedColumns": ["label", "zz"]}).info
    assert info.feature_names == ["sample_id", "g1", "g2"] and info.missing_excluded_columns == ["zz"]
    parts = run(spark, "create_defined_feature_matrix", source, StorageLocation(str(tmp_path), "p.csv"), {"definedFeatures": ["g2"]}, single=False)
    assert (tmp_path / "p.csv").is_dir() and parts.info.samples_processed == 3 and read_table(spark, str(tmp_path / "p.csv")).count() == 3


def test_requests():
    assert ColumnRequest.of({"chunkSize": 5}).chunk_size == 5 and ColumnRequest.of({"chunkSize": "5"}).chunk_size == 5
    wrong = [{"chunkSize": "x"}, {"chunkSize": 1.5}, {"chunkSize": True}, {"copy": 3}, {"numericColumns": "g1"}, {"numericColumns": [1]}, {"nope": 1}, {"chunkSize": None}]
    for bad in [lambda: ColumnRequest(chunk_size=0), lambda: MinMaxRequest(feature_range=(1, 1)), lambda: RobustRequest(quantile_range=(0, 75)), lambda: MinMaxRequest.of({"featureRange": [1]}), *[lambda w=w: ColumnRequest.of(w) for w in wrong]]:
        with pytest.raises(ValueError):
            bad()
    assert MinMaxRequest.of({"featureRange": [0, 2]}).to_json()["featureRange"] == [0, 2]
    said = Metadata.of({"application": "a", "team": 7})
    assert said.application == "a" and said.additional_data == {"team": 7}
    with pytest.raises(ValueError):
        ENVELOPES["annotate"].response(dataset_id="d", experiment_id="e", trace_id="t", success=True, status_code=600, message="m", time_consumed_ms=0)


#: Parameters of each process on the table above; filters and header listings need none.
ASKED = {"create_defined_feature_matrix": {"definedFeatures": ["g2", "label"]}} | dict.fromkeys([*SCALERS, *NORMALIZERS], {"numericColumns": ["g2"], "chunkSize": 10})


@pytest.mark.parametrize("process", PROCESSES)
def test_json_round_trip(spark, source, tmp_path, process):
    types = ENVELOPES[process]
    family = types.family.split("_")[0] + "".join(w.title() for w in types.family.split("_")[1:])
    asked = {
        "datasetId": "d", "requestedBy": "me", "requestedAt": "2024-01-02T03:04:05+00:00", "requestMetadata": {"application": "web", "ticket": 3}, f"{family}ProcessRequest": ASKED.get(process, {}),
        "inputBlob": {"root": str(tmp_path), "fileName": "layer.csv"},
    }
    if process != "feature_extraction":
        asked["outputBlob"] = {"root": str(tmp_path), "fileName": "out", "extension": "csv"}
    answer = handle(spark, process, {**asked, "experimentId": "A" * 32}, {"X-Trace-ID": "t1"})
    assert answer.success and isinstance(answer, types.response) and answer.experiment_id == str(uuid.UUID("a" * 32))
    text = json.dumps(answer.to_json())
    back = types.response.of(json.loads(text))
    assert back == answer and json.dumps(back.to_json()) == text
    said = json.loads(text)
    assert said["statusCode"] == 200 and said[f"{family}ProcessResponse"]["info"] and said["requestMetadata"]["additionalData"] == {"ticket": 3} and said["error"] is None
    assert types.request.of(json.loads(json.dumps(types.request.of(asked).to_json()))) == types.request.of(asked)
    for wrong in ({**asked, "inputBlob": {"root": "x"}}, {**asked, f"{family}ProcessRequest": {"odd": 1}}, {**asked, "more": 1}, {}):
        error = handle(spark, process, wrong)
        assert not error.success and error.status_code == 400 and getattr(error, types.answered) is None and types.response.of(json.loads(json.dumps(error.to_json()))) == error


def test_handle(spark, source, tmp_path):
    where = StorageLocation(str(tmp_path), "layer.csv")
    types = ENVELOPES["annotate"]
    good = handle(spark, "annotate", types.request(dataset_id="d", input_blob=where, output_blob=StorageLocation(str(tmp_path), "o.csv"), feature_selection_process_request=types.parameters()), {"X-Trace-ID": "t1"})
    assert good.success and good.status_code == 200 and good.trace_id == "t1" and good.feature_selection_process_response.info.rows_retained == 2
    types = ENVELOPES["l1_normalization"]
    bad = handle(spark, "l1_normalization", types.request(dataset_id="d", input_blob=where, output_blob=StorageLocation(str(tmp_path), "o.csv"), normalization_process_request=types.parameters()))
    assert not bad.success and bad.status_code == 400 and "g1" in bad.error.message
    lost = handle(spark, "annotate", {"datasetId": "d", "featureSelectionProcessRequest": {}, "inputBlob": {"root": str(tmp_path), "fileName": "no.csv"}, "outputBlob": {"root": str(tmp_path), "fileName": "o.csv"}})
    assert lost.status_code == 500 and lost.dataset_id == "d"


def test_storage(spark, tmp_path):
    root = str(tmp_path / "store")
    assert create_container(spark, root) and not create_container(spark, root)
    upload(spark, f"{root}/a/b.bin", b"\x00\xff")
    assert download(spark, f"{root}/a/b.bin") == b"\x00\xff"
    path = save_model(spark, root, "r1", {"w": [1, 2]})
    with pytest.raises(ValueError, match="pickle"):
        load_model(spark, path)
    assert load_model(spark, path, trusted=True) == {"w": [1, 2]} and model_metadata(spark, path) == {"request_id": "r1", "model_type": "support-vector-machine"}
    assert in_background(upload, spark, f"{root}/later", b"x").result() == 1 and in_background(download, spark, f"{root}/later").result() == b"x"
    with pytest.raises(ValueError):
        StorageLocation(" ", "x")


def test_tools(tmp_path):
    assert tools.parse_experiment_id({"experimentId": "A" * 32}) == str(uuid.UUID("a" * 32))
    assert uuid.UUID(tools.parse_experiment_id({"experimentId": "x"})) and uuid.UUID(tools.parse_experiment_id({}))
    trace = "0" * 31 + "1"
    assert tools.get_trace_id({"traceparent": f"00-{trace}-a-b"}) == trace and len(tools.get_trace_id({"traceparent": "00-1-2"})) == 32
    assert tools.to_string_keyed_dict({"a": 1, 2: 3}) == {"a": 1} and tools.to_string_keyed_dict([1]) == {}
    (tmp_path / "pyproject.toml").write_text('[project]\nversion = "2.1"\n')
    assert tools.project_version(str(tmp_path)) == "2.1" and tools.project_version(str(tmp_path / "no")) == "unknown"
    assert tools.utc_now().tzinfo is not None and tools.elapsed_ms(0) > 0
