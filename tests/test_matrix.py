"""Matrices against the same operators on columns, and files of thousands of columns."""

import math
import time

import numpy as np
import pandas as pd
import pytest

from tabulaire.operators import MaxAbs, MinMax, Robust, Standard, complete_cases, normalize, select_features
from tabulaire.operators.matrix import chosen_features, complete_rows, fit_matrix, matrix_state, normalize_matrix, pack, read_matrix, scale_matrix, write_matrix
from tabulaire.plans.state import merged, resume, save_part
from tabulaire.sources.delimited import infer_wide, read_delimited

NAMES = ["x", "a.b", "gaps", "none", "k", "whole"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(300).selectExpr("concat('s', id) as id", "cast(hash(id) as double) as x", "1e6 + id / 7.0D as `a.b`", "case when id % 3 = 0 then null when id % 5 = 0 then double('nan') else id * 1.0D end as gaps", "cast(null as double) as none", "7.0D as k", "id - 9 as whole", "id % 2 = 0 as flag").repartition(3)


def rows_of(df):
    return sorted((str(r[0]), tuple(None if v is None else round(float(v), 6) + 0.0 for v in r[1:])) for r in df.collect())


SCALERS = [Standard(), Standard(with_mean=False), Standard(with_std=False), MinMax(feature_range=(-1, 1), clip=True), MinMax(), MaxAbs(), Robust(), Robust(quantile_range=(10, 80), unit_variance=True), Robust(with_centering=False), Robust(with_scaling=False)]


@pytest.mark.parametrize("scaler", SCALERS, ids=str)
def test_scalers_equal_those_on_columns(table, scaler):
    matrix = pack(table, NAMES)
    assert matrix.others == ["id", "flag"]
    fitted, plain = fit_matrix(matrix, scaler), type(scaler)(NAMES, **scaler.flags).fit(table)
    assert (fitted.columns, fitted.rows, fitted.counts) == (plain.columns, plain.rows, plain.counts)
    for k, v in plain.values.items():
        assert (fitted.values[k] is None) == (v is None)
        for a, b in zip(fitted.values[k] or [], v or [], strict=True):
            assert a == b if b is None else a == pytest.approx(b, rel=1e-9, abs=1e-9)
    got = scale_matrix(matrix, scaler, plain).unpacked().select("id", *[f"`{n}`" for n in NAMES])
    assert rows_of(got) == rows_of(scaler.transform(table, plain).select("id", *[f"`{n}`" for n in NAMES]))


@pytest.mark.parametrize("norm", ["l1", "l2", "max"])
def test_norms_filters_and_choices(spark, table, norm):
    full = ["x", "a.b", "whole"]
    matrix = pack(table.select("id", "x", "`a.b`", "whole"), full)
    assert rows_of(normalize_matrix(matrix, norm).unpacked()) == rows_of(normalize(table.select("id", "x", "`a.b`", "whole"), norm, full))
    with pytest.raises(Exception, match="gaps"):
        normalize_matrix(pack(table, NAMES), norm).rows.collect()
    some = table.select("id", "x", "gaps")
    assert rows_of(complete_rows(pack(some)).unpacked()) == rows_of(complete_cases(some))
    assert rows_of(chosen_features(pack(table, NAMES), ["whole", "x", "whole"]).unpacked().select("id", "whole", "x")) == rows_of(select_features(table, ["id", "whole", "x"]))
    with pytest.raises(ValueError, match="nope"):
        chosen_features(matrix, ["nope"])


def test_states_of_matrices_merge_with_those_of_columns(spark, table, tmp_path):
    from tabulaire.plans.state import partial_state

    folder = str(tmp_path / "s")
    save_part(matrix_state(pack(table.where("whole < 50"), NAMES)), folder, "a")
    save_part(partial_state(table.where("whole >= 50"), NAMES), folder, "b")
    got, plain = Standard(NAMES).finish(resume(spark, folder)), Standard(NAMES).fit(table)
    assert got.counts == plain.counts
    for k in ("mean", "variance", "scale"):
        assert got.values[k] == [b if b is None else pytest.approx(b, rel=1e-6, abs=1e-9) for b in plain.values[k]]


def test_odd_matrices(spark, table):
    bad = spark.createDataFrame([(1.0, 2.0), (math.inf, 1.0)], "x double, y double")
    with pytest.raises(ValueError, match="infinity.*x"):
        fit_matrix(pack(bad), Standard())
    with pytest.raises(Exception, match="infinity"):
        scale_matrix(pack(bad), Standard(), Standard().fit(bad.where("x = 1"))).rows.collect()
    none = pack(table.limit(0), NAMES)
    for scaler in (Standard(), Robust(), MinMax()):
        assert fit_matrix(none, scaler).rows == 0 and scale_matrix(none, scaler).unpacked().count() == 0
    with pytest.raises(ValueError, match="other features"):
        scale_matrix(pack(table, ["x"]), Standard(), Standard(["k"]).fit(table))
    with pytest.raises(ValueError, match="values"):
        pack(table.selectExpr("x", "id as values"))


@pytest.mark.parametrize("name", ["t.csv", "t.tsv"])
def test_files(spark, tmp_path, name):
    separator = "\t" if name.endswith("tsv") else ","
    text = separator.join(["id", '"g,1\tx"', "g2", "g2", "note"]) + "\n" + "".join(separator.join([f's{i}', str(i / 4), "NA" if i % 3 else "-1e3", "", f'"line\n{i} ""q"""' if i % 2 else "plain"]) + "\r\n" for i in range(50))
    (tmp_path / name).write_bytes(text.encode())
    matrix = read_matrix(spark, str(tmp_path / name), ["id", "note"])
    assert matrix.names == ["g,1\tx", "g2", "g2.1"] and matrix.others == ["id", "note"]
    rows = sorted(matrix.rows.collect(), key=lambda r: int(r.id[1:]))
    assert [(r.id, r.note, list(r["values"])) for r in rows] == [(f"s{i}", f'line\n{i} "q"' if i % 2 else "plain", [i / 4, None if i % 3 else -1000.0, None]) for i in range(50)]
    write_matrix(matrix, str(tmp_path / f"out-{name}"))
    back = pd.read_csv(tmp_path / f"out-{name}", sep=separator)
    assert list(back.columns) == ["id", "note", "g,1\tx", "g2", "g2.1"] and sorted(back["note"]) == sorted(r.note for r in rows) and back["g,1\tx"].sum() == sum(i / 4 for i in range(50))
    (tmp_path / f"bad-{name}").write_text(separator.join("ab") + "\n" + separator.join(["1", "x"]) + "\n")
    with pytest.raises(Exception, match="'b' is not numeric"):
        read_matrix(spark, str(tmp_path / f"bad-{name}"), []).rows.collect()


def test_twenty_thousand_columns(spark, tmp_path):
    """From file to file: planned at once and run in seconds."""
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(40, 20_000)) * 5, 3)
    with open(tmp_path / "wide.csv", "w") as f:
        f.write("id," + ",".join(f"g{i}" for i in range(20_000)) + "\n")
        f.writelines(f"s{i}," + ",".join(map(str, r)) + "\n" for i, r in enumerate(x))
    began = time.perf_counter()
    matrix = read_matrix(spark, str(tmp_path / "wide.csv"), ["id"])
    scaled = scale_matrix(matrix, Standard())
    write_matrix(scaled, str(tmp_path / "out.csv"))
    took = time.perf_counter() - began
    out = pd.read_csv(tmp_path / "out.csv").sort_values("id", key=lambda s: s.str[1:].astype(int))
    assert np.allclose(out.iloc[:, 1:].to_numpy(), (x - x.mean(0)) / x.std(0)) and list(out.columns[:2]) == ["id", "g0"]
    assert took < 60, took
    robust = fit_matrix(matrix, Robust())
    assert np.allclose(robust.values["center"], np.median(x, 0)) and np.allclose(robust.values["scale"], np.quantile(x, 0.75, axis=0) - np.quantile(x, 0.25, axis=0))


def test_types_of_wide_files(spark, tmp_path):
    """As the types of columns are found, of 3,000 columns in one scan."""
    kinds = {"l": ["1", "-2", ""], "w": ["1", "+2", " 3"], "f": ["1", "2.5", "NA"], "b": ["True", "false", "TRUE"], "s": ["x", "1", "2"], "n": ["", "NA", "nan"], "g": ["99999999999999999999", "1", "2"], "i": ["inf", "-Infinity", "1"], "m": ["True", "", "False"], "u": ["1_0", "2", "3"], "d": ["NAN", "1", "2"], "q": ['"1"', '"2"', "3"]}
    names = [f"{k}{j}" for j in range(250) for k in kinds]
    rows = [",".join(kinds[n[0]][i] for n in names) for i in range(3)]
    (tmp_path / "t.csv").write_text(",".join(names) + "\n" + "\n".join(rows) + "\n")
    expected = {"l": "double", "w": "bigint", "f": "double", "b": "boolean", "s": "string", "n": "double", "g": "double", "i": "double", "m": "string", "u": "string", "d": "string", "q": "bigint"}
    got = infer_wide(spark, str(tmp_path / "t.csv"), names)
    assert {n: t.simpleString() for n, t in got.items()} == {n: expected[n[0]] for n in names}
    (tmp_path / "small.csv").write_text(",".join(kinds) + "\n" + "\n".join(",".join(kinds[k][i] for k in kinds) for i in range(3)) + "\n")
    assert {c: t for c, t in read_delimited(spark, str(tmp_path / "small.csv")).dtypes} == expected
    (tmp_path / "head.csv").write_text(",".join(names) + "\n")
    assert {t.simpleString() for t in infer_wide(spark, str(tmp_path / "head.csv"), names).values()} == {"string"}


@pytest.mark.parametrize(("process", "parameters"), [("standard_standardization", {}), ("robust_standardization", {"quantileRange": [10, 90]}), ("l2_normalization", {"chunkSize": 7})])
def test_processes_on_wide_files(spark, tmp_path, process, parameters, monkeypatch):
    """The same file and report as by columns."""
    from tabulaire import pipeline
    from tabulaire.report import StorageLocation

    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(30, 60)), 4)
    (tmp_path / "in.csv").write_text("id,site," + ",".join(f"g{i}" for i in range(60)) + "\n" + "".join(f's{i},"a,{i}",' + ",".join(map(str, r)) + "\n" for i, r in enumerate(x)))
    plain = pipeline.run(spark, process, str(tmp_path / "in.csv"), StorageLocation(str(tmp_path), "plain"), parameters)
    monkeypatch.setattr(pipeline, "WIDE_FILE", 10)
    seen = []
    monkeypatch.setattr(pipeline, "write_matrix", lambda m, p: seen.append(p) or write_matrix(m, p))
    wide = pipeline.run(spark, process, str(tmp_path / "in.csv"), StorageLocation(str(tmp_path), "wide"), parameters)
    assert seen, "the table was a matrix"
    one, other = pd.read_csv(tmp_path / "plain.csv"), pd.read_csv(tmp_path / "wide.csv")
    pd.testing.assert_frame_equal(one, other, check_exact=False, rtol=1e-9)
    for k, v in vars(plain.info).items():
        w = getattr(wide.info, k)
        assert w == (pytest.approx(v, rel=1e-9) if isinstance(v, list) and v and isinstance(v[0], float) else v), k
    # columns that are not all the numbers, or not last, go by columns
    (tmp_path / "mixed.csv").write_text("g0,id," + ",".join(f"g{i}" for i in range(1, 20)) + "\n" + "".join("1,s," + ",".join("2" for _ in range(19)) + "\n" for _ in range(3)))
    seen.clear()
    report = pipeline.run(spark, process, str(tmp_path / "mixed.csv"), StorageLocation(str(tmp_path), "mixed-out"), parameters)
    assert not seen and report.info.numeric_column_count == 20 and list(pd.read_csv(tmp_path / "mixed-out.csv").columns[:2]) == ["g0", "id"]


def test_merged_states_of_many_tasks(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as x").repartition(16)
    state = merged(matrix_state(pack(df))).first()
    assert (state["rows"], state.n, state.mean, round(state.m2, 3)) == (1000, 1000, pytest.approx(499.5), round(sum((i - 499.5) ** 2 for i in range(1000)), 3))
