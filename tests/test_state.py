"""Fits in parts against fits of the whole, in batch and on streams, and fits that are stored."""

import math
import pickle
import random

import pytest

from tabulaire.operators import MaxAbs, MinMax, Robust, Standard
from tabulaire.plans.state import load_parts, merged, partial_state, resume, save_part, sketched_quantiles
from tabulaire.sources.artefacts import load_fit, save_fit
from tabulaire.sources.storage import load_model, save_model
from tabulaire.streaming import fit_stream

COLUMNS = ["x", "y", "a.b", "none", "whole"]
SCALERS = [Standard(COLUMNS), Standard(COLUMNS, with_mean=False), MinMax(COLUMNS, feature_range=(-1, 2)), MaxAbs(COLUMNS)]


@pytest.fixture(scope="module")
def table(spark):
    """Values far from zero beside their spread, so that sums of squares would cancel."""
    return spark.range(2000).selectExpr("id", "1e9 + pmod(hash(id), 1000) / 100.0D as x", "case when id % 3 = 0 then null when id % 7 = 0 then double('nan') else cast(hash(id) as double) end as y", "cast(id % 5 as float) as `a.b`", "cast(null as double) as none", "id - 77 as whole")


def same(one, other):
    assert (one.columns, one.rows, one.counts) == (other.columns, other.rows, other.counts) and one.values.keys() == other.values.keys()
    for k, v in one.values.items():
        assert len(v) == len(other.values[k])
        for a, b in zip(v, other.values[k], strict=True):
            assert a == b if a is None or b is None else a == pytest.approx(b, rel=1e-6, abs=1e-9), k


@pytest.mark.parametrize("wide", [60, 0])
def test_parts_merge_to_the_whole(spark, table, tmp_path, wide):
    folder = str(tmp_path / "state")
    parts = {"a": "id < 10", "b": "id between 10 and 1200", "empty": "false", "c": "id > 1200"}
    for part, test in parts.items():
        save_part(partial_state(table.where(test), COLUMNS, wide=wide), folder, part)
    save_part(partial_state(table.where(parts["b"]), COLUMNS), folder, "b")  # run again: counts once
    for scaler in SCALERS:
        same(scaler.finish(resume(spark, folder)), scaler.fit(table))
    # in pairs, and in another order
    a, b, c = (partial_state(table.where(parts[p]), COLUMNS, wide=wide) for p in "abc")
    same(SCALERS[0].finish(merged(merged(c.unionByName(a)).unionByName(b))), SCALERS[0].fit(table))


def test_state_says_what_it_does_not_know(spark, table, tmp_path):
    with pytest.raises(ValueError, match="no columns"):
        Standard(["x", "y"]).finish(merged(partial_state(table, ["x"])))
    bad = spark.createDataFrame([(1.0,), (math.inf,)], "x double")
    with pytest.raises(ValueError, match="infinity"):
        Standard(["x"]).finish(merged(partial_state(bad).unionByName(partial_state(table, ["x"]))))
    path = save_part(partial_state(table, ["x"]), str(tmp_path / "s"), "p")
    spark.read.parquet(path).selectExpr("9 as format", "* except (format)").write.parquet(str(tmp_path / "other" / "part=p"))
    with pytest.raises(Exception, match="another format"):
        load_parts(spark, str(tmp_path / "other")).collect()


def test_sketches_of_parts(spark, table):
    """Few values: the sketch holds all of them; many: ranks are as near as the sketch promises."""
    odds = [0.1, 0.5, 0.9]
    few = merged(partial_state(table.where("id < 300"), ["whole"], sketch=1024).unionByName(partial_state(table.where("id between 300 and 599"), ["whole"], sketch=1024)))
    assert [round(v) for v in sketched_quantiles(few, odds).first().q] == [-18, 222, 462]
    many = spark.range(200_000).selectExpr("cast(pmod(hash(id), 100000) as double) as x")
    states = [partial_state(many.where(f"x % 4 = {k}"), sketch=1024) for k in range(4)]
    whole = sorted(r.x for r in many.collect())
    union = states[0]
    for s in states[1:]:
        union = union.unionByName(s)
    for p, v in zip(odds, sketched_quantiles(merged(union), odds).first().q, strict=True):
        low, high = whole.index(v), len(whole) - whole[::-1].index(v)
        assert low / len(whole) - 0.02 <= p <= high / len(whole) + 0.02
    fitted = Robust(["x"]).finish(merged(union))
    assert fitted.values["center"][0] == pytest.approx(50_000, abs=2000)
    assert Robust(["x"]).finish(merged(partial_state(many, ["x"]))).values["center"] == [None], "without a sketch no quantile is known"


def test_stream_goes_on_where_it_stopped(spark, table, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    rows = table.selectExpr("x", "y")

    def drain():
        query = fit_stream(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source), folder, ["x", "y"], sketch=512).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        query.awaitTermination()

    rows.where("x < 1e9 + 3").repartition(2).write.parquet(source)
    drain()
    scaler = Standard(["x", "y"])
    same(scaler.finish(resume(spark, folder)), scaler.fit(rows.where("x < 1e9 + 3")))
    rows.where("x >= 1e9 + 3").repartition(3).write.mode("append").parquet(source)
    drain()
    drain()  # nothing new
    same(scaler.finish(resume(spark, folder)), scaler.fit(rows))


@pytest.mark.parametrize("scaler", [*SCALERS, Standard(COLUMNS, with_mean=False, with_std=False), Robust(COLUMNS), Robust(COLUMNS, with_centering=False, quantile_range=(10, 80), unit_variance=True), MinMax(COLUMNS, clip=True)], ids=str)
def test_stored_fit_is_the_fit(spark, table, tmp_path, scaler):
    fitted = scaler.fit(table)
    back, stored = load_fit(spark, save_fit(spark, scaler, fitted, str(tmp_path / "f")), table)
    assert stored == fitted and back.flags == {k: tuple(v) if isinstance(v, tuple) else v for k, v in scaler.flags.items()} and type(back) is type(scaler)


def test_stored_fit_is_refused_where_it_does_not_fit(spark, table, tmp_path, monkeypatch):
    path = save_fit(spark, scaler := Standard(["x", "y"]), scaler.fit(table), str(tmp_path / "f"))
    with pytest.raises(ValueError, match="not found"):
        load_fit(spark, path, table.select("x"))
    with pytest.raises(ValueError, match="not numeric"):
        load_fit(spark, path, table.selectExpr("x", "string(y) as y"))
    rows = spark.read.parquet(path)
    for i, change in enumerate((rows.where("position = 0"), rows.withColumn("rows", rows["rows"] + 1), rows.unionByName(rows))):
        change.write.parquet(str(tmp_path / f"bad{i}"))
        with pytest.raises(ValueError, match="incomplete or was changed"):
            load_fit(spark, str(tmp_path / f"bad{i}"))
    rows.withColumn("format", rows["format"] + 1).write.parquet(str(tmp_path / "new"))
    with pytest.raises(ValueError, match="format 2"):
        load_fit(spark, str(tmp_path / "new"))
    # a model that is a scaler and its fit is never unpickled
    monkeypatch.setattr(pickle, "loads", lambda data: pytest.fail("unpickled"))
    back, fitted = load_model(spark, save_model(spark, str(tmp_path), "r", (scaler, scaler.fit(table)), "scaler"))
    assert fitted == scaler.fit(table) and back.columns == ["x", "y"]


def test_random_splits(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, math.nan, 0.0, rng.uniform(-1, 1) * 10 ** rng.randrange(-5, 6)]), rng.randrange(6)) for _ in range(200)]
    df = spark.createDataFrame(rows, "v double, part int").coalesce(2)
    union = None
    for k in range(6):
        one = partial_state(df.where(f"part = {k}"), ["v"])
        union = one if union is None else union.unionByName(one)
    for scaler in (Standard(["v"]), MinMax(["v"]), MaxAbs(["v"])):
        same(scaler.finish(merged(union)), scaler.fit(df))
