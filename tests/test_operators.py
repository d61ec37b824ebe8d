import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tabulaire.operators import FILTERS, MaxAbs, MinMax, Robust, Standard, complete_cases, extract_features, feature_listing, normalize, select_features, standardize
from tabulaire.operators.scalers import METHODS
from tabulaire.plans import stats
from tabulaire.plans.stats import collected, column_stats, quantiles

SCHEMA = "sample_id string, x double, y double, k double, flag boolean, note string"
ROWS = [("s1", 1.0, -4.0, 7.0, True, "a"), ("s2", 2.0, 0.0, 7.0, False, None), ("s3", 3.0, 2.0, 7.0, True, "b"), ("s4", 4.0, 8.0, 7.0, True, "c"), ("s5", None, 4.0, 7.0, False, "d")]


@pytest.fixture(scope="module")
def basic(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def values(df, column):
    return [r[column] for r in df.orderBy("sample_id").collect()]


def near(got, expected):
    assert [None if g is None else round(g, 6) + 0.0 for g in got] == pytest.approx(expected) or [None if g is None else round(g, 6) for g in got] == expected


@pytest.mark.parametrize(
    ("scaler", "x", "y", "k"),
    [
        (Standard(), [-1.341641, -0.447214, 0.447214, 1.341641, None], [-1.5, -0.5, 0, 1.5, 0.5], [0] * 5),
        (MinMax(), [0, 0.333333, 0.666667, 1, None], [0, 0.333333, 0.5, 1, 0.666667], [0] * 5),
        (MaxAbs(), [0.25, 0.5, 0.75, 1, None], [-0.5, 0, 0.25, 1, 0.5], [1] * 5),
        (Robust(), [-1, -0.333333, 0.333333, 1, None], [-1.5, -0.5, 0, 1.5, 0.5], [0] * 5),
        (Robust(unit_variance=True), [-1.348980, -0.449660, 0.449660, 1.348980, None], [-2.023469, -0.674490, 0, 2.023469, 0.674490], [0] * 5),
    ],
)
@pytest.mark.parametrize("wide", [60, 0])
def test_scalers(basic, scaler, x, y, k, wide):
    scaler.wide = wide
    out = scaler.apply(basic)
    assert out.columns == basic.columns
    assert values(out, "flag") == [r[4] for r in ROWS]
    for column, expected in (("x", x), ("y", y), ("k", k)):
        got = values(out, column)
        assert [g is None for g in got] == [e is None for e in expected]
        assert [g for g in got if g is not None] == pytest.approx([e for e in expected if e is not None], abs=1e-6)


def test_standard_report(basic):
    fitted = Standard().fit(basic)
    assert fitted.columns == ["x", "y", "k"] and fitted.samples_seen == [4, 5, 5]
    assert fitted.values["mean"] == [2.5, 2.0, 7.0] and fitted.values["variance"] == [1.25, 16.0, 0.0] and fitted.values["scale"][2] == 1.0
    neither = Standard(with_mean=False, with_std=False)
    assert neither.fit(basic).values == {"mean": [], "variance": [], "scale": []}
    assert values(neither.apply(basic), "y") == [-4, 0, 2, 8, 4]


def test_min_max_clip_keeps_missing(basic):
    scaler = MinMax(["x"], feature_range=(-1, 1), clip=True)
    out = scaler.transform(basic, scaler.fit(basic.where("x between 2 and 3")))
    assert values(out, "x") == [-1, -1, 1, 1, None]


def test_column_choice(basic):
    with pytest.raises(ValueError, match="not found.*nope"):
        Standard(["nope"]).fit(basic)
    with pytest.raises(ValueError, match="not numeric.*note"):
        Standard(["note"]).fit(basic)
    with pytest.raises(ValueError, match="no numeric columns"):
        Standard().fit(basic.select("note"))
    assert values(standardize(basic, "max_abs", ["flag"]), "flag") == [1, 0, 1, 1, 0]
    assert Standard([]).fit(basic).columns == ["x", "y", "k"]


@pytest.mark.parametrize("flags", [{"feature_range": (1, 1)}, {"feature_range": (2, 1)}])
def test_bad_range(flags):
    with pytest.raises(ValueError):
        MinMax(**flags)


@pytest.mark.parametrize("bounds", [(0, 75), (75, 25), (25, 100)])
def test_bad_quantiles(bounds):
    with pytest.raises(ValueError):
        Robust(quantile_range=bounds)


def test_infinity_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    with pytest.raises(ValueError, match="infinity"):
        Standard().fit(df)
    with pytest.raises(Exception, match="infinity"):
        scaler = Standard()
        scaler.transform(df, scaler.fit(df.where("x = 1"))).collect()
    df = spark.createDataFrame([(1.0,), (3.0,), (math.nan,), (None,)], "x double")
    assert sorted(r.x for r in standardize(df, "standard").collect() if r.x is not None) == [-1, 1]


@pytest.mark.parametrize("wide", [60, 0])
@pytest.mark.parametrize("method", ["standard", "min_max", "max_abs", "robust"])
def test_column_without_values_and_empty_table(spark, method, wide):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    assert [r.y for r in standardize(df, method, wide=wide).collect()] == [None, None]
    assert standardize(df.limit(0), method, wide=wide).count() == 0


def test_max_abs_clip_warns():
    with pytest.warns(UserWarning, match="no effect"):
        MaxAbs(clip=True)


@pytest.mark.parametrize(
    ("norm", "first", "third"),
    [("l1", [0.428571, -0.571429, 0], [0.25, 0.25, 0.5]), ("l2", [0.6, -0.8, 0], [0.408248, 0.408248, 0.816497]), ("max", [0.75, -1, 0], [0.5, 0.5, 1])],
)
@pytest.mark.parametrize("wide", [60, 0])
def test_norms(spark, norm, first, third, wide):
    df = spark.createDataFrame([("s1", 3.0, -4.0, 0.0), ("s2", 0.0, 0.0, 0.0), ("s3", 1.0, 1.0, 2.0)], "sample_id string, a double, b double, c double")
    rows = normalize(df, norm, wide=wide).orderBy("sample_id").collect()
    assert list(rows[0])[1:] == pytest.approx(first, abs=1e-6) and list(rows[1])[1:] == [0, 0, 0] and list(rows[2])[1:] == pytest.approx(third, abs=1e-6)
    assert [abs(r.a) for r in normalize(df, norm, ["a"]).collect()] == [1, 0, 1]


@pytest.mark.parametrize("wide", [60, 0])
def test_norms_refuse_missing(spark, wide):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "a double, `norm.x` double")
    with pytest.raises(ValueError, match="norm.x"):
        normalize(df, "l2", check=True, wide=wide)
    with pytest.raises(Exception, match="missing values"):
        normalize(df, "l2", wide=wide).collect()


def test_complete_cases(spark):
    rows = [("s1", 1.0, 1, "A"), ("s2", None, 2, "B"), ("s3", 3.0, None, "A"), ("s4", 4.0, 4, None), (None, 5.0, 5, "B"), ("s6", math.nan, 6, "B")]
    df = spark.createDataFrame(rows, "sample_id string, g1 double, g2 bigint, label string")
    assert [r.sample_id for r in complete_cases(df).collect()] == ["s1"]
    assert complete_cases(complete_cases(df)).count() == 1
    assert complete_cases(df.where("g2 > 1")).columns == df.columns
    assert len(FILTERS) == 11


def test_complete_cases_pushes_down(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus")
    plan = complete_cases(df)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(o_orderkey)" in plan and "Exchange" not in plan


def test_features(spark):
    df = spark.createDataFrame([("s1", 1.0, 2.0, 3.0, "A")], "sample_id string, TP53 double, `HLA.A` double, tp53 double, label string")
    assert select_features(df, ["HLA.A", "TP53", "HLA.A"]).columns == ["HLA.A", "TP53"]
    assert select_features(df, ["HLA.A", "TP53"]).first()[0] == 2.0
    with pytest.raises(ValueError, match="BRCA1, Z"):
        select_features(df, ["BRCA1", "TP53", "Z"])
    with pytest.raises(ValueError):
        select_features(df, [])
    listing = feature_listing(df.columns, ["label", "zzz", "aaa"])
    assert listing.feature_names == ["sample_id", "TP53", "HLA.A", "tp53"] and listing.excluded_columns == ["label"] and listing.missing_excluded_columns == ["aaa", "zzz"] and listing.total_column_count == 5
    assert [r.feature for r in extract_features(df, ["label"]).collect()] == ["sample_id", "TP53", "HLA.A", "tp53"]


def test_names_with_dots_and_case(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 5.0)], "`a.b` double, `A.b` double")
    out = standardize(df, "standard", ["A.b"])
    assert out.columns == ["a.b", "A.b"] and sorted(r[1] for r in out.collect()) == [-1, 1] and sorted(r[0] for r in out.collect()) == [1, 3]


def exact(df, columns, odds, small=None, wide=60):
    rows, found = collected(quantiles(df, columns, odds, wide, small), columns)
    return {c: f["q"] if "q" in f else None for c, f in zip(columns, found, strict=True)}


def plainly(values, p):
    values = sorted(v for v in values if v is not None)
    at = p * (len(values) - 1)
    low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
    return low + (high - low) * (at - int(at))


COLUMNS = {
    "tied_ends": "case when id < 100000 then 0.0D when id < 100010 then id / 1e9 else 1.0D end",
    "spread": "cast(hash(id) as double)",
    "few": "cast(pmod(hash(id), 17) as double)",
    "heavy": "case when id % 3 = 0 then 7.0D else cast(pmod(hash(id), 5000) as double) end",
    "huge_and_tiny": "pow(10.0D, pmod(hash(id), 600) - 300) * if(id % 2 = 0, 1, -1)",
    "gaps": "case when id % 10 = 0 then cast(id as double) end",
    "none": "cast(null as double)",
    "one": "case when id = 77 then 3.5D end",
}


def test_quantiles_by_sketches_are_exact(spark):
    """Beyond what a sketch holds, with ties at the ends of brackets, inside them, and everywhere."""
    df = spark.range(200_010).selectExpr(*[f"{e} as {c}" for c, e in COLUMNS.items()])
    odds = [0.25, 0.500013, 0.9]
    got, plain = exact(df, df.columns, odds, small=False), df.toPandas()
    for c in df.columns:
        values = [v for v in plain[c].tolist() if v == v]
        assert got[c] == (pytest.approx([plainly(values, p) for p in odds], rel=1e-12) if values else None), c


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_quantiles_of_few_rows(spark, n):
    df = spark.range(n).selectExpr("cast(id as double) as x", "cast(null as double) as y")
    odds = [0.1, 0.5, 0.9]
    expected = [plainly(list(range(n)), p) for p in odds] if n else None
    assert exact(df, ["x", "y"], odds, small=False) == {"x": pytest.approx(expected) if n else None, "y": None}
    assert exact(df, ["x", "y"], odds, small=True) == {"x": pytest.approx(expected) if n else None, "y": None}


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan")


def test_quantiles_take_three_scans(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_quantity", "l_extendedprice", "l_discount")
    assert scans(quantiles(df, df.columns, [0.25, 0.5, 0.75], small=True)) == 1
    one = quantiles(df, df.columns, [0.25, 0.5, 0.75], small=False)
    assert scans(one) == 3
    rows, found = collected(one, df.columns)
    assert rows == df.count() and all(f["n"] == rows for f in found)


def test_many_columns_by_sketches(spark, monkeypatch):
    monkeypatch.setattr(stats, "STACKED", 4)
    df = spark.range(3000).selectExpr(*[f"cast(pmod(hash(id, {i}), {10 ** (i % 5 + 1)}) as double) as x{i}" for i in range(9)], "cast(null as double) as x9")
    odds = [0.1, 0.5, 0.9]
    assert exact(df, df.columns, odds, small=False) == {c: q and pytest.approx(q) for c, q in exact(df, df.columns, odds, small=True).items()}


@pytest.mark.parametrize("method", ["standard", "min_max", "max_abs", "robust"])
@pytest.mark.parametrize("flags", [{}, {"wide": 0}])
def test_no_job_before_the_action(spark, method, flags):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_quantity", "l_tax")
    group = f"lazy-{method}-{len(flags)}"
    spark.sparkContext.setJobGroup(group, group)
    out = standardize(df, method, ["l_quantity", "l_tax"], **flags)
    asked = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not asked
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan
    scaler = METHODS[method](["l_quantity", "l_tax"], **flags)
    order = lambda rows: sorted(tuple(round(v, 12) + 0.0 for v in r) for r in rows)
    assert order(out.collect()) == order(scaler.transform(df, scaler.fit(df)).collect())


table = st.lists(st.tuples(st.one_of(st.none(), st.floats(-1e6, 1e6)), st.floats(-1e3, 1e3)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table)
def test_properties(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double").coalesce(1)
    for a, b in zip(standardize(df, "standard").collect(), standardize(df, "standard", wide=0).collect(), strict=True):
        assert (a.x is None) == (b.x is None) and a.y == pytest.approx(b.y, abs=1e-6)
    out = [r for r in standardize(df, "min_max").collect()]
    assert all(-1e-9 <= r.y <= 1 + 1e-9 for r in out)
    assert all(abs(r.y) <= 1 for r in standardize(df, "max_abs").collect())
    stats = column_stats(df, ["x", "y"], {})
    assert stats[""]["rows"] == len(rows) and stats["x"]["n"] == sum(r[0] is not None for r in rows)
    full = complete_cases(df)
    for r in normalize(full, "l2").collect():
        assert math.hypot(r.x, r.y) == pytest.approx(1) or r.x * r.x + r.y * r.y < 1e-20
