import csv
import io
import random

import pandas as pd
import pytest

from tabulaire.sources import read_delimited, read_header, read_table, write_delimited
from tabulaire.sources.delimited import _header, breaks_lines, column_names, infer
from tabulaire.sources.files import copy_object, copy_objects, read_range, read_stream, size_of, write_stream
from tabulaire.sources.records import after_line, block_starts, lines

QUIRKS = {
    "tokens": "a,b,c\n1,NA,x\n2,n/a,null\n3,,Na\n4,<NA>,-\n",
    "duplicates": "a,a,b,a.1,\n1,2,3,4,5\n",
    "short row": "a,b,c\n1,2\n3,4,5\n",
    "blank lines": "a,b\n\n1,2\n\n3,4\n",
    "quoted": 'a,b\n"x, y\nz","say ""hi"""\n1,2\n',
    "dates": "d,t\n2024-01-02,2024-01-02 03:04:05\n2024-02-03,2024-01-02 03:04:06\n",
    "booleans": "a,b\nTrue,True\nFalse,\n",
    "numbers": "a,b,c,d,e\n1,1.5,1e3,-inf,99999999999999999999\n2,2,.5,3,1\n",
    "all missing": "a,b\n1,\n2,\n",
    "leading zeros": "a,b\n007,1.\n010,2\n",
}


@pytest.mark.parametrize("name", QUIRKS)
def test_reads_as_data_frames_do(spark, tmp_path, name):
    path = tmp_path / "t.csv"
    path.write_text(QUIRKS[name])
    expected = pd.read_csv(io.StringIO(QUIRKS[name]))
    got = read_delimited(spark, str(path), preserve_order=True).orderBy("_row").drop("_row")
    assert got.columns == list(expected.columns)
    for column, dtype in expected.dtypes.items():
        kind = dict(got.dtypes)[column]
        if name == "numbers" and column == "e":
            continue  # beyond 64 bits
        assert kind == {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}[str(dtype)], column
    rows = [[None if v is None or (isinstance(v, float) and v != v) else v for v in r] for r in got.collect()]
    wanted = [[None if pd.isna(v) else (str(v) if str(expected.dtypes.iloc[i]) == "object" else v) for i, v in enumerate(r)] for r in expected.itertuples(index=False)]
    if name == "numbers":
        rows, wanted = [r[:4] for r in rows], [r[:4] for r in wanted]
    assert rows == wanted


def test_long_rows_and_odd_files(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="Expected 2 fields"):
        read_delimited(spark, str(path)).collect()
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="No columns"):
        read_delimited(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "head.csv").write_text("a,b\n")
    got = read_delimited(spark, str(tmp_path / "head.csv"))
    assert got.columns == ["a", "b"] and got.count() == 0 and {t for _, t in got.dtypes} == {"string"}
    for odd in ("t.txt", "t"):
        with pytest.raises(ValueError, match="extension"):
            read_header(spark, str(tmp_path / odd))


def test_names():
    assert column_names(["a", "a", "b"]) == ["a", "a.1", "b"]
    assert column_names(["a", "", None, "a.1", "a"]) == ["a", "Unnamed: 1", "Unnamed: 2", "a.1", "a.2"]


@pytest.mark.parametrize("name", ["t.csv", "t.tsv"])
def test_round_trip(spark, tmp_path, name):
    df = spark.createDataFrame([("s1", 1.5, True, 'a "b", c\nd'), (None, None, False, "x\ty"), ("s3", float("nan"), True, "z")], "`id.x` string, v double, flag boolean, note string").coalesce(1)
    path = str(tmp_path / name)
    write_delimited(df, path)
    back = read_table(spark, path)
    assert back.columns == df.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, df.selectExpr("`id.x`", "nanvl(v, null) as v", "flag", "note").collect()))
    pandas = pd.read_csv(path, sep="\t" if name.endswith("tsv") else ",")
    assert list(pandas["v"].isna()) == [False, True, True] and pandas["flag"].dtype == bool
    write_delimited(df.limit(0), path)
    assert read_header(spark, path) == df.columns


def test_parallel_parts_and_parquet(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id * 2 as twice").repartition(4)
    folder = str(tmp_path / "parts.csv")
    write_delimited(df, folder, single=False)
    assert read_table(spark, folder).count() == 100
    (tmp_path / "broken.csv").write_text('a,b\n"x\ny",1\nz,2\n')
    (tmp_path / "whole.csv").write_text('a,b\n"x y",1\n"z ""q""",2\n')
    assert breaks_lines(spark, str(tmp_path / "broken.csv")) and not breaks_lines(spark, str(tmp_path / "whole.csv")) and not breaks_lines(spark, folder)
    assert sorted(r.a for r in read_table(spark, str(tmp_path / "broken.csv")).collect()) == ["x\ny", "z"]
    df.write.parquet(str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path / "t.parquet")).count() == 100


@pytest.fixture
def small_splits(spark):
    """Files are split every few bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


CELLS = ["plain", "", "two\nlines", "\n", 'say ""hi""'.replace('""', '"'), "a,b", "\n\n\nx", '"', "5 in", "tail\r\nend", "é東\n", "'", "long " * 30 + "\n" + "and\n" * 20]


def table_text(rng, rows, separator, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, delimiter=separator, lineterminator=end)
    w.writerow(["id", "head\nline", "note"])
    for i in range(rows):
        w.writerow([i, rng.choice(CELLS), rng.choice(CELLS)])
        if rng.random() < 0.1:
            out.write(end)  # blank lines are skipped
    return out.getvalue()


@pytest.mark.parametrize(("size", "name", "end"), [(40, "t.csv", "\n"), (64, "t.tsv", "\r\n"), (300, "t.csv", "\r\n"), (10_000_000, "t.csv", "\n")])
def test_quoted_line_breaks_are_read_in_parallel(spark, tmp_path, small_splits, size, name, end):
    text = table_text(random.Random(size), 120, "\t" if name.endswith("tsv") else ",", end)
    (tmp_path / name).write_bytes(text.encode())
    expected = pd.read_csv(io.BytesIO(text.encode()), sep="\t" if name.endswith("tsv") else ",", keep_default_na=False, na_values=[""], dtype=str, lineterminator=None)
    small_splits(size)
    got = read_delimited(spark, str(tmp_path / name), preserve_order=True)
    assert got.columns == ["id", "head\nline", "note", "_row"]
    rows = got.orderBy("_row").collect()
    assert [r._row for r in rows] == list(range(len(rows))) and [r.id for r in rows] == list(range(120))
    if size < 10_000:
        assert lines(spark, str(tmp_path / name)).rdd.getNumPartitions() > 10
        assert block_starts(lines(spark, str(tmp_path / name)), "\t" if name.endswith("tsv") else ",")
    # cells as the csv module has them
    plain = list(csv.reader(io.StringIO(text, newline=""), delimiter="\t" if name.endswith("tsv") else ","))
    plain = [r for r in plain[1:] if r]
    assert [(r["head\nline"] or "", r.note or "") for r in rows] == [(a, b) for _, a, b in plain] and len(expected) == 120


def test_quotes_that_open_nothing(spark, tmp_path, small_splits):
    """A quote inside an unquoted field is data, however the file is split."""
    body = "".join(f'{i},5" pipe,"x\ny{i}"\n' for i in range(40))
    (tmp_path / "q.csv").write_text("a,b,c\n" + body)
    small_splits(33)
    rows = read_delimited(spark, str(tmp_path / "q.csv"), multiline=True, preserve_order=True).orderBy("_row").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [(i, '5" pipe', f"x\ny{i}") for i in range(40)]


def test_state_after_a_line():
    for line, outside, inside in (("", False, True), ("a,b", False, True), ('"a', True, False), ('a,"b', True, False), ('a"b,c', False, False), ('"a""', True, False), ('"a"",""b"', False, False), ('a""', False, True), ('x"', False, False), ('"', True, False), ('""', False, True), ('"a",b,"c', True, True)):
        assert (after_line(line, False, ","), after_line(line, True, ",")) == (outside, inside), line


def test_row_numbers_of_many_files(spark, tmp_path, small_splits):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    for k in range(3):
        (folder / f"part-{k}.csv").write_text("n\n" + "".join(f"{100 * k + i}\n" for i in range(30 - 10 * k)))
    small_splits(20)
    rows = read_delimited(spark, str(folder), preserve_order=True).orderBy("_row").collect()
    assert [r.n for r in rows] == [*range(30), *range(100, 120), *range(200, 210)] and [r._row for r in rows] == list(range(60))


@pytest.mark.parametrize("name", ["t.csv", "t.tsv"])
def test_parts_are_written_in_order_and_joined(spark, tmp_path, name):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "concat('x ', id, if(id % 3 = 0, ',', '')) as `a,b`", "if(id % 5 = 0, null, id / 4) as v")
    path = str(tmp_path / name)
    plan = []
    original = type(df.write).csv
    try:
        type(df.write).csv = lambda self, folder, *a, **k: (plan.append(self._df.rdd.getNumPartitions()), original(self, folder, *a, **k))[1]
        write_delimited(df, path)
    finally:
        type(df.write).csv = original
    assert plan == [7], "all tasks write"
    whole = (tmp_path / name).read_bytes()
    write_delimited(df.coalesce(1), str(tmp_path / f"one.{name}"))
    assert whole == (tmp_path / f"one.{name}").read_bytes() and not list(tmp_path.glob("*.parts"))
    write_delimited(df, str(tmp_path / f"folder.{name}"), single=False)
    parts = sorted((tmp_path / f"folder.{name}").glob("part-*"))
    assert len(parts) == 7 and all(p.read_bytes().startswith(_header(df, "," if name == "t.csv" else "\t")) for p in parts)
    head = _header(df, "," if name == "t.csv" else "\t")
    assert head + b"".join(p.read_bytes().removeprefix(head) for p in parts) == whole
    assert [r.id for r in read_delimited(spark, path, preserve_order=True).orderBy("_row").collect()] == list(range(1000))


def test_types_of_many_columns(spark):
    kinds = {"l": ["1", "-2", None], "f": ["1", "2.5", None], "b": ["True", "false", "TRUE"], "s": ["x", "1", None], "n": [None] * 3, "w": ["1", "2", "3"], "g": ["99999999999999999999", "1", "2"], "i": ["inf", "-Infinity", "1"], "m": ["True", None, "False"]}
    df = spark.createDataFrame(list(zip(*kinds.values(), strict=True)), ", ".join(f"{c} string" for c in kinds))
    expected = {"l": "double", "f": "double", "b": "boolean", "s": "string", "n": "double", "w": "bigint", "g": "double", "i": "double", "m": "string"}
    for wide in (60, 2):
        assert {c: t.simpleString() for c, t in infer(df, df.columns, wide).items()} == expected
        assert {t.simpleString() for t in infer(df.limit(0), df.columns, wide).values()} == {"string"}


def test_streams_ranges_and_copies(spark, tmp_path):
    path = str(tmp_path / "blob")
    data = bytes(range(256)) * 5000
    assert write_stream(spark, path, (data[i : i + 1000] for i in range(0, len(data), 1000))) == len(data) == size_of(spark, path)
    assert b"".join(read_stream(spark, path, 77_777)) == data and max(len(c) for c in read_stream(spark, path, 77_777)) == 77_777
    assert read_range(spark, path, 300, 10) == data[300:310] and read_range(spark, path, len(data) - 3, 100) == data[-3:] and read_range(spark, path, len(data) + 5, 9) == b""
    assert copy_object(spark, path, f"{path}2") == len(data) and (tmp_path / "blob2").read_bytes() == data
    assert copy_objects(spark, [(path, f"{path}-{i}") for i in range(12)], 3) == [len(data)] * 12
    with pytest.raises(Exception, match="nowhere"):
        copy_objects(spark, [(path, f"{path}-a"), (str(tmp_path / "nowhere"), f"{path}-b")])

    def broken():
        yield b"half"
        raise RuntimeError("no more")

    with pytest.raises(RuntimeError):
        write_stream(spark, path, broken())
    assert (tmp_path / "blob").read_bytes() == data, "what was there stays until all is written"
