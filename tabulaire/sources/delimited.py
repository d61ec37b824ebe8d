"""CSV and TSV tables, read as data-frame users expect and written with a header.

The header names the columns (repeats become ``a.1``, blanks ``Unnamed: 1``), a
fixed set of tokens means missing, types are inferred over the whole table
(never dates), short rows are filled with missing values and long rows are an
error. Everything is read as text by Spark's own parser with a schema of our
own, in as many tasks as the file has splits; inference is one aggregate.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabulaire.functions.columns import named
from tabulaire.plans.stats import WIDE

from .files import join_parts
from .records import records

#: The extensions and their separators.
SEPARATORS = {".csv": ",", ".tsv": "\t"}
#: The texts that mean a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_MISSING = frozenset(MISSING)
_INTEGER = r"^\s*[+-]?[0-9]{1,19}\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
_TRUE, _FALSE = ("True", "TRUE", "true"), ("False", "FALSE", "false")
_NEVER = "\u0000"  # stands for a null that no file holds, so that empty fields stay texts until we judge them


def extension_of(path: str) -> str:
    name = path.rstrip("/").rpartition("/")[2]
    return "." + name.rpartition(".")[2].lower() if "." in name else ""


def separator_of(path: str) -> str:
    try:
        return SEPARATORS[extension_of(path)]
    except KeyError:
        raise ValueError(f"Unsupported file extension: {extension_of(path) or None}; one of {', '.join(SEPARATORS)} is needed") from None


def column_names(header: Iterable[str | None]) -> list[str]:
    """Names for header cells: blanks by position, repeats numbered, names that are taken passed over."""
    cells = [c if c not in (None, "") else f"Unnamed: {i}" for i, c in enumerate(header)]
    used, seen, out = set(cells), {}, []
    for cell in cells:
        name, n = cell, seen.get(cell, 0)
        if n:
            name = f"{cell}.{n}"
            while name in used:
                n += 1
                name = f"{cell}.{n}"
        seen[cell] = n + 1
        used.add(name)
        out.append(name)
    return out


def _options(separator: str) -> dict[str, object]:
    return {"sep": separator, "quote": '"', "escape": '"', "nullValue": _NEVER, "emptyValue": "", "mode": "PERMISSIVE", "maxColumns": 200_000, "maxCharsPerColumn": -1}


def _reader(spark: SparkSession, separator: str, multiline: bool):
    return spark.read.options(**_options(separator)).option("multiLine", multiline)


def breaks_lines(spark: SparkSession, path: str) -> bool:
    """Whether a record may go on in the next line: some line has an odd number of quotes. Read as plain lines, in parallel."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_header(spark: SparkSession, path: str, multiline: bool = True) -> list[str]:
    """The column names of a file; only its first record is read."""
    first = _reader(spark, separator_of(path), multiline).option("header", False).csv(path).limit(1).collect()
    if not first:
        raise ValueError(f"No columns to parse from file: {path}")
    *cells, last = first[0]
    return column_names([*cells, last and last.removesuffix("\r")])  # of a file whose quotes hold other line ends than its own


def wide_header(spark: SparkSession, path: str) -> list[str]:
    """``read_header`` of a file whose header is one line, however many names it has."""
    separator = separator_of(path)
    head = spark.read.option("lineSep", "\n").text(path).where(F.trim("value") != "").limit(1).collect()
    if not head:
        raise ValueError(f"No columns to parse from file: {path}")
    return column_names(next(csv.reader([head[0].value.removesuffix("\r")], delimiter=separator)))


def _presence(text: Column) -> Column:
    return F.when(text.isin(*MISSING), None).otherwise(text)


def read_delimited(spark: SparkSession, path: str, *, multiline: bool | None = None, types: dict[str, T.DataType] | None = None, preserve_order: bool = False) -> DataFrame:
    """A typed table from CSV or TSV, by the extension of ``path``.

    Files are split over tasks, also where quotes hold line breaks (see
    ``records``): ``multiline`` says that they do, or is found out by a look at the
    lines (None). ``types`` skips inference for the columns it names.
    ``preserve_order`` adds ``_row``, the row's number from 0 in the order of files
    by name and of rows in a file, without gaps.
    """
    separator = separator_of(path)
    multiline = breaks_lines(spark, path) if multiline is None else multiline
    names = read_header(spark, path, multiline)
    slots = [f"c{i}" for i in range(len(names) + 1)]  # one more than the header, to notice long rows
    schema = T.StructType([T.StructField(s, T.StringType()) for s in slots])
    if multiline:
        rows = records(spark, path, separator)
        options = {k: str(v) for k, v in _options(separator).items()}
        raw = rows.select("file", "block", "at", F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("r")).select("file", "block", "at", "r.*")
    else:
        raw = _reader(spark, separator, False).option("header", True).option("enforceSchema", True).schema(schema).csv(path)
        if preserve_order:
            raw = raw.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    said = F.raise_error(F.concat(F.lit(f"Expected {len(names)} fields in a row, saw more: "), F.col(slots[-1])))
    texts = [F.when(F.col(slots[-1]).isNotNull(), said.cast("string")).otherwise(_presence(F.col(s))) for s in slots[:-1]]
    table = raw.select(*[t.alias(n) for t, n in zip(texts, names, strict=True)])
    kinds = dict(types or {})
    kinds |= infer(table, [n for n in names if n not in kinds])
    typed = [as_type(t, kinds[n]).alias(n) for t, n in zip(texts, names, strict=True)]
    return _numbered(raw, typed) if preserve_order else raw.select(*typed)


def _numbered(raw: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns`` of ``raw`` and ``_row``: what blocks (file, block) before a row's own hold, and its place (``at``) in its own.

    Nothing is sorted: blocks are counted in one pass, a row a block comes to the driver, and their running totals go back.
    """
    blocks = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least")).collect()
    totals, before = [], 0
    for b in sorted(blocks, key=lambda b: (b.file, b.block)):
        totals.append((b.file, b.block, before - b.least))
        before += b.n
    offsets = F.broadcast(raw.sparkSession.createDataFrame(totals, "file string, block long, offset long"))
    return raw.join(offsets, ["file", "block"]).select(*columns, (F.col("offset") + F.col("at")).alias("_row"))


def infer(table: DataFrame, columns: list[str], wide: int = WIDE) -> dict[str, T.DataType]:
    """The type of each text column over all its values: long, double, boolean or string.

    Missing values make whole numbers doubles and leave booleans text; a column
    of missing values only is double; without rows every column is text. One scan:
    what a column can still be is narrowed by three tests that are true of all its
    values or not; of more than ``wide`` columns all are stacked, so the
    plan has these tests once however many columns there are.
    """
    if not columns:
        return {}
    every = lambda test: F.coalesce(F.bool_and(test), F.lit(True))
    tests = {
        "n": lambda x: F.count(x),
        "l": lambda x: every(x.rlike(_INTEGER) & F.trim(x).try_cast("bigint").isNotNull()),
        "d": lambda x: every(x.rlike(_NUMBER)),
        "b": lambda x: every(x.isin(*_TRUE, *_FALSE)),
    }
    count = F.count(F.lit(1)).alias("rows")
    if len(columns) > wide:
        stacked = table.select(F.posexplode(F.array(*[named(c) for c in columns])).alias("at", "x"))
        found = {r["at"]: r for r in stacked.groupBy("at").agg(count, *[make(F.col("x")).alias(k) for k, make in tests.items()]).collect()}
        marks = [found[i].asDict() if i in found else {"rows": 0} for i in range(len(columns))]
    else:
        row = table.agg(count, *[make(named(c)).alias(f"{k}{i}") for i, c in enumerate(columns) for k, make in tests.items()]).first()
        marks = [{"rows": row["rows"], **{k: row[f"{k}{i}"] for k in tests}} for i in range(len(columns))]
    return {c: _kind(m) for c, m in zip(columns, marks, strict=True)}


_WHOLE, _FRACTION = re.compile(_INTEGER), re.compile(_NUMBER)


class TypeStates:
    """What each column of a table can still be, narrowed cell by cell: whole number, number, boolean, or else text."""

    def __init__(self, width: int):
        self.rows = 0
        self.n = [0] * width
        self.tests = {k: [True] * width for k in "ldb"}

    def add(self, rows: list[list[str]]) -> None:
        self.rows += len(rows)
        for i, column in enumerate(zip(*rows, strict=True)):
            there = [c for c in column if c not in _MISSING]
            self.n[i] += len(there)
            for k, test in (("l", _is_whole), ("d", _is_number), ("b", _is_boolean)):
                if there and self.tests[k][i]:
                    self.tests[k][i] = test(there)


def _is_whole(cells: list[str]) -> bool:
    try:
        values = list(map(int, cells))
    except ValueError:
        return False
    return -(2**63) <= min(values) and max(values) < 2**63 and all(map(_WHOLE.match, cells))


def _is_number(cells: list[str]) -> bool:
    try:
        list(map(float, cells))
    except ValueError:
        return False
    return all(map(_FRACTION.match, cells))


def _is_boolean(cells: list[str]) -> bool:
    return set(cells) <= {*_TRUE, *_FALSE}


def cells_of(record: str, separator: str, width: int) -> list[str]:
    """A record's fields, short ones filled up; a longer one is an error."""
    cells = next(csv.reader([record], delimiter=separator)) if '"' in record else record.split(separator)
    if len(cells) > width:
        raise ValueError(f"Expected {width} fields in a row, saw more: {len(cells)}")
    return cells + [""] * (width - len(cells))


def infer_wide(spark: SparkSession, path: str, names: list[str]) -> dict[str, T.DataType]:
    """``infer`` of a file of very many columns in one scan, none of them ever a column of Spark's.

    Each task narrows one state a column over its records; the states, a row a
    column and task, are then merged by one grouping.
    """
    separator, width = separator_of(path), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, most = TypeStates(width), max(1, 4_000_000 // width)
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                states.add([cells_of(r, separator, width) for r in batch.column(0).slice(at, most).to_pylist()])
        columns = [pa.array(range(width), pa.int32()), pa.array([states.rows] * width, pa.int64()), pa.array(states.n, pa.int64()), *[pa.array(states.tests[k]) for k in "ldb"]]
        yield pa.record_batch(columns, names=["at", "rows", "n", "l", "d", "b"])

    states = records(spark, path, separator).select("value").mapInArrow(run, "at int, rows long, n long, l boolean, d boolean, b boolean")
    found = {r["at"]: r.asDict() for r in states.groupBy("at").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), *[F.bool_and(k).alias(k) for k in "ldb"]).collect()}
    return {name: _kind(found.get(i, {"rows": 0})) for i, name in enumerate(names)}


def _kind(m: dict) -> T.DataType:
    """The narrowest type that a column's tests leave."""
    full = m["rows"] and m["n"] == m["rows"]
    if not m["rows"]:
        return T.StringType()
    if m["l"] and full:
        return T.LongType()
    if m["d"]:
        return T.DoubleType()
    return T.BooleanType() if m["b"] and full else T.StringType()


def as_type(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(text.isNotNull(), text.isin(*_TRUE))
    if isinstance(kind, T.DoubleType):
        low = F.lower(F.trim(text))
        sign = F.when(low.startswith("-"), float("-inf")).otherwise(float("inf"))
        return F.when(low.rlike("inf"), sign).otherwise(F.when(~low.rlike("inf"), low).cast("double"))
    return text if isinstance(kind, T.StringType) else F.trim(text).cast(kind)


def write_delimited(df: DataFrame, path: str, *, separator: str | None = None, single: bool = True) -> str:
    """Writes ``df`` with a header, missing values empty, replacing what is there; the format is that of ``path``.

    All tasks write. Parts are named in the order of the table's partitions, so
    one after the other they hold the rows as ``df.collect()`` has them; of a table
    that was read from one file and went through no shuffle that is the file's own
    order. ``single`` joins them to one file at ``path`` by the file system;
    otherwise ``path`` is their folder, and each part has the header.
    """
    separator = separator or separator_of(path)
    rows = df.select(*[_shown(f).alias(f.name) for f in df.schema])
    folder = f"{path}.parts" if single else path
    writer = rows.write.mode("overwrite").options(sep=separator, quote='"', escape='"', nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.option("header", not single).csv(folder)
    if single:
        head = _header(df, separator)
        join_parts(df.sparkSession, folder, path, head)
    return path


def _header(df: DataFrame, separator: str) -> bytes:
    """The names as the writer quotes them."""
    quoted = ['"' + c.replace('"', '""') + '"' if not c or c[0] in " \t" or c[-1] in " \t" or any(x in c for x in (separator, '"', "\n", "\r")) else c for c in df.columns]
    return (separator.join(quoted) + "\n").encode()


def _shown(field: T.StructField) -> Column:
    """Booleans as True and False, NaN as missing, all else as Spark writes it."""
    x = named(field.name)
    if isinstance(field.dataType, T.BooleanType):
        return F.when(x, "True").when(~x, "False")
    return F.nanvl(x, F.lit(None).cast(field.dataType)) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else x
