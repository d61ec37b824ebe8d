"""Global per-column statistics as plans of one row, so that they can be collected, or stand in a larger plan as a scalar subquery.

Few columns: one aggregate with several expressions a column. Many columns: the
columns are stacked to (position, value) and grouped, because plans with
thousands of aggregate expressions take longer to compile than to run. Both
are partial aggregates before one small exchange.

Quantiles are exact. Where a table is small enough, its values are held in
one aggregate's buffers. Else three scans find them, whatever the values and
their ties: the first sketches all columns and brackets every rank, the second
counts beside the brackets and sketches what lies strictly between their ends, and
the third gathers what lies strictly between the ends of the brackets of these.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tabulaire.functions.columns import is_infinite, value_of

WIDE = 60  #: more target columns than this are stacked
SMALL_BYTES = 16_000_000  #: a table that Catalyst puts at more bytes than this has its quantiles found by sketches
SKETCH = 16_384  #: the sketches' accuracy parameter
GRID = 2048  #: points at which the second sketch is read
STACKED = 100  #: columns whose sketches one aggregate holds; fewer than would make it sort instead of hash
#: How far from a rank, as a share of the values, its bracket's ends are asked for: three times the sketches'
#: error of one in a hundred (a published formula of the sketch), so a rank is missed once in 10**11 or less.
MARGIN = 3 * 2.296 / SKETCH**0.9723 + 2 / SKETCH

Aggregates = dict[str, Callable[[Column], Column]]


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[value_of(c).alias(f"c{i}") for i, c in enumerate(columns)])


def _stacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(F.posexplode(F.array(*[value_of(c) for c in columns])).alias("at", "x"))


def _in_order(rows: DataFrame, *fields: str) -> DataFrame:
    """Rows (at, rows, fields) as one: rows, and found, the fields of each position in order."""
    listed = F.array_sort(F.collect_list(F.struct("at", *fields)))
    return rows.agg(F.coalesce(F.max("rows"), F.lit(0)).cast("long").alias("rows"), listed.alias("found"))


def summary(df: DataFrame, columns: list[str], aggregates: Aggregates, wide: int = WIDE) -> DataFrame:
    """One row: ``rows``, and ``found``, a struct of n, bad and each aggregate for each column in order; nulls and NaN are skipped.

    ``n`` counts the values that are not null, ``bad`` says whether one is
    infinite. A stacked table without rows has an empty list. Nothing runs yet.
    """
    wanted: Aggregates = {"n": F.count, "bad": lambda x: F.max(is_infinite(x)), **aggregates}
    count = F.count(F.lit(1)).alias("rows")
    if len(columns) > wide:
        grouped = _stacked(df, columns).groupBy("at").agg(count, *[make(F.col("x")).alias(name) for name, make in wanted.items()])
        return _in_order(grouped, *wanted)
    row = _numbers(df, columns).agg(count, *[make(F.col(f"c{i}")).alias(f"{name}_{i}") for i in range(len(columns)) for name, make in wanted.items()])
    return row.select("rows", F.array(*[F.struct(*[F.col(f"{name}_{i}").alias(name) for name in wanted]) for i in range(len(columns))]).alias("found"))


def collected(one: DataFrame, columns: list[str]) -> tuple[int, list[dict]]:
    """The rows and each column's statistics of a ``summary``; raises ValueError on infinite values."""
    row = one.first()
    got = [f.asDict() for f in row["found"]] or [{"n": 0} for _ in columns]
    if infinite := [c for c, f in zip(columns, got, strict=True) if f.get("bad")]:
        raise ValueError(f"Input contains infinity in columns: {infinite}")
    return row["rows"], got


def column_stats(df: DataFrame, columns: list[str], aggregates: Aggregates, wide: int = WIDE) -> dict[str, dict]:
    """``{column: {name: value}}`` of ``summary``, collected; under the key "" the ``rows`` of the table."""
    rows, got = collected(summary(df, columns, aggregates, wide), columns)
    return {"": {"rows": rows}, **{c: dict.fromkeys(aggregates) | f for c, f in zip(columns, got, strict=True)}}


def is_small(df: DataFrame, most: int = SMALL_BYTES) -> bool:
    """Whether Catalyst's own estimate of the table's bytes is small; no job is run to find out."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= most


def quantiles(df: DataFrame, columns: list[str], odds: list[float], wide: int = WIDE, small: bool | None = None) -> DataFrame:
    """A ``summary`` with ``q``, the exact linearly interpolated quantiles of each column, null without values.

    ``small`` says that one aggregate may hold the values; None asks Catalyst.
    """
    if is_small(df) if small is None else small:
        points = F.array(*[F.lit(p) for p in odds])
        return summary(df, columns, {"q": lambda x: F.percentile(x, points)}, wide)
    parts = [_by_sketches(df, columns[at : at + STACKED], odds) for at in range(0, len(columns), STACKED)]
    if len(parts) == 1:
        return parts[0]
    # one row each, put side by side as scalar subqueries of a plan of one row
    whole = [p.select(F.struct("rows", "found")).scalar() for p in parts]
    one = df.sparkSession.range(1).select(*[w.alias(f"p{i}") for i, w in enumerate(whole)])
    return one.select(F.col("p0.rows").alias("rows"), F.concat(*[F.col(f"p{i}.found") for i in range(len(parts))]).alias("found"))


def _beside(df: DataFrame, columns: list[str], one: DataFrame) -> DataFrame:
    """Stacked values with what ``one`` (rows, found) found for their column; found out once, before the scan."""
    known = df.select(F.array(*[value_of(c) for c in columns]).alias("x"), one.select("found").scalar().alias("found"))
    return known.select("found", F.posexplode("x").alias("at", "x")).select("at", "x", F.get("found", F.col("at")).alias("f"))


def _clamped(fraction: float) -> float:
    return min(1.0, max(0.0, fraction))


def _by_sketches(df: DataFrame, columns: list[str], odds: list[float]) -> DataFrame:
    """``quantiles`` in three scans."""
    slots, x, n = range(len(odds)), F.col("x"), F.col("n")
    number = F.count(F.lit(1)).alias("rows")

    # First scan: a bracket of values around the two ranks that each quantile lies between.
    first = _stacked(df, columns).groupBy("at").agg(number, F.count("x").alias("n"), F.max(is_infinite(x)).alias("bad"), F.kll_sketch_agg_double("x", F.lit(SKETCH)).alias("s"))
    read = lambda s, *p: F.kll_sketch_get_quantile_double(s, F.array(*[F.lit(_clamped(v)) for v in p]))
    ends = F.when(n > 0, read("s", 0.0, 1.0, *[p + side * MARGIN for p in odds for side in (-1, 1)]))
    # below that many values the margin is less than a rank, and the bracket is all of them
    few = n * MARGIN < 2
    one = _in_order(first.withColumn("e", ends).select("at", "rows", "n", "bad", *[F.when(few, F.col("e")[j]).otherwise(F.col("e")[2 + 2 * i + j]).alias(f"{k}{i}") for i in slots for j, k in enumerate("ab")]), "n", "bad", "rows", *[f"{k}{i}" for i in slots for k in "ab"])

    # Second scan: exact counts at the ends, and a sketch of the open interval.
    inside = lambda i: (x > F.col(f"f.a{i}")) & (x < F.col(f"f.b{i}"))
    counts = [c for i in slots for c in (F.count_if(x <= F.col(f"f.a{i}")).alias(f"upto{i}"), F.count_if(inside(i)).alias(f"in{i}"), F.kll_sketch_agg_double(F.when(inside(i), x), F.lit(SKETCH)).alias(f"s{i}"))]
    second = _beside(df, columns, one).groupBy("at").agg(F.first("f").alias("f"), *counts).select("at", "f.rows", "f.n", "f.bad", *[f"f.{k}{i}" for i in slots for k in "ab"], *[f"{k}{i}" for i in slots for k in ("upto", "in", "s")])
    # one text instead of thousands of literals, which would take seconds to plan
    grid = F.split(F.lit(",".join(str(i / GRID) for i in range(GRID + 1))), ",").cast("array<double>")
    cuts = []
    for i, p in enumerate(odds):
        lower = F.floor(F.lit(p) * (n - 1))
        a, b, m, upto = F.col(f"a{i}"), F.col(f"b{i}"), F.col(f"in{i}"), F.col(f"upto{i}")
        points = F.when(m > 0, F.kll_sketch_get_quantile_double(f"s{i}", grid))
        narrow = m * MARGIN >= 2
        at = lambda rank, by, m=m, upto=upto: F.least(F.lit(GRID), F.greatest(F.lit(0), (F.floor(((rank - upto) / m + by) * GRID) + int(by > 0)).cast("int")))
        low = F.when((lower < upto) | ~narrow, a).otherwise(F.get(f"g{i}", at(lower, -MARGIN)))
        high = F.when((lower + 1 >= upto + m) | ~narrow, b).otherwise(F.get(f"g{i}", at(lower + 2, MARGIN)))
        # the lower rank may lie at an end and the next one beyond it, so either end stays where its rank is no inner one
        cuts += [points.alias(f"g{i}"), F.when(m > 0, low).otherwise(a).alias(f"a{i}"), F.when(m > 0, high).otherwise(b).alias(f"b{i}")]
    grids = second.select("*", *cuts[::3])
    two = _in_order(grids.select("at", "rows", "n", "bad", *[c for i in slots for c in cuts[3 * i + 1 : 3 * i + 3]]), "n", "bad", "rows", *[f"{k}{i}" for i in slots for k in "ab"])

    # Third scan: counts at the new ends, and the values between them.
    counts = [c for i in slots for c in (F.count_if(x < F.col(f"f.a{i}")).alias(f"below{i}"), F.count_if(x <= F.col(f"f.a{i}")).alias(f"upto{i}"), F.count_if(x == F.col(f"f.b{i}")).alias(f"last{i}"), F.sort_array(F.collect_list(F.when(inside(i), x))).alias(f"v{i}"))]
    third = _beside(df, columns, two).groupBy("at").agg(F.first("f").alias("f"), *counts)
    found = []
    for i, p in enumerate(odds):
        a, b, below, upto, last, inner = F.col(f"f.a{i}"), F.col(f"f.b{i}"), F.col(f"below{i}"), F.col(f"upto{i}"), F.col(f"last{i}"), F.col(f"v{i}")
        size = F.size(inner)
        missed = F.raise_error(F.lit("a sketch missed a rank of a quantile; fit again")).cast("double")

        def value(rank: Column) -> Column:
            return F.when(rank < below, missed).when(rank < upto, a).when(rank < upto + size, F.get(inner, (rank - upto).cast("int"))).when(rank < upto + size + last, b).otherwise(missed)  # noqa: B023

        total = F.col("f.n")
        exact = F.lit(p) * (total - 1)
        lower = F.floor(exact)
        here, there = value(lower), value(F.least(lower + 1, total - 1))
        found.append(F.when(total > 0, here + (there - here) * (exact - lower)))
    return _in_order(third.select("at", F.col("f.rows").alias("rows"), F.col("f.n").alias("n"), F.col("f.bad").alias("bad"), F.when(F.col("f.n") > 0, F.array(*found)).alias("q")), "n", "bad", "q")
