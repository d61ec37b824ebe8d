"""Queries over the driver's tables, one or more an operator, each with DuckDB SQL for the same rows.

The tables hold no missing values, so queries that show how these are handled
put them in by a rule that both engines share.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulaire import process_queries
from tabulaire.operators import FILTERS, complete_cases, extract_features, normalize, select_features, standardize

Build = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Query:
    table: str
    build: Build
    sql: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(spark.read.parquet(f"{sf_dir}/{self.table}.parquet"))


LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_linenumber"]
_L2 = f"sqrt({' + '.join(f'{c} * {c}' for c in LINE)})"
#: Points in time are compared as texts, whatever an engine calls their type and whatever the session's time zone.
_TIMES = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}


def _rounded(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    """Results to some decimals, without negative zeros, for comparison between engines."""
    return df.withColumns({c: F.round(c, places) + 0.0 for c in columns})


def _round_sql(expressions: dict[str, str], places: int = 6) -> str:
    return ", ".join(f"round({e}, {places}) + 0.0 AS {name}" for name, e in expressions.items())


def _scaled(table: str, keys: list[str], columns: list[str], method: str, expression: str, before: Build = lambda df: df, source: str | None = None, places: int = 6, **flags) -> Query:
    """A scaler over ``columns``; ``expression`` is its SQL with {x} for the column, over ``source`` (the table by default)."""
    sql = f"SELECT {', '.join(keys)}, {_round_sql({c: expression.format(x=c) for c in columns}, places)} FROM {source or table}"
    return Query(table, lambda df: _rounded(standardize(before(df).select(*keys, *columns), method, columns, **flags), columns, places), sql)


def _whole(table: str, columns: list[str], build: Build, expressions: dict[str, str], source: str | None = None) -> Query:
    """An operator on ``columns`` of a whole table, all other columns passed through; points in time as texts."""
    time = _TIMES.get(table)
    put = [f"{e} AS {c}" for c, e in expressions.items()] + ([f"strftime({time}, '%Y-%m-%d %H:%M:%S.%f') AS {time}"] if time else [])

    def run(df: DataFrame) -> DataFrame:
        out = _rounded(build(df), columns)
        return out.withColumn(time, F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")) if time else out

    return Query(table, run, f"SELECT * REPLACE ({', '.join(put)}) FROM {source or table}")


def _norm(norm: str, columns: list[str], size: str) -> Query:
    sized = f"(SELECT *, {size} AS size FROM lineitem)"
    sql = f"SELECT {', '.join(KEYS)}, {_round_sql({c: f'{c} / CASE WHEN size = 0 THEN 1 ELSE size END' for c in columns})} FROM {sized}"
    return Query("lineitem", lambda df: _rounded(normalize(df.select(*KEYS, *columns), norm, columns), columns), sql)


#: Filter query: its table, and where nulls are put, as column to (key, modulus). Every column of the table counts.
_GAPS: dict[str, tuple[str, dict[str, tuple[str, int]]]] = {
    "retain_complete_samples": ("lineitem", {"l_quantity": ("l_linenumber", 3), "l_returnflag": ("l_orderkey", 7)}),
    "retain_common_samples_across_layers": ("orders", {"o_totalprice": ("o_orderkey", 5), "o_orderstatus": ("o_orderkey", 11)}),
    "assign_class_labels": ("customer", {"c_acctbal": ("c_custkey", 4), "c_mktsegment": ("c_custkey", 9)}),
    "detect_classification_type": ("part", {"p_brand": ("p_partkey", 6), "p_size": ("p_partkey", 5)}),
    "extract_subtype_labels": ("supplier", {"s_name": ("s_suppkey", 3), "s_acctbal": ("s_suppkey", 8)}),
    "annotate": ("events", {"event_type": ("event_id", 10), "value": ("user_id", 7)}),
    "remove_low_variance": ("labels", {"quality": ("doc_id", 5)}),
    "remove_no_signal": ("documents", {"lang": ("doc_id", 4), "n_chars": ("doc_id", 9)}),
    "select_correlation": ("conversations", {"role": ("conv_id", 6), "text": ("turn", 4)}),
    "select_top_features": ("nation", {"n_name": ("n_nationkey", 4)}),
    "data_extraction": ("pages", {"url": ("page_id", 3)}),
}


def _filter(name: str) -> Query:
    table, gaps = _GAPS[name]
    time = _TIMES.get(table)

    def build(df: DataFrame) -> DataFrame:
        new = {c: F.when(F.col(k) % m != 0, F.col(c)) for c, (k, m) in gaps.items()}
        if time:
            new[time] = F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return complete_cases(df.select(*[new.get(c, F.col(c)).alias(c) for c in df.columns]))

    put = [f"CASE WHEN {k} % {m} <> 0 THEN {c} END AS {c}" for c, (k, m) in gaps.items()] + [f"strftime({time}, '%Y-%m-%d %H:%M:%S.%f') AS {time}"] * bool(time)
    return Query(table, build, f"SELECT * FROM (SELECT * REPLACE ({', '.join(put)}) FROM {table}) WHERE COLUMNS(*) IS NOT NULL")


_WITH_GAPS = "(SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity FROM lineitem)"
_ROBUST = "({{x}} - (SELECT quantile_cont({{x}}, 0.5) FROM {t})) / ((SELECT quantile_cont({{x}}, {b}) FROM {t}) - (SELECT quantile_cont({{x}}, {a}) FROM {t}))"
_WIDE = [f"e{i}" for i in range(64)]
_WIDE_SOURCE = "(SELECT vec_id, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)) + " FROM embeddings)"


def _unpacked(df: DataFrame) -> DataFrame:
    return df.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)])


def _standard_sql(x: str = "{x}") -> str:
    return f"({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER ()"


QUERIES: dict[str, Query] = {
    "standard_standardization": _whole("lineitem", LINE, lambda df: standardize(df, "standard", LINE), {c: f"round({_standard_sql().format(x=c)}, 6) + 0.0" for c in LINE}),
    "standard_no_mean": _scaled("lineitem", KEYS, LINE, "standard", "{x} / stddev_pop({x}) OVER ()", with_mean=False),
    "standard_no_std": _scaled("lineitem", KEYS, LINE, "standard", "{x} - avg({x}) OVER ()", places=7, with_std=False),
    "standard_with_missing": _scaled("lineitem", KEYS, ["l_quantity"], "standard", _standard_sql(), lambda df: df.withColumn("l_quantity", F.when(F.col("l_linenumber") != 3, F.col("l_quantity"))), _WITH_GAPS),
    "standard_constant_column": _scaled("nation", ["n_nationkey"], ["k"], "standard", "{x} - 7.0", lambda df: df.withColumn("k", F.lit(7.0)), "(SELECT n_nationkey, CAST(7.0 AS DOUBLE) AS k FROM nation)"),
    "standard_wide_path": _scaled("embeddings", ["vec_id"], _WIDE, "standard", _standard_sql(), _unpacked, _WIDE_SOURCE),
    "min_max_standardization": _scaled("orders", ["o_orderkey"], ["o_totalprice"], "min_max", "({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ())"),
    "min_max_range": _scaled("part", ["p_partkey"], ["p_size", "p_retailprice"], "min_max", "2.0 * ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) - 1.0", feature_range=(-1, 1)),
    "max_abs_standardization": _scaled("customer", ["c_custkey"], ["c_acctbal"], "max_abs", "{x} / max(abs({x})) OVER ()"),
    "robust_standardization": _whole("events", ["value"], lambda df: standardize(df, "robust", ["value"]), {"value": f"round({_ROBUST.format(t='events', a=0.25, b=0.75).format(x='value')}, 6) + 0.0"}),
    "robust_unit_variance": _scaled("events", ["event_id"], ["value"], "robust", "1.3489795003921634 * " + _ROBUST.format(t="events", a=0.25, b=0.75), unit_variance=True),
    "robust_q10_q90": _scaled("orders", ["o_orderkey"], ["o_totalprice"], "robust", _ROBUST.format(t="orders", a=0.1, b=0.9), quantile_range=(10.0, 90.0)),
    "robust_no_center": _scaled("orders", ["o_orderkey"], ["o_totalprice"], "robust", _ROBUST.format(t="orders", a=0.25, b=0.75).replace("({x} - (SELECT quantile_cont({x}, 0.5) FROM orders))", "{x}"), with_centering=False),
    "l1_normalization": _norm("l1", LINE, " + ".join(f"abs({c})" for c in LINE)),
    "l2_normalization": _whole("lineitem", LINE, lambda df: normalize(df, "l2", LINE), {c: f"round({c} / CASE WHEN {_L2} = 0 THEN 1 ELSE {_L2} END, 6) + 0.0" for c in LINE}),
    "max_normalization": _norm("max", LINE, f"greatest({', '.join(f'abs({c})' for c in LINE)})"),
    "l2_zero_row": _norm("l2", ["l_discount", "l_tax"], "sqrt(l_discount * l_discount + l_tax * l_tax)"),
    **{name: _filter(name) for name in FILTERS},
    "defined_feature_matrix": Query("orders", lambda df: select_features(df, ["o_totalprice", "o_orderkey", "o_totalprice"]), "SELECT o_totalprice, o_orderkey FROM orders"),
    "feature_extraction": Query(
        "lineitem",
        lambda df: extract_features(df, ["l_orderkey", "nope"]),
        "SELECT CAST(row_number() OVER () - 1 AS INT) AS position, column_name AS feature FROM (DESCRIBE lineitem) WHERE column_name NOT IN ('l_orderkey', 'nope')",
    ),
}


def _min_max_clip(df: DataFrame) -> DataFrame:
    """Fitted on one part of the table, applied to all of it, clipped to the range."""
    from tabulaire.operators import MinMax

    scaler = MinMax(["p_size", "p_retailprice"], feature_range=(-1, 1), clip=True)
    rows = df.select("p_partkey", "p_size", "p_retailprice")
    return _rounded(scaler.transform(rows, scaler.fit(rows.where("p_size between 10 and 40"))), scaler.columns)


def _clip_sql(x: str) -> str:
    part = "FROM part WHERE p_size BETWEEN 10 AND 40"
    return f"least(greatest(2.0 * ({x} - (SELECT min({x}) {part})) / ((SELECT max({x}) {part}) - (SELECT min({x}) {part})) - 1.0, -1.0), 1.0)"


QUERIES["min_max_range_clip"] = Query("part", _min_max_clip, f"SELECT p_partkey, {_round_sql({c: _clip_sql(c) for c in ('p_size', 'p_retailprice')})} FROM part")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in (QUERIES | process_queries.QUERIES).items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in (QUERIES | process_queries.QUERIES).items()}
