"""Design matrices: projection on named features, and listing of the features of a header."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabulaire.functions.columns import named


#: Fixed value: what the error says of features that are not there.
NOT_FOUND = "The following requested features were not found in the input matrix: {names}"


def select_features(df: DataFrame, features: Iterable[str]) -> DataFrame:
    """The features asked for, each once, in the order they were asked for; raises on names that are not there."""
    wanted = list(dict.fromkeys(features))
    if not wanted:
        raise ValueError("definedFeatures must not be empty")
    there = set(df.columns)
    if absent := [f for f in wanted if f not in there]:
        raise ValueError(NOT_FOUND.format(names=", ".join(absent)))
    return df.select(*[named(f) for f in wanted])


@dataclass(frozen=True)
class FeatureListing:
    feature_names: list[str]
    excluded_columns: list[str]
    missing_excluded_columns: list[str]
    total_column_count: int

    @property
    def feature_count(self) -> int:
        return len(self.feature_names)

    @property
    def excluded_column_count(self) -> int:
        return len(self.excluded_columns)


def feature_listing(columns: Iterable[str], excluded: Iterable[str] = ()) -> FeatureListing:
    """Names not excluded and excluded names that are there, both in table order; those that are not there, sorted."""
    columns, out = list(columns), set(excluded)
    return FeatureListing([c for c in columns if c not in out], [c for c in columns if c in out], sorted(out - set(columns)), len(columns))


def extract_features(df: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Feature names as rows (position, feature); only the schema is looked at."""
    names = feature_listing(df.columns, excluded).feature_names
    return SparkSession.active().createDataFrame(list(enumerate(names)), "position int, feature string")
