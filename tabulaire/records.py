"""Checked records that JSON objects turn into and back: dataclasses whose values are converted to their types.

Every name is camelCase in JSON and snake_case in Python; unknown names are an
error. The same types give the Spark schema of a record.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import datetime
from types import NoneType, UnionType
from typing import Any, Self, Union, get_args, get_origin, get_type_hints

from pyspark.sql import types as T


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", lambda m: "_" + m[1].lower(), name)


def camel(name: str) -> str:
    return re.sub(r"_([a-z0-9])", lambda m: m[1].upper(), name)


def _options(kind: Any) -> tuple[list[Any], bool]:
    """The types of a union but None, and whether None is one."""
    if get_origin(kind) not in (Union, UnionType):
        return [kind], kind is NoneType
    return [k for k in get_args(kind) if k is not NoneType], NoneType in get_args(kind)


def converted(kind: Any, value: Any, name: str) -> Any:
    """``value`` as ``kind``; ValueError, naming the field, if it is none."""
    options, empty = _options(kind)
    if kind is Any or (value is None and empty):
        return value
    if len(options) > 1:
        for option in options:
            try:
                return converted(option, value, name)
            except ValueError:
                continue
        raise ValueError(f"{camel(name)}: {value!r} is none of its types")
    (only,) = options
    wrong = ValueError(f"{camel(name)}: {value!r} is not of type {getattr(only, '__name__', only)}")
    origin, inner = get_origin(only), get_args(only)
    if origin in (list, tuple):
        if not isinstance(value, (list, tuple)) or (origin is tuple and len(value) != len(inner)):
            raise wrong
        return origin(converted(k, v, name) for k, v in zip(inner if origin is tuple else inner * len(value), value, strict=True))
    if origin is dict or only is dict:
        if not isinstance(value, Mapping):
            raise wrong
        return dict(value)
    if isinstance(only, type) and issubclass(only, Record):
        if isinstance(value, Mapping):
            return only.of(value)
    elif only is datetime and isinstance(value, str):
        return datetime.fromisoformat(value)
    elif only is bool:
        value = {"true": True, "false": False}.get(value, value) if isinstance(value, str) else value
    elif only in (int, float) and not isinstance(value, bool):
        try:
            number = only(value)
        except (TypeError, ValueError):
            raise wrong from None
        if only is int and isinstance(value, float) and number != value:
            raise wrong
        return number
    if not isinstance(value, only) or (isinstance(value, bool) and only is not bool):
        raise wrong
    return value


def _plain(value: Any) -> Any:
    if isinstance(value, Record):
        return value.to_json()
    if isinstance(value, datetime):
        return value.isoformat()
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value


@dataclass
class Record:
    @classmethod
    def kinds(cls) -> dict[str, Any]:
        hints = get_type_hints(cls)
        return {f.name: hints[f.name] for f in fields(cls)}

    @classmethod
    def of(cls, given: Mapping[str, Any]) -> Self:
        """From a JSON object, nested ones too; names in either form, unknown and missing ones and wrong types are a ValueError."""
        kinds = cls.kinds()
        if odd := sorted(k for k in given if snake(k) not in kinds):
            raise ValueError(f"unknown fields: {odd}")
        try:
            return cls(**{snake(k): converted(kinds[snake(k)], v, snake(k)) for k, v in given.items()})
        except TypeError as e:
            raise ValueError(f"{cls.__name__}: {e}") from None

    def to_json(self) -> dict[str, Any]:
        return {camel(f.name): _plain(getattr(self, f.name)) for f in fields(self)}

    @classmethod
    def schema(cls) -> T.StructType:
        return T.StructType([T.StructField(name, spark_type(kind)) for name, kind in cls.kinds().items()])

    def row(self) -> tuple:
        """The values of ``schema``."""
        return tuple(_cell(kind, getattr(self, name)) for name, kind in self.kinds().items())


def spark_type(kind: Any) -> T.DataType:
    """The Spark type of a field; of a number or a list of numbers, a list."""
    options, _ = _options(kind)
    kind = next((k for k in options if get_origin(k) is list), options[0] if options else str)
    if get_origin(kind) in (list, tuple):
        return T.ArrayType(spark_type(get_args(kind)[0]))
    if isinstance(kind, type) and issubclass(kind, Record):
        return kind.schema()
    if get_origin(kind) is dict or kind is dict:
        return T.MapType(T.StringType(), T.StringType())
    return {int: T.LongType(), float: T.DoubleType(), bool: T.BooleanType(), datetime: T.TimestampType()}.get(kind, T.StringType())


def _cell(kind: Any, value: Any) -> Any:
    if value is None:
        return None
    if isinstance(value, Record):
        return value.row()
    wanted = spark_type(kind)
    if isinstance(wanted, T.ArrayType):
        inner = get_args(next((k for k in _options(kind)[0] if get_origin(k) in (list, tuple)), list[str]))[0]
        return [_cell(inner, v) for v in (value if isinstance(value, (list, tuple)) else [value])]
    if isinstance(wanted, T.MapType):
        return {str(k): None if v is None else str(v) for k, v in value.items()}
    return float(value) if isinstance(wanted, T.DoubleType) else str(value) if isinstance(wanted, T.StringType) else value
