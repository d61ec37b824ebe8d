"""Small helpers of request handling and reports."""

from __future__ import annotations

import re
import tomllib
import uuid
from collections.abc import Mapping
from datetime import UTC, datetime
from functools import lru_cache
from pathlib import Path
from time import perf_counter


def utc_now() -> datetime:
    return datetime.now(UTC)


def elapsed_ms(start: float) -> float:
    """Milliseconds since a ``perf_counter`` reading, to three decimals."""
    return round((perf_counter() - start) * 1000, 3)


def parse_experiment_id(body: Mapping[str, object]) -> str:
    """``experimentId`` as a UUID in its usual form; a new one if it is missing or no UUID."""
    try:
        return str(uuid.UUID(str(body["experimentId"])))
    except (KeyError, ValueError):
        return str(uuid.uuid4())


#: The headers that carry a trace, and the shape of the second one: version, trace, span and flags.
TRACE_HEADERS = ("X-Trace-ID", "traceparent")
_PARENT = re.compile(r"[^-]*-([^-]{32})-[^-]*-[^-]*")


def get_trace_id(headers: Mapping[str, str]) -> str:
    """The trace that a request belongs to; a new one if its headers name none."""
    own, parent = (headers.get(h) or "" for h in TRACE_HEADERS)
    known = _PARENT.fullmatch(parent)
    return own or (known[1] if known else uuid.uuid4().hex)


def to_string_keyed_dict(value: object) -> dict[str, object]:
    """What a JSON object can hold of ``value``: a dict's entries under text keys, nothing of anything else."""
    entries = value.items() if isinstance(value, dict) else ()
    return dict(e for e in entries if isinstance(e[0], str))


@lru_cache
def project_metadata(root: str = ".") -> dict[str, object]:
    """The ``[project]`` table of ``pyproject.toml`` in ``root``; empty if there is none."""
    path = Path(root) / "pyproject.toml"
    return dict(tomllib.loads(path.read_text()).get("project", {})) if path.is_file() else {}


def project_version(root: str = ".") -> str:
    return str(project_metadata(root).get("version", "unknown"))
