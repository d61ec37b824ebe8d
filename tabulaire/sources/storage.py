"""Artefacts and containers on any file system that Spark reaches."""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Any

from pyspark.sql import SparkSession

from tabulaire.operators.scalers import Fitted, Scaler
from tabulaire.report import StorageLocation

from .artefacts import load_fit, save_fit
from .files import at, read_stream, write_stream


def create_container(spark: SparkSession, path: str) -> bool:
    """Makes a folder; False if it was there."""
    fs, p = at(spark, path)
    return False if fs.exists(p) else bool(fs.mkdirs(p))


def upload(spark: SparkSession, location: StorageLocation | str, data: bytes | Iterable[bytes]) -> int:
    """Writes bytes, or a stream of them, replacing what is there; the containing folder is made first. ``in_background`` does not wait."""
    path = location if isinstance(location, str) else location.path
    create_container(spark, path.rpartition("/")[0])
    return write_stream(spark, path, [data] if isinstance(data, (bytes, bytearray)) else data)


def in_background(work: Callable[..., Any], *arguments: Any) -> Future:
    """``upload`` or ``download`` while the caller goes on; its result is the future's."""
    pool = ThreadPoolExecutor(1)
    future = pool.submit(work, *arguments)
    pool.shutdown(wait=False)
    return future


def download(spark: SparkSession, location: StorageLocation | str, offset: int = 0, length: int | None = None) -> bytes:
    """The bytes of a blob, or a range of them; ``files.read_stream`` gives those of a large one in chunks."""
    path = location if isinstance(location, str) else location.path
    if not path.strip():
        raise ValueError("a name is needed")
    return b"".join(read_stream(spark, path, offset=offset, length=length))


def save_model(spark: SparkSession, root: str, request_id: str, model: Any, kind: str = "svm", model_type: str = "support-vector-machine") -> str:
    """Saves a model below ``experiments`` in ``root``, with its metadata beside it; the path.

    A scaler and its fit (a pair) become ``{request_id}_{kind}_model.fit``, a typed
    table (see ``artefacts``); anything else is pickled to ``..._model.pickle``.
    """
    base = f"{root.rstrip('/')}/experiments/{request_id}_{kind}_model"
    if isinstance(model, tuple) and len(model) == 2 and isinstance(model[0], Scaler) and isinstance(model[1], Fitted):
        path = save_fit(spark, *model, f"{base}.fit")
    else:
        path = f"{base}.pickle"
        upload(spark, path, pickle.dumps(model))
    upload(spark, f"{path}.metadata.json", json.dumps({"request_id": request_id, "model_type": model_type}).encode())
    return path


def model_metadata(spark: SparkSession, path: str) -> dict[str, str]:
    """What ``save_model`` wrote about the model at ``path``."""
    return json.loads(download(spark, f"{path}.metadata.json"))


def load_model(spark: SparkSession, path: str, *, trusted: bool = False) -> Any:
    """What ``save_model`` saved. A pickle runs whatever it holds, so it is loaded only if the caller trusts all who can write there."""
    if path.endswith(".fit"):
        return load_fit(spark, path)
    if not trusted:
        raise ValueError(f"{path} is a pickle: load it with trusted=True if nobody else can write there")
    return pickle.loads(download(spark, path))
