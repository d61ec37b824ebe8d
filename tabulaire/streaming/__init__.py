"""Streams: the operators that look at one row at a time run on them as they are.

Row norms, filters and projections need no state. Scalers transform a stream
with what they learned from a table before, and learn from a stream batch by
batch: each batch's state is a part of its own in a folder, so the fit goes on
where it stopped, and a batch that is run again after a failure counts once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tabulaire.operators import complete_cases, normalize, select_features
from tabulaire.operators.scalers import Fitted, Scaler
from tabulaire.plans.state import partial_state, resume, save_part


def scale_stream(stream: DataFrame, scaler: Scaler, fitted: Fitted) -> DataFrame:
    return scaler.transform(stream, fitted)


def fit_stream(stream: DataFrame, folder: str, columns: Iterable[str] | None = None, *, sketch: int | None = None, name: str = "batch") -> DataStreamWriter:
    """A writer whose query adds each batch's state to ``folder``; set a checkpoint and a trigger, and start it.

    ``name`` tells the queries that share a folder apart. ``resume`` of the
    folder is what all batches so far add up to, whenever it is asked for.
    """
    chosen = list(columns) if columns else None

    def add(batch: DataFrame, batch_id: int) -> None:
        save_part(partial_state(batch, chosen, sketch=sketch), folder, f"{name}-{batch_id}")

    return stream.writeStream.foreachBatch(add)


__all__ = ["complete_cases", "fit_stream", "normalize", "resume", "scale_stream", "select_features"]
