"""Records of delimited text whose quotes may hold line breaks, read in parallel.

A file is split anywhere between lines. Whether a split begins inside quotes
follows from what all splits before it do to that state, and for one split
that is a function of two values: where it ends if it begins outside, and where
if it begins inside. So one pass finds these functions (from the lines with
quotes alone), their composition along each file gives every split's start, and
a second pass joins lines to records. Only records that cross a split are put
together by a grouping; fields are left to Spark's own parser.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of a file or folder in order within each block, a split of the file by its first byte.

    Lines end with a line feed; a carriage return before it belongs to the line, for inside quotes it is data.
    """
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def after_line(line: str, inside: bool, separator: str) -> bool:
    """Whether a field's quotes are still open at the end of a line that begins inside such quotes or not.

    Quotes open a field only as its first character, and a pair of them inside stands for one.
    """
    at, end = 0, len(line)
    while True:
        if not inside:
            if at < end and line[at] == '"':
                inside, at = True, at + 1
            else:
                at = line.find(separator, at) + 1
                if not at:
                    return False
                continue
        at = line.find('"', at) + 1
        if not at:
            return True
        if at < end and line[at] == '"':
            at += 1
            continue
        inside, at = False, line.find(separator, at) + 1
        if not at:
            return False


@dataclass
class _Run:
    """What a run of lines does: for each state it may begin in, the state after it, and whether a record that began in it is open then."""

    state: list[bool]
    began: list[bool]


def _effects(separator: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[tuple[str, int], _Run] = {}
        for batch in batches:
            for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
                r = runs.setdefault((file, block), _Run([False, True], [False, False]))
                for start in (0, 1):
                    outside = not r.state[start]
                    r.state[start] = after_line(line, r.state[start], separator)
                    r.began[start] = r.state[start] and (outside or r.began[start])
        if runs:
            rows = [(f, b, *r.state, *r.began) for (f, b), r in runs.items()]
            yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "block", "out", "inn", "began_out", "began_inn"])

    return run


def block_starts(text: DataFrame, separator: str) -> dict[tuple[str, int], int]:
    """The blocks (file, first byte) that begin inside quotes, and the block in which the record that they begin in began.

    One row a block comes to the driver: some bytes for each 128 MB of text.
    """
    quoted = text.where(F.col("value").contains('"'))
    effects = {(r.file, r.block): r for r in quoted.mapInArrow(_effects(separator), "file string, block long, out boolean, inn boolean, began_out boolean, began_inn boolean").collect()}
    if not any(r.out for r in effects.values()):
        return {}  # every file begins outside quotes, and no block leaves them open
    starts, file, inside, owner = {}, None, False, 0
    for r in sorted(text.select("file", "block").distinct().collect()):
        if r.file != file:
            file, inside = r.file, False
        if inside:
            starts[r.file, r.block] = owner
        if run := effects.get((r.file, r.block)):
            if run.began_inn if inside else run.began_out:
                owner = r.block
            inside = run.inn if inside else run.out
    return starts


def _joined(separator: str, starts):
    """Lines to records (file, block, part, at, value, open, head).

    ``at`` numbers a block's records, ``head`` marks a file's first one, which is
    not numbered. A record that crosses blocks is ``open`` pieces, all with the
    block it began in; blank lines outside quotes are left out.
    """
    kinds = {"file": pa.string(), "block": pa.int64(), "part": pa.int64(), "at": pa.int64(), "value": pa.string(), "open": pa.bool_(), "head": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, key, at = starts.value, None, 0
        held: list[str] = []
        inside = lead = headed = False
        rows: list[tuple] = []

        def close(open_: bool) -> None:
            nonlocal at, held, lead, headed
            value = "\n".join(held)
            if held and (open_ or lead or value.strip()):
                head = not headed and not lead
                headed = headed or head
                rows.append((key[0], owners[key] if lead else key[1], key[1], -1 if head or lead else at, value, open_ or lead, head))
                at += not head and not lead
            held, lead = [], False

        def emitted() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))
            rows.clear()
            return made

        for batch in batches:
            for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
                if (file, block) != key:
                    if key is not None:
                        close(inside)
                    key, at = (file, block), 0
                    inside = lead = key in owners
                    headed = block > 0
                held.append(line)
                if '"' in line:
                    inside = after_line(line, inside, separator)
                if not inside:
                    close(False)
            if rows:
                yield emitted()
        if key is not None:
            close(inside)
        if rows:
            yield emitted()

    return run


def records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, at, value): a row a record but each file's first, with its quotes and line breaks, in this order."""
    text = lines(spark, path)
    starts = block_starts(text, separator)
    made = text.mapInArrow(_joined(separator, spark.sparkContext.broadcast(starts)), "file string, block long, part long, at long, value string, open boolean, head boolean")
    if starts:
        # a piece or more in each block that such a record crosses; there is one of them a block at most
        pieces = made.where("open").groupBy("file", "block").agg(F.array_sort(F.collect_list(F.struct("part", "at", "value", "head"))).alias("p"))
        first = F.get("p", F.lit(0))
        crossing = pieces.select("file", "block", first["at"].alias("at"), F.array_join(F.transform("p", lambda p: p["value"]), "\n").alias("value"), first["head"].alias("head"))
        made = made.where("not open").select("file", "block", "at", "value", "head").unionByName(crossing)
    return made.where("not head").select("file", "block", "at", F.regexp_replace("value", "\r$", "").alias("value"))
