"""Operator 12: the cheapest edits that give conversations a legal structure.

Each turn is one macro edit: a run of inserts, then keep, rerole or delete. The
codes of macro edits (``IK``, ``D``, ...) are free of prefixes, so the audits of
all states after the same turn are too, and are ordered by their parents' order
and then by their own last codes. So the dynamic programme holds no strings: a
layer is a cost and a rank a state with parent pointers, and the audit is read
off backwards at the end.

Turns are range-partitioned by conversation and turn, in one shuffle. What lies
within a partition is repaired there. A conversation that goes on beyond it is
cut into blocks of bounded size; what a segment of it does to costs and ranks,
from each state it can begin in, is a small table of four by four, and these
tables are chained. So one conversation may have any share of all turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_arrow, keep, only

KEEP, REROLE, DELETE, INSERT, RAGGED = 0, 1, 2, 5, 5  #: costs; the last is that of a truncated turn that stays
BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 20
RESULTS = 1024  #: conversations in a batch of results
#: The macro edits in the order of their codes (ASCII): inserts, then the turn's own edit.
CODES = tuple(sorted("I" * n + edit for n in range(3) for edit in "DKR"))

# States by the roles so far: none, a system turn, ending in a user's, ending in an assistant's. The first and last may end.
NONE, SYSTEM, USER, ASSISTANT = range(4)
AFTER_INSERT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
TO_CLOSE = {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  #: inserts that end a conversation
NAME = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
BLANKS = " \t\n\x0b\x0c\r"

# A turn's kind: its role's class, and what is wrong with it.
CLASSES = "uas"
DOOMED, TRUNCATED = 4, 8  #: added to 0..2 for a role of ``CLASSES`` and 3 for any other


def kind_of(role: str, doomed: bool, truncated: bool) -> int:
    at = CLASSES.find(role[0]) if role else -1
    return (at if at >= 0 else 3) + DOOMED * doomed + TRUNCATED * truncated


@lru_cache
def moves(kind: int) -> tuple[tuple[int, int, int, int], ...]:
    """What a turn allows: state before, state after, cost, place in ``CODES``."""
    role, out = kind & 3, []
    for p in range(4):
        state, run = p, 0
        while run < 3 and (not run or state != p):
            if kind & DOOMED:
                edits = [("D", state, DELETE)]
            else:
                ragged = RAGGED * bool(kind & TRUNCATED)
                wanted = AFTER_INSERT[state]
                edits = [("D", state, DELETE)]
                if role == wanted - USER:
                    edits.append(("K", wanted, KEEP + ragged))
                else:
                    edits.append(("R", wanted, REROLE + ragged))
                    if role == 2 and state == NONE:
                        edits.append(("K", SYSTEM, KEEP + ragged))
            out += [(p, q, cost + INSERT * run, CODES.index("I" * run + edit)) for edit, q, cost in edits]
            state, run = AFTER_INSERT[state], run + 1
    return tuple(out)


Layer = dict[int, tuple[int, int]]  #: state to cost and rank


def ranked(best: dict[int, tuple]) -> Layer:
    """Costs with ranks among all states, from (cost, order...) of each."""
    order = {q: n for n, q in enumerate(sorted(best, key=lambda q: best[q][1:]))}
    return {q: (best[q][0], order[q]) for q in best}


def forward(kinds: Iterable[int], layer: Layer) -> tuple[Layer, list[dict[int, tuple[int, int]]]]:
    """The last layer, and each turn's parent pointers: state to the state before and the code."""
    parents = []
    for kind in kinds:
        best: dict[int, tuple[int, int, int, int]] = {}
        for p, q, cost, code in moves(kind):
            if p in layer:
                c, r = layer[p]
                if q not in best or (c + cost, r, code) < best[q]:
                    best[q] = (c + cost, r, code, p)
        parents.append({q: (b[3], b[2]) for q, b in best.items()})
        layer = ranked({q: b[:3] for q, b in best.items()})
    return layer, parents


def backward(parents: list[dict[int, tuple[int, int]]], state: int) -> list[int]:
    """The codes that lead to ``state``, in order."""
    out = []
    for step in reversed(parents):
        state, code = step[state]
        out.append(code)
    return out[::-1]


def ending(layer: Layer) -> tuple[int, int]:
    """The best last state and the whole cost."""
    cost, _, state = min((c + INSERT * TO_CLOSE[q], r, q) for q, (c, r) in layer.items())
    return state, cost


def rewritten(codes: list[int], rows: Iterable[tuple[str, str]], state: int) -> tuple[list[tuple[str, str, str]], int]:
    """(edit, role, text) of what stays and is inserted, from ``state`` on; the state after."""
    out = []
    for code, (role, text) in zip(codes, rows, strict=True):
        *inserts, edit = CODES[code]
        for _ in inserts:
            state = AFTER_INSERT[state]
            out.append(("I", NAME[state], ""))
        if edit == "K":
            state = SYSTEM if role[0] == "s" else AFTER_INSERT[state]
            out.append(("K", role, text))
        elif edit == "R":
            state = AFTER_INSERT[state]
            out.append(("R", NAME[state], text))
    return out, state


def closing(state: int) -> list[tuple[str, str, str]]:
    out = []
    for _ in range(TO_CLOSE[state]):
        state = AFTER_INSERT[state]
        out.append(("I", NAME[state], ""))
    return out


def joined(lines: list[tuple[str, str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in lines)


class Block:
    """Turns of one conversation in order, and what counts in them."""

    def __init__(self):
        self.rows: list[tuple[str, str]] = []
        self.chars = self.illegal = self.distinct = 0
        self.first = self.last = self.low = self.high = self.turn = None
        self.opened = None  # the first turn's number, with whether there is one

    def add(self, turn: int | None, role: str, text: str) -> None:
        if self.rows:
            self.illegal += (self.last + role[:1]) not in LEGAL
        else:
            self.first, self.opened = role[:1], turn
        self.last = role[:1]
        if turn is not None:
            self.distinct += self.turn != turn
            self.low, self.high = turn if self.low is None else self.low, turn
        self.turn = turn
        self.rows.append((role, text))
        self.chars += len(role) + len(text)

    def faults(self) -> Iterator[str | None]:
        """The first fault of each turn, of duplicates those within the block."""
        seen = set()
        for role, text in self.rows:
            stripped = text.strip(BLANKS)
            if not stripped:
                yield "blank"
            elif (role, text) in seen:
                yield "duplicate"
            else:
                yield None if stripped[-1] in ".!?" else "truncated"
                seen.add((role, text))

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = {**dict.fromkeys(_COUNTS, pa.int64()), "audit": pa.string(), "repaired_sha256": pa.string()}
_LINES = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
#: What a block adds to its conversation: first and last role initial, first, last, least and greatest turn, distinct turns, illegal pairs.
_STATS = pa.struct([("rows", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("opened", pa.int64()), ("turn", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("distinct", pa.int64()), ("illegal", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64())])
_OPEN = {"part": pa.int32(), "block": pa.int32(), "kinds": pa.binary(), "keys": pa.list_(pa.binary()), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "stats": _STATS}
_FIRST = pa.schema([("conv_id", pa.int64()), *_RESULT.items(), *_OPEN.items(), ("lines", _LINES)])
_STATS_DDL = "struct<rows:long,first:string,last:string,opened:long,turn:long,low:long,high:long,distinct:long,illegal:long,blank:long,duplicate:long,truncated:long>"
_LINES_DDL = "array<struct<edit:string,role:string,text:string>>"
_RESULT_DDL = ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
_FIRST_DDL = f"conv_id long, {_RESULT_DDL}, part int, block int, kinds binary, keys array<binary>, roles array<string>, texts array<string>, stats {_STATS_DDL}, lines {_LINES_DDL}"


def _dicts(lines: list[tuple[str, str, str]]) -> list[dict]:
    return [{"edit": e, "role": r, "text": t} for e, r, t in lines]


def solved(conv_id: int | None, block: Block, whole: bool) -> dict:
    """The result of a conversation that is one block."""
    faults = list(block.faults())
    kinds = [kind_of(role, fault in ("blank", "duplicate"), fault == "truncated") for (role, _), fault in zip(block.rows, faults, strict=True)]
    layer, parents = forward(kinds, {NONE: (0, 0)})
    state, cost = ending(layer)
    codes = backward(parents, state)
    lines, state = rewritten(codes, block.rows, NONE)
    lines += closing(state)
    return {
        "conv_id": conv_id, "gaps": block.gaps, "illegal": block.illegal, "cost": cost, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "audit": "".join(CODES[c] for c in codes) + "I" * TO_CLOSE[state], "repaired_sha256": hashlib.sha256(joined(lines).encode()).hexdigest(), "lines": _dicts(lines) if whole else None,
    }


def opened(conv_id: int | None, block: Block, part: int, number: int) -> dict:
    """A block of a conversation that may go on elsewhere: kinds as far as they are known, and keys of the turns whose first like ones are to be found."""
    kinds, keys, n = [], [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for (role, text), fault in zip(block.rows, block.faults(), strict=True):
        kinds.append(kind_of(role, fault in ("blank", "duplicate"), fault == "truncated"))
        known = fault in ("blank", "duplicate")
        keys.append(None if known else hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest())
        if fault:
            n[fault] += 1
    stats = {"rows": len(block.rows), "first": block.first, "last": block.last, "opened": block.opened, "turn": block.turn, "low": block.low, "high": block.high, "distinct": block.distinct, "illegal": block.illegal, **n}
    return {"conv_id": conv_id, "part": part, "block": number, "kinds": bytes(kinds), "keys": keys, "roles": [r for r, _ in block.rows], "texts": [t for _, t in block.rows], "stats": stats}


def _first_pass(whole: bool, rows: int, chars: int):
    """Sorted turns to results of conversations that lie within the partition, and blocks (numbered in the partition) of those that may not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out = TaskContext.get().partitionId(), []
        conv, block, number, within, cut = None, None, 0, False, False
        for batch in batches:
            for conv_id, turn, role, text, dropped in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped")), strict=True):
                if block is None or conv_id != conv:
                    if block is not None:
                        # neither the partition's first conversation nor cut into blocks: all of it is here
                        if within and not cut:
                            out.append(solved(conv, block, whole))
                        else:
                            out.append(opened(conv, block, part, number))
                            number += 1
                        within, cut = True, False
                    conv, block = conv_id, Block()
                if not dropped:
                    if len(block.rows) >= rows or block.rows and block.chars + len(text) > chars:
                        yield pa.RecordBatch.from_pylist([opened(conv, block, part, number)], schema=_FIRST)
                        block, number, cut = Block(), number + 1, True
                    block.add(turn, role, text)
                if len(out) >= RESULTS:
                    yield pa.RecordBatch.from_pylist(out, schema=_FIRST)
                    out = []
        if block is not None:
            out.append(opened(conv, block, part, number))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_FIRST)

    return run


def _mapped(df: DataFrame, make, schema: str, kinds: pa.Schema) -> DataFrame:
    """``make`` of each row, a list of new rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                if made := make(batch.slice(row, 1).to_pylist()[0]):
                    yield pa.RecordBatch.from_pylist(made, schema=kinds)

    return df.mapInArrow(run, schema)


def _added(total: dict | None, more: dict) -> dict:
    """What two runs of turns that follow each other add up to."""
    if total is None or not total["rows"]:
        return dict(more) if total is None or more["rows"] else total
    if not more["rows"]:
        return total
    both = {k: total[k] + more[k] for k in ("rows", "distinct", "illegal", "blank", "duplicate", "truncated")}
    both["illegal"] += total["last"] + more["first"] not in LEGAL
    both["distinct"] -= total["turn"] is not None and total["turn"] == more["opened"]
    return both | {"first": total["first"], "opened": total["opened"], "last": more["last"], "turn": more["turn"], "low": more["low"] if total["low"] is None else total["low"], "high": total["high"] if more["high"] is None else more["high"]}


_SEGMENT = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("blocks", pa.list_(pa.struct([("block", pa.int32()), ("kinds", pa.binary())]))), ("stats", _STATS), ("table", pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())])))])
_SEGMENT_DDL = f"conv string, part int, blocks array<struct<block:int,kinds:binary>>, stats {_STATS_DDL}, table array<struct<before:int,after:int,cost:long,rank:int>>"


def _segment(row: dict) -> list[dict]:
    """Blocks of one conversation and partition, with duplicates known, to what they do to costs and ranks."""
    stats, blocks = None, []
    for b in row["blocks"]:
        kinds, own = bytearray(b["kinds"]), dict(b["stats"])
        firsts = set(b["firsts"] or ())
        for i, sought in enumerate(b["sought"]):
            if sought and i not in firsts:
                own["duplicate"] += 1
                own["truncated"] -= bool(kinds[i] & TRUNCATED)
                kinds[i] = kinds[i] & 3 | DOOMED
        blocks.append({"block": b["block"], "kinds": bytes(kinds)})
        stats = _added(stats, own)
    table = []
    for p in range(4):
        layer, _ = forward((k for b in blocks for k in b["kinds"]), {p: (0, 0)})
        table += [{"before": p, "after": q, "cost": c, "rank": r} for q, (c, r) in layer.items()]
    return [{"conv": row["conv"], "part": row["part"], "blocks": blocks, "stats": stats, "table": table}]


_CHAIN = pa.schema([("conv_id", pa.int64()), ("conv", pa.string()), *[(c, pa.int64()) for c in _COUNTS], ("last", pa.int32()), ("path", pa.list_(pa.struct([("part", pa.int32()), ("before", pa.int32()), ("after", pa.int32())])))])
_CHAIN_DDL = f"conv_id long, conv string, {', '.join(f'{c} long' for c in _COUNTS)}, last int, path array<struct<part:int,before:int,after:int>>"


def _chain(row: dict) -> list[dict]:
    """A conversation's segments in order, a small table each, to the states in which the best edits pass from one to the next."""
    layer, steps, stats = {NONE: (0, 0)}, [], None
    for segment in row["segments"]:
        best: dict[int, tuple] = {}
        for m in segment["table"]:
            if m["before"] in layer:
                c, r = layer[m["before"]]
                found = (c + m["cost"], r, m["rank"], m["before"])
                if m["after"] not in best or found < best[m["after"]]:
                    best[m["after"]] = found
        steps.append((segment["part"], {q: b[3] for q, b in best.items()}))
        layer = ranked({q: b[:3] for q, b in best.items()})
        stats = _added(stats, segment["stats"])
    last, cost = ending(layer)
    state, path = last, []
    for part, before in reversed(steps):
        path.append({"part": part, "before": before[state], "after": state})
        state = before[state]
    gaps = 0 if stats["low"] is None else stats["high"] - stats["low"] + 1 - stats["distinct"]
    return [{"conv_id": int(row["conv"]) if row["conv"] else None, "conv": row["conv"], "gaps": gaps, "cost": cost, "last": last, "path": path, **{k: stats[k] for k in ("blank", "duplicate", "truncated", "illegal")}}]


_EDITS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int32()), ("codes", pa.binary())])


def _edits(row: dict) -> list[dict]:
    """The codes of each block of a segment whose states at both ends are known."""
    kinds = [k for b in row["blocks"] for k in b["kinds"]]
    _, parents = forward(kinds, {row["before"]: (0, 0)})
    codes = backward(parents, row["after"])
    out, at, state = [], 0, row["before"]
    for b in row["blocks"]:
        own = codes[at : at + len(b["kinds"])]
        out.append({"part": row["part"], "block": b["block"], "before": state, "codes": bytes(own)})
        for i, code in enumerate(own):
            *inserts, edit = CODES[code]
            for _ in inserts:
                state = AFTER_INSERT[state]
            if edit == "K" and kinds[at + i] & 3 == 2:
                state = SYSTEM
            elif edit != "D":
                state = AFTER_INSERT[state]
        at += len(own)
    return out


_PIECE = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("audit", pa.string()), ("repaired", pa.string()), ("lines", _LINES)])
_PIECE_DDL = f"conv string, part int, block int, audit string, repaired string, lines {_LINES_DDL}"
_END = (1 << 31) - 1  #: stands for the part after the last


def _piece(whole: bool):
    def piece(row: dict) -> list[dict]:
        codes = list(row["codes"])
        lines, _ = rewritten(codes, zip(row["roles"], row["texts"], strict=True), row["before"])
        return [{"conv": row["conv"], "part": row["part"], "block": row["block"], "audit": "".join(CODES[c] for c in codes), "repaired": joined(lines) if lines else None, "lines": _dicts(lines) if whole else None}]

    return piece


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, each conversation's followed by its own row of totals, to results; texts go through the digest and are let go."""
    sha, any_, audit = hashlib.sha256(), False, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            text = row["repaired"]
            if row["part"] == _END:
                lines = closing(row["last"])
                text = joined(lines) if lines else None
                audit.append("I" * len(lines))
            else:
                audit.append(row["audit"])
            if text is not None:
                sha.update((("\n" if any_ else "") + text).encode())
                any_ = True
            if row["part"] == _END:
                yield pa.RecordBatch.from_pylist([{"conv_id": row["conv_id"], **{c: row[c] for c in _COUNTS}, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], schema=pa.schema([("conv_id", pa.int64()), *_RESULT.items()]))
                sha, any_, audit = hashlib.sha256(), False, []


def ordered(turns: DataFrame) -> DataFrame:
    """Turns in ranges of (conv_id, turn), in order: nulls first, ties by the beginnings of role and text and a hash of both.

    Equal rows may be in different ranges, so no key is too frequent for one.
    """
    order: list[Column] = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), F.substring("text", 1, 64), F.xxhash64("role", "text"), F.col("_row")]
    rows = turns.withColumn("_row", F.monotonically_increasing_id())
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")


def prepared(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) with a blank for a null role or text."""
    rows = only(turns, conv_id="conv_id", turn="turn", role="role", text="text", **({"dropped": "dropped"} if "dropped" in turns.columns else {}))
    rows = rows if "dropped" in rows.columns else rows.withColumn("dropped", F.lit(False))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce("dropped", F.lit(False)).alias("dropped"))


def damage(turns: DataFrame) -> DataFrame:
    """Faults put in by crc32 of ``conv_id:turn`` modulo 20: 0 drops a turn, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it the user's.

    Nulls are blanks. A dropped turn stays as a row whose ``dropped`` is true, for its conversation's sake.
    """
    rows = prepared(only(turns, conv_id="conv_id", turn="turn", role="role", text="text"))
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("fault", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20)
    f = F.col("fault")
    text = F.when(f.isin(0, 1), "").when(f == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(f == 0, "").when(f == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (f == 0).alias("dropped"), F.explode(F.when(f == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def _passes(turns: DataFrame, whole: bool, rows: int, chars: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What the first pass wrote, the chains of conversations that go on over blocks, and the pieces of these."""
    bounded_arrow(turns.sparkSession)
    first = keep(ordered(prepared(turns)).mapInArrow(_first_pass(whole, rows, chars), _FIRST_DDL), "conversations")
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    blocks = first.where("part is not null")
    keys = blocks.select(conv, "part", "block", F.posexplode("keys").alias("at", "key")).where("key is not null")
    firsts = keys.groupBy("conv", "key").agg(F.min(F.struct("part", "block", "at")).alias("f")).select("f.*").groupBy("part", "block").agg(F.collect_list("at").alias("firsts"))
    sought = F.transform("keys", lambda k: k.isNotNull())
    small = blocks.select(conv, "part", "block", "kinds", "stats", sought.alias("sought")).join(firsts, ["part", "block"], "left")
    runs = small.groupBy("conv", "part").agg(F.array_sort(F.collect_list(F.struct("block", "kinds", "sought", "firsts", "stats"))).alias("blocks"))
    segments = keep(_mapped(runs, _segment, _SEGMENT_DDL, _SEGMENT), "segments")
    lists = segments.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "stats", "table"))).alias("segments"))
    chains = keep(_mapped(lists, _chain, _CHAIN_DDL, _CHAIN), "chains")
    path = chains.select("conv", F.explode("path").alias("p")).select("conv", "p.*")
    edits = _mapped(segments.select("conv", "part", "blocks").join(path, ["conv", "part"]), _edits, "part int, block int, before int, codes binary", _EDITS)
    pieces = _mapped(blocks.select(conv, "part", "block", "roles", "texts").join(edits, ["part", "block"]), _piece(whole), _PIECE_DDL, _PIECE)
    return first, chains, pieces, blocks


def repair(turns: DataFrame, rows: int = BLOCK_ROWS, chars: int = BLOCK_CHARS) -> DataFrame:
    """Per conversation of ``turns`` (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are taken by number, null ones first; ties by role and text (their
    first 64 characters, then a hash), so that repeated rows stand together, and
    all but the first of them are duplicates. A null role or text is one blank; a
    null conv_id is a conversation of its own; a role of another initial than
    u, a or s can only be changed or deleted. Rows whose ``dropped``
    is true (see ``damage``) only name their conversation; one without other
    rows has zeros, no audit and the digest of an empty text. An empty table
    gives an empty result; other columns are ignored. ``rows`` and ``chars`` bound
    a block. A conversation's audit and digest are put together in one task, which
    reads its blocks one after the other: a digest has no other way.
    """
    first, chains, pieces, _ = _passes(turns, False, rows, chars)
    totals = chains.select("conv", F.lit(_END).alias("part"), F.lit(0).alias("block"), "conv_id", *_COUNTS, "last")
    stream = pieces.drop("lines").unionByName(totals, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "part", "block")
    rest = stream.mapInArrow(_digests, f"conv_id long, {_RESULT_DDL}")
    return first.where("part is null").select("conv_id", *_RESULT).unionByName(rest)


def repaired_turns(turns: DataFrame, rows: int = BLOCK_ROWS, chars: int = BLOCK_CHARS) -> DataFrame:
    """The repaired conversations themselves: conv_id, part, block, at (in this order), edit (K, R or I), role, text."""
    first, chains, pieces, _ = _passes(turns, True, rows, chars)
    line = lambda df: df.select("conv_id", "part", "block", F.posexplode("lines").alias("at", "l")).select("conv_id", "part", "block", "at", "l.*")
    conv_id = F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id")
    ends = {s: [{"edit": e, "role": r, "text": t} for e, r, t in closing(s)] for s in (SYSTEM, USER)}
    made = lambda s: F.array(*[F.struct(*[F.lit(line[k]).alias(k) for k in ("edit", "role", "text")]) for line in ends[s]])
    last = chains.where(F.col("last").isin(SYSTEM, USER)).select("conv_id", F.lit(_END).alias("part"), F.lit(0).alias("block"), F.when(F.col("last") == SYSTEM, made(SYSTEM)).otherwise(made(USER)).alias("lines"))
    solved_ = first.where("part is null").select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("block"), "lines")
    return line(solved_).unionByName(line(pieces.select(conv_id, "part", "block", "lines"))).unionByName(line(last))


def sql() -> str:
    """DuckDB SQL for ``repair(damage(conversations))``; its dynamic programme holds whole strings."""
    values = []
    for kind in [c + f for f in (0, DOOMED, TRUNCATED) for c in range(4)]:
        for p, q, cost, code in moves(kind):
            *inserts, edit = CODES[code]
            state, roles = p, []
            for _ in inserts:
                state = AFTER_INSERT[state]
                roles.append(f"'{NAME[state]}:'")
            values.append(f"({kind}, {p}, {q}, {cost}, '{CODES[code]}', [{', '.join(roles)}]::VARCHAR[], '{edit}', '{NAME.get(q, '')}')")
    ends = ", ".join(f"({q}, {n * INSERT}, '{'I' * n}', {[f'{r}:' for _, r, _ in closing(q)]}::VARCHAR[])" for q, n in TO_CLOSE.items())
    return f"""
WITH RECURSIVE bytes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, _: xor(c >> 1, 3988292384 * (c & 1)), i)) AS crc),
faulted AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda c, b: xor(crc[1 + (xor(c, b) & 255)], c >> 8), 4294967295), 4294967295) % 20 AS fault
  FROM conversations, bytes),
turned AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM faulted, range(2) AS twice(n) WHERE fault <> 0 AND (n = 0 OR fault = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM turned),
judged AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate, bare <> '' AND right(bare, 1) NOT IN ('.', '!', '?') AS ragged,
    role[1:1] AS r, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair FROM numbered),
kinds AS (SELECT *, CASE r WHEN 'u' THEN 0 WHEN 'a' THEN 1 WHEN 's' THEN 2 ELSE 3 END + CASE WHEN blank OR duplicate THEN {DOOMED} WHEN ragged THEN {TRUNCATED} ELSE 0 END AS kind FROM judged),
moves(kind, p, q, cost, code, inserted, edit, name) AS (VALUES {", ".join(values)}),
layers(conv_id, i, q, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', []::VARCHAR[] FROM conversations
  UNION ALL
  SELECT * FROM (
    SELECT l.conv_id, k.i, m.q, l.cost + m.cost AS cost, l.audit || m.code AS audit,
      list_concat(list_concat(l.lines, m.inserted), CASE m.edit WHEN 'K' THEN [k.role || ':' || k.text] WHEN 'R' THEN [m.name || ':' || k.text] ELSE []::VARCHAR[] END)
    FROM layers l JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM l.conv_id AND k.i = l.i + 1 JOIN moves m ON m.kind = k.kind AND m.p = l.q
    QUALIFY row_number() OVER (PARTITION BY l.conv_id, m.q ORDER BY l.cost + m.cost, l.audit || m.code) = 1)),
ends(q, cost, code, inserted) AS (VALUES {ends}),
totals AS (
  SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(ragged AND NOT duplicate) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM kinds GROUP BY conv_id),
best AS (
  SELECT l.conv_id, CAST(l.cost + e.cost AS BIGINT) AS cost, l.audit || e.code AS audit, sha256(array_to_string(list_concat(l.lines, e.inserted), chr(10))) AS repaired_sha256
  FROM layers l JOIN ends e ON e.q = l.q LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM l.conv_id WHERE l.i = coalesce(t.n, 0)
  QUALIFY row_number() OVER (PARTITION BY l.conv_id ORDER BY l.cost + e.cost, l.audit || e.code) = 1)
SELECT b.conv_id, {", ".join(f"CAST(coalesce(t.{c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))}, b.cost, b.audit, b.repaired_sha256
FROM best b LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM b.conv_id"""
