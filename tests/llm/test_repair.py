"""Operator 12 against every sequence of edits, against whole strings, and against its SQL."""

import hashlib
import random
import re
import zlib
from itertools import product

import duckdb
import pytest

from tabulaire.llm import repair as own
from tabulaire.llm.repair import damage, repair, repaired_turns

DATA = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
LEGAL = re.compile("(s?(ua)+)?")
INSIDE = re.compile("[^\x20\x09-\x0d]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        found = INSIDE.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def choices(role, text, fault):
    """(letter, role initial that stays, cost, line) of a turn's edits."""
    yield "D", "", 2, None
    if fault not in ("blank", "duplicate"):
        more = 5 if fault == "truncated" else 0
        yield "K", role[:1] or "?", more, f"{role}:{text}"
        for new in ("user", "assistant"):
            yield "R", new[0], 1 + more, f"{new}:{text}"


def every(rows):
    """(cost, audit, repaired) of the best of all edits with up to two inserts before each turn and at the end."""
    runs = [r for n in range(3) for r in product("ua", repeat=n)]
    names = {"u": "user", "a": "assistant"}
    best = None
    for turns in product(*(list(choices(r, t, f)) for (r, t), f in zip(rows, faults(rows), strict=True))):
        for inserts in product(runs, repeat=len(rows) + 1):
            roles = "".join("".join(run) + turn[1] for run, turn in zip(inserts, [*turns, ("", "", 0, None)], strict=True))
            if not LEGAL.fullmatch(roles):
                continue
            cost = sum(t[2] for t in turns) + 5 * sum(map(len, inserts))
            audit = "".join("I" * len(run) + turn[0] for run, turn in zip(inserts, [*turns, ("", "", 0, None)], strict=True))
            if best is None or (cost, audit) < best[:2]:
                lines = [line for run, turn in zip(inserts, [*turns, ("", "", 0, None)], strict=True) for line in [*[f"{names[r]}:" for r in run], turn[3]] if line is not None]
                best = cost, audit, "\n".join(lines)
    return best


def strings(rows):
    """The same by a dynamic programme over whole audits and texts, for conversations of any length."""
    best = {"": (0, "", ())}  # roles so far, cut to what matters
    short = lambda roles: roles if roles in ("", "s") else "su"[: 2 if roles.endswith("u") else 0] or "sua"
    names = {"u": "user", "a": "assistant"}

    for (role, text), fault in zip(rows, faults(rows), strict=True):
        new = {}
        for roles, (cost, audit, lines) in best.items():
            paths = [(roles, cost, audit, lines)]
            for _ in range(2):
                last = paths[-1]
                for r in "ua":
                    if re.fullmatch("s?(ua)*u?", last[0] + r):
                        paths.append((short(last[0] + r), last[1] + 5, last[2] + "I", (*last[3], f"{names[r]}:")))
                        break
            for at, c, a, kept in paths:
                for letter, r, more, line in choices(role, text, fault):
                    after = at + r
                    if r and not re.fullmatch("s?(ua)*u?", after):
                        continue
                    found = (c + more, a + letter, (*kept, line) if line is not None else kept)
                    if short(after) not in new or found[:2] < new[short(after)][:2]:
                        new[short(after)] = found
        best = new
    ends = []
    for roles, (cost, audit, lines) in best.items():
        more = {"": [], "s": ["user:", "assistant:"], "su": ["assistant:"], "sua": []}[roles]
        ends.append((cost + 5 * len(more), audit + "I" * len(more), "\n".join([*lines, *more])))
    return min(ends)


def verdict(turns, best=strings):
    """One conversation's (turn, role, text) rows, in order, to what the operator says of it."""
    rows = [(" " if r is None else r, " " if t is None else t) for _, r, t in turns]
    numbers = [n for n, _, _ in turns if n is not None]
    found = faults(rows)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, text = best(rows)
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    return gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def in_order(turns):
    return sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", r[2] or " "))


TEXTS = ["Yes.", "No!", "Well", "", " \t", "é?", ".", "x . \n"]
ROLES = ["user", "assistant", "system", "tool", "", None]


def test_small_conversations_against_every_edit():
    rng = random.Random(1)
    for _ in range(120):
        turns = [(i, rng.choice(ROLES[:4]) if rng.random() < 0.9 else rng.choice(ROLES), rng.choice(TEXTS)) for i in range(rng.randrange(4))]
        block = own.Block()
        for n, r, t in turns:
            block.add(n, r or " ", t)
        got = own.solved(1, block, True)
        assert tuple(got[c] for c in COLUMNS[1:]) == verdict([(n, r or " ", t) for n, r, t in turns], every) == verdict([(n, r or " ", t) for n, r, t in turns])


def conversations(rng, sizes):
    """{conv_id: (turn, role, text) rows}."""
    return {i: [(rng.choice([None, *range(n + 2)]) if rng.random() < 0.1 else j, rng.choice(ROLES) if rng.random() < 0.5 else "ua"[j % 2].replace("u", "user").replace("a", "assistant"), rng.choice(TEXTS) if rng.random() < 0.5 else f"Text {j}.") for j in range(n)] for i, n in sizes.items()}


SCHEMA = "part int, conv_id long, `a.b` string, text string, turn long, role string, block int, lines string"


def table(spark, given):
    return spark.createDataFrame([(1, i, "b", t, n, r, 2, "l") for i, turns in given.items() for n, r, t in turns], SCHEMA)


@pytest.mark.parametrize(("rows", "partitions"), [(4096, 4), (4096, 1), (3, 4), (1, 7), (50, 3)])
def test_conversations_over_blocks_and_partitions(spark, rows, partitions):
    given = conversations(random.Random(rows), {None: 5, 1: 1, 2: 40, 3: 0, 4: 200, 5: 7, -6: 3, 7: 2, 8: 90, 9: 1})
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = {r.conv_id: tuple(r)[1:] for r in repair(table(spark, given), rows=rows).collect()}
        lines = {}
        for r in sorted(repaired_turns(table(spark, given), rows=rows).collect(), key=lambda r: (r.part, r.block, r["at"])):
            lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    expected = {i: verdict(in_order(turns)) for i, turns in given.items() if turns}
    assert got == expected
    assert {i: hashlib.sha256("\n".join(v).encode()).hexdigest() for i, v in lines.items()} == {i: v[-1] for i, v in expected.items() if v[-1] != hashlib.sha256(b"").hexdigest()}


def test_one_conversation_with_nearly_all_turns(spark):
    rng = random.Random(9)
    given = {1: [(n, "user" if n % 2 else "assistant", rng.choice(["Same.", f"Text {n}.", "Open"])) for n in range(20_000)] + [(None, "user", "Same.")] * 3000, 2: [(0, "user", "Hi."), (1, "assistant", "Ho.")]}
    got = {r.conv_id: tuple(r)[1:] for r in repair(table(spark, given), rows=500).collect()}
    assert got == {i: verdict(in_order(turns)) for i, turns in given.items()}


def damaged(conv_id, turn, role, text):
    key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
    fault = zlib.crc32(key.encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    return [] if fault == 0 else [(turn, role, "")] if fault == 1 else [(turn, role, re.sub("[.!?]", "", text))] if fault == 2 else [(turn, role, text)] * 2 if fault == 3 else [(turn, "user", text)] if fault == 4 else [(turn, role, text)]


def test_damage(spark):
    given = conversations(random.Random(3), {None: 12, **dict.fromkeys(range(60), 6), 99: 1, **dict.fromkeys(range(100, 160), 1)})
    got = {r.conv_id: tuple(r)[1:] for r in repair(damage(table(spark, given))).collect()}
    expected = {i: verdict(in_order([d for n, r, t in turns for d in damaged(i, n, r, t)])) for i, turns in given.items()}
    assert got == expected
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got.values()


def test_table_against_its_sql(spark):
    turns = spark.read.parquet(f"{DATA}/conversations.parquet")
    got = repair(damage(turns))
    assert got.columns == COLUMNS
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    found = con.sql(own.sql())
    assert found.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == sorted(found.fetchall())


def test_odd_texts_and_empty_tables(spark):
    long = "word " * 400_000 + "."
    given = {1: [(0, "user", long), (1, "assistant", long), (1, "assistant", long), (2, "user", "\x0b\x0c"), (3, "uncle", "ünï🎉!")]}
    got = repair(table(spark, given)).collect()
    assert [tuple(r) for r in got] == [(1, *verdict(in_order(given[1])))]
    none = repair(damage(spark.createDataFrame([], SCHEMA)))
    assert none.columns == COLUMNS
    assert none.collect() == []
    assert repaired_turns(spark.createDataFrame([], SCHEMA)).collect() == []
