"""Operator 13 against a plain Lloyd on whole tables, and against its SQL."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from tabulaire.llm import codes
from tabulaire.llm.codes import compress

DATA = "/root/testdata/sf0.001"


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, vector, label) rows, one number at a time, with new sums in every round."""
    kept = [(i, [math.floor(256 * v) for v in x], label) for i, x, label in rows if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    part = lambda x, p: x[p * width : (p + 1) * width]
    books = [[part(x, p) for _, x, _ in kept[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [[] for _ in book]
            for _, x, _ in kept:
                own[nearest(part(x, p), book)[1]].append(part(x, p))
            books[p] = [[sum(c) // len(vs) for c in zip(*vs, strict=True)] if vs else old for vs, old in zip(own, book, strict=True)]
    sha = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    out, totals = [], {}
    for i, x, label in kept:
        near = [nearest(part(x, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in near)
        totals[label] = totals.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in near), error, label))
    return [(i, code, error, totals[label], sha) for i, code, error, label in out]


def test_table_against_plain_rounds_and_sql(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    got = sorted(tuple(r) for r in compress(table).collect())
    assert got == sorted(plain([(r.vec_id, r.embedding, r.label) for r in table.collect()]))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    found = con.sql(codes.sql())
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(found.fetchall()) == got


SCHEMA = "x int, vec_id long, `a.b` string, embedding array<float>, codes string, label int, part int, `count` int"


def make(spark, rows):
    return spark.createDataFrame([(1, i, "b", x, "c", label, 2, 3) for i, x, label in rows], SCHEMA)


def rows_of(n, seed, width=16):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)) * 3) / 256 * rng.integers(1, 40, (n, 1))
    return [(int(rng.integers(0, n)), [float(v) for v in x[i]], int(rng.integers(0, 4)) if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize(("n", "seed"), [(3, 1), (64, 2), (300, 3)])
def test_odd_tables(spark, n, seed):
    rows = rows_of(n, seed)
    rows += rows[: n // 3]  # whole rows repeat
    rows += [(None, rows[0][1], 1), (None, rows[1][1], None), (5, None, 1), (6, [None] + [0.0] * 15, 1), (7, [math.nan] + [0.0] * 15, 2), (8, [math.inf] + [0.0] * 15, 2), (-(2**40), [0.0] * 16, 9)]
    got = [tuple(r) for r in compress(make(spark, rows).repartition(5)).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_equal_vectors_share_an_entry_and_others_stay_unused(spark):
    rows = [(i, [0.5] * 32, i % 2) for i in range(200)]
    got = [tuple(r) for r in compress(make(spark, rows)).collect()]
    assert sorted(got) == sorted(plain(rows))
    assert {r[1] for r in got} == {"00" * 16}


def test_many_labels_with_a_hot_one(spark, monkeypatch):
    rows = [(i, x, 7 if i % 3 else i) for i, (_, x, _) in enumerate(rows_of(400, 6))]
    monkeypatch.setattr(codes, "FEW", 0)
    assert sorted(tuple(r) for r in compress(make(spark, rows)).collect()) == sorted(plain(rows))


def test_only_changed_parts_are_shuffled():
    """The sums of a round are those of all rows, though unchanged rows add nothing."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    x = rng.integers(-50, 50, (100, 16))
    old, new = rng.integers(0, 8, (100, 16)).astype(np.uint8), rng.integers(0, 8, (100, 16)).astype(np.uint8)
    new[:90] = old[:90]

    def sums(codes_, before):
        batch = pa.record_batch([pa.array(list(x.astype(np.int32))), pa.array([c.tobytes() for c in codes_]), pa.array([b if b is None else b.tobytes() for b in before], pa.binary())], names=["x", "codes", "before"])
        out = {}
        for b in codes._deltas(16, 8)(iter([batch])):
            for r in b.to_pylist():
                out[r["part"], r["entry"]] = np.array([r["n"], *r["sums"]])
        return out

    first, delta, whole = sums(old, [None] * 100), sums(new, list(old)), sums(new, [None] * 100)
    assert all(abs(v[0]) <= 20 for v in delta.values())  # the ten rows that changed, at most
    for key in first.keys() | delta.keys():
        both = first.get(key, 0) + delta.get(key, 0)
        assert (both == whole.get(key, np.zeros(2, int))).all()


def test_what_cannot_be_coded_is_refused(spark):
    for bad in ([(1, [0.0] * 17, 1)], [(1, [0.0] * 16, 1), (2, [0.0] * 32, 1)], [(1, [1e9] * 16, 1)]):
        with pytest.raises(Exception, match="equal parts|differing lengths|too large"):
            compress(make(spark, bad)).collect()


def test_empty_table(spark):
    for rows in ([], [(1, None, 1)]):
        out = compress(make(spark, rows))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert out.collect() == []
