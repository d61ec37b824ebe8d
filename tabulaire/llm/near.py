"""Operator 5: n-gram Jaccard join with Bayesian candidate pruning.

Documents with the same words are one text. Each text's shingles (five words)
are min-hashed; texts that agree on all hashes of a band meet in a bucket. No
pairs are made there: a bucket links its texts to its first, and the connected
components of these links are the only places where similar texts can be.
Band keys travel once, packed into one row for each range of keys and some
thousands of texts, after a task has linked the texts that meet within it; so a
bucket that holds a third of all texts is a few entries of each task.

Chains of chance meetings can tie unlike texts into large components. Texts of
components of more than a block are therefore bucketed again by bands of twice
the length (``LONG``), which similar texts share no less surely and unlike ones
hardly ever. What is left is cut into blocks; pairs of blocks are tasks.

Inside such a task pairs are pruned as in Bayesian locality-sensitive hashing:
min-hash values are compared a few at a time, and a pair is dropped once the
posterior probability that its similarity reaches the threshold is below a
tolerance (uniform prior, so the posterior's tail is a binomial one). What is
left is verified exactly on the shingles. A task returns each text's number of
links and, for all that its links connect, one link to the smallest text, never
the links themselves, so the rows do not grow with the square of a group;
classes are the connected components of these.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Sieve, bounded_arrow, forget, hot_join, keep, often, only, sieve, small_batches
from .words import mix, to_bytes, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 5  #: two texts of similarity 0.8 share no band with a probability of 1.3e-7
LONG = (160, 10)  #: bands and rows inside large components: a probability of 1.3e-8, and 0.02 of sharing any at similarity 0.4
HASHES = BANDS * ROWS
TOLERANCE = 1e-7  #: posterior probability below which a pair is dropped
STEP = 20  #: min-hash values compared at a time
BLOCK = 128  #: texts in a block, on average; components of over 16 blocks have larger ones,
MOST = 2048  #: of so many texts at most
BLOCK_BYTES = 8_000_000  #: and so many bytes of shingles
FLUSH = 1_000_000  #: band keys that a task gathers before it packs them (some 40 MB)
RANGES = 256  #: ranges of keys that they are packed by (their first byte)
SMALL = 200_000  #: candidate texts whose ids are broadcast, at most (some 15 MB); more are joined by a shuffle
DENSE = 200  #: cells of a product of matrices that take as long as one shingle of a pair looked up
CHUNK = 16_384  #: pairs verified at first, where only what they connect is wanted
ENTRIES = 2_000_000  #: band keys of one range that a task holds; beyond, ranges are split


def shingles(w: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``WORDS`` words (hashed); fewer words are one shingle, no words none."""
    n = min(WORDS, len(w))
    if not n:
        return w
    with np.errstate(over="ignore"):
        h = np.full(len(w) - n + 1, n, np.uint64)
        for j in range(n):
            h = mix(h + w[j : len(w) - n + 1 + j] * np.uint64(2 * j + 1))
    return np.unique(h)


def identity(w: np.ndarray) -> bytes:
    """128 bits that two texts share if they have the same words (hashed) in the same order."""
    return hashlib.blake2b(w.tobytes(), digest_size=16).digest()


def _bijections(n: int) -> tuple[np.ndarray, np.ndarray]:
    flip, multiply = np.split((mix(np.arange(1, 2 * n + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)[:, None], 2)
    return flip, multiply | np.uint32(1)


_FIRST, _SECOND = _bijections(HASHES), _bijections(LONG[0] * LONG[1])


def signature(sets: np.ndarray, by: tuple[np.ndarray, np.ndarray] = _FIRST) -> np.ndarray:
    """The min-hash values of a set of shingles: bijections of 32 bits, their minima taken for many at a time."""
    x, (flip, multiply) = (sets >> np.uint64(32)).astype(np.uint32), by
    out = np.full(len(flip), 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 1024):
            np.minimum(out, ((x[None, at : at + 1024] ^ flip) * multiply).min(1), out=out)
    return out


def band_keys(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each run of ``rows`` values and its number."""
    with np.errstate(over="ignore"):
        h = np.arange(len(values) // rows, dtype=np.uint64)
        for j in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + values[j::rows].astype(np.uint64))
    return h


def least_matches(similarity: float, tolerance: float) -> list[int]:
    """After each ``STEP`` values: the fewest matches that leave the posterior chance of reaching ``similarity`` at ``tolerance``.

    With a uniform prior and m of n matches the similarity is Beta(m+1, n-m+1),
    and its tail above t is the chance of at most m hits in n+1 draws of odds t.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance and m < n:
            m += 1
            tail += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        out.append(m)
    return out


def _linked(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the first node of each, and links (node, first node) of all others."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
    hub = nodes[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
    ok = nodes != hub
    return keys[first], nodes[first], nodes[ok], hub[ok]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` things the smallest that the links (i, j) connect it to."""
    root = np.arange(n)
    while True:
        # links pull both roots down to the smaller, then paths are halved until they are flat
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i].copy(), low)
        np.minimum.at(root, root[j].copy(), low)
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            return root


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node) that connect what the links (a, b) do, one for every other node."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = _roots(len(nodes), place[: len(a)], place[len(a) :])
    leaf = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[leaf], nodes[root[leaf]]


PACKED = "span int, n int, pack binary, a long, b long"
_PACKED = pa.schema([("span", pa.int32()), ("n", pa.int32()), ("pack", pa.binary()), ("a", pa.int64()), ("b", pa.int64())])


class _Bands:
    """Band keys of the texts that a task has met, until they are packed."""

    def __init__(self):
        self.keys, self.nodes, self.seen, self.n = [], [], set(), 0

    def add(self, node: int, same: bytes | int, keys: np.ndarray) -> None:
        """``keys`` of the text that ``same`` tells from others, if it is new."""
        if same not in self.seen:
            self.seen.add(same)
            self.keys.append(keys)
            self.nodes.append(node)
            self.n += len(keys)

    def flush(self) -> pa.RecordBatch:
        """A row (span, n, pack) for each range of keys, and a row (a, b) for each link between two of the texts."""
        keys = np.concatenate([*self.keys, np.zeros(0, np.uint64)])
        nodes = np.repeat(np.array(self.nodes, np.int64), [len(k) for k in self.keys])
        self.__init__()
        keys, nodes, a, b = _linked(keys, nodes)
        a, b = _stars(a, b)
        edges = np.searchsorted((keys >> np.uint64(56)).astype(np.int64), np.arange(RANGES + 1))
        full = np.flatnonzero(np.diff(edges))
        packs = [_pack((keys[edges[s] : edges[s + 1]] >> np.uint64(8)) & np.uint64(2**48 - 1), nodes[edges[s] : edges[s + 1]]) for s in full]
        none = lambda n, kind: pa.nulls(n, kind)
        return pa.concat_batches([
            pa.record_batch([pa.array(full, pa.int32()), pa.array(np.diff(edges)[full], pa.int32()), pa.array(packs, pa.binary()), none(len(full), pa.int64()), none(len(full), pa.int64())], schema=_PACKED),
            pa.record_batch([none(len(a), pa.int32()), none(len(a), pa.int32()), none(len(a), pa.binary()), pa.array(a), pa.array(b)], schema=_PACKED),
        ])


def _pack(keys: np.ndarray, nodes: np.ndarray) -> bytes:
    """48-bit keys of one range, and nodes by their distance from the least; keys that agree so far only make a few more candidates."""
    base = nodes.min()
    away = nodes - base
    return base.tobytes() + (keys >> np.uint64(16)).astype("<u4").tobytes() + (keys & np.uint64(0xFFFF)).astype("<u2").tobytes() + away.astype("<u4" if away.max() < 2**32 else "<u8").tobytes()


def _unpack(pack: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` keys and nodes of a pack."""
    keys = np.frombuffer(pack, "<u4", n, 8).astype(np.uint64) << np.uint64(16) | np.frombuffer(pack, "<u2", n, 8 + 4 * n).astype(np.uint64)
    away = np.frombuffer(pack, "<u4" if len(pack) == 8 + 10 * n else "<u8", n, 8 + 6 * n)
    return keys, np.frombuffer(pack, np.int64, 1)[0] + away.astype(np.int64)


_SKETCH = pa.schema([("node", pa.int64()), ("doc_id", pa.int64()), ("hash", pa.int64()), ("same", pa.binary()), ("size", pa.int64()), *_PACKED])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (node, doc_id, hash, same, size: words) and, between them, of ``PACKED``; the others' columns are null."""
    from pyspark import TaskContext

    at, bands = TaskContext.get().partitionId() << 33, _Bands()
    wide = lambda b: pa.record_batch([b.column(f.name) if f.name in b.schema.names else pa.nulls(b.num_rows, f.type) for f in _SKETCH], schema=_SKETCH)
    for batch in small_batches(batches, "text"):
        same, sizes = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = word_hashes(to_bytes(text))
            same.append(identity(words))
            sizes.append(len(words))
            if len(words) and same[-1] not in bands.seen:
                bands.add(at + i, same[-1], band_keys(signature(shingles(words))))
        nodes = pa.array(np.arange(at, at + batch.num_rows))
        yield wide(pa.record_batch([nodes, batch.column("doc_id"), batch.column("hash"), pa.array(same, pa.binary()), pa.array(sizes, pa.int64())], names=["node", "doc_id", "hash", "same", "size"]))
        at += batch.num_rows
        if bands.n >= FLUSH:
            yield wide(bands.flush())
    yield wide(bands.flush())


def _sketch_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``PACKED`` rows of the longer bands of (node, component, shingles); texts meet only within their component."""
    bands = _Bands()
    for batch in small_batches(batches, "shingles"):
        for node, component, found in zip(*[batch.column(c).to_pylist() for c in ("node", "component", "shingles")], strict=True):
            keys = band_keys(signature(np.frombuffer(found, np.uint64), _SECOND), LONG[1])
            bands.add(node, node, mix(keys ^ mix(np.array([component], np.int64).view(np.uint64))))
        if bands.n >= FLUSH:
            yield bands.flush()
    yield bands.flush()


def _split(parts: int):
    """Packs of ranges to packs of ranges ``parts`` times as narrow."""
    wide = np.uint64(2**48 // parts + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for span, n, pack in zip(*[batch.column(c).to_pylist() for c in ("span", "n", "pack")], strict=True):
                keys, nodes = _unpack(pack, n)
                inner = keys // wide
                cut = np.flatnonzero(np.r_[True, inner[1:] != inner[:-1], True])
                rows += [(span * parts + int(inner[lo]), hi - lo, _pack(keys[lo:hi], nodes[lo:hi])) for lo, hi in zip(cut[:-1], cut[1:], strict=True)]
            spans, counts, packs = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch([pa.array(spans, pa.int64()), pa.array(counts, pa.int32()), pa.array(packs, pa.binary())], names=["span", "n", "pack"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect the nodes that share a key, from packs sorted by range: stars, of all that a task holds at once."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    last = None

    def settle() -> None:
        x, y = _linked(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))[2:]
        a.append(x)
        b.append(y)
        held.clear()

    def out() -> pa.RecordBatch:
        x, y = _stars(np.concatenate(a), np.concatenate(b))
        a[:], b[:] = [x[:0]], [y[:0]]
        return pa.record_batch([pa.array(x), pa.array(y)], names=["a", "b"])

    for batch in batches:
        for span, n, pack in zip(*[batch.column(c).to_pylist() for c in ("span", "n", "pack")], strict=True):
            if held and span != last:
                settle()
                if sum(map(len, a)) > FLUSH:
                    yield out()
            held.append(_unpack(pack, n))
            last = span
    if held:
        settle()
    yield out()


def candidate_links(packed: DataFrame, keys: int) -> DataFrame:
    """Links (a, b) that connect all nodes with a common band key, from written ``PACKED`` rows of ``keys`` band keys in all."""
    packs = packed.where("pack is not null").select("span", "n", "pack")
    parts = -(-keys // (RANGES * ENTRIES))
    if parts > 1:
        packs = packs.mapInArrow(_split(parts), "span long, n int, pack binary")
    met = packs.repartition("span").sortWithinPartitions("span").mapInArrow(_meet, "a long, b long")
    return packed.where("a is not null").select("a", "b").unionByName(met)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge up at most, and none up and down; one small exchange."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node connected to each node of ``edges`` (a, b), by large and small stars.

    Each round links every node's larger neighbours to its smallest one, then
    its smaller ones, until only stars are left; rounds are written tables, the
    one before is deleted, and their number grows with the logarithm of a
    component's size. Nodes with very many neighbours are dealt over tasks.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _is_forest_of_stars(edges):
        most = often(2 * edges.count())
        # large star: neighbours above a node join the least of its neighbourhood
        around = both(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        up = hot_join(around.where("b > a"), least.select("a", "m"), "a", ["b"], least.where(F.col("n") >= most).select("a"))
        up = keep(up.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"), name)
        forget(edges)
        # small star: a node and its neighbours below join the least of them
        least = up.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        joined = hot_join(up, least.select("a", "m"), "a", ["b"], least.where(F.col("n") >= most).select("a"))
        edges = keep(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), name)
        forget(up)
    found = keep(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), name)
    forget(edges)
    return found


def _members(may: Sieve):
    """(doc_id, hash, same, shingles) of the texts whose ``key`` may be wanted, each row's once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            passed = batch.filter(pa.array(may.passes(batch.column("key").to_numpy(zero_copy_only=False)), pa.bool_()))
            for part in small_batches(iter([passed]), "text"):
                rows = []
                for doc_id, h, text in zip(*[part.column(c).to_pylist() for c in ("doc_id", "hash", "text")], strict=True):
                    words = word_hashes(to_bytes(text))
                    same = identity(words)
                    if (doc_id, h, same) not in seen:
                        seen.add((doc_id, h, same))
                        rows.append((doc_id, h, same, shingles(words).tobytes()))
                columns = zip(*rows, strict=True) if rows else ((),) * 4
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["doc_id", "hash", "same", "shingles"])

    return run


def _shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray):
    """A function that counts the common shingles of some of the pairs (i, j), given their places among them."""
    rows, column = np.unique(np.r_[i, j], return_inverse=True)
    i, j = column[: len(i)], column[len(i) :]
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    number, count = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)[1:]
    shared = count[number] > 1
    rank = np.cumsum(count > 1) - 1
    owner, number = owner[shared], rank[number[shared]]
    n, edges = int((count > 1).sum()), np.searchsorted(owner, np.arange(len(rows) + 1))

    def dense() -> np.ndarray:
        # shingles of at least two texts as columns of 0 and 1, some columns at a time
        order = np.argsort(number, kind="stable")
        by, where = owner[order], number[order]
        common = np.zeros((len(rows), len(rows)), np.float32)
        for lo in range(0, n, 4096):
            a, b = np.searchsorted(where, [lo, lo + 4096])
            x = np.zeros((len(rows), min(4096, n - lo)), np.float32)
            x[by[a:b], where[a:b] - lo] = 1
            common += x @ x.T
        return common

    def counts(some: np.ndarray) -> np.ndarray:
        own, other = i[some], j[some]
        sizes = np.diff(edges)[other]
        if len(rows) ** 2 * n < DENSE * int(sizes.sum()):
            return dense()[own, other].astype(np.int64)
        out, marks, order = np.zeros(len(some), np.int64), np.zeros(n, bool), np.argsort(own, kind="stable")
        cut = np.flatnonzero(np.diff(own[order], prepend=-1, append=-1))
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            pairs = order[lo:hi]
            mine = number[edges[own[pairs[0]]] : edges[own[pairs[0]] + 1]]
            marks[mine] = True
            size = sizes[pairs]
            stop = np.cumsum(size)
            at = np.arange(stop[-1]) + np.repeat(edges[other[pairs]] - stop + size, size)
            total = np.r_[0, np.cumsum(marks[number[at]])]
            out[pairs] = total[stop] - total[stop - size]
            marks[mine] = False
        return out

    return counts


def similar_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float, tolerance: float, connect: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of ``left``, j of ``right``, i before j) whose Jaccard similarity is at least ``similarity``; with ``connect`` only some of them, that connect what all do."""
    sizes = np.array([len(s) for s in sets])
    values = np.stack([signature(s) for s in sets])
    a, b = sizes[left][:, None], sizes[right]
    ok = np.minimum(a, b) >= similarity * np.maximum(a, b)
    if left is right:
        ok &= left[:, None] < right
    steps = list(zip(range(0, HASHES, STEP), least_matches(similarity, tolerance), strict=True))
    # while many pairs are left all are compared, a hash at a time
    x, y, seen = np.ascontiguousarray(values[left].T), np.ascontiguousarray(values[right].T), np.zeros(ok.shape, np.uint8)
    while steps and 8 * np.count_nonzero(ok) > ok.size:
        at, least = steps.pop(0)
        for k in range(at, at + STEP):
            seen += x[k][:, None] == y[k]
        ok &= seen >= least
    i, j = np.nonzero(ok)
    hits = seen[i, j].astype(np.int16)
    i, j = left[i].astype(np.int32), right[j].astype(np.int32)
    for at, least in steps:
        for lo in range(0, len(i), 65_536):
            part = slice(lo, lo + 65_536)
            hits[part] += (values[i[part], at : at + STEP] == values[j[part], at : at + STEP]).sum(1)
        ok = hits >= least
        i, j, hits = i[ok], j[ok], hits[ok]
    if not len(i):
        return i, j
    # exact; if only what is connected is asked for, the likeliest pairs first, and none that others connect already
    common = _shared(sets, i, j)
    rest, most = (np.argsort(-hits, kind="stable"), CHUNK) if connect else (np.arange(len(i)), len(i))
    found = [rest[:0]]
    while len(rest):
        some, rest = rest[:most], rest[most:]
        both = common(some)
        found.append(some[both >= similarity * (sizes[i[some]] + sizes[j[some]] - both) - 1e-9])
        most *= 2
        if len(rest):
            links = np.concatenate(found)
            root = _roots(len(sets), i[links], j[links])
            rest = rest[root[i[rest]] != root[j[rest]]]
    links = np.sort(np.concatenate(found))
    return i[links], j[links]


def _verify(similarity: float, tolerance: float, connect: bool):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        (_, x, y), own = rows[0][0], {r[1]: (r[2], r[3]) for r in rows}
        nodes = sorted(own)
        sets = [np.frombuffer(own[n][1], np.uint64) for n in nodes]
        block = np.array([own[n][0] for n in nodes])
        left = np.flatnonzero(block == x)
        right = left if x == y else np.flatnonzero(block == y)
        if not len(left) or not len(right):
            return
        i, j = similar_pairs(sets, left, right, similarity, tolerance, connect)
        if not len(i):
            return
        links = np.bincount(np.r_[i, j], minlength=len(nodes))
        linked = np.flatnonzero(links)
        root = _roots(len(nodes), i, j)
        leaf = np.flatnonzero(root != np.arange(len(nodes)))
        name = np.array(nodes, np.int64)
        a, b = np.r_[name[linked], name[leaf]], np.r_[name[linked], name[root[leaf]]]
        yield pa.record_batch([pa.array(a), pa.array(b), pa.array(np.r_[links[linked], np.zeros(len(leaf), np.int64)])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for component, x, y, node, block, found in zip(*[batch.column(c).to_pylist() for c in ("component", "x", "y", "node", "block", "shingles")], strict=True):
                if held and held[0][0] != (component, x, y):
                    yield from settle(held)
                    held = []
                held.append(((component, x, y), node, block, found))
        if held:
            yield from settle(held)

    return run


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, tolerance: float = TOLERANCE, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, n_links, n_copies.

    n_links counts the other texts (documents with the same words are one
    text) whose shingle sets have a Jaccard similarity of at least
    ``similarity`` with the row's, n_copies the rows with the row's words, itself
    included, and class_id is the smallest doc_id of all rows connected to the
    row by links and copies. Texts without words (null ones too) are copies of
    each other; a null doc_id stays null and its class has the smallest id
    there is, or null; repeated rows are copies; an empty table gives an empty
    result; other columns are ignored.
    """
    return _classes(docs, similarity, tolerance, doc_id, text)[0].select("doc_id", "class_id", "n_links", "n_copies")


def _sized(nodes: DataFrame, name: str) -> DataFrame:
    """``nodes`` (node, component, size, ...) of components of several, with n (nodes) and total (size) of their component; a written table."""
    sizes = nodes.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("total")).where("n > 1")
    return keep(hot_join(nodes, sizes, "component", ["node"], sizes.where(F.col("n") >= often(nodes.count())).select("component")), name)


def _candidates(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """(node, component, n, total, shingles) of the texts that may have a similar one; a written table.

    ``docs`` has doc_id, hash and text, ``sketched`` is what ``_sketch`` made of it.
    """
    rows = sketched.where("same is not null").select("node", "doc_id", "hash", "same", "size")
    links = candidate_links(sketched.select("span", "n", "pack", "a", "b"), BANDS * rows.count())
    parts = components(links, "candidate-links")
    # texts, each by one of its rows; copies of one text need no comparison
    first = F.min(F.struct("node", F.col("doc_id").alias("wanted_id"), F.col("hash").alias("wanted_hash"), "size")).alias("first")
    texts = keep(rows.join(parts, "node").groupBy("component", "same").agg(first).select("component", "same", "first.*"), "met")
    wanted = _sized(texts, "candidates")
    # only texts that may be wanted are hashed again and go into the join, so little is shuffled where it is no broadcast
    may = sieve(wanted.select(F.xxhash64("wanted_id", "wanted_hash").alias("key")))
    keyed = docs.select("doc_id", "hash", F.xxhash64("doc_id", "hash").alias("key"), "text")
    found = keyed.mapInArrow(_members(may), "doc_id long, hash long, same binary, shingles binary")
    match = found["doc_id"].eqNullSafe(wanted["wanted_id"]) & (found["hash"] == wanted["wanted_hash"]) & (found["same"] == wanted["same"])
    ids = F.broadcast(wanted) if wanted.count() <= SMALL else wanted
    sets = keep(found.join(ids, match).select("node", "component", "n", "total", "shingles"), "shingles")
    for old in (parts, texts, wanted):
        forget(old)
    return sets


def _refined(sets: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``sets`` with the components of more than a block, if there are any, parted by the longer bands; and the written tables that it reads."""
    large = sets.where(F.col("n") > BLOCK)
    if large.isEmpty():
        return sets, [sets]
    packed = keep(large.mapInArrow(_sketch_again, PACKED), "longer-bands")
    parts = components(candidate_links(packed, LONG[0] * large.count()), "longer-links")
    # rows that repeat as a whole may come from several tasks
    nodes = large.select("node", (F.octet_length("shingles") / 8).cast("long").alias("size")).dropDuplicates(["node"])
    sized = _sized(nodes.join(parts, "node"), "refined")
    forget(packed)
    forget(parts)
    return sets.where(F.col("n") <= BLOCK).unionByName(large.select("node", "shingles").join(sized.drop("size"), "node")), [sets, sized]


def _classes(docs: DataFrame, similarity: float, tolerance: float = TOLERANCE, doc_id: str = "doc_id", text: str = "text", connect: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """As ``near_duplicates``, with each row's xxhash64 of its text (hash) and that of its class's first row (class_hash); and the written tables it reads.

    The first row of a class has its smallest doc_id (null: only if all are) and, of these, the smallest hash.
    With ``connect`` links are found only as far as classes need them, so n_links is too small.
    """
    spark = docs.sparkSession
    bounded_arrow(spark)
    rows = only(docs, doc_id=doc_id, text=text).withColumns({"doc_id": F.col("doc_id").cast("long"), "hash": F.xxhash64("text")})
    sketched = keep(rows.mapInArrow(_sketch, f"node long, doc_id long, hash long, same binary, size long, {PACKED}"), "sketches")
    placed, read = _refined(_candidates(rows, sketched))
    n, size = F.col("n"), 8 * F.col("total")
    blocks = F.greatest(F.least(F.ceil(n / BLOCK), F.lit(16)), F.ceil(n / MOST), F.ceil(size / BLOCK_BYTES)).cast("int")
    placed = placed.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "block", "shingles")
    # a component's pairs of blocks go to one partition after the other, so no task has several of a large one while others have none
    number = F.col("y") * (F.col("y") + 1) / 2 + F.col("x")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    to = F.pmod(F.hash("component").cast("long") + number.cast("long"), F.lit(parts)).cast("int")
    dealt = pairs.withColumn("to", to).repartitionById(parts, "to").drop("to").sortWithinPartitions("component", "x", "y")
    found = keep(dealt.mapInArrow(_verify(similarity, tolerance, connect), "a long, b long, links long"), "links")
    for old in read:
        forget(old)
    counts = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    classes = components(found.where("a <> b").select("a", "b"), "links-of-classes")
    documents = sketched.where("same is not null").select("node", "doc_id", "hash", "same")
    texts = documents.groupBy("same").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")).alias("least"), F.count("*").alias("n_copies"))
    texts = keep(texts, "texts")
    linked = keep(documents.select("node", "same").join(counts, "node").join(classes, "node").join(texts.select("same", "least"), "same"), "linked")
    forget(found)
    forget(classes)
    tables = [sketched, texts, linked]
    firsts = linked.groupBy("component").agg(F.min("least").alias("least_of_class"), F.count("*").alias("n"))
    linked = hot_join(linked, firsts.drop("n"), "component", ["node"], firsts.where(F.col("n") >= often(linked.count())).select("component")).select("same", "n_links", "least_of_class")
    first = F.coalesce("least_of_class", "least")
    named = texts.join(linked, "same", "left").select("same", first["doc_id"].alias("class_id"), first["hash"].alias("class_hash"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("n_copies").cast("long").alias("n_copies"))
    hot = texts.where(F.col("n_copies") >= often(documents.count())).select("same")
    return hot_join(documents, named, "same", ["node"], hot).drop("node", "same"), tables


def first_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` (doc_id, text, ...) with one row of each class: one of the smallest doc_id, all columns.

    Rows without a doc_id come last in a class. Rows are told apart by doc_id
    and text (hashed), so a row is never dropped for another that shares its
    doc_id alone; of rows that share both any one stays. Texts without words
    (null and empty ones too) are copies of each other; an empty table stays empty.
    """
    mark = lambda i, h: F.xxhash64(i, h)
    name = "_mark" + max([c for c in docs.columns if c.startswith("_mark")], default="")  # no column of docs
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("hash") == F.col("class_hash"))
    classes, tables = _classes(docs, similarity, connect=True)
    rows = classes.select(mark("doc_id", "hash").alias(name), first.alias("first"), "n_copies").where("not first or n_copies > 1")
    found = keep(rows.groupBy(name).agg(F.max("first").alias("first"), F.count("*").alias("n")).where("not first or n > 1"), "repeated")
    for old in tables:
        forget(old)
    own = mark(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]))
    may = sieve(found.select(F.col(name).alias("key")))
    # most rows are no candidates for dropping and take no part in a join
    kept = docs.where(~may(own)).union(docs.where(may(own)).join(found.select(name), own == found[name], "left_anti"))
    again = found.where("first").select(name)
    if again.isEmpty():
        return kept
    # rows that repeat a class's first row as a whole
    return kept.union(docs.where(may(own)).join(again, own == again[name]).dropDuplicates([name]).drop(name))


def sql(similarity: float = SIMILARITY, words: int = WORDS) -> str:
    """The same rows by an inverted index of all shingles and a recursive search for classes."""
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') END AS w FROM documents),
t AS (SELECT w, min(r) AS node, min(doc_id) AS first_id, count(*) AS n_copies FROM d GROUP BY w),
s AS (SELECT DISTINCT node, array_to_string(w[p:p + {words - 1}], ' ') AS g FROM t, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS u(p) WHERE len(w) > 0),
z AS (SELECT node, count(*) AS n FROM s GROUP BY node),
c AS (SELECT a.node AS a, b.node AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.node <> b.node GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN z x ON x.node = a JOIN z y ON y.node = b WHERE k >= {similarity} * (x.n + y.n - k) - 1e-9),
f AS (SELECT node, node AS other FROM t UNION SELECT f.node, l.b FROM f JOIN l ON l.a = f.other),
m AS (SELECT f.node, min(o.first_id) AS class_id FROM f JOIN t o ON o.node = f.other GROUP BY f.node),
n AS (SELECT a AS node, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, n_copies FROM d JOIN t USING (w) JOIN m USING (node) LEFT JOIN n USING (node)"""
