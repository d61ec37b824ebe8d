"""Operator 4: benchmark decontamination with suffix arrays over the training documents.

Every task makes suffix arrays over shards of its whole documents. Benchmark
items ("tests") come as a query set in blocks of bounded size. Words are
numbered by their place in a block's vocabulary, all other words are 0 and end
a match, so only suffixes that begin with a known word are sorted. Every test
suffix is binary-searched in every shard, word by word, for all test suffixes at
once: an interval of the array holds all its occurrences, and is narrowed until
it is empty. Intervals nest, so the number of depths whose intervals hold a
suffix of the array is the longest verbatim match at that place: every place of
every document has its own. Word numbers are exact, so matches need no further
check, and no document is shuffled.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_arrow, only, small_batches
from .words import WORD, keep_rows, to_bytes

WINDOW = 10  #: words; a shorter item is one window as a whole
BLOCK = 1_000_000  #: test words in a block (some 20 MB at most in a worker)
SHARD = 2_000_000  #: bytes of text under one suffix array, or one longer document


@dataclass
class Tests:
    """A block of the query set: word numbers of all items, each followed by a 0."""

    vocabulary: dict[bytes, int]
    words: np.ndarray
    items: list[str]  # id of each item
    starts: np.ndarray  # of all test suffixes, as places in words
    item_of: np.ndarray  # of each such suffix
    lengths: np.ndarray  # of the window it begins; 0: too few words are left for one


def tests_of(items: list[tuple[str, str]], window: int = WINDOW) -> Tests:
    vocabulary: dict[bytes, int] = {}
    words, starts, item_of, lengths = [], [], [], []
    for i, (_, text) in enumerate(items):
        own = WORD.findall(to_bytes(text).lower())
        n = min(window, len(own))
        for at in range(len(own)):
            starts.append(len(words) + at)
            item_of.append(i)
            lengths.append(n if at + n <= len(own) else 0)
        words += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in own]
        words.append(0)
    as_array = lambda x: np.array(x, np.int64)
    return Tests(vocabulary, np.array(words, np.int32), [k for k, _ in items], as_array(starts), as_array(item_of), as_array(lengths))


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Places of the suffixes that begin with a known word, sorted as sequences of words up to their first 0.

    Prefix doubling that sorts anew only the suffixes still tied with another
    and not yet ended, so it takes few rounds but where texts repeat.
    """
    places = np.flatnonzero(words)
    order = places[np.argsort(words[places], kind="stable")]
    rank = np.zeros(len(words) + 1, np.int64)  # by first place of the group in order, from 1; 0: ended

    def regroup(at: np.ndarray, first: np.ndarray) -> None:
        """Ranks order[at] where ``first`` marks the beginnings of groups."""
        rank[order[at]] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))] + 1

    if not len(order):
        return order
    all_ = np.arange(len(order))
    regroup(all_, np.r_[True, words[order[1:]] != words[order[:-1]]])
    open_, step = all_, 1
    while len(open_):
        r = rank[order[open_]]
        tied = np.zeros(len(open_), bool)
        same = r[1:] == r[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        open_, r = open_[tied], r[tied]
        if not len(open_):
            break
        ahead = np.minimum(order[open_] + step, len(words))
        after = rank[ahead]
        sort = np.lexsort((after, r))
        order[open_] = order[open_[sort]]
        r, after = r[sort], after[sort]
        first = np.r_[True, (r[1:] != r[:-1]) | (after[1:] != after[:-1])]
        regroup(open_, first)
        # tied suffixes that have both ended are equal for good
        open_ = open_[after > 0]
        step *= 2
    return order


def search(words: np.ndarray, order: np.ndarray, tests: Tests) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For depth 1, 2, ...: test suffixes (numbers) that still match, and the intervals of ``order`` that hold their matches."""
    live = np.arange(len(tests.starts))
    low, high = np.zeros(len(live), np.int64), np.full(len(live), len(order))
    padded = np.r_[words, np.int32(0)]
    depth = 0
    while len(live):
        wanted = tests.words[tests.starts[live] + depth]

        def bound(after: bool) -> np.ndarray:
            """The first place in each interval whose next word is not below (or, ``after``, is above) the wanted one."""
            a, b = low.copy(), high.copy()
            while (going := a < b).any():
                middle = (a + b) // 2
                word = padded[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, len(words))]  # noqa: B023
                right = (word <= wanted if after else word < wanted) & going  # noqa: B023
                a = np.where(right, middle + 1, a)
                b = np.where(going & ~right, middle, b)
            return a

        low, high = bound(False), bound(True)
        found = (low < high) & (wanted > 0)
        live, low, high = live[found], low[found], high[found]
        depth += 1
        if len(live):
            yield depth, live, low, high


@dataclass
class Shard:
    """Words of some documents, each document followed by a 0, under a suffix array."""

    words: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, found: list[list[bytes]], tests: Tests) -> Shard:
        """Of documents given by their words."""
        number = tests.vocabulary.get
        counts = np.array([len(w) for w in found], np.int64)
        starts = np.r_[0, np.cumsum(counts + 1)]
        words = np.zeros(starts[-1], np.int32)
        for at, own in zip(starts, found, strict=False):
            words[at : at + len(own)] = list(map(number, own, repeat(0)))
        return cls(words, starts[:-1], counts, suffix_array(words))

    def matches(self, tests: Tests) -> Matches:
        """Every occurrence of every test window, and each document's longest match.

        Windows of the same words have one interval of the array, whose places
        are listed once, however many items hold them. Of a document's longest
        matches the first is given, with the first test suffix that begins with it.
        """
        none = np.zeros(0, np.int64)
        windows, places, of_window, items = [none], [none], [none], [none]
        depths: list[int] = []  # words of each distinct window
        n = len(self.order)
        steps = np.zeros(n + 1, np.int64)  # up and down at the borders of each depth's intervals
        keys, owners = [none], [none]  # depth * n + low of the intervals that some test suffix leaves there, and its number
        before = none, none, none

        def left(depth: int, gone: np.ndarray) -> None:
            low, first = np.unique(before[1][gone], return_index=True)
            keys.append(depth * n + low)
            owners.append(before[0][gone][first])

        depth = 0
        for depth, live, low, high in search(self.words, self.order, tests):
            starts, first = np.unique(low, return_index=True)
            steps[starts] += 1
            steps[high[first]] -= 1
            # an interval that stays as it is has no match that ends there
            gone = np.ones(len(before[0]), bool)
            same = np.searchsorted(before[0], live) if depth > 1 else none
            if depth > 1:
                gone[same] = (before[1][same] != low) | (before[2][same] != high)
            left(depth - 1, gone)
            before = live, low, high
            whole = tests.lengths[live] == depth
            if whole.any():
                a, first, which = np.unique(low[whole], return_index=True, return_inverse=True)
                m = high[whole][first] - a
                windows.append(np.repeat(np.arange(len(a)) + len(depths), m))
                places.append(self.order[np.repeat(a - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())])
                pairs = np.unique(np.stack([which + len(depths), tests.item_of[live[whole]]], 1), axis=0)
                of_window.append(pairs[:, 0])
                items.append(pairs[:, 1])
                depths += [depth] * len(a)
        left(depth, np.ones(len(before[0]), bool))
        longest = np.zeros(len(self.words), np.int64)
        longest[self.order] = np.cumsum(steps)[:-1]
        rank = np.zeros(len(self.words), np.int64)
        rank[self.order] = np.arange(n)
        top = np.maximum.reduceat(longest, self.starts) if len(self.starts) else none
        doc = np.repeat(np.arange(len(self.starts)), self.counts + 1)
        at = np.flatnonzero((longest == top[doc]) & (longest > 0))
        first = np.full(len(self.starts), -1)
        first[doc[at][::-1]] = at[::-1]
        owner = np.full(len(self.starts), -1)
        key = np.concatenate(keys)  # ascending: depth by depth, and each in order
        found = np.flatnonzero(top)
        owner[found] = np.concatenate(owners)[np.searchsorted(key, top[found] * n + rank[first[found]], "right") - 1]
        at, items = np.concatenate(of_window), np.concatenate(items)
        cut = np.searchsorted(at, np.arange(len(depths) + 1))
        return Matches(np.concatenate(windows), np.concatenate(places), np.array(depths, np.int64), [items[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], top, first, owner)


@dataclass
class Matches:
    """Occurrences (window number and place in the shard's words), each window's words and items, and each document's longest match."""

    windows: np.ndarray
    places: np.ndarray
    depths: np.ndarray
    items: list[np.ndarray]
    longest: np.ndarray  # words, by document
    where: np.ndarray  # place
    owner: np.ndarray  # test suffix


def _digest(ids: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def examine(texts: list[str | None], blocks: list) -> tuple[list[np.ndarray], list[set[str]], list[tuple]]:
    """Per text: which of its words are hit, the items found, and its longest match as (words, item, start in the text)."""
    words = [WORD.findall(to_bytes(t).lower()) for t in texts]
    hits = [np.zeros(len(w), bool) for w in words]
    items: list[set[str]] = [set() for _ in texts]
    best: list[tuple] = [(0, None, None)] * len(texts)
    for block in blocks:
        tests = block.value
        shard = Shard.of(words, tests)
        found = shard.matches(tests)
        docs = np.searchsorted(shard.starts, found.places, "right") - 1
        # spans of windows as steps up and down: their running sum is above 0 inside any
        steps = np.zeros(len(shard.words) + 1, np.int64)
        np.add.at(steps, found.places, 1)
        np.add.at(steps, found.places + found.depths[found.windows], -1)
        inside = np.cumsum(steps)[:-1] > 0
        for d in np.unique(docs):
            hits[d] |= inside[shard.starts[d] : shard.starts[d] + shard.counts[d]]
        for d, w in np.unique(np.stack([docs, found.windows], 1), axis=0):
            items[d].update(tests.items[i] for i in found.items[w])
        for d in np.flatnonzero(found.longest):
            own = int(found.longest[d]), tests.items[tests.item_of[found.owner[d]]], int(found.where[d] - shard.starts[d])
            if (-own[0], own[2], own[1]) < (-best[d][0], best[d][2] or 0, best[d][1] or ""):
                best[d] = own
        if len(blocks) > 1:
            block.unpersist_local()
    return hits, items, best


def _run(blocks: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SHARD):
            hits, items, best = examine(batch.column("text").to_pylist(), blocks)
            n_hit = [int(h.sum()) for h in hits]
            columns = {
                "n_words": pa.array([len(h) for h in hits], pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "n_items": pa.array([len(x) for x in items], pa.int64()),
                "items_sha256": pa.array([_digest(x) for x in items], pa.string()),
                "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_()),
                "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                "match_words": pa.array([b[0] for b in best], pa.int64()),
                "match_item": pa.array([b[1] for b in best], pa.string()),
                "match_start": pa.array([b[2] for b in best], pa.int64()),
            }
            yield pa.record_batch([batch.column("doc_id"), *columns.values()], names=["doc_id", *columns])

    return run


class Block:
    """A broadcast block of tests; a worker holds the unpickled block only while it is in use, if there are several."""

    def __init__(self, tests: Tests, spark):
        self.shared = spark.sparkContext.broadcast(pickle.dumps(tests))
        self._tests = None

    def __getstate__(self):
        return {"shared": self.shared, "_tests": None}

    @property
    def value(self) -> Tests:
        if self._tests is None:
            self._tests = pickle.loads(self.shared.value)
        return self._tests

    def unpersist_local(self) -> None:
        self._tests = None
        if hasattr(self.shared, "_path") and hasattr(self.shared, "_value") and self.shared._path:
            del self.shared._value  # it is read again from the worker's file


def blocks_of(benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> list[Block]:
    """The query set (item_id, text) as broadcasts of about ``block`` words each; the driver holds one block at a time.

    Blocks are dealt by a hash of the item, their number by the characters there
    are; after these are counted the table is read once, whatever their number.
    """
    spark = benchmark.sparkSession
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // (5 * block)))
    b = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    dealt = rows.withColumn("b", b).repartition(n, "b").sortWithinPartitions("b")
    return [Block(tests_of(sorted((r.item_id, r.text) for r in own), window), spark) for _, own in groupby(dealt.toLocalIterator(), lambda r: r.b)]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, match_words, match_item, match_start.

    A window is ``window`` consecutive words of an item of ``benchmark``
    (item_id, text), or all words of a shorter item. n_hit counts the
    document's words inside any occurrence of a window, items the items with
    such windows; the last three are the document's longest verbatim match of a
    test suffix, be it shorter than a window (ties: the first in the document,
    then the smallest item), its item and its first word in the document; 0 and
    nulls if no word is an item's. Null and empty
    texts have no words and the digest of an empty string; items without words,
    text or id are never found; items that repeat count once by id. Every row
    of ``docs`` is kept; an empty benchmark finds nothing; other columns are
    ignored.
    """
    bounded_arrow(docs.sparkSession)
    blocks = blocks_of(only(benchmark, item_id="item_id", text="text"), window, block)
    rows = only(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_run(blocks), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, match_words long, match_item string, match_start long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``docs`` (with a column text) without the rows that hold a window of ``benchmark``; all columns, no shuffle."""
    blocks = blocks_of(only(benchmark, item_id="item_id", text="text"), window, block)
    return keep_rows(docs, lambda texts: [not h.any() for h in examine(texts, blocks)[0]])


def sql(window: int = WINDOW) -> str:
    """The same rows by joins of windows, and longest matches as runs along the diagonals of equal words."""
    words = lambda: "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, row_number() OVER () AS b, {words()} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
s AS (SELECT item, w, least({window}, len(w)) AS n FROM i WHERE len(w) > 0),
t AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM s, unnest(range(1, len(w) - n + 2)) AS u(p)),
d AS (SELECT doc_id, row_number() OVER () AS r, CASE WHEN text IS NULL THEN [] ELSE {words()} END AS w FROM documents),
x AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM t), unnest(range(1, len(w) + 1)) AS u(p) WHERE p + n - 1 <= len(w)),
m AS (SELECT x.r, x.p, x.n, t.item FROM x JOIN t ON x.n = t.n AND x.g = t.g),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM m, unnest(range(p, p + n)) AS u(q) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r),
e AS (SELECT r, item, b, p, p - q AS diagonal FROM (SELECT r, unnest(w) AS g, unnest(range(1, len(w) + 1)) AS p FROM d) JOIN (SELECT item, b, unnest(w) AS g, unnest(range(1, len(w) + 1)) AS q FROM i) USING (g)),
f AS (SELECT r, item, min(p) AS p, count(*) AS n FROM (SELECT *, p - row_number() OVER (PARTITION BY r, b, diagonal ORDER BY p) AS run FROM e) GROUP BY r, item, b, diagonal, run),
l AS (SELECT r, max(n) AS match_words, arg_min(item, (-n, p, item)) AS match_item, arg_min(p, (-n, p, item)) - 1 AS match_start FROM f GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(match_words, 0) AS match_words, match_item, match_start
FROM d LEFT JOIN h USING (r) LEFT JOIN k USING (r) LEFT JOIN l USING (r)"""
