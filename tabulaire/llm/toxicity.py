"""Operator 9: toxicity, by a convolutional text classifier in numpy.

A word's embedding is the sum of rows for its hash and the hashes of its
prefixes, so that new forms of known words are recognised. Every word and prefix
of a few training documents has a row; its first coordinate begins at how far
the word's shares of the two labels differ, in standard errors, the others at
random, and all are trained. Filters of several widths run over the whole text,
each filter's maximum feeds a logistic output. Thresholds are calibrated for
each language, as predicted from the text, on rows left out of training, and
moved to 0.5 by a shift of the logit.

All labelled rows are learned from, none is drawn: words are counted by a
shuffle, the network is trained in shards of some thousand rows side by side whose
weights are averaged after each epoch, languages are told apart by counts of
n-grams, and thresholds come from counts of logits. Only the model itself
(some megabytes) passes the driver.
"""

from __future__ import annotations

import pickle
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import language
from .common import bounded_arrow, fold_of, forget, keep, only, sieve, small_batches
from .words import _BACK, _LOW, _POWER, _spans, _sums, mix, score_rows, to_bytes

PREFIXES = (3, 4, 5, 6, 7, 8)  #: bytes
WIDTHS = (1, 2, 3)
DIM, FILTERS = 12, 12
_HEAD = max(PREFIXES)
LEAST_DOCS = 4  #: training documents that a word or prefix must be in to get an embedding
ROWS = 60_000  #: embeddings at most (3 MB, and row numbers of two bytes): of more words and prefixes the most frequent
LONG = 4096  #: bytes from which a word is known by its prefixes only
BLANKS = 20  #: one empty text is learned as clean for so many others
EPOCHS = 8
SHARD = 4096  #: rows that one task trains on between two averages, about
SHARD_BYTES = 32_000_000  #: of row numbers in a shard, about; a shard of longer texts is cut
PACK = 1_000_000  #: bytes of packed row numbers whose forms are told apart at once
FLUSH = 500_000  #: hashes that a task counts before it hands them on
LANGUAGES = 2000  #: that are told apart, at most
FIXED = 1 << 24  #: sums of weights are whole multiples of 1 / FIXED, so they are the same in any order
GRID = 256  #: logits are counted in steps of 1 / GRID
SLOTS = 1 << 20
STEP = 1024  #: forms that are filtered at once
LOOK = 1 << 16  #: words whose filters' responses are held at once
FLAGGED = 0.002  #: share of clean rows that a threshold may flag


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each different word of ``texts`` once, as (words, 1 + prefixes) 64-bit hashes; which of them stand in the texts, one after the other; and how many in each text.

    A hash is 0 where a word is shorter than the prefix, and for the whole of a word of ``LONG`` bytes or more.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)  # joined by a byte that no word has
    keys, starts, long = [], [], []
    at, inside = 0, False  # whether the last part ended inside a word
    with np.errstate(over="ignore"):
        for part in _spans(data):
            begin, stops, sums, total = _sums(part)
            first = int(inside and len(begin) and not begin[0])
            inside = bool(len(stops)) and stops[-1] == len(part)
            begin, size, sums = begin[first:], (stops - begin)[first:], sums[first:]
            big = size >= LONG  # known by its first bytes only
            heads = (total[begin[big] + _HEAD] - total[begin[big]]) * _BACK[begin[big]] + np.uint64(1 << 33)
            sums[big], size[big] = heads, _HEAD
            keys.append(mix(sums + size.astype(np.uint64)))
            starts.append(begin + at)
            long.append(big)
            at += len(part)
        keys, starts, long = np.concatenate(keys), np.concatenate(starts), np.concatenate(long)
        order = np.argsort(keys)
        new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
        own, place = order[new], np.empty(len(keys), np.int64)
        place[order] = np.cumsum(new) - 1
        at = starts[own, None] + np.arange(_HEAD)
        head = np.where(at < len(data), _LOW[data[np.minimum(at, len(data) - 1)]], 0) if len(own) else np.zeros((0, _HEAD), np.uint8)
        size = np.cumprod(head != 0, 1).sum(1)
        sums = np.cumsum(head * _POWER[:_HEAD], 1, dtype=np.uint64)[:, np.array(PREFIXES) - 1]
        known = mix(sums + np.array(PREFIXES, np.uint64) + np.uint64(1 << 32))
    hashes = np.empty((len(own), 1 + len(PREFIXES)), np.uint64)
    hashes[:, 0] = np.where(long[own], 0, keys[own])
    hashes[:, 1:] = np.where(size[:, None] >= np.array(PREFIXES), known, 0)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    return hashes, place, np.diff(np.searchsorted(starts, ends), prepend=0)


def features(raw: bytes) -> np.ndarray:
    """The hashes of ``words`` for each word of a text."""
    hashes, place, _ = words([raw])
    return hashes[place]


def distinct(docs: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All different rows of ``docs`` (row numbers of words), the first of them zeros, and each document as places among them."""
    rows = np.vstack([np.zeros_like(docs[0], shape=(1, docs[0].shape[1])), *docs]).astype(np.uint16)
    rows = np.pad(rows, [(0, 0), (0, -rows.shape[1] % 4)])
    place = np.zeros(len(rows), np.int64)
    for part in np.ascontiguousarray(rows).view(np.uint64).T:
        own = np.unique(part, return_inverse=True)[1]
        _, first, place = np.unique(place * (own.max() + 1) + own, return_index=True, return_inverse=True)
    return rows[first, : docs[0].shape[1]], np.split(place[1:].astype(np.int32), np.cumsum([len(d) for d in docs[:-1]]))


class Vocabulary:
    """Row numbers of the hashes seen in training, by direct addressing; 0 for all others."""

    def __init__(self, hashes: np.ndarray):
        # hashes come by falling frequency: of two in one slot the more frequent stays
        self.hashes = np.r_[np.uint64(0), hashes]
        self.slots = np.zeros(SLOTS, np.uint16)
        self.slots[(hashes[::-1] % np.uint64(SLOTS)).astype(np.int64)] = np.arange(len(hashes), 0, -1)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        at = self.slots[(hashes % np.uint64(SLOTS)).astype(np.int64)]
        return np.where(self.hashes[at] == hashes, at, np.uint16(0))


def near(rows: np.ndarray) -> np.ndarray:
    """``rows`` without words that no filter sees together with a known one, but for a blank at the end.

    Filters respond to every window of unknown words alike, so their maxima stay the same.
    """
    reach = max(WIDTHS) - 1
    kept = np.convolve(rows.any(1), np.ones(2 * reach + 1))[reach : reach + len(rows)] > 0 if len(rows) else np.zeros(0, bool)
    return np.vstack([rows[kept], np.zeros((max(WIDTHS), rows.shape[1]), rows.dtype)])


class Network:
    """Embedding rows (row 0 stays zero), one filter bank a width, and a logistic output."""

    def __init__(self, leaning: np.ndarray, seed: int = 11):
        """``leaning`` has each row's difference between the labels, in standard errors."""
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.02, (len(leaning) + 1, DIM)).astype(np.float32)
        self.e[1:, 0] += 0.1 * np.clip(leaning, -8, 8)
        self.e[0] = 0
        self.w = [rng.normal(0, 0.3, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def maps(self, x: np.ndarray):
        """Each width's filters at each word vector of ``x`` but the last ``max(WIDTHS) - 1``."""
        n = len(x) - max(WIDTHS) + 1
        for k, w, b in zip(WIDTHS, self.w, self.b, strict=True):
            y = x[:n] @ w[0]
            for j in range(1, k):
                y += x[j : j + n] @ w[j]
            yield y + b

    def embed(self, rows: np.ndarray) -> np.ndarray:
        """The word vectors of ``rows`` and those of the blanks after them."""
        return np.vstack([self.vectors(rows), np.zeros((max(WIDTHS) - 1, DIM), np.float32)])

    def vectors(self, forms: np.ndarray) -> np.ndarray:
        """The vector of each of ``forms`` (row numbers of a word)."""
        x = np.zeros((len(forms), DIM), np.float32)
        for j in range(forms.shape[1]):
            x += self.e.take(forms[:, j], 0)
        return x

    def logits(self, forms: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The scores of texts of ``sizes`` words, which are ``forms[place]``; texts of unknown words only, and empty ones, get the filters' response to nothing.

        Filters are applied once to each form, with sums in a fixed order, so a
        text's score is the same whatever texts are scored with it.
        """
        gap = max(WIDTHS)  # blanks after each text: filters also run over its end
        x = np.ascontiguousarray(np.vstack([np.zeros((1, DIM), np.float32), self.vectors(forms)]).T)
        filters = [f for w in self.w for f in w]
        parts = np.empty((len(filters), x.shape[1], FILTERS), np.float32)
        for at in range(0, x.shape[1], STEP):
            part = 0
            for rows, e in zip(np.concatenate(filters, 1), x[:, at : at + STEP], strict=True):
                part += rows[:, None] * e
            parts[:, at : at + STEP] = part.reshape(len(filters), FILTERS, -1).transpose(0, 2, 1)
        begin = np.cumsum(sizes + gap) - sizes - gap
        seen = np.zeros(len(place) + gap * len(sizes), np.int64)
        seen[np.arange(len(place)) + gap * np.repeat(np.arange(len(sizes)), sizes)] = place + 1
        most = np.full((len(WIDTHS), len(sizes), FILTERS), -np.inf, np.float32)
        last = len(seen) - gap + 1
        for at in range(0, last, LOOK):
            stop = min(at + LOOK, last)
            some = np.flatnonzero((begin < stop) & (begin + sizes >= at))
            if not len(some):  # between two texts
                continue
            edges = np.stack([np.maximum(begin[some], at), np.minimum(begin[some] + sizes[some] + 1, stop)], 1).ravel() - at
            edges, own = edges[:-1] if edges[-1] == stop - at else edges, iter(parts)
            for k, width in enumerate(WIDTHS):
                y = next(own).take(seen[at:stop], 0)
                for j in range(1, width):
                    y += next(own).take(seen[at + j : stop + j], 0)
                most[k, some] = np.maximum(most[k, some], np.maximum.reduceat(y, edges, 0)[::2])
        pooled = np.maximum(most + np.stack(self.b)[:, None], 0).astype(np.float64)
        total = np.full(len(sizes), self.bias[0], np.float64)
        for i, out in enumerate(self.out):
            total += pooled[i // FILTERS, :, i % FILTERS] * np.float64(out)
        return total

    def logit(self, rows: np.ndarray) -> float:
        """The score of one text."""
        return float(self.logits(rows, np.arange(len(rows)), np.array([len(rows)]))[0])

    def gradients(self, docs: list[np.ndarray], labels: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Of the mean logistic loss, for w, b, out and bias; and embedding rows (each once) with theirs."""
        return self.slopes(*distinct(docs), labels)

    def slopes(self, forms: np.ndarray, docs: list[np.ndarray], labels: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The gradients on ``docs`` as places among ``forms``, of which the first is a blank.

        The documents' words stand one after the other, with blanks between
        that no filter sees beyond; only what a maximum came from gets a gradient.
        Each form is embedded and filtered once.
        """
        gap = max(WIDTHS) - 1
        blanks = np.zeros(gap, np.int32)
        rows = np.concatenate([part for d in docs for part in (d, blanks)])
        starts = np.cumsum([0] + [len(d) + gap for d in docs[:-1]])
        marks = np.zeros(len(forms), np.int32)
        marks[rows] = 1
        own = forms[marks > 0]
        rows = (np.cumsum(marks) - 1)[rows]
        x = self.vectors(own)
        tops = np.empty((len(docs), len(WIDTHS), FILTERS), np.int64)
        pooled = np.empty(tops.shape, np.float32)
        n = len(rows) - gap
        for k, (w, b) in enumerate(zip(self.w, self.b, strict=True)):
            y = (x @ w[0]).take(rows[:n], 0)
            for j in range(1, len(w)):
                y += (x @ w[j]).take(rows[j : j + n], 0)
            for i, (at, d) in enumerate(zip(starts, docs, strict=True)):
                tops[i, k] = at + y[at : at + len(d)].argmax(0)
            pooled[:, k] = y[tops[:, k], np.arange(FILTERS)] + b
        flat = np.maximum(pooled, 0).reshape(len(docs), -1)
        g = (1 / (1 + np.exp(-np.clip(flat @ self.out + self.bias[0], -30, 30))) - labels).astype(np.float32) / len(docs)
        back = np.where(pooled > 0, (g[:, None] * self.out).reshape(pooled.shape), 0)
        gw, where, grads = [np.zeros_like(w) for w in self.w], [], []
        for k, width in enumerate(WIDTHS):
            for j in range(width):
                at = rows[tops[:, k] + j]
                gw[k][j] = np.einsum("ife,if->ef", x[at], back[:, k])
                where.append(at.ravel())
                grads.append((self.w[k][j].T * back[:, k, :, None]).reshape(-1, DIM))
        where, grads = np.concatenate(where), np.concatenate(grads)
        of_forms = np.stack([np.bincount(where, grads[:, e], len(own)) for e in range(DIM)], 1)
        some = of_forms.any(1)
        numbers = own[some]
        found, place = np.unique(numbers, return_inverse=True)
        spread = np.repeat(of_forms[some], numbers.shape[1], 0)
        ge = np.stack([np.bincount(place.ravel(), spread[:, e], len(found)) for e in range(DIM)], 1).astype(np.float32)
        known = (found > 0) & ge.any(1)
        return [*gw, *(back[:, k].sum(0) for k in range(len(WIDTHS))), g @ flat, np.array([g.sum()], np.float32)], found[known], ge[known]

    def train(self, docs: list[np.ndarray], labels: np.ndarray, epochs: int, rate: float = 0.05, batch: int = 32) -> None:
        """Adagrad, by batches in random order."""
        rng, squares, (forms, docs) = np.random.default_rng(5), self.squares(), distinct(docs)
        for _ in range(epochs):
            self.epoch(forms, docs, labels, squares, rng, rate, batch)

    @property
    def weights(self) -> list[np.ndarray]:
        """All but the embeddings."""
        return [*self.w, *self.b, self.out, self.bias]

    def squares(self) -> list[np.ndarray]:
        """What Adagrad has summed up before the first batch: for the weights, then for the embeddings."""
        return [np.full(a.shape, 1e-6, np.float32) for a in [*self.weights, self.e]]

    def epoch(self, forms: np.ndarray, docs: list[np.ndarray], labels: np.ndarray, squares: list[np.ndarray], rng: np.random.Generator, rate: float = 0.05, batch: int = 32) -> None:
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            given, found, ge = self.slopes(forms, [docs[i] for i in chosen], labels[chosen])
            for a, s, g in zip(self.weights, squares[:-1], given, strict=True):
                s += g * g
                a -= rate * g / np.sqrt(s)
            squares[-1][found] += ge * ge
            self.e[found] -= rate * ge / np.sqrt(squares[-1][found])


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    network: Network
    shifts: dict[str, float]  #: by predicted language; "" for any other
    languages: language.LanguageModel
    taught: bool = True  #: whether there were texts of both labels to learn from

    def logits(self, texts: list[str | None]) -> np.ndarray:
        hashes, place, sizes = words([to_bytes(t) for t in texts])
        return self.network.logits(self.vocabulary.rows(hashes), place, sizes)

    def score(self, texts: list[str | None]) -> dict[str, list]:
        shifts = [self.shifts.get(v, self.shifts[""]) for v in self.languages.predict(texts)["lang_pred"]]
        p = 1 / (1 + np.exp(-np.clip(self.logits(texts) - np.array(shifts), -30, 30)))
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}


def _threshold(logits: np.ndarray, labels: np.ndarray, times: np.ndarray | None = None) -> float:
    """The logit that parts the labels with the best F1 among those that flag at most ``FLAGGED`` of the 0 labels (or one of them).

    ``times`` says how often each pair of logit and label is there. Of cuts that do equally well, the one in the widest gap; none parts equal logits.
    """
    times = np.ones(len(logits), np.int64) if times is None else times
    if not 0 < (labels * times).sum() < times.sum():
        return 0.0
    order = np.argsort(logits, kind="stable")
    z, y, n = logits[order], (labels * times)[order], times[order]
    cuts = np.r_[z[0] - 1, (z[1:] + z[:-1]) / 2, z[-1] + 1]
    hits = y.sum() - np.r_[0, np.cumsum(y)]
    flagged = n.sum() - np.r_[0, np.cumsum(n)]
    gaps = np.r_[1.0, np.diff(z), 1.0]
    f1 = np.where(((flagged - hits) <= max(1, FLAGGED * (n.sum() - y.sum()))) & (gaps > 0), 2 * hits / (flagged + y.sum()), -1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cuts[best[np.argmax(gaps[best])]])


def _counted(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes in ``texts``, the number of texts that have each, and the number of those of label 1."""
    hashes, place, sizes = words([to_bytes(t) for t in texts])
    known, column = np.unique(hashes, return_inverse=True)
    text, word = np.divmod(np.unique(np.repeat(np.arange(len(texts)), sizes) * len(hashes) + place), max(1, len(hashes)))
    text, own = np.divmod(np.unique(text[:, None] * len(known) + column.reshape(hashes.shape)[word]), max(1, len(known)))
    return known, np.bincount(own, minlength=len(known)).astype(float), np.bincount(own, labels[text], len(known))


def _total(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What some counts add up to."""
    known, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return known, *(np.bincount(place, np.concatenate([p[i] for p in parts]), len(known)) for i in (1, 2))


_NOTHING = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)


def _leaning(n: np.ndarray, toxic: np.ndarray, both: list[int]) -> np.ndarray:
    """How far hashes' shares of the labels differ, in standard errors; ``both`` has the number of texts of either label."""
    both = [max(1, x) for x in both]
    p = n / sum(both)
    return (toxic / both[1] - (n - toxic) / both[0]) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / both[0] + 1 / both[1]))


def _frequent(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of at least ``LEAST_DOCS`` texts by falling number of texts, and their leaning; counted some texts at a time."""
    known, n, toxic = _total([_NOTHING, *(_counted(texts[at : at + 100], labels[at : at + 100]) for at in range(0, len(texts), 100))])
    often = np.flatnonzero((n >= LEAST_DOCS) & (known > 0))
    often = often[np.argsort(-n[often], kind="stable")][:ROWS]
    return known[often], _leaning(n[often], toxic[often], [(labels == v).sum() for v in (0, 1)])


def fit(sample: list[tuple[str, int]], languages: language.LanguageModel, epochs: int = EPOCHS) -> ToxicityModel:
    """Trains on a few (text, 0 or 1) pairs, here and now; every fourth is left out of training and sets the thresholds."""
    texts, labels = [t for t, _ in sample], np.array([int(y) for _, y in sample])
    train = [i for i in range(len(sample)) if i % 4] or list(range(len(sample)))
    known, leaning = _frequent([texts[i] for i in train], labels[train]) if train else (np.zeros(0, np.uint64), np.zeros(0))
    vocabulary, network = Vocabulary(known), Network(leaning)
    docs = [near(vocabulary.rows(features(to_bytes(t)))) for t in texts]
    taught = 0 < labels[train].sum() < len(train)
    blank = near(vocabulary.rows(features(b"")))
    if taught:
        # some empty texts among the clean ones: what the network does not know, other languages too, counts as clean
        empty = [blank] * -(-len(train) // BLANKS)
        network.train([docs[i] for i in train] + empty, np.r_[labels[train], np.zeros(len(empty))].astype(np.float32), epochs)
    model = ToxicityModel(vocabulary, network, {"": 0.0}, languages, bool(taught))
    held = [i for i in range(len(sample)) if not i % 4]
    logits = np.array([network.logit(docs[i]) for i in held])
    named = np.array(languages.predict([texts[i] for i in held])["lang_pred"])
    floor = network.logit(blank) + 0.1 if taught else -np.inf
    model.shifts[""] = max(floor, _threshold(logits, labels[held]))
    for name in sorted(set(map(str, named))):
        own = named == name
        if labels[held][own].sum() >= 8 and (1 - labels[held][own]).sum() >= 8:
            model.shifts[name] = max(floor, _threshold(logits[own], labels[held][own]))
    return model


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows of ``docs`` (doc_id, text, lang) that ``labels`` (doc_id, value) mark, as h, text, lang, value.

    An id is learned once however often it is labelled (with the least of its values), by one
    of its texts, the one of the smallest hash. Null values, ids and texts take no part. ``h`` is the id's hash.
    """
    labels = labels.where("doc_id is not null and value is not null").groupBy("doc_id").agg(F.min("value").alias("value"))
    wanted = sieve(labels.select(F.xxhash64("doc_id").alias("key")))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("doc_id is not null and text is not null")
    own = docs.where(wanted(F.xxhash64("doc_id"))).groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("t"), "text", "lang")).alias("own"))
    return own.join(labels, "doc_id").select(F.xxhash64(F.lit("toxicity"), "doc_id").alias("h"), "own.text", "own.lang", "value")


def _words(rows: DataFrame) -> DataFrame:
    """Of all ``rows`` (text, value): hash, n and toxic, the texts that have a word or prefix and those of label 1 among them, added up by task and then by a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, merged = [_NOTHING], 0, 0  # entries in all, and in the first, which is merged

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(parts[0][0].view(np.int64)), *[pa.array(x.astype(np.int64)) for x in parts[0][1:]]], names=["hash", "n", "toxic"])

        for batch in small_batches(batches, "text"):
            texts, labels = batch.column("text").to_pylist(), batch.column("value").to_numpy()
            for at in range(0, len(texts), 100):
                parts.append(_counted(texts[at : at + 100], labels[at : at + 100]))
                size += len(parts[-1][0])
                if size > merged + FLUSH:
                    parts = [_total(parts)]
                    size = merged = len(parts[0][0])
                    if merged > FLUSH:
                        yield out()
                        parts, size, merged = [_NOTHING], 0, 0
        parts = [_total(parts)]
        yield out()

    counts = rows.select("text", "value").mapInArrow(run, "hash long, n long, toxic long")
    return counts.where("hash <> 0").groupBy("hash").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _languages(rows: DataFrame) -> language.LanguageModel:
    """A naive Bayes model of all ``rows`` (text, lang) by the hashed character n-grams of operator 7."""
    rows = rows.where("lang is not null").select("lang", "text")
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        warnings.warn(f"more than {LANGUAGES} languages: only the most frequent are told apart", stacklevel=2)
    prior = {r.lang: r.n for r in found[:LANGUAGES]}
    classes = sorted(prior)
    if not classes:
        return language.LanguageModel([], np.zeros((language.BUCKETS, 0)), np.zeros(0))
    buckets = min(language.BUCKETS, 1 << (language.CELLS // len(classes)).bit_length() - 1)
    place = {v: i for i, v in enumerate(classes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(classes), buckets), np.int64)
        for batch in small_batches(batches, "text"):
            found: dict = {}  # of a batch, so no more than some times its texts
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if lang in place and language.has_letter(text):
                    for g in language.grams(text):
                        if len(g) > buckets:
                            total[place[lang]] += np.bincount(g & np.uint32(buckets - 1), minlength=buckets)
                        else:
                            found.setdefault(lang, []).append(g)
            for lang, own in found.items():
                total[place[lang]] += np.bincount(np.concatenate(own) & np.uint32(buckets - 1), minlength=buckets)
        yield pa.record_batch([pa.array([_packed(total)], pa.binary())], names=["total"])

    counts = _added(rows.mapInArrow(run, "total binary"), lambda a, b: a + b)
    counts = (np.zeros((len(classes), buckets)) if counts is None else counts) + 0.1
    table = np.log(counts / counts.sum(1, keepdims=True)).T
    return language.LanguageModel(classes, table - table.mean(1, keepdims=True), np.log([prior[v] / sum(prior.values()) for v in classes]))


def _packed(x) -> bytes:
    return zlib.compress(pickle.dumps(x, 5), 1)


def _unpacked(x: bytes):
    return pickle.loads(zlib.decompress(x))


def _added(parts: DataFrame, add):
    """What all rows of ``parts`` (one column, from ``_packed``) add up to, in a tree of tasks; None of no rows."""
    own = parts.rdd.map(lambda r: bytes(r[0]))
    return _unpacked(own.treeReduce(lambda a, b: _packed(add(_unpacked(a), _unpacked(b))), depth=3)) if own.getNumPartitions() else None


def _shards(rows: DataFrame, vocabulary: Vocabulary, n: int) -> DataFrame:
    """All ``rows`` (h, text, value) as row numbers of words, in shards of about ``SHARD`` rows: one row (shard, pack) each, or some for a shard of long texts."""
    shared, shards = rows.sparkSession.sparkContext.broadcast(vocabulary), max(1, -(-n // SHARD))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            hashes, place, sizes = words([to_bytes(t) for t in batch.column("text").to_pylist()])
            known = shared.value.rows(hashes)
            numbers = [near(known[own]) for own in np.split(place, np.cumsum(sizes[:-1]))]
            packs = [zlib.compress(x.astype(np.uint16).tobytes(), 1) for x in numbers]
            yield pa.record_batch([batch.column("shard"), batch.column("h"), batch.column("value"), pa.array(packs, pa.binary())], names=["shard", "h", "value", "numbers"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, labels, total = None, [], [], 0  # parts: forms and the documents made of them

        def out() -> pa.RecordBatch:
            forms, places = distinct([f for f, _ in parts])
            docs = [at[d] for at, (_, docs) in zip(places, parts, strict=True) for d in docs]
            pack = _packed((forms, np.concatenate(docs), [len(d) for d in docs], labels))
            return pa.record_batch([pa.array([own], pa.int64()), pa.array([pack], pa.binary())], names=["shard", "pack"])

        for batch in small_batches(batches, "numbers", PACK):
            docs = []
            for shard, value, numbers in zip(batch.column("shard").to_pylist(), batch.column("value").to_pylist(), batch.column("numbers").to_pylist(), strict=True):
                size = len(numbers := zlib.decompress(numbers))
                if labels and (shard != own or total + size > SHARD_BYTES):
                    if docs:
                        parts.append(distinct(docs))
                    yield out()
                    parts, docs, labels, total = [], [], [], 0
                own, total = shard, total + size
                docs.append(np.frombuffer(numbers, np.uint16).reshape(-1, 1 + len(PREFIXES)))
                labels.append(value)
            if docs:
                parts.append(distinct(docs))
        if parts:
            yield out()

    rows = rows.select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), "h", "text", "value")
    numbers = rows.mapInArrow(encode, "shard long, h long, value int, numbers binary")
    return numbers.repartition(shards, "shard").sortWithinPartitions("shard", "h").mapInArrow(pack, "shard long, pack binary")


def _merge(a: tuple, b: tuple) -> tuple:
    """Sums of two parts: shards, of weights and their squares, and of the embeddings that had a gradient."""
    rows, place = np.unique(np.r_[a[2], b[2]], return_inverse=True)
    sums = []
    for x, y in zip(a[3], b[3], strict=True):
        total = np.zeros((len(rows), *x.shape[1:]), np.int64)
        total[place[: len(x)]] += x
        total[place[len(x) :]] += y
        sums.append(total)
    return a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)], rows, sums


def _fixed(x: np.ndarray) -> np.ndarray:
    return np.rint(x.astype(np.float64) * FIXED).astype(np.int64)


def _trained(shards: DataFrame, network: Network, blank: np.ndarray, epochs: int) -> Network:
    """``network`` after ``epochs`` over all shards: each trains a copy for an epoch, then weights are averaged, embeddings over the shards that changed them."""
    spark, squares = shards.sparkSession, network.squares()
    for epoch in range(epochs):
        shared = spark.sparkContext.broadcast((network, squares))

        def run(batches: Iterator[pa.RecordBatch], epoch=epoch, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    forms, docs, sizes, labels = _unpacked(batch.column("pack")[i].as_py())
                    docs = np.split(docs, np.cumsum(sizes[:-1]))
                    empty = -(-len(docs) // BLANKS)  # what the network does not know, other languages too, counts as clean
                    own, sums = pickle.loads(pickle.dumps(shared.value, 5))
                    before = sums[-1].copy()
                    own.epoch(forms, docs + [np.zeros(len(blank), np.int32)] * empty, np.r_[labels, np.zeros(empty)].astype(np.float32), sums, np.random.default_rng([5, epoch, batch.column("shard")[i].as_py()]))
                    rows = np.flatnonzero((sums[-1] != before).any(1))
                    got = 1, [_fixed(x) for x in [*own.weights, *sums[:-1]]], rows, [np.ones(len(rows), np.int64), _fixed(own.e[rows]), _fixed(sums[-1][rows])]
                    yield pa.record_batch([pa.array([_packed(got)], pa.binary())], names=["sums"])

        n, dense, rows, (times, e, of_rows) = _added(shards.mapInArrow(run, "sums binary"), _merge)
        half = len(dense) // 2
        for x, total in zip([*network.weights, *squares[:-1]], dense[:half] + dense[half:], strict=True):
            x[...] = total / n / FIXED
        network.e[rows], squares[-1][rows] = e / times[:, None] / FIXED, of_rows / times[:, None] / FIXED
        shared.destroy()
    return network


def _shifts(rows: DataFrame, model: ToxicityModel, floor: float) -> dict[str, float]:
    """The thresholds on all ``rows`` (text, value), over all and by predicted language, from counts of their logits."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            z = np.rint(np.clip(shared.value.logits(texts), -30, 30) * GRID).astype(np.int64)
            yield pa.record_batch([pa.array(shared.value.languages.predict(texts)["lang_pred"], pa.string()), pa.array(z), batch.column("value")], names=["lang", "z", "value"])

    counted = rows.select("text", "value").mapInArrow(run, "lang string, z long, value int").groupBy("lang", "z", "value").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "z", "value").collect()
    lang, z, y, n = np.array([r.lang for r in counted]), np.array([r.z for r in counted]) / GRID, np.array([r.value for r in counted], np.int64), np.array([r.n for r in counted], np.int64)
    shifts = {"": max(floor, _threshold(z, y, n))}
    for name in sorted(set(map(str, lang))):
        own = lang == name
        if (y * n)[own].sum() >= 8 and ((1 - y) * n)[own].sum() >= 8:
            shifts[name] = max(floor, _threshold(z[own], y[own], n[own]))
    return shifts


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, epochs: int = EPOCHS) -> ToxicityModel:
    """Learns from all labels (doc_id, value) and languages of rows whose crc32(doc_id) mod ``folds`` is not ``held``.

    A fourth of the rows, by a hash of their ids, is left out of training and sets
    the thresholds; where the others lack a label, all train and set them.
    """
    bounded_arrow(docs.sparkSession)
    rows = keep(labelled_rows(docs, labels.where(fold_of(F.col("doc_id"), folds) != held)), "toxicity-rows")
    spared = F.pmod("h", F.lit(4)) == 0
    count = {(r.spared, r.value): r.n for r in rows.groupBy(spared.alias("spared"), "value").agg(F.count(F.lit(1)).alias("n")).collect()}
    both = [count.get((False, v), 0) for v in (0, 1)]
    train, rest = rows.where(~spared), rows.where(spared)
    if not all(both):
        train, rest, both = rows, rows, [count.get((False, v), 0) + count.get((True, v), 0) for v in (0, 1)]
    languages = _languages(rows)
    if not all(both):
        forget(rows)
        return ToxicityModel(Vocabulary(_NOTHING[0]), Network(np.zeros(0)), {"": 0.0}, languages, False)
    often = _words(train).where(F.col("n") >= LEAST_DOCS).orderBy(F.desc("n"), "hash").limit(ROWS).collect()
    vocabulary = Vocabulary(np.array([r.hash for r in often], np.int64).view(np.uint64))
    network = Network(_leaning(np.array([r.n for r in often], float), np.array([r.toxic for r in often], float), both))
    blank = near(vocabulary.rows(features(b"")))
    shards = keep(_shards(train, vocabulary, sum(both)), "toxicity-shards")
    model = ToxicityModel(vocabulary, _trained(shards, network, blank, epochs), {"": 0.0}, languages)
    forget(shards)
    model.shifts = _shifts(rest, model, network.logit(blank) + 0.1)
    forget(rows)
    return model


def apply(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows`` (doc_id, held_out, text) to doc_id, held_out, score, predicted."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    return score_rows(rows, lambda texts: shared.value.score(texts), "score double, predicted int", {"score": pa.float64(), "predicted": pa.int32()})


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    value: Column = F.col("value").cast("int")
    return only(labels, doc_id="doc_id", value=column).select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("value"))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, score, predicted (score >= 0.5).

    Learns from all ``labels`` (doc_id, toxic) outside the held fold. Every row is
    kept, repeated ones too. Null and empty texts get the score of a text
    without known words; without labels every score is about a half; a null doc_id
    is not held out and never learned from; an empty table gives an empty
    result; other columns are ignored.
    """
    bounded_arrow(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text", lang="lang").withColumn("doc_id", F.col("doc_id").cast("long"))
    model = learn(rows, labels_of(labels, "toxic"), folds, held)
    return apply(rows.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "text"), model)
