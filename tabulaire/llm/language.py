"""Operator 7: language identification.

Sparse multinomial logistic regression on TF-IDF character n-grams: trained by
follow-the-regularised-leader with elastic-net penalties, then calibrated by a
temperature. The model is fitted on a bounded, balanced sample of labelled
rows; whole texts are scored in the executors, a batch of texts at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_arrow, fold_of, only
from .words import labelled_sample, score_rows

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16  #: of n-grams; fewer for more than 128 languages, so that a model has
CELLS = 1 << 23  #: so many weights at most
SAMPLE = 4000  #: labelled rows to learn from, at most
SCALE = 50.0  #: what relative frequencies are multiplied by
SLICE = 1 << 20  #: characters of a text that are hashed at once
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def lowered(text: str) -> np.ndarray:
    """Code points of a text in lower case, character by character (so the two small sigmas are one)."""
    return np.frombuffer(text.lower().replace("ς", "σ").encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all character n-grams of a text between two blanks, lower-cased; very long texts slice by slice, no n-gram lost or added."""
    carried = 0  # code points of the slice before that the next one begins with
    c = np.zeros(0, np.uint32)
    for at in range(0, len(text) or 1, SLICE):
        part = text if len(text) <= SLICE else text[at : at + SLICE]
        new = lowered(f"{' ' if not at else ''}{part}{' ' if at + SLICE >= len(text) else ''}")
        c = np.concatenate([c[len(c) - carried :], new]) if at else new
        out = []
        with np.errstate(over="ignore"):
            for n in ORDERS:
                # those that end in what is new
                own = c[max(0, carried - (n - 1)) :]
                if len(own) >= n:
                    h = np.full(len(own) - n + 1, n, np.uint32)
                    for j in range(n):
                        h ^= own[j : len(own) - n + 1 + j]
                        h *= _MULTIPLY[j]
                        h ^= h >> np.uint32(15)
                    h &= np.uint32(BUCKETS - 1)
                    out.append(h)
        carried = min(len(c), max(ORDERS) - 1)
        yield np.concatenate(out)


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_LETTER.search(text))


class LanguageModel:
    """Classes and, per bucket and class, idf times weight, temperature included. Of classes that tie the first by name is predicted."""

    def __init__(self, classes: list[str], table: np.ndarray, bias: np.ndarray):
        self.classes, self.table, self.bias = classes, table.astype(np.float32), bias

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.classes)), 0
        buckets = len(self.table)
        for g in grams(text):
            if buckets < BUCKETS:
                g &= np.uint32(buckets - 1)
            if len(g) > buckets // 2:
                total += np.bincount(g, minlength=buckets).astype(np.float32) @ self.table
            else:
                total += self.table[g].sum(0)
            n += len(g)
        return total * (SCALE / n) + self.bias

    def predict(self, texts: list[str | None]) -> dict[str, list]:
        langs, scores = [], []
        for text in texts:
            if not has_letter(text) or not self.classes:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            z = self.logits(text)
            p = np.exp(z - z.max())
            langs.append(self.classes[int(z.argmax())])
            scores.append(float(p.max() / p.sum()))
        return {"lang_pred": langs, "score": scores}


def fit(sample: list[tuple[str, str]], epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-2) -> LanguageModel:
    """Trains on (text, language) pairs; every fifth pair is left out of training and sets the temperature."""
    sample = [(t, y) for t, y in sample if has_letter(t)]
    classes = sorted({y for _, y in sample})
    if not classes:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0))
    buckets = min(BUCKETS, 1 << (CELLS // len(classes)).bit_length() - 1)
    docs = []
    for text, _ in sample:
        counts = sum(np.bincount(g & np.uint32(buckets - 1), minlength=buckets) for g in grams(text))
        f = np.flatnonzero(counts)
        docs.append((f.astype(np.uint16), (counts[f] / counts.sum() * SCALE).astype(np.float32)))
    df = np.zeros(buckets)
    for f, _ in docs:
        df[f] += 1
    idf = np.log((1 + len(docs)) / (1 + df)) + 1
    place = {v: i for i, v in enumerate(classes)}
    y = np.array([place[v] for _, v in sample])
    train = [i for i in range(len(docs)) if i % 5] or list(range(len(docs)))
    held = [i for i in range(len(docs)) if not i % 5]
    z, n = np.zeros((buckets + 1, len(classes))), np.zeros((buckets + 1, len(classes)))

    def weights(f: np.ndarray) -> np.ndarray:
        # the elastic net in closed form: small sums of gradients leave a weight at exactly 0
        return np.where(np.abs(z[f]) <= l1, 0.0, -(z[f] - np.sign(z[f]) * l1) / ((beta + np.sqrt(n[f])) / alpha + l2))

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(train):
            f = np.append(docs[i][0].astype(np.int64), buckets)  # the last is the bias
            x = np.append(docs[i][1] * idf[docs[i][0]], 1.0)
            w = weights(f)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = x[:, None] * p
            z[f] += g - (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / alpha * w
            n[f] += g * g
    w = weights(np.arange(buckets + 1))
    scores = np.array([(docs[i][1] * idf[docs[i][0]]) @ w[docs[i][0]] + w[buckets] for i in held]).reshape(len(held), len(classes))

    def loss(t: float) -> float:
        s = scores / t
        return float(np.mean(np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(held)), y[held]]))

    t = min(np.geomspace(0.05, 20, 121), key=loss) if held else 1.0
    return LanguageModel(classes, w[:buckets] * idf[:, None] / t, w[buckets] / t)


def learn(docs: DataFrame, may_learn: Column, most_rows: int = SAMPLE) -> LanguageModel:
    """Fits on at most ``most_rows`` of the rows (doc_id, text, lang) where ``may_learn`` holds."""
    labels = docs.where(may_learn).select("doc_id", F.col("lang").alias("value"))
    return fit(labelled_sample(docs, labels, most_rows, "language"))


def apply(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """``rows`` (doc_id, held_out, text) to doc_id, held_out, lang_pred, score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    score: Callable = lambda texts: shared.value.predict(texts)
    return score_rows(rows, score, "lang_pred string, score double", {"lang_pred": pa.string(), "score": pa.float64()})


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Learns from rows with a language whose crc32(doc_id) mod ``folds`` is not
    ``held``. Every row is kept, repeated ones too. A null text or one without
    a letter is ``und`` with score 0, as is every text where nothing could be
    learned; of languages that tie the first by name is taken; a null doc_id is
    not held out and never learned from; an empty table gives an empty result;
    other columns are ignored. Every language of the labels is learned, unless
    there are more than rows in the sample: then the most frequent, with a warning.
    """
    bounded_arrow(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text", lang="lang").withColumn("doc_id", F.col("doc_id").cast("long"))
    fold = fold_of(F.col("doc_id"), folds)
    model = learn(rows, fold != held)
    return apply(rows.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "text"), model)
