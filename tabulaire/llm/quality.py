"""Operator 10: quality, by votes of the nearest labelled neighbours in a latent-semantic space.

TF-IDF of hashed trigrams, of a text's bytes and of its words' first bytes, is
reduced by a truncated singular value decomposition of a bounded labelled
sample. The sample's unit vectors are broadcast; every document's cosines with
all of them are computed exactly, in blocks, and its nearest neighbours vote
with weights that grow with similarity. Nothing but the cosines decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_arrow, fold_of, only
from .toxicity import labels_of
from .words import labelled_sample, score_rows, to_bytes

BUCKETS = 1 << 13
TERMS = 2 * BUCKETS  #: trigrams of bytes, then of words' first bytes
RANK = 48
SAMPLE = 4000  #: labelled rows, so 4000 vectors of 48 floats (0.8 MB) are broadcast at most
NEIGHBOURS = 15
SHARPNESS = 8.0  #: a neighbour's weight is its similarity to this power
PLACES = 5  #: decimals of similarities; equal ones are ties
LEAST = 1.5e-6  #: length that a text must keep in the latent space to have a direction there
BLOCK = 256  #: documents whose cosines are computed at once
SLICE = 1 << 20

_GAP = np.zeros(256, bool)
_GAP[list(b" \t\n\r")] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def counts(raw: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of a whole text."""
    total = np.zeros(BUCKETS)
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    for at in range(0, max(1, len(b) - 2), SLICE):
        c = b[at : at + SLICE + 2]
        with np.errstate(over="ignore"):
            h = (c[:-2] << np.uint32(16) | c[1:-1] << np.uint32(8) | c[2:]) * np.uint32(0x9E3779B1)
        total += np.bincount(h >> np.uint32(32 - 13), minlength=BUCKETS)
    return total


def initials(raw: bytes) -> bytes:
    """The first byte of each run of bytes without blanks, A-Z lower-cased."""
    b = np.frombuffer(raw, np.uint8)
    word = ~_GAP[b]
    return _LOWER[b[word & np.r_[True, ~word[:-1]]]].tobytes() if len(b) else b""


@dataclass
class QualityModel:
    basis: np.ndarray  #: idf times right singular vectors, (terms, rank)
    vectors: np.ndarray  #: unit vectors of labelled texts
    labels: np.ndarray
    rate: float  #: share of label 1: the score of a text that is near to nothing

    def vectorise(self, texts: list[str | None]) -> np.ndarray:
        """Unit vectors; of texts without a term of the sample, or so little of one that its direction is rounding, zeros."""
        x = _tf(texts) @ self.basis
        # a text's terms are two parts of unit length, or one, or none
        return _unit(x * (np.linalg.norm(x, axis=1) > LEAST)[:, None])

    def score(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        p = np.full(len(texts), self.rate)
        for at in range(0, len(texts) if len(self.labels) else 0, BLOCK):
            own = self.vectorise(texts[at : at + BLOCK])
            near = np.round(own @ self.vectors.T, PLACES)
            k = min(NEIGHBOURS, near.shape[1])
            last = np.partition(near, -k, axis=1)[:, -k, None]
            # neighbours as near as the last one share the places that nearer ones leave
            above, tied = near > last, near == last
            share = above + tied * ((k - above.sum(1)) / tied.sum(1))[:, None]
            weight = np.maximum(near, 1e-3) ** SHARPNESS * share
            p[at : at + BLOCK] = np.where(own.any(1), (weight @ self.labels) / weight.sum(1), self.rate)
        p = np.clip(p, 0, 1)
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}


def terms(text: str | None) -> np.ndarray:
    """A text's trigrams by the logarithm of their counts, those of bytes and those of initials in unit length each."""
    raw, out = to_bytes(text), np.zeros(TERMS, np.float32)
    for at, part in ((0, raw), (BUCKETS, initials(raw))):
        n = np.log1p(counts(part))
        if n.any():
            out[at : at + BUCKETS] = n / np.linalg.norm(n)
    return out


def _tf(texts: list[str | None]) -> np.ndarray:
    out = np.empty((len(texts), TERMS), np.float32)
    for i, text in enumerate(texts):
        out[i] = terms(text)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(sample: list[tuple[str, int]], rate: float = 0.5, rank: int = RANK) -> QualityModel:
    """The decomposition (by random projection and two power iterations) and the labelled vectors of (text, 0 or 1) pairs."""
    if not sample:
        return QualityModel(np.zeros((TERMS, rank), np.float32), np.zeros((0, rank), np.float32), np.zeros(0), rate)
    x = _tf([t for t, _ in sample])
    there = np.count_nonzero(x, axis=0)
    idf = (np.log((1 + len(x)) / (1 + there)) + 1).astype(np.float32)
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    q = np.random.default_rng(3).normal(size=(TERMS, min(rank + 10, len(x)))).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(x.T @ np.linalg.qr(x @ q)[0])
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    directions = (q @ v.T)[:, :rank].astype(np.float32)
    directions[there == 0] = 0  # terms that no text of the sample has
    return QualityModel(idf[:, None] * directions, _unit(x @ directions), np.array([int(y) for _, y in sample], float), rate)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, most_rows: int = SAMPLE) -> QualityModel:
    """Fits on labels (doc_id, value) of rows whose crc32(doc_id) mod ``folds`` is not ``held``; the rate is that of all these labels."""
    known = labels.where(fold_of(F.col("doc_id"), folds) != held)
    rate = known.agg(F.avg("value")).first()[0]
    return fit(labelled_sample(docs, known, most_rows, "quality"), 0.5 if rate is None else float(rate))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted (score >= 0.5).

    Learns from ``labels`` (doc_id, quality) outside the held fold. Every row
    is kept, repeated ones too. Null and empty texts, and those of less than
    three bytes, have no trigrams and get the share of label 1 among the
    labels, as does any text that shares no term with the sample; without
    labels every score is 0.5. Neighbours of equal similarity (to ``PLACES``
    decimals) beyond the last place share it, so the order of the labelled
    texts has no effect. A null doc_id is not held out and never learned from;
    an empty table gives an empty result; other columns are ignored.
    """
    bounded_arrow(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    shared = docs.sparkSession.sparkContext.broadcast(learn(rows, labels_of(labels, "quality"), folds, held))
    rows = rows.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "text")
    return score_rows(rows, lambda texts: shared.value.score(texts), "score double, predicted int", {"score": pa.float64(), "predicted": pa.int32()})
