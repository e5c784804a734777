r"""Quality scores by positive-unlabelled learning.

Trusted positives are documents whose labels all say 1; the unlabelled are documents of any kind, whatever their label. Labels of 0 are never used. The class prior, the share of good documents
among the unlabelled, is estimated by the best bin of a positive-against-unlabelled classifier: above a score, the share of the unlabelled over that of the positives bounds the prior from
above, and the least such bound (with its margin for chance) is taken. The classifier then minimises the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss, so that its output is a probability; where the bracket is negative, its gradient is reversed.

A text's features are its whole bytes' pairs of character classes, hashed byte triples, and a few figures of words and lines. The fit is on a sample of SAMPLE positives and SAMPLE
unlabelled documents at most (expected; taken by hash, not in the held-out fold), the only bounded part; every document is scored, whole.

Defined cases: a null or empty text has zero features and is scored; a null doc_id is scored and lies in the fold of the empty string; repeated rows are scored each; of several labels the least counts;
without trusted positives all scores are 0.5; an empty table gives an empty result; very long texts are read in pieces of PIECE bytes; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, utf8

#: Positives, and unlabelled documents, in the sample that the model is fitted on, in expectation.
SAMPLE = 6000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Buckets of hashed byte triples; bytes read at once.
BUCKETS, PIECE = 512, 1 << 20
_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\v\f\r", b".", b",", b"!?;:", b"'\"()-", b"#*$%&|<>", bytes(range(128, 256)))
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _k, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _k
_CLASSES = len(_GROUPS) + 1
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64)
_FIGURES = 7
SIZE = _CLASSES * _CLASSES + BUCKETS + _FIGURES


def _figures(text: bytes) -> np.ndarray:
    """Words, their bytes, repeats of the word before, different words, lines, different lines, words in capitals: sums over pieces cut at blanks."""
    out, at = np.zeros(_FIGURES), 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            found = text.find(b" ", end)
            end = found if found >= 0 else len(text)
        part = text[at:end]
        words, lines = part.split(), part.split(b"\n")
        out += len(words), sum(map(len, words)), sum(map(eq, words[1:], words)), len(set(words)), len(lines), len(set(lines)), sum(map(bytes.isupper, words))
        at = end
    return out


def _counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of character classes and hashed triples of bytes, counted."""
    pairs, triples = np.zeros(_CLASSES * _CLASSES), np.zeros(BUCKETS)
    for at in range(0, len(text), PIECE):
        raw = np.frombuffer(text[at : at + PIECE + 2], np.uint8)  # two bytes more, so that nothing is lost between pieces
        kind = _CLASS[raw[: PIECE + 1]]
        pairs += np.bincount(kind[:-1] * _CLASSES + kind[1:], minlength=len(pairs))
        low = _LOWER[raw]
        if len(low) > 2:
            mixed = (low[:-2] << np.uint64(16) | low[1:-1] << np.uint64(8) | low[2:]) * np.uint64(0x9E3779B97F4A7C15)
            triples += np.bincount((mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), minlength=BUCKETS)
    return pairs, triples


def features(texts: list[bytes]) -> np.ndarray:
    """A row of SIZE numbers a text: square roots of shares, and scaled figures."""
    out = np.zeros((len(texts), SIZE), np.float32)
    for i, text in enumerate(texts):
        if text:
            pairs, triples = _counted(text)
            n, chars, stutter, kinds, lines, line_kinds, capitals = _figures(text)
            words = max(1.0, n)
            out[i, : len(pairs)] = np.sqrt(pairs / len(text))
            out[i, len(pairs) : -_FIGURES] = np.sqrt(triples / len(text))
            out[i, -_FIGURES:] = np.log1p(n) / 10, np.log1p(chars / words) / 3, stutter / words, kinds / words, np.log1p(words / max(1.0, lines)) / 5, line_kinds / max(1.0, lines), capitals / words
    return out


# ---- the fit ----


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scaled(x).astype(np.float64) @ self.weights + self.bias)


def _adam(size: int, gradient, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w.astype(np.float32)).astype(float)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk of outputs on positives and unlabelled: prior * R_p(+), and R_u(-) - prior * R_p(-), which must not be negative."""
    return prior * float(_softplus(-zp).mean()), float(_softplus(zu).mean()) - prior * float(_softplus(zp).mean())


def minimise(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 300, rate: float = 0.02, ridge: float = 1e-3) -> np.ndarray:
    """Weights (the bias last) of least non-negative risk."""
    p, u = (np.hstack([x, np.ones((len(x), 1), x.dtype)]) for x in (p, u))

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        good = -prior * ((1 - _sigmoid(zp)) @ p) / len(p)
        rest = _sigmoid(zu) @ u / len(u) - prior * (_sigmoid(zp) @ p) / len(p)
        bad = risk(zp, zu, prior)[1] < 0
        return (-rest if bad else good + rest) + ridge * np.append(w[:-1], 0)

    return _adam(p.shape[1], gradient, steps, rate)


def against(p: np.ndarray, u: np.ndarray, steps: int = 150, rate: float = 0.02, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a classifier that tells positives from unlabelled."""
    p, u = (np.hstack([x, np.ones((len(x), 1), x.dtype)]) for x in (p, u))

    def gradient(w: np.ndarray) -> np.ndarray:
        return (_sigmoid(u @ w) @ u / len(u) - (1 - _sigmoid(p @ w)) @ p / len(p)) + ridge * np.append(w[:-1], 0)

    return _adam(p.shape[1], gradient, steps, rate)


def class_prior(p: np.ndarray, u: np.ndarray, confidence: float = 0.5) -> float:
    """Share of positives among the unlabelled by the best bin of scores that were not fitted on."""
    order = np.sort(np.concatenate([p, u]))[::-1]
    share = lambda x: (len(x) - np.searchsorted(np.sort(x), order, side="left")) / len(x)
    qp, qu = share(p), share(u)
    margin = np.sqrt(np.log(4 / confidence) / (2 * len(p))) + np.sqrt(np.log(4 / confidence) / (2 * len(u)))
    at = int(np.argmin(np.where(qp > 0, (qu + margin) / np.maximum(qp, 1e-12), np.inf)))
    return float(np.clip(qu[at] / qp[at], 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model of two samples' features. The prior is estimated on scores of either half by the classifier of the other."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(SIZE), np.ones(SIZE), np.zeros(SIZE), 0.0, 0.5)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    raw = Model(mean, scale, np.zeros(SIZE), 0.0, 0.5)
    p, u = raw.scaled(positive), raw.scaled(unlabelled)
    halves = [(x[k::2] if len(x) > 1 else x) for k in range(2) for x in (p, u)]
    tested = []
    for seen_p, seen_u, new_p, new_u in ((*halves[:2], *halves[2:]), (*halves[2:], *halves[:2])):
        w = against(seen_p, seen_u)
        tested.append((new_p @ w[:-1] + w[-1], new_u @ w[:-1] + w[-1]))
    prior = class_prior(*(np.concatenate(x) for x in zip(*tested, strict=True)))
    w = minimise(p, u, prior)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


# ---- on Spark ----


def held_out(column: Column) -> Column:
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def trusted(labels: DataFrame) -> DataFrame:
    """doc_id of the documents outside the held-out fold whose labels all say 1."""
    learned = labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return learned.filter("quality = 1 and doc_id is not null").select("doc_id")


def samples(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features of some ``most`` positives and as many unlabelled documents, taken by hash outside the held-out fold."""
    good = trusted(labels)
    learned = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text")
    n_good, n_all = good.count(), learned.count()
    width = 1 << 32
    draw = lambda seed: F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(width))
    cut = lambda n: min(width, width * most // max(n, 1))
    picked = good.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(width)) < cut(n_good))
    marked = learned.join(small(picked.withColumn("good", F.lit(True)), 64), "doc_id", "left").withColumn("other", draw(5) < cut(n_all)).filter("good or other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(utf8(batch.column("text"))).astype(np.float16)
            yield pa.RecordBatch.from_pydict({k: batch.column(k) for k in ("key", "good", "other")} | {"x": pa.array([r.tobytes() for r in x], pa.binary())})

    out = marked.select(F.xxhash64("doc_id", "text").alias("key"), F.coalesce("good", F.lit(False)).alias("good"), "other", "text").mapInArrow(run, "key long, good boolean, other boolean, x binary").toArrow()
    order = np.argsort(out.column("key").to_numpy(), kind="stable")  # reruns fit the same rows in the same order
    x = np.frombuffer(b"".join(out.column("x").to_pylist()), np.float16).reshape(-1, SIZE)[order].astype(np.float32)
    return tuple(x[out.column(k).to_numpy()[order]] for k in ("good", "other"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, made = utf8(batch.column("text")), []
            for at in range(0, len(texts), 512):
                made.append(np.round(model.score(features(texts[at : at + 512])), 9))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(np.concatenate(made) if made else [], pa.float64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = scored(docs, fit(*samples(docs, labels, most)))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
