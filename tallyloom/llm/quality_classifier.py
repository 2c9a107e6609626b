"""A quality classifier from trusted positives and unlabelled text, by non-negative unbiased risk."""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import by_batch, keep_rows, pick, stored

#: Marks of the form of a text; each is spread over hat functions at these knots.
KNOTS = {
    "log_words": (0, 1, 2, 3, 4, 5, 6, 7, 8, 10),
    "word_length": (0, 3, 4, 5, 6, 7, 8, 10, 14),
    "distinct": (0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 1),
    "echoes": (0, 0.01, 0.03, 0.1, 0.3, 0.6, 1),
    "same_lines": (0, 0.05, 0.15, 0.3, 0.6, 1),
    "words_a_line": (0, 2, 5, 10, 20, 40, 80),
    "upper": (0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.8),
    "digits": (0, 0.01, 0.03, 0.1, 0.3, 1),
    "stops": (0, 0.005, 0.01, 0.02, 0.04, 0.1, 0.3),
    "symbols": (0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.3, 0.6),
    "white": (0, 0.05, 0.1, 0.15, 0.2, 0.3, 0.6),
    "beyond_ascii": (0, 0.01, 0.05, 0.1, 0.2, 0.5, 1),
    "one_letter": (0, 0.02, 0.05, 0.1, 0.2, 0.4, 1),
}
_PRINTED = np.arange(33, 127)
_UPPER = np.arange(65, 91)
_DIGITS = np.arange(48, 58)
_STOPS = np.array([ord(c) for c in ".,;:!?"])
_SYMBOLS = np.array([ord(c) for c in "#*$%&|<>@[\\]^_`{}~+=/!"])
_WHITE = np.array([9, 10, 11, 12, 13, 32])
RAW = len(KNOTS) + len(_PRINTED)
WIDTH = 1 + sum(map(len, KNOTS.values())) + len(_PRINTED)
BINS = 400
#: Partial sums meet in this many groups before the driver adds them up.
GROUPS = 8


def raw_features(text: str) -> np.ndarray:
    """The marks of a whole text, then the root of each printed character's share of its bytes."""
    out = np.zeros(RAW, np.float32)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(1, int(counts.sum()))
    words = text.split()
    n = len(words)
    if n:
        lines = [x for x in text.split("\n") if x and not x.isspace()]
        distinct = len(set(words)) / n
        echoes = sum(map(eq, words, words[1:])) / n
        one = sum(len(w) == 1 for w in words) / n
        same = 1 - len(set(lines)) / len(lines) if lines else 0.0
        part = lambda chars: counts[chars].sum() / size
        out[: len(KNOTS)] = (
            math.log1p(n), sum(map(len, words)) / n, distinct, echoes, same, n / max(1, len(lines)),
            part(_UPPER), part(_DIGITS), part(_STOPS), part(_SYMBOLS), part(_WHITE), counts[128:].sum() / size, one,
        )
    out[len(KNOTS) :] = np.sqrt(counts[_PRINTED] / size)
    return out


def expand(raw: np.ndarray) -> np.ndarray:
    """One, the hat functions of every mark, and the character shares: the classifier's inputs."""
    parts = [np.ones((len(raw), 1))]
    for i, knots in enumerate(KNOTS.values()):
        at = np.asarray(knots, float)
        value = np.clip(raw[:, i].astype(float), at[0], at[-1])
        left = np.clip(np.searchsorted(at, value, "right") - 1, 0, len(at) - 2)
        share = (value - at[left]) / (at[left + 1] - at[left])
        hats = np.zeros((len(raw), len(at)))
        rows = np.arange(len(raw))
        hats[rows, left] = 1 - share
        hats[rows, left + 1] += share
        parts.append(hats)
    parts.append(raw[:, len(KNOTS) :].astype(float))
    return np.hstack(parts)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), RAW)


def _total(rows: DataFrame, sums) -> np.ndarray | None:
    """``sums`` of every batch, added up by task, then by group, then here: a fixed size each time."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = sums(expand(_matrix(batch.column(0).slice(at, 4096))))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GROUPS]), pa.array([total.tobytes()])], names=["part", "total"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for own in batch.column(1):
                value = np.frombuffer(own.as_py())
                total = value if total is None else total + value
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["total"])

    groups = rows.select("x").mapInArrow(partial, "part long, total binary").repartition(GROUPS, "part").mapInArrow(added, "total binary").collect()
    return sum(np.frombuffer(r.total) for r in groups) if groups else None


def _moments(x: np.ndarray) -> np.ndarray:
    """Sums of products; the constant input makes the first row the plain sums and the corner the count."""
    return (x.T @ x).ravel()


class PositiveUnlabelled:
    """A linear scorer under squared loss: all of its risk follows from first and second moments.

    With squared loss the positive risk, the unlabelled risk and their difference are quadratic in
    the weights, so the moments of the positives and of all documents say everything that gradient
    steps over the documents would. ``prior`` is the share of positives in the unlabelled text.
    """

    def __init__(self, positives: np.ndarray, unlabelled: np.ndarray):
        self.a_p, self.a_u = positives / positives[0, 0], unlabelled / unlabelled[0, 0]
        ridge = 1e-3 + 30 / positives[0, 0]
        scale = np.diag(self.a_u).copy()
        scale[0] = 0
        self.solve = np.linalg.inv(self.a_u + np.diag(ridge * (scale + 1e-2)))

    def ratio(self) -> np.ndarray:
        """Weights whose score is the density of positives over that of all documents."""
        return self.solve @ self.a_p[0]

    def parts(self, w: np.ndarray, prior: float) -> tuple[float, float]:
        """The positives' risk, and the negatives' risk as unlabelled minus positives; that may fall below zero."""
        loss = lambda a, sign: 1 + 2 * sign * a[0] @ w + w @ a @ w
        return prior * loss(self.a_p, -1), loss(self.a_u, 1) - prior * loss(self.a_p, 1)

    def fit(self, prior: float, steps: int = 200) -> np.ndarray:
        """Weights of least non-negative risk: where the negatives' risk is below zero, steps undo that."""
        w = self.solve @ (2 * prior * self.a_p[0] - self.a_u[0])
        best, least = w, math.inf
        for _ in range(steps):
            positive, negative = self.parts(w, prior)
            if positive + max(0.0, negative) < least - 1e-12:
                best, least = w, positive + max(0.0, negative)
            of_negative = 2 * (self.a_u[0] + self.a_u @ w) - 2 * prior * (self.a_p[0] + self.a_p @ w)
            of_positive = 2 * prior * (self.a_p @ w - self.a_p[0])
            gradient = of_positive + of_negative if negative >= 0 else -of_negative
            step = self.solve @ gradient
            w = w - 0.1 * step
            if np.abs(step).max() < 1e-9:
                break
        return best


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from two histograms of one score.

    Above any score at least the positives' share of the unlabelled lies, so the share is at most
    the quotient of the two tails; the tail with the least upper bound decides.
    """
    n_p, n_u = positives.sum(), unlabelled.sum()
    tail_p, tail_u = np.cumsum(positives[::-1]) / n_p, np.cumsum(unlabelled[::-1]) / n_u
    wide = math.sqrt(math.log(40) / 2 / n_p) + math.sqrt(math.log(40) / 2 / n_u)
    bound = np.where(tail_p > 0.1, (tail_u + wide) / np.maximum(tail_p, 1e-9), np.inf)
    at = int(np.argmin(bound))
    return float(np.clip(tail_u[at] / max(tail_p[at], 1e-9), 0.02, 0.98))


def _histogram(w: np.ndarray):
    return lambda x: np.bincount(np.clip((x @ w) / 2 * BINS, 0, BINS - 1).astype(int), minlength=BINS).astype(float)


def _fold(key: str, folds: int, held: int):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == held, F.lit(False))


def _features(rows: DataFrame, key: str) -> DataFrame:
    """(key, x) of every row of two columns, written once."""

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.concatenate([raw_features(t.as_py() or "") for t in batch.column(1)])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, RAW, dtype=np.int32)), pa.array(values))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "x"])

    return stored(rows.mapInArrow(by_batch(features), f"{key} {dict(rows.dtypes)[key]}, x array<float>"))


def _weights(x: DataFrame, labels: DataFrame, key: str, label: str, folds: int, held: int) -> np.ndarray | None:
    trusted = pick(labels, key, label).filter(~_fold(key, folds, held)).groupBy(key).agg(F.min(label).alias("low")).filter("low = 1")
    trusted = trusted.select(F.col(key).alias("_key"), (F.xxhash64(key) % 2 == 0).alias("_first"))
    positives = stored(x.join(trusted, x[key] == trusted["_key"]).select("x", "_first"))
    square = lambda sums: sums.reshape(WIDTH, WIDTH)
    every, one, other = (_total(t, _moments) for t in (x, positives.filter("_first"), positives.filter("NOT _first")))
    if one is None or other is None:
        return None
    # the prior comes from positives that its score wasn't fitted to
    tally = _histogram(PositiveUnlabelled(square(one), square(every)).ratio())
    prior = estimate_prior(_total(positives.filter("NOT _first"), tally), _total(x, tally))
    return PositiveUnlabelled(square(one + other), square(every)).fit(prior)


def _scores(raw: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    return np.full(len(raw), 0.5) if weights is None else np.clip((1 + expand(raw) @ weights) / 2, 0, 1)


def quality_scores(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 3, held: int = 1) -> DataFrame:
    """Score, prediction and fold of every document.

    Positives are the documents that ``labels`` marks 1 and never 0, outside the held-out fold
    (crc32 of the key as text, modulo ``folds``, equal to ``held``); labels of 0 are not used. All
    documents together are the unlabelled text. Only the text itself is an input. The score
    estimates the chance of label 1 and lies between 0 and 1.

    Every row gives one row, repeated ones too; null counts as empty text, an empty text has a score
    like any other, and a null key is not held out. With fewer than two positives all scores are 0.5.

    Features are computed once and written; three narrow passes follow (moments, histograms, scores),
    of which nothing but sums of fixed size reaches the driver. Positives find their features by a
    join on the key, which splits if a key repeats.
    """
    rows = pick(docs, key, text)
    x = _features(rows, key)
    weights = _weights(x, labels, key, label, folds, held)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(_matrix(batch.column(1)), weights))], names=[key, "score"])

    scored = x.mapInArrow(by_batch(score), f"{key} {dict(rows.dtypes)[key]}, score double")
    return scored.select(key, _fold(key, folds, held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 3, held: int = 1) -> DataFrame:
    """The documents, with all columns, that :func:`quality_scores` predicts 1 for.

    Texts are scored where they lie, in a second pass, so they are never shuffled.
    """
    weights = _weights(_features(pick(docs, key, text), key), labels, key, label, folds, held)

    def keep(texts: pa.Array) -> list[bool]:
        return (_scores(np.array([raw_features(t.as_py() or "") for t in texts]), weights) >= 0.5).tolist()

    return keep_rows(docs, text, keep)
