"""Quality scores by a regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics.  Both classes' means and
covariances come from sums over all labelled training rows (a distributed
aggregate of d + d * d numbers a class); the covariances are shrunk towards
their diagonal and towards the pooled one, and factored once (Cholesky).  The score is the logistic of
the calibrated log-density difference: log prior ratio, log determinants and
the two Mahalanobis distances, taken with the cached factors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import first_by_hash
from .workspace import Workspace, plain_names

FEATURES = (
    "log_words", "log_word_length", "word_spread", "symbols", "pipes", "capitals", "exclamations", "digits",
    "distinct_words", "adjacent_repeats", "repeated_pairs", "top_word", "repeated_lines", "log_line_length", "stops", "squeeze",
)
#: Bytes that prose seldom has: ASCII punctuation but . , ; : ' " ! ? - ( ) and the pipe, which is counted by itself.
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"!?-()|")
_UPPER, _DIGITS, _STOPS = bytes(range(65, 91)), bytes(range(48, 58)), b".?!;:,"


def _count(raw: bytes, what: bytes) -> int:
    return len(raw) - len(raw.translate(None, what))


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a whole text; the null text is the empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, m = max(len(raw), 1), max(len(words), 1)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    adjacent = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda k, of: np.log(k / of + 1e-3)
    capitals = _count(raw, _UPPER)
    return np.array([
        np.log1p(len(words)),
        np.log1p(sizes.mean()),
        np.log1p(sizes.std()),
        share(_count(raw, _SYMBOLS), n),
        share(raw.count(b"|"), m),
        share(capitals, n),
        share(raw.count(b"!"), m),
        share(_count(raw, _DIGITS), n),
        np.log(max(len(seen), 1)) / np.log(m + 1),
        share(adjacent, m),
        share(max(len(words) - 1 - pairs, 0), m),
        share(max(seen.values(), default=0), m),
        share(len(lines) - len(set(lines)), max(len(lines), 1)),
        np.log1p(n / max(len(lines), 1)),
        share(_count(raw, _STOPS), m),
        np.log(len(zlib.compress(raw, 1)) / n),
    ])


@dataclass(frozen=True)
class Discriminant:
    """Means and inverse Cholesky factors of both classes (0, 1) and the calibration of their difference."""

    means: np.ndarray
    factors: np.ndarray
    logs: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        part = [self.logs[c] - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in (0, 1)]
        return part[1] - part[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * self.difference(x) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, shrink: float = 0.05, pool: float = 0.02, floor: float = 1e-3) -> Discriminant | None:
    """From n, sum x and sum x x' of both classes; None if a class has no rows.

    Covariance of a class: (1 - pool) own + pool pooled, then (1 - shrink) of
    that plus shrink of its diagonal; no variance is below ``floor``.
    """
    if min(counts) < 1:
        return None
    d = sums.shape[1]
    means = sums / counts[:, None]
    own = np.array([products[c] / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)])
    pooled = (counts[:, None, None] * own).sum(axis=0) / counts.sum()
    factors, logs = np.empty((2, d, d)), np.empty(2)
    for c in (0, 1):
        s = (1 - pool) * own[c] + pool * pooled
        diagonal = np.maximum(np.diag(s), floor)
        s = (1 - shrink) * s + shrink * np.diag(diagonal)
        s[np.diag_indices(d)] = np.maximum(np.diag(s), floor)
        low = np.linalg.cholesky(s + 1e-9 * np.eye(d))
        factors[c] = np.linalg.inv(low)
        logs[c] = np.log(counts[c] / counts.sum()) - np.log(np.diag(low)).sum()
    return Discriminant(means, factors, logs)


def calibrate(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a ridge logistic on the difference (its size grows with d, so by itself it is too sure)."""
    scale = max(float(np.std(z)), 1e-9)
    x = np.stack((np.clip(z / scale, -6, 6), np.ones(len(z))), axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return max(w[0], 1e-3) / scale, w[1]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([statistics(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x[:, j]) for j in range(x.shape[1])]], ["doc_id", *FEATURES])


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the doc_id as text (null: empty) leaves ``fold``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def statistics_frame(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_statistics, schema)


#: The calibration's two numbers are fitted on at most so many labelled training rows (the first by a hash of their id).
CALIBRATION_ROWS = 20_000


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", calibration_rows: int = CALIBRATION_ROWS) -> Discriminant | None:
    """Fits on all rows of ``stats`` that have a label and are not held out.

    A doc_id with several labels has the smallest; null labels and labels of
    absent documents are ignored.
    """
    own = labels.filter(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("y")).filter("y in (0, 1)")
    rows = stats.join(own.filter(~held_out(F.col("doc_id"))), "doc_id")
    d = len(FEATURES)
    cells = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("y").agg(
        F.count("y"), *[F.sum(f) for f in FEATURES], *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in cells]
    ).collect()
    counts, first, second = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in sums:  # at most two rows
        y = r[0]
        counts[y], first[y] = r[1], r[2 : 2 + d]
        for (i, j), v in zip(cells, r[2 + d :], strict=True):
            second[y, i, j] = second[y, j, i] = v
    model = fit(counts, first, second)
    if model is None:
        return None
    sample = first_by_hash(rows, "doc_id", calibration_rows, int(counts.sum())).select("y", *FEATURES).toPandas()
    slope, shift = calibrate(model.difference(sample[list(FEATURES)].to_numpy()), sample["y"].to_numpy(float))
    return Discriminant(model.means, model.factors, model.logs, slope, shift)


def _scores(batches: Iterator[pa.RecordBatch], model: Discriminant | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.stack([batch.column(f).to_numpy() for f in FEATURES], axis=1) if len(batch) else np.zeros((0, len(FEATURES)))
        p = model.score(x) if model else np.full(len(batch), 0.5)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    The null text is scored like the empty one.  Without training rows of both
    classes every score is 0.5.  Repeated rows are scored one by one; other
    columns are ignored; an empty table gives an empty result.
    """
    stats = Workspace(docs.sparkSession, "quality").table(statistics_frame(docs))
    model = docs.sparkSession.sparkContext.broadcast(train(stats, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(lambda batches: _scores(batches, model.value), f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _keep(batches: Iterator[pa.RecordBatch], model: Discriminant | None, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([statistics(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
        p = model.score(x) if model else np.ones(len(batch))
        yield batch.filter(pa.array(p >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier does not reject.

    Statistics, not texts, meet the labels, so no text is shuffled.  Rows are
    judged one by one; the null text is judged like the empty one.  Without
    training rows of both classes nothing is rejected; an empty table gives an
    empty result; all columns are kept, whatever their names.
    """
    names, docs = docs.columns, plain_names(docs)
    ws = Workspace(docs.sparkSession, "quality")
    stats = ws.table(statistics_frame(docs))
    model = docs.sparkSession.sparkContext.broadcast(train(stats, labels))
    ws.drop(stats)
    return docs.mapInArrow(lambda batches: _keep(batches, model.value, threshold), docs.schema).toDF(*names)
