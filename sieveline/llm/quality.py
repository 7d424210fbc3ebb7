"""Quality classifier: regularised quadratic discriminant over document statistics.

Each document becomes a few transformed statistics (logs of rates, roots of
shares), which are near enough to normal within good text. Each class has a mean
and a covariance, shrunk towards the pooled covariance and its diagonal. A score
is the difference of the two log densities, each from a Mahalanobis distance by
the class' Cholesky factor, which is inverted once and kept; a logistic curve
fitted on training rows makes it a probability.

Moments are summed over all labelled training rows, task by task; only the
logistic curve is fitted on a bounded sample, ``CURVE_ROWS`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import held_out, stored
from sieveline.llm.tokens import text_blocks
from sieveline.llm.wordhash import Words

#: Training rows on which the logistic curve is fitted, those of the smallest hashes.
CURVE_ROWS = 20_000
SHRINK, RIDGE = 0.1, 1e-3
THRESHOLD = 0.3

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
N_STATISTICS = 12


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of transformed statistics per text; empty texts have finite ones."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    words = Words(texts)
    edges = np.cumsum([0, *[len(r) + 1 for r in raw]])

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[edges[1:]] - sums[edges[:-1]]).astype(float)

    size = np.maximum(np.diff(edges) - 1, 0).astype(float)
    count = np.diff(words.first)
    n = count.astype(float)
    lines = per_text(data == 10)  # each text has one newline behind it
    # capitals: A-Z, and those of the Latin-1 block, whose second byte tells them
    capital = _UPPER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital[second[(data[second] >= 0x80) & (data[second] <= 0x9E)]] = True
    letters = per_text(~_PUNCTUATION[data] & ~_DIGIT[data] & (data > 32) & (data & 0xC0 != 0x80))
    hashes = words.hashes()
    text = np.repeat(np.arange(len(texts)), count)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    first = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))[: len(h)]
    distinct = np.bincount(t[first], minlength=len(texts)).astype(float)
    runs = np.diff(np.append(np.flatnonzero(first), len(h)))
    commonest = np.zeros(len(texts))
    np.maximum.at(commonest, t[first], runs)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) + 1
    repeated = np.bincount(text[again], minlength=len(texts)).astype(float)
    length = (words.end - words.start).astype(float)
    marks = np.concatenate([[0], np.cumsum(_PUNCTUATION[data], dtype=np.int64)])
    bare = np.bincount(text[(marks[words.end] - marks[words.start]) == length], minlength=len(texts)).astype(float)
    longest = np.zeros(len(texts))
    np.maximum.at(longest, text, length)
    # words that end in two marks or more
    doubled = np.flatnonzero((length >= 3) & _PUNCTUATION[data[np.maximum(words.end - 1, 0)]] & _PUNCTUATION[data[np.maximum(words.end - 2, 0)]])
    shouted = np.bincount(text[doubled], minlength=len(texts)).astype(float)
    some = np.maximum(n, 1)
    columns = [
        np.log1p(n),
        np.log((size + 1) / (n + 1)),
        np.sqrt(repeated / some),
        np.log1p(distinct) / np.log1p(some),
        np.sqrt(commonest / some),
        np.log((per_text(_PUNCTUATION[data]) + 0.5) / (size + 20)),
        np.log((per_text(capital) + 0.5) / (letters + 20)),
        np.log((per_text(_DIGIT[data]) + 0.5) / (size + 20)),
        np.sqrt(bare / some),
        np.log((lines + 0.5) / (n + 1)),
        np.log1p(longest),
        np.sqrt(shouted / some),
    ]
    return np.stack(columns, axis=1) if len(texts) else np.zeros((0, N_STATISTICS))


def document_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x, the statistics of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "__text", 2 << 20):
            x = statistics(texts)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_STATISTICS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "x"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    """Per class: mean, the Cholesky factor's inverse, and the log density's constant;
    then the logistic curve. A class too small to fit leaves the training share as the score."""

    share: float
    mean: np.ndarray | None = None
    whiten: np.ndarray | None = None
    constant: np.ndarray | None = None
    scale: np.ndarray | None = None
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = x / self.scale
        log = [c - 0.5 * ((z - m) @ w.T).__pow__(2).sum(axis=1) for m, w, c in zip(self.mean, self.whiten, self.constant, strict=True)]
        # a far outlier's margin says no more than a near one's
        d = log[1] - log[0]
        return np.sign(d) * np.log1p(np.abs(d))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -60, 60)))


def _rows(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return np.asarray(batch.column(column).flatten()).reshape(-1, N_STATISTICS)


def moments(labelled: DataFrame) -> DataFrame:
    """y, n, the sums of x and of x x', each task's apart: a few rows per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = np.zeros(2), np.zeros((2, N_STATISTICS)), np.zeros((2, N_STATISTICS, N_STATISTICS))
        for batch in batches:
            x, y = _rows(batch), batch.column("y").to_numpy()
            for k in (0, 1):
                mine = x[y == k]
                n[k] += len(mine)
                s[k] += mine.sum(axis=0)
                q[k] += mine.T @ mine
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(n), pa.array(s.tolist(), pa.list_(pa.float64())), pa.array(q.reshape(2, -1).tolist(), pa.list_(pa.float64()))], ["y", "n", "s", "q"])

    parts = labelled.select("y", "x").mapInArrow(run, "y int, n double, s array<double>, q array<double>")
    at = lambda c, k: [F.sum(F.col(c)[i]).alias(f"{c}{i}") for i in range(k)]
    return parts.groupBy("y").agg(F.sum("n").alias("n"), F.array(*at("s", N_STATISTICS)).alias("s"), F.array(*at("q", N_STATISTICS**2)).alias("q"))


def fit(labelled: DataFrame, *, curve_rows: int = CURVE_ROWS) -> Model:
    """labelled: doc_id, x, y (0 or 1)."""
    sums = {r["y"]: (r["n"], np.array(r["s"]), np.array(r["q"]).reshape(N_STATISTICS, N_STATISTICS)) for r in moments(labelled).collect()}
    n = np.array([sums.get(k, (0,))[0] for k in (0, 1)], float)
    model = Model(share=float(n[1] / n.sum()) if n.sum() else 0.5)
    if n.min() < 2:
        return model
    mean = np.array([sums[k][1] / n[k] for k in (0, 1)])
    cov = np.array([sums[k][2] / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)])
    pooled = np.einsum("k,kij->ij", n, cov) / n.sum()
    model.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
    grid = np.outer(model.scale, model.scale)
    model.mean = mean / model.scale
    whiten, constant = [], []
    for k in (0, 1):
        shrink = max(SHRINK, N_STATISTICS / (N_STATISTICS + n[k]))
        sigma = (1 - shrink) * cov[k] / grid + shrink * pooled / grid
        sigma = (1 - RIDGE) * sigma + RIDGE * np.diag(np.maximum(np.diag(sigma), 1e-6))
        factor = np.linalg.cholesky(sigma + 1e-9 * np.eye(N_STATISTICS))
        whiten.append(np.linalg.inv(factor))
        constant.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    model.whiten, model.constant = np.array(whiten), np.array(constant)
    sample = labelled.select("x", "y", F.xxhash64("doc_id").alias("h")).orderBy("h", "y").limit(curve_rows).select("x", "y").toArrow()
    x = np.asarray(sample.column("x").combine_chunks().flatten()).reshape(-1, N_STATISTICS)
    model.slope, model.shift = logistic_curve(model.margin(x), sample.column("y").to_numpy().astype(float))
    return model


def logistic_curve(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with a weak pull towards slope 1."""
    x, b = np.stack([m, np.ones(len(m))], axis=1), np.array([1.0, 0.0])
    pull = np.diag([1.0, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - y) + pull @ (b - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, g)
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    The model learns from labelled rows that aren't held out; labels other than 0
    and 1 count as none, and of several labels of an id the largest counts. Null
    or empty text is scored by its (empty) statistics. Rows with a null id are
    scored and never learnt from. Repeated rows stay, and all of them count in the fit. An
    empty table gives no rows. Other columns take no part. If a class has fewer than two
    training rows, every score is the training share of label 1 (0.5 without rows).
    """
    known = stored(document_statistics(docs, id_col=id_col, text_col=text_col), "statistics")
    marked = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y IN (0, 1)").groupBy("__id").agg(F.max("y").alias("y"))
    training = stored(known.where(~held_out(F.col("doc_id"))).join(marked, F.col("doc_id") == F.col("__id")).select("doc_id", "x", "y"), "training")
    model = fit(training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_rows(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = known.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
