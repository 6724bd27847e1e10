"""Severity grades by cumulative-link (proportional odds) regression.

P(grade <= k) = sigmoid(cut_k - w . x): one weight per sparse text feature,
shared by all ordered cuts.  Features are the presence of lower-cased words
and of their first four letters, hashed into 2**18 cells and scaled by the
square root of their number; in the fit each cell is also scaled by how unevenly
it occurs between the lowest grade and the others (its log-odds), so that a
small sample is not learned by heart.  The expected severity is the sum over the cuts
of P(grade > k).  The fit uses a bounded sample of labelled rows (at most
``per_class`` documents per grade) and keeps features that occur in three
sampled documents or more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .quality import CLASS_BYTES, class_limits, pieces

CELLS = 1 << 18
PER_CLASS = 3000
# words are runs of letters and digits; everything else in ASCII separates
_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[c for c in range(128) if not chr(c).isalnum()]] = True


def features(raw: bytes) -> np.ndarray:
    """Sorted distinct cells of one text."""
    out = []
    for piece in T._blocks(raw.lower(), _SEPARATORS):
        buf = np.frombuffer(piece, np.uint8)
        s, e = T.runs(~_SEPARATORS[buf])
        if len(s):
            out.append(T.hash_runs(buf, s, e))
            out.append(T.mix(T.hash_runs(buf, s, np.minimum(e, s + 4))))
    return np.unique(np.concatenate(out) % np.uint64(CELLS)).astype(np.int64) if out else np.empty(0, np.int64)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Ordinal:
    grades: list[int]
    weights: np.ndarray     # by cell
    cuts: np.ndarray        # ascending, one fewer than grades

    def above(self, xs: list[np.ndarray]) -> np.ndarray:
        """P(grade > k) for every cut k, one row per text."""
        z = np.array([self.weights[x].sum() / np.sqrt(max(1, len(x))) for x in xs])
        return _sigmoid(z[:, None] - self.cuts[None, :])


def fit_ordinal(xs: list[np.ndarray], ys: list[int], rounds: int = 300, rate: float = 0.3, ridge: float = 1e-4) -> Ordinal:
    """Weights by Adam on the cumulative-link likelihood."""
    grades = sorted(set(ys)) or [0]
    k = len(grades) - 1
    y = np.searchsorted(grades, ys)
    w = np.zeros(CELLS)
    if not k:
        return Ordinal(grades, w, np.zeros(0))
    n = len(xs)
    row = np.repeat(np.arange(n), [len(x) for x in xs])
    cell = np.concatenate(xs) if row.size else np.empty(0, np.int64)
    often = np.bincount(cell, minlength=CELLS) >= min(3, n)
    row, cell = row[often[cell]], cell[often[cell]]
    used, cell = np.unique(cell, return_inverse=True)
    low = y[row] == 0
    seen = [(np.bincount(cell[m], minlength=len(used)) + 0.5) / (c.sum() + 1) for m, c in ((~low, y > 0), (low, y == 0))]
    odds = np.abs(np.log(seen[0]) - np.log(seen[1]))
    value = odds[cell] / np.sqrt(np.maximum(1, np.array([len(x) for x in xs])))[row]
    weight = 1 / np.bincount(y, minlength=k + 1)[y] / (k + 1)            # grades weigh the same
    theta = np.concatenate((np.zeros(len(used)), [0.0], np.zeros(k - 1)))  # weights, first cut, log gaps
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        gaps = np.exp(theta[len(used) + 1:])
        cuts = theta[len(used)] + np.concatenate(([0], np.cumsum(gaps)))
        z = np.bincount(row, theta[:len(used)][cell] * value, n)
        upto = np.concatenate((np.zeros((n, 1)), _sigmoid(cuts[None, :] - z[:, None]), np.ones((n, 1))), axis=1)
        slope = upto * (1 - upto)
        at = np.arange(n)
        p = np.maximum(upto[at, y + 1] - upto[at, y], 1e-12)
        d_cut = np.zeros((n, k + 2))
        d_cut[at, y + 1] += slope[at, y + 1] / p
        d_cut[at, y] -= slope[at, y] / p
        d_cut *= weight[:, None]
        d_z = -d_cut.sum(axis=1)
        grad = np.empty_like(theta)
        grad[:len(used)] = np.bincount(cell, d_z[row] * value, len(used)) - ridge * theta[:len(used)]
        each = d_cut[:, 1:-1].sum(axis=0)
        grad[len(used)] = each.sum()
        grad[len(used) + 1:] = each[::-1].cumsum()[::-1][1:] * gaps
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    w[used] = theta[:len(used)] * odds
    gaps = np.exp(theta[len(used) + 1:])
    return Ordinal(grades, w, theta[len(used)] + np.concatenate(([0], np.cumsum(gaps))))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", where: Column | None = None,
        per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES) -> Ordinal:
    """Model from a bounded sample: at most ``per_class`` documents and ``class_bytes`` bytes
    of text per grade (the longest texts by evenly spaced pieces).  The texts become
    distinct cells in the tasks, at most one per byte, which bounds what the driver gets."""
    rows = T.stored(T.labelled_sample(docs, labels, label, per_class, where), "severity-sample")
    limits = class_limits(rows, class_bytes)

    @F.arrow_udf("array<int>")
    def cells(text: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([features(pieces(raw, limits[c])).astype(np.int32) for raw, c in zip(T.utf8(text), y.to_pylist(), strict=True)],
                        pa.list_(pa.int32()))

    got = rows.select("doc_id", "y", cells("text", "y").alias("x")).toArrow().sort_by("doc_id")
    return fit_ordinal([np.asarray(x.values, dtype=np.int64) for x in got.column("x")], got.column("y").to_pylist())


def severity(docs: DataFrame, labels: DataFrame, label: str = "toxic", where: Column | None = None,
             per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with ``_severity`` (expected grade), ``_grade`` (the first grade
    whose cumulative probability reaches one half) and ``_p_above`` (P(grade > k)
    per cut).

    NULL texts count as empty; without labels, or with one grade only, every
    text has that grade (0 without any).  A text of any length is judged whole; rows
    that repeat are judged alike; an empty table gives no rows.  All columns pass through."""
    T.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, where, per_class))

    @F.arrow_udf("struct<severity:double,grade:int,above:array<double>>")
    def judge(text: pa.Array) -> pa.Array:
        m = shared.value
        above = m.above([features(raw) for raw in T.utf8(text)])
        g = np.array(m.grades, float)
        expected = g[0] + above @ np.diff(g) if len(g) > 1 else np.full(len(text), g[0])
        grade = [m.grades[i] for i in (above >= 0.5).sum(axis=1)]
        return pa.StructArray.from_arrays(
            [pa.array(expected, pa.float64()), pa.array(grade, pa.int32()), pa.array(list(above), pa.list_(pa.float64()))],
            names=["severity", "grade", "above"])

    return (docs.withColumn("_j", judge(F.col("text").cast("string")))
                .withColumns({"_severity": F.col("_j.severity"), "_grade": F.col("_j.grade"), "_p_above": F.col("_j.above")})
                .drop("_j"))
