"""Quality classifier: regularised quadratic discriminant over document statistics.

Every whole text becomes a vector of transformed statistics (lengths, shares of
kinds of characters, repetition, entropy). Class means and covariances come from
sums over all labelled training rows, merged from partial sums; each covariance
is shrunk to the pooled one and to a multiple of the identity. The score is the
difference of the two log densities (Mahalanobis distance by a triangular solve
with a Cholesky factor that is computed once, and the factor's log determinant)
plus the log ratio of priors, as a probability.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, pick, received, sent, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAMES = "words word_length word_length_spread letters capitals digits signs spaces distinct repeats top_word adjacent pairs lines line_length same_lines ends entropy odd_signs capital_words long_words".split()
_LETTERS = re.compile(r"[^\W\d_]")
_PLAIN_SIGNS = frozenset(".,;:!?'\"()-")
SHRINK_POOLED, SHRINK_SPHERE = 0.1, 0.02


def _share(n: float, of: float) -> float:
    """A share on a square-root scale, which spreads small ones."""
    return math.sqrt(n / of) if of else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``NAMES``; all zero for null or empty."""
    text = text or ""
    words = text.split()
    n, w = len(text), len(words)
    if not w:
        return [0.0] * len(NAMES)
    chars = Counter(text)
    letters = capitals = digits = spaces = signs = odd = 0
    for c, k in chars.items():
        if c.isalpha():
            letters += k
            capitals += k * c.isupper()
        elif c.isdigit():
            digits += k
        elif c.isspace():
            spaces += k
        else:
            signs += k
            odd += k * (c not in _PLAIN_SIGNS)
    freq = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, w)
    lines = [x for x in text.split("\n") if x]
    adjacent = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    entropy = -sum(k / n * math.log2(k / n) for k in chars.values())
    ends = sum(k for x, k in freq.items() if x[-1] in ".!?")
    capital_words = sum(k for x, k in freq.items() if len(x) > 1 and x.isupper())
    return [
        math.log1p(w), math.log(sizes.mean()), math.log1p(sizes.std()), letters / n, _share(capitals, letters), _share(digits, n), _share(signs, n), spaces / n,
        math.log(len(freq) / w), _share(w - len(freq), w), _share(max(freq.values()), w), _share(adjacent, w), math.log((pairs + 1) / w), math.log1p(len(lines)), math.log1p(w / max(1, len(lines))),
        _share(len(lines) - len(set(lines)), len(lines)), _share(ends, w), entropy, _share(odd, n), _share(capital_words, w), _share(int((sizes > 20).sum()), w),
    ]


@dataclass
class Model:
    """Class means, cached Cholesky factors of the shrunken covariances and their inverses (triangular too, solved for once),
    their log determinants, and log priors."""

    means: np.ndarray
    factors: np.ndarray
    inverses: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    scale: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        dens = []
        for k in (0, 1):
            z = self.inverses[k] @ (x - self.means[k]).T  # its squares sum up to the Mahalanobis distance
            dens.append(self.log_priors[k] - 0.5 * (z * z).sum(0) - 0.5 * self.log_dets[k])
        return dens[1] - dens[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        # log densities of some twenty dependent statistics overstate the evidence: a fixed, monotone temperature
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x) / 4, -30, 30)))


def model_of(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, pooled: float = SHRINK_POOLED, sphere: float = SHRINK_SPHERE) -> Model:
    """The discriminant from each class's count, sum and sum of outer products.

    A class with fewer rows leans on the pooled covariance the more; with no
    rows of a class both get the same density and the priors decide.
    """
    d = sums.shape[1]
    total = max(1.0, n.sum())
    mean = sums.sum(0) / total
    spread = np.sqrt(np.maximum(np.diag(squares.sum(0)) / total - mean**2, 1e-6))
    means = np.stack([sums[k] / n[k] if n[k] else mean for k in (0, 1)]) / spread
    second = squares / np.outer(spread, spread)
    within = [second[k] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    common = (within[0] + within[1]) / total if n.sum() else np.eye(d)
    factors, dets = [], []
    for k in (0, 1):
        lean = max(pooled, d / (d + n[k])) if n[k] else 1.0
        own = within[k] / n[k] if n[k] else common
        c = (1 - lean) * own + lean * common
        c = (1 - sphere) * c + sphere * max(1e-3, np.trace(c) / d) * np.eye(d)
        f = np.linalg.cholesky((c + c.T) / 2)
        factors.append(f)
        dets.append(2 * np.log(np.diag(f)).sum())
    return Model(means, np.stack(factors), np.stack([np.tril(np.linalg.solve(f, np.eye(d))) for f in factors]), np.array(dets), np.log((n + 1) / (total + 2)), spread)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` (array of statistics) of every document."""

    def run(batches):
        for b in slices(batches):
            x = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    own = pick(docs, "doc_id", "text")
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, x array<double>")


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """Train on all rows of ``rows`` (doc_id, x) that have a label (``labels``: doc_id, label 0/1).

    Null ids and labels do not count; of several labels of a doc_id the lower one holds.
    """
    d = len(NAMES)
    own = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))

    def sums(batches):
        n, s, q = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for b in slices(batches):
            if not b.num_rows:
                continue
            y = b.column(0).to_numpy(zero_copy_only=False).astype(int)
            x = np.array(b.column(1).to_pylist())
            for k in (0, 1):
                own = x[y == k]
                n[k] += len(own)
                s[k] += own.sum(0)
                q[k] += own.T @ own
        flat = [np.concatenate([[n[k]], s[k], q[k].ravel()]).tolist() for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(flat, pa.list_(pa.float64()))], names=["label", "v"])

    part = rows.join(own, "doc_id").select(F.col("label").cast("int").alias("label"), "x").mapInArrow(sums, "label int, v array<double>")
    # element by element: two times about 460 sums, whatever the number of tasks
    whole = part.select("label", F.posexplode("v")).groupBy("label", "pos").agg(F.sum("col").alias("s")).collect()
    v = np.zeros((2, 1 + d + d * d))
    for r in whole:
        v[r["label"], r["pos"]] = r["s"]
    return model_of(v[:, 0], v[:, 1 : 1 + d], v[:, 1 + d :].reshape(2, d, d))


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row (doc_id, x)."""
    packed = sent(rows.sparkSession, model)

    def run(batches):
        model = received(packed)
        for b in slices(batches):
            x = np.array(b.column(1).to_pylist()).reshape(b.num_rows, -1)
            p = np.round(model.score(x), 9) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` of every document, learned from ``labels`` (doc_id, label).

    Null and empty texts have all statistics zero and get a score like any
    other; repeated rows score alike; without any label the score is 0.5; an
    empty table gives no rows.
    """
    rows = materialize(described(docs))
    return score(rows, fit(rows, labels))
