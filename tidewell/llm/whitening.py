"""Whitening of embeddings from a covariance that partitions compute and merge pairwise.

Vectors become whole numbers. Each task takes the count, the exact sum and the
scatter of its distinct vectors round their own mean; two such states become one
by Chan's formula, which adds the scatter between the two means, so nothing is
ever multiplied before it is centred. The states are merged in a tree; a matrix
of dimension by dimension is all that reaches the driver, which takes its
eigenvectors. A second pass whitens the distinct vectors and merges their
covariance the same way: its distance from the identity is reported.
"""

from __future__ import annotations

import pickle
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mark, materialize, pick, sized_slices, trim

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of more entries are refused: the covariance has to fit the driver (4,096 entries: 128 MB).
MAX_DIM = 4096
#: Rows of a block whose scatter is taken at once.
ROWS = 4096
LONG = 1 << 63


def nothing() -> tuple[int, list, np.ndarray]:
    """A state: count, sums (exact where the values are whole numbers) and scatter round the mean. A plain tuple, as it travels between workers."""
    return 0, [], np.zeros((0, 0))


def _padded(state, dim: int):
    """The same in more dimensions, in which all entries are zero."""
    n, total, scatter = state
    more = dim - len(total)
    return state if not more else (n, total + [0] * more, np.pad(scatter, (0, more)))


def merged(a, b):
    """Chan's formula: scatters add up, with that between the two means."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    dim = max(len(a[1]), len(b[1]))
    (n, s, one), (m, t, two) = _padded(a, dim), _padded(b, dim)
    apart = np.array([(y * n - x * m) / (n * m) for x, y in zip(s, t)], np.float64)
    return n + m, [x + y for x, y in zip(s, t)], one + two + np.outer(apart, apart) * (n * m / (n + m))


def _wide(x: np.ndarray, factor: int) -> np.ndarray:
    """Whole numbers that can be multiplied by a factor: Python's own where 64 bits do not hold the products."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    return x if top * factor < LONG >> 1 else x.astype(object)


def moments(x: np.ndarray):
    """The state of the rows of a matrix of whole numbers (or of floats)."""
    n = len(x)
    if x.dtype == np.float64:
        total = x.sum(0)
        centred = x - total / n
        return n, total.tolist(), centred.T @ centred
    x = _wide(x, 2 * n)
    total = x.sum(0)
    centred = ((n * x - total) / n).astype(np.float64)
    return n, [int(t) for t in total], centred.T @ centred


def whole(vectors: pa.ListArray, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The vectors to keep, in blocks of one length: (positions, matrix of floor(scale * c))."""
    valid = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    some = vectors.take(pa.array(valid))
    flat = some.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = pc.list_value_length(some).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(length)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    fine = bad[ends] == bad[ends - length]
    blocks = []
    for size in np.unique(length[fine]):
        rows = np.flatnonzero(fine & (length == size))
        if size > MAX_DIM:
            raise ValueError(f"a vector of {size} entries; at most {MAX_DIM} are whitened")
        with np.errstate(over="ignore"):
            x = np.floor(scale * flat[(ends - length)[rows][:, None] + np.arange(size)])
        low, high = x <= -float(LONG), x >= float(LONG)
        x = np.where(low | high, 0, x).astype(np.int64)
        x[low], x[high] = -LONG, LONG - 1
        blocks.append((valid[rows], x))
    return blocks


def packed(x: np.ndarray) -> pa.Array:
    """Rows as bytes, equal where the vectors are equal but for zeros at the end: 16-bit entries where they do, else 64-bit."""
    used = np.where(x != 0, np.arange(1, x.shape[1] + 1), 0).max(1, initial=0)
    small = (np.abs(x) < 1 << 15).all(1) & (x != -LONG).all(1)
    return pa.array([(b"s" + r[:u].astype("<i2").tobytes()) if s else (b"l" + r[:u].astype("<i8").tobytes()) for r, u, s in zip(x, used, small)], pa.binary())


def unpacked(codes: list[bytes]) -> np.ndarray:
    """The matrix of packed rows, shorter ones with zeros at the end."""
    rows = [np.frombuffer(c, "<i2" if c[:1] == b"s" else "<i8", offset=1) for c in codes]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


@dataclass
class Whitening:
    """What turns vectors into whitened ones: count and sums of the fit list, components (columns), eigenvalues, their share."""

    n: int
    total: list
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact, of rows of whole numbers."""
        x = np.pad(x, ((0, 0), (0, len(self.total) - x.shape[1])))
        top = max(map(abs, self.total), default=0)
        x = _wide(x, 2 * self.n)
        return x * self.n - np.array(self.total, np.int64 if x.dtype != object and top < LONG >> 2 else object)

    def deviations(self, apart: np.ndarray) -> list[int]:
        """Exact sums of squares of rows."""
        top = max(abs(int(apart.max(initial=0))), abs(int(apart.min(initial=0))))
        wide = apart if top * top * max(1, apart.shape[1]) < LONG else apart.astype(object)
        return [int(d) for d in (wide * wide).sum(1)]

    def whitened(self, apart: np.ndarray) -> np.ndarray:
        """Coordinates by component; NaN for a component without variance."""
        centred = (apart / self.n).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (centred @ self.vectors) / np.sqrt(self.values), np.nan)


def _total(states: DataFrame, depth: int):
    """All states (one binary column, a row a task) merged in a tree."""
    join = lambda a, b: pickle.dumps(merged(pickle.loads(a), pickle.loads(b)))
    return pickle.loads(states.rdd.map(lambda r: bytes(r[0])).treeReduce(join, depth))


def _states(distinct: DataFrame, of) -> DataFrame:
    """A state for each task over the packed vectors; ``of`` makes the values of a block."""

    def run(batches):
        held = nothing()
        for b in sized_slices(batches, 0, ROWS, 16 << 20):
            held = merged(held, moments(of(unpacked(b.column(0).to_pylist()))))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held)], pa.binary())], names=["state"])

    return distinct.select("code").mapInArrow(run, "state binary")


def components(state, most: int) -> Whitening:
    """Unit eigenvectors of the covariance by falling eigenvalue; a sign is chosen so that the largest entry is positive.

    Variance that rounding alone can make counts as none.
    """
    n, total, scatter = state
    cov = scatter / max(1, n)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2) if len(cov) else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(-values, kind="stable")[:most]
    values, vectors = values[order], vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0) if len(order) else vectors
    trace = float(np.trace(cov))
    values = np.where(values > len(cov) * np.finfo(float).eps * trace, values, 0.0)
    return Whitening(n, total, vectors, values, values / trace if trace else np.zeros(len(values)))


def fit(rows: DataFrame, most: int = 4, scale: int = 256, depth: int = 3) -> Whitening | None:
    """The whitening of the distinct vectors of ``rows`` (vec_id, embedding); None where no vector is left."""
    since = mark()

    def codes(batches):
        for b in _slices(batches):
            for _, x in whole(b.column(0), scale):
                yield pa.RecordBatch.from_arrays([packed(x), pa.array(np.full(len(x), x.shape[1], np.int32))], names=["code", "size"])

    distinct = materialize(rows.select("embedding").mapInArrow(codes, "code binary, size int").groupBy("code").agg(F.max("size").alias("size")))
    try:
        dim = distinct.agg(F.max("size")).first()[0]
        if dim is None:
            return None
        model = components(_padded(_total(_states(distinct, lambda x: x), depth), dim), most)
        use = model.values > 0
        if use.any():
            n, _, scatter = _total(_states(distinct, lambda x: model.whitened(model.apart(x))[:, use]), depth)
            model.identity_error = float(np.abs(scatter / n - np.eye(int(use.sum()))).max())
        return model
    finally:
        discard(rows.sparkSession, since)


def _slices(batches):
    """Batches whose vectors (the last column) have at most a million entries, but for a single longer one."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column(b.num_columns - 1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            room = (1 << 20) + (ends[at - 1] if at else 0)
            to = max(at + 1, min(at + ROWS, int(np.searchsorted(ends, room, "right"))))
            yield b.slice(at, to - at)
            at = to
    trim()


def whiten(rows: DataFrame, most: int = 4, scale: int = 256) -> DataFrame:
    """A row for each vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    An entry counts as floor(scale * c), at most what 64 bits hold. Null
    vectors and those with null or non-finite entries are dropped; shorter
    vectors have zeros at the end; repeated rows and ids stay rows of their own
    while equal vectors count once in the fit. A component without variance has
    a null ``whitened``, and a deviation over 64 bits is null. No vectors, or
    none with an entry, give no rows. Vectors of more than 4,096 entries are
    an error. Other columns are ignored.
    """
    rows = pick(rows, "vec_id", "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    model = fit(rows, most, scale)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)

    def run(batches):
        k = len(model.values)
        for b in _slices(batches):
            for at, x in whole(b.column(1), scale):
                apart = model.apart(x)
                dev = [d if d < LONG else None for d in model.deviations(apart)]
                made = pa.array(model.whitened(apart).ravel(), from_pandas=True)
                each = np.repeat(np.arange(len(x)), k)
                rest = [np.tile(v, len(x)) for v in (np.arange(1, k + 1, dtype=np.int32), model.explained)]
                cols = [b.column(0).take(pa.array(at[each])), pa.array(rest[0]), pa.array(np.full(len(each), model.n)), pa.array(dev, pa.int64()).take(pa.array(each)), made, pa.array(rest[1]), pa.array(np.full(len(each), model.identity_error))]
                yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
