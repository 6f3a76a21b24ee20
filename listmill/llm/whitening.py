"""Whitening of embeddings by an incremental eigendecomposition.

Each task keeps count, mean and the eigendecomposition of its vectors' scatter matrix and adds a
vector as a rank-one update by its centred value: the new eigenvalues are the roots of a secular
equation, whose small or equal terms are deflated first, and the new vectors come from Loewner's
formula, so that they stay orthogonal. Spectra of tasks are combined in a tree of fixed width, by
one update per eigenpair and one for the distance of the means. The basis that comes out is refined
once by a distributed Rayleigh-Ritz step: the covariance of all rows projected on it is summed over
tasks, and its small eigenproblem turns the basis into the components.

Vectors become integers first, x = floor(scale * c) + offset, so counts and sums are exact. What goes
to the driver and back is a square matrix of the vectors' length, whatever the number of rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.engine import cut

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
#: Partial results that one task combines.
FAN_IN = 16
#: Integers up to this are exact as doubles; entries beyond it count as not finite.
MOST_INTEGER = 2.0**53
#: A component's eigenvalue is more than this share of the largest one; else it has no spread to whiten.
LEAST_SHARE = 1e-12
_EPS = np.finfo(float).eps
_ROWS_AT_ONCE = 4096


def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """d[j] - root[i] as a matrix, for the roots of 1 + sum_j z2[j] / (d[j] - x) = 0.

    ``d`` rises strictly and ``z2`` is positive, so root i lies between d[i] and d[i + 1], the last
    one beyond d[-1] by at most the sum of z2. Each root is sought as a distance from the nearer
    pole, which keeps all digits of the differences. Steps solve the equation's two-pole model and
    fall back to halving the interval.
    """
    k = len(d)
    beyond = np.append(d[1:], d[-1] + z2.sum())
    half = (beyond - d) / 2
    below = np.tri(k)  # [i, j]: pole j is not above root i
    middle = 1 + (1 / (d - (d + half)[:, None])) @ z2
    right = (middle < 0) & (np.arange(k) < k - 1)
    origin = np.where(right, beyond, d)
    # the root's distance from its origin lies between low and high
    low = np.where(right, -half, np.where(middle < 0, half, 0.0))
    high = np.where(right, 0.0, np.where(middle < 0, 2 * half, half))
    apart, to_left, to_right = d - origin[:, None], d - origin, beyond - origin
    x = (low + high) / 2
    done = np.zeros(k, bool)
    with np.errstate(all="ignore"):
        for _ in range(120):
            inverse = 1 / (apart - x[:, None])
            terms, terms_below = inverse @ z2, (inverse * below) @ z2
            inverse *= inverse
            slope, slope_below = inverse @ z2, (inverse * below) @ z2
            f = 1 + terms
            low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
            d1, d2 = to_left - x, to_right - x
            a = (d1 + d2) * f - d1 * d2 * slope
            b = d1 * d2 * f
            c = f - d1 * slope_below - d2 * (slope - slope_below)
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = x + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
            # terms below are negative, those above positive
            done |= np.abs(f) <= 4 * _EPS * k * (1 + terms - 2 * terms_below)
            new = np.where(done, x, new)
            done |= np.abs(new - x) <= _EPS * np.abs(x)
            x = new
            if done.all():
                break
    return (apart - x[:, None]).T


@dataclass
class Spectrum:
    """Vectors seen: how many, their mean, and the eigendecomposition of their scatter about it."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def update(self, v: np.ndarray) -> None:
        """Adds v v' to the scatter."""
        z = v @ self.basis
        d, scale = self.values, float(z @ z)
        if scale == 0.0:
            return
        tiny = 8 * _EPS * max(d[-1], scale)
        keep = np.abs(z) * np.sqrt(scale) > tiny
        active = np.flatnonzero(keep)
        near = np.flatnonzero(np.diff(d[active]) <= tiny) if len(active) > 1 else ()
        for i in near:  # equal eigenvalues: turn the pair until one of them has nothing of v
            one, two = active[i], active[i + 1]
            r = np.hypot(z[one], z[two])
            c, s = z[two] / r, z[one] / r
            if abs((d[two] - d[one]) * c * s) <= tiny:
                pair = self.basis[:, [one, two]]
                self.basis[:, one], self.basis[:, two] = c * pair[:, 0] - s * pair[:, 1], s * pair[:, 0] + c * pair[:, 1]
                # the eigenvalues move by less than the bound above
                d[one], d[two] = c * c * d[one] + s * s * d[two], s * s * d[one] + c * c * d[two]
                z[one], z[two], keep[one] = 0.0, r, False
        active = np.flatnonzero(keep)
        active = active[np.argsort(d[active], kind="stable")]
        k = len(active)
        if k == 0:
            return
        poles, z = d[active], z[active]
        if k == 1:
            d[active] += z * z
        else:
            poles = np.maximum.accumulate(poles + 0.0)
            delta = secular_roots(poles, z * z)
            # Loewner's formula gives the z for which these roots are exact: the distances of pole j
            # from all roots, over those from pole i for i < j and from pole i + 1 for i >= j
            upper = np.append(poles[1:], 0.0)
            other = np.where(np.tri(k, k, -1, dtype=bool), poles, upper) - poles[:, None]
            other[:, -1] = -1.0
            exact = np.sqrt(np.abs(np.prod(delta / other, axis=1)))
            w = np.copysign(exact, z)[:, None] / delta
            w /= np.sqrt((w * w).sum(axis=0))
            self.basis[:, active] = self.basis[:, active] @ w
            d[active] = poles - delta[np.arange(k), np.arange(k)]
        if (np.diff(d) < 0).any():
            by = np.argsort(d, kind="stable")
            self.values, self.basis = d[by], self.basis[:, by]

    def add(self, x: np.ndarray) -> None:
        """One more vector, as an update by its distance from the mean."""
        away = x - self.mean
        self.n += 1
        if self.n > 1:
            self.update(away * np.sqrt((self.n - 1) / self.n))
        self.mean = self.mean + away / self.n

    def combine(self, other: Spectrum) -> None:
        """The other's vectors, by one update per eigenpair and one between the means."""
        if other.n == 0:
            return
        both, apart = self.n + other.n, other.mean - self.mean
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        self.update(np.sqrt(self.n * (other.n / both)) * apart)
        self.mean = self.mean + apart * (other.n / both)
        self.n = both


def integers(vectors: pa.Array, size: int, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows remain, and their vectors as integers."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(lengths == size)
    entries = vectors.take(pa.array(right)).flatten().cast(pa.float64())
    c = pc.fill_null(entries, float("nan")).to_numpy(zero_copy_only=False).reshape(len(right), size)
    with np.errstate(all="ignore"):
        x = np.floor(scale * c) + offset
        good = (np.abs(x) <= MOST_INTEGER).all(axis=1)
    return right[good], x[good].astype(np.int64)


def _common_length(df: DataFrame, column: str) -> int:
    """The length that most vectors have without null and non-finite entries; of equals the greater."""
    entries = F.transform(column, lambda c: c.cast("double"))
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    counts = df.where(F.col(column).isNotNull() & (F.size(column) > 0) & whole).groupBy(F.size(column).alias("size")).count()
    top = counts.orderBy(F.desc("count"), F.desc("size")).first()
    return top["size"] if top else 0


def _in_tree(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """Merges the payloads of (part, payload) rows, FAN_IN at a time, level by level, the last on the driver.

    Each level is stored, so a lost executor costs its own groups only.
    """

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        groups: dict[int, list[bytes]] = {}
        for row in sorted(rows, key=lambda r: r["part"]):
            groups.setdefault(row["part"] // FAN_IN, []).append(row["payload"])
        if groups:
            yield pa.RecordBatch.from_arrays([pa.array(list(groups), pa.int64()), pa.array([merge(g) for g in groups.values()], pa.binary())], names=["part", "payload"])

    stored = cut(parts)
    while (count := stored.agg(F.max("part")).first()[0]) is not None and count >= FAN_IN:
        stored = cut(stored.repartitionById(count // FAN_IN + 1, F.expr(f"cast(part div {FAN_IN} as int)")).mapInArrow(merged, stored.schema))
    payloads = [bytes(r["payload"]) for r in stored.orderBy("part").collect()]
    return merge(payloads) if payloads else None


def _numbered(parts: DataFrame) -> DataFrame:
    """(part, payload) of one payload per task, numbered by partition."""
    return parts.select(F.spark_partition_id().cast("bigint").alias("part"), "payload")


def _packed(head: list, *arrays: np.ndarray) -> bytes:
    """A line of JSON, then doubles. JSON keeps integers of any length exact."""
    return b"\n".join([json.dumps(head).encode(), b"".join(np.ascontiguousarray(a, float).tobytes() for a in arrays)])


def _unpacked(payload: bytes) -> tuple[list, np.ndarray]:
    head, _, rest = payload.partition(b"\n")
    return json.loads(head), np.frombuffer(rest, float)


def _exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python integers: high and low halves cannot overflow within a batch."""
    return [(int(h) << 32) + int(l) for h, l in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]


@dataclass(frozen=True)
class Whitening:
    """What a vector needs to be whitened. ``components`` has a unit eigenvector per column."""

    size: int
    scale: int
    offset: int
    n: int
    sums: list[int]
    values: np.ndarray
    total: float
    components: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from the exact integer n x - S."""
        return self.away(x).astype(float) / self.n

    def away(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit integers where they are enough, else Python's."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; null where 64 bits do not hold the sum."""
        away = self.away(x)
        most = int(np.abs(away).max(initial=0))
        if most * most * max(1, self.size) >= 1 << 63:
            away = away.astype(object)
        sums = (away * away).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in sums]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)


def _per_batch(vectors: pa.Array, size: int, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(vectors), _ROWS_AT_ONCE):
        rows, x = integers(vectors.slice(at, _ROWS_AT_ONCE), size, scale, offset)
        if len(rows):
            yield rows + at, x


def _moments(df: DataFrame, column: str, size: int, scale: int, offset: int, project: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of p p' over all rows, p being a row's projection; partial sums per task, combined in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _per_batch(batch.column(0), size, scale, offset):
                p = project(x)
                total = p.T @ p + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([_packed([len(total)], total)], pa.binary())], names=["payload"])

    def merge(payloads: list[bytes]) -> bytes:
        return _packed(_unpacked(payloads[0])[0], np.sum([_unpacked(p)[1] for p in payloads], axis=0))

    payload = _in_tree(_numbered(df.select(column).mapInArrow(run, "payload binary")), merge)
    if payload is None:
        return None
    (k,), flat = _unpacked(payload)
    return flat.reshape(k, k)


def fit(df: DataFrame, vector_column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """The whitening of all vectors that remain (see ``whiten``); None if none has an entry.

    A task's memory and the driver's grow with the square of the vectors' length, not with rows; an
    update's time with its cube.
    """
    size = _common_length(df, vector_column)
    if size == 0:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sums = Spectrum.empty(size), [0] * size
        for batch in batches:
            for _, x in _per_batch(batch.column(0), size, scale, offset):
                sums = [a + b for a, b in zip(sums, _exact_sums(x))]
                for row in x.astype(float):
                    seen.add(row)
        if seen.n:
            yield pa.RecordBatch.from_arrays([pa.array([packed(seen, sums)], pa.binary())], names=["payload"])

    def packed(seen: Spectrum, sums: list[int]) -> bytes:
        return _packed([seen.n, sums], seen.mean, seen.values, seen.basis)

    def unpacked(payload: bytes) -> tuple[Spectrum, list[int]]:
        (n, sums), flat = _unpacked(payload)
        return Spectrum(n, flat[:size].copy(), flat[size : 2 * size].copy(), flat[2 * size :].reshape(size, size).copy()), sums

    def merge(payloads: list[bytes]) -> bytes:
        first, sums = unpacked(payloads[0])
        for payload in payloads[1:]:
            other, more = unpacked(payload)
            first.combine(other)
            sums = [a + b for a, b in zip(sums, more)]
        return packed(first, sums)

    payload = _in_tree(_numbered(df.select(vector_column).mapInArrow(run, "payload binary")), merge)
    if payload is None:
        return None
    seen, sums = unpacked(payload)
    basis = np.linalg.qr(seen.basis)[0]  # orthogonal to the last digit
    start = Whitening(size, scale, offset, seen.n, sums, np.ones(size), float(size), basis)
    covariance = _moments(df, vector_column, size, scale, offset, start.whitened) / seen.n
    values, turn = np.linalg.eigh(covariance)
    values, turn = values[::-1], turn[:, ::-1]
    kept = min(components, int((values > max(0.0, LEAST_SHARE * values[0])).sum()))
    return Whitening(size, scale, offset, seen.n, sums, values[:kept], float(np.trace(covariance)), (basis @ turn)[:, :kept])


def identity_error(df: DataFrame, model: Whitening, vector_column: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    if not len(model.values):
        return None
    moments = _moments(df, vector_column, model.size, model.scale, model.offset, model.whitened)
    return float(np.abs(moments / model.n - np.eye(len(model.values))).max())


def whiten(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """A row per remaining vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Rows whose vector is null, empty or holds a null or non-finite entry are dropped, and so are
    entries that have no exact integer (beyond 2^53) and vectors of another length than most have.
    Components are numbered from 1 by falling eigenvalue; of equal eigenvalues any basis of their
    space is taken, the same for all rows. Components without spread (a share of 1e-12 of the first
    eigenvalue or less) are left out, so equal vectors, a single one or an empty table give no rows.
    ``deviation`` is null where it exceeds 64 bits. Null and repeated ids are kept as they are;
    repeated vectors count each; other columns are not looked at.
    """
    schema = T.StructType(
        [
            T.StructField("vec_id", df.schema[id_column].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    rows = df.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    model = fit(rows, "vector", components, scale, offset)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    error, k = identity_error(rows, model, "vector"), len(model.values)
    explained = model.values / model.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _per_batch(batch.column(1), model.size, model.scale, model.offset):
                columns = [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(len(at) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
