"""Embedding whitening: principal components of quantised vectors, scaled to unit variance.

Sums and the centred covariance are added up over all partitions; the symmetric matrix, whose size is fixed by the
vectors' dimension alone, is reduced to tridiagonal form by Householder reflections. Sturm counts locate its leading
eigenvalues by bisection, inverse iteration with reorthogonalisation within clusters gives the eigenvectors, and
the components are broadcast for the projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, store

# An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
# Entries worked on at once, and eigenvalues that count as one cluster, as a share of the matrix' norm.
ENTRIES = 1 << 20
CLUSTER = 1e-3
EPS = np.finfo(np.float64).eps


class Whitening(NamedTuple):
    """``sums`` are exact; ``components`` has a row for each of ``values``, the eigenvalues from the largest on."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    identity_error: float


# ---- vectors of a batch


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``ENTRIES`` entries, one row at least."""
    lengths = pa.compute.list_value_length(batch.column("embedding")).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(lengths)])
    begin = 0
    while begin < batch.num_rows:
        end = max(int(np.searchsorted(total, total[begin] + ENTRIES, "right")) - 1, begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def usable(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length of each row, -1 for a row that is dropped; all entries as double; where each row's entries begin)."""
    column = part.column("embedding")
    lengths = pa.compute.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    begins = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    # A scaled entry beyond 62 bits has no long value.
    with np.errstate(invalid="ignore", over="ignore"):
        bad = ~np.isfinite(entries) | (np.abs(entries) * SCALE >= 2.0**62)
    before = np.concatenate([[0], np.cumsum(bad)])
    return np.where(before[begins[1:]] > before[begins[:-1]], -1, lengths), entries, begins[:-1]


def quantised(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the rows with ``size`` usable entries, their whole numbers)."""
    lengths, entries, begins = usable(part)
    rows = np.flatnonzero(lengths == size)
    chosen = entries[begins[rows][:, None] + np.arange(size)]
    return rows, np.floor(chosen * SCALE).astype(np.int64) + SHIFT


class Centre:
    """Exact differences from the mean: the whole part of the mean and what is left of the division."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])
        self.squares = sum(r * r for r in self.rest)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n*x - S)^2, which is (n*d - r)^2 for d, r as kept here."""
        d = x - self.whole
        # Products are taken in 64 bits where they fit, else in whole numbers of any size.
        large = int(np.abs(d).max(initial=0))
        if large * large * max(d.shape[1], 1) >= 2**62 or large * self.n * max(d.shape[1], 1) >= 2**62:
            d = d.astype(object)
        rest = np.array(self.rest, d.dtype if d.dtype == object else np.int64)
        square, mixed = (d * d).sum(axis=1).tolist(), (d * rest).sum(axis=1).tolist()
        return [self.n * self.n * a - 2 * self.n * b + self.squares for a, b in zip(square, mixed, strict=True)]


# ---- sums over all partitions


def lengths_and_sums(vectors: DataFrame) -> DataFrame:
    """(size, n, at, high, low): for every length of usable vectors, each dimension's sum in two halves of 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for part in parts(batch):
                for size in np.unique(usable(part)[0]).tolist():
                    if size > 0:
                        _, x = quantised(part, size)
                        held = found.setdefault(size, [0, np.zeros(size, object), np.zeros(size, object)])
                        held[0] += len(x)
                        held[1] += (x >> 32).sum(axis=0)
                        held[2] += (x & 0xFFFFFFFF).sum(axis=0)
        for size, (n, high, low) in found.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "size": pa.array([size] * size, pa.int32()),
                    "n": pa.array([n] * size, pa.int64()),
                    "at": pa.array(range(size), pa.int32()),
                    "high": pa.array(high.tolist(), pa.int64()),
                    "low": pa.array(low.tolist(), pa.int64()),
                }
            )

    made = vectors.select("embedding").mapInArrow(run, "size int, n bigint, at int, high bigint, low bigint")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return made.groupBy("size", "at").agg(F.sum("n").alias("n"), exact("high").alias("high"), exact("low").alias("low"))


def products(vectors: DataFrame, size: int, rows: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of the outer products of ``rows(x)`` with themselves: ``width`` by ``width``, whatever the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for part in parts(batch):
                made = rows(quantised(part, size)[1])
                total += made.T @ made
        lower = [total[i, : i + 1] for i in range(width)]
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(width), pa.int32()), "row": pa.array(lower, pa.list_(pa.float64()))})

    made = vectors.select("embedding").mapInArrow(run, "at int, row array<double>").repartition("at")
    each = made.select("at", F.posexplode("row").alias("other", "value"))
    summed = each.groupBy("at", "other").agg(F.sum("value").alias("value")).toArrow()
    found = np.zeros((width, width))
    found[summed["at"].to_numpy(), summed["other"].to_numpy()] = summed["value"].to_numpy()
    return found + np.tril(found, -1).T


# ---- eigenvalues and eigenvectors of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, next diagonal, Householder vectors) of an orthogonally similar tridiagonal matrix."""
    a, turned = matrix.copy(), []
    for j in range(len(a) - 2):
        x = a[j + 1 :, j].copy()
        norm = np.linalg.norm(x)
        v = x
        v[0] += norm if v[0] >= 0 else -norm
        size = np.linalg.norm(v)
        if size == 0:
            turned.append(v)
            continue
        v /= size
        turned.append(v)
        rest = a[j + 1 :, j + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[j + 1 :, j] -= 2 * v * (v @ a[j + 1 :, j])
    return np.diag(a).copy(), np.diag(a, -1).copy(), turned


def below(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each shift."""
    tiny = np.finfo(np.float64).tiny * max(1.0, float((beside**2).max(initial=0)))
    count = np.zeros(shifts.size, np.int64)
    q = np.ones(shifts.size)
    for i, d in enumerate(diagonal):
        q = d - shifts - (beside[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection on Sturm counts."""
    n = diagonal.size
    reach = np.concatenate([np.abs(beside), [0]]) + np.concatenate([[0], np.abs(beside)])
    low = np.full(k, (diagonal - reach).min() - 1e-12)
    high = np.full(k, (diagonal + reach).max() + 1e-12)
    rank = n - 1 - np.arange(k)
    for _ in range(1100):
        middle = low + (high - low) / 2
        if np.all((high - low) <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))) or np.all((middle <= low) | (middle >= high)):
            break
        above = below(diagonal, beside, middle) > rank
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return low + (high - low) / 2


def solved(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(T - shift) z = right for every shift at once (columns), by elimination with row exchanges."""
    n, k = right.shape
    floor = EPS * max(np.abs(diagonal).max(), np.abs(beside).max(initial=0), 1e-300)
    main, first, second = np.empty((n, k)), np.zeros((n, k)), np.zeros((n, k))
    b = right.copy()
    d, u = diagonal[0] - shifts, np.full(k, beside[0] if n > 1 else 0.0)
    for i in range(n - 1):
        sub, below_d = beside[i], diagonal[i + 1] - shifts
        after = beside[i + 1] if i + 2 < n else 0.0
        swap = abs(sub) > np.abs(d)
        pivot = np.where(swap, sub, np.where(np.abs(d) < floor, floor, d))
        factor = np.where(swap, d, sub) / pivot
        main[i] = pivot
        first[i] = np.where(swap, below_d, u)
        second[i] = np.where(swap, after, 0.0)
        d = np.where(swap, u, below_d) - factor * first[i]
        u = np.where(swap, -factor * second[i], after)
        here, there = b[i].copy(), b[i + 1].copy()
        b[i] = np.where(swap, there, here)
        b[i + 1] = np.where(swap, here, there) - factor * b[i]
    main[n - 1] = np.where(np.abs(d) < floor, floor, d)
    z = np.empty((n, k))
    for i in range(n - 1, -1, -1):
        z[i] = b[i]
        if i + 1 < n:
            z[i] -= first[i] * z[i + 1]
        if i + 2 < n:
            z[i] -= second[i] * z[i + 2]
        z[i] /= main[i]
        # Solutions grow like one over the distance to the eigenvalue; scaled before they leave the range of doubles.
        grown = np.abs(z[i]) > 1e150
        if grown.any():
            z[i:, grown] *= 1e-150
            b[:, grown] *= 1e-150
    return z


def vectors_of(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration; those of close eigenvalues are kept orthogonal to each other."""
    norm = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0))
    cluster = np.concatenate([[0], np.cumsum(np.abs(np.diff(values)) > CLUSTER * norm)])
    z = np.random.default_rng(7).standard_normal((diagonal.size, values.size))
    for _ in range(rounds):
        z = solved(diagonal, beside, values, z / np.linalg.norm(z, axis=0))
        for c in range(values.size):
            z[:, c] /= np.linalg.norm(z[:, c])
            mine = z[:, :c][:, cluster[:c] == cluster[c]]
            for _ in range(2):
                z[:, c] -= mine @ (mine.T @ z[:, c])
                z[:, c] /= np.linalg.norm(z[:, c])
    return z


def eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    k = min(k, len(matrix))
    scale = np.abs(matrix).max(initial=0)
    if not k or not scale:
        return np.zeros(k), np.eye(len(matrix))[:k]
    diagonal, beside, turned = tridiagonal(matrix / scale)
    values = leading(diagonal, beside, k)
    z = vectors_of(diagonal, beside, values)
    for j in range(len(turned) - 1, -1, -1):
        z[j + 1 :] -= 2 * np.outer(turned[j], turned[j] @ z[j + 1 :])
    return values * scale, (z / np.linalg.norm(z, axis=0)).T


# ---- the operator


def fit(df: DataFrame, k: int = 32, vec_id: str = "vec_id", embedding: str = "embedding") -> Whitening | None:
    """Components of all usable vectors (see ``whiten``); None if there are none.

    The driver holds the sums and the covariance, whose size follows from the dimension, never from the number of rows.
    """
    vectors = pick(df, embedding=embedding)
    found = store(lengths_and_sums(vectors), "vector-sums")
    most = found.where("at = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").head()
    if most is None:
        return None
    size, n = most["size"], most["n"]
    sums = [0] * size
    for r in found.where(F.col("size") == size).collect():
        sums[r["at"]] = int(r["high"]) * 2**32 + int(r["low"])
    centre = Centre(n, sums)
    covariance = products(vectors, size, centre.centred, size) / n
    values, components = eigen(covariance, k)
    trace = float(np.trace(covariance))
    # Directions without variance cannot be scaled to one.
    some = values > max(trace, 0.0) * size * EPS
    values, components = values[some], components[some]
    project = components.T / np.sqrt(values)
    check = products(vectors, size, lambda x: centre.centred(x) @ project, len(values)) / n if len(values) else np.zeros((0, 0))
    error = float(np.abs(check - np.eye(len(values))).max(initial=0))
    return Whitening(n, sums, trace, values, components, error)


def whiten(df: DataFrame, model: Whitening, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per usable vector: ``vec_id``, ``deviation`` (text of a whole number of any size), ``whitened`` (array of doubles).

    A vector is usable if it is not null and holds no null, NaN, infinite entry or one beyond 62 bits after scaling, and
    has the length that most such vectors have (the greater one of two equally frequent ones); all others, the empty
    vector too, are dropped. A null id stays null, repeated rows come out repeated, an empty table gives an empty
    table, other columns are ignored. Components without variance are left out, so fewer than ``k`` may come back.
    """
    vectors = pick(df, vec_id=vec_id, embedding=embedding)
    size, centre = len(model.sums), Centre(model.n, model.sums)
    shared = df.sparkSession.sparkContext.broadcast(model.components.T / np.sqrt(model.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = shared.value
        for batch in batches:
            for part in parts(batch):
                rows, x = quantised(part, size)
                found = (centre.centred(x) @ project).ravel()
                ends = np.arange(len(rows) + 1, dtype=np.int32) * project.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(rows)),
                        pa.array([str(v) for v in centre.deviations(x)], pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(found)),
                    ],
                    names=["vec_id", "deviation", "whitened"],
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, deviation string, whitened array<double>")


def report(df: DataFrame, model: Whitening | None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """A row for each usable vector and component; ``deviation`` is null where it needs more than a long."""
    schema = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        ids = pick(df, vec_id=vec_id).schema["vec_id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"vec_id {ids}, {schema}")
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    each = whiten(df, model, vec_id, embedding).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
