"""K-Means for many (K, seed) pairs in the same passes, and their Euclidean silhouettes.

Vectors are packed in blocks.  A pass reads every vector once and serves all models: the draws
of k-means++ (the row with the largest key log(u) / D^2, an exact weighted draw), the
sums of a Lloyd step, or the silhouettes.  The driver sees sums by centre only, whatever the
number of rows.

Silhouettes need the mean distance of each row to all rows of each cluster.  Here the rows are
gathered in CELLS cells around as many drawn rows; a row's distance to a cell's mean stands
for its distances to the cell's rows.  Cost is rows x CELLS.  By the triangle inequality a mean
distance to a cluster is off by at most the mean distance of the cluster's rows to their cells'
means, which gives the error bound that is returned; with at most CELLS distinct
rows each is its own cell and the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.staging import stage
from tidemark.functions.workers import ship

CELLS = 2048
#: Rows that are compared with all centres or cells at once.
CHUNK = 512
#: Files of rows up to which the driver adds up the parts of a pass itself.
FEW = 64


@dataclass
class Model:
    k: int
    seed: int
    centres: np.ndarray
    inertia: float = 0.0


class Vectors:
    """Packed rows, kept by the executors while models are fitted; ``close`` gives them back."""

    def __init__(self, rows: DataFrame, key: str, columns: Sequence[str]):
        ship(rows.sparkSession)
        self.width = len(columns)
        ready = rows.select(F.xxhash64(key).alias("id"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("id").to_numpy().astype("<i8").tobytes()
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([ids]), pa.array([x])], ["id", "x"])

        written = stage(ready.mapInArrow(run, "id binary, x binary"), "vectors")
        self.few = len(written.inputFiles()) <= FEW
        self.rows = written.persist(StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        self.rows.unpersist()

    def sums(self, size: int, add) -> np.ndarray:
        """Sums of ``size`` numbers that ``add(ids, vectors)`` gives for each block."""
        blocks = _Blocks(self.width)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for ids, x in blocks.read(batches):
                total += add(ids, x)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "a"])

        parts = self.rows.mapInArrow(run, "cell long, a double")
        if not self.few:
            parts = parts.groupBy("cell").agg(F.sum("a").alias("a"))
        found = parts.toArrow()
        return np.bincount(found.column("cell").to_numpy(), found.column("a").to_numpy(), size)

    def picked(self, draws: int, keys) -> np.ndarray:
        """The vector with the largest of ``keys(ids, vectors)`` for each draw."""
        blocks, width = _Blocks(self.width), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, at = np.full(draws, -np.inf), np.zeros((draws, width))
            for ids, x in blocks.read(batches):
                found = keys(ids, x)
                top = found.argmax(axis=0)
                better = found[top, np.arange(draws)] > best
                best[better], at[better] = found[top, np.arange(draws)][better], x[top[better]]
            columns = [pa.array(np.arange(draws)), pa.array(best), pa.array(list(at), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["draw", "key", "x"])

        parts = self.rows.mapInArrow(run, "draw long, key double, x array<double>").where("key > double('-inf')")
        found = parts.groupBy("draw").agg(F.max_by("x", F.struct("key", "x")).alias("x")).orderBy("draw").collect()
        return np.array([r["x"] for r in found]).reshape(-1, self.width)


@dataclass
class _Blocks:
    """How a worker reads packed rows."""

    width: int

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for id_, x_ in zip(batch.column("id"), batch.column("x")):
                ids, x = np.frombuffer(id_.as_buffer(), "<i8"), np.frombuffer(x_.as_buffer(), "<f8").reshape(-1, self.width)
                for at in range(0, len(ids), CHUNK):
                    yield ids[at : at + CHUNK], x[at : at + CHUNK]


def _chances(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each row, the same in every pass."""
    x = ids.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    found = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
    return np.maximum(found, 0.0)


def _started(data: Vectors, jobs: Sequence[tuple[int, int]]) -> list[Model]:
    """k-means++: centres one by one, each drawn by squared distance to those before."""
    models = [Model(k, seed, np.empty((0, data.width))) for k, seed in jobs]
    for step in range(max(k for k, _ in jobs)):
        open_ = [m for m in models if m.k > step]
        known = [(m.seed * 1009 + m.k) * 1009 + step for m in open_], [m.centres for m in open_]

        def keys(ids: np.ndarray, x: np.ndarray, known=known) -> np.ndarray:
            out = np.empty((len(x), len(known[0])))
            for k, (salt, centres) in enumerate(zip(*known)):
                away = _squares(x, centres).min(axis=1) if len(centres) else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    out[:, k] = np.where(away > 1e-12, np.log(_chances(ids, salt)) / away, -1e300)
            return out

        for m, at in zip(open_, data.picked(len(open_), keys)):
            m.centres = np.vstack([m.centres, at])
    return models


def _step(models: list[Model], width: int):
    """Sums of a Lloyd step: for each model its centres' rows and vectors, and the inertia."""
    centres = [m.centres for m in models]
    stacked, starts = np.vstack(centres), np.cumsum([0, *map(len, centres)])
    size = len(stacked) * (width + 1) + len(models)

    def add(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
        away = _squares(x, stacked)
        out = np.zeros(size)
        sums, inertia = out[: -len(starts) + 1].reshape(len(stacked), width + 1), out[-len(starts) + 1 :]
        for m, (lo, hi) in enumerate(zip(starts, starts[1:])):
            near = away[:, lo:hi].argmin(axis=1)
            sums[lo:hi, 0] = np.bincount(near, minlength=hi - lo)
            for d in range(width):
                sums[lo:hi, d + 1] = np.bincount(near, x[:, d], hi - lo)
            inertia[m] = away[np.arange(len(x)), lo + near].sum()
        return out

    return size, add


def fit(data: Vectors, jobs: Sequence[tuple[int, int]], max_iter: int = 300, tolerance: float = 1e-4) -> list[Model]:
    """Models of all (K, seed); each stops when its centres move by less than ``tolerance`` in all."""
    models = _started(data, jobs)
    open_ = list(models)
    for _ in range(max_iter):
        size, add = _step(open_, data.width)
        found = data.sums(size, add)
        sums, at, left = found[: -len(open_)].reshape(-1, data.width + 1), 0, []
        for m, inertia in zip(open_, found[-len(open_) :]):
            own = sums[at : at + m.k]
            at += m.k
            # A centre without rows stays where it is.
            new = np.where(own[:, :1] > 0, own[:, 1:] / np.maximum(own[:, :1], 1), m.centres)
            moved, m.centres, m.inertia = ((new - m.centres) ** 2).sum(), new, inertia
            if moved > tolerance:
                left.append(m)
        open_ = left
        if not open_:
            break
    size, add = _step(models, data.width)  # inertia of the last centres
    for m, inertia in zip(models, data.sums(size, add)[-len(models) :]):
        m.inertia = float(inertia)
    return models


def _drawn(data: Vectors, rows: int, cells: int) -> np.ndarray:
    """Up to ``cells`` distinct rows, by hash; nearly all rows of a small table."""
    share = min(1.0, 2.0 * cells / max(rows, 1))
    blocks = _Blocks(data.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in blocks.read(batches):
            key = _chances(ids, 7)
            use = key <= share
            columns = [pa.array(key[use]), pa.array(list(x[use]), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "x"])

    found = data.rows.mapInArrow(run, "key double, x array<double>").groupBy("x").agg(F.min("key").alias("key"))
    top = found.orderBy("key", "x").limit(cells).collect()
    return np.array([r["x"] for r in top]).reshape(-1, data.width)


def silhouettes(data: Vectors, models: Sequence[Model], cells: int = CELLS) -> list[tuple[float, float]]:
    """(mean Euclidean silhouette, bound of its error) of each model."""
    width = data.width
    rows = int(data.sums(1, lambda ids, x: np.array([float(len(x))]))[0])
    drawn = _drawn(data, rows, cells)

    def gathered(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
        near = _squares(x, drawn).argmin(axis=1)
        parts = [np.bincount(near, minlength=len(drawn))]
        parts += [np.bincount(near, x[:, d], len(drawn)) for d in range(width)]
        return np.concatenate(parts)

    held = data.sums(len(drawn) * (width + 1), gathered).reshape(width + 1, len(drawn))
    means = np.where(held[0] > 0, held[1:] / np.maximum(held[0], 1), drawn.T).T
    centres = [m.centres for m in models]
    starts = np.cumsum([0, *map(len, centres)])
    groups = int(starts[-1])

    def label(x: np.ndarray) -> np.ndarray:
        return np.stack([lo + _squares(x, c).argmin(axis=1) for lo, c in zip(starts, centres)], axis=1)

    def weighed(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Rows by (cell, cluster), then distances to the cells' means by cluster."""
        near, own = _squares(x, drawn).argmin(axis=1), label(x)
        off = np.sqrt(((x - means[near]) ** 2).sum(axis=1))
        counts = np.zeros(len(drawn) * groups)
        away = np.zeros(groups)
        for m in range(own.shape[1]):
            counts += np.bincount(near * groups + own[:, m], minlength=len(counts))
            away += np.bincount(own[:, m], off, groups)
        return np.concatenate([counts, away])

    found = data.sums(len(drawn) * groups + groups, weighed)
    weights, away = found[:-groups].reshape(len(drawn), groups), found[-groups:]
    sizes = weights.sum(axis=0)
    error = away / np.maximum(sizes, 1)

    def judged(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(2 * len(centres))
        every = np.arange(len(x))
        near, own = _squares(x, drawn).argmin(axis=1), label(x)
        # Differences, not products, so that a row's distance to its own cell's mean is exact; input by input.
        away_ = np.zeros((len(x), len(means)))
        for d in range(width):
            away_ += (x[:, d, None] - means[None, :, d]) ** 2
        away_ = np.sqrt(away_)
        sums = away_ @ weights
        mean = np.where(sizes > 0, sums / np.maximum(sizes, 1), np.inf)
        for m, (lo, hi) in enumerate(zip(starts, starts[1:])):
            k = own[:, m]
            others = sizes[k] - 1
            a = (sums[every, k] - away_[every, near]) / np.maximum(others, 1)
            rest = mean[:, lo:hi].copy()
            rest[every, k - lo] = np.inf
            b = rest.min(axis=1)
            alone = (others < 1) | ~np.isfinite(b)
            top = np.maximum(np.maximum(a, b), 1e-300)
            out[2 * m] += np.where(alone, 0.0, (b - a) / np.where(alone, 1.0, top)).sum()
            off_a = error[k] * sizes[k] / np.maximum(others, 1)
            off_b = error[lo:hi].max()
            room = np.maximum(top - np.maximum(off_a, off_b), 1e-300)
            out[2 * m + 1] += np.where(alone, 0.0, np.minimum((off_a + off_b) / room, 2.0)).sum()
        return out

    totals = data.sums(2 * len(centres), judged) / max(rows, 1)
    return [(float(totals[2 * m]), float(totals[2 * m + 1])) for m in range(len(centres))]
