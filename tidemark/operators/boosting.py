"""Gradient-boosted trees over rows that stay in Spark.

Inputs are cut once into at most BINS bins.  A pass over the rows adds up, for every
open node, input and bin, the gradients of its rows; the driver sees these sums only
(nodes x inputs x bins, whatever the number of rows) and picks the splits.  Several
objectives on the same rows grow side by side in the same passes.

Every row keeps its margin (the prediction so far).  A new tree is grown from the margins,
so no tree is grown twice: growing on costs the new trees, and an ensemble is cut by
leaving trees out.  Rows and margins are kept by the executors, apart, so that a round replaces
the margins only: it applies its one tree to those of the round before, and every REWRITE rounds
all trees to the written rows.  So nothing is written while trees grow, and a lost executor costs
one reading of its rows and the trees since the last REWRITE.  An ensemble that has stopped leaves the passes.

A block holds its bins input by input: a tree compares a whole line of bins at once for each
node, and a row's path is put together from these bits.  Of two nodes with one parent only the
smaller is added up; the other is the rest of the parent.

Objectives: ``logistic`` and ``squared`` take Newton steps; ``quantile`` (pinball loss)
splits by gradients and then sets each leaf to the quantile of its residuals, read from
counts over GRID points that follow the residuals of the round before (mergeable, with a
rank error of about 1/GRID).

Defined results: a null input is its median over train rows; a null target is left out of
training; without validation rows all ``rounds`` trees are grown and kept; without train
rows the ensemble is empty and predicts 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.staging import stage
from tidemark.functions.workers import ship
from tidemark.sources.tables import load_table, save_table

BINS, GRID = 64, 512
#: Rows of a block, about: a pass has a fixed cost for each block, model and input.
BLOCK_ROWS = 32_768
REWRITE = 16
#: Tasks up to which the driver adds up the parts of a pass itself.
FEW = 64


@dataclass(frozen=True)
class Objective:
    kind: str  # logistic, squared or quantile
    level: float = 0.5  # of a quantile


@dataclass(frozen=True)
class Growth:
    rounds: int = 1000  # at most; validation rows decide
    patience: int = 50  # rounds without a better validation loss
    least: float = 1e-4  # share by which that many rounds have to lower it
    step: float = 0.05
    depth: int = 5  # 32 leaves
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 20
    seed: int = 42


@dataclass
class Tree:
    """Nodes by heap number: children of n are 2n and 2n + 1, the root is 1."""

    feature: np.ndarray  # -1 where a node is not split
    bin: np.ndarray  # rows of this bin or a lower one go left
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, int))

    def paths(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Which of the paths of ``depth`` steps each row takes; ``bins`` has a line for each input."""
        inner = slice(1, 1 << depth)
        right = bins[np.maximum(self.feature[inner], 0)] > self.bin[inner, None].astype(bins.dtype)
        path = np.zeros(bins.shape[1], np.min_scalar_type((1 << depth) - 1))
        steps: list[np.ndarray] = []
        for level in range(depth):
            bits = right[(1 << level) - 1 : (2 << level) - 1]
            for step in steps:  # of two halves, the one that the step leads to
                low, high = bits[: len(bits) // 2], bits[len(bits) // 2 :]
                bits = low ^ ((low ^ high) & step)
            steps.append(bits[0])
            path = path * 2 + bits[0]
        return path

    def small(self) -> Tree:
        """What rows need of a finished tree."""
        none = np.zeros(0)
        return Tree(self.feature.astype(np.int32), self.bin.astype(np.uint8), none, self.value, none, none)

    def ends(self, depth: int) -> np.ndarray:
        """Node where each path of ``depth`` steps ends: its first node that is not split, or its last."""
        last = np.arange(1 << depth, 2 << depth)
        found = last
        for up in range(1, depth + 1):
            found = np.where(self.feature[last >> up] < 0, last >> up, found)
        return found


@dataclass
class Ensemble:
    objective: Objective
    columns: tuple[str, ...]
    medians: tuple[float, ...]
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # validation loss after each tree

    def first(self, rounds: int) -> Ensemble:
        """The ensemble cut to its first trees."""
        return replace(self, trees=self.trees[:rounds], losses=self.losses[:rounds])

    def margins(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), self.base)
        if not self.trees:
            return out
        # Every input is binned once by the thresholds of all trees.
        feature, threshold = (np.stack([getattr(t, c) for t in self.trees]) for c in ("feature", "threshold"))
        cuts = [np.unique(threshold[feature == f]) for f in range(len(self.columns))]
        bins = np.zeros((len(cuts), len(values)), np.min_scalar_type(max(map(len, cuts))))
        place = np.zeros(feature.shape, int)
        for f, c in enumerate(cuts):
            bins[f] = np.where(np.isnan(values[:, f]), 0, np.searchsorted(c, values[:, f]))
            place[feature == f] = np.searchsorted(c, threshold[feature == f])
        for t, at in zip(self.trees, place):
            out += t.value[t.ends(self.depth)][replace(t, bin=at).paths(bins, self.depth)]
        return out

    def predicted(self, spark: SparkSession) -> Column:
        """Prediction of a row from its input columns; a probability if logistic."""
        ship(spark)
        margins, logistic = self.margins, self.objective.kind == "logistic"
        width = len(self.columns)

        def score(inputs: pa.Array) -> pa.Array:
            found = margins(inputs.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            return pa.array(_chance(found) if logistic else found)

        return F.arrow_udf(score, "double")(filled(self.columns, self.medians))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes of all trees, in order."""
        rows = [
            (k, n, int(t.feature[n]), float(t.threshold[n]), float(t.value[n]), float(t.gain[n]), int(t.rows[n]))
            for k, t in enumerate(self.trees)
            for n in range(1, len(t.feature))
            if n == 1 or t.feature[n // 2] >= 0
        ]
        schema = "tree int, node int, feature int, threshold double, value double, gain double, rows long"
        return spark.createDataFrame(rows, schema)

    def importance(self, spark: SparkSession) -> DataFrame:
        """Total gain of each input column over all splits."""
        names = spark.createDataFrame(list(enumerate(self.columns)), "feature int, name string")
        gains = self.nodes(spark).where("feature >= 0").groupBy("feature").agg(F.sum("gain").alias("importance"))
        found = F.broadcast(names).join(gains, "feature", "left")
        return found.select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))

    def save(self, spark: SparkSession, path: str) -> None:
        save_table(self.nodes(spark), f"{path}/nodes")
        facts = (
            self.objective.kind, self.objective.level, list(self.columns), [float(m) for m in self.medians],
            float(self.base), self.depth, len(self.trees), [float(x) for x in self.losses],
        )
        schema = (
            "kind string, level double, columns array<string>, medians array<double>, base double, "
            "depth int, trees int, losses array<double>"
        )
        save_table(spark.createDataFrame([facts], schema), f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        f = load_table(spark, f"{path}/facts").first()
        trees = [Tree.empty(f["depth"]) for _ in range(f["trees"])]
        for r in load_table(spark, f"{path}/nodes").collect():  # bounded by the model
            t, n = trees[r["tree"]], r["node"]
            t.feature[n], t.threshold[n], t.value[n] = r["feature"], r["threshold"], r["value"]
            t.gain[n], t.rows[n] = r["gain"], r["rows"]
        known = (tuple(f["columns"]), tuple(f["medians"]), f["base"], f["depth"])
        return cls(Objective(f["kind"], f["level"]), *known, trees, list(f["losses"]))


def filled(columns: Sequence[str], medians: Sequence[float]) -> Column:
    """Inputs as an array of doubles, nulls replaced."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in zip(columns, medians)])


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def slopes(how: Objective, y: np.ndarray, margin: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Negative gradient and curvature of each row's loss."""
    if how.kind == "logistic":
        p = _chance(margin)
        return weight * (y - p), weight * p * (1 - p)
    if how.kind == "squared":
        return weight * (y - margin), weight
    return weight * (how.level - (y <= margin)), weight


def losses(how: Objective, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    if how.kind == "logistic":
        return np.logaddexp(0, margin) - y * margin
    if how.kind == "squared":
        return (y - margin) ** 2
    return np.maximum(how.level * (y - margin), (how.level - 1) * (y - margin))


# --- passes over the rows ------------------------------------------------------------


#: Columns of a block: many rows packed in one, so that a pass moves few, large values.
_KINDS = {"id": "<i8", "y": "<f8", "weight": "<f8", "held": "?", "bins": "u1"}
_BLOCK = ", ".join(f"{c} binary" for c in _KINDS)
#: Bytes before the values of a column, so that these stay aligned; the first is the number of different ones, 0 for many.
_HEAD = 8


def _coded(values: np.ndarray) -> bytes:
    """A column of a block: of few different values these and a byte for each row, of one only itself."""
    own, at = np.unique(values, return_inverse=True)
    if len(own) > 255:
        return bytes(_HEAD) + values.tobytes()
    own = np.append(own, np.zeros(-own.nbytes % 8, "u1").view(own.dtype)) if own.nbytes % 8 else own
    return bytes([at.max(initial=0) + 1]).ljust(_HEAD, b"\0") + own.tobytes() + (at.astype("u1").tobytes() if at.any() else b"")


def _decoded(data: bytes, kind: str, rows: int) -> np.ndarray:
    if not data[0]:
        return np.frombuffer(data, kind, offset=_HEAD)
    own = np.frombuffer(data, kind, data[0], _HEAD)
    start = _HEAD + -(-own.nbytes // 8) * 8
    return own[np.frombuffer(data, "u1", offset=start)] if data[0] > 1 else np.repeat(own, rows)


def _numbers(data: bytes, rows: int) -> np.ndarray:
    """Ids of a block: the first of numbers without a gap, or all."""
    found = np.frombuffer(data, "<i8")
    return found if len(found) == rows else found[0] + np.arange(rows)


def _block(row: Row, inputs: int) -> dict[str, np.ndarray]:
    bins = np.frombuffer(row["bins"], "u1").reshape(inputs, -1)
    rows = bins.shape[1]
    found = {c: _decoded(row[c], _KINDS[c], rows) for c in ("y", "weight", "held")}
    return {"id": _numbers(row["id"], rows), "bins": bins, **found}


def _packed(block: dict[str, np.ndarray]) -> pa.RecordBatch:
    block = {c: np.ascontiguousarray(block[c], kind) for c, kind in _KINDS.items()}
    ids = block["id"]
    found = {c: _coded(block[c]) for c in ("y", "weight", "held")}
    found["id"] = ids[:1].tobytes() if (np.diff(ids) == 1).all() else ids.tobytes()
    found["bins"] = block["bins"].tobytes()
    return pa.RecordBatch.from_arrays([pa.array([found[c]], pa.binary()) for c in _KINDS], list(_KINDS))


@dataclass
class _State:
    """What a pass needs to know of the ensembles that still grow."""

    objectives: list[Objective]
    places: list[int]  # lines of the margins that are theirs
    depth: int
    inputs: int
    round: int
    rules: Growth
    plain: bool  # all weights are 1

    def read(self, held: tuple[Row, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """A block, and its margins by model."""
        row, margins = held
        return _block(row, self.inputs), margins[self.places]

    def planes(self, how: Objective) -> int:
        """Sums that a pass takes for each cell."""
        return 2 if self.plain and how.kind != "logistic" else 3

    def drawn(self, ids: np.ndarray) -> np.ndarray:
        """The rows of this round's sample, the same in all its passes."""
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ np.uint64((self.rules.seed * 1_000_003 + self.round) * 0x2545F491 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return (x >> np.uint64(11)).astype(float) / (1 << 53) < self.rules.row_share


def _sums(blocks: RDD, find: Callable[[Iterator[tuple[Row, np.ndarray]]], np.ndarray]) -> np.ndarray:
    """Sum over all tasks of what ``find`` makes of the blocks of one; its size is bounded by the model."""
    parts = blocks.mapPartitions(lambda held: [find(held)])
    if blocks.getNumPartitions() > FEW:
        return parts.treeReduce(np.add)
    return sum(parts.collect())


def _level_pass(state: _State, trees: list[Tree], chosen: list[np.ndarray], level: int, nodes: list[np.ndarray]):
    """By model: two sums of the validation loss (at the root), then sums of rows by (sum, chosen input, one of ``nodes``, bin).

    The sums are gradients, curvatures and rows; of plain weights, where a curvature is 1, gradients and
    rows, or for a quantile rows at or under the margin and rows.
    """
    slots = []
    for at in nodes:
        slot = np.full(1 << level, -1)
        slot[at - (1 << level)] = np.arange(len(at))
        slots.append(slot)
    sizes = [len(at) * BINS for at in nodes]
    small = np.result_type(np.uint16, np.min_scalar_type((2 * BINS) << level)).type

    def run(blocks: Iterator[tuple[Row, np.ndarray]]) -> np.ndarray:
        loss = np.zeros((len(trees), 2))
        sums = [np.zeros((state.planes(how), len(c), size)) for how, c, size in zip(state.objectives, chosen, sizes)]
        for block, margins in map(state.read, blocks):
            y, weight, held = block["y"], block["weight"], block["held"]
            if level == 0 and held.any():
                for m, how in enumerate(state.objectives):
                    loss[m] += (weight * losses(how, y, margins[m]))[held].sum(), weight[held].sum()
            use = np.flatnonzero(~held & state.drawn(block["id"]))
            bins, y, weight, margins = block["bins"][:, use], y[use], weight[use], margins[:, use]
            for m, how in enumerate(state.objectives):
                if not sizes[m]:
                    continue
                own, margin, at, target, w = bins, margins[m], np.zeros(len(use), small), y, weight
                if level:
                    at = slots[m][trees[m].paths(bins, level)]
                    open_ = np.flatnonzero(at >= 0)
                    own, margin, at, target, w = bins[:, open_], margin[open_], at[open_].astype(small), y[open_], weight[open_]
                if state.plain and how.kind == "quantile":
                    at = at * small(2 * BINS) + (target <= margin)
                    for k, c in enumerate(chosen[m]):
                        n = np.bincount(at + own[c] * np.uint8(2), minlength=2 * sizes[m]).reshape(-1, 2)
                        sums[m][0, k] += n[:, 1]
                        sums[m][1, k] += n[:, 0]
                        sums[m][1, k] += n[:, 1]
                    continue
                at = at * small(BINS)
                g, h = slopes(how, target, margin, w)
                for k, c in enumerate(chosen[m]):
                    cell = (at + own[c]).astype(np.intp)
                    sums[m][0, k] += np.bincount(cell, g, sizes[m])
                    if len(sums[m]) == 3:
                        sums[m][1, k] += np.bincount(cell, h, sizes[m])
                    sums[m][-1, k] += np.bincount(cell, minlength=sizes[m])
        return np.concatenate([x.ravel() for m in range(len(trees)) for x in (loss[m], sums[m])])

    def by_model(found: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Loss, and gradients, curvatures and rows by (sum, one of the nodes, input, bin)."""
        out, at = [], 0
        for how, c, size, held in zip(state.objectives, chosen, sizes, nodes):
            planes = state.planes(how)
            part = found[at : at + 2 + planes * len(c) * size]
            at += len(part)
            cells = part[2:].reshape(planes, len(c), len(held), BINS).swapaxes(1, 2)
            whole = np.zeros((3, len(held), state.inputs, BINS))
            whole[2][:, c] = cells[-1]
            whole[1][:, c] = cells[-2] if planes == 3 else cells[-1]
            whole[0][:, c] = cells[0] if planes == 3 or how.kind == "squared" else how.level * cells[1] - cells[0]
            out.append((part[:2], whole))
        return out

    return run, by_model


def _smaller(tree: Tree, level: int) -> np.ndarray:
    """Of each two nodes of the level that come from a split, the one with fewer rows."""
    first = 1 << level
    if not level:
        return np.array([1])
    split = np.flatnonzero(tree.feature[first // 2 : first] >= 0) + first // 2
    return 2 * split + (tree.rows[2 * split + 1] < tree.rows[2 * split])


def _with_rest(found: np.ndarray, nodes: np.ndarray, level: int, above: np.ndarray | None) -> np.ndarray:
    """Sums of all nodes of a level: those found, and what they leave of the sums of their parents."""
    if above is None:
        return found
    out = np.zeros((3, 1 << level, *found.shape[2:]))
    place = nodes - (1 << level)
    out[:, place] = found
    rest = above[:, place // 2] - found
    # Where no row is left, nothing is: equal gains stay equal.
    rest[:2] = np.where(rest[2] > 0, rest[:2], 0.0)
    rest[1] = np.maximum(rest[1], 0.0)
    out[:, place ^ 1] = rest
    return out


def _leaf_pass(state: _State, trees: list[Tree], grids: list[np.ndarray | None]):
    """Weights of residuals by (model, leaf, grid interval), for quantiles."""
    size = (2 << state.depth) * (GRID + 1)
    ends = [t.ends(state.depth) for t in trees]

    def run(blocks: Iterator[tuple[Row, np.ndarray]]) -> np.ndarray:
        sums = np.zeros((len(trees), size))
        for block, margins in map(state.read, blocks):
            use = np.flatnonzero(~block["held"] & state.drawn(block["id"]))
            bins, y, weight = block["bins"][:, use], block["y"][use], block["weight"][use]
            for m, grid in enumerate(grids):
                if grid is not None:
                    node = ends[m][trees[m].paths(bins, state.depth)]
                    slot = np.searchsorted(grid, y - margins[m, use])
                    sums[m] += np.bincount(node * (GRID + 1) + slot, weight, size)
        return sums

    return run


# --- choices on the driver -------------------------------------------------------------


def _split(tree: Tree, level: int, sums: np.ndarray, edges: list[np.ndarray], rules: Growth) -> None:
    """Split the nodes of a level where that gains; sums are (3, node, input, bin)."""
    left = np.cumsum(sums, axis=3)
    total = left[:, :, :, -1:]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - total[0] ** 2 / total[1]
    valid = (left[2] >= rules.min_rows) & (right[2] >= rules.min_rows) & np.isfinite(gain)
    gain = np.where(valid, gain, 0.0).reshape(sums.shape[1], -1)
    best = gain.argmax(axis=1)
    for k, at in enumerate(best):
        node, f, b = (1 << level) + k, at // BINS, at % BINS
        if gain[k, at] <= 1e-12:
            continue
        tree.feature[node], tree.bin[node], tree.threshold[node] = f, b, edges[f][b]
        tree.gain[node] = gain[k, at]
        for child, side in ((2 * node, left), (2 * node + 1, right)):
            g, h, n = side[:, k, f, b]
            tree.value[child], tree.rows[child] = g / h if h else 0.0, round(n)
        tree.rows[node] = tree.rows[2 * node] + tree.rows[2 * node + 1]


def _quantiles(grid: np.ndarray, weights: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Quantiles of counted residuals, linear inside an interval."""
    total = np.cumsum(weights)
    if not total[-1]:
        return np.zeros(len(levels))
    k = np.searchsorted(total, levels * total[-1])
    lo, hi = grid[np.maximum(k - 1, 0)], grid[np.minimum(k, GRID - 1)]
    before = np.where(k > 0, total[k - 1], 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weights[k] != 0, lo + (hi - lo) * (levels * total[-1] - before) / weights[k], hi)


def _next_grid(grid: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Points at equal shares of the residuals just counted, and the ends of the old grid."""
    inner = _quantiles(grid, weights, (np.arange(GRID - 2) + 0.5) / (GRID - 2))
    return np.maximum.accumulate(np.concatenate([grid[:1], inner, grid[-1:]]))


def best_round(losses: Sequence[float], patience: int, least: float = 0.0) -> tuple[int, bool]:
    """(round of the least loss, whether patience ran out), from 1.

    Patience runs out after ``patience`` rounds that together lower the loss by a share of at most ``least``.
    """
    mark = 0
    for i, loss in enumerate(losses):
        if loss < losses[mark] - least * abs(losses[mark]):
            mark = i
        elif i and i - mark >= patience:
            return int(np.argmin(losses[: i + 1])) + 1, True
    return (int(np.argmin(losses)) if losses else 0) + 1, False


# --- growing -------------------------------------------------------------------------------


def edges_of(train: DataFrame, columns: Sequence[str]) -> tuple[tuple[float, ...], list[np.ndarray]]:
    """Median and upper bounds of bins of each input, from mergeable sketches."""
    points = [(i + 1) / BINS for i in range(BINS - 1)]
    found = train.agg(
        *[F.percentile_approx(F.col(c).cast("double"), [0.5, *points], 10_000).alias(str(i)) for i, c in enumerate(columns)]
    ).first()
    medians = tuple(float(found[i][0]) if found[i] else 0.0 for i in range(len(columns)))
    return medians, [np.unique(np.array(found[i][1:], float)) if found[i] else np.zeros(1) for i in range(len(columns))]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of the batches, BLOCK_ROWS or a few more at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _binned(rows: DataFrame, columns: Sequence[str], y: Column, weight: Column, held: Column,
            medians: Sequence[float], edges: list[np.ndarray]) -> DataFrame:
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            values = batch.column("inputs").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bins = np.empty(values.shape, np.uint8)
            for f, e in enumerate(edges):
                bins[:, f] = np.searchsorted(e, values[:, f])
            found = {c: batch.column(c).to_numpy() for c in ("id", "y", "weight", "held")}
            yield _packed({**found, "bins": bins.T})

    ready = rows.select(
        F.monotonically_increasing_id().alias("id"),
        y.cast("double").alias("y"),
        weight.cast("double").alias("weight"),
        held.alias("held"),
        filled(columns, medians).alias("inputs"),
    ).where(F.col("y").isNotNull())
    # Small row groups, or a few large files would be all that the passes share out.
    sized = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1"}
    return stage(ready.mapInArrow(run, _BLOCK), "binned", sized)


def _apart(rows: RDD) -> RDD:
    """Kept by the executors, one by one: then rows and margins meet without a copy."""
    return rows._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK)


def _margins(rows: RDD, inputs: int, depth: int, starts: list[float], trees: list[list[Tree]]) -> RDD:
    """Margins of the blocks by model: its start, and all its trees."""

    def made(row: Row) -> np.ndarray:
        bins = np.frombuffer(row["bins"], "u1").reshape(inputs, -1)
        out = np.repeat(np.array(starts, float)[:, None], bins.shape[1], axis=1)
        for line, own in zip(out, trees):
            for t in own:
                line += t.value[t.ends(depth)][t.paths(bins, depth)]
        return out

    return _apart(rows.map(made))


def _grown(rows: RDD, margins: RDD, inputs: int, depth: int, places: list[int], trees: list[Tree]) -> RDD:
    """Lines ``places`` of the margins, each with a tree more."""

    def made(held: tuple[Row, np.ndarray]) -> np.ndarray:
        bins = np.frombuffer(held[0]["bins"], "u1").reshape(inputs, -1)
        out = held[1][places]
        for line, t in zip(out, trees):
            line += t.value[t.ends(depth)][t.paths(bins, depth)]
        return out

    return _apart(rows.zip(margins).map(made))


def _bases(train: DataFrame, objectives: Sequence[Objective], y: Column, weight: Column) -> tuple[list[float], list]:
    """First margins, and a first grid of the target for quantiles."""
    grid = [0.0, *[(i + 0.5) / (GRID - 2) for i in range(GRID - 2)], 1.0]
    mean = F.sum(y * weight) / F.sum(F.when(y.isNotNull(), weight))
    levels = [o.level for o in objectives]
    a = train.agg(mean.alias("mean"), F.percentile_approx(y, levels).alias("q"), F.percentile_approx(y, grid).alias("grid"))
    a = a.first()
    bases, grids = [], []
    for k, o in enumerate(objectives):
        if o.kind == "logistic":
            p = min(max(a["mean"], 1e-9), 1 - 1e-9)
            bases.append(float(np.log(p / (1 - p))))
        else:
            bases.append(float(a["mean"] if o.kind == "squared" else a["q"][k]))
        span = a["grid"][-1] - a["grid"][0]
        ends = [a["grid"][0] - span, *a["grid"][1:-1], a["grid"][-1] + span]
        grids.append(np.array(ends) - bases[-1] if o.kind == "quantile" else None)
    return bases, grids


def grow(
    rows: DataFrame,
    columns: Sequence[str],
    objectives: Sequence[Objective],
    y: Column,
    weight: Column | None = None,
    rules: Growth = Growth(),
) -> list[Ensemble]:
    """An ensemble for each objective from rows of ``split`` train, cut by those of ``split`` val."""
    spark = rows.sparkSession
    ship(spark)
    columns, y = tuple(columns), y.cast("double")
    plain = weight is None
    weight = F.lit(1.0) if plain else weight.cast("double")
    train = rows.where((F.col("split") == "train") & y.isNotNull())
    medians, edges = edges_of(train, columns)
    if train.isEmpty():
        return [Ensemble(o, columns, medians, 0.0, rules.depth) for o in objectives]
    bases, grids = _bases(train, objectives, y, weight)
    both = rows.where(F.col("split").isin("train", "val"))
    seen = _binned(both, columns, y, weight, F.col("split") == "val", medians, edges)
    models = [Ensemble(o, columns, medians, b, rules.depth) for o, b in zip(objectives, bases)]
    live = list(range(len(models)))
    draw = np.random.default_rng(rules.seed)
    width, many = len(columns), max(1, round(rules.column_share * len(columns)))
    rows_ = _apart(seen.rdd)
    margins, lines = None, live
    for r in range(rules.rounds + 1):
        old = margins
        if r % REWRITE == 0:
            margins = _margins(rows_, width, rules.depth, [bases[m] for m in live], [[t.small() for t in models[m].trees] for m in live])
        else:
            margins = _grown(rows_, old, width, rules.depth, [lines.index(m) for m in live], [models[m].trees[-1].small() for m in live])
        lines, blocks = live, rows_.zip(margins)
        # Drawn for all models, so that none depends on when another stops.
        drawn = [np.sort(draw.choice(width, many, replace=False)) for _ in models]
        trees, above = {m: Tree.empty(rules.depth) for m in live}, {}
        for level in range(rules.depth):
            state = _State([objectives[m] for m in live], [lines.index(m) for m in live], rules.depth, width, r, rules, plain)
            nodes = [_smaller(trees[m], level) for m in live]
            if not sum(map(len, nodes)):
                break
            run, by_model = _level_pass(state, [trees[m] for m in live], [drawn[m] for m in live], level, nodes)
            found = dict(zip(live, zip(by_model(_sums(blocks, run)), nodes)))
            if level == 0:
                if old is not None:
                    old.unpersist()
                for m in list(live) if r else []:
                    loss, rows_held = found[m][0][0]
                    if rows_held:
                        models[m].losses.append(float(loss / rows_held))
                        if best_round(models[m].losses, rules.patience, rules.least)[1]:
                            live = [x for x in live if x != m]
                if r == rules.rounds or not live:
                    break
            for m in live:
                (_, sums), own = found[m]
                above[m] = _with_rest(sums, own, level, above.get(m))
                _split(trees[m], level, above[m], edges, rules)
        if r == rules.rounds or not live:
            break
        if any(grids[m] is not None for m in live):
            state = _State([objectives[m] for m in live], [lines.index(m) for m in live], rules.depth, width, r, rules, plain)
            counts = _sums(blocks, _leaf_pass(state, [trees[m] for m in live], [grids[m] for m in live]))
            for m, own in zip(live, counts.reshape(len(live), -1, GRID + 1)):
                if grids[m] is not None:
                    for n in np.flatnonzero(own.sum(axis=1)):
                        trees[m].value[n] = _quantiles(grids[m], own[n], np.array([objectives[m].level]))[0]
                    grids[m] = _next_grid(grids[m], own.sum(axis=0))
        for m in live:
            trees[m].value *= rules.step
            models[m].trees.append(trees[m])
    margins.unpersist()
    rows_.unpersist()
    return [m.first(best_round(m.losses, rules.patience, rules.least)[0]) if m.losses else m for m in models]
