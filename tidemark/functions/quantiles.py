"""Exact order statistics and quantiles without sorting the data.

The built-in ``percentile`` keeps every distinct value of a group in one task,
which is unbounded for prices or revenues.  Here a mergeable sketch only
brackets the wanted ranks; exact counts then confirm the bracket, and the
bracket is narrowed until it holds few distinct values.  The data is scanned
two or three times, nothing large is shuffled, and the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of

GRID = 200
ACCURACY = 2_000  # rank error a tenth of a grid cell
MAX_VALUES = 100_000


@dataclass
class _Search:
    rank: int
    low: object = None
    high: object = None
    below: int = 0
    inside: int = 0
    settled: bool = False
    value: object = None
    """The answer, where a bound turned out to be it."""

    def holds(self) -> Column:
        """Values strictly between the bounds: a hot value at a bound is outside."""
        v = F.col("v")
        if self.low is None:
            return F.lit(True)
        return (v > F.lit(self.low)) & (v < F.lit(self.high))


def _measure(values: DataFrame, searches: list[_Search]) -> list[dict]:
    """Count, distinct count and quantile grid of every bracket, in one scan."""
    fractions = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    v = F.col("v")
    parts = []
    for i, s in enumerate(searches):
        inside = s.holds()
        count = lambda c: F.lit(0) if s.low is None else F.count_if(c)  # noqa: B023, E731
        kept = F.when(inside, v)
        parts += [
            count(v < F.lit(s.low)).alias(f"below{i}"),
            count(v == F.lit(s.low)).alias(f"low{i}"),
            count(v == F.lit(s.high)).alias(f"high{i}"),
            F.count_if(inside).alias(f"inside{i}"),
            F.approx_count_distinct(kept).alias(f"distinct{i}"),
            F.percentile_approx(kept, fractions, ACCURACY).alias(f"grid{i}"),
        ]
    row = values.agg(*parts).first()
    return [
        {k: row[f"{k}{i}"] for k in ("below", "low", "high", "inside", "distinct", "grid")}
        for i in range(len(searches))
    ]


def _few(distinct: int) -> bool:
    """The distinct count is off by a few percent; a fifth of the room is kept for that."""
    return distinct <= MAX_VALUES * 0.8


def _narrow(values: DataFrame, searches: list[_Search], first: dict) -> None:
    """Narrow brackets until they hold few distinct values.

    A trial bracket is bounded by two values of the present one.  Either a bound
    is the answer, or the answer lies strictly between, and the bounds leave
    the bracket with all their rows, however hot they are.
    """
    for s in searches:
        s.inside, s.settled = first["inside"], _few(first["distinct"])
    grids = {id(s): first["grid"] for s in searches}
    margin = {id(s): 1 for s in searches}
    while True:
        open_ = [s for s in searches if not s.settled]
        if not open_:
            return
        trials = []
        for s in open_:
            grid, m = grids[id(s)], margin[id(s)]
            cell = (s.rank - s.below) * GRID // max(s.inside, 1)
            low, high = max(cell - m, 0), min(cell + 1 + m, GRID)
            trials.append(_Search(s.rank, grid[low], grid[high]))
        for s, t, seen in zip(open_, trials, _measure(values, trials)):
            above_low = seen["below"] + seen["low"]
            upto = above_low + seen["inside"]
            if seen["below"] <= s.rank < above_low:
                s.value, s.settled = t.low, True
            elif above_low <= s.rank < upto:
                s.low, s.high, s.below, s.inside = t.low, t.high, above_low, seen["inside"]
                grids[id(s)], margin[id(s)] = seen["grid"], 1
                s.settled = _few(seen["distinct"])
            elif t.low != t.high and upto <= s.rank < upto + seen["high"]:
                s.value, s.settled = t.high, True
            else:
                margin[id(s)] *= 4  # the sketch missed; try a wider cell of the same grid


def _pick(values: DataFrame, searches: list[_Search]) -> dict[int, object]:
    """Values at the ranks: counts per value of the (few-valued) brackets, running sum, cut."""
    done = {s.rank: s.value for s in searches if s.value is not None}
    searches = [s for s in searches if s.value is None]
    if not searches:
        return done
    counts = values.where(any_of([s.holds() for s in searches])).groupBy("v").agg(
        F.count(F.lit(1)).alias("n")
    )
    order = W.orderBy("v")  # at most len(ranks) * MAX_VALUES rows
    upto = counts.select(
        "v",
        *[
            (F.lit(s.below) + F.sum(F.when(s.holds(), F.col("n")).otherwise(0)).over(order)).alias(
                f"u{i}"
            )
            for i, s in enumerate(searches)
        ],
    )
    row = upto.agg(
        *[
            F.min(F.when(s.holds() & (F.col(f"u{i}") > F.lit(s.rank)), F.col("v"))).alias(f"r{i}")
            for i, s in enumerate(searches)
        ]
    ).first()
    return done | {s.rank: row[f"r{i}"] for i, s in enumerate(searches)}


def _select(
    df: DataFrame, column: Column, ranks_of: Callable[[int], Sequence[int]]
) -> tuple[int, dict[int, object]]:
    values = df.select(column.alias("v")).where(F.col("v").isNotNull())
    (first,) = _measure(values, [_Search(0)])
    n = first["inside"]
    if n == 0:
        return 0, {}
    searches = [_Search(r) for r in sorted(set(ranks_of(n)))]
    _narrow(values, searches, first)
    return n, _pick(values, searches)


def kth_values(df: DataFrame, column: Column, ranks: Sequence[int]) -> dict[int, object]:
    """Exact values at 0-based ascending ``ranks`` of the non-null ``column``."""
    return _select(df, column, lambda n: [min(max(r, 0), n - 1) for r in ranks])[1]


def exact_quantiles(
    df: DataFrame, column: Column, fractions: Sequence[float]
) -> list[float | None]:
    """Exact quantiles with linear interpolation between neighbours."""

    def ranks(n: int) -> list[int]:
        spots = [p * (n - 1) for p in fractions]
        return [r for s in spots for r in (math.floor(s), math.ceil(s))]

    n, at = _select(df, column, ranks)
    if n == 0:
        return [None] * len(fractions)
    out = []
    for p in fractions:
        spot = p * (n - 1)
        low, high = at[math.floor(spot)], at[math.ceil(spot)]
        out.append(float(low) + (float(high) - float(low)) * (spot - math.floor(spot)))
    return out
