"""Overlapping time windows over all snapshots at once, without repeating lines.

A line belongs to about six monthly 180-day windows, and to many more weekly
ones.  Joining lines with snapshots would multiply the largest table by that
factor.  Instead the time axis is cut at every window bound.  Between two cuts
(a *pane*) all lines belong to exactly the same windows, so lines are first
aggregated to (key, pane) -- map-side, which also flattens a customer that owns
a large share of all lines -- and only those few rows are repeated.

The calendar tables are built from the snapshot list alone.  Their size is
bounded by days in range + snapshots x bounds, never by the data, which is why
they may be broadcast.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import DAY_MICROS, micros


@dataclass(frozen=True)
class Span:
    """A window relative to a snapshot, in days; the end is always included."""

    name: str
    start_days: int
    end_days: int
    start_open: bool = False

    @property
    def begin(self) -> int:
        return self.start_days * DAY_MICROS + (1 if self.start_open else 0)

    @property
    def stop(self) -> int:
        """First microsecond after the window."""
        return self.end_days * DAY_MICROS + 1


@dataclass(frozen=True)
class Calendar:
    """``pieces``: day and pane bounds; ``coverage``: which windows hold a pane."""

    pieces: DataFrame
    coverage: DataFrame
    first_us: int
    last_us: int


def build_calendar(snapshots: DataFrame, spans: Sequence[Span]) -> Calendar:
    """Calendar tables for ``spans`` around every row of ``snapshots``."""
    spark = snapshots.sparkSession
    # The snapshot list is a calendar: a few hundred rows for decades of data.
    at = sorted(r[0] for r in snapshots.select(micros("snapshot_date")).distinct().collect())
    cuts = sorted({s + b for s in at for w in spans for b in (w.begin, w.stop)})
    pieces = [
        (day, lo, hi)
        for lo, hi in zip(cuts, cuts[1:])
        for day in range(lo // DAY_MICROS, (hi - 1) // DAY_MICROS + 1)
    ]
    coverage = []
    for s in at:
        lo = bisect_left(cuts, s + min(w.begin for w in spans))
        hi = bisect_left(cuts, s + max(w.stop for w in spans))
        for pane in cuts[lo:hi]:
            inside = [s + w.begin <= pane < s + w.stop for w in spans]
            if any(inside):
                coverage.append((pane, s, *inside))
    flags = ", ".join(f"in_{w.name} boolean" for w in spans)
    piece_df = spark.createDataFrame(pieces, "day_no long, pane long, pane_end long")
    cover_df = spark.createDataFrame(coverage, f"pane long, snapshot_us long, {flags}")
    return Calendar(
        piece_df,
        cover_df.withColumn("snapshot_date", F.timestamp_micros("snapshot_us")),
        cuts[0] if cuts else 0,
        cuts[-1] if cuts else 0,
    )


def into_panes(
    lines: DataFrame,
    calendar: Calendar,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    by_day: bool = False,
) -> DataFrame:
    """Aggregate lines to (keys, pane), or (keys, day, pane); lines in no window drop out."""
    timed = within(lines, calendar).withColumn("__us", micros("InvoiceDate")).withColumn(
        "day_no", F.floor(F.col("__us") / F.lit(DAY_MICROS))
    )
    placed = timed.join(F.broadcast(calendar.pieces), "day_no").where(
        (F.col("__us") >= F.col("pane")) & (F.col("__us") < F.col("pane_end"))
    )
    grain = [*keys, "day_no", "pane"] if by_day else [*keys, "pane"]
    return placed.groupBy(*grain).agg(*aggregates)


def over_snapshots(panes: DataFrame, calendar: Calendar) -> DataFrame:
    """Repeat pane rows for every snapshot they matter to, with one flag per window."""
    return panes.join(F.broadcast(calendar.coverage), "pane")


#: Lines whose pane rows one task takes.
TASK_LINES = 100_000


def within(lines: DataFrame, calendar: Calendar) -> DataFrame:
    """Lines in the calendar's range."""
    # The outer bounds are literals, so they reach the scan as pushed filters.
    return lines.where(
        (F.col("InvoiceDate") >= F.timestamp_micros(F.lit(calendar.first_us)))
        & (F.col("InvoiceDate") < F.timestamp_micros(F.lit(calendar.last_us)))
    )


#: For tables of many rows: read a few times, so that their size counts for more than the time to pack them.
PACKED = {"compression": "zstd"}
#: Tables that lie by customer meet where they are, also on customer and snapshot.
WHERE_THEY_ARE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def many(lines: DataFrame) -> bool:
    """Whether ``spread_by`` counts out the tasks; fewer rows are laid out as Spark likes."""
    return lines.count() > TASK_LINES


def spread_by(panes: DataFrame, lines: DataFrame, *keys: str) -> DataFrame:
    """Place pane rows by key before repeating them.

    The repeat and the aggregation by (keys, snapshot) that follows then stay in
    the partition.  A key has at most one row per pane (and day), so one hot
    key is bounded by the calendar.  The number of partitions follows the counted ``lines`` behind
    the panes: sizes at run time are those before the repeat, and partitions merged by
    them would hold many times as much after it.
    """
    n = lines.count()
    if n <= TASK_LINES:  # any number of tasks will do
        return panes.repartition(*keys)
    return panes.repartition(max(math.ceil(n / TASK_LINES), panes.sparkSession.sparkContext.defaultParallelism), *keys)
