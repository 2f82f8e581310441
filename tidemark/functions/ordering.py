"""Positions and running totals over a whole frame in one global order.

``Window.orderBy`` without a partition key sends every row to one task.  Here
the rows are range-partitioned by the order, each range keeps its own running
totals, and the totals of the ranges before it (one row per range) are added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.staging import stage


def with_running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums ``totals`` (name -> value) under ``order``.

    ``order`` must be a total order (end it with a unique key); ``within``
    restarts the totals per group, which may be as large as the frame.
    """
    own = {f"__{name}": value for name, value in totals.items()}
    # The range bounds come from a sample, so the range of each row is written
    # down once and not recomputed by the two reads below.  The number of ranges
    # is left open: small data is coalesced into few, in order.
    ranged = stage(
        df.withColumns(own)
        .repartitionByRange(*[F.col(c) for c in within], *order)
        .withColumn("__range", F.spark_partition_id()),
        "ranged",
    )
    blocks = ranged.groupBy(*within, "__range").agg(*[F.sum(c).alias(f"{c}_block") for c in own])
    # One row per range and group: bounded by the number of shuffle partitions.
    earlier = W.partitionBy(*within).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        *within,
        "__range",
        *[F.coalesce(F.sum(f"{c}_block").over(earlier), F.lit(0)).alias(f"{c}_before") for c in own],
    )
    inside = (
        W.partitionBy(*within, "__range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    )
    placed = ranged.join(_few(offsets, within), [*within, "__range"])
    return placed.select(
        *df.columns,
        *[
            (F.sum(f"__{name}").over(inside) + F.col(f"__{name}_before")).alias(name)
            for name in totals
        ],
    )


def _few(offsets: DataFrame, within: Sequence[str]) -> DataFrame:
    """Without groups there is a row for each shuffle partition; groups may be many."""
    return offsets if within else F.broadcast(offsets)


def with_position(
    df: DataFrame, order: Sequence[Column], name: str = "position", within: Sequence[str] = ()
) -> DataFrame:
    """Add the 1-based position of every row in the global order, per group of ``within``.

    One range shuffle: rows are numbered where they lie sorted, and a group's
    number of rows in earlier ranges is added.
    """
    keys = [*[F.col(c) for c in within], *order]
    ranged = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__id", F.monotonically_increasing_id()),
        "ranged",
    )
    # The id is the number of the range, then 33 bits for the row in it.
    ranged = ranged.withColumns(
        {"__range": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND(F.lit(2**33 - 1))}
    )
    blocks = ranged.groupBy(*within, "__range").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first")
    )
    earlier = W.partitionBy(*within).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        *within, "__range", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__before")
    )
    placed = ranged.join(_few(offsets, within), [*within, "__range"])
    return placed.select(*df.columns, (F.col("__row") + F.col("__before")).alias(name))
