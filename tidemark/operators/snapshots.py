"""Snapshot dates: the points in time for which customers are described."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def time_bounds(lines: DataFrame) -> DataFrame:
    """One row: first and last transaction time."""
    return lines.agg(F.min("InvoiceDate").alias("first_ts"), F.max("InvoiceDate").alias("last_ts"))


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def snapshot_dates(
    lines: DataFrame,
    frequency: str = "month_end",
    observation_days: int = 180,
    prediction_days: int = 90,
    short_range: str = "error",
) -> DataFrame:
    """Month-end or weekly (Sunday) snapshots that keep the first row's time of day.

    The first has ``observation_days`` of history, the last ``prediction_days``
    of future.  When the range is too short: ``short_range='error'`` fails the
    query, ``'latest'`` gives the last transaction time as the only snapshot.
    """
    first, last = F.col("first"), F.col("last")
    start_day, end_day = F.to_date(first), F.to_date(last)
    if frequency in ("month_end", "M", "ME"):
        days = F.transform(
            F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month")),
            lambda d: F.last_day(d),
        )
    elif frequency in ("week", "W"):
        # weekday: Monday = 0, so Sunday is 6 days after Monday.
        sunday = F.date_add(start_day, (F.lit(6) - F.weekday(start_day)) % 7)
        days = F.when(
            sunday <= end_day, F.sequence(sunday, end_day, F.expr("interval 7 days"))
        ).otherwise(F.array().cast("array<date>"))
    else:
        raise ValueError(f"unknown snapshot frequency: {frequency}")
    time_of_day = first - F.date_trunc("day", first)
    regular = F.filter(
        F.transform(days, lambda d: d.cast("timestamp") + time_of_day),
        lambda t: t.between(first, last),
    )
    if short_range == "latest":
        fallback = F.array(F.col("last_ts"))
    elif short_range == "error":
        fallback = F.raise_error(
            F.lit(f"need at least {observation_days + prediction_days} days of transactions")
        ).cast("array<timestamp>")
    else:
        raise ValueError(f"unknown short_range: {short_range}")
    return (
        time_bounds(lines)
        .withColumn("first", F.col("first_ts") + _days(observation_days))
        .withColumn("last", F.col("last_ts") - _days(prediction_days))
        .select(
            F.explode(F.when(first < last, regular).otherwise(fallback)).alias("snapshot_date")
        )
    )


def newest(snapshots: DataFrame, n: int = 1) -> DataFrame:
    """The latest ``n`` snapshots (one: single-snapshot mode)."""
    return snapshots.orderBy(F.desc("snapshot_date")).limit(n)


def at_latest_snapshot(df: DataFrame) -> DataFrame:
    """Rows of the newest snapshot of a stored table.

    The maximum is a scalar subquery, so a table partitioned by snapshot reads
    one folder of it.
    """
    top = df.agg(F.max("snapshot_date").alias("m"))
    return df.where(F.col("snapshot_date") == top.scalar())


def temporal_consistency(
    lines: DataFrame, features: DataFrame, observation_days: int = 180
) -> DataFrame:
    """Recompute count and revenue of every feature row straight from the lines.

    Independent of the pane aggregation on purpose: plain window bounds on the
    exact purchase times, one row per snapshot with the number of disagreements.
    """
    reach = _days(observation_days)
    bounds = features.select("snapshot_date").distinct().select(
        F.unix_micros("snapshot_date").alias("to"),
        F.unix_micros(F.col("snapshot_date") - reach).alias("from"),
    )
    windows = sorted((r["from"], r["to"]) for r in bounds.collect())  # one row for each snapshot
    # Time is cut before the start and after the end of each window; a line is added up under the
    # number of cuts before it, so it is counted once, however many windows hold it.
    cuts = sorted([(lo, 0) for lo, _ in windows] + [(hi, 1) for _, hi in windows])
    at = F.unix_micros("InvoiceDate")
    starts, ends = (F.array(*[F.lit(c).cast("long") for c, k in cuts if k == kind]) for kind in (0, 1))
    passed = F.size(F.filter(starts, lambda c: c <= at)) + F.size(F.filter(ends, lambda c: c < at))
    parts = lines.groupBy(F.col("CustomerID").alias("customer_id"), passed.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("Revenue").alias("revenue"), F.max("InvoiceDate").alias("last")
    )
    # At most one part for each cut.
    held = parts.groupBy("customer_id").agg(F.collect_list(F.struct("part", "n", "revenue", "last")).alias("parts"))
    places = F.array(
        *[
            F.struct(
                F.timestamp_micros(F.lit(hi)).alias("snapshot_date"),
                F.lit(cuts.index((lo, 0)) + 1).alias("first"),
                F.lit(cuts.index((hi, 1))).alias("last"),
            )
            for lo, hi in windows
        ]
    )

    def window(w: Column) -> Column:
        """The parts inside a window, added up."""
        inside = F.filter("parts", lambda p: (p["part"] >= w["first"]) & (p["part"] <= w["last"]))
        return F.struct(
            w["snapshot_date"].alias("snapshot_date"),
            F.aggregate(inside, F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias("n_again"),
            F.aggregate(inside, F.lit(0.0), lambda s, p: s + p["revenue"]).alias("revenue_again"),
            F.array_max(F.transform(inside, lambda p: p["last"])).alias("last_used"),
        )

    found = F.filter(F.transform(places, window), lambda x: x["n_again"] > 0)
    again = held.select("customer_id", F.inline(found))
    both = features.select(
        "customer_id", "snapshot_date", "rfm_frequency_count", "rfm_monetary_total"
    ).join(again, ["customer_id", "snapshot_date"], "full")
    same_n = F.col("rfm_frequency_count").eqNullSafe(F.col("n_again"))
    near_enough = F.abs(F.col("rfm_monetary_total") - F.col("revenue_again")) <= (
        F.lit(1e-6) + F.abs(F.col("revenue_again")) * 1e-9
    )
    return both.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(~same_n).alias("count_mismatches"),
        F.count_if(~F.coalesce(near_enough, F.lit(False))).alias("revenue_mismatches"),
        F.count_if(F.col("last_used") > F.col("snapshot_date")).alias("future_rows"),
    )
