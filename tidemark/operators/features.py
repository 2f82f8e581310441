"""Point-in-time customer features for all snapshots in one job.

Grain and shuffles, for L lines:

* activity (RFM, windows, gaps, engagement, trend): lines -> (customer, day,
  pane) by one shuffle, placed by customer by another -> features; nothing
  larger than L moves.
* products: lines -> (customer, product, pane), placed by customer; all
  snapshots are derived there.
* baskets: lines -> (customer, invoice, pane), placed by invoice -> partial sums
  -> (customer, snapshot).

"Transactions" are invoice lines, as in the column definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import DAY_MICROS, ratio, whole_days_from_micros
from tidemark.functions.staging import stage
from tidemark.operators.panes import (
    Calendar,
    Span,
    PACKED,
    WHERE_THEY_ARE,
    build_calendar,
    into_panes,
    many,
    over_snapshots,
    spread_by,
    within,
)
from tidemark.settings import FeatureRules

KEYS = ("customer_id", "snapshot_date")

RFM = (
    "rfm_recency_days",
    "rfm_frequency_count",
    "rfm_monetary_avg",
    "rfm_monetary_total",
    "rfm_monetary_std",
    "days_since_first_purchase",
    "customer_lifetime_days",
)
GAPS = (
    "interpurchase_time_mean",
    "interpurchase_time_std",
    "interpurchase_time_median",
    "interpurchase_time_cv",
    "purchase_frequency_per_month",
)
PRODUCT = (
    "unique_products_count",
    "avg_basket_size",
    "std_basket_size",
    "return_rate",
    "product_diversity_hhi",
)
ENGAGEMENT = (
    "engagement_score",
    "engagement_score_normalized",
    "consistency_score",
    "activity_score",
)
TREND = (
    "revenue_trend_slope",
    "transaction_trend_slope",
    "revenue_trend_direction",
    "transaction_trend_direction",
)
METADATA = ("snapshot_date", "observation_start_date", "observation_window_days")


def window_columns(rules: FeatureRules = FeatureRules()) -> list[str]:
    return [
        f"{kind}_{name}_{days}d" for name, days in rules.windows for kind in ("txn_count", "revenue")
    ]


def feature_columns(rules: FeatureRules = FeatureRules()) -> list[str]:
    """The 33 features in table order."""
    return [*RFM, *window_columns(rules), *GAPS, *PRODUCT, *ENGAGEMENT, *TREND]


def feature_spans(rules: FeatureRules = FeatureRules()) -> list[Span]:
    return [
        Span("observation", -rules.observation_days, 0),
        *[Span(name, -days, 0) for name, days in rules.windows],
    ]


def by_customer(lines: DataFrame) -> DataFrame:
    return lines.withColumnRenamed("CustomerID", "customer_id")


# --- activity ---------------------------------------------------------------


def _daily(lines: DataFrame, calendar: Calendar) -> DataFrame:
    """(customer, day, pane) rows with everything the activity features need."""
    revenue = F.col("Revenue")
    return into_panes(
        by_customer(lines).select("customer_id", "InvoiceDate", "Revenue", "is_return"),
        calendar,
        ["customer_id"],
        [
            F.count(F.lit(1)).alias("n"),
            F.sum(revenue).alias("revenue"),
            F.avg(revenue).alias("mean"),
            (F.var_pop(revenue) * F.count(F.lit(1))).alias("spread"),
            F.count_if("is_return").alias("returned"),
            F.min("__us").alias("first_us"),
            F.max("__us").alias("last_us"),
        ],
        by_day=True,
    )


def _with_previous(placed: DataFrame) -> DataFrame:
    """Add the previous visit, and an anchor value for stable variance sums.

    The window holds one customer's days, so it is bounded by the calendar.
    """
    life = W.partitionBy("customer_id").orderBy("first_us")
    return placed.withColumns(
        {
            "previous_us": F.lag("last_us").over(life),
            "anchor": F.first("mean").over(life),
        }
    )


def _activity_rows(lines: DataFrame, calendar: Calendar, rules: FeatureRules) -> DataFrame:
    """Day rows repeated for the snapshots that observe them, with the gap before each."""
    c = F.col
    reach = rules.observation_days * DAY_MICROS
    # A gap counts when both of its ends are in the window.
    gap = F.when(
        c("previous_us") >= c("snapshot_us") - reach,
        whole_days_from_micros(c("previous_us"), c("first_us")),
    )
    placed = spread_by(_daily(lines, calendar), within(lines, calendar), "customer_id")
    return (
        over_snapshots(_with_previous(placed), calendar)
        .where("in_observation")
        .withColumn("gap", gap)
    )


def _with_middle_gap(rows: DataFrame) -> DataFrame:
    """Add ``middle``: what a row's gap adds to the median of its customer's gaps.

    The m gaps between consecutive lines, sorted, are some zeros (lines of one
    day) and then the positive gaps before the days.  The j-th largest of these
    stands at index m - j; the median is the mean of the entries at the two
    middle indexes.  The window holds one row per day of one observation window.
    """
    c = F.col
    by_gap = W.partitionBy(*KEYS).orderBy(F.desc_nulls_last("gap"))
    whole = by_gap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    placed = rows.withColumns(
        {"m": F.sum("n").over(whole) - 1, "j": F.row_number().over(by_gap)}
    )
    index = c("m") - c("j")
    low, high = F.floor((c("m") - 1) / 2), F.ceil((c("m") - 1) / 2)
    hits = (index == low).cast("int") + (index == high).cast("int")
    return placed.withColumn("middle", F.when(c("gap") > 0, c("gap") * hits / 2)).drop("m", "j")


def _with_month_place(rows: DataFrame) -> DataFrame:
    """Add ``place``: the row's month among the active months, centred, and their number.

    The least-squares slope over months 0..m-1 is the sum of (i - (m-1)/2) y_i
    over m(m^2-1)/12, and that sum can be taken row by row.
    """
    day = F.date_from_unix_date(F.col("day_no").cast("int"))
    by_month = W.partitionBy(*KEYS).orderBy("month_no")
    whole = by_month.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (
        rows.withColumn("month_no", F.year(day) * 12 + F.month(day))
        .withColumn("i", F.dense_rank().over(by_month))
        .withColumn("months", F.max("i").over(whole))
        .withColumn("place", F.col("i") - (F.col("months") + 1) / 2)
        .drop("i", "month_no")
    )


def _slope(centred_sum: Column, months: Column) -> Column:
    m = months.cast("double")
    return F.when(m >= 2, centred_sum * 12 / (m * (m * m - 1))).otherwise(F.lit(0.0))


#: Slopes nearer to zero than this are no trend: sums of cents leave rounding noise of that size.
FLAT_BELOW = 5e-7


def _direction(slope: Column) -> Column:
    return F.when(F.abs(slope) < FLAT_BELOW, F.lit(0.0)).otherwise(F.signum(slope))


def activity_features(
    lines: DataFrame, calendar: Calendar, rules: FeatureRules = FeatureRules()
) -> DataFrame:
    """RFM, window, gap, trend and the simple engagement features."""
    c = F.col
    rows = _with_month_place(_with_middle_gap(_activity_rows(lines, calendar, rules)))
    off = c("mean") - c("anchor")
    sums = rows.groupBy(*KEYS, "snapshot_us").agg(
        F.sum("n").alias("n"),
        F.sum("revenue").alias("total"),
        F.sum(c("n") * off).alias("off1"),
        F.sum(c("spread") + c("n") * off * off).alias("off2"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.sum("returned").alias("returned"),
        F.sum("gap").alias("gap1"),
        F.sum(c("gap") * c("gap")).alias("gap2"),
        F.sum("middle").alias("middle"),
        F.max("months").alias("months"),
        F.sum(c("place") * c("revenue")).alias("revenue_moment"),
        F.sum(c("place") * c("n")).alias("line_moment"),
        *[F.sum(F.when(c(f"in_{w}"), c("n"))).alias(f"n_{w}") for w, _ in rules.windows],
        *[
            F.sum(F.when(c(f"in_{w}"), c("revenue"))).alias(f"revenue_{w}")
            for w, _ in rules.windows
        ],
    )
    n = c("n").cast("double")
    variance = (c("off2") - c("off1") * c("off1") / n) / F.nullif(n - 1, F.lit(0.0))
    g = n - 1  # gaps between consecutive lines
    gap_mean = F.coalesce(c("gap1") / F.nullif(g, F.lit(0.0)), F.lit(0.0))
    gap_var = (c("gap2") - c("gap1") * c("gap1") / g) / F.nullif(g - 1, F.lit(0.0))
    gap_std = F.when(c("n") >= 3, F.sqrt(F.greatest(gap_var, F.lit(0.0)))).otherwise(F.lit(0.0))
    lifetime = whole_days_from_micros(c("first_us"), c("last_us"))
    months_active = F.coalesce(F.nullif(lifetime / F.lit(30.0), F.lit(0.0)), F.lit(1.0))
    base = sums.select(
        *KEYS,
        whole_days_from_micros(c("last_us"), c("snapshot_us")).alias("rfm_recency_days"),
        c("n").alias("rfm_frequency_count"),
        (c("total") / n).alias("rfm_monetary_avg"),
        c("total").alias("rfm_monetary_total"),
        F.coalesce(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(0.0)).alias("rfm_monetary_std"),
        whole_days_from_micros(c("first_us"), c("snapshot_us")).alias("days_since_first_purchase"),
        lifetime.alias("customer_lifetime_days"),
        *[
            col
            for w, d in rules.windows
            for col in (
                F.coalesce(c(f"n_{w}"), F.lit(0)).alias(f"txn_count_{w}_{d}d"),
                F.coalesce(c(f"revenue_{w}"), F.lit(0.0)).alias(f"revenue_{w}_{d}d"),
            )
        ],
        gap_mean.alias("interpurchase_time_mean"),
        F.coalesce(gap_std, F.lit(0.0)).alias("interpurchase_time_std"),
        F.coalesce("middle", F.lit(0.0)).alias("interpurchase_time_median"),
        (n / months_active).alias("purchase_frequency_per_month"),
        (c("returned") / n).alias("return_rate"),
        _slope(c("revenue_moment"), c("months")).alias("revenue_trend_slope"),
        _slope(c("line_moment"), c("months")).alias("transaction_trend_slope"),
    )
    name, days = rules.windows[0]
    cv = ratio(c("interpurchase_time_std"), c("interpurchase_time_mean"))
    return (
        base.withColumn("interpurchase_time_cv", cv)
        .withColumns(
            {
                "engagement_score": c("rfm_frequency_count")
                * c("rfm_monetary_avg")
                / (c("rfm_recency_days") + 1),
                "consistency_score": F.lit(1.0) / (c("interpurchase_time_cv") + 1),
                "activity_score": c(f"txn_count_{name}_{days}d") / (c("rfm_frequency_count") + 1),
                "revenue_trend_direction": _direction(c("revenue_trend_slope")),
                "transaction_trend_direction": _direction(c("transaction_trend_slope")),
            }
        )
    )


# --- products and baskets -----------------------------------------------------


#: Lines of a customer that one task takes; the products or invoices of a larger one are dealt to several.
HEAVY_LINES = 1_000_000


def _dealt(panes: DataFrame, lines: DataFrame, part: str) -> DataFrame:
    """``panes`` placed by customer and ``share``: 0, or one of several for a customer of many lines.

    Customers over HEAVY_LINES are at most one for each so many lines, so few that they are
    broadcast.  What is repeated by snapshot afterwards stays in its partition.
    """
    counts = by_customer(lines).groupBy("customer_id").agg(F.count(F.lit(1)).alias("lines"))
    heavy = counts.where(F.col("lines") > HEAVY_LINES).select(
        "customer_id", F.ceil(F.col("lines") / HEAVY_LINES).alias("shares")
    )
    share = F.pmod(F.xxhash64(part), F.coalesce("shares", F.lit(1).cast("long")))
    dealt = panes.join(F.broadcast(heavy), "customer_id", "left").withColumn("share", share)
    return spread_by(dealt.drop("shares"), lines, "customer_id", "share")


def _by_customer_again(parts: DataFrame, lines: DataFrame, calendar: Calendar) -> DataFrame:
    """The shares of a customer in one place, that of the customer's activity rows."""
    observed = within(lines, calendar)
    return spread_by(parts, observed, "customer_id") if many(observed) else parts


def product_features(lines: DataFrame, calendar: Calendar) -> DataFrame:
    """Distinct products and 1 - sum of squared line shares (diversity).

    A customer's panes lie together, or by ranges of products for a heavy one.  The rows
    repeated by snapshot are counted per product and then per customer where they are; only
    one row for each customer, share and snapshot is merged.
    """
    panes = into_panes(
        by_customer(lines).select("customer_id", "StockCode", "InvoiceDate"),
        calendar,
        ["customer_id", "StockCode"],
        [F.count(F.lit(1)).alias("n")],
    )
    per_product = (
        over_snapshots(_dealt(panes, lines, "StockCode"), calendar)
        .where("in_observation")
        .groupBy("customer_id", "share", "StockCode", "snapshot_date")
        .agg(F.sum("n").cast("double").alias("n"))
    )
    n = F.col("n")
    parts = per_product.groupBy("customer_id", "share", "snapshot_date").agg(
        F.count(F.lit(1)).alias("products"), F.sum(n).alias("n"), F.sum(n * n).alias("squares")
    )
    return _by_customer_again(parts, lines, calendar).groupBy(*KEYS).agg(
        F.sum("products").alias("unique_products_count"),
        (1 - F.sum("squares") / (F.sum(n) * F.sum(n))).alias("product_diversity_hhi"),
    )


def basket_features(lines: DataFrame, calendar: Calendar) -> DataFrame:
    """Mean and sample deviation of the absolute net quantity per invoice.

    Placed and merged like products: a heavy customer's invoices are dealt to several tasks.
    """
    panes = into_panes(
        by_customer(lines).select("customer_id", "InvoiceNo", "InvoiceDate", "Quantity"),
        calendar,
        ["customer_id", "InvoiceNo"],
        [F.sum("Quantity").alias("quantity")],
    )
    per_invoice = (
        over_snapshots(_dealt(panes, lines, "InvoiceNo"), calendar)
        .where("in_observation")
        .groupBy("customer_id", "share", "InvoiceNo", "snapshot_date")
        .agg(F.abs(F.sum("quantity")).alias("size"))
    )
    n, mean = F.col("n"), F.col("mean")
    parts = per_invoice.groupBy("customer_id", "share", "snapshot_date").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg("size").alias("mean"),
        (F.var_pop("size") * F.count("size")).alias("off"),
    )
    merged = _by_customer_again(parts, lines, calendar).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("shares"),
        F.sum(n).alias("n"),
        F.sum(n * mean).alias("total"),
        F.sum(n * mean * mean).alias("squares"),
        F.sum("off").alias("off"),
    )
    # Deviations inside the shares, and of the shares' means; there are none of the latter in one share.
    between = F.when(F.col("shares") > 1, F.greatest(F.col("squares") - F.col("total") * F.col("total") / n, F.lit(0.0)))
    off = F.col("off") + F.coalesce(between, F.lit(0.0))
    return merged.select(
        *KEYS,
        (F.col("total") / n).alias("avg_basket_size"),
        F.coalesce(F.sqrt(F.try_divide(off, n - 1)), F.lit(0.0)).alias("std_basket_size"),
    )


# --- all groups -----------------------------------------------------------------


def _best_scores(features: DataFrame) -> DataFrame:
    return features.groupBy("snapshot_date").agg(F.max("engagement_score").alias("best"))


def normalise_engagement(features: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """Score over the best score of its snapshot; one broadcast row per snapshot."""
    best = _best_scores(features) if best is None else best
    return (
        features.join(F.broadcast(best), "snapshot_date")
        .withColumn("engagement_score_normalized", ratio(F.col("engagement_score"), F.col("best")))
        .drop("best")
    )


def customer_features(
    lines: DataFrame, snapshots: DataFrame, rules: FeatureRules = FeatureRules()
) -> DataFrame:
    """All 33 features and the metadata columns, for every snapshot."""
    calendar = build_calendar(snapshots, feature_spans(rules))
    joined = (
        activity_features(lines, calendar, rules)
        .join(product_features(lines, calendar), list(KEYS))
        .join(basket_features(lines, calendar), list(KEYS))
    )
    # Read twice below (best score per snapshot, and the rows): written once.  All sides lie by customer,
    # so that none of the rows, many times those of the lines' panes, moves again.
    if many(within(lines, calendar)):
        written = stage(joined, "features", PACKED, WHERE_THEY_ARE)
        scored = normalise_engagement(written, stage(_best_scores(written), "best"))
    else:
        scored = normalise_engagement(stage(joined, "features"))
    days = rules.observation_days
    return scored.select(
        "customer_id",
        *feature_columns(rules),
        "snapshot_date",
        (F.col("snapshot_date") - F.make_dt_interval(F.lit(days))).alias("observation_start_date"),
        F.lit(days).alias("observation_window_days"),
    )


def calendar_for(snapshots: DataFrame, rules: FeatureRules = FeatureRules()) -> Calendar:
    return build_calendar(snapshots, feature_spans(rules))


def preference_features(lines: DataFrame) -> DataFrame:
    """Most frequent country and weekday (ties: smallest) and mean purchase hour.

    The counts per (customer, value) come first, so no task holds the values
    of a whole customer.
    """
    src = by_customer(lines)
    columns = {"preferred_country": "Country", "preferred_day": "DayOfWeek"}
    counts = (
        src.groupBy("customer_id", "Country", "DayOfWeek")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("Hour").alias("hours"))
    )
    out = counts.groupBy("customer_id").agg(
        (F.sum("hours") / F.sum("n")).alias("avg_purchase_hour")
    )
    for name, source in columns.items():
        per_value = counts.groupBy("customer_id", source).agg(F.sum("n").alias("n"))
        # Highest count; among equals the smallest value sorts first.
        best = per_value.groupBy("customer_id").agg(
            F.min(F.struct((-F.col("n")).alias("rank"), F.col(source).alias("value"))).alias("b")
        )
        out = out.join(best.select("customer_id", F.col("b.value").alias(name)), "customer_id")
    return out.select("customer_id", "preferred_country", "avg_purchase_hour", "preferred_day")


def with_custom_features(features: DataFrame, custom: DataFrame) -> DataFrame:
    return features.join(custom, "customer_id", "left")


def describe_features(features: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, min and max per column, one row each."""
    stats = features.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                *[F.col(c)[k].alias(k) for k in ("count", "mean", "std", "min", "max")],
            )
            for c in columns
        ]
    )
    return stats.select(F.inline(rows))


def top_engagement(features: DataFrame, n: int = 10) -> DataFrame:
    return (
        features.select(
            "customer_id",
            "rfm_recency_days",
            "rfm_frequency_count",
            "rfm_monetary_total",
            "engagement_score",
        )
        .orderBy(F.desc("engagement_score"), "customer_id")
        .limit(n)
    )
