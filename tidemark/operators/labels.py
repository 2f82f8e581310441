"""Churn labels and future-revenue targets.

Observation and prediction windows are spans of one pane calendar, so past and
future of every (customer, snapshot) come out of the same aggregation and no
join of the two is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import percent, whole_days_from_micros
from tidemark.functions.quantiles import exact_quantiles
from tidemark.operators.features import by_customer
from tidemark.operators.panes import (
    Span,
    build_calendar,
    into_panes,
    over_snapshots,
    spread_by,
    within,
)
from tidemark.settings import ChurnRules, ValueRules


def _spans(rules: ChurnRules) -> list[Span]:
    start = rules.gap_days
    end = start + rules.prediction_days
    return [
        Span("observation", -rules.observation_days, 0),
        Span("prediction", start, end, start_open=True),
        Span("validation", end, end + rules.validation_days, start_open=True),
    ]


def customer_history(
    lines: DataFrame, snapshots: DataFrame, rules: ChurnRules = ChurnRules()
) -> DataFrame:
    """Observed customers per snapshot with their later activity and eligibility."""
    calendar = build_calendar(snapshots, _spans(rules))
    panes = into_panes(
        by_customer(lines).select("customer_id", "InvoiceDate", "Revenue"),
        calendar,
        ["customer_id"],
        [
            F.count(F.lit(1)).alias("n"),
            F.sum("Revenue").alias("revenue"),
            F.min("__us").alias("first_us"),
            F.max("__us").alias("last_us"),
        ],
    )
    seen = over_snapshots(spread_by(panes, within(lines, calendar), "customer_id"), calendar)
    past = F.col("in_observation")
    grouped = seen.groupBy("customer_id", "snapshot_date", "snapshot_us").agg(
        F.sum(F.when(past, F.col("n"))).alias("transaction_count"),
        F.sum(F.when(past, F.col("revenue"))).alias("total_revenue"),
        F.min(F.when(past, F.col("first_us"))).alias("first_us"),
        F.max(F.when(past, F.col("last_us"))).alias("last_us"),
        F.coalesce(F.bool_or("in_prediction"), F.lit(False)).alias("active_later"),
        F.coalesce(F.bool_or("in_validation"), F.lit(False)).alias("returned"),
    )
    # The first purchase is inside the window by construction, so it needs no clipping.
    return grouped.where(F.col("transaction_count") > 0).select(
        "customer_id",
        "snapshot_date",
        "transaction_count",
        "total_revenue",
        F.timestamp_micros("first_us").alias("first_purchase_date"),
        F.timestamp_micros("last_us").alias("last_purchase_date"),
        whole_days_from_micros(F.col("last_us"), F.col("snapshot_us")).alias(
            "days_since_last_purchase"
        ),
        whole_days_from_micros(F.col("first_us"), F.col("last_us")).alias("tenure_days"),
        whole_days_from_micros(F.col("first_us"), F.col("snapshot_us")).alias(
            "days_in_observation"
        ),
        "active_later",
        "returned",
    )


def eligibility(history: DataFrame, rules: ChurnRules = ChurnRules()) -> DataFrame:
    """Per snapshot: customers seen, removed by each rule in order, and kept."""
    few = F.col("transaction_count") < rules.min_transactions
    young = F.col("days_in_observation") < rules.min_tenure_days
    return history.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("initial_customers"),
        F.count_if(few).alias("removed_min_transactions"),
        F.count_if(~few & young).alias("removed_min_tenure"),
        F.count_if(~few & ~young).alias("eligible_customers"),
    )


def eligible(history: DataFrame, rules: ChurnRules = ChurnRules()) -> DataFrame:
    return history.where(
        (F.col("transaction_count") >= rules.min_transactions)
        & (F.col("days_in_observation") >= rules.min_tenure_days)
    )


def _labelled(history: DataFrame, rules: ChurnRules) -> DataFrame:
    return eligible(history, rules).withColumn(
        "churn_label", F.when(F.col("active_later"), F.lit(0)).otherwise(F.lit(1))
    )


def churn_labels(
    lines: DataFrame, snapshots: DataFrame, rules: ChurnRules = ChurnRules()
) -> DataFrame:
    """1 for an eligible customer without a line in the prediction window, else 0."""
    return _labelled(customer_history(lines, snapshots, rules), rules).select(
        "customer_id",
        "snapshot_date",
        "churn_label",
        "last_purchase_date",
        "days_since_last_purchase",
        "transaction_count",
        "tenure_days",
    )


def churn_label_stats(
    lines: DataFrame, snapshots: DataFrame, rules: ChurnRules = ChurnRules()
) -> DataFrame:
    """One row per snapshot: sizes, churn rate, profile of both classes, settings."""
    labelled = _labelled(customer_history(lines, snapshots, rules), rules)
    measures = {
        "recency": "days_since_last_purchase",
        "frequency": "transaction_count",
        "revenue": "total_revenue",
    }
    classes = {"churned": 1, "active": 0}
    return labelled.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("churn_label") == 1).alias("churned_count"),
        F.count_if(F.col("churn_label") == 0).alias("active_count"),
        (F.avg("churn_label") * 100).alias("churn_rate_pct"),
        *[
            F.avg(F.when(F.col("churn_label") == flag, F.col(source))).alias(f"{group}_avg_{name}")
            for group, flag in classes.items()
            for name, source in measures.items()
        ],
        F.lit(rules.prediction_days).alias("churn_window_days"),
        F.lit(rules.observation_days).alias("observation_window_days"),
        F.lit(rules.prediction_days).alias("prediction_window_days"),
        F.lit(rules.min_tenure_days).alias("min_tenure_days"),
        F.lit(rules.min_transactions).alias("min_transactions"),
    )


def label_validation(
    lines: DataFrame, snapshots: DataFrame, rules: ChurnRules = ChurnRules()
) -> DataFrame:
    """Do churned customers stay away in the window after the prediction window?"""
    churned = _labelled(customer_history(lines, snapshots, rules), rules).where(
        F.col("churn_label") == 1
    )
    return churned.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("churned_customers"),
        F.count_if(~F.col("returned")).alias("stayed_churned"),
        F.count_if("returned").alias("returned"),
        percent(F.count_if(~F.col("returned")), F.count(F.lit(1))).alias("churn_label_precision"),
        F.lit(rules.validation_days).alias("validation_window_days"),
    )


def churn_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(
        F.count(F.lit(1)).alias("labels"),
        (F.avg("churn_label") * 100).alias("churn_rate_pct"),
    )


# --- future revenue ---------------------------------------------------------------


def clv_targets(
    lines: DataFrame,
    snapshots: DataFrame,
    rules: ValueRules = ValueRules(),
    observation_days: int = 180,
) -> DataFrame:
    """Revenue after the snapshot for every customer with features there.

    ``is_censored`` marks snapshots whose horizon runs past the last line.
    """
    calendar = build_calendar(
        snapshots,
        [
            Span("observation", -observation_days, 0),
            Span("future", 0, rules.horizon_days, start_open=True),
        ],
    )
    panes = into_panes(
        by_customer(lines).select("customer_id", "InvoiceDate", "Revenue"),
        calendar,
        ["customer_id"],
        [F.sum("Revenue").alias("revenue")],
    )
    last = lines.agg(F.max("InvoiceDate").alias("m"))
    horizon = F.col("snapshot_date") + F.make_dt_interval(F.lit(rules.horizon_days))
    return (
        over_snapshots(spread_by(panes, within(lines, calendar), "customer_id"), calendar)
        .groupBy("customer_id", "snapshot_date")
        .agg(
            F.bool_or("in_observation").alias("observed"),
            F.coalesce(
                F.sum(F.when(F.col("in_future"), F.col("revenue"))), F.lit(0.0)
            ).alias("clv_target"),
        )
        .where("observed")
        .select(
            "customer_id",
            "snapshot_date",
            "clv_target",
            (horizon > last.scalar()).alias("is_censored"),
        )
    )


# The quantiles reported for future revenue.
TARGET_QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def value_stats(values: DataFrame, column: str) -> DataFrame:
    """Mean, deviation, extremes, zero share and exact quantiles of a money column."""
    marks = exact_quantiles(values, F.col(column), TARGET_QUANTILES)
    v = F.col(column)
    return values.agg(
        F.count(v).alias("samples"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.count_if(v == 0).alias("zero_count"),
        percent(F.count_if(v == 0), F.count(v)).alias("zero_pct"),
        *[
            F.lit(m).cast("double").alias(f"p{round(q * 100)}")
            for q, m in zip(TARGET_QUANTILES, marks)
        ],
    )
