"""Segment naming, profiles, strategies and summaries.

These operators take any ``segment`` column: cluster ids of a model, or a rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import percent
from tidemark.settings import SegmentThresholds

# Strategy per segment name
# (priority, goal, actions, campaign type, budget).
STRATEGIES = (
    (
        "Champions",
        "High",
        "Retention & Advocacy",
        (
            "Reward with exclusive benefits",
            "Ask for reviews and referrals",
            "Early access to new products",
            "VIP customer service",
        ),
        "Loyalty program, referral incentives",
        "Medium (focus on experience)",
    ),
    (
        "Loyal Customers",
        "High",
        "Upsell & Cross-sell",
        (
            "Recommend premium products",
            "Bundle offers",
            "Exclusive discounts",
            "Appreciation campaigns",
        ),
        "Product recommendations, premium offers",
        "Medium-High",
    ),
    (
        "At Risk",
        "Critical",
        "Win-back before churn",
        (
            "Personalized re-engagement campaigns",
            "Limited-time offers",
            "Survey to understand issues",
            "Special discounts",
        ),
        "Win-back emails, discount codes",
        "High (prevent churn)",
    ),
    (
        "Hibernating",
        "Medium",
        "Reactivation",
        (
            "Remind of past purchases",
            "New product announcements",
            "Aggressive discounts",
            "Limited-time comeback offers",
        ),
        "Reactivation campaigns, deep discounts",
        "Medium (ROI-dependent)",
    ),
    (
        "New Customers",
        "High",
        "Onboarding & Second Purchase",
        (
            "Welcome series",
            "Product education",
            "First-repeat purchase incentive",
            "Build engagement",
        ),
        "Onboarding emails, next-purchase coupon",
        "High (critical period)",
    ),
    (
        "Promising",
        "Medium-High",
        "Accelerate to Champions",
        (
            "Encourage higher frequency",
            "Category expansion offers",
            "Loyalty program enrollment",
            "Engagement campaigns",
        ),
        "Frequency incentives, cross-category offers",
        "Medium",
    ),
    (
        "Need Attention",
        "Medium",
        "Prevent decline",
        (
            "Engagement campaigns",
            "Value propositions",
            "Special offers",
            "Feedback surveys",
        ),
        "Engagement emails, moderate discounts",
        "Low-Medium",
    ),
    (
        "Lost/Churned",
        "Low",
        "Low-cost reactivation attempts",
        (
            "Minimal-cost reactivation",
            "Only if high CLV",
            "Generic re-engagement",
            "Opt-out option",
        ),
        "Automated win-back (low cost)",
        "Low (only high-CLV customers)",
    ),
)


def segment_name(
    recency: Column,
    frequency: Column,
    monetary: Column,
    limits: SegmentThresholds = SegmentThresholds(),
) -> Column:
    """Business name by the first rule that fits."""
    t = limits
    rules = [
        (
            "Champions",
            (recency < t.champion_recency)
            & (frequency > t.champion_frequency)
            & (monetary > t.champion_monetary),
        ),
        ("Loyal Customers", (frequency > t.loyal_frequency) & (monetary > t.loyal_monetary)),
        (
            "At Risk",
            (recency > t.risk_recency)
            & (frequency > t.risk_frequency)
            & (monetary > t.risk_monetary),
        ),
        (
            "Hibernating",
            (recency > t.hibernating_recency) & (frequency > t.hibernating_frequency),
        ),
        ("New Customers", (recency < t.new_recency) & (frequency < t.new_frequency)),
        ("Promising", (recency < t.promising_recency) & (frequency >= t.promising_frequency)),
        ("Need Attention", (recency < t.attention_recency) & (frequency >= t.attention_frequency)),
    ]
    named = F
    for name, rule in rules:
        named = named.when(rule, F.lit(name))
    return named.otherwise(F.lit("Lost/Churned"))


def name_customers(
    features: DataFrame, limits: SegmentThresholds = SegmentThresholds()
) -> DataFrame:
    """Apply the naming rules to every feature row itself."""
    return features.withColumn(
        "segment_name",
        segment_name(
            F.col("rfm_recency_days"),
            F.col("rfm_frequency_count"),
            F.col("rfm_monetary_avg"),
            limits,
        ),
    )


def segment_profiles(
    assigned: DataFrame, limits: SegmentThresholds = SegmentThresholds()
) -> DataFrame:
    """Size, share, means, revenue and name per ``segment``.

    ``avg_churn_risk`` and ``avg_clv`` appear when the input has the scores.
    """
    optional = {"churn_probability": "avg_churn_risk", "clv_prediction": "avg_clv"}
    grouped = assigned.groupBy("segment").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("rfm_recency_days").alias("avg_recency"),
        F.avg("rfm_frequency_count").alias("avg_frequency"),
        F.avg("rfm_monetary_avg").alias("avg_monetary"),
        F.sum("rfm_monetary_total").alias("total_revenue"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        F.avg("days_since_first_purchase").alias("avg_customer_age_days"),
        *[F.avg(c).alias(name) for c, name in optional.items() if c in assigned.columns],
    )
    # One row per segment from here on.
    total = F.sum("size").over(_everything())
    return (
        grouped.withColumn("size_pct", percent(F.col("size"), total))
        .withColumn(
            "segment_name",
            segment_name(
                F.col("avg_recency"), F.col("avg_frequency"), F.col("avg_monetary"), limits
            ),
        )
        .select(
            "segment",
            "size",
            "size_pct",
            "avg_recency",
            "avg_frequency",
            "avg_monetary",
            "total_revenue",
            "avg_engagement_score",
            "avg_customer_age_days",
            *[name for c, name in optional.items() if c in assigned.columns],
            "segment_name",
        )
    )


def _everything() -> WindowSpec:
    """A window over a whole table of a few report rows."""
    return W.partitionBy(F.lit(0))


def name_assignments(assigned: DataFrame, profiles: DataFrame) -> DataFrame:
    """Give every row the name of its segment (one broadcast row per segment)."""
    return assigned.join(
        F.broadcast(profiles.select("segment", "segment_name")), "segment", "left"
    )


def strategies(spark: SparkSession) -> DataFrame:
    rows = [(n, p, g, list(a), t, b) for n, p, g, a, t, b in STRATEGIES]
    return spark.createDataFrame(
        rows,
        "segment_name string, priority string, goal string, actions array<string>, "
        "campaign_type string, budget_allocation string",
    )


def strategy_report(profiles: DataFrame) -> DataFrame:
    """Profiles with the strategy of their name."""
    return profiles.select("segment", "segment_name", "size", "size_pct").join(
        F.broadcast(strategies(profiles.sparkSession)), "segment_name"
    )


def segment_summary(profiles: DataFrame) -> DataFrame:
    """Rounded table with business column names."""
    return profiles.select(
        F.col("segment").alias("Segment ID"),
        F.col("segment_name").alias("Segment Name"),
        F.col("size").alias("Customer Count"),
        F.col("size_pct").alias("Percentage (%)"),
        F.round("avg_recency", 1).alias("Avg Days Since Purchase"),
        F.round("avg_frequency", 1).alias("Avg Transactions"),
        F.round("avg_monetary", 2).alias("Avg Order Value ($)"),
        F.round("total_revenue", 2).alias("Total Revenue ($)"),
    )


def top_segments(profiles: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` largest by size and by revenue."""
    out = None
    for measure in ("size", "total_revenue"):
        part = (
            profiles.orderBy(F.desc(measure), "segment")
            .limit(n)
            .select(
                F.lit(measure).alias("measure"),
                "segment",
                "segment_name",
                F.col(measure).cast("double").alias("value"),
            )
        )
        out = part if out is None else out.unionByName(part)
    return out


def min_max_scaled(profiles: DataFrame, columns: Sequence[str], key: str = "segment") -> DataFrame:
    """Columns scaled to 0..1 over the profile rows; NULL where all are equal."""
    w = _everything()
    return profiles.select(
        key,
        *[
            (
                (F.col(c) - F.min(c).over(w))
                / F.nullif((F.max(c).over(w) - F.min(c).over(w)).cast("double"), F.lit(0.0))
            ).alias(c)
            for c in columns
        ],
    )


def comparison_metrics(
    profiles: DataFrame,
    metrics: Sequence[str] = (
        "avg_recency",
        "avg_frequency",
        "avg_monetary",
        "avg_engagement_score",
    ),
    key: str = "segment",
) -> DataFrame:
    """Scaled metrics for a segment comparison; needs three of them."""
    present = [m for m in metrics if m in profiles.columns]
    if len(present) < 3:
        raise ValueError("a comparison needs at least three metrics")
    return min_max_scaled(profiles, present, key)


def revenue_share(profiles: DataFrame, key: str = "segment") -> DataFrame:
    """Revenue, its share, and the mean over segments."""
    w = _everything()
    return profiles.select(
        key,
        "total_revenue",
        percent(F.col("total_revenue"), F.sum("total_revenue").over(w)).alias("revenue_pct"),
        F.avg("total_revenue").over(w).alias("avg_revenue"),
    )


def chart_sample(customers: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """At most ``n`` customers for a scatter plot: the same ones on every run."""
    mixed = F.md5(F.concat(F.col("customer_id").cast("string"), F.lit(f":{seed}")).cast("binary"))
    return customers.orderBy(mixed, "customer_id").limit(n)
