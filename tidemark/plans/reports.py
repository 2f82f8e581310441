"""Business report tables from the predictions and the allocation.

Segments are those of the latest snapshot only, so a customer appears once.

Fixed values: the labels and column names of the report tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    count_text,
    money,
    percent,
    percent_text,
    plain_number,
    ratio,
)
from tidemark.functions.ordering import with_position
from tidemark.functions.quantiles import exact_quantiles

# Recommended action per campaign tier.
ACTIONS = {
    "premium": "Personal Call + 30% Discount + VIP Support",
    "standard": "Email Campaign + 20% Discount",
    "light": "Automated Email + 10% Discount",
}


def customer_action_list(
    allocation: DataFrame, segments: DataFrame | None = None, top: int | None = None
) -> DataFrame:
    """Targeted customers in order of expected value, formatted for people.

    ``top`` keeps the first ranks with a bounded top-n; the full list ranks all
    rows in parallel.
    """
    order = [F.desc("expected_value"), F.col("customer_id")]
    if top is not None:
        allocation = allocation.orderBy(*order).limit(top)
    rows = with_position(allocation, order, "priority_rank")
    columns = ["customer_id", "priority_rank", "campaign_tier"]
    if segments is not None:
        rows = rows.join(
            segments.select("customer_id", F.col("segment_name").alias("segment")),
            "customer_id",
            "left",
        )
        columns.append("segment")
    action = F.lit(None).cast("string")
    for tier, text in ACTIONS.items():
        action = F.when(F.col("campaign_tier") == tier, F.lit(text)).otherwise(action)
    return rows.select(
        *columns,
        action.alias("action"),
        F.concat(plain_number(F.col("churn_probability") * 100, 1), F.lit("%")).alias("churn_risk"),
        F.concat(F.lit("$"), plain_number(F.col("clv_prediction"), 2)).alias("expected_clv"),
        F.concat(F.lit("$"), plain_number(F.col("expected_value"), 2)).alias("expected_return"),
        F.concat(plain_number(F.col("roi") * 100, 1), F.lit("%")).alias("roi_pct"),
    )


def _segment_scores(segments: DataFrame, churn: DataFrame, clv: DataFrame) -> DataFrame:
    return (
        segments.select("customer_id", "segment_name")
        .join(churn.select("customer_id", "churn_probability"), "customer_id", "left")
        .join(clv.select("customer_id", "clv_prediction"), "customer_id", "left")
    )


def segment_report(segments: DataFrame, churn: DataFrame, clv: DataFrame) -> DataFrame:
    """Size, risk and value per segment name, formatted."""
    total = segments.agg(F.count(F.lit(1)).alias("t"))
    grouped = (
        _segment_scores(segments, churn, clv)
        .groupBy("segment_name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("churn_probability").alias("risk"),
            F.avg("clv_prediction").alias("clv"),
            F.coalesce(F.sum("clv_prediction"), F.lit(0.0)).alias("total"),
            F.count_if(F.col("churn_probability") > 0.7).alias("high"),
        )
    )
    return grouped.withColumn("share", percent(F.col("n"), total.scalar())).select(
        F.col("segment_name").alias("Segment"),
        F.col("n").alias("Customer Count"),
        percent_text(F.col("share")).alias("Percentage"),
        percent_text(F.col("risk") * 100).alias("Avg Churn Risk"),
        F.concat(F.lit("$"), F.format_string("%.2f", F.col("clv"))).alias("Avg CLV"),
        money(F.col("total")).alias("Total CLV"),
        F.col("high").alias("High Risk Count"),
    )


def impact_figures(churn: DataFrame, clv: DataFrame, portfolio: DataFrame) -> DataFrame:
    """One row of numbers: the situation without and with the campaigns.

    The baseline loss is the sum of probability times value over all customers.
    """
    loss = (
        churn.select("customer_id", "churn_probability")
        .join(clv.select("customer_id", "clv_prediction"), "customer_id")
        .agg(F.sum(F.col("churn_probability") * F.col("clv_prediction")).alias("l"))
    )
    base = churn.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("churn_probability") > 0.5).alias("churners"),
    )

    def figure(name: str) -> Column:
        return portfolio.select(name).scalar()

    return base.select(
        "customers",
        "churners",
        loss.scalar().alias("baseline_loss"),
        figure("total_campaign_cost").alias("cost"),
        figure("total_expected_revenue_saved").alias("saved"),
        figure("total_expected_net_value").alias("net"),
        figure("expected_customers_saved").alias("customers_saved"),
        figure("portfolio_roi_pct").alias("roi"),
    )


def impact_report(churn: DataFrame, clv: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Eight metrics: baseline, with campaigns, improvement."""
    c = F.col
    rate = ratio(c("churners") * 100, c("customers"))
    new_churners = c("churners") - c("customers_saved")
    new_rate = ratio(new_churners * 100, c("customers"))

    def whole(col: Column) -> Column:
        return F.format_number(col.cast("double"), 0)

    def plain(col: Column) -> Column:
        return F.format_string("%.0f", col.cast("double"))

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    loss, saved, cost, net = c("baseline_loss"), c("saved"), c("cost"), c("net")
    kept_share = ratio(c("customers_saved") * 100, c("churners"))
    rows = [
        ("Total Customers", whole(c("customers")), whole(c("customers")), text("→")),
        (
            "Customers Churning",
            whole(c("churners")),
            whole(new_churners),
            text("-", plain(c("customers_saved")), " (", plain(kept_share), "%)"),
        ),
        (
            "Churn Rate",
            percent_text(rate),
            percent_text(new_rate),
            text("-", percent_text(rate - new_rate)),
        ),
        (
            "Revenue at Risk",
            text("$", whole(loss)),
            text("$", whole(loss - saved)),
            text("$", whole(saved)),
        ),
        ("Retention Investment", text("$0"), text("$", whole(cost)), text("-$", whole(cost))),
        ("Revenue Saved", text("$0"), text("$", whole(saved)), text("+$", whole(saved))),
        (
            "Net Impact",
            text("-$", whole(loss)),
            text("$", whole(net)),
            text("+$", whole(net + loss)),
        ),
        ("ROI", text("N/A"), text(plain(c("roi")), "%"), text("+", plain(c("roi")), "%")),
    ]
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("Metric"),
                before.alias("Baseline (No Action)"),
                after.alias("With ML Optimization"),
                better.alias("Improvement"),
            )
            for name, before, after, better in rows
        ]
    )
    return impact_figures(churn, clv, portfolio).select(F.inline(table))


def data_overview(lines: DataFrame) -> DataFrame:
    """Lines, customers, date range and revenue of the cleaned data, formatted."""
    people = lines.select("CustomerID").distinct().agg(F.count(F.lit(1)).alias("n"))
    day = "yyyy-MM-dd"
    return lines.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("InvoiceDate").alias("a"),
        F.max("InvoiceDate").alias("b"),
        F.sum("Revenue").alias("r"),
    ).select(
        count_text(F.col("n")).alias("total_transactions_analyzed"),
        count_text(people.scalar()).alias("total_customers"),
        F.concat(F.date_format("a", day), F.lit(" to "), F.date_format("b", day)).alias(
            "date_range"
        ),
        money(F.col("r")).alias("total_revenue"),
    )


def segment_overview(segments: DataFrame) -> DataFrame:
    """Number of segments, the largest and the smallest (ties: first name)."""
    sizes = segments.groupBy("segment_name").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).cast("string").alias("number_of_segments"),
        F.min(F.struct((-F.col("n")).alias("n"), "segment_name"))["segment_name"].alias(
            "largest_segment"
        ),
        F.min(F.struct("n", "segment_name"))["segment_name"].alias("smallest_segment"),
    )


def churn_overview(churn: DataFrame) -> DataFrame:
    p = F.col("churn_probability")
    return churn.agg(
        percent_text(F.avg(p) * 100).alias("overall_churn_risk"),
        count_text(F.count_if(p > 0.7)).alias("high_risk_customers"),
    )


def value_overview(clv: DataFrame) -> DataFrame:
    v = F.col("clv_prediction")
    (median,) = exact_quantiles(clv, v, [0.5])
    return clv.agg(
        F.concat(F.lit("$"), F.format_string("%.2f", F.avg(v))).alias("average_clv"),
        F.concat(
            F.lit("$"), F.format_string("%.2f", F.lit(median).cast("double"))
        ).alias("median_clv"),
        money(F.sum(v)).alias("total_portfolio_clv"),
    )


def campaign_overview(portfolio: DataFrame) -> DataFrame:
    return portfolio.select(
        money(F.col("total_campaign_cost")).alias("budget_allocated"),
        count_text(F.col("total_customers_targeted")).alias("customers_targeted"),
        money(F.col("total_expected_revenue_saved")).alias("expected_revenue_saved"),
        money(F.col("total_expected_net_value")).alias("expected_net_value"),
        percent_text(F.col("portfolio_roi_pct")).alias("portfolio_roi"),
        F.format_string("%.0f", F.col("expected_customers_saved")).alias(
            "expected_customers_saved"
        ),
    )


def campaign_breakdown(allocation: DataFrame) -> DataFrame:
    return allocation.groupBy("campaign_tier").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("campaign_cost").alias("cost"),
        F.sum("expected_value").alias("value"),
    ).select(
        F.concat(F.initcap("campaign_tier"), F.lit(" Campaign")).alias("campaign"),
        count_text(F.col("n")).alias("customers"),
        money(F.col("cost")).alias("cost"),
        money(F.col("value")).alias("expected_value"),
    )


def business_summary(
    lines: DataFrame,
    segments: DataFrame,
    churn: DataFrame,
    clv: DataFrame,
    allocation: DataFrame,
    portfolio: DataFrame,
    churn_metrics: DataFrame | None = None,
    clv_metrics: DataFrame | None = None,
) -> DataFrame:
    """One row of nested totals, ready to be written as JSON.

    Model figures are included when their metric tables are given.
    """

    def as_struct(part: DataFrame, extra: list[tuple[str, Column]] = ()) -> Column:
        wide = part.select(F.struct(*[F.col(c) for c in part.columns]).alias("s")).scalar()
        if not extra:
            return wide
        for name, value in extra:
            wide = wide.withField(name, value)
        return wide

    churn_extra, value_extra = [], []
    if churn_metrics is not None:
        auc = churn_metrics.select(F.format_string("%.3f", "roc_auc").alias("v")).scalar()
        recall = churn_metrics.select(percent_text(F.col("recall") * 100).alias("v")).scalar()
        churn_extra = [("model_roc_auc", auc), ("model_recall", recall)]
    if clv_metrics is not None:
        r2 = clv_metrics.select(F.format_string("%.3f", "r2_score").alias("v")).scalar()
        value_extra = [("model_r2", r2)]
    tiers = campaign_breakdown(allocation)
    per_tier = tiers.agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in tiers.columns]))).alias("t")
    )
    return lines.sparkSession.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm").alias("report_date"),
        as_struct(data_overview(lines)).alias("data_overview"),
        as_struct(segment_overview(segments)).alias("segmentation_results"),
        as_struct(churn_overview(churn), churn_extra).alias("churn_analysis"),
        as_struct(value_overview(clv), value_extra).alias("clv_predictions"),
        as_struct(campaign_overview(portfolio)).alias("campaign_optimization"),
        per_tier.scalar().alias("campaign_breakdown"),
    )


# --- data behind the executive summary charts ---------------------------------------------


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Customers per value of ``column``, values without a label left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("label"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def value_histogram(clv: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram of predicted value; empty bins have count 0."""
    v = F.col("clv_prediction")
    edges = clv.agg(
        F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean_value")
    )
    # Cells are counted map-side; one row per bin leaves this aggregation.
    low, high = edges.select("low").scalar(), edges.select("high").scalar()
    width = (high - low) / bins
    cell = F.least(F.floor((v - low) / F.nullif(width, F.lit(0.0))).cast("int"), F.lit(bins - 1))
    counted = (
        clv.where(v.isNotNull())
        .groupBy(F.coalesce(cell, F.lit(0)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = edges.select(
        "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    step = (F.col("high") - F.col("low")) / bins
    return grid.join(counted, "bin", "left").select(
        (F.col("bin") + 1).alias("bin"),
        (F.col("low") + step * F.col("bin")).alias("bin_low"),
        (F.col("low") + step * (F.col("bin") + 1)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("customers"),
    )


def tier_chart(allocation: DataFrame) -> DataFrame:
    return allocation.groupBy("campaign_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("campaign_cost").alias("budget")
    )


def financial_impact(churn: DataFrame, clv: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Baseline loss, cost, saved revenue and net value as signed bars."""
    bars = [
        ("Baseline Churn Loss", -F.col("baseline_loss")),
        ("Campaign Cost", -F.col("cost")),
        ("Revenue Saved", F.col("saved")),
        ("Net Value", F.col("net")),
    ]
    table = F.array(
        *[F.struct(F.lit(k).alias("category"), v.alias("amount")) for k, v in bars]
    )
    return impact_figures(churn, clv, portfolio).select(F.inline(table))


def quality_summary(report: DataFrame, statistics: DataFrame, metadata: DataFrame) -> DataFrame:
    """Validation report, cleaning counters and feature-store facts as one table of items."""
    none = F.lit(None)
    checks = report.select(
        F.lit("validation").alias("section"), F.col("check").alias("item"), "status", none.cast("double").alias("value")
    )

    def items(section: str, row: DataFrame, names: list[str]) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in names]
        found = row.select(F.inline(F.array(*cells)))
        return found.select(F.lit(section).alias("section"), "item", none.cast("string").alias("status"), "value")

    counters = items("cleaning", statistics, statistics.columns)
    facts = items("features", metadata, ["n_customers", "n_snapshots", "n_features"])
    made = metadata.select(
        F.lit("features").alias("section"),
        F.lit("created_at").alias("item"),
        F.col("created_at").cast("string").alias("status"),
        none.cast("double").alias("value"),
    )
    return checks.unionByName(counters).unionByName(facts).unionByName(made)
