"""Registered queries: every operator over the whole given tables.

Inputs that several queries share (cleaned lines, features, label history) are
stage tables, written once per session and table folder.  ``forget()`` drops
them, so that a benchmark measures each query from the base tables.

Scores of the evaluation, allocation and report queries are plain expressions
of the features (recency over 180 as churn probability, thousandths of the
window revenue as value), so that results are the same in any engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.staging import stage
from tidemark.operators import (
    campaigns,
    cleaning,
    clustering,
    evaluation,
    features,
    labels,
    panes,
    prediction,
    quality,
    segments,
    snapshots,
)
from tidemark.plans import checks, reports
from tidemark.sources import tables
from tidemark.sources.transactions import transactions_from_star

TIGHT_BUDGET = 5035.0
TIER_BUDGET = 1203.0
AMPLE_BUDGET = 1e9

_stages: dict[tuple, object] = {}


def forget() -> None:
    _stages.clear()


def fixed(col, places: int = 4):
    """Put a double on a grid of ``places`` decimals.

    The cut lies off the half, where means of cents would fall, so that the
    last-bit differences between engines do not change the result.
    """
    scale = 10**places
    return F.floor(col * float(scale) + 0.381966) / float(scale)


def tidy(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select(
        *[
            fixed(F.col(f"`{f.name}`"), places).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


class Inputs:
    """Shared inputs of one table folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _once(self, name: str, make: Callable):
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _stages:
            _stages[key] = make()
        return _stages[key]

    def _staged(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return self._once(name, lambda: stage(make(), name))

    @property
    def raw(self) -> DataFrame:
        return transactions_from_star(self.spark, self.folder)

    @property
    def plan(self) -> cleaning.Cleaning:
        return self._once("plan", lambda: cleaning.plan_cleaning(self.raw))

    @property
    def lines(self) -> DataFrame:
        # Derived columns are cheaper to make than to read.
        return cleaning.derive(self._staged("clean", lambda: self.plan.regular()))

    @property
    def snapshots(self) -> DataFrame:
        return self._staged("snapshots", lambda: snapshots.snapshot_dates(self.lines))

    @property
    def latest(self) -> DataFrame:
        return snapshots.newest(self.snapshots)

    @property
    def calendar(self):
        return self._once("calendar", lambda: features.calendar_for(self.snapshots))

    @property
    def features(self) -> DataFrame:
        def make() -> DataFrame:
            found = features.customer_features(self.lines, self.snapshots)
            # Already written, but for one column; many rows are not written again.
            return found if panes.many(self.lines) else stage(found, "features")

        return self._once("features", make)

    @property
    def latest_features(self) -> DataFrame:
        """Only the latest snapshot is computed, not all and then filtered."""
        return self._staged(
            "latest_features", lambda: features.customer_features(self.lines, self.latest)
        )

    @property
    def activity(self) -> DataFrame:
        return self._staged(
            "activity", lambda: features.activity_features(self.lines, self.calendar)
        )

    @property
    def labels(self) -> DataFrame:
        return self._staged("labels", lambda: labels.churn_labels(self.lines, self.snapshots))

    @property
    def label_scores(self) -> DataFrame:
        return self.labels.select(
            "customer_id",
            "snapshot_date",
            "churn_label",
            (F.col("days_since_last_purchase") / F.lit(180.0)).alias("churn_probability"),
        )

    @property
    def targets(self) -> DataFrame:
        return self._staged("targets", lambda: labels.clv_targets(self.lines, self.snapshots))

    @property
    def guesses(self) -> DataFrame:
        """Future revenue next to a plain guess: the revenue of the past window."""
        past = self.activity.select(
            "customer_id",
            "snapshot_date",
            F.round(F.greatest("rfm_monetary_total", F.lit(0.0)), 2).alias("predicted"),
        )
        return self._staged(
            "guesses",
            lambda: self.targets.join(past, ["customer_id", "snapshot_date"]).select(
                "customer_id", "snapshot_date", F.col("clv_target").alias("actual"), "predicted"
            ),
        )

    @property
    def scores(self) -> DataFrame:
        p = F.col("rfm_recency_days") / F.lit(180.0)
        clv = F.round(F.greatest("rfm_monetary_total", F.lit(0.0)), 2) / F.lit(1000)

        def make() -> DataFrame:
            calendar = features.calendar_for(self.latest)
            return features.activity_features(self.lines, calendar).select(
                "customer_id",
                "rfm_recency_days",
                "rfm_frequency_count",
                "rfm_monetary_avg",
                "rfm_monetary_total",
                "engagement_score",
                "days_since_first_purchase",
                p.alias("churn_probability"),
                clv.alias("clv_prediction"),
                evaluation.risk_level(p).alias("risk_level"),
                F.floor(F.col("rfm_recency_days") / F.lit(45.0)).cast("int").alias("segment"),
            )

        return self._staged("scores", make)

    @property
    def clv(self) -> DataFrame:
        return self.scores.select("customer_id", "clv_prediction")

    @property
    def churn(self) -> DataFrame:
        return self.scores.select("customer_id", "churn_probability", "risk_level")

    @property
    def named(self) -> DataFrame:
        return segments.name_customers(self.scores)

    @property
    def profiles(self) -> DataFrame:
        return segments.segment_profiles(self.scores)

    @property
    def tight(self) -> DataFrame:
        return self._staged(
            "tight", lambda: campaigns.allocate_budget(self.clv, self.churn, TIGHT_BUDGET)
        )

    @property
    def portfolio(self) -> DataFrame:
        return campaigns.portfolio_totals(self.tight)

    @property
    def churn_rows(self) -> DataFrame:
        return self._once(
            "churn_rows",
            lambda: prediction.training_rows(self.features, self.labels, "churn_label"),
        )

    @property
    def churn_model(self):
        return self._once("churn_model", lambda: prediction.train_churn(self.churn_rows))

    @property
    def value_rows(self) -> DataFrame:
        return self._once(
            "value_rows",
            lambda: prediction.training_rows(self.features, self.targets, "clv_target"),
        )

    @property
    def value_model(self):
        return self._once("value_model", lambda: prediction.train_value(self.value_rows))

    @property
    def segmentation(self):
        return self._once(
            "segmentation",
            lambda: clustering.fit_segments(self.latest_features),
        )


KEYS = ["customer_id", "snapshot_date"]


def _pick(df: DataFrame, *columns: str) -> DataFrame:
    return tidy(df.select(*KEYS, *columns))


def _thresholds(i: Inputs) -> DataFrame:
    return evaluation.threshold_scores(i.label_scores)


def _price_filter(i: Inputs) -> DataFrame:
    valid, limits = i.plan.valid, i.plan.limits
    ok = cleaning.price_ok(limits)
    return tidy(
        valid.agg(
            F.lit(limits.max_price).alias("max_price"),
            F.count_if(ok).alias("kept"),
            F.count_if(~ok).alias("removed"),
        )
    )


def _quantity_filter(i: Inputs) -> DataFrame:
    limits = i.plan.limits
    cheap = i.plan.valid.where(cleaning.price_ok(limits))
    ok = cleaning.quantity_ok(limits)
    return tidy(
        cheap.agg(
            F.lit(limits.min_quantity).alias("min_quantity"),
            F.lit(limits.max_quantity).alias("max_quantity"),
            F.count_if(ok).alias("kept"),
            F.count_if(~ok).alias("removed"),
        )
    )


def _min_txn(i: Inputs) -> DataFrame:
    """Lines per customer after the minimum-rows rule."""
    return i.plan.lines().groupBy("CustomerID").agg(F.count(F.lit(1)).alias("lines"))


def _return_shares(i: Inputs) -> DataFrame:
    # A lower limit than the default 0.8, which no customer of these tables reaches.
    rules = cleaning.CleaningRules(high_return_share=0.3)
    return tidy(cleaning.high_return_customers(i.lines, rules))


def _date_parts(i: Inputs) -> DataFrame:
    parts = ["Year", "Month", "Day", "DayOfWeek", "Hour", "Quarter"]
    return i.lines.groupBy(*parts).agg(F.count(F.lit(1)).alias("lines"))


def _types(i: Inputs) -> DataFrame:
    return tidy(
        i.lines.groupBy("transaction_type").agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("AbsQuantity").alias("abs_quantity"),
            F.sum("AbsRevenue").alias("abs_revenue"),
        ),
        2,
    )


def _report(i: Inputs) -> DataFrame:
    return quality.validation_report(i.raw).drop("details")


def _quality_summary(i: Inputs) -> DataFrame:
    found = reports.quality_summary(
        quality.validation_report(i.raw), i.plan.statistics(), tables.feature_metadata(i.features)
    )
    return tidy(found.where(F.col("item") != "created_at"))  # the time of the run


def _pit_window(i: Inputs) -> DataFrame:
    """Lines and customers inside the observation window of every snapshot."""
    a = i.activity
    return tidy(
        a.groupBy("snapshot_date").agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("rfm_frequency_count").alias("lines"),
            F.sum("rfm_monetary_total").alias("revenue"),
        ),
        2,
    )


def _metadata(i: Inputs) -> DataFrame:
    return tables.feature_metadata(i.features).select(
        "n_customers",
        "n_snapshots",
        "n_features",
        F.array_join("snapshot_dates", ",").alias("snapshot_dates"),
    )


def _describe(i: Inputs) -> DataFrame:
    return tidy(
        features.describe_features(
            i.activity, ["rfm_recency_days", "rfm_frequency_count", "rfm_monetary_avg"]
        )
    )


def _split(i: Inputs) -> DataFrame:
    rows = evaluation.temporal_split(i.label_scores)
    return tidy(evaluation.class_distribution(rows))


def _split_rows(i: Inputs) -> DataFrame:
    return evaluation.temporal_split(i.label_scores).select(*KEYS, "split")


def _strategies(i: Inputs) -> DataFrame:
    return tidy(
        segments.strategy_report(i.profiles).withColumn("actions", F.array_join("actions", "; "))
    )


def _ample(i: Inputs) -> DataFrame:
    return tidy(campaigns.allocate_budget(i.clv, i.churn, AMPLE_BUDGET))


def _tiered(i: Inputs, strategy: str) -> DataFrame:
    rows = campaigns.assign_campaigns(i.scores, TIER_BUDGET, strategy)
    return tidy(rows)


def _compare(i: Inputs) -> DataFrame:
    return tidy(
        campaigns.compare_strategies(i.scores, TIER_BUDGET).select(
            "strategy",
            "total_customers",
            "customers_targeted",
            "budget_spent",
            "expected_roi_pct",
            "total_expected_value",
        )
    )


def _stats(i: Inputs) -> DataFrame:
    rows = stage(campaigns.assign_campaigns(i.scores, TIER_BUDGET), "assigned")
    return tidy(campaigns.assignment_stats(rows, TIER_BUDGET))


def _tier_top(i: Inputs) -> DataFrame:
    return tidy(campaigns.tier_top(i.tight))


def _summary(i: Inputs) -> DataFrame:
    s = reports.business_summary(
        i.lines, i.named, i.churn, i.clv, i.tight, i.portfolio
    )
    parts = (
        "data_overview",
        "segmentation_results",
        "churn_analysis",
        "clv_predictions",
        "campaign_optimization",
    )
    return s.select(*[F.col(f"{p}.*") for p in parts])


def _checks(i: Inputs) -> DataFrame:
    plan = campaigns.execution_plan(i.tight)
    return checks.output_checks(
        {
            "lines": i.lines,
            "features": i.latest_features,
            "segments": i.named,
            "strategies": segments.strategy_report(i.profiles),
            "labels": i.labels,
            "churn": i.churn,
            "churn_metrics": evaluation.evaluate_binary(i.label_scores, 0.5),
            "clv": i.clv,
            "clv_metrics": evaluation.regression_metrics(i.guesses),
            "allocation": i.tight,
            "plan": plan,
            "portfolio": i.portfolio,
        }
    )


def _churn_scores(i: Inputs) -> DataFrame:
    return i.churn_model.predict(i.latest_features)


def _churn_eval(i: Inputs) -> DataFrame:
    m = i.churn_model
    test = stage(
        m.score(i.churn_rows.where(F.col("split") == "test")).select(
            "churn_label", "churn_probability"
        ),
        "test",
    )
    return evaluation.evaluate_binary(test, m.threshold)


def _bounds(i: Inputs) -> DataFrame:
    model = prediction.train_value(i.value_rows, bounds=True)
    return model.predict(i.latest_features, bounds=True)


def _k_search(i: Inputs) -> DataFrame:
    return i.segmentation.search


def _clusters(i: Inputs) -> DataFrame:
    assigned, _ = clustering.assign_segments(i.segmentation, i.features, i.latest_features)
    return assigned.select(*KEYS, "segment", "segment_name")


def _sample(i: Inputs) -> DataFrame:
    return segments.chart_sample(i.scores).select("customer_id", "rfm_recency_days")


RFM = ["rfm_recency_days", "rfm_frequency_count", "rfm_monetary_avg"]
# Centres in standardised units, for assignment without a trained model.
CENTRES = [(-0.7, 0.9, 0.1), (0.1, -0.2, -0.4), (1.3, -0.6, 0.2), (-0.4, -0.4, 1.1)]


def _holes(i: Inputs) -> DataFrame:
    """Scores with some average values missing."""
    hole = F.when(F.col("customer_id") % 7 != 0, F.col("rfm_monetary_avg"))
    return i.scores.select("customer_id", hole.alias("rfm_monetary_avg"))


def _scaled(i: Inputs) -> DataFrame:
    return clustering.standardised(i.scores.select("customer_id", "segment", *RFM), RFM)


def _log_trip(i: Inputs) -> DataFrame:
    y = prediction.to_log(F.col("actual") - 1000)
    return i.guesses.select(
        *KEYS, y.alias("log_target"), prediction.from_log(y).alias("back"), prediction.from_log(-y).alias("clipped")
    )


def _training(rows: DataFrame, targets: DataFrame, target: str) -> DataFrame:
    return tidy(prediction.training_rows(rows.select(*KEYS, *RFM), targets, target).select(*KEYS, target, *RFM, "split"))


def _product(i: Inputs) -> DataFrame:
    keys = KEYS
    returned = i.activity.select(*keys, "return_rate")
    return tidy(
        features.product_features(i.lines, i.calendar)
        .join(features.basket_features(i.lines, i.calendar), keys)
        .join(returned, keys)
    )


def _custom(i: Inputs) -> DataFrame:
    base = i.scores.select("customer_id", "rfm_recency_days")
    return tidy(features.with_custom_features(base, features.preference_features(i.lines)))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources and cleaning
    "raw_transactions": lambda i: tidy(i.raw),
    "clean_transactions": lambda i: tidy(i.plan.lines()),
    "cleaning_stats": lambda i: tidy(i.plan.statistics()),
    "price_p99_filter": _price_filter,
    "quantity_iqr_filter": _quantity_filter,
    "min_txn_filter": _min_txn,
    "high_return_customers": _return_shares,
    "date_parts": _date_parts,
    "transaction_type": _types,
    # quality
    "dq_schema_completeness": lambda i: tidy(quality.column_completeness(i.raw)),
    "dq_row_rules": lambda i: quality.row_counters(i.raw),
    "dq_duplicates": lambda i: quality.duplicate_counters(i.raw),
    "dq_customers": lambda i: quality.customer_counters(i.raw),
    "dq_report": _report,
    "quality_summary": _quality_summary,
    "dq_summary": lambda i: quality.validation_summary(quality.validation_report(i.raw)),
    # snapshots
    "snapshot_dates": lambda i: snapshots.snapshot_dates(i.lines),
    "snapshot_dates_weekly": lambda i: snapshots.snapshot_dates(i.lines, "week"),
    "latest_snapshot": lambda i: snapshots.at_latest_snapshot(i.activity).select(
        *KEYS, "rfm_frequency_count"
    ),
    "newest_snapshots": lambda i: snapshots.newest(i.snapshots, 6),
    "pit_window": _pit_window,
    "temporal_consistency": lambda i: snapshots.temporal_consistency(i.lines, i.activity),
    # features
    "features_rfm": lambda i: _pick(i.activity, *features.RFM),
    "features_windows": lambda i: _pick(i.activity, *features.window_columns()),
    "features_interpurchase": lambda i: _pick(i.activity, *features.GAPS),
    "features_product": _product,
    "features_engagement": lambda i: _pick(
        features.normalise_engagement(i.activity), *features.ENGAGEMENT
    ),
    "features_trend": lambda i: _pick(i.activity, *features.TREND),
    "features_all_snapshots": lambda i: tidy(
        features.customer_features(i.lines, i.snapshots)
    ),
    "features_custom": _custom,
    "feature_store_metadata": _metadata,
    "feature_description": _describe,
    "top_engagement": lambda i: tidy(features.top_engagement(i.scores)),
    # labels and targets
    "label_eligibility": lambda i: labels.eligibility(
        labels.customer_history(i.lines, i.snapshots)
    ),
    "churn_labels": lambda i: labels.churn_labels(i.lines, i.snapshots),
    "churn_label_stats": lambda i: tidy(labels.churn_label_stats(i.lines, i.snapshots)),
    "churn_label_validation": lambda i: tidy(labels.label_validation(i.lines, i.snapshots)),
    "churn_rate": lambda i: tidy(labels.churn_rate(i.labels)),
    "clv_targets": lambda i: tidy(labels.clv_targets(i.lines, i.snapshots), 2),
    "clv_target_stats": lambda i: tidy(labels.value_stats(i.targets, "clv_target"), 2),
    # evaluation
    "temporal_split": _split_rows,
    "split_class_distribution": _split,
    "class_weights": lambda i: tidy(evaluation.class_weights(i.labels)),
    "threshold_search": lambda i: tidy(_thresholds(i)),
    "best_threshold": lambda i: tidy(evaluation.best_threshold(_thresholds(i))),
    "key_thresholds": lambda i: tidy(evaluation.key_thresholds(_thresholds(i))),
    "binary_metrics": lambda i: tidy(evaluation.evaluate_binary(i.label_scores, 0.5)),
    "classification_report": lambda i: tidy(
        evaluation.classification_report(i.label_scores, 0.5)
    ),
    "roc_auc_rank": lambda i: tidy(evaluation.roc_auc(i.label_scores)),
    "risk_levels": lambda i: tidy(evaluation.risk_distribution(i.churn)),
    "regression_metrics": lambda i: tidy(evaluation.regression_metrics(i.guesses), 2),
    "decile_analysis": lambda i: tidy(
        evaluation.decile_analysis(i.guesses, key=("customer_id", "snapshot_date")), 2
    ),
    "risk_adjusted_clv": lambda i: tidy(
        evaluation.risk_adjusted(i.clv, i.churn.where(F.col("risk_level").isNotNull()))
    ),
    "risk_adjusted_stats": lambda i: tidy(
        evaluation.risk_adjusted_stats(evaluation.risk_adjusted(i.clv, i.churn))
    ),
    "clv_bands": lambda i: tidy(evaluation.value_band_distribution(i.clv)),
    "clv_prediction_stats": lambda i: tidy(labels.value_stats(i.clv, "clv_prediction")),
    "top_risk_adjusted": lambda i: tidy(
        evaluation.top_risk_adjusted(evaluation.risk_adjusted(i.clv, i.churn))
    ),
    # segments
    "segment_rule_names": lambda i: i.named.select("customer_id", "segment_name"),
    "segment_profiles": lambda i: tidy(i.profiles),
    "segment_strategies": _strategies,
    "segment_summary": lambda i: tidy(segments.segment_summary(i.profiles), 1),
    "segment_top3": lambda i: tidy(segments.top_segments(i.profiles), 2),
    "segment_sizes": lambda i: reports.count_by(i.named, "segment_name"),
    "segment_minmax": lambda i: tidy(
        segments.min_max_scaled(i.profiles, ["avg_recency", "avg_frequency", "avg_monetary"])
    ),
    "segment_comparison": lambda i: tidy(segments.comparison_metrics(i.profiles)),
    "revenue_share": lambda i: tidy(segments.revenue_share(i.profiles)),
    "chart_sample": _sample,
    # parts of the models that need no training
    "rfm_median_fill": lambda i: tidy(clustering.median_filled(_holes(i), ["rfm_monetary_avg"])),
    "rfm_standardised": lambda i: tidy(_scaled(i).drop("segment")),
    "nearest_centres": lambda i: _scaled(i).select(
        "customer_id", clustering.nearest_centre(RFM, CENTRES).alias("centre")
    ),
    "rule_davies_bouldin": lambda i: tidy(clustering.group_separation(_scaled(i), RFM, "segment")),
    "rule_centre_importance": lambda i: tidy(clustering.group_importance(_scaled(i), RFM, "segment")),
    "churn_training_rows": lambda i: _training(i.activity, i.labels, "churn_label"),
    "clv_training_rows": lambda i: _training(i.activity, i.targets, "clv_target"),
    "clv_log_round_trip": lambda i: tidy(_log_trip(i), 3),
    "clv_churn_adjusted": lambda i: tidy(prediction.churn_adjusted(i.clv, i.churn)),
    "snapshot_dates_to_the_end": lambda i: snapshots.snapshot_dates(i.lines, prediction_days=0),
    "snapshot_of_short_range": lambda i: snapshots.snapshot_dates(
        i.lines, observation_days=36500, short_range="latest"
    ),
    # campaigns
    "expected_value": lambda i: tidy(campaigns.expected_values(i.scores)),
    "campaign_options": lambda i: tidy(campaigns.campaign_options(i.scores)),
    "greedy_allocation_ample": _ample,
    "greedy_allocation_tight": lambda i: tidy(
        campaigns.allocate_budget(i.clv, i.churn, TIGHT_BUDGET)
    ),
    "allocation_by_tier": lambda i: tidy(campaigns.allocation_by_tier(i.tight)),
    "portfolio_metrics": lambda i: tidy(campaigns.portfolio_totals(i.tight)),
    "baseline_loss": lambda i: tidy(campaigns.baseline_loss(i.clv, i.churn)),
    "baseline_loss_by_risk": lambda i: tidy(campaigns.baseline_loss_by_risk(i.clv, i.churn)),
    "lift_vs_baseline": lambda i: tidy(campaigns.lift_vs_baseline(i.tight)),
    "budget_sensitivity": lambda i: tidy(
        campaigns.budget_sensitivity(i.clv, i.churn, TIGHT_BUDGET)
    ),
    "execution_plan": lambda i: tidy(
        campaigns.execution_plan(i.tight, i.named).select(
            "customer_id", "priority_rank", "campaign_tier", "expected_value", "segment_name"
        )
    ),
    "tier_summary": lambda i: tidy(campaigns.tier_summary(i.tight)),
    "tier_top5": _tier_top,
    "tiered_assignment": lambda i: _tiered(i, "expected_value"),
    "tiered_assignment_retention": lambda i: _tiered(i, "maximize_retention"),
    "tiered_stats": _stats,
    "campaign_distribution": lambda i: campaigns.campaign_distribution(
        campaigns.assign_campaigns(i.scores, TIER_BUDGET)
    ),
    "strategy_comparison": _compare,
    # reports and checks
    "customer_action_list": lambda i: reports.customer_action_list(i.tight, i.named),
    "top_customer_actions": lambda i: reports.customer_action_list(i.tight, i.named, top=100),
    "report_segment_profiles": lambda i: reports.segment_report(i.named, i.churn, i.clv),
    "impact_report": lambda i: reports.impact_report(i.churn, i.clv, i.portfolio),
    "financial_impact": lambda i: tidy(
        reports.financial_impact(i.churn, i.clv, i.portfolio), 2
    ),
    "business_summary": _summary,
    "campaign_breakdown": lambda i: reports.campaign_breakdown(i.tight),
    "tier_chart": lambda i: tidy(reports.tier_chart(i.tight)),
    "clv_histogram": lambda i: tidy(reports.value_histogram(i.clv)),
    "output_checks": _checks,
    # trained models: no fixed expected values
    "kmeans_segments": _clusters,
    "kmeans_k_search": _k_search,
    "davies_bouldin": lambda i: clustering.davies_bouldin(i.segmentation, i.latest_features),
    "segment_feature_importance": lambda i: clustering.segment_importance(
        i.segmentation, i.latest_features
    ),
    "churn_gbt_scores": _churn_scores,
    "churn_gbt_metrics": _churn_eval,
    "churn_importance": lambda i: prediction.feature_importance(i.churn_model.model, i.churn_rows),
    "clv_gbt_scores": lambda i: i.value_model.predict(i.latest_features),
    "clv_importance": lambda i: prediction.feature_importance(i.value_model.model, i.value_rows),
    "clv_quantile_bands": _bounds,
}
