"""The five stages end to end, each writing its tables under one folder.

A stage reads what earlier stages wrote, so any of them can be re-run alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.operators import (
    campaigns,
    cleaning,
    clustering,
    evaluation,
    features,
    labels,
    prediction,
    quality,
    segments,
    snapshots,
)
from tidemark.plans import checks, reports
from tidemark.settings import Settings
from tidemark.sources import tables


@dataclass(frozen=True)
class Workspace:
    """Where the tables of a run live."""

    spark: SparkSession
    folder: str

    def at(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def read(self, name: str, kind: str = "parquet") -> DataFrame:
        return tables.load_table(self.spark, self.at(name), kind)

    def write(self, df: DataFrame, name: str, kind: str = "parquet") -> DataFrame:
        tables.save_table(df, self.at(name), kind)
        return df if kind != "parquet" else self.read(name)

    def features(self) -> DataFrame:
        return tables.load_features(self.spark, self.at("features"))


def build_features(
    ws: Workspace,
    raw: DataFrame,
    settings: Settings = Settings(),
    frequency: str = "month_end",
    single_snapshot: bool = False,
    strict: bool = False,
) -> None:
    """Stage 0: validate, clean, snapshot, describe customers."""
    report = ws.write(
        quality.validation_report(raw, settings.quality, settings.cleaning), "validation_report"
    )
    if strict and not quality.validation_summary(report).first()["ok"]:
        raise ValueError("raw data failed validation")
    plan = cleaning.plan_cleaning(raw, settings.cleaning)
    ws.write(plan.statistics(), "cleaning_stats", "json")
    lines = ws.write(plan.lines(), "clean_transactions")
    churn = settings.churn
    when = snapshots.snapshot_dates(
        lines, frequency, churn.observation_days, churn.prediction_days, short_range="latest"
    )
    if single_snapshot:
        when = snapshots.newest(when)
    built = features.customer_features(lines, when, settings.features)
    tables.save_features(built, ws.at("features"))
    store = ws.features()
    ws.write(tables.feature_metadata(store), "feature_metadata", "json")
    ws.write(
        snapshots.temporal_consistency(lines, store, settings.features.observation_days),
        "temporal_consistency",
    )


def segment_customers(
    ws: Workspace,
    k: int | None = None,
    rules: clustering.ClusterRules = clustering.ClusterRules(),
) -> None:
    """Stage 1: cluster the latest snapshot, name and describe the segments."""
    store = ws.features()
    latest = snapshots.at_latest_snapshot(store)
    seg = clustering.fit_segments(latest, k, rules)
    assigned, profiles = clustering.assign_segments(seg, store, latest)
    profiles = ws.write(profiles, "segment_profiles")
    ws.write(assigned, "segment_assignments")
    ws.write(clustering.davies_bouldin(seg, latest), "cluster_metrics", "json")
    ws.write(clustering.segment_importance(seg, latest), "segment_importance", "csv")
    ws.write(segments.strategy_report(profiles), "segment_strategies", "json")
    ws.write(segments.segment_summary(profiles), "segment_summary", "csv")
    seg.save(ws.spark, ws.at("models/segments"))


def predict_churn(
    ws: Workspace,
    settings: Settings = Settings(),
    rules: prediction.TreeRules = prediction.TreeRules(),
    newest: int = 6,
) -> None:
    """Stage 2: label the newest snapshots, train, evaluate, score the latest."""
    lines, store = ws.read("clean_transactions"), ws.features()
    when = store.select("snapshot_date").distinct()
    when = snapshots.newest(when, newest)
    made = ws.write(labels.churn_labels(lines, when, settings.churn), "churn_labels")
    ws.write(labels.churn_label_stats(lines, when, settings.churn), "churn_label_statistics", "csv")
    rows = prediction.training_rows(store, made, "churn_label")
    model = prediction.train_churn(rows, rules)
    test = stage(
        model.score(rows.where(F.col("split") == "test")).select(
            "churn_label", "churn_probability"
        ),
        "churn-test",
    )
    ws.write(evaluation.evaluate_binary(test, model.threshold), "churn_metrics", "json")
    ws.write(model.predict(snapshots.at_latest_snapshot(store)), "churn_predictions")
    ws.write(prediction.feature_importance(model.model, rows), "churn_importance", "csv")
    model.save(ws.at("models/churn"))


def predict_value(
    ws: Workspace,
    settings: Settings = Settings(),
    rules: prediction.TreeRules = prediction.TreeRules(),
) -> None:
    """Stage 3: future revenue targets, point model, band, risk adjustment."""
    lines, store = ws.read("clean_transactions"), ws.features()
    when = store.select("snapshot_date").distinct()
    made = ws.write(
        labels.clv_targets(lines, when, settings.value, settings.features.observation_days),
        "clv_targets",
    )
    rows = prediction.training_rows(store, made, "clv_target")
    model = prediction.train_value(rows, rules, settings.value.log_transform, bounds=True)
    test = stage(
        model.predict(
            rows.where(F.col("split") == "test"), keep=("snapshot_date", "clv_target")
        ),
        "value-test",
    )
    ws.write(
        evaluation.regression_metrics(test, "clv_target", "clv_prediction"), "clv_metrics", "json"
    )
    ws.write(
        evaluation.decile_analysis(
            test, "clv_target", "clv_prediction", ("customer_id", "snapshot_date")
        ),
        "clv_decile_analysis",
        "csv",
    )
    clv = ws.write(
        model.predict(snapshots.at_latest_snapshot(store), bounds=True), "clv_predictions"
    )
    ws.write(
        evaluation.risk_adjusted(
            clv, ws.read("churn_predictions"), settings.value.default_churn_probability
        ),
        "clv_risk_adjusted",
    )
    ws.write(prediction.feature_importance(model.model, rows), "clv_importance", "csv")
    model.save(ws.at("models/clv"))


def allocate(ws: Workspace, budget: float, min_roi: float = 0.0) -> None:
    """Stage 4: spend the budget, compare budgets, plan the campaigns."""
    clv, churn = ws.read("clv_predictions"), ws.read("churn_predictions")
    seg = snapshots.at_latest_snapshot(ws.read("segment_assignments"))
    ws.write(campaigns.baseline_loss_by_risk(clv, churn), "baseline_loss", "csv")
    chosen = ws.write(campaigns.allocate_budget(clv, churn, budget, min_roi), "allocation")
    ws.write(campaigns.portfolio_metrics(chosen), "portfolio_metrics")
    ws.write(campaigns.lift_vs_baseline(chosen), "lift", "json")
    ws.write(campaigns.budget_sensitivity(clv, churn, budget), "budget_sensitivity", "csv")
    # Files in order of priority, as ranges.
    ws.write(campaigns.execution_plan(chosen, seg).orderBy("priority_rank"), "execution_plan")


def report(ws: Workspace) -> None:
    """All business reports."""
    chosen, portfolio = ws.read("allocation"), ws.read("portfolio_metrics")
    clv, churn = ws.read("clv_predictions"), ws.read("churn_predictions")
    seg = snapshots.at_latest_snapshot(ws.read("segment_assignments"))
    actions = reports.customer_action_list(chosen, seg).orderBy("priority_rank")
    ws.write(actions, "reports/customer_actions", "csv")
    ws.write(
        reports.customer_action_list(chosen, seg, top=100).orderBy("priority_rank").coalesce(1),
        "reports/top_100_customer_actions",
        "csv",
    )
    ws.write(reports.segment_report(seg, churn, clv), "reports/segment_profiles", "csv")
    ws.write(reports.impact_report(churn, clv, portfolio), "reports/impact_analysis", "csv")
    ws.write(
        reports.business_summary(
            ws.read("clean_transactions"), seg, churn, clv, chosen, portfolio,
            ws.read("churn_metrics", "json"), ws.read("clv_metrics", "json"),
        ),
        "reports/business_summary",
        "json",
    )
    ws.write(reports.count_by(seg, "segment_name"), "reports/chart_segments", "csv")
    ws.write(reports.count_by(churn, "risk_level"), "reports/chart_risk", "csv")
    ws.write(reports.value_histogram(clv), "reports/chart_value", "csv")
    ws.write(reports.tier_chart(chosen), "reports/chart_tiers", "csv")
    ws.write(reports.financial_impact(churn, clv, portfolio), "reports/chart_impact", "csv")


def check(ws: Workspace) -> DataFrame:
    """Checks over everything a full run wrote."""
    return checks.output_checks(
        {
            "lines": ws.read("clean_transactions"),
            "features": ws.features(),
            "segments": ws.read("segment_assignments"),
            "strategies": ws.read("segment_strategies", "json"),
            "labels": ws.read("churn_labels"),
            "churn": ws.read("churn_predictions"),
            "churn_metrics": ws.read("churn_metrics", "json"),
            "clv": ws.read("clv_predictions"),
            "clv_metrics": ws.read("clv_metrics", "json"),
            "allocation": ws.read("allocation"),
            "plan": ws.read("execution_plan"),
            "portfolio": ws.read("portfolio_metrics"),
        }
    )
