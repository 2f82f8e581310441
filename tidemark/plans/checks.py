"""Checks of finished output tables: (check, status, message) rows.

Fixed values: the names of the checks and the wording of their messages.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_text, ratio
from tidemark.operators.features import METADATA

CLEAN_COLUMNS = ("CustomerID", "InvoiceDate", "Revenue")


def _row(check: str, ok: Column, message: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.when(F.coalesce(ok, F.lit(False)), F.lit("PASS")).otherwise(F.lit("FAIL")).alias(
            "status"
        ),
        message.alias("message"),
    )


def _found(n: Column, what: str) -> Column:
    return F.concat(F.lit("Found "), count_text(n), F.lit(f" {what}"))


def _fraction(a: Column, b: Column, what: str) -> Column:
    return F.concat(a.cast("string"), F.lit("/"), b.cast("string"), F.lit(f" {what}"))


def _has(df: DataFrame, *columns: str) -> Column:
    return F.lit(all(c in df.columns for c in columns))


def check_clean(lines: DataFrame) -> DataFrame:
    rows, nulls = F.col("rows"), F.col("nulls")
    return lines.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("CustomerID").isNull()).alias("nulls")
    ).select(
        F.inline(
            F.array(
                _row("Cleaned data has rows", rows > 0, _found(rows, "rows")),
                _row(
                    "Required columns present",
                    _has(lines, *CLEAN_COLUMNS),
                    F.lit("Has: " + ", ".join(CLEAN_COLUMNS)),
                ),
                _row(
                    "No null CustomerIDs",
                    nulls == 0,
                    F.concat(F.lit("Nulls: "), nulls.cast("string")),
                ),
            )
        )
    )


def check_features(features: DataFrame) -> DataFrame:
    rows = F.col("rows")
    n = len([c for c in features.columns if c not in ("customer_id", *METADATA)])
    return features.agg(F.count(F.lit(1)).alias("rows")).select(
        F.inline(
            F.array(
                _row("Features have customers", rows > 0, _found(rows, "feature rows")),
                _row("Has ~33 features", F.lit(25 <= n <= 40), F.lit(f"Found {n} features")),
            )
        )
    )


def check_segments(segments: DataFrame, strategies: DataFrame) -> DataFrame:
    rows, names = F.col("rows"), F.col("names")
    plans = strategies.agg(F.count(F.lit(1)).alias("s"))
    per_name = segments.groupBy("segment_name").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_name.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("segment_name").alias("names"))
        .withColumn("plans", plans.scalar())
        .select(
            F.inline(
                F.array(
                    _row(
                        "Customers are segmented", rows > 0,
                        F.concat(F.lit("Segmented "), count_text(rows), F.lit(" customers")),
                    ),
                    _row(
                        "Has 5-10 segments", names.between(5, 10), _found(names, "segments")
                    ),
                    _row(
                        "Segment strategies exist",
                        F.col("plans") > 0,
                        _found(F.col("plans"), "strategies"),
                    ),
                )
            )
        )
    )


def check_labels(labels: DataFrame) -> DataFrame:
    rate = F.col("rate")
    return labels.agg(F.avg("churn_label").alias("rate")).select(
        F.inline(
            F.array(
                _row(
                    "Has churn_label column",
                    _has(labels, "churn_label"),
                    F.lit("churn_label column present"),
                ),
                _row(
                    "Churn rate is reasonable",
                    rate.between(0.05, 0.95),
                    F.concat(F.lit("Churn rate: "), F.format_number(rate * 100, 1), F.lit("%")),
                ),
            )
        )
    )


def check_churn(churn: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    rows, valid = F.col("rows"), F.col("valid")
    out = churn.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("churn_probability").between(0, 1)).alias("valid"),
    ).select(
        F.inline(
            F.array(
                _row(
                    "Has churn probabilities",
                    _has(churn, "churn_probability"),
                    F.lit("churn_probability column present"),
                ),
                _row("Probabilities in [0, 1]", valid == rows, _fraction(valid, rows, "valid")),
            )
        )
    )
    if metrics is None:
        return out
    auc = F.col("roc_auc")
    return out.unionByName(
        metrics.select(
            F.inline(
                F.array(
                    _row(
                        "ROC AUC > 0.5",
                        auc > 0.5,
                        F.concat(F.lit("ROC AUC: "), F.format_string("%.4f", auc)),
                    )
                )
            )
        )
    )


def check_value(clv: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    rows, good = F.col("rows"), F.col("good")
    out = clv.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("clv_prediction") >= 0).alias("good"),
    ).select(
        F.inline(
            F.array(
                _row(
                    "Has clv_prediction column",
                    _has(clv, "clv_prediction"),
                    F.lit("clv_prediction column present"),
                ),
                _row(
                    "CLV predictions non-negative",
                    good == rows,
                    _fraction(good, rows, "predictions >= 0"),
                ),
            )
        )
    )
    if metrics is None:
        return out
    r2 = F.col("r2_score")
    return out.unionByName(
        metrics.select(
            F.inline(
                F.array(
                    _row(
                        "R² score reasonable",
                        r2.between(-1, 1),
                        F.concat(F.lit("R²: "), F.format_string("%.4f", r2)),
                    )
                )
            )
        )
    )


def check_allocation(allocation: DataFrame, plan: DataFrame, portfolio: DataFrame) -> DataFrame:
    rows, planned, roi = F.col("rows"), F.col("planned"), F.col("roi")
    return (
        allocation.agg(F.count(F.lit(1)).alias("rows"))
        .withColumns(
            {
                "planned": plan.agg(F.count(F.lit(1)).alias("n")).scalar(),
                "roi": portfolio.select("portfolio_roi_pct").scalar(),
            }
        )
        .select(
            F.inline(
                F.array(
                    _row(
                        "Customers allocated to campaigns",
                        rows > 0,
                        F.concat(F.lit("Allocated "), count_text(rows), F.lit(" customers")),
                    ),
                    _row(
                        "Has campaign_tier column",
                        _has(allocation, "campaign_tier"),
                        F.lit("campaign_tier column present"),
                    ),
                    _row(
                        "Execution plan covers allocation",
                        planned == rows,
                        _fraction(planned, rows, "planned"),
                    ),
                    _row(
                        "Portfolio ROI calculated",
                        roi.isNotNull(),
                        F.concat(F.lit("ROI: "), F.format_string("%.1f", roi), F.lit("%")),
                    ),
                )
            )
        )
    )


def check_overlap(segments: DataFrame, churn: DataFrame, clv: DataFrame) -> DataFrame:
    """Customers known to all three tables over customers known to any.

    One tagged union and one aggregation by customer give both counts.
    """
    tagged = None
    for bit, df in ((1, segments), (2, churn), (4, clv)):
        part = df.select("customer_id", F.lit(bit).alias("bit"))
        tagged = part if tagged is None else tagged.unionByName(part)
    seen = tagged.groupBy("customer_id").agg(F.bit_or("bit").alias("bits"))
    common, total = F.col("common"), F.col("total")
    return seen.agg(
        F.count_if(F.col("bits") == 7).alias("common"), F.count(F.lit(1)).alias("total")
    ).select(
        F.inline(
            F.array(
                _row(
                    "Customer IDs align",
                    ratio(common, total) > 0.5,
                    _fraction(common, total, "customers in all datasets"),
                )
            )
        )
    )


def output_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All checks for the tables present; a table that is absent fails its check."""
    spark = next(iter(tables.values())).sparkSession
    needs = {
        "clean": (check_clean, ["lines"]),
        "features": (check_features, ["features"]),
        "segments": (check_segments, ["segments", "strategies"]),
        "labels": (check_labels, ["labels"]),
        "churn": (check_churn, ["churn"]),
        "value": (check_value, ["clv"]),
        "allocation": (check_allocation, ["allocation", "plan", "portfolio"]),
        "overlap": (check_overlap, ["segments", "churn", "clv"]),
    }
    optional = {"churn": "churn_metrics", "value": "clv_metrics"}
    out = None
    for name, (check, inputs) in needs.items():
        absent = [i for i in inputs if i not in tables]
        if absent:
            part = spark.range(1).select(
                F.inline(
                    F.array(
                        _row(f"{name} tables exist", F.lit(False), F.lit(f"Missing: {absent}"))
                    )
                )
            )
        else:
            args = [tables[i] for i in inputs]
            if name in optional:
                args.append(tables.get(optional[name]))
            part = check(*args)
        out = part if out is None else out.unionByName(part)
    return out
