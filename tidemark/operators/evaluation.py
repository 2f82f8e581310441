"""Splits, class weights, thresholds and metrics over scored rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import percent, ratio, right_closed_bands
from tidemark.functions.ordering import with_position, with_running_totals
from tidemark.functions.quantiles import kth_values
from tidemark.functions.staging import stage

# Decision thresholds .10, .15 ... .85, and upper edges of the bands.
THRESHOLDS = tuple(round(0.10 + 0.05 * i, 2) for i in range(16))
KEY_THRESHOLDS = (0.3, 0.5, 0.7)
RISK_LEVELS = [(0.3, "Low"), (0.5, "Medium"), (0.7, "High"), (1.0, "Very High")]
VALUE_BANDS = [(100.0, "Low"), (300.0, "Medium"), (500.0, "High"), (None, "Very High")]


# --- temporal split -----------------------------------------------------------------


def split_sizes(n: int, test_size: float = 0.2, val_size: float = 0.1) -> tuple[int, int]:
    """Rows in train, and in train + validation, of ``n`` rows in time order."""
    fit = int(n * (1 - test_size))
    return fit - int(fit * val_size), fit


def temporal_split(
    rows: DataFrame, test_size: float = 0.2, val_size: float = 0.1
) -> DataFrame:
    """Add ``split``: the oldest rows train, the newest test, no shuffling.

    Order is (snapshot_date, customer_id).  Only the two rows at the borders
    are looked for (counts per snapshot, then one exact rank inside it); the
    split itself is a comparison, so nothing is sorted or moved.
    """
    counts = (
        rows.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n")).orderBy("snapshot_date")
    ).select(F.unix_micros("snapshot_date").alias("us"), "n").collect()  # one row per snapshot
    total = sum(r["n"] for r in counts)
    at = F.unix_micros("snapshot_date")

    def first(size: int) -> Column:
        """Condition: among the first ``size`` rows."""
        if size <= 0:
            return F.lit(False)
        seen = 0
        for r in counts:
            if seen + r["n"] >= size:
                inside = rows.where(at == r["us"])
                rank = size - seen - 1
                last = kth_values(inside, F.col("customer_id"), [rank])[rank]
                return (at < r["us"]) | ((at == r["us"]) & (F.col("customer_id") <= last))
            seen += r["n"]
        return F.lit(True)

    train, fit = split_sizes(total, test_size, val_size)
    label = F.when(first(train), "train").when(first(fit), "val").otherwise("test")
    return rows.withColumn("split", label)


def class_distribution(rows: DataFrame, label: str = "churn_label") -> DataFrame:
    """Class sizes per split; ``extreme`` outside 10 to 40 percent churn."""
    rate = F.avg(label) * 100
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(F.col(label) == 1).alias("churned"),
        F.count_if(F.col(label) == 0).alias("active"),
        rate.alias("churn_rate_pct"),
        ((rate < 10) | (rate > 40)).alias("extreme"),
    )


def class_weights(rows: DataFrame, label: str = "churn_label", balance: bool = True) -> DataFrame:
    """Weight per class: negatives over positives for class 1, else 1."""
    counts = rows.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    positive = ratio(F.col("negatives"), F.col("positives"), 1.0) if balance else F.lit(1.0)
    return counts.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias(label), F.lit(1.0).alias("weight")),
                F.struct(F.lit(1).alias(label), positive.alias("weight")),
            )
        )
    )


# --- classification -------------------------------------------------------------------


def _confusion(hit: Column, positive: Column) -> list[Column]:
    return [
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
    ]


def _f_score(beta: float) -> Column:
    b2 = beta * beta
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return ratio(tp * (1 + b2), tp * (1 + b2) + fn * b2 + fp)


def threshold_scores(
    scored: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    label: str = "churn_label",
    score: str = "churn_probability",
    beta: float = 2.0,
) -> DataFrame:
    """Confusion counts and scores at every threshold.

    Rows are first counted per band between thresholds (one map-side pass, at
    most one row per band); the counts at a threshold are sums of bands, so
    the scored rows are never repeated.
    """
    marks = sorted(set(thresholds))
    band = sum([(F.col(score) >= t).cast("int") for t in marks], F.lit(0))
    bands = (
        scored.select(band.alias("band"), F.col(label).alias("y"))
        .groupBy("band")
        .agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n"))
    )
    ladder = scored.sparkSession.createDataFrame(
        [(float(t), i + 1) for i, t in enumerate(marks)], "threshold double, level int"
    )
    hit = F.col("band") >= F.col("level")
    levels = bands.withColumn(
        "level", F.explode(F.sequence(F.lit(1), F.lit(len(marks))))
    ).groupBy("level").agg(
        F.coalesce(F.sum(F.when(hit, F.col("p"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~hit, F.col("p"))), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(~hit, F.col("n"))), F.lit(0)).alias("tn"),
    )
    return (
        ladder.join(levels, "level")
        .select(
            "threshold",
            "tp",
            "fp",
            "fn",
            "tn",
            ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
            ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
            _f_score(1.0).alias("f1"),
            _f_score(beta).alias("f_beta"),
        )
    )


def best_threshold(scores: DataFrame, metric: str = "f_beta") -> DataFrame:
    """The threshold with the highest metric; the lowest one among equals."""
    if metric not in ("f1", "f_beta", "precision", "recall"):
        raise ValueError(f"unknown metric: {metric}")
    return scores.orderBy(F.desc(metric), "threshold").limit(1)


def key_thresholds(scores: DataFrame, metric: str = "f_beta") -> DataFrame:
    """Scores at .3, .5, .7 and at the best threshold."""
    best = best_threshold(scores, metric).select("threshold")
    return scores.where(F.col("threshold").isin(*KEY_THRESHOLDS)).unionByName(
        scores.join(F.broadcast(best), "threshold", "left_semi").where(
            ~F.col("threshold").isin(*KEY_THRESHOLDS)
        )
    )


def roc_auc(
    scored: DataFrame, label: str = "churn_label", score: str = "churn_probability"
) -> DataFrame:
    """Exact area under the ROC curve; ties count half.

    Rows are counted per distinct score first, then the negatives below each
    score come from a distributed running total.
    """
    per_score = scored.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
    )
    run = with_running_totals(per_score, [F.col(score)], {"n_upto": F.col("n")})
    below = F.col("n_upto") - F.col("n")
    return run.agg(
        F.sum("p").alias("positives"),
        F.sum("n").alias("negatives"),
        F.sum(F.col("p").cast("double") * (below + F.col("n") / 2)).alias("wins"),
    ).select(
        "positives",
        "negatives",
        auc_of_counts(F.col("wins"), F.col("positives"), F.col("negatives")).alias("roc_auc"),
    )


def auc_of_counts(wins: Column, positives: Column, negatives: Column) -> Column:
    """Share of won pairs; as doubles, since the number of pairs can exceed 64 bits."""
    return ratio(wins, positives.cast("double") * negatives.cast("double"), None)


def binary_metrics(
    scored: DataFrame,
    threshold: float = 0.5,
    label: str = "churn_label",
    score: str = "churn_probability",
) -> DataFrame:
    """Metrics at one threshold, without the AUC (see :func:`evaluate_binary`)."""
    hit, positive = F.col(score) >= threshold, F.col(label) == 1
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return scored.agg(*_confusion(hit, positive)).select(
        F.lit(float(threshold)).alias("threshold"),
        ratio(F.col("tp") + F.col("tn"), n).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f_score(1.0).alias("f1_score"),
        _f_score(2.0).alias("f2_score"),
        F.col("tn").alias("true_negatives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tp").alias("true_positives"),
        recall.alias("churn_capture_rate"),
        precision.alias("precision_at_threshold"),
        ratio(precision, (F.col("tp") + F.col("fn")) / n).alias("lift_at_top_k_pct"),
    )


def evaluate_binary(
    scored: DataFrame,
    threshold: float = 0.5,
    label: str = "churn_label",
    score: str = "churn_probability",
) -> DataFrame:
    """One row with all classification metrics and the AUC."""
    return binary_metrics(scored, threshold, label, score).withColumn(
        "roc_auc", roc_auc(scored, label, score).select("roc_auc").scalar()
    )


def classification_report(
    scored: DataFrame,
    threshold: float = 0.5,
    label: str = "churn_label",
    score: str = "churn_probability",
) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(name: str, hit: Column, false: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            ratio(hit, hit + false).alias("precision"),
            ratio(hit, hit + miss).alias("recall"),
            ratio(hit * 2, hit * 2 + false + miss).alias("f1_score"),
            (hit + miss).alias("support"),
        )

    return scored.agg(
        *_confusion(F.col(score) >= threshold, F.col(label) == 1)
    ).select(F.inline(F.array(row("Active", tn, fn, fp), row("Churned", tp, fp, fn))))


def risk_level(probability: Column) -> Column:
    """Low, Medium, High or Very High; a probability of exactly 0 has none."""
    return F.when(probability <= 1, right_closed_bands(probability, RISK_LEVELS, 0.0))


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Customers and share per risk level."""
    total = scored.agg(F.count(F.lit(1)).alias("t"))
    return (
        scored.groupBy("risk_level")
        .agg(F.count(F.lit(1)).alias("customers"))
        .where(F.col("risk_level").isNotNull())
        .withColumn("pct", percent(F.col("customers"), total.scalar()))
    )


# --- regression -----------------------------------------------------------------------


def regression_metrics(
    scored: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """RMSE, MAE, R2, MAPE over positive actuals, and the portfolio error."""
    y = F.col("y")
    p = F.col("p")
    rows = scored.select(
        F.nanvl(F.col(actual).cast("double"), F.lit(None)).alias("y"),
        F.nanvl(F.col(predicted).cast("double"), F.lit(None)).alias("q"),
    ).where(F.col("y").isNotNull() & F.col("q").isNotNull())
    rows = rows.select("y", F.greatest("q", F.lit(0.0)).alias("p"))
    err = y - p
    sums = rows.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("sse"),
        (F.var_pop(y) * F.count(y)).alias("sst"),
        (F.avg(F.when(y > 0, F.abs(err) / y)) * 100).alias("mape"),
        F.sum(y).alias("total_actual_clv"),
        F.sum(p).alias("total_predicted_clv"),
    )
    return sums.select(
        "rmse",
        "mae",
        (1 - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2_score"),
        "mape",
        (
            F.try_divide(
                F.abs(F.col("total_actual_clv") - F.col("total_predicted_clv")),
                F.col("total_actual_clv"),
            )
            * 100
        ).alias("portfolio_error_pct"),
        "total_actual_clv",
        "total_predicted_clv",
    )


def _after_cuts(rows: DataFrame, shares: Sequence[float], key: Sequence[str]) -> list[Column]:
    """For each share of the row index, whether a row comes after it in the order of ``v`` and ``key``.

    The cuts are exact order statistics, found by counting; only rows that tie with a cut
    that splits them are put in order by their keys.
    """
    n = rows.count()
    ranks = [math.floor(round(p * (n - 1), 6)) for p in shares]
    values = kth_values(rows, F.col("v"), ranks) if n else {}
    counts = [
        f
        for i, r in enumerate(ranks if n else [])
        for f in (F.count_if(F.col("v") < values[r]).alias(f"below{i}"), F.count_if(F.col("v") == values[r]).alias(f"same{i}"))
    ]
    seen = rows.agg(F.lit(0).alias("zero"), *counts).first()
    out = []
    for i, r in enumerate(ranks):
        if not n:
            out.append(F.lit(False))
            continue
        after = F.col("v") > values[r]
        if r + 1 < seen[f"below{i}"] + seen[f"same{i}"]:
            ties = rows.where(F.col("v") == values[r]).select(*key)
            ties = with_position(ties, [F.col(k) for k in key])
            last = ties.where(F.col("position") == r + 1 - seen[f"below{i}"]).first()
            cut = F.struct(*[F.lit(last[k]).cast(rows.schema[k].dataType).alias(k) for k in key])
            after = after | ((F.col("v") == values[r]) & (F.struct(*key) > cut))
        out.append(after)
    return out


def decile_analysis(
    scored: DataFrame,
    actual: str = "actual",
    predicted: str = "predicted",
    key: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """Actual and predicted value by decile of the prediction, best first.

    Deciles are quantile bins of the row index (not equal counts), so the row
    at index i of n falls in ceil(10 i / (n - 1)).
    """
    # Best first; a null prediction comes last.  Not the negative: a zero of minus sign in the written
    # rows is not found by a filter for zero.
    place = F.coalesce(F.lit(0.0) - F.col(predicted).cast("double"), F.lit(float("inf")))
    rows = scored.select(
        *key, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"), place.alias("v")
    )
    rows = stage(rows, "deciles")  # the cuts are found in several cheap scans
    decile = F.lit(1)
    for after in _after_cuts(rows, [d / 10 for d in range(1, 10)], key):
        decile = decile + after.cast("int")
    stats = rows.groupBy(decile.alias("decile")).agg(
        F.sum("actual").alias("actual_sum"),
        F.avg("actual").alias("actual_mean"),
        F.count(F.lit(1)).alias("count"),
        F.sum("predicted").alias("predicted_sum"),
        F.avg("predicted").alias("predicted_mean"),
    )
    ten = W.partitionBy(F.lit(0))  # ten rows
    share = percent(F.col("actual_sum"), F.sum("actual_sum").over(ten))
    return stats.withColumn("actual_pct", share).withColumn(
        "cumulative_pct",
        F.sum("actual_pct").over(ten.orderBy("decile").rowsBetween(W.unboundedPreceding, 0)),
    )


def risk_adjusted(
    clv: DataFrame, churn: DataFrame, default_probability: float = 0.2
) -> DataFrame:
    """CLV with the churn probability (default where unknown) and both products."""
    joined = clv.join(churn.select("customer_id", "churn_probability"), "customer_id", "left")
    p = F.coalesce(F.col("churn_probability"), F.lit(default_probability))
    return joined.withColumn("churn_probability", p).withColumns(
        {
            "clv_risk_adjusted": F.col("clv_prediction") * (1 - F.col("churn_probability")),
            "expected_churn_loss": F.col("clv_prediction") * F.col("churn_probability"),
        }
    )


def risk_adjusted_stats(adjusted: DataFrame) -> DataFrame:
    return adjusted.agg(
        F.avg("clv_prediction").alias("mean_base_clv"),
        F.avg("clv_risk_adjusted").alias("mean_risk_adjusted_clv"),
        F.avg("expected_churn_loss").alias("mean_expected_loss"),
        F.sum("expected_churn_loss").alias("total_expected_loss"),
    )


def value_band(value: Column) -> Column:
    """Low to Very High by predicted value; exactly 0 has no band."""
    return right_closed_bands(value, VALUE_BANDS, 0.0)


def value_band_distribution(clv: DataFrame) -> DataFrame:
    total = clv.agg(F.count(F.lit(1)).alias("t"))
    return (
        clv.groupBy(value_band(F.col("clv_prediction")).alias("clv_band"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .where(F.col("clv_band").isNotNull())
        .withColumn("pct", percent(F.col("customers"), total.scalar()))
    )


def top_risk_adjusted(adjusted: DataFrame, n: int = 10) -> DataFrame:
    return (
        adjusted.select("customer_id", "clv_prediction", "churn_probability", "clv_risk_adjusted")
        .orderBy(F.desc("clv_risk_adjusted"), "customer_id")
        .limit(n)
    )
