import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation
from tidemark.operators.clustering import choose_k


def _scored(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice([0.05, 0.1, 0.3, 0.45, 0.5, 0.62, 0.7, 1.0]), rng.randrange(2)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "customer_id long, churn_probability double, churn_label int")


def test_threshold_ladder(spark):
    rows, df = _scored(spark)
    got = {r["threshold"]: r for r in evaluation.threshold_scores(df).collect()}
    assert len(got) == 16
    for t, r in got.items():
        tp = sum(p >= t and y == 1 for _, p, y in rows)
        fp = sum(p >= t and y == 0 for _, p, y in rows)
        fn = sum(p < t and y == 1 for _, p, y in rows)
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert r["f_beta"] == pytest.approx(5 * tp / (5 * tp + 4 * fn + fp))
    best = evaluation.best_threshold(evaluation.threshold_scores(df)).first()
    top = max(r["f_beta"] for r in got.values())
    assert best["threshold"] == min(t for t, r in got.items() if r["f_beta"] == top)


def test_auc_counts_ties_half(spark):
    rows, df = _scored(spark)
    pos = [p for _, p, y in rows if y == 1]
    neg = [p for _, p, y in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert evaluation.roc_auc(df).first()["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))


def test_binary_metrics_without_any_hit(spark):
    _, df = _scored(spark)
    m = evaluation.binary_metrics(df.withColumn("churn_probability", F.lit(0.0)), 0.5).first()
    assert (m["precision"], m["recall"], m["lift_at_top_k_pct"]) == (0.0, 0.0, 0.0)


def test_split_is_by_time_and_exact(spark):
    rng = random.Random(5)
    # One snapshot holds most rows, ids are not in order.
    rows = [(rng.randrange(10**9), 3 if rng.random() < 0.7 else rng.randrange(6)) for _ in range(203)]
    df = spark.createDataFrame(rows, "customer_id long, k int").select(
        "customer_id",
        (F.to_timestamp(F.lit("2020-01-31 05:00:00")) + F.make_dt_interval(F.col("k") * 30)).alias("snapshot_date"),
    )
    got = evaluation.temporal_split(df).collect()
    got.sort(key=lambda r: (r["snapshot_date"], r["customer_id"]))
    train, fit = evaluation.split_sizes(203)
    assert (train, fit) == (146, 162)
    assert [r["split"] for r in got] == ["train"] * 146 + ["val"] * 16 + ["test"] * 41


@pytest.mark.parametrize("n", [10, 12, 18])
def test_deciles_are_quantile_bins_of_the_index(spark, n):
    df = spark.createDataFrame(
        [(i, float(i), float(n - i)) for i in range(n)], "customer_id long, actual double, predicted double"
    )
    got = {r["decile"]: r for r in evaluation.decile_analysis(df).collect()}
    want = {}
    for i in range(n):
        d = max(1, math.ceil(10 * i / (n - 1)))
        want.setdefault(d, []).append(float(i))
    assert {d: r["count"] for d, r in got.items()} == {d: len(v) for d, v in want.items()}
    assert got[10]["cumulative_pct"] == pytest.approx(100.0)
    assert got[1]["actual_sum"] == sum(want[1])


def test_deciles_split_ties_by_all_keys(spark):
    """A third of the rows have one prediction, some rows none, and keys repeat in the first column."""
    rows = [(i // 2, i % 2, float(i), None if i % 17 == 0 else 5.0 if i % 3 == 0 else float(i % 7)) for i in range(211)]
    df = spark.createDataFrame(rows, "a long, b int, actual double, predicted double")
    got = {r["decile"]: (r["count"], r["actual_sum"]) for r in evaluation.decile_analysis(df, key=("a", "b")).collect()}
    order = sorted(rows, key=lambda r: (float("inf") if r[3] is None else -r[3], r[0], r[1]))
    want = {}
    for i, r in enumerate(order):
        d = max(1, math.ceil(10 * i / 210))
        n, total = want.get(d, (0, 0.0))
        want[d] = (n + 1, total + r[2])
    assert got == want
    assert evaluation.decile_analysis(df.where("false"), key=("a", "b")).collect() == []


def test_risk_levels_and_value_bands(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (0.3, 100.0), (0.5, 300.0), (0.7, 500.0), (1.0, 500.01)], "p double, v double"
    )
    got = df.select(evaluation.risk_level(F.col("p")), evaluation.value_band(F.col("v"))).collect()
    names = [None, "Low", "Medium", "High", "Very High"]
    assert [tuple(r) for r in got] == list(zip(names, names))


def test_regression_metrics(spark):
    df = spark.createDataFrame(
        [(10.0, 8.0), (0.0, 1.0), (-5.0, -3.0), (float("nan"), 4.0), (20.0, 25.0)],
        "actual double, predicted double",
    )
    m = evaluation.regression_metrics(df).first()
    y, p = [10.0, 0.0, -5.0, 20.0], [8.0, 1.0, 0.0, 25.0]
    assert m["rmse"] == pytest.approx(math.sqrt(sum((a - b) ** 2 for a, b in zip(y, p)) / 4))
    assert m["mape"] == pytest.approx((0.2 + 0.25) / 2 * 100)
    assert m["portfolio_error_pct"] == pytest.approx(abs(25 - 34) / 25 * 100)
    mean = sum(y) / 4
    assert m["r2_score"] == pytest.approx(
        1 - sum((a - b) ** 2 for a, b in zip(y, p)) / sum((a - mean) ** 2 for a in y)
    )


def test_unknown_churn_probability_gets_the_default(spark):
    clv = spark.createDataFrame([(1, 100.0), (2, 50.0)], "customer_id long, clv_prediction double")
    churn = spark.createDataFrame([(1, 0.5)], "customer_id long, churn_probability double")
    got = {r["customer_id"]: r for r in evaluation.risk_adjusted(clv, churn).collect()}
    assert got[1]["clv_risk_adjusted"] == 50.0
    assert got[2]["expected_churn_loss"] == pytest.approx(10.0)


def test_class_weights(spark):
    _, df = _scored(spark)
    rows = {r["churn_label"]: r["weight"] for r in evaluation.class_weights(df).collect()}
    pos = df.where("churn_label = 1").count()
    assert rows == {0: 1.0, 1: pytest.approx((300 - pos) / pos)}
    flat = {r["weight"] for r in evaluation.class_weights(df, balance=False).collect()}
    assert flat == {1.0}


def test_choice_of_k():
    assert choose_k({3: 9, 4: 5, 5: 4}, {3: 0.2, 4: 0.6, 5: 0.6}) == 4
    # Seven clusters are too many: the elbow of the inertia curve instead.
    inertia = {3: 100.0, 4: 60.0, 5: 50.0, 6: 45.0, 7: 42.0, 8: 40.0}
    assert choose_k(inertia, {3: 0.1, 4: 0.2, 5: 0.2, 6: 0.2, 7: 0.9, 8: 0.3}) == 4


def test_auc_of_billions_of_rows(spark):
    from tidemark.operators.evaluation import auc_of_counts

    n = 4_000_000_000
    df = spark.sql(f"select {n}L p, {n}L n, {float(n) * n * 0.75}D w")
    got = df.select(auc_of_counts(F.col("w"), F.col("p"), F.col("n"))).first()[0]
    assert got == pytest.approx(0.75)
