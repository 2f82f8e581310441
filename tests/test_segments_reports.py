import pytest
from pyspark.sql import functions as F

from tidemark.operators import segments
from tidemark.plans import checks, reports


def test_every_name(spark):
    cases = [
        (10, 11, 101, "Champions"),
        (29, 9, 81, "Loyal Customers"),
        (61, 6, 61, "At Risk"),
        (91, 4, 10, "Hibernating"),
        (29, 2, 500, "New Customers"),
        (44, 3, 1, "Promising"),
        (59, 2, 1, "Need Attention"),
        (60, 2, 1, "Lost/Churned"),
        (30, 10, 100, "Loyal Customers"),
    ]
    df = spark.createDataFrame(cases, "r int, f int, m int, want string")
    got = df.withColumn("got", segments.segment_name(F.col("r"), F.col("f"), F.col("m"))).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


@pytest.fixture(scope="module")
def profiles(spark):
    rows = [(i, i % 2, 10 * (i % 2) + 5, 4, 20.0 + i, 80.0 + i, 3.0, 50, 0.5, 10.0) for i in range(6)]
    df = spark.createDataFrame(
        rows,
        "customer_id long, segment int, rfm_recency_days int, rfm_frequency_count long, "
        "rfm_monetary_avg double, rfm_monetary_total double, engagement_score double, "
        "days_since_first_purchase int, churn_probability double, clv_prediction double",
    )
    return segments.segment_profiles(df)


def test_profiles(profiles):
    rows = {r["segment"]: r for r in profiles.collect()}
    assert rows[0]["size"] == 3 and rows[0]["size_pct"] == 50.0
    assert rows[1]["avg_recency"] == 15.0 and rows[1]["avg_churn_risk"] == 0.5
    assert rows[0]["total_revenue"] == 80 + 82 + 84
    assert {r["segment_name"] for r in rows.values()} == {"Promising"}
    report = segments.strategy_report(profiles).collect()
    assert len(report) == 2 and len(report[0]["actions"]) == 4
    assert len(segments.STRATEGIES) == 8


def test_scaling_of_equal_values_is_missing(profiles):
    rows = {r["segment"]: r for r in segments.min_max_scaled(profiles, ["avg_recency", "avg_frequency"]).collect()}
    assert (rows[0]["avg_recency"], rows[1]["avg_recency"]) == (0.0, 1.0)
    assert rows[0]["avg_frequency"] is None
    with pytest.raises(ValueError):
        segments.comparison_metrics(profiles.select("segment", "avg_recency", "avg_monetary"))


def test_chart_sample_is_repeatable(spark):
    df = spark.range(100).withColumnRenamed("id", "customer_id")
    a = [r[0] for r in segments.chart_sample(df, 10).collect()]
    b = [r[0] for r in segments.chart_sample(df.repartition(7), 10).collect()]
    assert a == b and len(set(a)) == 10


@pytest.fixture(scope="module")
def tables(spark):
    allocation = spark.createDataFrame(
        [
            (1, "premium", "Premium Retention", 50.0, 0.9, 400.0, 216.0, 166.0, 3.32, 0.6),
            (2, "light", "Light Touch", 10.0, 0.5, 200.0, 20.0, 10.0, 1.0, 0.2),
        ],
        "customer_id long, campaign_tier string, campaign_name string, campaign_cost double, "
        "churn_probability double, clv_prediction double, expected_revenue_saved double, "
        "expected_value double, roi double, expected_retention_rate double",
    )
    scores = [(1, 0.9, 400.0), (2, 0.5, 200.0), (3, 0.1, 0.0), (4, 0.71, 1000.0)]
    churn = spark.createDataFrame([(i, p) for i, p, _ in scores], "customer_id long, churn_probability double")
    clv = spark.createDataFrame([(i, v) for i, _, v in scores], "customer_id long, clv_prediction double")
    seg = spark.createDataFrame(
        [(1, "At Risk"), (2, "Promising"), (3, "Promising"), (4, "At Risk")],
        "customer_id long, segment_name string",
    )
    from tidemark.operators.campaigns import portfolio_totals

    return allocation, churn, clv, seg, portfolio_totals(allocation)


def test_action_list(tables):
    allocation, _, _, seg, _ = tables
    rows = reports.customer_action_list(allocation, seg).orderBy("priority_rank").collect()
    assert rows[0].asDict() == {
        "customer_id": 1, "priority_rank": 1, "campaign_tier": "premium", "segment": "At Risk",
        "action": "Personal Call + 30% Discount + VIP Support", "churn_risk": "90.0%",
        "expected_clv": "$400.0", "expected_return": "$166.0", "roi_pct": "332.0%",
    }
    assert [r["customer_id"] for r in rows] == [1, 2]
    assert reports.customer_action_list(allocation, seg, top=1).count() == 1


def test_segment_and_impact_reports(tables):
    _, churn, clv, seg, portfolio = tables
    rows = {r["Segment"]: r for r in reports.segment_report(seg, churn, clv).collect()}
    assert rows["At Risk"]["Total CLV"] == "$1,400.00" and rows["At Risk"]["High Risk Count"] == 2
    assert rows["Promising"]["Percentage"] == "50.0%" and rows["Promising"]["Avg CLV"] == "$100.00"
    impact = {r["Metric"]: r for r in reports.impact_report(churn, clv, portfolio).collect()}
    assert len(impact) == 8
    assert impact["Customers Churning"]["Baseline (No Action)"] == "2"
    assert impact["Revenue at Risk"]["Baseline (No Action)"] == "$1,170"
    assert impact["Retention Investment"]["With ML Optimization"] == "$60"


def test_histogram_keeps_empty_bins(tables):
    rows = {r["bin"]: r for r in reports.value_histogram(tables[2], 10).collect()}
    assert len(rows) == 10
    assert [rows[b]["customers"] for b in range(1, 11)] == [1, 0, 1, 0, 1, 0, 0, 0, 0, 1]
    assert rows[10]["bin_high"] == 1000.0


def test_checks_report_missing_tables_and_overlap(tables):
    allocation, churn, clv, seg, portfolio = tables
    few = seg.where("customer_id = 1")
    rows = {
        r["check"]: r
        for r in checks.output_checks(
            {"segments": few, "churn": churn, "clv": clv, "allocation": allocation,
             "plan": allocation, "portfolio": portfolio}
        ).collect()
    }
    assert rows["Customer IDs align"]["status"] == "FAIL"
    assert rows["Customer IDs align"]["message"] == "1/4 customers in all datasets"
    assert rows["labels tables exist"]["status"] == "FAIL"
    assert rows["Probabilities in [0, 1]"]["message"] == "4/4 valid"
    assert rows["Execution plan covers allocation"]["status"] == "PASS"
