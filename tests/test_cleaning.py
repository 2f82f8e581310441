import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning, quality
from tidemark.settings import CleaningRules

COLUMNS = "InvoiceNo StockCode Description Quantity InvoiceDate UnitPrice CustomerID Country".split()
WHEN = "12/1/2010 8:26"


def _row(**kw):
    base = dict(
        InvoiceNo="536365", StockCode="85123A", Description="HEART", Quantity="6",
        InvoiceDate=WHEN, UnitPrice="2.5", CustomerID="17850.0", Country="United Kingdom",
    )
    base.update(kw)
    return tuple(base[c] for c in COLUMNS)


@pytest.fixture(scope="module")
def raw(spark):
    good = [
        _row(InvoiceNo=f"1{i}", CustomerID=f"{100 + i % 4}.0", Quantity=str(1 + i % 5),
             UnitPrice=str(1 + i % 3))
        for i in range(40)
    ]
    bad = [
        _row(CustomerID=None),
        _row(CustomerID=None, Description=None),  # charged to the customer rule only
        _row(StockCode=None),
        _row(Description=None),
        _row(InvoiceDate="not a date"),
        _row(Quantity="many"),
        _row(UnitPrice="x"),
        _row(UnitPrice="0"),
        _row(Quantity="0"),
        _row(UnitPrice="0", Quantity="0"),  # counted by both rules
        _row(UnitPrice="5000"),  # above the price percentile
        _row(Quantity="9000"),  # bulk
        _row(InvoiceNo="C9", Quantity="-2", CustomerID="100"),
        _row(InvoiceNo="19", Quantity="-3000", CustomerID="101"),  # returns are never outliers
        _row(CustomerID="555"),  # single line
        _row(CustomerID="abc"),  # no usable customer, dropped with the small ones
        _row(InvoiceNo="77", Quantity="-1", CustomerID="777"),
        _row(InvoiceNo="78", Quantity="-1", CustomerID="777"),
    ]
    return spark.createDataFrame(good + bad, ", ".join(f"{c} string" for c in COLUMNS))


@pytest.fixture(scope="module")
def plan(raw):
    return cleaning.plan_cleaning(raw)


def test_each_row_is_charged_to_the_right_rule(plan):
    s = plan.statistics().first().asDict()
    assert s["initial_rows"] == 58
    assert s["null_customer_removed"] == 2
    assert s["null_stockcode_removed"] == 1
    assert s["null_description_removed"] == 1
    assert s["null_date_removed"] == 1
    assert s["numeric_conversion_failed"] == 2
    assert s["invalid_price_removed"] == 2
    assert s["zero_quantity_removed"] == 2
    assert s["price_outliers_removed"] == 1
    assert s["quantity_outliers_removed"] == 1
    assert s["cancellations_flagged"] == 1
    assert s["returns_flagged"] == 4
    assert s["customers_removed_min_txn"] == 1
    assert s["high_return_customers"] == 1
    assert s["final_rows"] == plan.lines().count() == 44
    assert s["removal_pct"] == pytest.approx(100 * 14 / 58)


def test_derived_columns(plan):
    row = plan.lines().where("InvoiceNo = 'C9'").first()
    assert (row["transaction_type"], row["Revenue"], row["AbsRevenue"]) == ("cancellation", -5.0, 5.0)
    assert (row["Year"], row["Month"], row["Day"], row["DayOfWeek"]) == (2010, 12, 1, 2)
    assert (row["Hour"], row["Quarter"]) == (8, 4)
    kinds = {r["InvoiceNo"]: r["transaction_type"] for r in plan.lines().collect()}
    assert kinds["77"] == "return" and kinds["10"] == "purchase"


def test_day_and_month_are_not_guessed(spark):
    df = spark.createDataFrame([_row(InvoiceDate="2/3/2011 9:05")] * 2,
                               ", ".join(f"{c} string" for c in COLUMNS))
    got = cleaning.typed(df).select(F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm")).first()[0]
    assert got == "2011-02-03 09:05"


def test_missing_column_is_an_error(raw):
    with pytest.raises(ValueError, match="Country"):
        cleaning.typed(raw.drop("Country"))
    report = quality.validation_report(raw.drop("Country")).collect()
    assert [(r["check"], r["status"], r["severity"]) for r in report] == [
        ("Schema Validation", "FAIL", "ERROR")
    ]


def test_high_return_customers(plan):
    got = cleaning.high_return_customers(plan.lines(), CleaningRules()).collect()
    assert [(r["CustomerID"], r["return_share"]) for r in got] == [(777, 1.0)]


def test_validation_report(raw):
    rows = {r["check"]: r for r in quality.validation_report(raw).collect()}
    assert rows["Data Type - Quantity"]["status"] == "FAIL"
    assert rows["Data Type - Quantity"]["details"]["invalid_count"] == 1.0
    assert rows["Date Completeness"]["message"] == "Found 1 null dates"
    assert rows["Date Range Validation"]["details"]["out_of_range"] == 1.0
    assert rows["Value Range - Quantity"]["message"] == "Out of range: 0, Zero: 2"
    assert rows["Business Rule - Cancellations"]["details"]["cancellation_count"] == 1.0
    # Identical keys occur in many rows; null keys equal each other.
    keys = [(r["InvoiceNo"], r["StockCode"], r["CustomerID"]) for r in raw.collect()]
    assert rows["Duplicate Records"]["details"]["duplicate_count"] == sum(
        keys.count(k) > 1 for k in keys
    )
    summary = quality.validation_summary(quality.validation_report(raw)).first()
    assert not summary["ok"] and summary["errors"] == 3
    assert summary["total_checks"] == len(rows)


def test_no_outlier_rule_without_positive_quantities(spark):
    df = spark.createDataFrame(
        [_row(Quantity="-1", InvoiceNo=str(i)) for i in range(4)],
        ", ".join(f"{c} string" for c in COLUMNS),
    )
    assert cleaning.clean_transactions(df).count() == 4


def test_lines_do_not_move_to_meet_the_customers_to_drop(spark):
    rows = [(f"{i}", "s", "d", 1.0, "2020-01-01 10:00:00", 2.0, float(i % 40), "x") for i in range(200)]
    raw = spark.createDataFrame(rows + [("n", "s", "d", 1.0, "2020-01-01 10:00:00", 2.0, 99.0, "x")],
        "InvoiceNo string, StockCode string, Description string, Quantity double, InvoiceDate string, UnitPrice double, CustomerID double, Country string")
    regular = cleaning.plan_cleaning(raw).regular()
    assert regular.where("CustomerID = 99").isEmpty() and regular.count() == 200
    plan = regular._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
