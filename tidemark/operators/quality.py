"""Data-quality checks on raw transactions.

All row-level rules share one scan; duplicates and customer counts add one
grouped pass each.

Fixed values: the names of the checks, their severities and the wording of their messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_text, percent
from tidemark.functions.parsing import invoice_time, number
from tidemark.settings import REQUIRED_COLUMNS, CleaningRules, QualityRules

REPORT = ("check", "status", "severity", "message", "details")


def _result(check: str, ok: Column, severity: Column, message: Column, **details: Column) -> Column:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("double"))]
    return F.struct(
        F.lit(check).alias("check"),
        F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        severity.alias("severity"),
        message.alias("message"),
        (
            F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
        ).alias("details"),
    )


def _level(bad: Column, level: str = "WARNING") -> Column:
    return F.when(bad, F.lit(level)).otherwise(F.lit("INFO"))


def missing_columns(raw: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> list[str]:
    """Required columns that are absent; no data is read."""
    return sorted(set(required) - set(raw.columns))


def require_columns(raw: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> None:
    absent = missing_columns(raw, required)
    if absent:
        raise ValueError(f"missing required columns: {absent}")


def column_completeness(raw: DataFrame) -> DataFrame:
    """Missing share per column, one scan of the table."""
    shares = raw.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in raw.columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count"))
            for c in raw.columns
        ]
    )
    return shares.select("n", F.inline(rows)).select(
        "column_name",
        "missing_count",
        percent(F.col("missing_count"), F.col("n")).alias("missing_pct"),
    )


def row_counters(
    raw: DataFrame, rules: QualityRules = QualityRules(), formats: CleaningRules = CleaningRules()
) -> DataFrame:
    """One row with every count that a single scan can give."""
    return raw.agg(*_row_aggregates(rules, formats, raw))


def _row_aggregates(rules: QualityRules, formats: CleaningRules, raw: DataFrame) -> list[Column]:
    qty, price = number("Quantity"), number("UnitPrice")
    when = invoice_time(raw, formats.date_formats)
    revenue = qty * price
    in_range = when.between(F.lit(rules.min_date), F.lit(rules.max_date))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("Quantity").isNotNull() & qty.isNull()).alias("bad_quantity"),
        F.count_if(F.col("UnitPrice").isNotNull() & price.isNull()).alias("bad_price"),
        F.count_if(F.col("InvoiceDate").isNotNull() & when.isNull()).alias("bad_date"),
        F.count_if(price < 0).alias("negative_price"),
        F.count_if(price == 0).alias("zero_price"),
        F.count_if(price >= rules.min_unit_price).alias("valid_price"),
        F.count_if((qty < rules.min_quantity) | (qty > rules.max_quantity)).alias(
            "quantity_out_of_range"
        ),
        F.count_if(qty == 0).alias("zero_quantity"),
        F.count_if(F.col("InvoiceNo").cast("string").startswith(rules.cancellation_prefix)).alias(
            "cancellations"
        ),
        F.count_if(qty < 0).alias("returns"),
        F.count_if(revenue > 0).alias("positive_revenue"),
        F.count_if(revenue < 0).alias("negative_revenue"),
        F.count_if(revenue == 0).alias("zero_revenue"),
        F.min(when).alias("first_date"),
        F.max(when).alias("last_date"),
        # A row without a date is outside the range too.
        F.count_if(~F.coalesce(in_range, F.lit(False))).alias("date_out_of_range"),
        F.count_if(when.isNull()).alias("null_dates"),
        F.count_if(F.col("CustomerID").isNull()).alias("null_customers"),
    ]


def duplicate_counters(raw: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Rows in key groups of more than one row; missing keys equal each other."""
    keys = [c for c in rules.duplicate_keys if c in raw.columns]
    groups = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
    )


def customer_counters(raw: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Distinct customers, rows without one, and customers with too few rows."""
    sizes = raw.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("CustomerID").isNotNull()
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(known).alias("unique_customers"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_customers"),
        F.count_if(known & (F.col("n") < rules.min_transactions)).alias("below_threshold"),
    )


def validation_report(
    raw: DataFrame,
    rules: QualityRules = QualityRules(),
    formats: CleaningRules = CleaningRules(),
) -> DataFrame:
    """``(check, status, severity, message, details)`` rows of all checks."""
    spark = raw.sparkSession
    absent = missing_columns(raw)
    if absent:
        head = F.struct(
            F.lit("Schema Validation").alias("check"),
            F.lit("FAIL").alias("status"),
            F.lit("ERROR").alias("severity"),
            F.lit(f"Missing required columns: {absent}").alias("message"),
            F.lit(None).cast("map<string,double>").alias("details"),
        )
        return spark.range(1).select(F.inline(F.array(head)))

    c = F.col
    # One scan for all counts by row, null counts of every column included.
    nulls = {name: f"__null_{i}" for i, name in enumerate(raw.columns)}
    scan = raw.agg(
        *_row_aggregates(rules, formats, raw),
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(n) for name, n in nulls.items()],
    )
    missing = {name: percent(c(n), c("rows")) for name, n in nulls.items()}
    per_column = [
        F.when(
            pct > rules.max_missing_pct,
            F.struct(
                F.lit(f"Completeness - {name}").alias("check"),
                F.lit("FAIL").alias("status"),
                F.lit("WARNING").alias("severity"),
                F.concat(
                    F.format_number(pct, 2), F.lit(f"% missing (threshold: {rules.max_missing_pct}%)")
                ).alias("message"),
                F.create_map(F.lit("missing_pct"), pct).alias("details"),
            ),
        )
        for name, pct in missing.items()
    ]
    average = sum(missing.values(), F.lit(0.0)) / len(missing)
    overall = F.struct(
        F.lit("Overall Completeness").alias("check"),
        F.lit("PASS").alias("status"),
        F.lit("INFO").alias("severity"),
        F.concat(F.lit("Average missing: "), F.format_number(average, 2), F.lit("%")).alias("message"),
        F.create_map(*[x for name, pct in missing.items() for x in (F.lit(name), pct)]).alias("details"),
    )

    info, yes = F.lit("INFO"), F.lit(True)

    def share(n: str) -> Column:
        return F.concat(
            count_text(c(n)),
            F.lit("|"),
            F.format_number(percent(c(n), c("rows")), 2),
        )

    def found(n: str, what: str) -> Column:
        bits = F.split(share(n), r"\|")
        return F.concat(F.lit("Found "), bits[0], F.lit(f" {what} ("), bits[1], F.lit("%)"))

    def typed(name: str, bad: str, kind: str) -> Column:
        return _result(
            f"Data Type - {name}",
            c(bad) == 0,
            _level(c(bad) > 0, "ERROR"),
            F.when(c(bad) == 0, F.lit(f"{name} is {kind}-compatible")).otherwise(
                F.concat(count_text(c(bad)), F.lit(f" values of {name} are not {kind}"))
            ),
            invalid_count=c(bad),
        )

    fixed = [
        _result(
            "Schema Validation", yes, info,
            F.lit(f"All {len(REQUIRED_COLUMNS)} required columns present"),
        ),
        typed("Quantity", "bad_quantity", "numeric"),
        typed("UnitPrice", "bad_price", "numeric"),
        typed("InvoiceDate", "bad_date", "datetime"),
        _result(
            "Value Range - UnitPrice",
            c("negative_price") == 0,
            _level(c("negative_price") > 0),
            F.concat(
                F.lit("Negative: "), count_text(c("negative_price")),
                F.lit(", Zero: "), count_text(c("zero_price")),
                F.lit(", Valid: "), count_text(c("valid_price")),
            ),
            negative_count=c("negative_price"),
            zero_count=c("zero_price"),
            valid_count=c("valid_price"),
        ),
        _result(
            "Value Range - Quantity", yes, info,
            F.concat(
                F.lit("Out of range: "), count_text(c("quantity_out_of_range")),
                F.lit(", Zero: "), count_text(c("zero_quantity")),
            ),
            out_of_range=c("quantity_out_of_range"),
            zero_count=c("zero_quantity"),
        ),
        _result(
            "Business Rule - Cancellations", yes, info,
            found("cancellations", "cancellations"), cancellation_count=c("cancellations"),
        ),
        _result(
            "Business Rule - Returns", yes, info,
            found("returns", "returns"), return_count=c("returns"),
        ),
        _result(
            "Business Rule - Revenue Distribution", yes, info,
            F.concat(
                F.lit("Positive: "), count_text(c("positive_revenue")),
                F.lit(", Negative: "), count_text(c("negative_revenue")),
                F.lit(", Zero: "), count_text(c("zero_revenue")),
            ),
            positive_revenue=c("positive_revenue"),
            negative_revenue=c("negative_revenue"),
            zero_revenue=c("zero_revenue"),
        ),
        _result(
            "Date Range Validation",
            c("date_out_of_range") == 0,
            _level(c("date_out_of_range") > 0),
            F.concat(
                F.lit("Date range: "), F.date_format("first_date", "yyyy-MM-dd"),
                F.lit(" to "), F.date_format("last_date", "yyyy-MM-dd"),
                F.lit(" ("),
                F.timestamp_diff("DAY", c("first_date"), c("last_date")).cast("string"),
                F.lit(" days)"),
            ),
            range_days=F.timestamp_diff("DAY", c("first_date"), c("last_date")),
            out_of_range=c("date_out_of_range"),
        ),
        _result(
            "Date Completeness", c("null_dates") == 0, _level(c("null_dates") > 0),
            F.concat(F.lit("Found "), count_text(c("null_dates")), F.lit(" null dates")),
            null_count=c("null_dates"),
        ),
    ]
    # Null dates are only reported when there are some.
    by_row = F.filter(F.array(*fixed, overall, *per_column), lambda x: x.isNotNull())
    scanned = scan.select(F.inline(by_row)).where(
        (F.col("check") != "Date Completeness") | (F.col("status") == "FAIL")
    )
    duplicates = duplicate_counters(raw, rules).select(
        F.inline(
            F.array(
                _result(
                    "Duplicate Records",
                    c("duplicate_rows") == 0,
                    _level(c("duplicate_rows") > 0),
                    found("duplicate_rows", "duplicate rows"),
                    duplicate_count=c("duplicate_rows"),
                )
            )
        )
    )
    null_bits = F.split(share("null_customers"), r"\|")
    customers = customer_counters(raw, rules).select(
        F.inline(
            F.array(
                _result(
                    "Customer Data", yes, info,
                    F.concat(
                        F.lit("Unique customers: "), count_text(c("unique_customers")),
                        F.lit(", Null CustomerID: "), null_bits[0],
                        F.lit(" ("), null_bits[1], F.lit("%)"),
                    ),
                    unique_customers=c("unique_customers"),
                    null_customers=c("null_customers"),
                    null_pct=percent(c("null_customers"), c("rows")),
                ),
                _result(
                    "Customer Transaction Count", yes, info,
                    F.concat(
                        count_text(c("below_threshold")),
                        F.lit(f" customers with < {rules.min_transactions} transactions"),
                    ),
                    below_threshold=c("below_threshold"),
                    threshold=F.lit(rules.min_transactions),
                ),
            )
        )
    )
    out = scanned
    for part in (duplicates, customers):
        out = out.unionByName(part)
    return out.select(*REPORT)


def validation_summary(report: DataFrame) -> DataFrame:
    """Counts by outcome, and ``ok``: no failed check of severity ERROR."""
    failed = F.col("status") == "FAIL"
    return report.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & (F.col("severity") == "ERROR")).alias("errors"),
        F.count_if(failed & (F.col("severity") == "WARNING")).alias("warnings"),
    ).withColumn("ok", F.col("errors") == 0)
