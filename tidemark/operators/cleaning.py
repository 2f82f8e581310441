"""Cleaning of raw transactions.

The rules run in a fixed order: structure, price and quantity rules, price
percentile, quantity quartiles, minimum rows per customer, derived columns.
Rows that pass the first two are a stage table, so the joins or the parsing
behind the raw rows run once.  The outlier limits are exact scalars found by
narrow scans of that table, and the rows are shuffled by customer at most once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import percent
from tidemark.functions.parsing import invoice_time, number
from tidemark.functions.quantiles import exact_quantiles
from tidemark.functions.staging import stage
from tidemark.operators.quality import require_columns
from tidemark.settings import CleaningRules

DERIVED = (
    "is_cancellation",
    "is_return",
    "Revenue",
    "Year",
    "Month",
    "Day",
    "DayOfWeek",
    "Hour",
    "Quarter",
    "AbsQuantity",
    "AbsRevenue",
    "transaction_type",
)


@dataclass(frozen=True)
class OutlierLimits:
    """Scalars that the outlier rules compare with; None switches a rule off."""

    max_price: float | None
    min_quantity: float | None
    max_quantity: float | None


def typed(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Parsed columns plus ``reject_reason``: the first structural rule a row breaks."""
    require_columns(raw)
    parsed = raw.withColumns(
        {
            "_customer_missing": F.col("CustomerID").isNull(),
            "InvoiceNo": F.col("InvoiceNo").cast("string"),
            "InvoiceDate": invoice_time(raw, rules.date_formats),
            "Quantity": number("Quantity"),
            "UnitPrice": number("UnitPrice"),
            "CustomerID": number("CustomerID").cast("long"),
        }
    )
    reason = (
        F.when(F.col("_customer_missing"), F.lit("null_customer"))
        .when(F.col("StockCode").isNull(), F.lit("null_stockcode"))
        .when(F.col("Description").isNull(), F.lit("null_description"))
        .when(F.col("InvoiceDate").isNull(), F.lit("null_date"))
        .when(F.col("Quantity").isNull() | F.col("UnitPrice").isNull(), F.lit("bad_number"))
    )
    return parsed.withColumn("reject_reason", reason).drop("_customer_missing")


def with_flags(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return df.withColumns(
        {
            "is_cancellation": F.coalesce(
                F.col("InvoiceNo").startswith(rules.cancellation_prefix), F.lit(False)
            ),
            "is_return": F.col("Quantity") < 0,
        }
    )


def business_valid(rules: CleaningRules = CleaningRules()) -> Column:
    return (F.col("UnitPrice") >= rules.min_unit_price) & (F.col("Quantity") != 0)


def price_limit(lines: DataFrame, rules: CleaningRules = CleaningRules()) -> float | None:
    return exact_quantiles(lines, F.col("UnitPrice"), [rules.max_price_quantile])[0]


def quantity_limits(
    lines: DataFrame, rules: CleaningRules = CleaningRules()
) -> tuple[float | None, float | None]:
    """Quartile limits of the positive quantities; returns are not judged."""
    bought = F.when(F.col("Quantity") > 0, F.col("Quantity"))
    q1, q3 = exact_quantiles(lines, bought, [0.25, 0.75])
    if q1 is None or q3 is None:
        return None, None
    reach = rules.quantity_iqr_factor * (q3 - q1)
    return q1 - reach, q3 + reach


def price_ok(limits: OutlierLimits) -> Column:
    return F.lit(True) if limits.max_price is None else F.col("UnitPrice") <= limits.max_price


def quantity_ok(limits: OutlierLimits) -> Column:
    if limits.max_quantity is None:
        return F.lit(True)
    qty = F.col("Quantity")
    return (qty < 0) | qty.between(limits.min_quantity, limits.max_quantity)


def outlier_limits(valid: DataFrame, rules: CleaningRules = CleaningRules()) -> OutlierLimits:
    """Price limit first; the quantity limits see only rows under it."""
    top = price_limit(valid, rules)
    cheap = valid if top is None else valid.where(F.col("UnitPrice") <= top)
    low, high = quantity_limits(cheap, rules)
    return OutlierLimits(top, low, high)


def too_few_rows(lines: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Customers below the minimum row count (counted map-side, one row each)."""
    return (
        lines.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") < rules.min_transactions)
        .select("CustomerID")
    )


def keep_regular_customers(lines: DataFrame, few: DataFrame) -> DataFrame:
    """Drop the lines of customers in ``few``.

    An anti join against the few that go, not a semi join with the many that
    stay: the small side is what travels, and a customer with a large share of
    all lines is never gathered in one task when that side fits a broadcast
    (decided at run time by its real size).
    """
    return lines.where(F.col("CustomerID").isNotNull()).join(few, "CustomerID", "left_anti")


def with_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("Revenue", F.col("Quantity") * F.col("UnitPrice"))


def with_date_parts(df: DataFrame) -> DataFrame:
    at = F.col("InvoiceDate")
    return df.withColumns(
        {
            "Year": F.year(at),
            "Month": F.month(at),
            "Day": F.dayofmonth(at),
            "DayOfWeek": F.weekday(at),  # Monday = 0
            "Hour": F.hour(at),
            "Quarter": F.quarter(at),
        }
    )


def with_absolutes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"AbsQuantity": F.abs("Quantity"), "AbsRevenue": F.abs("Revenue")}
    )


def with_transaction_type(df: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("is_cancellation"), F.lit("cancellation"))
        .when(F.col("is_return"), F.lit("return"))
        .otherwise(F.lit("purchase"))
    )
    return df.withColumn("transaction_type", kind)


def derive(df: DataFrame) -> DataFrame:
    return with_transaction_type(with_absolutes(with_date_parts(with_revenue(df))))


@dataclass(frozen=True)
class Cleaning:
    """A planned cleaning: all tagged rows as staged, the valid ones of them, the limits."""

    tagged: DataFrame
    valid: DataFrame
    limits: OutlierLimits
    rules: CleaningRules

    @property
    def inliers(self) -> DataFrame:
        return self.valid.where(price_ok(self.limits) & quantity_ok(self.limits))

    def regular(self) -> DataFrame:
        """Cleaned lines without the derived columns.

        The customers to drop are written first: with their size known beforehand the lines
        are not shuffled to meet a few of them.
        """
        return keep_regular_customers(self.inliers, stage(too_few_rows(self.inliers, self.rules), "few"))

    def lines(self) -> DataFrame:
        return derive(self.regular())

    def statistics(self) -> DataFrame:
        """One row of counters; every count is charged to the rule that removed the row."""
        c, lim = F.col, self.limits
        sound = c("reject_reason").isNull()
        rule_ok = sound & business_valid(self.rules)
        in_price = rule_ok & price_ok(lim)
        in_quantity = in_price & quantity_ok(lim)

        def rejected(reason: str) -> Column:
            return F.count_if(c("reject_reason") == reason)

        scan = self.tagged.agg(
            F.count(F.lit(1)).alias("initial_rows"),
            rejected("null_customer").alias("null_customer_removed"),
            rejected("null_stockcode").alias("null_stockcode_removed"),
            rejected("null_description").alias("null_description_removed"),
            rejected("null_date").alias("null_date_removed"),
            rejected("bad_number").alias("numeric_conversion_failed"),
            # Flags and the zero-quantity count are taken before the price rule.
            F.count_if(sound & c("is_cancellation")).alias("cancellations_flagged"),
            F.count_if(sound & c("is_return")).alias("returns_flagged"),
            F.count_if(sound & (c("UnitPrice") < self.rules.min_unit_price)).alias(
                "invalid_price_removed"
            ),
            F.count_if(sound & (c("Quantity") == 0)).alias("zero_quantity_removed"),
            F.count_if(rule_ok & ~price_ok(lim)).alias("price_outliers_removed"),
            F.count_if(in_price & ~quantity_ok(lim)).alias("quantity_outliers_removed"),
        )
        people = (
            self.inliers.where(c("CustomerID").isNotNull())
            .groupBy("CustomerID")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(c("Quantity") < 0).alias("returned"),
            )
            .agg(
                F.count_if(c("n") < self.rules.min_transactions).alias("customers_removed_min_txn"),
                F.count_if(
                    (c("n") >= self.rules.min_transactions)
                    & (c("returned") / c("n") > self.rules.high_return_share)
                ).alias("high_return_customers"),
                F.coalesce(
                    F.sum(F.when(c("n") >= self.rules.min_transactions, c("n"))), F.lit(0)
                ).alias("final_rows"),
            )
        )
        per_customer = people.select(F.struct(*people.columns).alias("p")).scalar()
        return (
            scan.withColumn("p", per_customer)
            .select(*scan.columns, "p.*")
            .withColumn("rows_removed", c("initial_rows") - c("final_rows"))
            .withColumn("removal_pct", percent(c("rows_removed"), c("initial_rows")))
        )


def plan_cleaning(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> Cleaning:
    """Write the tagged rows once, find the scalar limits; of the cleaned rows only the customers to drop are written.

    The raw rows are read once: valid rows and all counters come from the written ones.  (An
    ``Observation`` of the write would do for the counters, but after one the session can't be
    serialised, and with it no classifier that keeps its training summary.)
    """
    tagged = stage(with_flags(typed(raw, rules), rules), "tagged")
    sound = F.col("reject_reason").isNull() & business_valid(rules)
    valid = tagged.where(sound).drop("reject_reason")
    return Cleaning(tagged, valid, outlier_limits(valid, rules), rules)


def clean_transactions(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return plan_cleaning(raw, rules).lines()


def high_return_customers(
    lines: DataFrame, rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """Customers whose share of return lines is above the limit; nothing is removed."""
    return (
        lines.groupBy("CustomerID")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if("is_return").alias("return_lines"),
        )
        .withColumn("return_share", F.col("return_lines") / F.col("lines"))
        .where(F.col("return_share") > rules.high_return_share)
    )
