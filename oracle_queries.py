"""Equivalent SQL for the registered queries, as DuckDB statements.

The statements share common table expressions; :func:`build` puts the needed
ones in front of each final SELECT.
"""

from __future__ import annotations

import re


def fx(expr: str, places: int = 4) -> str:
    """Same grid as ``fixed`` in the query registry."""
    scale = 10**places
    return f"floor(({expr}) * {scale}.0 + 0.381966) / {scale}.0"


def fxs(*names: str, places: int = 4) -> str:
    return ", ".join(f"{fx(n, places)} AS {n}" for n in names)


CTES: dict[str, str] = {}

CTES["raw"] = """
SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_orderkey % 2 = 0 THEN 'C' ELSE '' END
         || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
       CAST(l_partkey AS VARCHAR) AS StockCode,
       p_name AS Description,
       l_quantity * CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1.0 ELSE 1.0 END
                  * CASE WHEN l_orderkey % 97 = 0 THEN 100.0 ELSE 1.0 END AS Quantity,
       o_orderdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)) AS InvoiceDate,
       CASE WHEN l_orderkey % 211 = 0 THEN 0.0 ELSE l_extendedprice / l_quantity END AS UnitPrice,
       CAST(CASE WHEN l_orderkey % 10 = 3 THEN NULL ELSE o_custkey END AS DOUBLE) AS CustomerID,
       n_name AS Country
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN part ON l_partkey = p_partkey"""

CTES["sound"] = """
SELECT * FROM raw
WHERE CustomerID IS NOT NULL AND StockCode IS NOT NULL AND Description IS NOT NULL
  AND InvoiceDate IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL"""
CTES["valid"] = "SELECT * FROM sound WHERE UnitPrice >= 0.01 AND Quantity <> 0"
CTES["price_cut"] = "SELECT quantile_cont(UnitPrice, 0.99) AS v FROM valid"
CTES["cheap"] = "SELECT * FROM valid WHERE UnitPrice <= (SELECT v FROM price_cut)"
CTES["qty_cut"] = """
SELECT quantile_cont(Quantity, 0.25) AS q1, quantile_cont(Quantity, 0.75) AS q3
FROM cheap WHERE Quantity > 0"""
CTES["inliers"] = """
SELECT cheap.* FROM cheap, qty_cut
WHERE Quantity < 0 OR Quantity BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)"""
CTES["clean"] = """
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
       CAST(CustomerID AS BIGINT) AS CustomerID, Country,
       InvoiceNo LIKE 'C%' AS is_cancellation, Quantity < 0 AS is_return,
       Quantity * UnitPrice AS Revenue,
       CAST(year(InvoiceDate) AS INTEGER) AS "Year", CAST(month(InvoiceDate) AS INTEGER) AS "Month",
       CAST(day(InvoiceDate) AS INTEGER) AS "Day",
       CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS DayOfWeek,
       CAST(hour(InvoiceDate) AS INTEGER) AS "Hour",
       CAST(quarter(InvoiceDate) AS INTEGER) AS "Quarter",
       abs(Quantity) AS AbsQuantity, abs(Quantity * UnitPrice) AS AbsRevenue,
       CASE WHEN InvoiceNo LIKE 'C%' THEN 'cancellation' WHEN Quantity < 0 THEN 'return'
            ELSE 'purchase' END AS transaction_type
FROM inliers
WHERE CustomerID IN (SELECT CustomerID FROM inliers GROUP BY CustomerID HAVING count(*) >= 2)"""

CTES["bounds"] = """
SELECT min(InvoiceDate) + INTERVAL 180 DAY AS f, max(InvoiceDate) - INTERVAL 90 DAY AS l,
       max(InvoiceDate) AS last_ts FROM clean"""
CTES["snaps"] = """
SELECT snapshot_date FROM (
  SELECT CAST(last_day(CAST(m AS DATE)) AS TIMESTAMP) + (f - date_trunc('day', f)) AS snapshot_date, f, l
  FROM (SELECT f, l, unnest(generate_series(date_trunc('month', f), date_trunc('month', l),
                                            INTERVAL 1 MONTH)) AS m FROM bounds))
WHERE snapshot_date BETWEEN f AND l"""
CTES["week_snaps"] = """
SELECT snapshot_date FROM (
  SELECT unnest(generate_series(f + to_days(CAST((7 - isodow(f)) % 7 AS INTEGER)), l, INTERVAL 7 DAY))
         AS snapshot_date FROM bounds)"""
CTES["latest"] = "SELECT max(snapshot_date) AS snapshot_date FROM snaps"
CTES["obs"] = """
SELECT c.CustomerID AS customer_id, c.InvoiceNo, c.StockCode, c.InvoiceDate, c.Quantity, c.Revenue,
       c.is_return, s.snapshot_date
FROM clean c JOIN snaps s
  ON c.InvoiceDate BETWEEN s.snapshot_date - INTERVAL 180 DAY AND s.snapshot_date"""

CTES["rfm"] = """
SELECT customer_id, snapshot_date,
       CAST(date_sub('day', max(InvoiceDate), snapshot_date) AS INTEGER) AS rfm_recency_days,
       count(*) AS rfm_frequency_count,
       sum(Revenue) / count(*) AS rfm_monetary_avg,
       sum(Revenue) AS rfm_monetary_total,
       coalesce(stddev_samp(Revenue), 0.0) AS rfm_monetary_std,
       CAST(date_sub('day', min(InvoiceDate), snapshot_date) AS INTEGER) AS days_since_first_purchase,
       CAST(date_sub('day', min(InvoiceDate), max(InvoiceDate)) AS INTEGER) AS customer_lifetime_days
FROM obs GROUP BY customer_id, snapshot_date"""


def _window(name: str, days: int) -> str:
    cond = f"InvoiceDate >= snapshot_date - INTERVAL {days} DAY"
    return (
        f"count(*) FILTER (WHERE {cond}) AS txn_count_{name}_{days}d, "
        f"coalesce(sum(Revenue) FILTER (WHERE {cond}), 0.0) AS revenue_{name}_{days}d"
    )


WINDOWS = (("short", 30), ("medium", 60), ("long", 90), ("very_long", 180))
CTES["windows"] = (
    "SELECT customer_id, snapshot_date, "
    + ", ".join(_window(n, d) for n, d in WINDOWS)
    + " FROM obs GROUP BY customer_id, snapshot_date"
)
CTES["gap_rows"] = """
SELECT customer_id, snapshot_date, InvoiceDate,
       date_sub('day', lag(InvoiceDate) OVER (PARTITION BY customer_id, snapshot_date
                                              ORDER BY InvoiceDate), InvoiceDate) AS gap
FROM obs"""
CTES["gaps"] = """
SELECT customer_id, snapshot_date, m AS interpurchase_time_mean, s AS interpurchase_time_std,
       d AS interpurchase_time_median,
       CASE WHEN m = 0 THEN 0.0 ELSE s / m END AS interpurchase_time_cv,
       n / CASE WHEN life = 0 THEN 1.0 ELSE life / 30.0 END AS purchase_frequency_per_month
FROM (SELECT customer_id, snapshot_date, coalesce(avg(gap), 0.0) AS m,
             coalesce(stddev_samp(gap), 0.0) AS s, coalesce(quantile_cont(gap, 0.5), 0.0) AS d,
             count(*) AS n, date_sub('day', min(InvoiceDate), max(InvoiceDate)) AS life
      FROM gap_rows GROUP BY customer_id, snapshot_date)"""
CTES["product"] = """
SELECT customer_id, snapshot_date, count(*) AS unique_products_count,
       1 - sum(CAST(n AS DOUBLE) * n) / (CAST(sum(n) AS DOUBLE) * sum(n)) AS product_diversity_hhi
FROM (SELECT customer_id, snapshot_date, StockCode, count(*) AS n FROM obs
      GROUP BY customer_id, snapshot_date, StockCode)
GROUP BY customer_id, snapshot_date"""
CTES["basket"] = """
SELECT customer_id, snapshot_date, avg(q) AS avg_basket_size,
       coalesce(stddev_samp(q), 0.0) AS std_basket_size
FROM (SELECT customer_id, snapshot_date, InvoiceNo, abs(sum(Quantity)) AS q FROM obs
      GROUP BY customer_id, snapshot_date, InvoiceNo)
GROUP BY customer_id, snapshot_date"""
CTES["returns"] = """
SELECT customer_id, snapshot_date, avg(CASE WHEN is_return THEN 1.0 ELSE 0.0 END) AS return_rate
FROM obs GROUP BY customer_id, snapshot_date"""
CTES["engagement"] = """
SELECT customer_id, snapshot_date, engagement_score,
       CASE WHEN top = 0 THEN 0.0 ELSE engagement_score / top END AS engagement_score_normalized,
       1.0 / (interpurchase_time_cv + 1) AS consistency_score,
       txn_count_short_30d / (rfm_frequency_count + 1) AS activity_score
FROM (SELECT *, max(engagement_score) OVER (PARTITION BY snapshot_date) AS top
      FROM (SELECT customer_id, snapshot_date, interpurchase_time_cv, txn_count_short_30d,
                   rfm_frequency_count,
                   rfm_frequency_count * rfm_monetary_avg / (rfm_recency_days + 1) AS engagement_score
            FROM rfm JOIN windows USING (customer_id, snapshot_date)
                     JOIN gaps USING (customer_id, snapshot_date)))"""
CTES["months"] = """
SELECT customer_id, snapshot_date, rev, n, count(*) OVER w AS m,
       row_number() OVER (PARTITION BY customer_id, snapshot_date ORDER BY mon) - 1 AS i
FROM (SELECT customer_id, snapshot_date, date_trunc('month', InvoiceDate) AS mon,
             sum(Revenue) AS rev, count(*) AS n
      FROM obs GROUP BY customer_id, snapshot_date, date_trunc('month', InvoiceDate))
WINDOW w AS (PARTITION BY customer_id, snapshot_date)"""
CTES["trend"] = """
SELECT customer_id, snapshot_date, r AS revenue_trend_slope, t AS transaction_trend_slope,
       CAST(sign(round(r, 6)) AS DOUBLE) AS revenue_trend_direction,
       CAST(sign(round(t, 6)) AS DOUBLE) AS transaction_trend_direction
FROM (SELECT customer_id, snapshot_date,
             CASE WHEN max(m) < 2 THEN 0.0
                  ELSE sum((i - (m - 1) / 2.0) * rev ORDER BY i) * 12 / (max(m) * (max(m) * max(m) - 1)) END AS r,
             CASE WHEN max(m) < 2 THEN 0.0
                  ELSE sum((i - (m - 1) / 2.0) * n ORDER BY i) * 12 / (max(m) * (max(m) * max(m) - 1)) END AS t
      FROM months GROUP BY customer_id, snapshot_date)"""
CTES["features"] = """
SELECT * FROM rfm JOIN windows USING (customer_id, snapshot_date)
JOIN gaps USING (customer_id, snapshot_date) JOIN product USING (customer_id, snapshot_date)
JOIN basket USING (customer_id, snapshot_date) JOIN returns USING (customer_id, snapshot_date)
JOIN engagement USING (customer_id, snapshot_date) JOIN trend USING (customer_id, snapshot_date)"""
# Score of the latest snapshot only, for queries that need no other columns.
CTES["rfm_latest"] = """
SELECT *, rfm_frequency_count * rfm_monetary_avg / (rfm_recency_days + 1) AS engagement_score
FROM rfm WHERE snapshot_date = (SELECT snapshot_date FROM latest)"""

CTES["history"] = """
SELECT customer_id, snapshot_date, n AS transaction_count, revenue AS total_revenue,
       last_ts AS last_purchase_date,
       CAST(date_sub('day', last_ts, snapshot_date) AS INTEGER) AS days_since_last_purchase,
       CAST(date_sub('day', first_ts, last_ts) AS INTEGER) AS tenure_days,
       CAST(date_sub('day', first_ts, snapshot_date) AS INTEGER) AS days_in_observation,
       active.c IS NOT NULL AS active_later, back.c IS NOT NULL AS returned
FROM (SELECT customer_id, snapshot_date, count(*) AS n, sum(Revenue) AS revenue,
             min(InvoiceDate) AS first_ts, max(InvoiceDate) AS last_ts
      FROM obs GROUP BY customer_id, snapshot_date) h
LEFT JOIN (SELECT DISTINCT CustomerID AS c, snapshot_date AS s FROM clean JOIN snaps
             ON InvoiceDate > snapshot_date AND InvoiceDate <= snapshot_date + INTERVAL 90 DAY) active
  ON customer_id = active.c AND snapshot_date = active.s
LEFT JOIN (SELECT DISTINCT CustomerID AS c, snapshot_date AS s FROM clean JOIN snaps
             ON InvoiceDate > snapshot_date + INTERVAL 90 DAY
            AND InvoiceDate <= snapshot_date + INTERVAL 180 DAY) back
  ON customer_id = back.c AND snapshot_date = back.s"""
CTES["labels"] = """
SELECT *, CASE WHEN active_later THEN 0 ELSE 1 END AS churn_label,
       days_since_last_purchase / 180.0 AS churn_probability
FROM history WHERE transaction_count >= 2 AND days_in_observation >= 30"""
CTES["targets"] = """
SELECT o.customer_id, o.snapshot_date, coalesce(r.rev, 0.0) AS clv_target,
       o.snapshot_date + INTERVAL 180 DAY > (SELECT last_ts FROM bounds) AS is_censored
FROM (SELECT DISTINCT customer_id, snapshot_date FROM obs) o
LEFT JOIN (SELECT CustomerID AS customer_id, snapshot_date, sum(Revenue) AS rev
           FROM clean JOIN snaps ON InvoiceDate > snapshot_date
                AND InvoiceDate <= snapshot_date + INTERVAL 180 DAY
           GROUP BY CustomerID, snapshot_date) r
  ON o.customer_id = r.customer_id AND o.snapshot_date = r.snapshot_date"""
CTES["guesses"] = """
SELECT customer_id, snapshot_date, clv_target AS actual,
       round(greatest(rfm_monetary_total, 0), 2) AS predicted
FROM targets JOIN rfm USING (customer_id, snapshot_date)"""

CTES["scores"] = """
SELECT *, CASE WHEN churn_probability <= 0 THEN NULL WHEN churn_probability <= 0.3 THEN 'Low'
               WHEN churn_probability <= 0.5 THEN 'Medium' WHEN churn_probability <= 0.7 THEN 'High'
               WHEN churn_probability <= 1 THEN 'Very High' END AS risk_level
FROM (SELECT *, rfm_recency_days / 180.0 AS churn_probability,
             round(greatest(rfm_monetary_total, 0), 2) / 1000 AS clv_prediction,
             CAST(floor(rfm_recency_days / 45.0) AS INTEGER) AS segment
      FROM rfm_latest)"""


_RFM = ("rfm_recency_days", "rfm_frequency_count", "rfm_monetary_avg")
CTES["holes"] = """
SELECT customer_id, CASE WHEN customer_id % 7 <> 0 THEN rfm_monetary_avg END AS m FROM scores"""
CTES["scaled"] = "SELECT customer_id, segment, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in _RFM
) + " FROM scores"
CTES["rule_centres"] = (
    "SELECT segment, " + ", ".join(f"avg({c}) AS {c}" for c in _RFM) + " FROM scaled GROUP BY segment"
)
CTES["rule_spread"] = (
    "SELECT s.segment, avg(sqrt(" + " + ".join(f"pow(s.{c} - k.{c}, 2)" for c in _RFM) + ")) AS spread "
    "FROM scaled s JOIN rule_centres k ON s.segment = k.segment GROUP BY s.segment"
)
CTES["rule_variance"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop({c}) AS v FROM rule_centres" for c in _RFM
)
CENTRES = ((-0.7, 0.9, 0.1), (0.1, -0.2, -0.4), (1.3, -0.6, 0.2), (-0.4, -0.4, 1.1))


def _nearest() -> str:
    away = [
        "(" + " + ".join(f"pow({c} - ({v}::DOUBLE), 2)" for c, v in zip(_RFM, x)) + ")" for x in CENTRES
    ]
    least = f"least({', '.join(away)})"
    return "CASE " + " ".join(f"WHEN {d} = {least} THEN {i}" for i, d in enumerate(away)) + " END"


def time_split(source: str) -> str:
    """The rows of ``source`` with ``split``: the oldest 72 percent train, to 80 percent val, then test."""
    return f"""
SELECT *, CASE WHEN pos <= fit - CAST(trunc(fit * 0.1) AS BIGINT) THEN 'train' WHEN pos <= fit THEN 'val'
               ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY snapshot_date, customer_id) AS pos,
             CAST(trunc(count(*) OVER () * (1 - 0.2::DOUBLE)) AS BIGINT) AS fit FROM {source})"""


def naming(r: str, f: str, m: str) -> str:
    return f"""CASE WHEN {r} < 30 AND {f} > 10 AND {m} > 100 THEN 'Champions'
     WHEN {f} > 8 AND {m} > 80 THEN 'Loyal Customers'
     WHEN {r} > 60 AND {f} > 5 AND {m} > 60 THEN 'At Risk'
     WHEN {r} > 90 AND {f} > 3 THEN 'Hibernating'
     WHEN {r} < 30 AND {f} < 3 THEN 'New Customers'
     WHEN {r} < 45 AND {f} >= 3 THEN 'Promising'
     WHEN {r} < 60 AND {f} >= 2 THEN 'Need Attention'
     ELSE 'Lost/Churned' END"""


CTES["named"] = (
    "SELECT *, "
    + naming("rfm_recency_days", "rfm_frequency_count", "rfm_monetary_avg")
    + " AS segment_name FROM scores"
)
CTES["profiles"] = (
    "SELECT *, 100.0 * size / sum(size) OVER () AS size_pct, "
    + naming("avg_recency", "avg_frequency", "avg_monetary")
    + """ AS segment_name FROM (
SELECT segment, count(*) AS size, avg(rfm_recency_days) AS avg_recency,
       avg(rfm_frequency_count) AS avg_frequency, avg(rfm_monetary_avg) AS avg_monetary,
       sum(rfm_monetary_total) AS total_revenue, avg(engagement_score) AS avg_engagement_score,
       avg(days_since_first_purchase) AS avg_customer_age_days,
       avg(churn_probability) AS avg_churn_risk, avg(clv_prediction) AS avg_clv
FROM scores GROUP BY segment)"""
)
CTES["campaign"] = """
SELECT * FROM (VALUES ('premium', 'Premium Retention', 50.0::DOUBLE, 0.60::DOUBLE),
  ('standard', 'Standard Retention', 25.0::DOUBLE, 0.40::DOUBLE),
  ('light', 'Light Touch', 10.0::DOUBLE, 0.20::DOUBLE),
  ('none', 'No Intervention', 0.0::DOUBLE, 0.0::DOUBLE))
  t(campaign_tier, campaign_name, campaign_cost, expected_retention_rate)"""
CTES["all_options"] = """
SELECT customer_id, churn_probability, clv_prediction,
       churn_probability * clv_prediction AS expected_loss_baseline, campaign_tier, campaign_name,
       campaign_cost, churn_probability * clv_prediction * expected_retention_rate AS expected_revenue_saved,
       churn_probability * clv_prediction * expected_retention_rate - campaign_cost AS expected_value,
       CASE WHEN campaign_cost > 0 THEN (churn_probability * clv_prediction * expected_retention_rate
            - campaign_cost) / campaign_cost ELSE 0.0 END AS roi,
       expected_retention_rate
FROM scores CROSS JOIN campaign"""
CTES["options"] = "SELECT * FROM all_options WHERE campaign_tier <> 'none' AND roi >= 0"
CTES["ample"] = """
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY expected_value DESC, campaign_tier) AS k FROM options) WHERE k = 1"""
CTES["ranked_options"] = """
SELECT *, row_number() OVER (ORDER BY expected_value DESC, customer_id, campaign_tier) AS pos FROM options"""
TIGHT_BUDGET = 5035.0


def walk(source: str, scenarios: str, cost: str) -> str:
    """Sequential greedy walk: one step per option, carrying money and taken customers."""
    return f"""
SELECT scenario, 0::BIGINT AS pos, money, []::BIGINT[] AS taken, false AS took FROM ({scenarios})
UNION ALL
SELECT w.scenario, o.pos,
       CASE WHEN NOT list_contains(w.taken, o.customer_id) AND o.{cost} <= w.money
            THEN w.money - o.{cost} ELSE w.money END,
       CASE WHEN NOT list_contains(w.taken, o.customer_id) AND o.{cost} <= w.money
            THEN list_append(w.taken, o.customer_id) ELSE w.taken END,
       NOT list_contains(w.taken, o.customer_id) AND o.{cost} <= w.money
FROM WALKNAME w JOIN {source} o ON o.pos = w.pos + 1"""


CTES["tight_walk"] = walk(
    "ranked_options", f"SELECT 'all' AS scenario, {TIGHT_BUDGET}::DOUBLE AS money", "campaign_cost"
).replace("WALKNAME", "tight_walk")
CTES["tight"] = "SELECT o.* FROM ranked_options o JOIN tight_walk w ON o.pos = w.pos AND w.took"
CTES["budget_walk"] = walk(
    "ranked_options",
    "SELECT f AS scenario, f * %r::DOUBLE AS money FROM "
    "(VALUES (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE), (1.5::DOUBLE), (2.0::DOUBLE)) t(f)"
    % TIGHT_BUDGET,
    "campaign_cost",
).replace("WALKNAME", "budget_walk")
CTES["portfolio"] = """
SELECT count(*) AS total_customers_targeted, coalesce(sum(campaign_cost), 0) AS total_campaign_cost,
       coalesce(sum(expected_revenue_saved), 0) AS total_expected_revenue_saved,
       coalesce(sum(expected_value), 0) AS total_expected_net_value,
       coalesce(sum(churn_probability * expected_retention_rate), 0) AS expected_customers_saved,
       coalesce(sum(expected_value) / nullif(sum(campaign_cost), 0) * 100, 0) AS portfolio_roi_pct,
       coalesce(sum(campaign_cost) / nullif(sum(churn_probability * expected_retention_rate), 0), 0)
         AS cost_per_customer_saved
FROM tight"""
CTES["tiered"] = """
SELECT * FROM (VALUES (1, 'VIP Personal Outreach', 25.0::DOUBLE, 0.5::DOUBLE, 500, 0.6::DOUBLE),
  (2, 'Premium Email Campaign', 5.0::DOUBLE, 0.3::DOUBLE, 200, 0.5::DOUBLE),
  (3, 'Standard Retention', 2.0::DOUBLE, 0.2::DOUBLE, 100, 0.3::DOUBLE),
  (4, 'Basic Email', 1.0::DOUBLE, 0.1::DOUBLE, 50, 0.2::DOUBLE),
  (0, 'No Action', 0.0::DOUBLE, 0.0::DOUBLE, 0, 0.0::DOUBLE))
  t(tier, campaign_name, cost, retention_rate, min_clv, min_churn)"""
CTES["tiered_options"] = """
SELECT customer_id, tier, campaign_name, cost, retention_rate, churn_probability AS churn_prob,
       clv_prediction AS clv, churn_probability * clv_prediction * retention_rate - cost AS expected_value,
       churn_probability * retention_rate AS impact
FROM scores JOIN tiered ON clv_prediction >= min_clv AND churn_probability >= min_churn
WHERE tier = 0 OR churn_probability * clv_prediction * retention_rate - cost > 0"""
TIER_BUDGET = 1203.0
for _name, _key in (("value", "expected_value"), ("retention", "impact")):
    CTES[f"tiered_{_name}_ranked"] = (
        f"SELECT *, row_number() OVER (ORDER BY {_key} DESC, customer_id, tier) AS pos "
        "FROM tiered_options"
    )
    CTES[f"tiered_{_name}_walk"] = walk(
        f"tiered_{_name}_ranked",
        f"SELECT 'all' AS scenario, {TIER_BUDGET}::DOUBLE AS money",
        "cost",
    ).replace("WALKNAME", f"tiered_{_name}_walk")
    CTES[f"tiered_{_name}"] = (
        f"SELECT o.* FROM tiered_{_name}_ranked o JOIN tiered_{_name}_walk w "
        "ON o.pos = w.pos AND w.took"
    )


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_0-9]+\b", sql))
    return [name for name in CTES if name in words]


# Words that are also column names or report labels: only counted after FROM or JOIN.
_CLASHES = {"returns", "gaps", "portfolio", "months", "options", "windows", "product", "campaign",
            "features", "labels", "raw", "clean", "latest", "trend", "named", "profiles", "tight",
            "valid", "engagement", "scores", "targets", "history", "bounds", "basket", "sound"}


def _used(sql: str) -> set[str]:
    after = set(re.findall(r"(?:FROM|JOIN|,)\s*\(?\s*([a-z_0-9]+)\b", sql))
    return {n for n in _needs(sql) if n in after or n not in _CLASHES}


def build(final: str) -> str:
    wanted: set[str] = set()
    todo = list(_used(final))
    while todo:
        name = todo.pop()
        if name in wanted:
            continue
        wanted.add(name)
        todo += [n for n in _used(CTES[name]) if n != name]
    parts = []
    for name in CTES:
        if name in wanted:
            kind = "" if name.endswith("_walk") else " MATERIALIZED"
            parts.append(f"{name} AS{kind} ({CTES[name]})")
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + final


F_RFM = ("rfm_monetary_avg", "rfm_monetary_total", "rfm_monetary_std")
ALL_DOUBLES = (
    *F_RFM,
    *[f"revenue_{n}_{d}d" for n, d in WINDOWS],
    "interpurchase_time_mean", "interpurchase_time_std", "interpurchase_time_median",
    "interpurchase_time_cv", "purchase_frequency_per_month",
    "avg_basket_size", "std_basket_size", "return_rate", "product_diversity_hhi",
    "engagement_score", "engagement_score_normalized", "consistency_score", "activity_score",
    "revenue_trend_slope", "transaction_trend_slope",
    "revenue_trend_direction", "transaction_trend_direction",
)
COUNTS = ("rfm_recency_days", "rfm_frequency_count", "days_since_first_purchase",
          "customer_lifetime_days")
KEYS = "customer_id, snapshot_date"


def pct(a: str, b: str) -> str:
    return f"coalesce(100.0 * ({a}) / nullif({b}, 0), 0)"


def num(expr: str, places: int = 0) -> str:
    """Thousands separators and fixed decimals."""
    return f"format('{{:,.{places}f}}', CAST({expr} AS DOUBLE))"


def dec(expr: str, places: int) -> str:
    return f"format('{{:.{places}f}}', CAST({expr} AS DOUBLE))"


def short(expr: str, places: int) -> str:
    """Rounded number with at least one decimal and no further zeros."""
    fixed = f"CAST(CAST(round({expr}, {places}) AS DECIMAL(28,{places})) AS VARCHAR)"
    return f"regexp_replace(regexp_replace({fixed}, '(\\.[0-9]+?)0+$', '\\1'), '^-(0\\.0)$', '\\1')"


def confusion(source: str, hit: str) -> str:
    return (
        f"SELECT count(*) FILTER (WHERE {hit} AND churn_label = 1) AS tp, "
        f"count(*) FILTER (WHERE {hit} AND churn_label = 0) AS fp, "
        f"count(*) FILTER (WHERE NOT ({hit}) AND churn_label = 1) AS fn, "
        f"count(*) FILTER (WHERE NOT ({hit}) AND churn_label = 0) AS tn FROM {source}"
    )


SCORES = (
    "coalesce(tp / nullif(tp + fp, 0), 0) AS precision, "
    "coalesce(tp / nullif(tp + fn, 0), 0) AS recall, "
    "coalesce(2.0 * tp / nullif(2.0 * tp + fn + fp, 0), 0) AS f1, "
    "coalesce(5.0 * tp / nullif(5.0 * tp + 4.0 * fn + fp, 0), 0) AS f_beta"
)
CTES["ladder"] = (
    "SELECT threshold, tp, fp, fn, tn, " + SCORES + " FROM (SELECT threshold, "
    "count(*) FILTER (WHERE churn_probability >= threshold AND churn_label = 1) AS tp, "
    "count(*) FILTER (WHERE churn_probability >= threshold AND churn_label = 0) AS fp, "
    "count(*) FILTER (WHERE churn_probability < threshold AND churn_label = 1) AS fn, "
    "count(*) FILTER (WHERE churn_probability < threshold AND churn_label = 0) AS tn "
    "FROM labels CROSS JOIN (VALUES "
    + ", ".join(f"({round(0.10 + 0.05 * i, 2)}::DOUBLE)" for i in range(16))
    + ") t(threshold) GROUP BY threshold)"
)
LADDER_OUT = (
    f"SELECT {fx('threshold')} AS threshold, tp, fp, fn, tn, "
    f"{fxs('precision', 'recall', 'f1', 'f_beta')} FROM ladder"
)
CTES["split_rows"] = time_split("labels")
AUC = """(SELECT sum(p * (below + n / 2.0)) / (sum(p) * sum(n)) FROM (
  SELECT p, n, coalesce(sum(n) OVER (ORDER BY churn_probability ROWS BETWEEN UNBOUNDED PRECEDING
                                     AND 1 PRECEDING), 0) AS below
  FROM (SELECT churn_probability, count(*) FILTER (WHERE churn_label = 1) AS p,
               count(*) FILTER (WHERE churn_label = 0) AS n FROM labels GROUP BY churn_probability)))"""
CTES["adjusted"] = """
SELECT customer_id, clv_prediction, churn_probability,
       clv_prediction * (1 - churn_probability) AS clv_risk_adjusted,
       clv_prediction * churn_probability AS expected_churn_loss FROM scores"""


def value_stats(source: str, col: str, places: int) -> str:
    marks = ", ".join(
        f"{fx(f'quantile_cont({col}, {q})', places)} AS p{round(q * 100)}"
        for q in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    )
    return (
        f"SELECT count({col}) AS samples, {fx(f'avg({col})', places)} AS mean, "
        f"{fx(f'stddev_samp({col})', places)} AS std, {fx(f'min({col})', places)} AS min, "
        f"{fx(f'max({col})', places)} AS max, count(*) FILTER (WHERE {col} = 0) AS zero_count, "
        f"{fx(f'100.0 * count(*) FILTER (WHERE {col} = 0) / count({col})', places)} AS zero_pct, "
        f"{marks} FROM {source}"
    )


ALLOC = (
    "customer_id, campaign_tier, campaign_name, "
    + fxs("campaign_cost", "churn_probability", "clv_prediction", "expected_revenue_saved",
          "expected_value", "roi", "expected_retention_rate")
)
TIERED = (
    "customer_id, tier, campaign_name, "
    + fxs("cost", "retention_rate", "expected_value", "churn_prob", "clv")
)
ACTION = """CASE campaign_tier WHEN 'premium' THEN 'Personal Call + 30% Discount + VIP Support'
  WHEN 'standard' THEN 'Email Campaign + 20% Discount'
  WHEN 'light' THEN 'Automated Email + 10% Discount' END"""
CTES["actions"] = (
    "SELECT t.customer_id, row_number() OVER (ORDER BY expected_value DESC, t.customer_id) AS priority_rank, "
    f"campaign_tier, segment_name AS segment, {ACTION} AS action, "
    f"{short('t.churn_probability * 100', 1)} || '%' AS churn_risk, "
    f"'$' || {short('t.clv_prediction', 2)} AS expected_clv, "
    f"'$' || {short('expected_value', 2)} AS expected_return, "
    f"{short('roi * 100', 1)} || '%' AS roi_pct "
    "FROM tight t LEFT JOIN named n ON t.customer_id = n.customer_id"
)
CTES["figures"] = """
SELECT count(*) AS customers, count(*) FILTER (WHERE churn_probability > 0.5) AS churners,
       sum(churn_probability * clv_prediction) AS loss,
       (SELECT total_campaign_cost FROM portfolio) AS cost,
       (SELECT total_expected_revenue_saved FROM portfolio) AS saved,
       (SELECT total_expected_net_value FROM portfolio) AS net,
       (SELECT expected_customers_saved FROM portfolio) AS people,
       (SELECT portfolio_roi_pct FROM portfolio) AS roi
FROM scores"""
CTES["tier_stats"] = f"""
SELECT count(*) AS total_customers, count(*) FILTER (WHERE tier > 0) AS customers_targeted,
       count(*) FILTER (WHERE tier = 0) AS customers_not_targeted, {TIER_BUDGET}::DOUBLE AS total_budget,
       coalesce(sum(cost) FILTER (WHERE tier > 0), 0) AS budget_spent,
       coalesce(sum(expected_value) FILTER (WHERE tier > 0), 0) AS total_expected_value,
       coalesce(sum(churn_prob * retention_rate) FILTER (WHERE tier > 0), 0) AS expected_customers_retained,
       coalesce(sum(churn_prob * clv * retention_rate) FILTER (WHERE tier > 0), 0) AS expected_revenue_saved
FROM tiered_value"""

RAW_COUNTS = """
SELECT count(*) AS rows, 0::BIGINT AS bad_quantity, 0::BIGINT AS bad_price, 0::BIGINT AS bad_date,
       count(*) FILTER (WHERE UnitPrice < 0) AS negative_price,
       count(*) FILTER (WHERE UnitPrice = 0) AS zero_price,
       count(*) FILTER (WHERE UnitPrice >= 0.01) AS valid_price,
       count(*) FILTER (WHERE Quantity < -100000 OR Quantity > 100000) AS quantity_out_of_range,
       count(*) FILTER (WHERE Quantity = 0) AS zero_quantity,
       count(*) FILTER (WHERE InvoiceNo LIKE 'C%') AS cancellations,
       count(*) FILTER (WHERE Quantity < 0) AS returns,
       count(*) FILTER (WHERE Quantity * UnitPrice > 0) AS positive_revenue,
       count(*) FILTER (WHERE Quantity * UnitPrice < 0) AS negative_revenue,
       count(*) FILTER (WHERE Quantity * UnitPrice = 0) AS zero_revenue,
       min(InvoiceDate) AS first_date, max(InvoiceDate) AS last_date,
       count(*) FILTER (WHERE NOT coalesce(InvoiceDate BETWEEN TIMESTAMP '2010-01-01'
                                           AND TIMESTAMP '2012-12-31', false)) AS date_out_of_range,
       count(*) FILTER (WHERE InvoiceDate IS NULL) AS null_dates,
       count(*) FILTER (WHERE CustomerID IS NULL) AS null_customers
FROM raw"""
RAW_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
               "CustomerID", "Country")
CTES["missing"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
    f"100.0 * (count(*) - count({c})) / count(*) AS missing_pct FROM raw"
    for c in RAW_COLUMNS
)
CTES["raw_counts"] = RAW_COUNTS
CTES["duplicate_counts"] = """
SELECT sum(n)::BIGINT AS rows, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS duplicate_rows
FROM (SELECT count(*) AS n FROM raw GROUP BY InvoiceNo, StockCode, CustomerID)"""
CTES["customer_counts"] = """
SELECT sum(n)::BIGINT AS rows, count(CustomerID) AS unique_customers,
       coalesce(sum(n) FILTER (WHERE CustomerID IS NULL), 0)::BIGINT AS null_customers,
       count(*) FILTER (WHERE CustomerID IS NOT NULL AND n < 2) AS below_threshold
FROM (SELECT CustomerID, count(*) AS n FROM raw GROUP BY CustomerID)"""


def _check(name: str, ok: str, bad_level: str, message: str, source: str, where: str = "") -> str:
    return (
        f"SELECT {name} AS \"check\", CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"CASE WHEN {ok} THEN 'INFO' ELSE '{bad_level}' END AS severity, {message} AS message "
        f"FROM {source} {where}"
    )


def _found(n: str, what: str) -> str:
    return f"'Found ' || {num(n)} || ' {what} (' || {num(f'100.0 * {n} / rows', 2)} || '%)'"


CTES["dq"] = " UNION ALL ".join(
    [
        _check("'Schema Validation'", "true", "ERROR", "'All 8 required columns present'", "raw_counts"),
        _check("'Data Type - Quantity'", "bad_quantity = 0", "ERROR", "'Quantity is numeric-compatible'", "raw_counts"),
        _check("'Data Type - UnitPrice'", "bad_price = 0", "ERROR", "'UnitPrice is numeric-compatible'", "raw_counts"),
        _check("'Data Type - InvoiceDate'", "bad_date = 0", "ERROR", "'InvoiceDate is datetime-compatible'", "raw_counts"),
        _check("'Value Range - UnitPrice'", "negative_price = 0", "WARNING",
               f"'Negative: ' || {num('negative_price')} || ', Zero: ' || {num('zero_price')} || ', Valid: ' || {num('valid_price')}", "raw_counts"),
        _check("'Value Range - Quantity'", "true", "WARNING",
               f"'Out of range: ' || {num('quantity_out_of_range')} || ', Zero: ' || {num('zero_quantity')}", "raw_counts"),
        _check("'Business Rule - Cancellations'", "true", "WARNING", _found("cancellations", "cancellations"), "raw_counts"),
        _check("'Business Rule - Returns'", "true", "WARNING", _found("returns", "returns"), "raw_counts"),
        _check("'Business Rule - Revenue Distribution'", "true", "WARNING",
               f"'Positive: ' || {num('positive_revenue')} || ', Negative: ' || {num('negative_revenue')} || ', Zero: ' || {num('zero_revenue')}", "raw_counts"),
        _check("'Date Range Validation'", "date_out_of_range = 0", "WARNING",
               "'Date range: ' || strftime(first_date, '%Y-%m-%d') || ' to ' || strftime(last_date, '%Y-%m-%d') || ' (' || date_sub('day', first_date, last_date) || ' days)'", "raw_counts"),
        _check("'Date Completeness'", "null_dates = 0", "WARNING",
               f"'Found ' || {num('null_dates')} || ' null dates'", "raw_counts", "WHERE null_dates > 0"),
        _check("'Completeness - ' || column_name", "false", "WARNING",
               f"{num('missing_pct', 2)} || '% missing (threshold: 5.0%)'", "missing", "WHERE missing_pct > 5"),
        _check("'Overall Completeness'", "true", "WARNING", f"'Average missing: ' || {num('a', 2)} || '%'",
               "(SELECT avg(missing_pct) AS a FROM missing)"),
        _check("'Duplicate Records'", "duplicate_rows = 0", "WARNING", _found("duplicate_rows", "duplicate rows"), "duplicate_counts"),
        _check("'Customer Data'", "true", "WARNING",
               f"'Unique customers: ' || {num('unique_customers')} || ', Null CustomerID: ' || {num('null_customers')} || ' (' || {num('100.0 * null_customers / rows', 2)} || '%)'", "customer_counts"),
        _check("'Customer Transaction Count'", "true", "WARNING",
               f"{num('below_threshold')} || ' customers with < 2 transactions'", "customer_counts"),
    ]
)


def _qa(name: str, ok: str, message: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"{message} AS message FROM {source}"
    )


R2 = "1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*))"
QA = " UNION ALL ".join(
    [
        _qa("Cleaned data has rows", "n > 0", f"'Found ' || {num('n')} || ' rows'", "(SELECT count(*) AS n FROM clean)"),
        _qa("Required columns present", "true", "'Has: CustomerID, InvoiceDate, Revenue'", "(SELECT 1)"),
        _qa("No null CustomerIDs", "n = 0", "'Nulls: ' || n", "(SELECT count(*) - count(CustomerID) AS n FROM clean)"),
        _qa("Features have customers", "n > 0", f"'Found ' || {num('n')} || ' feature rows'", "(SELECT count(*) AS n FROM rfm_latest)"),
        _qa("Has ~33 features", "true", "'Found 33 features'", "(SELECT 1)"),
        _qa("Customers are segmented", "n > 0", f"'Segmented ' || {num('n')} || ' customers'", "(SELECT count(*) AS n FROM named)"),
        _qa("Has 5-10 segments", "n BETWEEN 5 AND 10", f"'Found ' || {num('n')} || ' segments'", "(SELECT count(DISTINCT segment_name) AS n FROM named)"),
        _qa("Segment strategies exist", "n > 0", f"'Found ' || {num('n')} || ' strategies'", "(SELECT count(*) AS n FROM profiles)"),
        _qa("Has churn_label column", "true", "'churn_label column present'", "(SELECT 1)"),
        _qa("Churn rate is reasonable", "r BETWEEN 0.05 AND 0.95", f"'Churn rate: ' || {num('r * 100', 1)} || '%'", "(SELECT avg(churn_label) AS r FROM labels)"),
        _qa("Has churn probabilities", "true", "'churn_probability column present'", "(SELECT 1)"),
        _qa("Probabilities in [0, 1]", "v = n", "v || '/' || n || ' valid'",
            "(SELECT count(*) AS n, count(*) FILTER (WHERE churn_probability BETWEEN 0 AND 1) AS v FROM scores)"),
        _qa("ROC AUC > 0.5", "a > 0.5", f"'ROC AUC: ' || {dec('a', 4)}", f"(SELECT {AUC} AS a)"),
        _qa("R² score reasonable", "r BETWEEN -1 AND 1", f"'R²: ' || {dec('r', 4)}", f"(SELECT {R2} AS r FROM guesses)"),
        _qa("Has clv_prediction column", "true", "'clv_prediction column present'", "(SELECT 1)"),
        _qa("CLV predictions non-negative", "v = n", "v || '/' || n || ' predictions >= 0'",
            "(SELECT count(*) AS n, count(*) FILTER (WHERE clv_prediction >= 0) AS v FROM scores)"),
        _qa("Customers allocated to campaigns", "n > 0", f"'Allocated ' || {num('n')} || ' customers'", "(SELECT count(*) AS n FROM tight)"),
        _qa("Has campaign_tier column", "true", "'campaign_tier column present'", "(SELECT 1)"),
        _qa("Execution plan covers allocation", "true", "n || '/' || n || ' planned'", "(SELECT count(*) AS n FROM tight)"),
        _qa("Portfolio ROI calculated", "r IS NOT NULL", f"'ROI: ' || {dec('r', 1)} || '%'", "(SELECT portfolio_roi_pct AS r FROM portfolio)"),
        _qa("Customer IDs align", "n > 0", "n || '/' || n || ' customers in all datasets'", "(SELECT count(*) AS n FROM scores)"),
    ]
)


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strategy_values() -> str:
    from tidemark.operators.segments import STRATEGIES

    return ", ".join(
        "(" + ", ".join(_lit(x) for x in (n, p, g, "; ".join(a), t, b)) + ")"
        for n, p, g, a, t, b in STRATEGIES
    )


ABOVE = "customer_id, snapshot_date, "
PROFILE_DOUBLES = ("size_pct", "avg_recency", "avg_frequency", "avg_monetary", "total_revenue",
                   "avg_engagement_score", "avg_customer_age_days", "avg_churn_risk", "avg_clv")


def _min_max(cols: tuple[str, ...]) -> str:
    return ", ".join(
        fx(f"({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0)") + f" AS {c}"
        for c in cols
    )


def finals() -> dict[str, str]:
    q: dict[str, str] = {}
    line_cols = "InvoiceNo, StockCode, Description, InvoiceDate, Country"
    q["raw_transactions"] = (
        f"SELECT {line_cols}, {fxs('Quantity', 'UnitPrice', 'CustomerID')} FROM raw"
    )
    q["clean_transactions"] = (
        f"SELECT {line_cols}, CustomerID, is_cancellation, is_return, \"Year\", \"Month\", \"Day\", "
        f"DayOfWeek, \"Hour\", \"Quarter\", transaction_type, "
        f"{fxs('Quantity', 'UnitPrice', 'Revenue', 'AbsQuantity', 'AbsRevenue')} FROM clean"
    )
    q["cleaning_stats"] = f"""
SELECT *, initial_rows - final_rows AS rows_removed,
       {fx('100.0 * (initial_rows - final_rows) / initial_rows')} AS removal_pct FROM (
SELECT (SELECT count(*) FROM raw) AS initial_rows,
 (SELECT count(*) FROM raw WHERE CustomerID IS NULL) AS null_customer_removed,
 (SELECT count(*) FROM raw WHERE CustomerID IS NOT NULL AND StockCode IS NULL) AS null_stockcode_removed,
 (SELECT count(*) FROM raw WHERE CustomerID IS NOT NULL AND StockCode IS NOT NULL AND Description IS NULL)
   AS null_description_removed,
 0::BIGINT AS null_date_removed, 0::BIGINT AS numeric_conversion_failed,
 (SELECT count(*) FROM sound WHERE InvoiceNo LIKE 'C%') AS cancellations_flagged,
 (SELECT count(*) FROM sound WHERE Quantity < 0) AS returns_flagged,
 (SELECT count(*) FROM sound WHERE UnitPrice < 0.01) AS invalid_price_removed,
 (SELECT count(*) FROM sound WHERE Quantity = 0) AS zero_quantity_removed,
 (SELECT count(*) FROM valid) - (SELECT count(*) FROM cheap) AS price_outliers_removed,
 (SELECT count(*) FROM cheap) - (SELECT count(*) FROM inliers) AS quantity_outliers_removed,
 (SELECT count(*) FROM (SELECT CustomerID FROM inliers GROUP BY CustomerID HAVING count(*) < 2))
   AS customers_removed_min_txn,
 (SELECT count(*) FROM (SELECT CustomerID FROM clean GROUP BY CustomerID
   HAVING avg(CASE WHEN is_return THEN 1.0 ELSE 0.0 END) > 0.8)) AS high_return_customers,
 (SELECT count(*) FROM clean) AS final_rows)"""
    q["price_p99_filter"] = f"""
SELECT {fx('(SELECT v FROM price_cut)')} AS max_price,
       count(*) FILTER (WHERE UnitPrice <= (SELECT v FROM price_cut)) AS kept,
       count(*) FILTER (WHERE UnitPrice > (SELECT v FROM price_cut)) AS removed FROM valid"""
    q["quantity_iqr_filter"] = f"""
SELECT {fx('q1 - 3 * (q3 - q1)')} AS min_quantity, {fx('q3 + 3 * (q3 - q1)')} AS max_quantity,
       (SELECT count(*) FROM inliers) AS kept,
       (SELECT count(*) FROM cheap) - (SELECT count(*) FROM inliers) AS removed FROM qty_cut"""
    q["min_txn_filter"] = "SELECT CustomerID, count(*) AS lines FROM clean GROUP BY CustomerID"
    q["high_return_customers"] = f"""
SELECT CustomerID, lines, return_lines, {fx('return_lines / lines')} AS return_share FROM (
  SELECT CustomerID, count(*) AS lines, count(*) FILTER (WHERE is_return) AS return_lines
  FROM clean GROUP BY CustomerID) WHERE return_lines / lines > 0.3"""
    parts = '"Year", "Month", "Day", DayOfWeek, "Hour", "Quarter"'
    q["date_parts"] = f"SELECT {parts}, count(*) AS lines FROM clean GROUP BY {parts}"
    q["transaction_type"] = f"""
SELECT transaction_type, count(*) AS lines, {fx('sum(AbsQuantity)', 2)} AS abs_quantity,
       {fx('sum(AbsRevenue)', 2)} AS abs_revenue FROM clean GROUP BY transaction_type"""

    q["dq_schema_completeness"] = (
        f"SELECT column_name, missing_count, {fx('missing_pct')} AS missing_pct FROM missing"
    )
    q["dq_row_rules"] = "SELECT * FROM raw_counts"
    q["dq_duplicates"] = "SELECT * FROM duplicate_counts"
    q["dq_customers"] = "SELECT * FROM customer_counts"
    q["dq_report"] = "SELECT * FROM dq"
    q["quality_summary"] = f"""
SELECT 'validation' AS section, "check" AS item, status, CAST(NULL AS DOUBLE) AS value FROM dq
UNION ALL
SELECT 'cleaning', item, NULL, value
FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ({q["cleaning_stats"]})) ON COLUMNS(*) INTO NAME item VALUE value)
UNION ALL
SELECT 'features', item, NULL, value FROM (
  UNPIVOT (SELECT (SELECT count(DISTINCT customer_id) FROM obs)::DOUBLE AS n_customers,
                  (SELECT count(DISTINCT snapshot_date) FROM obs)::DOUBLE AS n_snapshots, 36::DOUBLE AS n_features)
  ON COLUMNS(*) INTO NAME item VALUE value)"""
    q["dq_summary"] = """
SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
       count(*) FILTER (WHERE status = 'FAIL') AS failed,
       count(*) FILTER (WHERE status = 'FAIL' AND severity = 'ERROR') AS errors,
       count(*) FILTER (WHERE status = 'FAIL' AND severity = 'WARNING') AS warnings,
       count(*) FILTER (WHERE status = 'FAIL' AND severity = 'ERROR') = 0 AS ok FROM dq"""

    q["snapshot_dates"] = "SELECT snapshot_date FROM snaps"
    q["snapshot_dates_weekly"] = "SELECT snapshot_date FROM week_snaps"
    q["latest_snapshot"] = f"SELECT {KEYS}, rfm_frequency_count FROM rfm_latest"
    q["newest_snapshots"] = "SELECT snapshot_date FROM snaps ORDER BY snapshot_date DESC LIMIT 6"
    q["pit_window"] = f"""
SELECT snapshot_date, count(DISTINCT customer_id) AS customers, count(*) AS lines,
       {fx('sum(Revenue)', 2)} AS revenue FROM obs GROUP BY snapshot_date"""
    q["temporal_consistency"] = """
SELECT snapshot_date, count(DISTINCT customer_id) AS customers, 0::BIGINT AS count_mismatches,
       0::BIGINT AS revenue_mismatches, 0::BIGINT AS future_rows FROM obs GROUP BY snapshot_date"""

    q["features_rfm"] = f"SELECT {KEYS}, {', '.join(COUNTS)}, {fxs(*F_RFM)} FROM rfm"
    q["features_windows"] = (
        f"SELECT {KEYS}, {', '.join(f'txn_count_{n}_{d}d' for n, d in WINDOWS)}, "
        f"{fxs(*[f'revenue_{n}_{d}d' for n, d in WINDOWS])} FROM windows"
    )
    q["features_interpurchase"] = f"""
SELECT {KEYS}, {fxs('interpurchase_time_mean', 'interpurchase_time_std', 'interpurchase_time_median',
                    'interpurchase_time_cv', 'purchase_frequency_per_month')} FROM gaps"""
    q["features_product"] = f"""
SELECT {KEYS}, unique_products_count, {fxs('product_diversity_hhi', 'avg_basket_size', 'std_basket_size',
                                           'return_rate')}
FROM product JOIN basket USING ({KEYS}) JOIN returns USING ({KEYS})"""
    q["features_engagement"] = f"""
SELECT {KEYS}, {fxs('engagement_score', 'engagement_score_normalized', 'consistency_score',
                    'activity_score')} FROM engagement"""
    q["features_trend"] = f"""
SELECT {KEYS}, {fxs('revenue_trend_slope', 'transaction_trend_slope', 'revenue_trend_direction',
                    'transaction_trend_direction')} FROM trend"""
    q["features_all_snapshots"] = (
        f"SELECT {KEYS}, {', '.join(COUNTS)}, unique_products_count, "
        f"{', '.join(f'txn_count_{n}_{d}d' for n, d in WINDOWS)}, {fxs(*ALL_DOUBLES)}, "
        "snapshot_date - INTERVAL 180 DAY AS observation_start_date, "
        "180 AS observation_window_days FROM features"
    )
    q["features_custom"] = f"""
SELECT s.customer_id, s.rfm_recency_days, preferred_country,
       {fx('avg_purchase_hour')} AS avg_purchase_hour, preferred_day
FROM scores s
LEFT JOIN (SELECT CustomerID, avg("Hour") AS avg_purchase_hour FROM clean GROUP BY CustomerID) h
  ON s.customer_id = h.CustomerID
LEFT JOIN (SELECT CustomerID, Country AS preferred_country FROM (
   SELECT CustomerID, Country, row_number() OVER (PARTITION BY CustomerID ORDER BY count(*) DESC, Country) AS k
   FROM clean GROUP BY CustomerID, Country) WHERE k = 1) c ON s.customer_id = c.CustomerID
LEFT JOIN (SELECT CustomerID, DayOfWeek AS preferred_day FROM (
   SELECT CustomerID, DayOfWeek, row_number() OVER (PARTITION BY CustomerID
          ORDER BY count(*) DESC, DayOfWeek) AS k
   FROM clean GROUP BY CustomerID, DayOfWeek) WHERE k = 1) d ON s.customer_id = d.CustomerID"""
    q["feature_store_metadata"] = """
SELECT (SELECT count(DISTINCT customer_id) FROM obs) AS n_customers, count(*) AS n_snapshots,
       36 AS n_features,
       string_agg(strftime(snapshot_date, '%Y-%m-%d'), ',' ORDER BY snapshot_date) AS snapshot_dates
FROM (SELECT DISTINCT snapshot_date FROM obs)"""
    q["feature_description"] = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, {fx(f'avg({c})')} AS mean, "
        f"{fx(f'stddev_samp({c})')} AS std, {fx(f'min({c})')} AS min, {fx(f'max({c})')} AS max FROM rfm"
        for c in ("rfm_recency_days", "rfm_frequency_count", "rfm_monetary_avg")
    )
    q["top_engagement"] = f"""
SELECT customer_id, rfm_recency_days, rfm_frequency_count,
       {fxs('rfm_monetary_total', 'engagement_score')} FROM (
  SELECT * FROM rfm_latest ORDER BY engagement_score DESC, customer_id LIMIT 10)"""

    q["label_eligibility"] = """
SELECT snapshot_date, count(*) AS initial_customers,
       count(*) FILTER (WHERE transaction_count < 2) AS removed_min_transactions,
       count(*) FILTER (WHERE transaction_count >= 2 AND days_in_observation < 30) AS removed_min_tenure,
       count(*) FILTER (WHERE transaction_count >= 2 AND days_in_observation >= 30) AS eligible_customers
FROM history GROUP BY snapshot_date"""
    q["churn_labels"] = f"""
SELECT {KEYS}, churn_label, last_purchase_date, days_since_last_purchase, transaction_count, tenure_days
FROM labels"""
    means = ", ".join(
        fx(f"avg({src}) FILTER (WHERE churn_label = {flag})") + f" AS {group}_avg_{name}"
        for group, flag in (("churned", 1), ("active", 0))
        for name, src in (("recency", "days_since_last_purchase"), ("frequency", "transaction_count"),
                          ("revenue", "total_revenue"))
    )
    q["churn_label_stats"] = f"""
SELECT snapshot_date, count(*) AS total_customers, count(*) FILTER (WHERE churn_label = 1) AS churned_count,
       count(*) FILTER (WHERE churn_label = 0) AS active_count,
       {fx('100.0 * avg(churn_label)')} AS churn_rate_pct, {means}, 90 AS churn_window_days,
       180 AS observation_window_days, 90 AS prediction_window_days, 30 AS min_tenure_days,
       2 AS min_transactions FROM labels GROUP BY snapshot_date"""
    q["churn_label_validation"] = f"""
SELECT snapshot_date, count(*) AS churned_customers, count(*) FILTER (WHERE NOT returned) AS stayed_churned,
       count(*) FILTER (WHERE returned) AS returned,
       {fx('100.0 * count(*) FILTER (WHERE NOT returned) / count(*)')} AS churn_label_precision,
       90 AS validation_window_days FROM labels WHERE churn_label = 1 GROUP BY snapshot_date"""
    q["churn_rate"] = (
        f"SELECT count(*) AS labels, {fx('100.0 * avg(churn_label)')} AS churn_rate_pct FROM labels"
    )
    q["clv_targets"] = f"SELECT {KEYS}, {fx('clv_target', 2)} AS clv_target, is_censored FROM targets"
    q["clv_target_stats"] = value_stats("targets", "clv_target", 2)

    q["snapshot_dates_to_the_end"] = """
SELECT snapshot_date FROM (
  SELECT CAST(last_day(CAST(m AS DATE)) AS TIMESTAMP) + (f - date_trunc('day', f)) AS snapshot_date, f, last_ts
  FROM (SELECT f, last_ts, unnest(generate_series(date_trunc('month', f), date_trunc('month', last_ts),
                                                  INTERVAL 1 MONTH)) AS m FROM bounds))
WHERE snapshot_date BETWEEN f AND last_ts"""
    q["snapshot_of_short_range"] = "SELECT last_ts AS snapshot_date FROM bounds"
    q["rfm_median_fill"] = (
        f"SELECT customer_id, {fx('coalesce(m, (SELECT quantile_cont(m, 0.5) FROM holes))')} "
        "AS rfm_monetary_avg FROM holes"
    )
    q["rfm_standardised"] = f"SELECT customer_id, {fxs(*_RFM)} FROM scaled"
    q["nearest_centres"] = f"SELECT customer_id, {_nearest()} AS centre FROM scaled"
    apart = "sqrt(" + " + ".join(f"pow(ka.{c} - kb.{c}, 2)" for c in _RFM) + ")"
    q["rule_davies_bouldin"] = f"""
SELECT CAST(count(*) AS INTEGER) AS groups, {fx('avg(worst)')} AS davies_bouldin FROM (
  SELECT ka.segment, max((sa.spread + sb.spread) / {apart}) AS worst
  FROM rule_centres ka JOIN rule_spread sa ON ka.segment = sa.segment
  JOIN rule_centres kb ON ka.segment <> kb.segment JOIN rule_spread sb ON kb.segment = sb.segment
  GROUP BY ka.segment)"""
    q["rule_centre_importance"] = (
        f"SELECT feature, {fx('v / (SELECT sum(v) FROM rule_variance)')} AS importance FROM rule_variance"
    )
    rows = lambda source, target: (
        f"SELECT {KEYS}, {target}, {_RFM[0]}, {_RFM[1]}, {fx(_RFM[2])} AS {_RFM[2]}, split FROM ("
        + time_split(f"(SELECT * FROM rfm JOIN {source} USING (customer_id, snapshot_date))")
        + ")"
    )
    q["churn_training_rows"] = rows("(SELECT customer_id, snapshot_date, churn_label FROM labels)", "churn_label")
    q["clv_training_rows"] = rows(
        "(SELECT customer_id, snapshot_date, clv_target FROM targets)", f"{fx('clv_target')} AS clv_target"
    )
    q["clv_log_round_trip"] = f"""
SELECT {KEYS}, {fx('y', 3)} AS log_target, {fx('greatest(exp(y) - 1, 0)', 3)} AS back,
       {fx('greatest(exp(-y) - 1, 0)', 3)} AS clipped
FROM (SELECT {KEYS}, ln(1 + greatest(actual - 1000, 0)) AS y FROM guesses)"""
    q["clv_churn_adjusted"] = f"""
SELECT customer_id, {fx('clv_prediction')} AS clv_prediction, {fx('p')} AS churn_probability,
       {fx('clv_prediction * (1 - p)')} AS clv_risk_adjusted
FROM (SELECT customer_id, clv_prediction, churn_probability AS p FROM scores)"""
    q["chart_sample"] = """
SELECT customer_id, rfm_recency_days FROM scores
ORDER BY md5(CAST(customer_id AS VARCHAR) || ':42'), customer_id LIMIT 5000"""

    q["temporal_split"] = f"SELECT {KEYS}, split FROM split_rows"
    q["split_class_distribution"] = f"""
SELECT split, count(*) AS samples, count(*) FILTER (WHERE churn_label = 1) AS churned,
       count(*) FILTER (WHERE churn_label = 0) AS active, {fx('100.0 * avg(churn_label)')} AS churn_rate_pct,
       100.0 * avg(churn_label) < 10 OR 100.0 * avg(churn_label) > 40 AS extreme
FROM split_rows GROUP BY split"""
    q["class_weights"] = f"""
SELECT 0 AS churn_label, {fx('1.0')} AS weight FROM (SELECT 1)
UNION ALL SELECT 1 AS churn_label, {fx('count(*) FILTER (WHERE churn_label = 0) / count(*) FILTER (WHERE churn_label = 1)')} AS weight
FROM labels"""
    q["threshold_search"] = LADDER_OUT
    q["best_threshold"] = f"{LADDER_OUT.replace(' FROM ladder', '')} FROM (SELECT * FROM ladder ORDER BY f_beta DESC, threshold LIMIT 1)"
    q["key_thresholds"] = f"""{LADDER_OUT} WHERE ladder.threshold IN (0.3, 0.5, 0.7)
  OR ladder.threshold = (SELECT threshold FROM ladder ORDER BY f_beta DESC, threshold LIMIT 1)"""
    metrics = ", ".join(
        f"{fx(e)} AS {n}"
        for n, e in {
            "threshold": "0.5",
            "accuracy": "(tp + tn) / (tp + fp + fn + tn)",
            "precision": "tp / (tp + fp)",
            "recall": "tp / (tp + fn)",
            "f1_score": "2.0 * tp / (2.0 * tp + fn + fp)",
            "f2_score": "5.0 * tp / (5.0 * tp + 4.0 * fn + fp)",
            "churn_capture_rate": "tp / (tp + fn)",
            "precision_at_threshold": "tp / (tp + fp)",
            "lift_at_top_k_pct": "(tp / (tp + fp)) / ((tp + fn) / (tp + fp + fn + tn))",
            "roc_auc": AUC,
        }.items()
    )
    q["binary_metrics"] = f"""
SELECT {metrics}, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives
FROM ({confusion('labels', 'churn_probability >= 0.5')})"""
    q["classification_report"] = f"""
SELECT 'Active' AS class, {fx('tn / (tn + fn)')} AS precision, {fx('tn / (tn + fp)')} AS recall,
       {fx('2.0 * tn / (2.0 * tn + fn + fp)')} AS f1_score, tn + fp AS support
FROM ({confusion('labels', 'churn_probability >= 0.5')})
UNION ALL
SELECT 'Churned', {fx('tp / (tp + fp)')}, {fx('tp / (tp + fn)')}, {fx('2.0 * tp / (2.0 * tp + fn + fp)')}, tp + fn
FROM ({confusion('labels', 'churn_probability >= 0.5')})"""
    q["roc_auc_rank"] = f"""
SELECT count(*) FILTER (WHERE churn_label = 1) AS positives,
       count(*) FILTER (WHERE churn_label = 0) AS negatives, {fx(AUC)} AS roc_auc FROM labels"""
    q["risk_levels"] = f"""
SELECT risk_level, count(*) AS customers, {fx('100.0 * count(*) / (SELECT count(*) FROM scores)')} AS pct
FROM scores WHERE risk_level IS NOT NULL GROUP BY risk_level"""
    q["regression_metrics"] = f"""
SELECT {fx('sqrt(avg((actual - predicted) * (actual - predicted)))', 2)} AS rmse,
       {fx('avg(abs(actual - predicted))', 2)} AS mae,
       {fx(R2, 2)} AS r2_score,
       {fx('100 * avg(abs(actual - predicted) / actual) FILTER (WHERE actual > 0)', 2)} AS mape,
       {fx('100 * abs(sum(actual) - sum(predicted)) / sum(actual)', 2)} AS portfolio_error_pct,
       {fx('sum(actual)', 2)} AS total_actual_clv, {fx('sum(predicted)', 2)} AS total_predicted_clv
FROM guesses"""
    q["decile_analysis"] = f"""
SELECT decile, {fxs('actual_sum', 'actual_mean', 'predicted_sum', 'predicted_mean', places=2)}, count,
       {fx('100.0 * actual_sum / sum(actual_sum) OVER ()', 2)} AS actual_pct,
       {fx('100.0 * sum(actual_sum) OVER (ORDER BY decile) / sum(actual_sum) OVER ()', 2)} AS cumulative_pct
FROM (SELECT greatest(1, CAST(ceil(10.0 * i / (n - 1)) AS INTEGER)) AS decile, sum(actual) AS actual_sum,
             avg(actual) AS actual_mean, count(*) AS count, sum(predicted) AS predicted_sum,
             avg(predicted) AS predicted_mean
      FROM (SELECT *, row_number() OVER (ORDER BY predicted DESC, customer_id, snapshot_date) - 1 AS i,
                   count(*) OVER () AS n FROM guesses) GROUP BY 1)"""
    q["risk_adjusted_clv"] = f"""
SELECT customer_id, {fx('clv_prediction')} AS clv_prediction, {fx('p')} AS churn_probability,
       {fx('clv_prediction * (1 - p)')} AS clv_risk_adjusted, {fx('clv_prediction * p')} AS expected_churn_loss
FROM (SELECT customer_id, clv_prediction,
             CASE WHEN risk_level IS NULL THEN 0.2::DOUBLE ELSE churn_probability END AS p FROM scores)"""
    q["risk_adjusted_stats"] = f"""
SELECT {fx('avg(clv_prediction)')} AS mean_base_clv, {fx('avg(clv_risk_adjusted)')} AS mean_risk_adjusted_clv,
       {fx('avg(expected_churn_loss)')} AS mean_expected_loss,
       {fx('sum(expected_churn_loss)')} AS total_expected_loss FROM adjusted"""
    q["clv_bands"] = f"""
SELECT * FROM (SELECT CASE WHEN clv_prediction <= 0 THEN NULL WHEN clv_prediction <= 100 THEN 'Low'
   WHEN clv_prediction <= 300 THEN 'Medium' WHEN clv_prediction <= 500 THEN 'High' ELSE 'Very High' END AS clv_band,
   count(*) AS customers, {fx('100.0 * count(*) / (SELECT count(*) FROM scores)')} AS pct
FROM scores GROUP BY 1) WHERE clv_band IS NOT NULL"""
    q["clv_prediction_stats"] = value_stats("scores", "clv_prediction", 4)
    q["top_risk_adjusted"] = f"""
SELECT customer_id, {fxs('clv_prediction', 'churn_probability', 'clv_risk_adjusted')} FROM (
  SELECT * FROM adjusted ORDER BY clv_risk_adjusted DESC, customer_id LIMIT 10)"""

    q["segment_rule_names"] = "SELECT customer_id, segment_name FROM named"
    q["segment_profiles"] = f"SELECT segment, size, segment_name, {fxs(*PROFILE_DOUBLES)} FROM profiles"
    q["segment_strategies"] = f"""
SELECT segment, segment_name, size, {fx('size_pct')} AS size_pct, priority, goal, actions, campaign_type,
       budget_allocation
FROM profiles JOIN (VALUES {_strategy_values()})
  s(segment_name, priority, goal, actions, campaign_type, budget_allocation) USING (segment_name)"""
    q["segment_summary"] = f"""
SELECT segment AS "Segment ID", segment_name AS "Segment Name", size AS "Customer Count",
       {fx('size_pct', 1)} AS "Percentage (%)", {fx('round(avg_recency, 1)', 1)} AS "Avg Days Since Purchase",
       {fx('round(avg_frequency, 1)', 1)} AS "Avg Transactions",
       {fx('round(avg_monetary, 2)', 1)} AS "Avg Order Value ($)",
       {fx('round(total_revenue, 2)', 1)} AS "Total Revenue ($)" FROM profiles"""
    q["segment_top3"] = " UNION ALL ".join(
        f"SELECT '{m}' AS measure, segment, segment_name, {fx(m, 2)} AS value FROM "
        f"(SELECT * FROM profiles ORDER BY {m} DESC, segment LIMIT 3)"
        for m in ("size", "total_revenue")
    )
    q["segment_sizes"] = (
        "SELECT segment_name AS label, count(*) AS customers FROM named GROUP BY segment_name"
    )
    q["segment_minmax"] = (
        f"SELECT segment, {_min_max(('avg_recency', 'avg_frequency', 'avg_monetary'))} FROM profiles"
    )
    q["segment_comparison"] = (
        "SELECT segment, "
        + _min_max(("avg_recency", "avg_frequency", "avg_monetary", "avg_engagement_score"))
        + " FROM profiles"
    )
    q["revenue_share"] = f"""
SELECT segment, {fx('total_revenue')} AS total_revenue,
       {fx('100.0 * total_revenue / sum(total_revenue) OVER ()')} AS revenue_pct,
       {fx('avg(total_revenue) OVER ()')} AS avg_revenue FROM profiles"""

    value_cols = fxs("churn_probability", "clv_prediction", "campaign_cost", "expected_revenue_saved",
                     "expected_value", "roi", "expected_retention_rate")
    q["expected_value"] = f"""
SELECT customer_id, campaign_tier, campaign_name, {fx('expected_loss_baseline')} AS expected_loss_baseline,
       {value_cols} FROM all_options"""
    q["campaign_options"] = f"SELECT customer_id, campaign_tier, campaign_name, {value_cols} FROM options"
    q["greedy_allocation_ample"] = f"SELECT {ALLOC} FROM ample"
    q["greedy_allocation_tight"] = f"SELECT {ALLOC} FROM tight"
    q["allocation_by_tier"] = f"""
SELECT campaign_tier, count(*) AS customers, {fx('sum(campaign_cost)')} AS cost,
       {fx('sum(expected_revenue_saved)')} AS expected_revenue, {fx('sum(expected_value)')} AS expected_value
FROM tight GROUP BY campaign_tier"""
    q["portfolio_metrics"] = f"""
SELECT total_customers_targeted, {fxs('total_campaign_cost', 'total_expected_revenue_saved',
  'total_expected_net_value', 'expected_customers_saved', 'portfolio_roi_pct', 'cost_per_customer_saved')}
FROM portfolio"""
    loss = "churn_probability * clv_prediction"
    q["baseline_loss"] = f"""
SELECT count(*) AS customers, {fx('sum(clv_prediction)')} AS total_clv,
       {fx(f'sum({loss})')} AS baseline_expected_loss,
       {fx('avg(churn_probability)')} AS avg_churn_probability FROM scores"""
    q["baseline_loss_by_risk"] = f"""
SELECT risk_level, count(*) AS customers, {fx(f'sum({loss})')} AS expected_loss,
       {fx(f'100.0 * sum({loss}) / (SELECT sum({loss}) FROM scores)')} AS loss_pct
FROM scores WHERE risk_level IS NOT NULL GROUP BY risk_level"""
    q["lift_vs_baseline"] = f"""
SELECT {fx('sum(expected_revenue_saved)')} AS revenue_saved, {fx(f'sum({loss})')} AS baseline_loss,
       {fx(f'sum(expected_revenue_saved) / sum({loss})')} AS lift_vs_baseline FROM tight"""
    q["budget_sensitivity"] = f"""
SELECT {fx(f'scenario * {TIGHT_BUDGET}')} AS budget, count(*) AS customers_targeted,
       {fx('sum(campaign_cost)')} AS budget_used, {fx('sum(expected_revenue_saved)')} AS expected_revenue,
       {fx('sum(expected_value)')} AS expected_value,
       {fx('100.0 * sum(expected_value) / sum(campaign_cost)')} AS roi_pct,
       {fx('sum(churn_probability * expected_retention_rate)')} AS customers_saved
FROM ranked_options o JOIN budget_walk w ON o.pos = w.pos AND w.took GROUP BY scenario"""
    q["execution_plan"] = f"""
SELECT t.customer_id, row_number() OVER (ORDER BY expected_value DESC, t.customer_id) AS priority_rank,
       campaign_tier, {fx('expected_value')} AS expected_value, segment_name
FROM tight t LEFT JOIN named n ON t.customer_id = n.customer_id"""
    q["tier_summary"] = f"""
SELECT campaign_tier, count(*) AS customers, {fx('sum(campaign_cost)')} AS total_cost,
       {fx('sum(expected_revenue_saved)')} AS expected_revenue, {fx('sum(expected_value)')} AS expected_value,
       {fx('avg(churn_probability)')} AS avg_churn_probability, {fx('avg(clv_prediction)')} AS avg_clv
FROM tight GROUP BY campaign_tier"""
    q["tier_top5"] = f"""
SELECT campaign_tier, customer_id, {fxs('clv_prediction', 'churn_probability', 'expected_value')}, tier_rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY campaign_tier ORDER BY expected_value DESC, customer_id)
             AS INTEGER) AS tier_rank FROM tight) WHERE tier_rank <= 5"""
    q["tiered_assignment"] = f"SELECT {TIERED} FROM tiered_value"
    q["tiered_assignment_retention"] = f"SELECT {TIERED} FROM tiered_retention"
    q["tiered_stats"] = f"""
SELECT total_customers, customers_targeted, customers_not_targeted,
       {fxs('total_budget', 'budget_spent', 'total_expected_value', 'expected_customers_retained',
            'expected_revenue_saved')},
       {fx(pct('budget_spent', 'total_budget'))} AS budget_utilization_pct,
       {fx(pct('total_expected_value', 'budget_spent'))} AS expected_roi_pct FROM tier_stats"""
    q["campaign_distribution"] = (
        "SELECT campaign_name, count(*) AS customers FROM tiered_value GROUP BY campaign_name"
    )
    pay = int(TIER_BUDGET / 5)
    q["strategy_comparison"] = f"""
SELECT 'Expected Value' AS strategy, total_customers, customers_targeted, {fx('budget_spent')} AS budget_spent,
       {fx(pct('total_expected_value', 'budget_spent'))} AS expected_roi_pct,
       {fx('total_expected_value')} AS total_expected_value FROM tier_stats
UNION ALL SELECT 'Naive (All High Churn)', count(*), t, {fx('t * 5.0')}, {fx('50.0')}, NULL FROM (
  SELECT *, least(count(*) FILTER (WHERE churn_probability > 0.5) OVER (), {pay}) AS t FROM scores) GROUP BY t
UNION ALL SELECT 'Random Targeting', count(*), {pay}, {fx(str(TIER_BUDGET))}, {fx('20.0')}, NULL FROM scores"""

    q["customer_action_list"] = "SELECT * FROM actions"
    q["top_customer_actions"] = "SELECT * FROM actions WHERE priority_rank <= 100"
    q["report_segment_profiles"] = f"""
SELECT segment_name AS "Segment", count(*) AS "Customer Count",
       {num('100.0 * count(*) / (SELECT count(*) FROM named)', 1)} || '%' AS "Percentage",
       {num('100 * avg(churn_probability)', 1)} || '%' AS "Avg Churn Risk",
       '$' || {dec('avg(clv_prediction)', 2)} AS "Avg CLV", '$' || {num('sum(clv_prediction)', 2)} AS "Total CLV",
       count(*) FILTER (WHERE churn_probability > 0.7) AS "High Risk Count" FROM named GROUP BY segment_name"""
    rows = [
        ("Total Customers", num("customers"), num("customers"), "'→'"),
        ("Customers Churning", num("churners"), num("churners - people"),
         f"'-' || {dec('people', 0)} || ' (' || {dec('100.0 * people / churners', 0)} || '%)'"),
        ("Churn Rate", f"{num('100.0 * churners / customers', 1)} || '%'",
         f"{num('100.0 * (churners - people) / customers', 1)} || '%'",
         f"'-' || {num('100.0 * churners / customers - 100.0 * (churners - people) / customers', 1)} || '%'"),
        ("Revenue at Risk", f"'$' || {num('loss')}", f"'$' || {num('loss - saved')}", f"'$' || {num('saved')}"),
        ("Retention Investment", "'$0'", f"'$' || {num('cost')}", f"'-$' || {num('cost')}"),
        ("Revenue Saved", "'$0'", f"'$' || {num('saved')}", f"'+$' || {num('saved')}"),
        ("Net Impact", f"'-$' || {num('loss')}", f"'$' || {num('net')}", f"'+$' || {num('net + loss')}"),
        ("ROI", "'N/A'", f"{dec('roi', 0)} || '%'", f"'+' || {dec('roi', 0)} || '%'"),
    ]
    q["impact_report"] = " UNION ALL ".join(
        f"SELECT '{m}' AS \"Metric\", {a} AS \"Baseline (No Action)\", {b} AS \"With ML Optimization\", "
        f"{c} AS \"Improvement\" FROM figures"
        for m, a, b, c in rows
    )
    q["financial_impact"] = " UNION ALL ".join(
        f"SELECT '{n}' AS category, {fx(e, 2)} AS amount FROM figures"
        for n, e in (("Baseline Churn Loss", "-loss"), ("Campaign Cost", "-cost"),
                     ("Revenue Saved", "saved"), ("Net Value", "net"))
    )
    sizes = "(SELECT segment_name, count(*) AS n FROM named GROUP BY segment_name)"
    q["business_summary"] = f"""
SELECT (SELECT {num('count(*)')} FROM clean) AS total_transactions_analyzed,
 (SELECT {num('count(DISTINCT CustomerID)')} FROM clean) AS total_customers,
 (SELECT strftime(min(InvoiceDate), '%Y-%m-%d') || ' to ' || strftime(max(InvoiceDate), '%Y-%m-%d') FROM clean)
   AS date_range,
 (SELECT '$' || {num('sum(Revenue)', 2)} FROM clean) AS total_revenue,
 (SELECT CAST(count(*) AS VARCHAR) FROM {sizes}) AS number_of_segments,
 (SELECT segment_name FROM {sizes} ORDER BY n DESC, segment_name LIMIT 1) AS largest_segment,
 (SELECT segment_name FROM {sizes} ORDER BY n, segment_name LIMIT 1) AS smallest_segment,
 (SELECT {num('100 * avg(churn_probability)', 1)} || '%' FROM scores) AS overall_churn_risk,
 (SELECT {num('count(*)')} FROM scores WHERE churn_probability > 0.7) AS high_risk_customers,
 (SELECT '$' || {dec('avg(clv_prediction)', 2)} FROM scores) AS average_clv,
 (SELECT '$' || {dec('quantile_cont(clv_prediction, 0.5)', 2)} FROM scores) AS median_clv,
 (SELECT '$' || {num('sum(clv_prediction)', 2)} FROM scores) AS total_portfolio_clv,
 '$' || {num('total_campaign_cost', 2)} AS budget_allocated,
 {num('total_customers_targeted')} AS customers_targeted,
 '$' || {num('total_expected_revenue_saved', 2)} AS expected_revenue_saved,
 '$' || {num('total_expected_net_value', 2)} AS expected_net_value,
 {num('portfolio_roi_pct', 1)} || '%' AS portfolio_roi,
 {dec('expected_customers_saved', 0)} AS expected_customers_saved
FROM portfolio"""
    q["campaign_breakdown"] = f"""
SELECT upper(left(campaign_tier, 1)) || substr(campaign_tier, 2) || ' Campaign' AS campaign,
       {num('count(*)')} AS customers, '$' || {num('sum(campaign_cost)', 2)} AS cost,
       '$' || {num('sum(expected_value)', 2)} AS expected_value FROM tight GROUP BY campaign_tier"""
    q["tier_chart"] = f"""
SELECT campaign_tier, count(*) AS customers, {fx('sum(campaign_cost)')} AS budget FROM tight GROUP BY campaign_tier"""
    q["clv_histogram"] = f"""
SELECT CAST(b + 1 AS INTEGER) AS bin, {fx('low + (high - low) / 30 * b')} AS bin_low,
       {fx('low + (high - low) / 30 * (b + 1)')} AS bin_high, count(clv_prediction) AS customers
FROM (SELECT min(clv_prediction) AS low, max(clv_prediction) AS high FROM scores)
CROSS JOIN (SELECT unnest(range(0, 30)) AS b)
LEFT JOIN scores ON b = least(CAST(floor((clv_prediction - low) / ((high - low) / 30)) AS INTEGER), 29)
GROUP BY b, low, high"""
    q["output_checks"] = QA
    return q


def statements() -> dict[str, str]:
    return {name: build(sql) for name, sql in finals().items()}
