"""Campaign options per customer and budget allocation.

Options live in an array on the customer row: three to five entries from a
fixed table.  Choosing the best affordable option is then a map over rows, and
only one row per customer is ever ordered or moved.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import percent, ratio
from tidemark.functions.ordering import with_position, with_running_totals
from tidemark.functions.staging import stage


@dataclass(frozen=True)
class Campaign:
    tier: str
    name: str
    cost: float
    retention_rate: float
    description: str
    priority: int


@dataclass(frozen=True)
class TieredCampaign:
    tier: int
    name: str
    description: str
    cost: float
    retention_rate: float
    min_clv: float
    min_churn_prob: float


# Campaigns of the value optimiser.
CAMPAIGNS = (
    Campaign(
        "premium", "Premium Retention", 50.0, 0.60,
        "Personal outreach, 30% discount, dedicated support", 3,
    ),
    Campaign(
        "standard", "Standard Retention", 25.0, 0.40,
        "Automated email, 20% discount, standard support", 2,
    ),
    Campaign("light", "Light Touch", 10.0, 0.20, "Generic email, 10% discount", 1),
    Campaign("none", "No Intervention", 0.0, 0.0, "No retention campaign", 0),
)

# Campaigns of the tiered assignment, with eligibility limits.
TIERED_CAMPAIGNS = (
    TieredCampaign(1, "VIP Personal Outreach", "Personal call + 20% discount", 25.0, 0.50, 500, 0.6),
    TieredCampaign(
        2, "Premium Email Campaign", "Personalized email + 10% discount", 5.0, 0.30, 200, 0.5
    ),
    TieredCampaign(
        3, "Standard Retention", "Email campaign + small incentive", 2.0, 0.20, 100, 0.3
    ),
    TieredCampaign(4, "Basic Email", "Generic retention email", 1.0, 0.10, 50, 0.2),
    TieredCampaign(0, "No Action", "Do not target", 0.0, 0.0, 0, 0.0),
)

ALLOCATION_COLUMNS = (
    "customer_id",
    "campaign_tier",
    "campaign_name",
    "campaign_cost",
    "churn_probability",
    "clv_prediction",
    "expected_revenue_saved",
    "expected_value",
    "roi",
    "expected_retention_rate",
)
SENSITIVITY = (0.5, 0.75, 1.0, 1.5, 2.0)
SCENARIO = "budget"


def expected_value(p: Column, clv: Column, cost: Column, rate: Column) -> Column:
    """Revenue kept by the campaign minus its cost."""
    return p * clv * rate - cost


def scored_customers(clv: DataFrame, churn: DataFrame) -> DataFrame:
    """Customers that have both predictions."""
    if "risk_level" in churn.columns:
        churn = churn.select("customer_id", "churn_probability", "risk_level")
    else:
        churn = churn.select("customer_id", "churn_probability")
    return clv.select("customer_id", "clv_prediction").join(churn, "customer_id")


# --- value optimiser ----------------------------------------------------------------


def _option(c: Campaign) -> Column:
    p, clv = F.col("churn_probability"), F.col("clv_prediction")
    saved = p * clv * F.lit(c.retention_rate)
    value = saved - F.lit(c.cost)
    return F.struct(
        F.lit(c.tier).alias("campaign_tier"),
        F.lit(c.name).alias("campaign_name"),
        F.lit(c.cost).alias("campaign_cost"),
        saved.alias("expected_revenue_saved"),
        value.alias("expected_value"),
        ratio(value, F.lit(c.cost)).alias("roi"),
        F.lit(c.retention_rate).alias("expected_retention_rate"),
    )


def with_options(
    customers: DataFrame, min_roi: float = 0.0, campaigns: Sequence[Campaign] = CAMPAIGNS
) -> DataFrame:
    """Customers with the array of their options of at least ``min_roi``."""
    paid = [_option(c) for c in campaigns if c.cost > 0]
    return customers.withColumn(
        "options", F.filter(F.array(*paid), lambda o: o["roi"] >= F.lit(float(min_roi)))
    )


def expected_values(
    customers: DataFrame, campaigns: Sequence[Campaign] = CAMPAIGNS
) -> DataFrame:
    """One row per customer and campaign, without any filter."""
    p, clv = F.col("churn_probability"), F.col("clv_prediction")
    return customers.withColumn("expected_loss_baseline", p * clv).select(
        "customer_id",
        "churn_probability",
        "clv_prediction",
        "expected_loss_baseline",
        F.inline(F.array(*[_option(c) for c in campaigns])),
    )


def campaign_options(
    customers: DataFrame, min_roi: float = 0.0, campaigns: Sequence[Campaign] = CAMPAIGNS
) -> DataFrame:
    """One row per option that meets the minimum ROI."""
    return with_options(customers, min_roi, campaigns).select(
        "customer_id", "churn_probability", "clv_prediction", F.inline("options")
    )


def _cents(col: Column) -> Column:
    return F.round(col * 100).cast("long")


#: Intervals of the rank in which offers are counted, and offers that the driver puts in order itself.
INTERVALS, SORTED = 256, 10_000


@dataclass(frozen=True)
class _Round:
    """Offers up to (``a``, ``id``, ``b``) are taken while ``money`` is left; up to ``a`` if ``id`` is None."""

    money: int
    a: float | None = None  # None: no offer
    id: object = None
    b: object = None

    def cells(self) -> Column:
        values = (self.money, self.a, self.id, self.b)
        return F.struct(*[F.lit(v).alias(n) for v, n in zip(values, ("money", "a", "id", "b"))])


def _best(options: Column, money: Column, rank: str, cost: str, tier: str) -> Column:
    """The best option that ``money`` can pay, as (a, b, o) with the least a = -rank first."""
    payable = F.filter(options, lambda o: _cents(o[cost]) <= money)
    return F.array_min(
        F.transform(payable, lambda o: F.struct((-o[rank]).alias("a"), o[tier].alias("b"), o.alias("o")))
    )


def _taken(rounds: Mapping[str, Sequence[_Round]], kinds: str, rank: str, cost: str, tier: str, offer: str) -> Column:
    """The offer that a customer gets in one of the rounds done so far, else null."""
    done = [
        (F.lit(name), F.array(*[r.cells() for r in each]).cast(kinds) if each else F.array().cast(kinds))
        for name, each in rounds.items()
    ]
    mine = F.element_at(F.create_map(*[x for pair in done for x in pair]), F.col(SCENARIO))

    def after(got: Column, r: Column) -> Column:
        o = _best(F.col("options"), r["money"], rank, cost, tier)
        key = F.struct(F.col("customer_id"), o["b"])
        upto = (o["a"] < r["a"]) | ((o["a"] == r["a"]) & (r["id"].isNull() | (key <= F.struct(r["id"], r["b"]))))
        return F.when(got.isNotNull(), got).otherwise(F.when(upto, o))

    return F.aggregate(mine, F.lit(None).cast(offer), after)


def _interval(a: Column, edges: Mapping[str, Sequence[float]]) -> Column:
    """Number of the interval of ``a`` between the scenario's edges; an edge belongs to the lower one."""
    mine = F.create_map(*[x for n, e in edges.items() for x in (F.lit(n), F.array(*map(F.lit, e)))])
    return F.size(F.filter(F.element_at(mine, F.col(SCENARIO)), lambda e: e < a))


def _cuts(offers: DataFrame, left: Mapping[str, int], edges: Sequence[float]) -> dict[str, tuple[_Round, int, bool]]:
    """For each scenario how far its money reaches: (round, money spent, whether offers wait).

    Offers are counted by interval of their rank.  Only the interval in which the money
    ends is looked at closer: cut again, or put in order when it is small or one value.
    """
    cuts: dict[str, tuple[_Round, int, bool]] = {}
    limits = {name: (list(edges), 0, -math.inf, math.inf) for name in left}  # edges, spent before, bounds
    while limits:
        inside = F.lit(False)
        for name, (_, _, low, high) in limits.items():
            inside = inside | ((F.col(SCENARIO) == name) & (F.col("a") > low) & (F.col("a") <= high))
        some = offers.where(inside).withColumn("interval", _interval(F.col("a"), {n: x[0] for n, x in limits.items()}))
        sums = some.groupBy(SCENARIO, "interval").agg(
            F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"), F.min("a").alias("least"), F.max("a").alias("most")
        )
        by: dict[str, list] = {name: [] for name in limits}
        for r in sums.orderBy(SCENARIO, "interval").collect():  # bounded by INTERVALS
            by[r[SCENARIO]].append(r)
        small: dict[str, tuple[int, float, float]] = {}
        after: dict[str, tuple[list, int, float, float]] = {}
        for name, rows in by.items():
            spent, low = limits[name][1], limits[name][2]
            for r in rows:
                if spent + r["cents"] > left[name]:
                    if r["n"] <= SORTED or r["least"] == r["most"]:
                        small[name] = (spent, low, r["most"])
                    else:
                        after[name] = ([], spent, low, r["most"])
                    break
                spent, low = spent + r["cents"], r["most"]
            else:
                cuts[name] = (_Round(left[name], low if rows else None), spent, False)
        if after:
            inside = F.lit(False)
            for name, (_, _, low, high) in after.items():
                inside = inside | ((F.col(SCENARIO) == name) & (F.col("a") > low) & (F.col("a") <= high))
            finer = _edges(offers.where(inside).groupBy(SCENARIO))
            after = {name: (finer[name], *x[1:]) for name, x in after.items()}
        for name, (round_, spent) in _ordered_cuts(offers, small, left).items():
            cuts[name] = (round_, spent, True)
        limits = after
    return cuts


def _edges(groups) -> dict[str, list[float]]:
    points = [(i + 1) / INTERVALS for i in range(INTERVALS - 1)]
    found = groups.agg(F.percentile_approx("a", points, 10 * INTERVALS).alias("e"), F.min("a").alias("least")).collect()
    # The least value is an edge, so that a hot one leaves the interval above it.
    return {r[SCENARIO]: sorted({r["least"], *r["e"]}) for r in found}


def _ordered_cuts(
    offers: DataFrame, small: Mapping[str, tuple[int, float, float]], left: Mapping[str, int]
) -> dict[str, tuple[_Round, int]]:
    """Where the money ends inside one interval of each scenario."""
    if not small:
        return {}
    inside, money = F.lit(False), []
    for name, (spent, low, high) in small.items():
        inside = inside | ((F.col(SCENARIO) == name) & (F.col("a") > low) & (F.col("a") <= high))
        money += [F.lit(name), F.lit(left[name] - spent)]
    found = offers.where(inside).select(SCENARIO, "a", "customer_id", "b", "cents")
    ordered = [SCENARIO, "a", "customer_id", "b"]
    top = found.limit(SORTED * len(small) + 1).count()
    if top <= SORTED * len(small):
        rows, last = found.orderBy(*ordered).collect(), {}
        spent = {name: x[0] for name, x in small.items()}
        open_ = set(small)
        for r in rows:
            name = r[SCENARIO]
            if name in open_ and spent[name] + r["cents"] <= left[name]:
                spent[name] += r["cents"]
                last[name] = (r["a"], r["customer_id"], r["b"])
            else:
                open_.discard(name)
    else:  # many offers of one rank
        running = with_running_totals(
            found, [F.col(c) for c in ordered[1:]], {"spent": F.col("cents")}, within=[SCENARIO]
        )
        fits = running.where(F.col("spent") <= F.element_at(F.create_map(*money), F.col(SCENARIO)))
        key = F.struct("a", "customer_id", "b")
        ends = fits.groupBy(SCENARIO).agg(F.max(key).alias("last"), F.max("spent").alias("spent")).collect()
        last = {r[SCENARIO]: tuple(r["last"]) for r in ends}
        spent = {name: x[0] for name, x in small.items()}
        for r in ends:
            spent[r[SCENARIO]] += r["spent"]
    out = {}
    for name, (before, low, _) in small.items():
        cut = _Round(left[name], *last[name]) if name in last else _Round(left[name], low)
        out[name] = (cut, spent[name])
    return out


def greedy(
    customers: DataFrame,
    budgets: Mapping[str, float],
    rank: str,
    cost: str,
    tier: str,
) -> DataFrame:
    """Walk all options from the best down, one per customer, within the budget.

    ``customers`` has ``customer_id`` and an ``options`` array of structs with
    the fields named by ``rank``, ``cost`` and ``tier``.  Order: rank descending,
    customer, tier.  Each budget is an independent scenario; all of them are
    solved in the same jobs.

    Exact and parallel.  Per round every open customer offers the best option
    that the remaining budget could pay.  In the global order, all offers before
    the first one that does not fit are what the sequential walk takes: nobody
    after that point has an option before it.  The offer that does not fit, and
    every option dearer than the rest of the money, can never fit later.  So each
    round drops at least one distinct cost, and there are no more rounds than
    distinct costs.

    A round is known by its money and its last offer, so whether and when a customer is
    served is an expression of the row: nothing is sorted, moved or written between
    rounds.  The last offer is found by counts (``_cuts``).
    """
    if not budgets:
        raise ValueError("no budget given")
    left = {name: round(b * 100) for name, b in budgets.items()}
    customers = stage(customers, "customers")
    option = customers.schema["options"].dataType.elementType
    tier_type = option[tier].dataType.simpleString()
    id_type = customers.schema["customer_id"].dataType.simpleString()
    kinds = f"array<struct<money: bigint, a: double, id: {id_type}, b: {tier_type}>>"
    offer = f"struct<a: double, b: {tier_type}, o: {option.simpleString()}>"
    every = F.explode(F.array(*[F.lit(name) for name in left]))
    ranks = customers.select(F.explode(F.transform("options", lambda o: -o[rank])).alias("a"), F.lit("").alias(SCENARIO))
    edges = _edges(ranks.groupBy(SCENARIO)).get("", [])
    rounds: dict[str, list[_Round]] = {name: [] for name in left}
    while left:
        served = customers.withColumn(SCENARIO, every).where(F.col(SCENARIO).isin(*left))
        served = served.where(_taken(rounds, kinds, rank, cost, tier, offer).isNull())
        money = F.element_at(F.create_map(*[x for k, v in left.items() for x in (F.lit(k), F.lit(v))]), F.col(SCENARIO))
        best = _best(F.col("options"), money, rank, cost, tier)
        offers = served.select(SCENARIO, "customer_id", best.alias("offer")).where("offer is not null")
        cents = _cents(F.col(f"offer.o.{cost}"))
        offers = offers.select(SCENARIO, "customer_id", "offer.a", "offer.b", cents.alias("cents"))
        cuts = _cuts(offers, left, edges)
        for name, (cut, _, _) in cuts.items():
            rounds[name].append(cut)
        left = {name: left[name] - spent for name, (_, spent, waits) in cuts.items() if waits}
    rest = [c for c in customers.columns if c != "options"]
    result = customers.withColumn(SCENARIO, every).withColumn("offer", _taken(rounds, kinds, rank, cost, tier, offer))
    return result.where("offer is not null").select(SCENARIO, *rest, "offer.o.*")


def allocate_budgets(
    clv: DataFrame,
    churn: DataFrame,
    budgets: Mapping[str, float],
    min_roi: float = 0.0,
    campaigns: Sequence[Campaign] = CAMPAIGNS,
) -> DataFrame:
    """Allocation per budget scenario (column ``budget`` holds its name)."""
    customers = with_options(scored_customers(clv, churn), min_roi, campaigns).select(
        "customer_id", "churn_probability", "clv_prediction", "options"
    )
    result = greedy(customers, budgets, "expected_value", "campaign_cost", "campaign_tier")
    return result.select(SCENARIO, *ALLOCATION_COLUMNS)


def allocate_budget(
    clv: DataFrame,
    churn: DataFrame,
    total_budget: float,
    min_roi: float = 0.0,
    campaigns: Sequence[Campaign] = CAMPAIGNS,
) -> DataFrame:
    """Best campaign per customer by expected value, within one budget."""
    return allocate_budgets(clv, churn, {"all": total_budget}, min_roi, campaigns).drop(SCENARIO)


def allocation_by_tier(allocation: DataFrame) -> DataFrame:
    return allocation.groupBy("campaign_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("campaign_cost").alias("cost"),
        F.sum("expected_revenue_saved").alias("expected_revenue"),
        F.sum("expected_value").alias("expected_value"),
    )


def _portfolio() -> list[Column]:
    saved = F.col("churn_probability") * F.col("expected_retention_rate")
    return [
        F.count(F.lit(1)).alias("total_customers_targeted"),
        F.coalesce(F.sum("campaign_cost"), F.lit(0.0)).alias("total_campaign_cost"),
        F.coalesce(F.sum("expected_revenue_saved"), F.lit(0.0)).alias(
            "total_expected_revenue_saved"
        ),
        F.coalesce(F.sum("expected_value"), F.lit(0.0)).alias("total_expected_net_value"),
        F.coalesce(F.sum(saved), F.lit(0.0)).alias("expected_customers_saved"),
    ]


def _portfolio_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "portfolio_roi_pct": percent(
                F.col("total_expected_net_value"), F.col("total_campaign_cost")
            ),
            "cost_per_customer_saved": ratio(
                F.col("total_campaign_cost"), F.col("expected_customers_saved")
            ),
        }
    )


def portfolio_metrics(allocation: DataFrame) -> DataFrame:
    """One row of totals; the tiers are in ``by_campaign_tier``."""
    tiers = allocation_by_tier(allocation).agg(
        F.map_from_entries(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "campaign_tier",
                        F.struct(
                            F.col("customers").alias("count"),
                            "cost",
                            "expected_revenue",
                            "expected_value",
                        ),
                    )
                )
            )
        ).alias("by_campaign_tier")
    )
    return portfolio_totals(allocation).withColumn("by_campaign_tier", tiers.scalar())


def portfolio_totals(allocation: DataFrame) -> DataFrame:
    return _portfolio_ratios(allocation.agg(*_portfolio()))


def baseline_loss(clv: DataFrame, churn: DataFrame) -> DataFrame:
    """Customers, value and expected loss without any campaign."""
    p, v = F.col("churn_probability"), F.col("clv_prediction")
    return scored_customers(clv, churn).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(v).alias("total_clv"),
        F.sum(p * v).alias("baseline_expected_loss"),
        F.avg(p).alias("avg_churn_probability"),
    )


def baseline_loss_by_risk(clv: DataFrame, churn: DataFrame) -> DataFrame:
    """Expected loss and its share of the total by risk level."""
    loss = F.col("churn_probability") * F.col("clv_prediction")
    groups = scored_customers(clv, churn).groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(loss).alias("expected_loss")
    )
    total = groups.agg(F.sum("expected_loss").alias("t"))
    return groups.where(F.col("risk_level").isNotNull()).withColumn(
        "loss_pct", percent(F.col("expected_loss"), total.scalar())
    )


def lift_vs_baseline(allocation: DataFrame) -> DataFrame:
    """Saved revenue over the expected loss of the targeted customers."""
    return allocation.agg(
        F.sum("expected_revenue_saved").alias("revenue_saved"),
        F.sum(F.col("churn_probability") * F.col("clv_prediction")).alias("baseline_loss"),
    ).withColumn("lift_vs_baseline", ratio(F.col("revenue_saved"), F.col("baseline_loss")))


def budget_sensitivity(
    clv: DataFrame,
    churn: DataFrame,
    total_budget: float,
    factors: Sequence[float] = SENSITIVITY,
    min_roi: float = 0.0,
) -> DataFrame:
    """Portfolio totals at several budgets, all solved together."""
    budgets = {repr(float(total_budget * f)): total_budget * f for f in factors}
    allocation = allocate_budgets(clv, churn, budgets, min_roi)
    return _portfolio_ratios(allocation.groupBy(SCENARIO).agg(*_portfolio())).select(
        F.col(SCENARIO).cast("double").alias("budget"),
        F.col("total_customers_targeted").alias("customers_targeted"),
        F.col("total_campaign_cost").alias("budget_used"),
        F.col("total_expected_revenue_saved").alias("expected_revenue"),
        F.col("total_expected_net_value").alias("expected_value"),
        F.col("portfolio_roi_pct").alias("roi_pct"),
        F.col("expected_customers_saved").alias("customers_saved"),
    )


def execution_plan(allocation: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """Allocation in priority order with the segment of the latest snapshot."""
    ranked = with_position(
        allocation, [F.desc("expected_value"), F.col("customer_id")], "priority_rank"
    )
    if segments is None:
        return ranked
    return ranked.join(segments.select("customer_id", "segment_name"), "customer_id", "left")


def tier_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("campaign_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("campaign_cost").alias("total_cost"),
        F.sum("expected_revenue_saved").alias("expected_revenue"),
        F.sum("expected_value").alias("expected_value"),
        F.avg("churn_probability").alias("avg_churn_probability"),
        F.avg("clv_prediction").alias("avg_clv"),
    )


def tier_top(plan: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` customers of each tier.

    The rank filter is applied per task before the shuffle (window group limit),
    so a tier that holds most customers sends n rows per task.
    """
    best = W.partitionBy("campaign_tier").orderBy(F.desc("expected_value"), "customer_id")
    return (
        plan.select(
            "campaign_tier", "customer_id", "clv_prediction", "churn_probability", "expected_value"
        )
        .withColumn("tier_rank", F.row_number().over(best))
        .where(F.col("tier_rank") <= n)
    )


# --- tiered assignment -----------------------------------------------------------------

STRATEGY_RANK = {"expected_value": "expected_value", "maximize_retention": "retention_impact"}


def _clv_column(customers: DataFrame) -> Column:
    for name in ("clv_prediction", "clv_risk_adjusted"):
        if name in customers.columns:
            return F.col(name)
    return F.lit(0.0)


def tiered_options(
    customers: DataFrame, campaigns: Sequence[TieredCampaign] = TIERED_CAMPAIGNS
) -> DataFrame:
    """Customers with the array of campaigns they qualify for and gain from."""
    p, clv = F.col("churn_prob"), F.col("clv")
    options = []
    for c in campaigns:
        value = expected_value(p, clv, F.lit(c.cost), F.lit(c.retention_rate))
        allowed = (clv >= c.min_clv) & (p >= c.min_churn_prob)
        worthwhile = F.lit(True) if c.tier == 0 else value > 0
        options.append(
            F.when(
                allowed & worthwhile,
                F.struct(
                    F.lit(c.tier).alias("tier"),
                    F.lit(c.name).alias("campaign_name"),
                    F.lit(c.cost).alias("cost"),
                    F.lit(c.retention_rate).alias("retention_rate"),
                    value.alias("expected_value"),
                    (p * F.lit(c.retention_rate)).alias("retention_impact"),
                ),
            )
        )
    return (
        customers.select(
            "customer_id",
            F.col("churn_probability").alias("churn_prob"),
            _clv_column(customers).cast("double").alias("clv"),
        )
        .withColumn("options", F.filter(F.array(*options), lambda o: o.isNotNull()))
        # Only customers with some option take part.
        .where(F.size("options") > 0)
    )


def assign_campaigns(
    customers: DataFrame,
    budget: float,
    strategy: str = "expected_value",
    campaigns: Sequence[TieredCampaign] = TIERED_CAMPAIGNS,
) -> DataFrame:
    """Tiered campaign per customer by value or by retention; the rest get No Action."""
    if strategy not in STRATEGY_RANK:
        raise ValueError(f"unknown strategy: {strategy}")
    options = stage(tiered_options(customers, campaigns), "tiered")
    chosen = greedy(options, {"all": budget}, STRATEGY_RANK[strategy], "cost", "tier")
    columns = (
        "customer_id", "tier", "campaign_name", "cost", "retention_rate", "expected_value",
        "churn_prob", "clv",
    )
    chosen = stage(chosen.select(*columns), "assigned")
    left_over = options.join(chosen, "customer_id", "left_anti").select(
        "customer_id",
        F.lit(0).alias("tier"),
        F.lit("No Action").alias("campaign_name"),
        F.lit(0.0).alias("cost"),
        F.lit(0.0).alias("retention_rate"),
        F.lit(0.0).alias("expected_value"),
        "churn_prob",
        "clv",
    )
    return chosen.unionByName(left_over)


def assignment_stats(assignments: DataFrame, budget: float) -> DataFrame:
    """One row: spend, use of budget, value, ROI, retained customers, saved revenue."""
    on = F.col("tier") > 0

    def total(col: Column) -> Column:
        return F.coalesce(F.sum(F.when(on, col)), F.lit(0.0))

    kept = F.col("churn_prob") * F.col("retention_rate")
    return (
        assignments.agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.count_if(on).alias("customers_targeted"),
            F.count_if(~on).alias("customers_not_targeted"),
            F.lit(float(budget)).alias("total_budget"),
            total(F.col("cost")).alias("budget_spent"),
            total(F.col("expected_value")).alias("total_expected_value"),
            total(kept).alias("expected_customers_retained"),
            total(F.col("churn_prob") * F.col("clv") * F.col("retention_rate")).alias(
                "expected_revenue_saved"
            ),
        )
        .withColumn(
            "budget_utilization_pct", percent(F.col("budget_spent"), F.col("total_budget"))
        )
        .withColumn(
            "expected_roi_pct", percent(F.col("total_expected_value"), F.col("budget_spent"))
        )
    )


def campaign_distribution(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("campaign_name").agg(F.count(F.lit(1)).alias("customers"))


def compare_strategies(customers: DataFrame, budget: float) -> DataFrame:
    """Optimised assignment against two simple rules with assumed returns."""
    best = assignment_stats(assign_campaigns(customers, budget), budget).withColumn(
        "strategy", F.lit("Expected Value")
    )
    # Average cost 5 per customer, assumed returns 50 and 20 percent.
    each, naive_roi, random_roi = 5.0, 50.0, 20.0
    can_pay = int(budget / each)
    counts = customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("churn_probability") > 0.5).alias("high"),
    )
    naive = (
        counts.where(F.col("high") > 0)
        .withColumn("customers_targeted", F.least("high", F.lit(can_pay)))
        .select(
            F.lit("Naive (All High Churn)").alias("strategy"),
            "total_customers",
            "customers_targeted",
            (F.col("customers_targeted") * each).alias("budget_spent"),
            F.lit(naive_roi).alias("expected_roi_pct"),
        )
    )
    random = counts.select(
        F.lit("Random Targeting").alias("strategy"),
        "total_customers",
        F.lit(can_pay).cast("long").alias("customers_targeted"),
        F.lit(float(budget)).alias("budget_spent"),
        F.lit(random_roi).alias("expected_roi_pct"),
    )
    return best.unionByName(naive, allowMissingColumns=True).unionByName(
        random, allowMissingColumns=True
    )
