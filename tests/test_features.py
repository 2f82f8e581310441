import random
from collections import Counter, defaultdict
from datetime import timedelta
from pathlib import Path
from statistics import mean, median, stdev

import pytest
from pyspark.sql import functions as F

from tests.conftest import utc
from tidemark.operators import features, panes, snapshots
from tidemark.settings import FeatureRules

SNAPS = ["2020-03-31 08:26:00", "2020-04-30 08:26:00", "2020-05-31 08:26:00"]


def _random_rows(n=400, customers=12, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Customer 1 holds a third of all lines.
        c = 1 if rng.random() < 0.33 else rng.randrange(2, customers)
        at = utc("2019-08-01 00:00:00") + timedelta(minutes=rng.randrange(330 * 24 * 60))
        if rng.random() < 0.3 and rows:
            at = utc(rows[-1][3])
        rows.append(
            (c, rng.randrange(120), rng.randrange(15), at.strftime("%Y-%m-%d %H:%M:%S"),
             rng.choice([-3, -1, 1, 2, 5]), rng.randrange(1, 400) / 4)
        )
    # Edges of the window of the first snapshot, and one second outside.
    start = utc(SNAPS[0]) - timedelta(days=180)
    for k, t in enumerate(
        [start, start - timedelta(seconds=1), utc(SNAPS[0]), utc(SNAPS[0]) + timedelta(seconds=1)]
    ):
        rows.append((50, 900 + k, 1, t.strftime("%Y-%m-%d %H:%M:%S"), 1, 10 + k))
    # Months with a gap, equal revenue per visit, one-line customer.
    rows += [(60, 950 + k, 3, t, 2, 12.5) for k, t in enumerate(
        ["2019-12-15 10:00:00", "2020-02-15 10:00:00", "2020-03-15 10:00:00"])]
    rows.append((70, 990, 4, "2020-02-01 12:00:00", 4, 2.5))
    return rows


def _brute(rows, snap):
    """The definitions, one customer at a time."""
    s = utc(snap)
    by = defaultdict(list)
    for c, inv, p, t, q, u in rows:
        at = utc(t)
        if s - timedelta(days=180) <= at <= s:
            by[c].append((at, inv, p, q, q * u))
    out = {}
    for c, ls in by.items():
        ls.sort(key=lambda x: x[0])
        rev = [x[4] for x in ls]
        gaps = [(b[0] - a[0]).days for a, b in zip(ls, ls[1:])]
        baskets = defaultdict(float)
        months = defaultdict(lambda: [0.0, 0])
        for at, inv, p, q, r in ls:
            baskets[inv] += q
            months[(at.year, at.month)][0] += r
            months[(at.year, at.month)][1] += 1
        sizes = [abs(v) for v in baskets.values()]
        shares = Counter(x[2] for x in ls)
        n = len(ls)
        life = (ls[-1][0] - ls[0][0]).days
        cv = (stdev(gaps) / mean(gaps)) if len(gaps) > 1 and mean(gaps) else 0.0

        def slope(col):
            ys = [months[k][col] for k in sorted(months)]
            m = len(ys)
            if m < 2:
                return 0.0
            xm = (m - 1) / 2
            return sum((i - xm) * y for i, y in enumerate(ys)) / sum(
                (i - xm) ** 2 for i in range(m)
            )

        recency = (s - ls[-1][0]).days
        f = {
            "rfm_recency_days": recency,
            "rfm_frequency_count": n,
            "rfm_monetary_avg": mean(rev),
            "rfm_monetary_total": sum(rev),
            "rfm_monetary_std": stdev(rev) if n > 1 else 0.0,
            "days_since_first_purchase": (s - ls[0][0]).days,
            "customer_lifetime_days": life,
            "interpurchase_time_mean": mean(gaps) if gaps else 0.0,
            "interpurchase_time_std": stdev(gaps) if len(gaps) > 1 else 0.0,
            "interpurchase_time_median": median(gaps) if gaps else 0.0,
            "interpurchase_time_cv": cv,
            "purchase_frequency_per_month": n / (life / 30 if life else 1),
            "unique_products_count": len(shares),
            "avg_basket_size": mean(sizes),
            "std_basket_size": stdev(sizes) if len(sizes) > 1 else 0.0,
            "return_rate": sum(x[3] < 0 for x in ls) / n,
            "product_diversity_hhi": 1 - sum((k / n) ** 2 for k in shares.values()),
            "engagement_score": sum(rev) / (recency + 1),
            "consistency_score": 1 / (cv + 1),
            "revenue_trend_slope": slope(0),
            "transaction_trend_slope": slope(1),
        }
        for name, d in FeatureRules().windows:
            recent = [x for x in ls if x[0] >= s - timedelta(days=d)]
            f[f"txn_count_{name}_{d}d"] = len(recent)
            f[f"revenue_{name}_{d}d"] = sum(x[4] for x in recent)
        f["activity_score"] = f["txn_count_short_30d"] / (n + 1)
        out[c] = f
    best = max(v["engagement_score"] for v in out.values())
    for v in out.values():
        v["engagement_score_normalized"] = v["engagement_score"] / best if best else 0.0
    return out


@pytest.fixture(scope="module")
def built(make_lines, make_snapshots):
    rows = _random_rows()
    df = features.customer_features(make_lines(rows), make_snapshots(*SNAPS))
    return rows, df.columns, [r.asDict() for r in df.collect()]


def test_all_features_equal_the_definitions(built):
    rows, _, got = built
    for snap in SNAPS:
        want = _brute(rows, snap)
        have = {r["customer_id"]: r for r in got if r["snapshot_date"] == utc(snap)}
        assert set(have) == set(want)
        for c, f in want.items():
            for name, value in f.items():
                assert have[c][name] == pytest.approx(value, rel=1e-9, abs=1e-7), (snap, c, name)


def test_a_customer_of_a_third_of_the_lines_is_dealt_to_several_tasks(make_lines, make_snapshots, built, monkeypatch):
    rows, _, _ = built
    hot = [(7, 9000 + i % 90, i % 40, f"2020-0{1 + i % 2}-{1 + i % 27:02} 10:00:00", 1 + i % 9, 2) for i in range(len(rows) // 2)]
    lines, snaps = make_lines(rows + hot), make_snapshots(*SNAPS)

    def found():
        df = features.customer_features(lines, snaps).select(
            "customer_id", "snapshot_date", "unique_products_count", "product_diversity_hhi", "avg_basket_size", "std_basket_size"
        )
        return {(r["customer_id"], r["snapshot_date"]): tuple(r)[2:] for r in df.collect()}

    whole = found()
    monkeypatch.setattr(features, "HEAVY_LINES", 25)
    split = found()
    assert set(whole) == set(split)
    for k, v in whole.items():
        assert split[k] == pytest.approx(v, rel=1e-9, abs=1e-9)
    calendar = features.calendar_for(snaps)
    panes = features.into_panes(features.by_customer(lines), calendar, ["customer_id", "StockCode"], [F.count(F.lit(1)).alias("n")])
    tasks = features._dealt(panes, lines, "StockCode").where("customer_id = 7").select(F.spark_partition_id(), "share").distinct()
    assert tasks.select("share").distinct().count() > 3
    plan = features.product_features(lines, calendar)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" in plan and "StockCode, snapshot_date" not in "".join(
        x for x in plan.splitlines() if "Exchange" in x
    )


def test_window_bounds_are_inclusive(built):
    _, _, got = built
    edge = {r["snapshot_date"]: r for r in got if r["customer_id"] == 50}
    assert edge[utc(SNAPS[0])]["rfm_frequency_count"] == 2  # the start and the snapshot itself
    assert edge[utc(SNAPS[0])]["rfm_recency_days"] == 0


def test_equal_revenues_have_no_deviation_and_no_trend(built):
    _, _, got = built
    row = next(r for r in got if r["customer_id"] == 60 and r["snapshot_date"] == utc(SNAPS[0]))
    assert row["rfm_monetary_std"] == 0.0
    assert row["revenue_trend_slope"] == 0.0 and row["revenue_trend_direction"] == 0.0
    assert row["interpurchase_time_median"] == 45.5  # gaps of 62 and 29 days


def test_columns(built):
    _, columns, got = built
    assert columns == ["customer_id", *features.feature_columns(), *features.METADATA]
    assert len(features.feature_columns()) == 33
    assert got[0]["observation_window_days"] == 180


def test_later_rows_do_not_change_features(make_lines, make_snapshots, built):
    rows, _, got = built
    later = [(1, 5000 + i, 2, "2020-04-02 00:00:00", 7, 100) for i in range(20)]
    df = features.customer_features(make_lines(rows + later), make_snapshots(SNAPS[0]))
    want = {r["customer_id"]: r for r in got if r["snapshot_date"] == utc(SNAPS[0])}
    for r in df.collect():
        for k, v in r.asDict().items():
            assert v == pytest.approx(want[r["customer_id"]][k]) if isinstance(v, float) else (
                v == want[r["customer_id"]][k]
            )


def test_consistency_check_finds_a_leak(make_lines, make_snapshots):
    rows = _random_rows(120)
    lines = make_lines(rows)
    f = features.activity_features(lines, features.calendar_for(make_snapshots(*SNAPS)))
    clean = snapshots.temporal_consistency(lines, f).collect()
    assert len(clean) == 3 and all(
        r["count_mismatches"] == r["revenue_mismatches"] == r["future_rows"] == 0 for r in clean
    )
    leaky = f.withColumn("rfm_frequency_count", F.col("rfm_frequency_count") + 1)
    assert all(r["count_mismatches"] > 0 for r in snapshots.temporal_consistency(lines, leaky).collect())


def test_preferences_prefer_the_smallest_of_equals(spark):
    df = spark.createDataFrame(
        [(1, "B", 3, 10), (1, "A", 5, 12), (1, "B", 3, 14), (1, "A", 1, 8), (2, "C", 0, 1)],
        "CustomerID long, Country string, DayOfWeek int, Hour int",
    )
    got = {r["customer_id"]: r for r in features.preference_features(df).collect()}
    assert (got[1]["preferred_country"], got[1]["preferred_day"], got[1]["avg_purchase_hour"]) == (
        "A", 3, 11.0,
    )


def test_month_end_snapshots_keep_the_time_of_day(make_lines):
    lines = make_lines([(1, 1, 1, "2019-12-01 08:26:00", 1, 1), (1, 2, 1, "2020-12-09 12:50:00", 1, 1)])
    got = [r[0].strftime("%Y-%m-%d %H:%M") for r in snapshots.snapshot_dates(lines).collect()]
    assert got == [f"2020-0{m}-{d} 08:26" for m, d in ((5, 31), (6, 30), (7, 31), (8, 31))]
    newest = [r[0].month for r in snapshots.newest(snapshots.snapshot_dates(lines), 2).collect()]
    assert sorted(newest) == [7, 8]


def test_weekly_snapshots_are_sundays(make_lines):
    lines = make_lines([(1, 1, 1, "2020-01-01 08:00:00", 1, 1), (1, 2, 1, "2020-11-01 09:00:00", 1, 1)])
    got = [r[0] for r in snapshots.snapshot_dates(lines, "week").collect()]
    assert all(t.weekday() == 6 and t.hour == 8 for t in got)
    assert got[0] == utc("2020-07-05 08:00:00") and got[-1] == utc("2020-08-02 08:00:00")


def test_short_range(make_lines):
    lines = make_lines([(1, 1, 1, "2020-01-01 08:00:00", 1, 1), (1, 2, 1, "2020-03-01 09:00:00", 1, 1)])
    with pytest.raises(Exception, match="270 days"):
        snapshots.snapshot_dates(lines).collect()
    only = snapshots.snapshot_dates(lines, short_range="latest").collect()
    assert [r[0] for r in only] == [utc("2020-03-01 09:00:00")]


def test_tasks_follow_the_number_of_lines(make_lines, make_snapshots, monkeypatch):
    """Pane rows were dealt to as many tasks as their size before the repeat by snapshot asked for."""
    lines = make_lines([(i % 50, i, 1, f"2020-0{1 + i % 2}-{1 + i % 27:02} 10:00:00", 1, 2) for i in range(300)])
    monkeypatch.setattr(panes, "TASK_LINES", 10)
    calendar = features.calendar_for(make_snapshots(*SNAPS))
    for df in (features._activity_rows(lines, calendar, FeatureRules()), features._dealt(lines.withColumnRenamed("CustomerID", "customer_id"), lines, "StockCode")):
        assert df.rdd.getNumPartitions() == 30
    assert features.activity_features(lines, calendar).count() > 0


def test_features_of_many_lines_are_written_once_and_the_same(spark, make_lines, make_snapshots, monkeypatch):
    """The features of all snapshots were once written twice."""
    import query_registry

    rows = [(c, 10 * c + k, (c * k) % 5, f"2021-0{1 + (c + k) % 6}-1{k} 10:00:00", k - 1.5, 2.0 + c) for c in range(1, 9) for k in range(1, 6)]
    given = make_lines(rows), make_snapshots("2021-04-30 00:00:00", "2021-06-30 00:00:00")

    class Given(query_registry.Inputs):
        lines = property(lambda self: given[0])
        snapshots = property(lambda self: given[1])

    def made(name):
        return sorted(map(tuple, Given(spark, name).features.collect()))

    few = made("few")
    monkeypatch.setattr(panes, "TASK_LINES", 10)
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    assert made("many") == few
    assert len([p for p in set(folder.iterdir()) - before if p.name.startswith("features-")]) == 1
