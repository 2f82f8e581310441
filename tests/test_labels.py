import random
from datetime import timedelta

import pytest

from tests.conftest import utc
from tidemark.operators import labels
from tidemark.settings import ChurnRules

SNAP = "2020-06-30 08:00:00"


def _at(days, seconds=0):
    return (utc(SNAP) + timedelta(days=days, seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def _lines(make_lines):
    def seen(c, *extra):
        return [(c, c * 10, 1, _at(-60), 1, 5), (c, c * 10 + 1, 1, _at(-10), 1, 5), *extra]

    rows = (
        seen(1)  # gone
        + seen(2, (2, 1, 1, _at(0), 1, 5))  # on the snapshot: still the past
        + seen(3, (3, 1, 1, _at(90), 1, 7))  # last moment of the window: active
        + seen(4, (4, 1, 1, _at(90, 1), 1, 9))  # one second late: churned, returned later
        + [(5, 1, 1, _at(-60), 1, 5)]  # too few lines
        + [(6, 1, 1, _at(-29), 1, 5), (6, 2, 1, _at(-5), 1, 5)]  # 29 days
        + [(7, 1, 1, _at(-30), 1, 5), (7, 2, 1, _at(-5), 1, 5)]  # 30 days
        + seen(8, (8, 1, 1, _at(0, 1), -2, 50))  # first moment after: active, negative revenue
    )
    return make_lines(rows)


def test_label_edges(make_lines, make_snapshots):
    got = labels.churn_labels(_lines(make_lines), make_snapshots(SNAP)).collect()
    assert {r["customer_id"]: r["churn_label"] for r in got} == {1: 1, 2: 1, 3: 0, 4: 1, 7: 1, 8: 0}
    two = next(r for r in got if r["customer_id"] == 2)
    assert (two["days_since_last_purchase"], two["transaction_count"], two["tenure_days"]) == (0, 3, 60)


def test_eligibility_counts(make_lines, make_snapshots):
    h = labels.customer_history(_lines(make_lines), make_snapshots(SNAP))
    r = labels.eligibility(h).first()
    assert (
        r["initial_customers"], r["removed_min_transactions"],
        r["removed_min_tenure"], r["eligible_customers"],
    ) == (8, 1, 1, 6)


def test_label_statistics_and_validation(make_lines, make_snapshots):
    lines, snap = _lines(make_lines), make_snapshots(SNAP)
    s = labels.churn_label_stats(lines, snap).first()
    assert (s["total_customers"], s["churned_count"], s["active_count"]) == (6, 4, 2)
    assert s["churn_rate_pct"] == pytest.approx(400 / 6)
    v = labels.label_validation(lines, snap).first()
    assert (v["churned_customers"], v["stayed_churned"], v["returned"]) == (4, 3, 1)
    assert v["churn_label_precision"] == 75.0


def test_a_gap_moves_the_window(make_lines, make_snapshots):
    got = labels.churn_labels(
        _lines(make_lines), make_snapshots(SNAP), ChurnRules(gap_days=1)
    ).collect()
    flags = {r["customer_id"]: r["churn_label"] for r in got}
    assert flags[8] == 1 and flags[4] == 0


def test_targets(make_lines, make_snapshots):
    got = {
        r["customer_id"]: r for r in labels.clv_targets(_lines(make_lines), make_snapshots(SNAP)).collect()
    }
    assert got[1]["clv_target"] == 0.0 and got[2]["clv_target"] == 0.0
    assert got[3]["clv_target"] == 7.0 and got[4]["clv_target"] == 9.0
    assert got[8]["clv_target"] == -100.0
    assert len(got) == 8 and all(r["is_censored"] for r in got.values())


def test_random_targets_and_labels(make_lines, make_snapshots):
    rng = random.Random(2)
    rows = [
        (1 if rng.random() < 0.4 else rng.randrange(2, 9), i, 1, _at(rng.randrange(-300, 300), rng.randrange(9)),
         rng.choice([-1, 2]), rng.randrange(1, 50))
        for i in range(150)
    ]
    snaps = [_at(0), _at(31), _at(62)]
    lines, when = make_lines(rows), make_snapshots(*snaps)
    got = {(r["customer_id"], r["snapshot_date"]): r["clv_target"]
           for r in labels.clv_targets(lines, when).collect()}
    flags = {(r["customer_id"], r["snapshot_date"]): r["churn_label"]
             for r in labels.churn_labels(lines, when).collect()}
    want, labelled = {}, {}
    for s in map(utc, snaps):
        past = [r for r in rows if s - timedelta(days=180) <= utc(r[3]) <= s]
        for c in {r[0] for r in past}:
            own = [utc(r[3]) for r in past if r[0] == c]
            want[(c, s)] = sum(
                r[4] * r[5] for r in rows
                if r[0] == c and s < utc(r[3]) <= s + timedelta(days=180)
            )
            if len(own) >= 2 and (s - min(own)).days >= 30:
                labelled[(c, s)] = int(not any(
                    r[0] == c and s < utc(r[3]) <= s + timedelta(days=90) for r in rows
                ))
    assert got == pytest.approx(want)
    assert flags == labelled
