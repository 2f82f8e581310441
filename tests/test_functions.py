import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import quantiles
from tidemark.functions.columns import plain_number, right_closed_bands, whole_days
from tidemark.functions.ordering import with_position, with_running_totals
from tidemark.functions.quantiles import exact_quantiles, kth_values

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def _values(kind):
    rng = random.Random(7)
    if kind == "spread":
        return [rng.uniform(-50, 1000) for _ in range(3001)]
    if kind == "hot":  # a third of all rows on one value, another third on the largest
        return [5.0] * 1000 + [999.0] * 1000 + [rng.uniform(0, 999) for _ in range(1000)]
    return [float(rng.randrange(20)) for _ in range(501)]


@pytest.mark.parametrize("kind", ["spread", "hot", "few"])
def test_quantiles_equal_linear_interpolation(spark, kind, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_VALUES", 40)  # forces several narrowing rounds
    values = _values(kind)
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = exact_quantiles(df, F.col("v"), FRACTIONS)
    assert got == pytest.approx(list(np.quantile(values, FRACTIONS)), abs=1e-9)


@pytest.mark.parametrize("hot", [0.996, 0.5])
def test_hot_value_leaves_few_values_to_pick_from(spark, monkeypatch, hot):
    monkeypatch.setattr(quantiles, "MAX_VALUES", 100)
    given = []
    pick = quantiles._pick
    monkeypatch.setattr(quantiles, "_pick", lambda v, s: given.append((v, s)) or pick(v, s))
    rng = random.Random(2)
    values = [rng.uniform(1, 9) for _ in range(800)]
    values += [0.0] * int(800 / (1 - hot) * hot)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    fractions = [0.01, 0.5, 0.9, 0.995, 0.998, 0.9999]
    got = exact_quantiles(df, F.col("v"), fractions)
    assert got == pytest.approx(list(np.quantile(values, fractions)), abs=1e-9)
    for frame, searches in given:
        for s in searches:
            if s.value is None:
                assert frame.where(s.holds()).distinct().count() <= 100


def test_quantiles_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, F.col("v"), [0.5, 0.9]) == [None, None]
    one = spark.createDataFrame([(3.0,)], "v double")
    assert exact_quantiles(one, F.col("v"), [0.0, 0.5, 1.0]) == [3.0, 3.0, 3.0]


def test_kth_values_of_longs(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_VALUES", 10)
    ids = random.Random(1).sample(range(10**15), 700)
    df = spark.createDataFrame([(i,) for i in ids], "v long")
    ranks = [0, 1, 349, 698, 699]
    got = kth_values(df, F.col("v"), ranks)
    assert got == {r: sorted(ids)[r] for r in ranks}


def test_running_totals_follow_the_global_order(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0.0, 1.0, rng.random()]), rng.randrange(9)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, key double, w long").repartition(5)
    got = with_running_totals(df, [F.desc("key"), F.col("id")], {"upto": F.col("w")})
    want, total = {}, 0
    for i, _, w in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += w
        want[i] = total
    assert {r["id"]: r["upto"] for r in got.collect()} == want


def test_positions_restart_per_group(spark):
    rows = [(i, "big" if i % 10 else "small", i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, key long")
    got = with_position(df, [F.col("key"), F.col("id")], within=["g"]).collect()
    for g in ("big", "small"):
        ordered = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))
        want = {r[0]: k + 1 for k, r in enumerate(ordered)}
        assert {r["id"]: r["position"] for r in got if r["g"] == g} == want


def test_whole_days_are_elapsed_not_calendar(spark):
    df = spark.sql(
        "select timestamp'2020-01-01 23:00:00' a, timestamp'2020-01-03 01:00:00' b"
    )
    assert df.select(whole_days(F.col("a"), F.col("b"))).first()[0] == 1


def test_bands_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.3, 0.31, 9.0, None)], "v double")
    band = right_closed_bands(F.col("v"), [(0.3, "a"), (None, "b")], 0.0)
    assert [r[0] for r in df.select(band).collect()] == [None, "a", "b", "b", None]


def test_plain_numbers(spark):
    values = [24.5, 24.0, 0.125, -0.04, 12345678.9, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(plain_number(F.col("v"), 2)).collect()]
    assert got == ["24.5", "24.0", "0.13", "-0.04", "12345678.9", "100.0"]
    df = spark.createDataFrame([(-0.001,)], "v double")
    assert df.select(plain_number(F.col("v"), 2)).first()[0] == "0.0"
